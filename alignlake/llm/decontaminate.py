"""Benchmark decontamination with spaced seeds.

Words are runs of letters, digits and underscores, lower-cased. A text is contaminated by a benchmark item if, on one
diagonal (a fixed shift between both word sequences), a window of ``L = min(24, words of the item)`` item words differs
from the document in at most ``L // 8`` positions. Items of fewer than 12 words must occur without a difference; items of
fewer than ``LEAST`` words are no evidence and are ignored.

Fixed masks pick seven of up to twelve consecutive words; the other positions are ignored. The three masks are
lossless for the rule: whatever positions differ, one mask at one shift sees only equal words (a test tries
all patterns). Items of 8 to 11 words are found by the contiguous mask.

1. Masked hashes of the items go into a bit table of fixed size (``BITS``), built by a Spark aggregation. It only
   saves work: a document position whose hash is not in it cannot match any item.
2. Hits of a document, with the words around them, are stored; the hashes are joined with those of the items.
3. Each (document, item, diagonal) is verified on the words around the hit, which allow for substitutions.

Null and empty texts have no words and are kept; null or repeated items count once. Rows are told apart by id and text, so rows
with equal ids or null ids are judged by their own text. Other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignlake.llm.names import unused
from alignlake.session import written

# 1 picks a word, 0 ignores it.
MASKS = ("1111111", "1011101101", "100101110011")
WINDOW, SHARE, TOLERANT, LEAST = 24, 8, 12, 8
BITS = 24  # the bit table has 2 ** BITS bits, two per hash
WORD = re.compile(r"\w+")
WORD_CACHE = 1_000_000
REACH = WINDOW + max(map(len, MASKS))


class _Words(dict):
    """Hash of a word, kept between texts; emptied when it gets large."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def word_hashes(text: str | None, words: dict) -> np.ndarray:
    found = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(words.__getitem__, found), np.uint64, len(found))


def masked(ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(span, hash at each start) for each mask."""
    found = []
    for number, mask in enumerate(MASKS):
        n = len(ids) - len(mask) + 1
        if n <= 0:
            continue
        h = np.full(n, (number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for p, bit in enumerate(mask):
            if bit == "1":
                h = (h ^ ids[p : p + n]) * np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(29)
        found.append((len(mask), h))
    return found


def bit_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - BITS)).astype(np.int64), ((h >> np.uint64(4)) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def tolerance(n: int) -> tuple[int, int]:
    """Length of the window and differences allowed for an item of n words."""
    window = min(WINDOW, n)
    return window, window // SHARE if n >= TOLERANT else 0


def item_hashes(items: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Items by content (item, ids, words), and their masked hashes (hash, item, at)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            ids = [word_hashes(t, words).view(np.int64) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int64())), batch.column(1)], ["words", "item_id"])

    kind = items.schema[id_column].dataType.simpleString()
    table = items.select(F.col(f"`{text_column}`"), F.col(f"`{id_column}`").alias("item_id")).mapInArrow(split, f"words array<bigint>, item_id {kind}")
    table = table.filter(F.size("words") >= LEAST).groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    table = written(table.withColumn("item", F.xxhash64("words")), "items")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for _, h in masked(np.array(words, np.int64).view(np.uint64)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array([item] * len(h)), pa.array(np.arange(len(h), dtype=np.int32))], ["hash", "item", "at"])

    return table, table.select("item", "words").mapInArrow(hashed, "hash bigint, item bigint, at int")


def bit_table(hashes: DataFrame) -> np.ndarray:
    """2 ** BITS bits; at most 2 ** (BITS - 6) rows reach the driver, whatever the number of items."""
    places = hashes.select(F.explode(F.array(
        F.shiftrightunsigned("hash", 64 - BITS), F.shiftrightunsigned("hash", 4).bitwiseAND((1 << BITS) - 1))).alias("p"))
    rows = places.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("bits")).collect()
    table = np.zeros(1 << (BITS - 6), np.int64)
    for w, bits in rows:
        table[w] = bits
    return np.unpackbits(table.view(np.uint8), bitorder="little").view(bool)


def verify(doc: np.ndarray, start: int, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """Of the best window: equal words, first and last document word; None if no window is near enough.

    ``doc`` holds the document's words from position ``start`` on.
    """
    n = len(item)
    window, allowed = tolerance(n)
    q = np.arange(n) + diagonal - start
    inside = (q >= 0) & (q < len(doc))
    same = np.zeros(n, np.int64)
    same[inside] = doc[q[inside]] == item[inside]
    sums = np.convolve(same, np.ones(window, np.int64), "valid")
    good = np.flatnonzero(sums >= window - allowed)
    if not len(good):
        return None
    return int(sums.max()), int(max(0, good[0] + diagonal)), int(good[-1] + window - 1 + diagonal)


def overlaps(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
             item_text: str = "text") -> DataFrame:
    """(doc, version, item_ids, equal_words, first_word, last_word), one row per text and item that match."""
    known, hashes = item_hashes(items, item_column, item_text)
    table = np.packbits(bit_table(hashes), bitorder="little").tobytes()

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bits = _Words(), np.unpackbits(np.frombuffer(table, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("row", "region", "start", "words", "hashes", "positions")}
            for row, text in enumerate(batch.column(2).to_pylist()):
                ids = word_hashes(text, words)
                at, hit = [], []
                for _, h in masked(ids):
                    one, two = bit_places(h)
                    found = np.flatnonzero(bits[one] & bits[two])
                    at.append(found)
                    hit.append(h[found])
                at = np.concatenate(at) if at else np.empty(0, np.int64)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, hit = at[order], np.concatenate(hit)[order]
                for number, group in enumerate(np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 2 * REACH) + 1)):
                    start = max(0, int(at[group[0]]) - REACH)
                    out["row"].append(row)
                    out["region"].append(number)
                    out["start"].append(start)
                    out["words"].append(ids[start : at[group[-1]] + REACH + 1].view(np.int64))
                    out["hashes"].append(hit[group].view(np.int64))
                    out["positions"].append(at[group].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out["row"], pa.int64())), batch.column(1).take(pa.array(out["row"], pa.int64())),
                 pa.array(out["region"], pa.int32()), pa.array(out["start"], pa.int32()), pa.array(out["words"], pa.list_(pa.int64())),
                 pa.array(out["hashes"], pa.list_(pa.int64())), pa.array(out["positions"], pa.list_(pa.int32()))],
                ["doc", "version", "region", "start", "words", "hashes", "positions"])

    kind = docs.schema[id_column].dataType.simpleString()
    regions = written(
        docs.select(F.col(f"`{id_column}`").alias("doc"), F.xxhash64(F.col(f"`{text_column}`")).alias("version"), F.col(f"`{text_column}`").alias("text"))
        .mapInArrow(hits, f"doc {kind}, version bigint, region int, start int, words array<bigint>, hashes array<bigint>, positions array<int>")
        .withColumn("place", F.xxhash64("version", "region", "start", "words")), "hits")
    # equal passages at equal places of equal texts are one place
    places = regions.dropDuplicates(["place"]).select("place", "start", "words", "hashes", "positions")
    met = (
        places.select("place", F.explode(F.arrays_zip("hashes", "positions")).alias("h"))
        .select("place", F.col("h.hashes").alias("hash"), F.col("h.positions").alias("p"))
        .join(hashes, "hash").select("place", "item", (F.col("p") - F.col("at")).alias("diagonal")).distinct())
    both = met.join(places.select("place", "start", F.col("words").alias("doc_words")), "place").join(known.select("item", "words", "ids"), "item")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                found = verify(np.array(r["doc_words"], np.int64), r["start"], np.array(r["words"], np.int64), r["diagonal"])
                if found:
                    rows.append((r["place"], r["item"], *found))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)],
                ["place", "item", "equal_words", "first_word", "last_word"])

    sure = both.select("place", "item", "diagonal", "start", "doc_words", "words").mapInArrow(
        check, "place bigint, item bigint, equal_words int, first_word int, last_word int")
    return (
        regions.select("doc", "version", "place").distinct().join(sure, "place").groupBy("doc", "version", "item")
        .agg(F.max("equal_words").alias("equal_words"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"))
        .join(known.select("item", F.col("ids").alias("item_ids")), "item"))


def decontaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
                   item_text: str = "text") -> DataFrame:
    """``docs`` with ``items`` (sorted ids of matching items) and ``kept`` (no item matches)."""
    found = overlaps(docs, items, id_column, text_column, item_column, item_text)
    doc, version, listed, own = unused(docs.columns, "doc", "version", "found_items", "text_version")
    per_doc = found.groupBy(F.col("doc").alias(doc), F.col("version").alias(version)).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias(listed))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("items", "kept")]
    marked = docs.withColumn(own, F.xxhash64(F.col(f"`{text_column}`")))
    return (
        marked.join(per_doc, marked[f"`{id_column}`"].eqNullSafe(per_doc[doc]) & (marked[own] == per_doc[version]), "left")
        .select(*kept, F.coalesce(listed, F.array()).alias("items"), F.col(listed).isNull().alias("kept")))
