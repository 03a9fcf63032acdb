"""Phrases of two to four words that occur more often together than apart, counted in counting quotient filters.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words ``[^\\x20\\x09]+``. All counts are per language
(null: ``und``). A candidate occurs ``LEAST`` times or more; its score is ``floor(2000000 * a / (l + r))`` at its worst cut. A candidate
that lies inside a longer one with at least ``INSIDE`` percent of its occurrences is dropped.

1. Documents are tokenized in chunks of ``CHUNK`` bytes, cut between pieces only. A chunk keeps its words as numbers into its own list of
   words; the lists are counted, and every (language, word) that occurs ``LEAST`` times gets a dense id. The ids return to the
   chunks that hold them, so nothing that grows with the data is broadcast. All other words end a phrase.
2. For n = 2, 3, 4 each chunk counts its n-grams in a counting quotient filter: the packed ids go through an invertible
   permutation, the top bits of the result are the quotient, all others the remainder. Quotients are kept as one
   bit per slot and one per entry, so a filter is compact and loses nothing: every key can be read back.
3. Filters are cut by the leading bits of the quotient into shards of about ``ENTRIES`` keys. A shard's sorted filters are merged
   in a stream; n-grams below ``LEAST`` are gone, and each chunk gets back one bit per key. The next n counts only windows of which both halves
   survived, which holds for every frequent one.
4. Cuts, inclusion and ranks are joins of the frequent phrases.

Identical copies count as often as they occur. Null and empty texts hold no word. A language without candidates has no rows, an empty
table gives none. Equal scores stand by count, then by the bytes of the phrase. Other columns are ignored. At most 2^32 - 1 words
may be frequent (an error otherwise).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alignlake.operators import ordering
from alignlake.session import written

CHUNK = 4 << 20
ENTRIES = 2_000_000
LEAST, INSIDE, TOP, LONGEST = 30, 80, 2000, 4
MIX = ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D), (33, None))
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"


# --- words of a chunk -------------------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """An invertible mixing of 64-bit numbers."""
    for shift, factor in MIX:
        x = x ^ (x >> np.uint64(shift))
        if factor:
            x = x * np.uint64(factor)
    return x


def _unmixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in reversed(MIX):
        if factor:
            x = x * np.uint64(pow(factor, -1, 1 << 64))
        y = x
        for _ in range(64 // shift):
            y = x ^ (y >> np.uint64(shift))
        x = y
    return x


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.zeros(256, np.uint8)
    kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return kind, lower


def chunk_words(texts: list[bytes], langs: list[str]) -> tuple[np.ndarray, list[tuple[str, bytes, int]]]:
    """(numbers, words): the words of all texts as 1-based numbers into ``words``, 0 between pieces. ``words`` holds
    (language, word, count), most frequent first."""
    import xxhash

    kind, lower = _tables()
    joined = b"\n".join(texts)
    data = lower[np.frombuffer(joined, np.uint8)]
    sort = kind[data]
    edge = np.diff(np.concatenate(([0], (sort == 0).view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.int32), []
    piece = np.cumsum(sort == 2, dtype=np.int32)[starts]
    names = sorted(set(langs))
    begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    lang = np.searchsorted(names, langs)[np.searchsorted(begin, starts, "right") - 1].astype(np.uint64)
    sizes = ends - starts

    # two lanes hold a word of up to 16 bytes; longer ones are known by a digest of 16 bytes
    padded = np.append(data, np.zeros(16, np.uint8))
    lanes = padded[starts[:, None] + np.arange(16)]
    lanes[np.arange(16) >= sizes[:, None]] = 0
    lanes = lanes.view(np.uint64)
    raw = data.tobytes()
    for i in np.flatnonzero(sizes > 16):
        lanes[i] = np.frombuffer(xxhash.xxh3_128_digest(raw[starts[i] : ends[i]]), np.uint64)
    tag = (sizes.astype(np.uint64) << np.uint64(24)) + lang
    key = _mixed(lanes[:, 0] + _mixed(lanes[:, 1] + _mixed(tag)))
    _, one, place = np.unique(key, return_index=True, return_inverse=True)
    rep = one[place]
    if not ((lanes[rep] == lanes).all() and (tag[rep] == tag).all()):  # two words with one key: compare them whole
        _, one, place = np.unique(np.column_stack([lanes, tag]), axis=0, return_index=True, return_inverse=True)
        place = place.ravel()
    counts = np.bincount(place)
    order = np.argsort(-counts, kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(1, len(order) + 1)
    gap = np.append(0, np.cumsum(piece[1:] != piece[:-1]))
    numbers = np.zeros(len(starts) + gap[-1], np.int32)
    numbers[np.arange(len(starts)) + gap] = number[place]
    return numbers, [(names[lang[i]], raw[starts[i] : ends[i]], int(n)) for i, n in zip(one[order], counts[order], strict=True)]


def planes(values: np.ndarray, width: int = 4) -> bytes:
    """Unsigned numbers, low bytes first and each byte's plane together, which packs well."""
    kind = np.uint32 if width <= 4 else np.uint64
    return np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize)[:, :width].T).tobytes()


def unplaned(data: bytes, count: int, width: int = 4, kind=np.uint32) -> np.ndarray:
    out = np.zeros((count, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, count * width).reshape(width, count).T
    return out.view(kind).ravel()


def parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut at the ends of pieces only."""
    if len(text) <= size:
        yield text
        return
    cuts = np.flatnonzero(_tables()[0][np.frombuffer(text, np.uint8)] == 2)
    low = 0
    while len(text) - low > size:
        i = int(np.searchsorted(cuts, low + size, "right"))
        at = cuts[i - 1] if i and cuts[i - 1] > low else cuts[i] if i < len(cuts) else len(text)
        yield text[low:at]
        low = int(at)
    yield text[low:]


def chunks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(chunk, size, numbers, words, totals) per chunk of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        kind = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())]))

        def row(texts: list[bytes], langs: list[str]) -> pa.RecordBatch:
            nonlocal number
            numbers, words = chunk_words(texts, langs)
            totals = {}
            for name, _, n in words:
                totals[name] = totals.get(name, 0) + n
            number += 1
            column = lambda rows: pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary(), pa.int64()))], fields=list(kind.value_type)))
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(numbers)], pa.int64()), pa.array([planes(numbers)], pa.binary()), column(words),
                 column([(name, b"", n) for name, n in totals.items()])], ["chunk", "size", "numbers", "words", "totals"])

        texts, langs, held = [], [], 0
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                whole = value.as_py()
                for part in parts(whole, CHUNK) if whole else ():
                    if held and held + len(part) > CHUNK:
                        yield row(texts, langs)
                        texts, langs, held = [], [], 0
                    texts.append(part)
                    langs.append(name)
                    held += len(part)
        if held:
            yield row(texts, langs)

    word = "array<struct<lang:string,word:binary,n:bigint>>"
    return docs.select(F.col(f"`{text}`").cast("binary").alias("text"), F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang")).mapInArrow(
        run, f"chunk bigint, size bigint, numbers binary, words {word}, totals {word}")


# --- counting quotient filters ----------------------------------------------------------------------------------------

def permuted(ids: list[np.ndarray]) -> list[np.ndarray]:
    """Packed ids (32 bits each) as one 64-bit lane, or two above two ids, spread over the whole range."""
    ids = [i.astype(np.uint64) for i in ids]
    half = np.uint64(32)
    if len(ids) == 2:
        return [_mixed((ids[0] << half) | ids[1])]
    high = ids[0] if len(ids) == 3 else (ids[0] << half) | ids[1]
    low = (ids[-2] << half) | ids[-1]
    high = high ^ _mixed(low)
    low = low ^ _mixed(high)
    return [high ^ _mixed(low + np.uint64(1)), low]


def restored(lanes: list[np.ndarray], n: int) -> list[np.ndarray]:
    half, mask = np.uint64(32), np.uint64(0xFFFFFFFF)
    if n == 2:
        packed = _unmixed(lanes[0])
        return [packed >> half, packed & mask]
    high, low = lanes
    high = high ^ _mixed(low + np.uint64(1))
    low = low ^ _mixed(high)
    high = high ^ _mixed(low)
    return ([high] if n == 3 else [high >> half, high & mask]) + [low >> half, low & mask]


def summed(lanes: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in ascending order with their summed counts."""
    order = np.argsort(lanes[0], kind="stable") if len(lanes) == 1 else np.lexsort(lanes[::-1])
    lanes = [x[order] for x in lanes]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in lanes])
    first = np.flatnonzero(new)
    return [x[first] for x in lanes], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def to_filter(lanes: list[np.ndarray], counts: np.ndarray, taken: int) -> bytes:
    """Sorted distinct keys whose ``taken`` leading bits are known, as a counting quotient filter.

    The next bits are the quotient, about one slot per entry: ``occupied`` has a bit per slot, ``last`` one per entry that ends
    the run of a slot. The remainder keeps every further bit. A counter above one is kept beside its entry's bit.
    """
    n = len(counts)
    quotient = min(max(n - 1, 1).bit_length(), 63 - taken)
    rest = 64 - taken - quotient
    top = ((lanes[0] << np.uint64(taken)) >> np.uint64(64 - quotient)).astype(np.int64)
    occupied = np.zeros(1 << quotient, bool)
    occupied[top] = True
    last = np.append(top[1:] != top[:-1], True)
    more = counts > 1
    width = -(-rest // 8)
    return b"".join([
        np.array([n, quotient, more.sum()], np.int64).tobytes(), np.packbits(occupied).tobytes(), np.packbits(last).tobytes(),
        planes(lanes[0] & np.uint64((1 << rest) - 1), width),
        *[planes(x, 8) for x in lanes[1:]], np.packbits(more).tobytes(), counts[more].astype(np.int64).tobytes()])


def from_filter(data: bytes, prefix: int, taken: int, n_lanes: int) -> tuple[list[np.ndarray], np.ndarray]:
    n, quotient, n_more = np.frombuffer(data, np.int64, 3).tolist()
    rest = 64 - taken - quotient
    width = -(-rest // 8)
    at = 24

    def bits(count: int) -> np.ndarray:
        nonlocal at
        size = -(-count // 8)
        out = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count).astype(bool)
        at += size
        return out

    def numbers(size: int) -> np.ndarray:
        nonlocal at
        out = unplaned(data[at : at + n * size], n, size, np.uint64)
        at += n * size
        return out

    slots, last = np.flatnonzero(bits(1 << quotient)), bits(n)
    run = np.append(0, np.cumsum(last)[:-1])
    lead = (np.uint64(prefix) << np.uint64(64 - taken)) if taken else np.uint64(0)
    lanes = [lead | (slots[run].astype(np.uint64) << np.uint64(rest)) | numbers(width)]
    lanes += [numbers(8) for _ in range(n_lanes - 1)]
    counts = np.ones(n, np.int64)
    more = bits(n)
    counts[more] = np.frombuffer(data, np.int64, n_more, at)
    return lanes, counts


# --- one length of phrases --------------------------------------------------------------------------------------------

def windows(ids: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of ``n`` ids without a break."""
    if len(ids) < n:
        return np.empty(0, np.int64)
    whole = np.ones(len(ids) - n + 1, bool)
    for k in range(n):
        whole &= ids[k : len(ids) - n + 1 + k] != 0
    return np.flatnonzero(whole)


def counted(ids: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """(starts, keys, counts, place): the windows, their distinct keys in order, and the key of each window."""
    starts = windows(ids, n)
    lanes = permuted([ids[starts + k] for k in range(n)])
    order = np.argsort(lanes[0], kind="stable") if len(lanes) == 1 else np.lexsort(lanes[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in lanes])
    first = np.flatnonzero(new)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return starts, [x[order][first] for x in lanes], np.diff(np.append(first, len(order))), place


def narrowed(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """What longer windows can be made of: runs of two or more windows in a row, a break between them."""
    begin = np.flatnonzero(np.append(True, starts[1:] != starts[:-1] + 1)) if len(starts) else starts
    size = np.diff(np.append(begin, len(starts)))
    begin, size = begin[size > 1], size[size > 1]
    out = np.zeros(int((size + n).sum()), np.uint32)
    put = np.cumsum(size + n) - (size + n)
    inside = np.arange(int((size + n - 1).sum())) - np.repeat(np.cumsum(size + n - 1) - (size + n - 1), size + n - 1)
    out[np.repeat(put, size + n - 1) + inside] = ids[np.repeat(starts[begin], size + n - 1) + inside]
    return out


STREAM = "chunk bigint, size bigint, ids binary"


def _stream(chunk: int, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([planes(ids)], pa.binary())], ["chunk", "size", "ids"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}


def coded(cut: DataFrame, ids: DataFrame) -> DataFrame:
    """Chunks as streams of word ids; ``ids`` holds (chunk, map) with the id of each frequent word of the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            size = row["size"].as_py()
            numbers = unplaned(row["numbers"].as_py(), size)
            table = np.zeros(int(numbers.max(initial=0)) + 1, np.uint32)
            known = row["map"].values
            if known is not None:
                table[known.field("pos").to_numpy() + 1] = known.field("id").to_numpy().astype(np.uint32)
            found = table[numbers]
            yield _stream(row["chunk"].as_py(), narrowed(found, windows(found, 1), 1))

    return cut.select("chunk", "size", "numbers").join(ids, "chunk", "left").mapInArrow(run, STREAM)


def filters(streams: DataFrame, n: int, taken: int) -> DataFrame:
    """(shard, chunk, filter): each chunk's n-grams, cut by the ``taken`` leading bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, lanes, counts, _ = counted(unplaned(row["ids"].as_py(), row["size"].as_py()), n)
            shard = (lanes[0] >> np.uint64(64 - taken)).astype(np.int64) if taken else np.zeros(len(counts), np.int64)
            if not len(shard):
                continue
            first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            stop = np.append(first[1:], len(shard))
            made = [to_filter([x[i:j] for x in lanes], counts[i:j], taken) for i, j in zip(first, stop, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[first]), pa.array([row["chunk"].as_py()] * len(made), pa.int64()), pa.array(made, pa.binary())],
                ["shard", "chunk", "filter"])

    return streams.mapInArrow(run, "shard bigint, chunk bigint, filter binary")


def merged(made: DataFrame, n: int, taken: int, least: int) -> DataFrame:
    """Frequent n-grams (ids, f), and per chunk and shard (chunk, shard, bits): which of its keys are frequent."""
    n_lanes = 1 if n == 2 else 2

    def shard_rows(shard: int, held: list[tuple[int, bytes]], lanes: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        lanes = [x[counts >= least] for x in lanes]
        counts = counts[counts >= least]
        ids = np.stack(restored(lanes, n), 1).astype(np.int64)
        rows = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * n, pa.int32()), pa.array(ids.ravel()))
        none = lambda size, kind: pa.nulls(size, kind)
        size = len(counts)
        yield pa.RecordBatch.from_arrays(
            [rows, pa.array(counts), none(size, pa.int64()), none(size, pa.int64()), none(size, pa.int64()), none(size, pa.binary())],
            ["ids", "f", "chunk", "shard", "size", "bits"])
        whole = [np.ascontiguousarray(np.stack(lanes, 1)).view(f"V{8 * n_lanes}").ravel()] if n_lanes > 1 else lanes
        for chunk, data in held:
            keys, _ = from_filter(data, shard, taken, n_lanes)
            if n_lanes > 1:
                keys = [np.ascontiguousarray(np.stack(keys, 1)).view(f"V{8 * n_lanes}").ravel()]
            bits = np.packbits(np.isin(keys[0], whole[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.list_(pa.int64())), none(1, pa.int64()), pa.array([chunk]), pa.array([shard]), pa.array([len(keys[0])], pa.int64()),
                 pa.array([bits.tobytes()], pa.binary())], ["ids", "f", "chunk", "shard", "size", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, total, fresh, waiting = None, [], None, [], 0

        def settle() -> None:
            nonlocal total, fresh, waiting
            every = ([total] if total else []) + fresh
            total = summed([np.concatenate([x[0][i] for x in every]) for i in range(n_lanes)], np.concatenate([x[1] for x in every]))
            fresh, waiting = [], 0

        for row in _rows(batches):
            shard = row["shard"].as_py()
            if shard != now and held:
                settle()
                yield from shard_rows(now, held, *total)
                held, total = [], None
            now = shard
            held.append((row["chunk"].as_py(), row["filter"].as_py()))
            fresh.append(from_filter(held[-1][1], shard, taken, n_lanes))
            waiting += len(fresh[-1][1])
            if waiting > ENTRIES:
                settle()
        if held:
            settle()
            yield from shard_rows(now, held, *total)

    ordered = made.repartition("shard").sortWithinPartitions("shard", "chunk")
    return ordered.mapInArrow(run, "ids array<bigint>, f bigint, chunk bigint, shard bigint, size bigint, bits binary")


def pruned(streams: DataFrame, flags: DataFrame, n: int) -> DataFrame:
    """Streams cut down to what frequent n-grams cover, for the next length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids = unplaned(row["ids"].as_py(), row["size"].as_py())
            starts, _, counts, place = counted(ids, n)
            known = row["flags"].values
            if not len(counts):
                continue
            flag = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=size).astype(bool) for _, size, b in sorted(
                zip(*[known.field(c).to_pylist() for c in ("shard", "size", "bits")], strict=True))])
            left = narrowed(ids, starts[flag[place]], n)
            if len(left):
                yield _stream(row["chunk"].as_py(), left)

    held = flags.groupBy("chunk").agg(F.collect_list(F.struct("shard", "size", "bits")).alias("flags"))
    return streams.join(held, "chunk").mapInArrow(run, STREAM)


# --- phrases ----------------------------------------------------------------------------------------------------------

def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals): (ids, f) of every frequent word and phrase, (id, lang, word), and (lang, n)."""
    cut = written(chunks(docs, text, lang), "chunks")
    held = cut.select("chunk", F.posexplode("words").alias("pos", "w")).select("chunk", "pos", "w.*")
    totals = cut.select(F.explode("totals").alias("t")).groupBy("t.lang").agg(F.sum("t.n").alias("n"))
    common = written(held.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "words")
    words = written(ordering.with_index(common, ["lang", "word"], name="id").withColumn("id", F.col("id") + 1), "word-ids")
    highest = words.agg(F.max("id")).first()[0] or 0
    if highest >= 1 << 32:
        raise ValueError(f"{highest} frequent words; ids have 32 bits")
    maps = held.join(words, ["lang", "word"]).groupBy("chunk").agg(F.collect_list(F.struct("pos", "id")).alias("map"))
    streams = written(coded(cut, maps), "streams")
    phrases = words.select(F.array("id").alias("ids"), "f")
    for n in range(2, longest + 1):
        entries = streams.agg(F.sum("size")).first()[0] or 0
        taken = max(0, -(-entries // ENTRIES) - 1).bit_length()
        made = written(merged(filters(streams, n, taken), n, taken, least), f"phrases-{n}")
        phrases = phrases.unionByName(made.filter("f IS NOT NULL").select("ids", "f"))
        if n < longest:
            streams = written(pruned(streams, made.filter("f IS NULL"), n), "streams")
    return phrases, words, totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, inside: int = INSIDE, top: int = TOP,
                 longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` best phrases of each language."""
    phrases, words, totals = frequent_phrases(docs, text, lang, least, longest)
    long = phrases.filter(F.size("ids") > 1).withColumnRenamed("f", "a")

    # a candidate inside a longer one
    spans = [F.slice("ids", i, k) for k in range(2, longest) for i in range(1, longest - k + 2)]
    held = long.filter(F.size("ids") > 2).select("a", F.explode(F.array_distinct(F.filter(F.array(*[
        F.when(F.size("ids") > k, F.when(F.size("ids") >= i + k - 1, s)) for s, (k, i) in zip(
            spans, [(k, i) for k in range(2, longest) for i in range(1, longest - k + 2)], strict=True)]), lambda x: x.isNotNull()))).alias("ids"))
    around = held.groupBy("ids").agg(F.max("a").alias("around"))
    free = long.join(written(around, "around"), "ids", "left").filter(
        F.col("around").isNull() | (F.col("around").cast("decimal(24,0)") * 100 < F.col("a").cast("decimal(24,0)") * inside)).drop("around")

    # the worst cut
    cuts = free.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("ids", F.lit(1), F.col("k"))).withColumn("right", F.expr("slice(ids, k + 1, size(ids) - k)"))
    sides = phrases.join(words.select(F.array("id").alias("ids"), "lang"), "ids", "left")
    sides = written(sides, "sides")
    scored = (
        cuts.join(sides.select(F.col("ids").alias("left"), F.col("f").alias("l"), "lang"), "left")
        .join(sides.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
        .withColumn("score", F.expr("CAST(CAST(a AS DECIMAL(20,0)) * 2000000 AS DECIMAL(30,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
        .groupBy("ids").agg(F.max("a").alias("a"), F.max("lang").alias("lang"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("ids", "lang", "a", "cut.l", "cut.r", "cut.score"))

    # the best of a language, then their words
    best = scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).filter(F.col("place") <= top)
    best = written(best, "best")
    spelled = (
        best.select("ids", F.posexplode("ids").alias("pos", "id")).join(words.select("id", "word"), "id")
        .groupBy("ids").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda w: w["word"].cast("string")), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.join(spelled, "ids").withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
        .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
