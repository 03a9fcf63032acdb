"""Token ids in flat unsigned files with 64-bit document offsets.

``write_tokens`` lays the documents out in ascending id order, range by range. Each range is one pair of
files in the shared folder:

* ``<name>.ids``: the ids of its documents, end to end, little-endian, 2 bytes each where the vocabulary
  has at most 65,536 ids and 4 bytes otherwise;
* ``<name>.idx``: n + 1 little-endian unsigned 64-bit offsets into the ids, then n signed 64-bit
  document ids.

A manifest table names the files of each range that a finished task left, with the number of its
documents and ids. The base of a range is the prefix sum over the manifest (one small row per range), so
global positions need no pass over the ids. A task that is run again writes files of its own; only those
in the manifest are read. Files of a local or mounted folder are memory-mapped, others are read through
their file system.

Null and empty texts are documents that hold the end id alone. Rows with equal ids are neighbours, ordered
by a hash of their text, so that one id's rows may fill several ranges. Documents without an id stand first; the manifest counts them. Other columns of the input are ignored; an empty table gives an
empty manifest.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignlake.session import work_path, written

WORD_CACHE = 500_000
MANIFEST = "part int, ids_file string, index_file string, documents bigint, unnamed bigint, ids bigint, first_id bigint"
CHUNK = 1000  # documents encoded at once


# The steps of a tokenizer before its BPE model for which ``_plain`` knows the outcome.
PLAIN_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def byte_letters() -> list[str]:
    """The printable character that byte-level models write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class TextIds:
    """Ids of whole texts, equal to the library's ``encode`` of each without special tokens.

    The tokenizer splits at white space before anything else (probed when it is loaded), so a text's ids are those of its words.
    The distinct words of a batch are encoded once each and kept for the next batches of the task, end to end in one array.
    Words of Latin letters, with or without punctuation behind them, go straight to the library's BPE model, since
    what its earlier steps make of them is known; all others go through the library whole. A tokenizer that
    does not split at white space is applied to whole texts.
    """

    def __init__(self, definition: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        steps = json.loads(self.tokenizer.to_str())
        self.letters = byte_letters() if all(steps[k] == v for k, v in PLAIN_STEPS.items()) else None
        probe = ["ab", "'s", "--", "9", "é", *[str(getattr(p, "content", p)) for p in self.tokenizer.get_added_tokens_decoder().values()]]
        self.by_word = all(
            self._whole([f"{a}{s}{b}"])[0] == self._whole([a])[0] + self._whole([b])[0] for a in probe for b in probe for s in (" ", "\n", " \t"))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.parts: dict[str, list[int]] = {}
        self.flat, self.begin, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for i in range(0, len(texts), 5000)
                for e in self.tokenizer.encode_batch_fast(texts[i : i + 5000], add_special_tokens=False)]

    def _plain(self, word: str) -> list[int] | None:
        """Ids of letters below U+0250 with ASCII punctuation behind them; None for other words."""
        stem = word.rstrip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        lower = stem.lower()
        if not (lower.isalpha() and stem.isalpha()) or max(stem) >= "\u0250":
            return None
        tail = word[len(stem):]
        ids = self.parts.get(lower) or self._part(lower)
        return ids + (self.parts.get(tail) or self._part(tail)) if tail else ids

    def _part(self, part: str) -> list[int]:
        written_out = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
        ids = self.parts[part] = [t.id for t in self.tokenizer.model.tokenize(written_out)]
        return ids

    def _learn(self, words: list[str]) -> None:
        found = [self._plain(w) if self.letters and w else None for w in words]
        rest = [i for i, f in enumerate(found) if f is None]
        for i, ids in zip(rest, self._whole([words[i] for i in rest]), strict=True):
            found[i] = ids
        sizes = np.array([len(f) for f in found], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, sizes])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each; null texts have none."""
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        if not self.by_word:
            found = self._whole(texts.to_pylist())
            return np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(f) for f in found], np.int64)
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > WORD_CACHE:
            self._forget()
        new = [w for w in distinct if w not in self.known]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.begin[at] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        borders = words.offsets.to_numpy() - words.offsets[0].as_py()
        return ids, np.diff(np.append(0, ends)[borders])


def _opened(path: str):
    """The file system and the path inside it, for a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (fs.LocalFileSystem(), path)


def write_tokens(docs: DataFrame, tokenizer_file: str, end_id: int, id_column: str = "doc_id", text_column: str = "text",
                 folder: str | None = None) -> DataFrame:
    """Writes the files and returns the manifest. The tokenizer's file is read on the driver and sent to the tasks."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    folder = folder or work_path(spark, "tokens")
    files, inside = _opened(folder)
    files.create_dir(inside, recursive=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
        .withColumn("order", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "order").sortWithinPartitions("doc_id", "order").drop("order"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        encoder = TextIds(definition)
        kind = np.dtype("<u2" if max(encoder.vocabulary - 1, end_id) < 1 << 16 else "<u4")
        target, base = _opened(folder)
        offsets, names, total, unnamed = [np.zeros(1, np.uint64)], [], 0, 0
        with target.open_output_stream(f"{base}/{name}.ids") as out:
            for batch in batches:
                unnamed += batch.column(0).null_count
                names.append(batch.column(0).fill_null(0).to_numpy().astype("<i8"))
                for i in range(0, batch.num_rows, CHUNK):
                    ids, sizes = encoder.encode(batch.column(1).slice(i, CHUNK))
                    ends = np.cumsum(sizes)
                    out.write(np.insert(ids, ends, end_id).astype(kind).tobytes())
                    ends += total + np.arange(1, len(ends) + 1)
                    offsets.append(ends.astype(np.uint64))
                    total = int(ends[-1])
        if not names:
            target.delete_file(f"{base}/{name}.ids")
            return
        doc_ids = np.concatenate(names)
        with target.open_output_stream(f"{base}/{name}.idx") as out:
            out.write(np.concatenate(offsets).astype("<u8").tobytes())
            out.write(doc_ids.tobytes())
        yield pa.RecordBatch.from_pylist([{
            "part": part, "ids_file": f"{folder}/{name}.ids", "index_file": f"{folder}/{name}.idx", "documents": len(doc_ids),
            "unnamed": unnamed, "ids": total, "first_id": int(doc_ids[unnamed]) if unnamed < len(doc_ids) else None}], schema=pa.schema(
                [("part", pa.int32()), ("ids_file", pa.string()), ("index_file", pa.string()), ("documents", pa.int64()),
                 ("unnamed", pa.int64()), ("ids", pa.int64()), ("first_id", pa.int64())]))

    return written(ordered.mapInArrow(run, MANIFEST), "manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids before each range. One row per range reaches the driver."""
    rows = sorted(manifest.collect(), key=lambda r: r.part)
    bases = np.cumsum([0, *[r.ids for r in rows]])
    located = [(*r, int(b)) for r, b in zip(rows, bases, strict=False)]
    frame = manifest.sparkSession.createDataFrame(located, MANIFEST + ", base bigint")
    return frame.repartition(max(1, len(located))) if located else frame


def mapped(path: str, kind: str) -> np.ndarray:
    """Array over a whole file: memory-mapped where the folder is mounted, read otherwise."""
    from pyarrow import fs

    files, inside = _opened(path)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(inside, kind, "r")
    with files.open_input_file(inside) as stream:
        return np.frombuffer(stream.read(), kind)


def read_tokens(manifest: DataFrame, use: Callable[[np.ndarray], dict], fields: str) -> DataFrame:
    """(doc_id, start, n_tokens, ...) from the files; ``use`` makes the other ``fields`` from a document's ids."""
    schema = f"doc_id bigint, start bigint, n_tokens bigint, {fields}"
    extra = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["documents"]
                index = mapped(row["index_file"], "<u8")
                offsets, doc_ids = index[: n + 1].astype(np.int64), index[n + 1 :].view("<i8")
                width = "<u2" if _size(row["ids_file"]) == 2 * row["ids"] else "<u4"
                ids = mapped(row["ids_file"], width)
                for i in range(0, n, 4096):
                    made = [use(ids[offsets[k] : offsets[k + 1]]) for k in range(i, min(n, i + 4096))]
                    named = pa.array(doc_ids[i : i + 4096], mask=np.arange(i, i + len(made)) < row["unnamed"])
                    yield pa.RecordBatch.from_arrays(
                        [named, pa.array(offsets[i : i + len(made)] + row["base"]),
                         pa.array(np.diff(offsets[i : i + len(made) + 1])), *[pa.array([m[c] for m in made]) for c in extra]],
                        ["doc_id", "start", "n_tokens", *extra])

    return with_bases(manifest).mapInArrow(run, schema)


def _size(path: str) -> int:
    files, inside = _opened(path)
    return files.get_file_info(inside).size


def ids_crc32(ids: np.ndarray) -> dict:
    import zlib

    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
