"""License statements found by votes on diagonals.

A text is lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``: digits, letters and all that is not ASCII.

1. All rolling k-gram hashes of all texts are joined with the k-grams of the templates: k is ``SHORT`` for templates of fewer than
   ``LONG`` words, else ``LONG``. The template table is broadcast only up to ``BROADCAST`` k-grams.
2. A match at word p of a text and word q of a template votes for diagonal p - q. Votes are added per (row, template, diagonal) before
   they meet.
3. Diagonals at most ``DRIFT`` apart belong to one span: words put in or left out move the rest of a template to a neighbouring diagonal.
4. Spans go back to their texts and are verified on the words. A template of fewer than ``EXACT`` words must stand there word by word. A longer
   one needs ``VOTES`` percent of its k-grams, and ``SAME`` percent of its words in order within the span and ``DRIFT`` words around it.

The phrases of ``BASE`` are templates like the others; their verified places are the base places. Labels are those of all verified
templates; the score is the best share of a template's words found (1 for exact ones, 0 without any). Null and empty texts have no
words and no labels. Repeated rows get equal rows, rows with one id and other texts are told apart by a hash of the text. An empty table gives
an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alignlake.llm import byte_words

# Phrases and labels of the base places.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Wordings of public licenses and notices, with a label each.
TEMPLATES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
    "to the following conditions": "mit-text",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may "
    "obtain a copy of the license at": "apache-2.0-text",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3.0-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met": "bsd-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
    "the above copyright notice and this permission notice appear in all copies": "isc-text",
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
    "this file you can obtain one at": "mpl-2.0-text",
}
SHORT, LONG, EXACT = 2, 4, 8
DRIFT, VOTES, SAME = 6, 25, 80
BROADCAST = 100_000
CHUNK = 4 << 20
ROWS = 1 << 16


def word_bytes() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    return inside


def words_of(text: str | bytes) -> list[str]:
    data = byte_words.lower_table()[np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)]
    starts, ends = byte_words.runs(word_bytes()[data])
    return [data[i:j].tobytes().decode() for i, j in zip(starts, ends, strict=True)]


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the word hashes of all texts end to end, and the number of words of each."""
    lower, inside = byte_words.lower_table(), word_bytes()
    data = lower[np.frombuffer(b"\n".join(texts), np.uint8)]
    starts, ends = byte_words.runs(inside[data])
    out = np.empty(len(starts), np.uint64)
    for low in range(0, len(starts), 1 << 18):  # blocks, since a word takes some 50 bytes of work space
        part = slice(low, low + (1 << 18))
        i, j = starts[part], ends[part]
        out[part] = byte_words.hashes(data[i[0] : j[-1]], i - i[0], j - i[0])
    begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    return out, np.diff(np.append(np.searchsorted(starts, begin), len(starts)))


def rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    n = max(len(hashes) - k + 1, 0)
    value = np.full(n, k, np.uint64)
    for i in range(k):
        value = byte_words.mixed(value * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return value


def width(n_words: int) -> int:
    return SHORT if n_words < LONG else LONG


def template_grams(spark, templates: Sequence[str]) -> DataFrame:
    """(gram, template, q) of all k-grams of the templates, numbered in their order."""
    rows = []
    for number, template in enumerate(templates):
        hashes, counts = word_hashes([template.encode()])
        rows += [(int(g), number, q) for q, g in enumerate(rolled(hashes, width(int(counts[0]))).view(np.int64))]
    table = spark.createDataFrame(rows, "gram bigint, template int, q int")
    return F.broadcast(table) if len(rows) <= BROADCAST else table


def _groups(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``CHUNK`` bytes of text."""
    for batch in batches:
        ends = np.cumsum([len(x) if x is not None else 0 for x in batch.column(text).to_pylist()])
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CHUNK, "right")))
            yield batch.slice(low, high - low)
            low = high


def text_grams(docs: DataFrame) -> DataFrame:
    """(row, version, p, gram) of every k-gram of every text, for both widths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, 2):
            hashes, counts = word_hashes([t or b"" for t in batch.column(2).to_pylist()])
            owner = np.repeat(np.arange(batch.num_rows), counts)
            place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
            for k in (SHORT, LONG):
                grams = rolled(hashes, k).view(np.int64)
                whole = np.flatnonzero(owner[: len(grams)] == owner[k - 1 :]) if len(grams) else np.empty(0, np.int64)
                for low in range(0, len(whole), ROWS):
                    at = whole[low : low + ROWS]
                    take = pa.array(owner[at])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(take), batch.column(1).take(take), pa.array(place[at]), pa.array(grams[at])],
                        ["row", "version", "p", "gram"])

    return docs.mapInArrow(run, f"row {docs.schema['row'].dataType.simpleString()}, version bigint, p bigint, gram bigint")


def spans(docs: DataFrame, templates: Sequence[str]) -> DataFrame:
    """(row, version, spans): candidate spans (template, first, last) of each text that has any."""
    sizes = [len(t.split()) for t in templates]
    grams = F.array(*[F.lit(n - width(n) + 1) for n in sizes])
    size = F.array(*[F.lit(n) for n in sizes])
    # repeated rows vote once
    hits = text_grams(docs).join(template_grams(docs.sparkSession, templates), "gram").select("row", "version", "template", "p", "q").distinct()
    diagonals = hits.groupBy("row", "version", "template", (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("p").alias("first"), F.max("p").alias("last"))
    exact = F.get(size, F.col("template")) < EXACT
    diagonals = diagonals.filter(~exact | (F.col("votes") == F.get(grams, F.col("template"))))
    order = Window.partitionBy("row", "version", "template").orderBy("diagonal")
    apart = exact | (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT)
    merged = diagonals.withColumn("span", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(order)).groupBy("row", "version", "template", "span").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"), F.first("diagonal").alias("diagonal"))
    enough = merged.filter(F.col("votes") * 100 >= F.get(grams, F.col("template")) * VOTES)
    return enough.groupBy("row", "version").agg(F.collect_list(F.struct("template", "first", "last", "diagonal")).alias("spans"))


FOUND = "n_words bigint, found array<struct<template:int,first:bigint,score:double>>"


def verified(docs: DataFrame, candidates: DataFrame, templates: Sequence[str]) -> DataFrame:
    """(row, n_words, found): every row with its verified templates, the first word of each and its share of words."""
    wanted = [t.split() for t in templates]

    def check(words, span: dict) -> tuple[int, int, float] | None:
        want, n = wanted[span["template"]], len(wanted[span["template"]])
        if n < EXACT:
            first = span["diagonal"]
            return (span["template"], first, 1.0) if words(first, first + n) == want else None
        low, high = max(0, span["first"] - DRIFT), span["last"] + LONG + DRIFT
        have = words(low, high)
        blocks = [b for b in SequenceMatcher(None, want, have, autojunk=False).get_matching_blocks() if b.size]
        same = sum(b.size for b in blocks)
        return (span["template"], low + blocks[0].b, same / n) if same * 100 >= SAME * n else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, inside = byte_words.lower_table(), word_bytes()
        for batch in _groups(batches, 1):
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            data = lower[np.frombuffer(b"\n".join(texts), np.uint8)]
            starts, ends = byte_words.runs(inside[data])
            begin = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]))
            stop = np.append(begin[1:], len(starts))
            found = []
            for b, s, held in zip(begin, stop, batch.column(2), strict=True):
                def words(low: int, high: int) -> list[str]:
                    return [data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace") for i in range(b + low, min(b + high, s))]

                rows = [check(words, span) for span in held.as_py() or []]
                found.append([dict(zip(("template", "first", "score"), r, strict=True)) for r in sorted(r for r in rows if r)])
            kind = pa.list_(pa.struct([("template", pa.int32()), ("first", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stop - begin, pa.int64()), pa.array(found, kind)], ["row", "n_words", "found"])

    right = candidates.select(F.col("row").alias("row_"), F.col("version").alias("version_"), "spans")
    joined = docs.join(right, F.col("row").eqNullSafe(F.col("row_")) & F.col("version").eqNullSafe(F.col("version_")), "left").select("row", "text", "spans")
    return joined.mapInArrow(run, f"row {docs.schema['row'].dataType.simpleString()}, {FOUND}")


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", base: Mapping[str, str] = BASE,
         more: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row. Templates are words in lower case, joined by spaces."""
    phrases = [*base, *more]
    rows = docs.select(F.col(f"`{id_column}`").alias("row"), F.xxhash64(F.col(f"`{text_column}`")).alias("version"),
                       F.col(f"`{text_column}`").cast("binary").alias("text"))
    found = verified(rows, spans(rows, phrases), phrases)
    label = F.array(*[F.lit(name) for name in [*base.values(), *more.values()]])
    named = lambda items: F.array_join(F.array_sort(F.array_distinct(F.transform(items, lambda x: F.get(label, x["template"])))), ",")
    ours = F.filter("found", lambda x: x["template"] < len(base))
    return found.select(
        F.col("row").alias(id_column), "n_words", F.size(ours).cast("bigint").alias("n_base"),
        F.array_min(F.transform(ours, lambda x: x["first"])).alias("first_word"), F.array_max(F.transform(ours, lambda x: x["first"])).alias("last_word"),
        named(ours).alias("base_labels"), named(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["score"])), F.lit(0.0)).alias("score"))
