"""Phrase mining against plain counting, and the filters against what was put in."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from alignlake.llm import collocations

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top, inside=80):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    chosen = {g: n for g, n in counts.items() if len(g) > 2 and n >= least}
    kept = {}
    for g, a in chosen.items():
        subs = lambda q: {(q[0], *q[i : i + len(g) - 1]) for i in range(1, len(q) - len(g) + 2)}
        if any(len(q) > len(g) and 100 * b >= inside * a and g in subs(q) for q, b in chosen.items()):
            continue
        cuts = [(2000000 * a // (counts[g[: k + 1]] + counts[(g[0], *g[k + 1 :])]), k, counts[g[: k + 1]], counts[(g[0], *g[k + 1 :])]) for k in range(1, len(g) - 1)]
        score, _, left, right = min(cuts)
        kept.setdefault(g[0], []).append((-score, -a, " ".join(g[1:]).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, totals[lang], -score)
                  for lang, found in kept.items() for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def texts(seed, n=60):
    rnd = random.Random(seed)
    words = ["a", "B", "cc", "é", "dé", "x" * 40, "y" * 17, "y" * 16, "z\x01", "😀", "the", "The"]
    joins = [" ", " ", " ", "  \t", ". ", ",", "\n", "!", "\x0b"]
    rows = [(rnd.choice(["en", "fr", None, "und"]), "".join(rnd.choice(words[: rnd.randint(2, 12)]) + rnd.choice(joins) for _ in range(rnd.randint(0, 80)))) for _ in range(n)]
    return rows + [("en", None), ("fr", ""), ("en", " \t\n"), ("de", "alone"), ("en", "once upon a time " * 40), (None, None), ("fr", "!!!")]


@pytest.mark.parametrize("seed, chunk, entries", [(1, 4 << 20, 2_000_000), (2, 400, 100), (3, 50, 7)])
def test_phrases_equal_brute_force(spark, monkeypatch, seed, chunk, entries):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "ENTRIES", entries)
    rows = texts(seed)
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({"n": F.lit("mine"), "ids": F.lit(1), "phrase": F.lit(0)}).repartition(3)
    got = collocations.collocations(df, least=5, top=25)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 25)


def test_empty_tables_and_texts_without_frequent_words(spark):
    for rows in ([], [("en", None)], [("en", "a b c d")]):
        assert collocations.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_texts_are_cut_between_pieces_only():
    text = b"one two. three four,five " * 20 + b"x" * 100 + b". y"
    for size in (1, 10, 30, 10_000):
        cut = list(collocations.parts(text, size))
        assert b"".join(cut) == text
        assert all(p[:1] in b".,;:!?\n" for p in cut[1:])


@pytest.mark.parametrize("n, taken", [(2, 0), (2, 5), (3, 3), (4, 7)])
def test_filters_give_back_every_key_and_counter(n, taken):
    rnd = np.random.default_rng(n + taken)
    ids = [rnd.integers(1, 2**32, 5000, dtype=np.uint64) for _ in range(n)]
    ids = [np.append(i, i[:900]) for i in ids]
    assert all((a == b).all() for a, b in zip(collocations.restored(collocations.permuted(ids), n), ids, strict=True))
    lanes, counts = collocations.summed(collocations.permuted(ids), np.ones(len(ids[0]), np.int64))
    assert counts.sum() == 5900 and len(counts) == 5000
    shard = lanes[0] >> np.uint64(64 - taken) if taken else np.zeros(len(counts), np.uint64)
    for s in np.unique(shard):
        part = shard == s
        data = collocations.to_filter([x[part] for x in lanes], counts[part], taken)
        back, again = collocations.from_filter(data, int(s), taken, len(lanes))
        assert all((a == b[part]).all() for a, b in zip(back, lanes, strict=True)) and (again == counts[part]).all()
