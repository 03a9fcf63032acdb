"""License scans against a plain search over words."""

from __future__ import annotations

import random
import re
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from alignlake.llm import corpus_queries, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def places(words, phrase):
    want = phrase.split()
    return [i for i in range(len(words) - len(want) + 1) if words[i : i + len(want)] == want]


def brute(text):
    """Base columns, exact short labels, and labels of long templates by sliding a window over the whole text."""
    words = WORD.findall((text or "").translate(LOWER))
    base = [(i, label) for phrase, label in license_scan.BASE.items() for i in places(words, phrase)]
    short = {label for phrase, label in license_scan.TEMPLATES.items() if len(phrase.split()) < license_scan.EXACT and places(words, phrase)}
    starts = [i for i, _ in base]
    return len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in base})), short


def long_labels(text):
    words = WORD.findall((text or "").translate(LOWER))
    out = {}
    for phrase, label in license_scan.TEMPLATES.items():
        want = phrase.split()
        if len(want) >= license_scan.EXACT:
            for i in range(0, max(1, len(words) - len(want) // 2), 5):
                same = sum(b.size for b in SequenceMatcher(None, want, words[i : i + len(want) + 12], autojunk=False).get_matching_blocks())
                if same * 100 >= license_scan.SAME * len(want):
                    out[label] = max(out.get(label, 0), same / len(want))
    return out


def noisy(rnd, phrase, share):
    return " ".join(rnd.choice(["odd", "", "x y", w]) if rnd.random() < share else w for w in phrase.split())


def sample():
    rnd = random.Random(7)
    own = [f"w{i}" for i in range(50)] + ["license", "cc", "by", "MIT", "the", "software", "é"]
    fill = lambda n: " ".join(rnd.choice(own) for _ in range(n))
    rows, number = [], 0
    for phrase in [*license_scan.BASE, *license_scan.TEMPLATES]:
        for share in (0, 0, 0.05, 0.1, 0.6):
            number += 1
            rows.append((number, f"{fill(rnd.randint(0, 60))}. {noisy(rnd, phrase, share).title()}; {fill(rnd.randint(0, 60))}"))
    everything = ", ".join([*license_scan.BASE, *license_scan.TEMPLATES])
    return rows + [(901, None), (902, ""), (903, " \n\t!"), (904, "CC-BY cc by;CC BY"), (904, "MIT-License"), (None, "Apache\nLicense"), (None, None),
                   (905, "mit"), (906, "İMIT license mit\x7flicense"), (907, everything), (907, everything), (908, f"{fill(40_000)} mit license {fill(3000)}")]


def test_rows_equal_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"labels": F.lit("mine"), "row": F.lit(1), "version": F.lit(2)}).repartition(3)
    got = license_scan.scan(df)
    assert got.columns == COLUMNS
    key = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    found = sorted((tuple(r)[:6] for r in got.collect()), key=key)
    assert found == sorted(((i, *brute(t)[:5]) for i, t in rows), key=key)
    texts = {(i, brute(t)[0], brute(t)[4]): t for i, t in rows}
    for r in got.collect():
        text = texts[(r.doc_id, r.n_words, r.base_labels)]
        labels = set(filter(None, r.labels.split(",")))
        exact = set(filter(None, r.base_labels.split(","))) | brute(text)[5]
        assert exact <= labels
        far = long_labels(text)
        assert labels - exact <= set(far)
        # a window that starts at every fifth word may see a few words less or more than the span
        assert {label for label, share in far.items() if share >= 0.84} <= labels
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def test_templates_in_other_words_are_found_and_weak_ones_are_not(spark):
    phrase = next(p for p, label in license_scan.TEMPLATES.items() if label == "mit-text")
    words = phrase.split()
    inserted = " ".join(w if i % 9 else f"{w} also" for i, w in enumerate(words))
    changed = " ".join("other" if i % 8 == 3 else w for i, w in enumerate(words))
    half = " ".join(words[: len(words) // 2])
    rows = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame([(1, inserted), (2, changed), (3, half)], "doc_id long, text string")).collect()}
    assert rows[1].labels == rows[2].labels == "mit-text" and rows[1].score == 1.0 and 0.8 <= rows[2].score < 1
    assert rows[3].labels == "" and rows[3].score == 0.0


def test_empty_tables(spark):
    got = license_scan.scan(spark.createDataFrame([], "doc_id long, text string"))
    assert got.columns == COLUMNS and got.collect() == []


def test_hashes_do_not_depend_on_blocks():
    texts = [("word%d " % i * (i % 7) + "x" * i).encode() for i in range(300)]
    hashes, counts = license_scan.word_hashes(texts)
    alone = [license_scan.word_hashes([t]) for t in texts]
    assert (np.concatenate([h for h, _ in alone]) == hashes).all() and [int(c[0]) for _, c in alone] == counts.tolist()


def test_query_covers_every_document(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = corpus_queries.QUERIES["op12_license_diagonals"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        n, places_, first, last, base, short = brute(docs[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, places_, first, last, base)
        assert set(r.labels.split(",")) - {""} == set(filter(None, base.split(","))) | short | set(long_labels(docs[r.doc_id]) if "permi" in (docs[r.doc_id] or "") else ())
