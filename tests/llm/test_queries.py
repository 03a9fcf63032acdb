"""The registered queries against their SQL, and every stage of the pipeline against brute force on its own input."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from alignlake.llm import line_dedup, queries
from alignlake.registry.check import difference

from .test_words_and_lines import brute_contaminated, brute_groups, brute_lines


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), sf_dir, queries.ORACLES[name]) is None


def test_thirteen_operators_and_the_pipeline_are_registered():
    import __spark_entry__

    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def test_stages_do_their_whole_job(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").persist()
    columns = docs.columns
    rows = {}

    def step(k, frame):
        out = corpus_pipeline.STAGES[k][1](spark, frame, sf_dir).persist()
        assert out.columns[: len(columns)] == columns
        rows[k] = {r.doc_id: r for r in out.collect()}
        return out

    before = {r.doc_id: r for r in docs.collect()}
    told = step(0, docs)
    assert len(rows[0]) >= 0.97 * sum(len(r.text.split()) > 5 for r in before.values())
    assert all(r == before[i] for i, r in rows[0].items())

    cut = step(1, told)
    want = {i: t for i, t in brute_lines([(i, r.text) for i, r in rows[0].items()], 2, alone=line_dedup.ALONE)}
    assert {i: r.text for i, r in rows[1].items()} == {i: t for i, t in want.items() if t == rows[0][i].text or re.search(r"\S", t)}
    assert all(r.n_chars == (len(r.text) if r.text != rows[0][i].text else rows[0][i].n_chars) for i, r in rows[1].items())

    single = step(2, cut)
    groups = brute_groups([(i, r.text) for i, r in rows[1].items()], 5)
    assert rows[2] == {i: rows[1][i] for i in rows[1] if groups[i] == i}

    clean = step(3, single)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert rows[3] == {i: r for i, r in rows[2].items() if not brute_contaminated(r.text, items)}

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.MODEL)
    step(4, clean)
    assert {i: r.piece_ids for i, r in rows[4].items()} == {i: library.encode(r.text) for i, r in rows[3].items()}
    assert all(r.text == rows[3][i].text for i, r in rows[4].items())


def test_stages_take_empty_tables_nulls_and_repeated_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = "The people of the town and the house on the hill are in this place for a long time"
    odd = spark.createDataFrame(
        [(-1, text, "en", "s", 1), (-1, text, "en", "s", 1), (-2, None, None, None, None), (None, text + " again", None, None, 2), (-3, "", "en", "s", 0)], docs.schema)
    for frame, kept in ((docs.limit(0), {}), (docs.filter("length(text) < 3000").limit(120).unionByName(odd), {-1: 2, None: 1, -2: 0, -3: 0})):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, sf_dir).persist()
        ids = [r.doc_id for r in frame.collect()]
        assert frame.columns == [*docs.columns, "piece_ids"]
        assert all(ids.count(i) == n for i, n in kept.items())
