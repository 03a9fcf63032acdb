"""Nested provenance in bounded parts, recorded ends, metrics with a merged state and table functions."""

from __future__ import annotations

import datetime as dt
import random
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from alignlake.operators import provenance, user_functions
from alignlake.operators.reports import provenance_rollup
from alignlake.sources import writers

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers cannot import this file
HISTORY = "run_id bigint, stage string, seq bigint, step bigint, ts timestamp, loss double, grad_norm double, learning_rate double"
NOON = dt.datetime(2024, 5, 1, 12)


def history(n=200):
    rnd = random.Random(n)
    rows = []
    for seq in range(n):
        run = rnd.choice([1, 1, 1, 2, None])
        rows.append((run, rnd.choice(["sft", "reward"]), seq, seq // 3, NOON + dt.timedelta(seconds=seq),
                     rnd.choice([float("nan"), None, rnd.random()]), rnd.choice([None, 0.5]), 0.001))
    return rows


def plain(rows):
    return sorted(repr(tuple(r)) for r in rows)


def test_documents_have_bounded_parts_and_flatten_to_the_same_rows(spark, tmp_path):
    df = spark.createDataFrame(history(), HISTORY)
    stages = provenance_rollup(df)
    docs = provenance.documents(df, stages, points=7, rows_per_bucket=30)
    path = writers.write_documents(docs, str(tmp_path / "docs"))
    back = writers.read_documents(spark, path, docs.schema).persist()
    assert plain(provenance.history_of(back).collect()) == plain(df.collect())
    assert plain(provenance.stages_of(back).select(stages.columns).collect()) == plain(stages.collect())
    sizes = back.select("run_id", "part", "parts", F.aggregate("stages", F.lit(0), lambda n, s: n + F.size(s["metrics_history"])).alias("n")).collect()
    assert max(r.n for r in sizes) == 7
    assert {(r.run_id, r.part) for r in sizes} == {(r.run_id, p) for r in sizes for p in range(r.parts)}
    empty = provenance.documents(df.limit(0), stages.limit(0))
    assert empty.count() == 0 and provenance.history_of(empty).count() == 0


def test_only_recorded_ends_complete_a_stage_and_a_run(spark):
    df = spark.createDataFrame(history(), HISTORY)
    at = lambda s: NOON + dt.timedelta(hours=s)
    ends = spark.createDataFrame(
        [(1, "sft", at(1), 0.5, None), (1, "sft", at(3), None, "c3"), (1, "reward", at(2), None, None), (2, "sft", at(1), 0.25, "c"), (None, "sft", at(5), None, None),
         (9, "sft", at(1), 1.0, None)],
        "run_id bigint, stage string, ended_at timestamp, final_loss double, checkpoint_path string")
    stages = provenance.stage_provenance(df, ends).persist()
    got = {(r.run_id, r.stage): (r.completed, r.end_time, r.checkpoint_available) for r in stages.collect()}
    assert got == {(1, "sft"): (True, at(3), True), (1, "reward"): (True, at(2), False), (2, "sft"): (True, at(1), True), (2, "reward"): (False, None, False),
                   (None, "sft"): (True, at(5), False), (None, "reward"): (False, None, False)}
    assert {r.final_loss for r in stages.filter("run_id = 1 AND stage = 'sft'").collect()} == {0.5}
    runs = {r.run_id: (r.stages, r.stages_completed, r.completed, r.end_time) for r in provenance.run_provenance(stages).collect()}
    assert runs == {1: (2, 2, True, at(3)), 2: (2, 1, False, None), None: (2, 1, False, None)}


def test_summaries_count_unknown_success_as_failure(spark):
    rows = [(1, "a", True, 2.0, 1.0, 5), (1, "b", None, None, 3.0, None), (2, "a", True, 1.0, None, 1), (3, "b", False, 4.0, None, 0)]
    df = spark.createDataFrame(rows, "run_id long, stage string, success boolean, duration_seconds double, memory_peak_gb double, metrics_count long")
    got = {r.run_id: (r.total_stages, r.failure_count, r.total_duration_seconds, r.peak_memory_gb, r.metrics_count, r.completed_stages, r.completed)
           for r in provenance.pipeline_summary(df).collect()}
    assert got == {1: (2, 1, 2.0, 3.0, 5, ["a"], False), 2: (1, 0, 1.0, 0.0, 1, ["a"], True), 3: (1, 1, 4.0, 0.0, 0, [], False)}
    assert {r.stage: (r.runs, r.succeeded, r.success_rate, r.avg_seconds) for r in provenance.success_by_stage(df).collect()} == {
        "a": (2, 2, 1.0, 1.5), "b": (2, 0, 0.0, 4.0)}


class Extremes:
    """Lowest and highest value, and how often states were merged into one another at most."""

    def init(self):
        return (None, None, 0, 0)

    def update(self, state, rows):
        low, high, n, depth = state
        values = [v for v in rows.value.tolist() if not np.isnan(v)]
        return (min([*values, *([] if low is None else [low])], default=None), max([*values, *([] if high is None else [high])], default=None), n + len(rows), depth)

    def merge(self, state, other):
        lows, highs = [x for x in (state[0], other[0]) if x is not None], [x for x in (state[1], other[1]) if x is not None]
        return (min(lows, default=None), max(highs, default=None), state[2] + other[2], max(state[3], other[3]) + 1)

    def finish(self, state):
        return {"low": state[0], "high": state[1], "rows": state[2], "depth": state[3]}


def test_states_are_merged_in_a_tree(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 7) END AS key",
                                      "CASE WHEN id % 11 = 0 THEN NULL ELSE cast(id % 997 AS double) END AS value").repartition(23)
    got = user_functions.merged_metric(df, Extremes(), "low double, high double, rows bigint, depth bigint", ["key"], fan_in=3).collect()
    want = {r.key: (r.low, r.high, r.rows) for r in df.groupBy("key").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("rows")).collect()}
    assert {r.key: (r.low, r.high, r.rows) for r in got} == want
    assert all(r.depth <= 2 * 4 for r in got)  # three states a task at most, over ceil(log3 23) rounds
    whole = user_functions.merged_metric(df, Extremes(), "low double, high double, rows bigint, depth bigint").collect()
    assert len(whole) == 1 and whole[0].rows == 3000
    assert user_functions.merged_metric(df.limit(0), Extremes(), "low double, high double, rows bigint, depth bigint", ["key"]).collect() == []


@pytest.mark.parametrize("rows_per_bucket", [5, 1000])
def test_roc_area_equals_counting_pairs(spark, rows_per_bucket):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "b", None]), rnd.random() < 0.4, float(rnd.randrange(12))) for _ in range(300)]
    rows += [("only", True, 1.0), ("c", None, 1.0), ("a", True, None), ("a", False, float("nan"))]
    df = spark.createDataFrame(rows, "key string, label boolean, score double")
    got = {r.key: (r.positives, r.negatives, r.roc_area) for r in user_functions.roc_area(df, "label", "score", ["key"], rows_per_bucket).collect()}
    good = [r for r in rows if r[1] is not None and r[2] is not None and r[2] == r[2]]
    for key in {r[0] for r in good}:
        pos, neg = [[s for k, x, s in good if k == key and x is y] for y in (True, False)]
        area = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None
        assert got[key][:2] == (len(pos), len(neg)) and got[key][2] == (pytest.approx(area) if area is not None else None)
    assert set(got) == {r[0] for r in good}


class Words:
    def eval(self, text, times):
        for i, word in enumerate((text or "").split() * (times or 0)):
            yield i, word


def test_table_function_keeps_the_columns_of_its_row(spark):
    df = spark.createDataFrame([(1, "a b", 2), (2, None, 1), (3, "c", None), (4, "", 1), (5, "d", 1), (5, "d", 1)], "id long, text string, times int")
    rows = sorted(tuple(r) for r in user_functions.expand_rows(df, Words, "i int, word string", ["text", "times"]).select("id", "times", "i", "word").collect())
    assert rows == [(1, 2, 0, "a"), (1, 2, 1, "b"), (1, 2, 2, "a"), (1, 2, 3, "b"), (5, 1, 0, "d"), (5, 1, 0, "d")]
    kept = user_functions.expand_rows(df, Words, "i int, word string", ["text", "times"], keep_empty=True).collect()
    assert sorted((r.id, r.word or "") for r in kept) == [(1, "a"), (1, "a"), (1, "b"), (1, "b"), (2, ""), (3, ""), (4, ""), (5, "d"), (5, "d")]
