"""Streams that remember rows: any order of arrival, hot series in slices, a buffer over micro-batches, counters and quarantine."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from alignlake.plans import jobs as plans
from alignlake.sources import readers
from alignlake.streaming import stateful

POINTS = "run_id bigint, stage string, seq bigint, loss double"


def plain_monitor(rows, window=10, factor=2.0):
    out, series = [], {}
    for run, stage, seq, loss in sorted(rows, key=lambda r: r[2]):
        seen = series.setdefault((run, stage), {"all": [], "best": math.inf, "counter": 0})
        better = loss < seen["best"]
        seen["all"].append(loss)
        seen["best"] = loss if better else seen["best"]
        seen["counter"] = 0 if better else seen["counter"] + 1
        last = seen["all"][-window:]
        mean = sum(last) / len(last)
        odd = math.isnan(loss) or math.isinf(loss)
        out.append((run, stage, seq, len(last) == window and (odd or loss > mean * factor), seen["best"], seen["counter"]))
    return sorted(out, key=repr)


def points(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        run = rnd.choice([1, 1, 1, 2, None])
        loss = rnd.choice([rnd.random(), rnd.random() * 5, 30.0, 0.5, 0.5])
        rows.append((run, rnd.choice(["sft", None]) if run == 2 else "sft", seq, math.nan if rnd.random() < 0.03 else math.inf if rnd.random() < 0.02 else loss))
    return rows


def judged(df):
    return sorted(((r.run_id, r.stage, r.seq, r.diverged, r.best, r.patience_counter) for r in df.collect()), key=repr)


@pytest.mark.parametrize("cuts", [[], [1, 2, 3], [100, 104, 250]])
def test_slices_of_a_series_merge_in_order(spark, cuts):
    rows = points(len(cuts))
    schema = "run_id bigint, stage string, " + stateful.CARRY
    carry, found = spark.createDataFrame([], schema), []
    for low, high in zip([0, *cuts], [*cuts, len(rows)]):
        part = spark.createDataFrame(rows[low:high], POINTS)
        out, carry = stateful.followed(part, carry, ["run_id", "stage"], rows_per_bucket=17)
        carry = spark.createDataFrame(carry.collect(), schema)
        found += judged(out)
    assert sorted(found, key=repr) == plain_monitor(rows)


def stream_of(spark, tmp_path, parts, schema):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return readers.stream_table(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)


def test_monitor_takes_rows_in_any_order_and_sets_late_ones_aside(spark, tmp_path):
    rows = points(7, 120)
    mixed = sorted(rows, key=lambda r: r[2] // 10 % 3)
    parts = [mixed[:50], mixed[50:90], mixed[90:]]
    found, late = stateful.monitor_any_order(stream_of(spark, tmp_path, parts, POINTS), late_by=1000, rows_per_bucket=20, root=str(tmp_path / "a"))
    assert judged(found) == plain_monitor(rows) and late.count() == 0

    other = tmp_path / "strict"
    other.mkdir()
    found, late = stateful.monitor_any_order(stream_of(spark, other, parts, POINTS), late_by=20, rows_per_bucket=20, root=str(tmp_path / "b"))
    mark, missed = -math.inf, set()
    for part in parts:
        missed |= {r[2] for r in part if r[2] <= mark}
        mark = max(mark, max(r[2] for r in part) - 20)
    assert missed and {r.seq for r in late.collect()} == missed
    assert judged(found) == plain_monitor([r for r in rows if r[2] not in missed])


def test_buffer_mixes_files_and_every_row_leaves_once(spark, tmp_path):
    parts = [[(i,) for i in range(k * 100, k * 100 + 100)] for k in range(4)]
    out = stateful.shuffle_buffer(stream_of(spark, tmp_path, parts, "id long"), "id", 60, root=str(tmp_path / "s"), rows_per_bucket=30)
    rows = sorted(out.collect(), key=lambda r: (r.micro_batch, r.position))
    assert sorted(r.id for r in rows) == list(range(400))
    by_batch = {b: [r.id for r in rows if r.micro_batch == b] for b in range(5)}
    assert [len(by_batch[b]) for b in range(5)] == [40, 100, 100, 100, 60]
    assert all(len({i // 100 for i in by_batch[b]}) > 1 for b in range(1, 4))
    assert [r.id for r in rows] != sorted(r.id for r in rows)


def test_counters_equal_the_batch_report_after_every_micro_batch(spark, tmp_path):
    parts = [[(i, i % 3) for i in range(k * 10, k * 10 + 10)] for k in range(3)]
    stream = stream_of(spark, tmp_path, parts, "id long, kind int")
    rows, counters = stateful.observed_batches(stream, {"rows": F.count("*"), "odd": F.count_if(F.col("kind") == 1)}, build=lambda b: b.filter("kind = 1"),
                                               root=str(tmp_path / "o"))
    totals = sorted(tuple(r) for r in stateful.running_totals(counters, ["rows", "odd"]).collect())
    assert totals == [(b, 10 * b + 10, sum(i % 3 == 1 for i in range(10 * b + 10))) for b in range(3)]
    assert sorted(r.id for r in rows.collect()) == [i for i in range(30) if i % 3 == 1]
    sample = stateful.stream_sample(stream_of(spark, tmp_path / "again", parts, "id long, kind int"), "id", 7, root=str(tmp_path / "p"))
    assert sorted(r.id for r in sample.collect()) == sorted(
        r.id for r in stateful.sampling.seeded_sample(spark.range(30), "id", 7).collect())


def test_preparation_quarantines_rows_and_whole_batches(spark, tmp_path):
    good = [(i, f"What is question {i} about", f"It is the answer {i} of all", f"No answer {i} is known here") for i in range(30)]
    some_bad = [(100 + i, "Tell me about it please", "A good answer to this", "" if i == 3 else "A worse answer to this") for i in range(30)]
    all_bad = [(200 + i, "", "x", "y") for i in range(5)]
    schema = "id long, prompt string, chosen string, rejected string"
    vocab = plans.vocabulary_of(spark.createDataFrame(good, schema), "preference", 100)
    stream = stream_of(spark, tmp_path, [good, some_bad, all_bad], schema)
    rows, quarantine, gates = stateful.prepare_stream(stream, "preference", 64, vocab, root=str(tmp_path / "q"))
    want = plans.prepare_table(spark.createDataFrame(good + some_bad, schema), "preference", "id", 64, vocab)
    key = lambda r: r.id
    assert sorted(rows.select(want.columns).collect(), key=key) == sorted(want.collect(), key=key)
    assert sorted((r.micro_batch, r.reason) for r in quarantine.collect()) == [(1, "missing_fields"), *[(2, "failed_batch")] * 5]
    assert sorted((r.micro_batch, r.passed, r.total) for r in gates.collect()) == [(0, True, 30), (1, True, 30), (2, False, 5)]


def test_preparation_deals_a_micro_batch_of_one_file_to_all_cores(spark, tmp_path):
    schema = "id long, prompt string, chosen string, rejected string"
    good = [(i, f"What is question {i} about", f"It is the answer {i} of all", f"No answer {i} is known here") for i in range(100)]
    vocab = plans.vocabulary_of(spark.createDataFrame(good, schema), "preference", 100)
    path = str(tmp_path / "coarse")
    spark.createDataFrame(good, schema).coalesce(1).write.parquet(path)
    rows, _, _ = stateful.prepare_stream(readers.stream_table(spark, path, schema), "preference", 64, vocab, root=str(tmp_path / "q"))
    assert sorted(r.id for r in rows.select("id").collect()) == list(range(100))
    assert rows.select(F.input_file_name()).distinct().count() == spark.sparkContext.defaultParallelism
