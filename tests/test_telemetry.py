"""Metric series against pandas and plain-Python loops, with one run holding most rows."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from alignlake.operators import ordering, reports, telemetry
from alignlake.registry import series as registered
from alignlake.registry.check import difference

NAN, INF = float("nan"), float("inf")


def frame(spark, series, column="loss", stage="sft"):
    rows = [(run, stage, i * 3, None if v is None else float(v)) for run, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"run_id bigint, stage string, seq bigint, {column} double")


def by_run(df, *fields):
    return {r.run_id: tuple(r[f] for f in fields) if len(fields) > 1 else r[fields[0]] for r in df.collect()}


@pytest.fixture(scope="module")
def noisy():
    rng = random.Random(3)
    flat = [rng.random() * 100 for _ in range(150)] + [1 + rng.random() / 1000 for _ in range(150)]
    return {1: [rng.random() * 10 for _ in range(900)], 2: flat, 3: [5.0] * 8, 4: [None, NAN, 3.0, 4.0]}


@pytest.mark.parametrize("rows_per_bucket", [10**6, 70])
def test_rolling_and_stability(spark, noisy, rows_per_bucket):
    df = frame(spark, noisy)
    rolled = telemetry.rolling_stats(df, window=20, rows_per_bucket=rows_per_bucket).toPandas().sort_values("seq")
    assert set(rolled.run_id) == {1, 2}
    for run in (1, 2):
        want = pd.Series(noisy[run]).rolling(20)
        got = rolled[rolled.run_id == run]
        pd.testing.assert_series_equal(got.rolling_mean.reset_index(drop=True), want.mean(), check_names=False)
        exact = want.apply(lambda w: np.std(w, ddof=1), raw=True)  # pandas' own rolling std drifts
        pd.testing.assert_series_equal(got.rolling_std.reset_index(drop=True), exact, check_names=False)


def converged(values, w):
    std = pd.Series(values).rolling(w).std()
    limit = std.mean() * 0.1
    return next((i for i in range(w, len(std) - w) if all(std.iloc[i:i + w] < limit)), None)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 64])
def test_convergence(spark, noisy, rows_per_bucket):
    got = by_run(telemetry.convergence_point(frame(spark, noisy), window=20, rows_per_bucket=rows_per_bucket),
                 "convergence_index", "convergence_seq")
    for run in (1, 2):
        want = converged(noisy[run], 20)
        assert got[run] == (want, None if want is None else want * 3)
    assert got[2][0] is not None


def test_divergence_guards(spark):
    base = [1.0] * 9
    series = {1: base, 2: [*base, 9.0], 3: [*base, NAN], 4: [*base, INF], 5: [1.0] * 4 + [NAN] + [1.0] * 4 + [50.0],
              6: [*base, 1.0, 30.0], 7: [1.0] * 4 + [NAN]}
    df = telemetry.loss_divergence(frame(spark, series), rows_per_bucket=4)
    flagged = {run: 0 for run in series}
    for r in df.filter("diverged").collect():
        flagged[r.run_id] += 1
    assert flagged == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0, 6: 1, 7: 0}


def test_stepwise(spark):
    df = frame(spark, {1: [1.0, 10.0, 101.0, NAN, 5.0, INF]})
    df = df.selectExpr("*", "CAST(0.5 AS DOUBLE) AS learning_rate")
    got = telemetry.stepwise_divergence(df, rows_per_bucket=2).orderBy("seq").collect()
    assert [r.jumped for r in got] == [False, False, True, False, False, True]
    assert [r.not_finite for r in got] == [False, False, False, True, False, True]
    assert got[2].suggested_lr == 0.25 and got[1].suggested_lr is None


def follow(values):
    best, patience, out = INF, 0, []
    for v in values:
        if v < best:
            best, patience = v, 0
        else:
            patience += 1
        out.append((best, patience))
    return out


@pytest.mark.parametrize("rows_per_bucket", [10**6, 31])
def test_running_best(spark, noisy, rows_per_bucket):
    series = {1: noisy[1], 2: [3.0, NAN, 2.0, 2.0, INF, 1.0], 3: [NAN, NAN, 1.0]}
    got = telemetry.running_best(frame(spark, series), rows_per_bucket=rows_per_bucket).orderBy("run_id", "seq").collect()
    want = [pair for run in (1, 2, 3) for pair in follow(series[run])]
    assert [(r.best, r.patience_counter) for r in got] == want
    upward = telemetry.running_best(frame(spark, {1: [1.0, 3.0, 2.0]}), higher_is_better=True).orderBy("seq").collect()
    assert [(r.best, r.patience_counter) for r in upward] == [(1.0, 0), (3.0, 0), (3.0, 1)]


def stop(values, delta, patience, start):
    best, counter = start, 0
    for i, v in enumerate(values):
        if v > best + delta:
            best, counter = v, 0
        else:
            counter += 1
        if counter >= patience:
            return best, counter, i
    return best, counter, None


@pytest.mark.parametrize("delta, patience, start", [(0.001, 3, 0.0), (0.05, 5, -INF), (0.5, 2, 0.0)])
@pytest.mark.parametrize("rows_per_bucket", [10**6, 50])
def test_early_stopping(spark, delta, patience, start, rows_per_bucket):
    rng = random.Random(11)
    series = {
        1: [1.0, 1.0005, 1.001, 1.0015, 1.002], 2: [i / 100 for i in range(400)], 3: [rng.random() for _ in range(300)],
        4: [NAN, NAN, 0.5, INF, 1.0, 2.0, NAN, NAN, 1.0], 5: [0.2], 6: [i * delta * 1.01 for i in range(200)] + [0.0] * 20,
        7: [-5.0, -4.0, -3.0],
    }
    got = by_run(telemetry.early_stopping(frame(spark, series, "score"), "score", min_delta=delta, patience=patience,
                                          start=start, rows_per_bucket=rows_per_bucket),
                 "best", "patience_counter", "stop_index")
    for run, values in series.items():
        assert got[run] == stop(values, delta, patience, start), run


def test_early_stopping_gathers_no_series(spark):
    rng = random.Random(12)
    noise = [rng.random() for _ in range(3000)]
    series = {
        1: [*noise[:2999], 1e12], 2: [1e12, *noise], 3: [i / 7 for i in range(3000)], 4: [i / 1e5 for i in range(3000)],
        5: [NAN] * 300, 6: [-INF, INF, *noise[:100]], 7: [i + rng.random() * 30 for i in range(3000)], 8: [*noise[:120], 1e12, *noise[:120]],
    }
    df = frame(spark, series, "score")
    for delta, patience, start in ((0.01, 7, 0.0), (0.01, 400, -INF), (2.0, 3, -INF), (0.001, 130, 0.0)):
        got = by_run(telemetry.early_stopping(df, "score", min_delta=delta, patience=patience, start=start, rows_per_bucket=100),
                     "best", "patience_counter", "stop_index")
        assert got == {run: stop(values, delta, patience, start) for run, values in series.items()}
    indexed = telemetry._series(df, "score", telemetry.RUN_STAGE, "seq", keep_nan=True, rows_per_bucket=100)
    ways = telemetry.stopping_ways(indexed, telemetry.RUN_STAGE, 0.01, 7, 0.0, 100).selectExpr("run_id", "size(_ways) AS k").collect()
    per_run = {run: sum(r.k for r in ways if r.run_id == run) for run in series}
    assert max(r.k for r in ways) <= 7 and per_run[1] <= 20 and per_run[3] <= 30 * 7


def test_early_stopping_needs_a_delta(spark):
    with pytest.raises(ValueError):
        telemetry.early_stopping(frame(spark, {1: [1.0]}), "loss", min_delta=0)


def test_schedule_gradients_and_slope(spark):
    lr = telemetry.learning_rate_schedule(frame(spark, {1: [1.0, 1.0, 0.5, 0.25], 2: [1.0]}, "learning_rate"), rows_per_bucket=2)
    assert by_run(lr, "initial_lr", "final_lr", "lr_changes", "lr_decay_ratio") == {1: (1.0, 0.25, 2, 0.25)}
    grads = telemetry.gradient_stability(frame(spark, {1: [1.0] * 20 + [11.0, 1e-7, 2.0]}, "grad_norm"), window=20)
    assert by_run(grads, "final_grad_norm", "exploding_gradients", "vanishing_gradients") == {1: (2.0, 1, 1)}
    slopes = by_run(telemetry.trend_slope(frame(spark, {1: [0.0, 2.0, 4.0], 2: [7.0]})), "trend_slope")
    assert slopes[1] == pytest.approx(2.0) and slopes[2] == 0.0


def test_metric_names(spark):
    df = spark.createDataFrame([("sft", "loss"), ("sft", "sft/loss"), ("sft", "sftx/loss")], "stage string, metric string")
    assert [r.metric_key for r in telemetry.prefixed_metrics(df).collect()] == ["sft/loss", "sft/loss", "sft/sftx/loss"]
    assert [r.metric for r in telemetry.plain_metrics(df).collect()] == ["loss", "loss", "sftx/loss"]
    results = spark.createDataFrame([("s", "a", "1.5"), ("s", "b", "x")], "stage string, key string, value string")
    assert [(r.metric_key, r.number) for r in telemetry.numeric_results(results).collect()] == [("s/eval_a", 1.5)]


def test_progress(spark):
    df = spark.createDataFrame([("a", 1, 10, 40, 5.0), ("a", 2, 20, 40, 9.0), ("b", 1, 0, 40, 1.0), ("c", 1, 3, None, 6.0)],
                               "operation string, seq int, current_step int, total_steps int, elapsed_seconds double")
    got = {r.operation: (r.percent, r.seconds_per_step, r.eta_seconds) for r in telemetry.progress(df).collect()}
    assert got == {"a": (50.0, 0.45, pytest.approx(9.0)), "b": (0.0, None, None), "c": (None, 2.0, None)}


def test_config_difference_and_fingerprints(spark):
    rows = [(1, "lr", "0.1"), (2, "lr", "0.2"), (1, "batch", "4"), (2, "batch", "4"), (1, "warmup", "9")]
    df = spark.createDataFrame(rows, "run_id int, k string, v string")
    assert sorted(tuple(r) for r in reports.config_difference(df).collect()) == [("lr", 1, "0.1"), ("lr", 2, "0.2")]
    again = df.orderBy("v")
    assert reports.fingerprints(df).exceptAll(reports.fingerprints(again)).count() == 0
    first = reports.fingerprints(df).filter("run_id = 1").first().fingerprint
    assert reports.matches_fingerprint(reports.fingerprints(df), first).filter("matches").count() == 1


def test_stage_and_run_performance(spark):
    df = frame(spark, {1: [2.0, None, 1.0, NAN]}).selectExpr(
        "*", "seq AS step", "CAST(NULL AS DOUBLE) AS grad_norm", "CAST(0.1 AS DOUBLE) AS learning_rate")
    stage = reports.stage_performance(df).first()
    assert (stage.rows, stage.final_step, stage.final_loss, stage.loss_improvement_pct) == (4, 9, None, 50.0)
    run = reports.run_performance(df).first()
    assert (run.final_loss, run.best_loss, run.losses, run.convergence_rate) == (1.0, 1.0, 2, 0.5)
    assert run.stability_score == pytest.approx(1 / (1 + math.sqrt(0.5)))


def test_baseline_direction(spark):
    current = spark.createDataFrame([("loss", 1.0), ("accuracy", 0.9), ("other", 1.0)], "metric string, current double")
    lower = spark.createDataFrame([("loss", 2.0), ("accuracy", 0.6)], "metric string, baseline double")
    assert {r.metric: r.better for r in reports.baseline_comparison(current, lower).collect()} == {"loss": True, "accuracy": False}
    directed = lower.selectExpr("*", "metric = 'accuracy' AS higher_is_better")
    assert all(r.better for r in reports.baseline_comparison(current, directed).collect())


def test_error_reports(spark):
    df = spark.createDataFrame([("memory", "low", True), ("memory", "high", False), ("network", "low", True)],
                               "category string, severity string, recovered boolean")
    got = {(r.dimension, r.entry): (r.errors, r.recovered) for r in reports.error_counts(df).collect()}
    assert got == {("total", "all"): (3, 2), ("category", "memory"): (2, 1), ("category", "network"): (1, 1),
                   ("severity", "low"): (2, 2), ("severity", "high"): (1, 0)}


@pytest.mark.parametrize("name", [
    "rl_stopping", "rolling_stability", "stepwise_divergence", "gradient_stability", "lr_schedule", "convergence_point", "loss_divergence"])
def test_beyond_few_ranges_a_range_of_the_query_is_not_its_bucket(spark, sf_dir, monkeypatch, name):
    made = []

    def counted(df, folder):
        stored = written(df, folder)
        if folder == "ranges":
            made.append(stored.select("_bucket").distinct().count())
        return stored

    written = ordering.written
    monkeypatch.setattr(ordering, "written", counted)
    monkeypatch.setattr(ordering, "FEW_RANGES", 2, raising=False)
    monkeypatch.setattr(ordering, "RANGE_ROWS", 250, raising=False)
    assert difference(registered.QUERIES[name](spark, sf_dir), sf_dir, registered.ORACLES[name]) is None
    assert made and max(made) <= 4  # 1,000 events; buckets of 90 rows would make 11 or 12
