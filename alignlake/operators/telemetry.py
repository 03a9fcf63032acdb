"""Metric series: rolling statistics, trends, convergence, divergence and early stopping.

Series are rows of (keys..., order, value). All frame work goes through ``operators.ordering``, so one
run may hold any share of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alignlake.operators.ordering import ROWS_PER_BUCKET, Chunks, attach_group_values, with_index
from alignlake.session import written

RUN_STAGE = ("run_id", "stage")
INF = float("inf")


def not_finite(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == INF)


def nan_to_null(value: Column) -> Column:
    """Missing and NaN are the same to the report operators."""
    return F.when(~F.isnan(value), value)


def _series(df: DataFrame, value: str, keys: Sequence[str], order_by: str, keep_nan: bool = False,
            extra: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    picked = df.select(*keys, F.col(order_by).alias("seq"), F.col(value).cast("double").alias("value"), *extra)
    kept = picked.filter(F.col("value").isNotNull() if keep_nan else
                         F.col("value").isNotNull() & ~F.isnan("value"))
    return with_index(kept, "seq", keys, total="n", rows_per_bucket=rows_per_bucket)


def rolling_stats(df: DataFrame, value: str = "loss", keys: Sequence[str] = RUN_STAGE, order_by: str = "seq",
                  window: int = 50, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rolling mean and sample deviation per series, NULL until the window is full.

    Series that are not longer than the window are left out.
    """
    indexed = _series(df, value, keys, order_by, rows_per_bucket=rows_per_bucket).filter(F.col("n") > window)
    chunks = Chunks(indexed, keys, before=window - 1, chunk_rows=rows_per_bucket)
    full = F.col("idx") >= window - 1
    return chunks.finish(chunks.rows.withColumns({
        "rolling_mean": F.when(full, F.avg("value").over(chunks.last(window))),
        "rolling_std": F.when(full, F.stddev_samp("value").over(chunks.last(window))),
    }))


def stability(df: DataFrame, value: str = "loss", keys: Sequence[str] = RUN_STAGE, order_by: str = "seq",
              window: int = 50, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Last rolling mean and deviation, their ratio, and the least-squares slope over row positions."""
    rolled = rolling_stats(df, value, keys, order_by, window, rows_per_bucket)
    final = rolled.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.max_by("rolling_mean", "idx").alias("final_mean"),
        F.max_by("rolling_std", "idx").alias("final_std"), F.regr_slope("value", "idx").alias("trend_slope"))
    return final.withColumn("coefficient_of_variation", F.try_divide("final_std", "final_mean"))


def trend_slope(df: DataFrame, value: str = "loss", keys: Sequence[str] = RUN_STAGE, order_by: str = "seq",
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Least-squares slope of the value over the positions 0, 1, 2, ... of each series."""
    indexed = _series(df, value, keys, order_by, rows_per_bucket=rows_per_bucket)
    return indexed.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.coalesce(F.regr_slope("value", "idx"), F.lit(0.0)).alias("trend_slope"))


def _looked_back(df: DataFrame, value: str, keys: Sequence[str], order_by: str, window: int, rows_per_bucket: int) -> DataFrame:
    """Rolling mean and deviation, and the largest deviation of the last ``window`` rows, by chunk and stored."""
    indexed = _series(df, value, keys, order_by, rows_per_bucket=rows_per_bucket).filter(F.col("n") > window)
    chunks = Chunks(indexed, keys, before=2 * (window - 1), chunk_rows=rows_per_bucket)
    full = F.col("idx") >= window - 1
    rolled = chunks.rows.withColumns({
        "mean": F.when(full, F.avg("value").over(chunks.last(window))),
        "std": F.when(full, F.stddev_samp("value").over(chunks.last(window)))})
    looked = rolled.withColumns({
        "worst": F.max("std").over(chunks.last(window)),
        "start": F.col("idx") - (window - 1),
        "start_seq": F.lag("seq", window - 1).over(chunks.window),
    })
    return written(chunks.finish(looked, keep_chunk=True), "rolled")


def _first_calm(home: DataFrame, keys: Sequence[str], window: int) -> DataFrame:
    judged = attach_group_values(
        home, keys, {"_sum": F.sum("std"), "_count": F.count("std")},
        {"_total": F.sum("_sum"), "_rows": F.sum("_count")})
    calm = (
        (F.col("start") >= window) & (F.col("start") < F.col("n") - window)
        & (F.col("worst") < F.col("_total") / F.col("_rows") * 0.1)
    )
    return judged.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.min(F.when(calm, F.col("start"))).alias("convergence_index"),
        F.min_by(F.when(calm, F.col("start_seq")), F.when(calm, F.col("start"))).alias("convergence_seq"))


def convergence_point(df: DataFrame, value: str = "loss", keys: Sequence[str] = RUN_STAGE, order_by: str = "seq",
                      window: int = 50, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """First position from which a whole window of rolling deviations stays under a tenth of their mean.

    Looking back from the end of that window needs one pass: the largest deviation of the last
    ``window`` rows is known at each row, and the candidate is ``window - 1`` rows earlier.
    """
    return _first_calm(_looked_back(df, value, keys, order_by, window, rows_per_bucket), keys, window)


def stability_and_convergence(df: DataFrame, value: str = "loss", keys: Sequence[str] = RUN_STAGE, order_by: str = "seq",
                              window: int = 50, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """:func:`stability` and :func:`convergence_point` side by side, from one numbering and one walk over the chunks."""
    keys = list(keys)
    home = _looked_back(df, value, keys, order_by, window, rows_per_bucket)
    final = home.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.max_by("mean", "idx").alias("final_mean"), F.max_by("std", "idx").alias("final_std"),
        F.regr_slope("value", "idx").alias("trend_slope")).withColumn("coefficient_of_variation", F.try_divide("final_std", "final_mean"))
    calm = _first_calm(home, keys, window).select(F.struct(*keys).alias("_key"), "convergence_index", "convergence_seq")
    return final.join(calm, F.struct(*keys).eqNullSafe(F.col("_key")), "left").drop("_key")


def gradient_stability(df: DataFrame, value: str = "grad_norm", keys: Sequence[str] = RUN_STAGE,
                       order_by: str = "seq", window: int = 50, exploding: float = 10.0, vanishing: float = 1e-6,
                       rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Last gradient norm, last rolling deviation, and how many norms explode or vanish."""
    rolled = rolling_stats(df, value, keys, order_by, window, rows_per_bucket)
    return rolled.groupBy(*keys).agg(
        F.max_by("value", "idx").alias("final_grad_norm"), F.max_by("rolling_std", "idx").alias("grad_norm_std"),
        F.count_if(F.col("value") > exploding).alias("exploding_gradients"),
        F.count_if(F.col("value") < vanishing).alias("vanishing_gradients"))


def learning_rate_schedule(df: DataFrame, value: str = "learning_rate", keys: Sequence[str] = RUN_STAGE,
                           order_by: str = "seq", least_change: float = 1e-8,
                           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """First and last rate, their ratio and the number of changes, for series of two rows or more."""
    indexed = _series(df, value, keys, order_by, rows_per_bucket=rows_per_bucket).filter("n > 1")
    chunks = Chunks(indexed, keys, before=1, chunk_rows=rows_per_bucket)
    moved = chunks.finish(chunks.rows.withColumn(
        "moved", F.abs(F.col("value") - F.lag("value").over(chunks.window)) > least_change))
    ends = moved.groupBy(*keys).agg(
        F.min_by("value", "idx").alias("initial_lr"), F.max_by("value", "idx").alias("final_lr"),
        F.count_if("moved").alias("lr_changes"))
    return ends.withColumn("lr_decay_ratio", F.try_divide("final_lr", "initial_lr"))


def loss_divergence(df: DataFrame, value: str = "loss", keys: Sequence[str] = RUN_STAGE, order_by: str = "seq",
                    window: int = 10, factor: float = 2.0, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Flag a loss above ``factor`` times the mean of the last ``window`` losses, or one that is not finite.

    Nothing is flagged before ``window`` losses are there.
    """
    indexed = _series(df, value, keys, order_by, keep_nan=True, rows_per_bucket=rows_per_bucket)
    chunks = Chunks(indexed, keys, before=window - 1, chunk_rows=rows_per_bucket)
    loss = F.col("value")
    return chunks.finish(
        chunks.rows.withColumn("recent_avg", F.avg("value").over(chunks.last(window)))
        .withColumn("diverged", (F.col("idx") >= window - 1)
                    & (not_finite(loss) | (loss > F.col("recent_avg") * factor))))


def stepwise_divergence(df: DataFrame, value: str = "loss", rate: str = "learning_rate",
                        keys: Sequence[str] = RUN_STAGE, order_by: str = "seq", factor: float = 10.0,
                        reduction: float = 0.5, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Compare each loss with the one before; a jump suggests a smaller learning rate."""
    indexed = _series(df, value, keys, order_by, keep_nan=True, extra=[rate], rows_per_bucket=rows_per_bucket)
    chunks = Chunks(indexed, keys, before=1, chunk_rows=rows_per_bucket)
    loss, previous = F.col("value"), F.col("previous")
    jump = F.coalesce(~F.isnan(loss) & (loss > previous * factor), F.lit(False))
    return chunks.finish(
        chunks.rows.withColumn("previous", F.lag("value").over(chunks.window))
        .withColumn("jumped", jump)
        .withColumn("not_finite", not_finite(loss))
        .withColumn("suggested_lr", F.when(F.col("jumped"), F.col(rate) * reduction)))


def running_best(df: DataFrame, value: str = "loss", keys: Sequence[str] = RUN_STAGE, order_by: str = "seq",
                 higher_is_better: bool = False, recent: int = 10,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Best value so far, rows since it last improved, and the mean of the last ``recent`` values.

    Every chunk is walked once on its own; its minimum and the place of its last record then carry over
    chunk borders, so the running state of a long series never passes through one task.
    """
    sign = -1.0 if higher_is_better else 1.0
    indexed = _series(df, value, keys, order_by, keep_nan=True, rows_per_bucket=rows_per_bucket)
    chunks = Chunks(indexed, keys, before=recent - 1, chunk_rows=rows_per_bucket)
    cost = F.when(F.col("_home"), F.when(F.isnan("value"), F.lit(INF)).otherwise(F.col("value") * sign))
    before_row = chunks.window.rowsBetween(Window.unboundedPreceding, -1)
    up_to_row = chunks.window.rowsBetween(Window.unboundedPreceding, 0)
    walked = (
        chunks.rows.withColumn("_cost", cost)
        .withColumn("_before", F.coalesce(F.min("_cost").over(before_row), F.lit(INF)))
        .withColumn("_record", F.max(F.when(F.col("_cost") < F.col("_before"), F.col("idx"))).over(up_to_row))
        .withColumn("recent_avg", F.when(F.col("idx") >= recent - 1, F.avg("value").over(chunks.last(recent))))
    )
    rows = written(chunks.finish(walked, keep_chunk=True), "walked").withColumn("_group", F.struct(*keys, "_chunk"))

    per_chunk = rows.groupBy("_group").agg(F.min("_cost").alias("_least"), F.max("_record").alias("_at"))
    earlier = (Window.partitionBy(*[F.col("_group")[k] for k in keys]).orderBy(F.col("_group")["_chunk"])
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = (
        per_chunk.withColumn("_best_before", F.coalesce(F.min("_least").over(earlier), F.lit(INF)))
        .withColumn("_improved_at", F.when(F.col("_least") < F.col("_best_before"), F.col("_at")))
        .withColumn("_improved_before", F.max("_improved_at").over(earlier))
        .select("_group", "_best_before", "_improved_before")
    )
    local = F.least("_before", "_cost")
    ahead = local < F.col("_best_before")
    last = F.coalesce(F.when(ahead, F.col("_record")).otherwise(F.col("_improved_before")), F.lit(-1))
    judged = rows.join(carried, "_group").withColumns({
        "improved": F.col("_cost") < F.least("_before", "_best_before"),
        "best": F.least(F.col("_best_before"), local) * sign,
        "patience_counter": F.col("idx") - last,
    })
    return judged.select(*keys, "seq", "value", "idx", "n", "improved", "best", "patience_counter", "recent_avg")


def early_stopping(df: DataFrame, value: str, keys: Sequence[str] = RUN_STAGE, order_by: str = "seq",
                   min_delta: float = 0.001, patience: int = 3, start: float = 0.0,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Where a run stops when ``patience`` values in a row fail to beat the best by ``min_delta``.

    Higher is better. The best value only moves on a sufficient improvement, so the state depends on
    the path and has to be followed in order. Only a record, a value above all before it, can move it.
    Each chunk of rows is followed on its own from every record at which the path may enter it, one of its first
    ``patience`` rows; per series only the ways through its chunks are gathered and put together, never its rows.
    """
    if min_delta <= 0:
        raise ValueError("min_delta must be positive; running_best covers the case without one")
    indexed = _series(df, value, keys, order_by, keep_nan=True, rows_per_bucket=rows_per_bucket)
    indexed = written(indexed, "indexed")
    ways = stopping_ways(indexed, keys, min_delta, patience, start, rows_per_bucket)
    entered = F.when(F.size("_ways") > 0, F.struct("_chunk", "_ways"))
    ordered = ways.groupBy(*keys).agg(F.sort_array(F.collect_list(entered)).alias("_chunks"), F.max("n").alias("rows"))
    open_state = F.struct(
        F.lit(float(start)).alias("best"), F.lit(-1).cast("bigint").alias("last"), F.lit(None).cast("bigint").alias("at"))

    def step(state: Column, chunk: Column) -> Column:
        way = F.get(F.filter(chunk["_ways"], lambda w: w["first"] > state["best"] + min_delta), F.lit(0))
        in_time = way["entry"] - state["last"] <= patience
        moved = F.struct(way["best"].alias("best"), way["last"].alias("last"), way["at"].alias("at"))
        late = F.struct(state["best"].alias("best"), state["last"].alias("last"), (state["last"] + patience).alias("at"))
        return F.when(state["at"].isNotNull() | way.isNull(), state).when(in_time, moved).otherwise(late)

    at = F.coalesce(F.col("_state.at"), F.when(F.col("_state.last") + patience < F.col("rows"), F.col("_state.last") + patience))
    folded = ordered.withColumn("_state", F.aggregate("_chunks", open_state, step)).select(
        *keys, "rows", F.col("_state.best").alias("best"), F.col("_state.last").alias("_last"), at.alias("stop_index"))
    # the row at which a series stops is looked up by its position
    rows = indexed.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], F.col("idx").alias("_idx"), F.col("seq").cast("bigint").alias("stop_seq"))
    same = F.col("_idx") == F.col("stop_index")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    return folded.join(rows, same, "left").select(
        *keys, "rows", "best",
        F.when(F.col("stop_index").isNotNull(), patience).otherwise(F.col("rows") - 1 - F.col("_last")).cast("int").alias("patience_counter"),
        F.col("stop_index").isNotNull().alias("stopped"), "stop_index", "stop_seq")


def stopping_ways(indexed: DataFrame, keys: Sequence[str], min_delta: float, patience: int, start: float,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(keys, _chunk, n, _ways): per chunk of rows the ways of an early stopping through it, by the record they enter at.

    A way has its ``entry`` and the value there, the ``best`` value and the row of the ``last`` improvement in the chunk, and
    where it stops if a record of the chunk shows it.
    """
    size = max(rows_per_bucket, 1)
    chunked = indexed.withColumn("_chunk", F.floor(F.col("idx") / size).cast("bigint"))
    number = F.when(~F.isnan("value"), F.col("value"))
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    record = (number > start + min_delta) & F.coalesce(number > F.max(number).over(in_chunk), F.lit(True))
    points = written(chunked.withColumn("_point", F.when(record, F.struct("idx", "value"))).groupBy(*keys, "_chunk").agg(
        F.sort_array(F.collect_list("_point")).alias("_points"), F.max(number).alias("_high"), F.max("n").alias("n")), "points")
    points = points.withColumn("_group", F.struct(*keys, "_chunk"))
    # only the highest values of the chunks meet in one task, not their records
    before = (Window.partitionBy(*[F.col("_group")[k] for k in keys]).orderBy(F.col("_group")["_chunk"])
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = points.select("_group", F.max("_high").over(before).alias("_before"))
    records = points.join(carried, "_group").withColumn("_points", F.filter(
        "_points", lambda p: F.coalesce(p["value"] > F.col("_before"), F.lit(True))))
    none = F.array().cast("array<struct<entry:bigint,first:double,best:double,last:bigint,at:bigint>>")

    def way(entry: Column, first: Column, best: Column, last: Column, at: Column) -> Column:
        return F.struct(entry.alias("entry"), first.alias("first"), best.alias("best"), last.alias("last"), at.alias("at"))

    def step(ways: Column, point: Column) -> Column:
        moved = F.transform(ways, lambda w: F.when(w["at"].isNotNull(), w).when(
            point["idx"] - w["last"] > patience, way(w["entry"], w["first"], w["best"], w["last"], w["last"] + patience)).when(
            point["value"] > w["best"] + min_delta, way(w["entry"], w["first"], point["value"], point["idx"], w["at"])).otherwise(w))
        opened = way(point["idx"], point["value"], point["value"], point["idx"], F.lit(None).cast("bigint"))
        return F.concat(moved, F.when(point["idx"] % size < patience, F.array(opened)).otherwise(none))

    return records.select(*keys, "_chunk", "n", F.aggregate("_points", none, step).alias("_ways"))


def series_long(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = RUN_STAGE,
                order_by: str = "seq") -> DataFrame:
    """Plot series: one row per present value. Default columns are every ``*loss*`` one, rate and norm."""
    if columns is None:
        columns = [c for c in df.columns if "loss" in c or c in ("learning_rate", "grad_norm")]
    doubles = df.select(*keys, order_by, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([*keys, order_by], list(columns), "metric", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value"))


def memory_peaks(df: DataFrame, used: str = "memory_gb", keys: Sequence[str] = RUN_STAGE) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(used).alias("peak_memory_gb"), F.count(used).alias("samples"))


def memory_alerts(df: DataFrame, utilisation: str = "utilisation", limit: float = 0.95) -> DataFrame:
    return df.filter(F.col(utilisation) > limit)


def thinned(df: DataFrame, step: str = "step", log_steps: int = 10) -> DataFrame:
    """Every fifth logging step, the rate at which memory is reported."""
    return df.filter(F.col(step) % (log_steps * 5) == 0)


def progress(df: DataFrame, operation: str = "operation", step: str = "current_step", total: str = "total_steps",
             elapsed: str = "elapsed_seconds", order_by: str = "seq") -> DataFrame:
    """Latest state per operation: percent done, seconds per step and seconds left."""
    latest = df.groupBy(operation).agg(F.max_by(F.struct(step, total, elapsed), order_by).alias("_last"))
    current, goal, spent = F.col(f"_last.{step}"), F.col(f"_last.{total}"), F.col(f"_last.{elapsed}")
    each = F.when(current > 0, spent / current)
    return latest.select(
        operation, current.alias("current_step"), (current * 100.0 / F.nullif(goal, F.lit(0))).alias("percent"),
        each.alias("seconds_per_step"), F.when(goal.isNotNull(), (goal - current) * each).alias("eta_seconds"))


def prefixed_metrics(df: DataFrame, metric: str = "metric", stage: str = "stage") -> DataFrame:
    """Add ``metric_key``: the stage name in front of the metric, unless it is there already."""
    prefix = F.concat(F.col(stage), F.lit("/"))
    key = F.col(metric)
    return df.withColumn("metric_key", F.when(key.startswith(prefix), key).otherwise(F.concat(prefix, key)))


def plain_metrics(df: DataFrame, metric: str = "metric", stage: str = "stage") -> DataFrame:
    """Strip the stage prefix, so series logged with and without it analyse alike."""
    prefix = F.concat(F.col(stage), F.lit("/"))
    key = F.col(metric)
    return df.withColumn(metric, F.when(
        key.startswith(prefix), F.substring(key, F.length(prefix) + 1, F.length(key))).otherwise(key))


def numeric_results(df: DataFrame, key: str = "key", value: str = "value", stage: str = "stage") -> DataFrame:
    """Keep results that are numbers and name them ``stage/eval_key``."""
    number = F.col(value).try_cast("double")
    return (
        df.withColumn("number", number).filter(F.col("number").isNotNull())
        .withColumn("metric_key", F.concat(F.col(stage), F.lit("/eval_"), F.col(key)))
    )
