"""Dataset, error, run and provenance reports: one pass of mergeable aggregates each."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from alignlake.functions import patterns, text
from alignlake.operators import ordering, quality
from alignlake.operators.normalize import with_messages, with_preference
from alignlake.operators.sampling import head
from alignlake.operators.telemetry import RUN_STAGE, nan_to_null
from alignlake.operators.validate import check_raw_chat, check_raw_preference
from alignlake.session import written


def raw_checks(df: DataFrame, kind: str) -> DataFrame:
    """Rows with ``is_valid``, ``warnings`` and ``quality`` (of valid rows only)."""
    if kind == "chat":
        checked = with_messages(check_raw_chat(df), "_messages")
        scored = quality.with_chat_quality(checked, "_messages").drop("_messages")
    elif kind == "preference":
        checked = with_preference(check_raw_preference(df, "_unsafe_"))
        scored = quality.with_preference_quality(checked, flags="_unsafe_")
    else:
        raise ValueError(f"unknown kind: {kind}")
    return scored.withColumn("quality", F.when(F.col("is_valid"), F.col("quality")))


def validation_report(df: DataFrame, kind: str, error_share: float = 0.05, warning_share: float = 0.20) -> DataFrame:
    """One row of counts, shares, quality statistics and the verdict on an unprocessed table.

    Every row is checked. An empty table is not valid.
    """
    checked = raw_checks(df, kind)
    return validation_summary(checked.select("is_valid", F.size("warnings").alias("notes"), "quality"), error_share, warning_share)


def validation_summary(checked: DataFrame, error_share: float = 0.05, warning_share: float = 0.20) -> DataFrame:
    """The report of rows that are checked already: ``is_valid``, the number of ``notes`` and the ``quality`` of each."""
    score = F.col("quality")
    bands = [F.count_if(quality.band(score) == name).alias(f"{name}_rows") for name in quality.BANDS]
    facts = checked.agg(
        F.count("*").alias("total"), F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
        F.coalesce(F.sum("notes"), F.lit(0)).alias("content_warnings"),
        F.avg(score).alias("avg_quality"), F.min(score).alias("min_quality"), F.max(score).alias("max_quality"),
        F.coalesce(F.stddev_samp(score), F.lit(0.0)).alias("std_quality"),
        *bands)
    total = F.col("total")
    return facts.withColumns({
        "valid_percentage": F.try_divide(F.col("valid") * 100, total),
        "invalid_percentage": F.try_divide(F.col("invalid") * 100, total),
        "is_valid": (total > 0) & (F.col("invalid") <= total * error_share),
        "high_warning_rate": F.col("content_warnings") > total * warning_share,
    })


def reason_counts(df: DataFrame, reason: str = "reason", good: str = "successful") -> DataFrame:
    """Rows per reason, and each reason's share; the share of ``good`` is the success rate."""
    counts = df.groupBy(reason).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())  # over one row per reason
    return counts.withColumn("share", F.col("rows") / total).withColumn("is_success", F.col(reason) == good)


def token_length_stats(df: DataFrame, ids: str = "input_ids", source: str = "text",
                       rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """Length statistics of tokens and text; the median is the higher of two middle values.

    The lengths are stored first: they are narrow, and the texts are then read once for all passes.
    """
    lengths = df.select(F.size(ids).alias("tokens"), F.length(source).alias("characters"))
    long = written(lengths, "lengths").unpivot([], ["tokens", "characters"], "measure", "length")
    stats = long.groupBy("measure").agg(
        F.count("length").alias("rows"), F.min("length").alias("min"), F.max("length").alias("max"),
        F.avg("length").alias("mean"), F.coalesce(F.stddev_samp("length"), F.lit(0.0)).alias("std"))
    medians = ordering.median_by_counts(long, "length", ["measure"], upper=True, rows_per_bucket=rows_per_bucket)
    return stats.join(medians, "measure")


def text_quality_report(df: DataFrame, sources: Sequence[str] = ("text",)) -> DataFrame:
    """Text length and quality statistics over one or more text columns of a processed table."""
    texts = df.select(F.explode(F.array(*[F.col(s) for s in sources])).alias("text"))
    scored = quality.with_quality(texts, "text")
    score = F.col("quality")
    return scored.agg(
        F.count("text").alias("texts"), F.avg(F.length("text")).alias("avg_text_length"),
        F.avg(score).alias("avg_quality"), F.min(score).alias("min_quality"), F.max(score).alias("max_quality"),
        *[F.count_if(quality.band(score) == name).alias(f"{name}_rows") for name in quality.BANDS])


# Column names that give a table's kind away.
KIND_COLUMNS = {
    "chat": ["messages", "conversations", "instruction", "input", "question"],
    "preference": ["prompt", "chosen", "rejected", "question", "response_a", "response_b"],
}


def detect_kind(df: DataFrame) -> str:
    names = set(df.columns)
    return next((kind for kind, fields in KIND_COLUMNS.items() if names & set(fields)), "unknown")


def _any_harmful(value: Column, kind: DataType) -> Column:
    """True when a text anywhere in a value is harmful. Texts are read as they are: JSON escapes would hide words at line breaks."""
    if isinstance(kind, StringType):
        return patterns.is_harmful(value)
    if isinstance(kind, StructType):
        return reduce(operator.or_, [_any_harmful(value[f.name], f.dataType) for f in kind], F.lit(False))
    if isinstance(kind, ArrayType):
        return F.coalesce(F.exists(value, lambda v: _any_harmful(v, kind.elementType)), F.lit(False))
    if isinstance(kind, MapType):
        return (_any_harmful(F.map_keys(value), ArrayType(kind.keyType))
                | _any_harmful(F.map_values(value), ArrayType(kind.valueType)))
    return F.lit(False)


def health_report(df: DataFrame, small: int = 100) -> DataFrame:
    """Kind, issues of all rows and advice, in one row; a caller who wants a sample passes one.

    ``findings`` counts every issue once, as ``issue:rows`` in alphabetical order.
    """
    kind = detect_kind(df)
    sample = df
    if kind == "chat":
        sample = with_messages(sample, "_messages")
        harmful = reduce(operator.or_, [_any_harmful(F.col(f"`{f.name}`"), f.dataType) for f in df.schema])
        issue = (F.when(F.coalesce(F.size("_messages"), F.lit(0)) <= 0, "no_messages")
                 .when(harmful, "harmful_content"))
    elif kind == "preference":
        sample = with_preference(sample)
        missing = (F.col("prompt") == "") | (F.col("chosen") == "") | (F.col("rejected") == "")
        issue = F.when(missing, "missing_fields").when(F.col("chosen") == F.col("rejected"), "identical_responses")
    else:
        issue = F.lit(None).cast("string")
    listed = sample.select(issue.alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
    found = listed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("issue").isNotNull(), F.col("n"))), F.lit(0)).alias("issues"),
        F.array_join(F.array_sort(F.collect_list(F.when(
            F.col("issue").isNotNull(), F.concat_ws(":", "issue", F.col("n").cast("string"))))), ",").alias("findings"))
    size = F.col("checked")
    advice = F.array_compact(F.array(
        F.when(F.col("checked") == 0, F.lit("check_loading")),
        F.when(F.col("issues") > 0, F.lit("review_quality")),
        F.when((F.lit(kind) == "unknown") & (F.col("checked") > 0), F.lit("custom_preprocessing")),
        F.when((F.col("checked") > 0) & (size < small), F.lit("small_table"))))
    return found.select(
        F.lit(kind).alias("detected_kind"), "checked", "issues", "findings",
        F.array_join(advice, ",").alias("recommendations"))


def error_counts(df: DataFrame) -> DataFrame:
    """Errors and recovered errors in total, by category and by severity, in one aggregation."""
    counted = df.groupingSets(
        [[], ["category"], ["severity"]], "category", "severity").agg(
        F.grouping_id().alias("_level"), F.count("*").alias("errors"), F.count_if("recovered").alias("recovered"))
    dimension = F.when(F.col("_level") == 3, "total").when(F.col("_level") == 1, "category").otherwise("severity")
    return counted.select(
        dimension.alias("dimension"), F.coalesce("category", "severity", F.lit("all")).alias("entry"),
        "errors", "recovered", F.coalesce(F.try_divide("recovered", "errors"), F.lit(0.0)).alias("recovery_rate"))


def recovery_by_strategy(df: DataFrame, strategy: str = "category") -> DataFrame:
    """Successes, failures and success rate per recovery strategy."""
    return df.groupBy(F.col(strategy).alias("strategy")).agg(
        F.count_if("recovered").alias("success_count"), F.count_if(~F.col("recovered")).alias("failure_count"),
        F.avg(F.col("recovered").cast("double")).alias("success_rate"))


def recent_errors(df: DataFrame, at: Column | None = None, hours: int = 1, time: str = "ts") -> DataFrame:
    """Errors of the last hour before ``at`` (by default the newest error)."""
    until = at if at is not None else df.agg(F.max(time).alias("t")).scalar()
    return df.filter(F.col(time) > until - F.expr(f"INTERVAL {hours} HOURS")).agg(F.count("*").alias("recent_errors"))


def last_errors(df: DataFrame, rows: int = 10, order_by: str = "event_id") -> DataFrame:
    return df.orderBy(F.desc(order_by)).limit(rows)


def _last(column: str, order_by: str) -> Column:
    return F.max_by(nan_to_null(F.col(column)), F.col(order_by))


def _present(column: str, order_by: str, fn) -> Column:
    value = nan_to_null(F.col(column))
    return fn(value, F.when(value.isNotNull(), F.col(order_by)))


def stage_performance(df: DataFrame, keys: Sequence[str] = RUN_STAGE, order_by: str = "seq") -> DataFrame:
    """Rows, last step, values of the last row and loss improvement per series."""
    loss = nan_to_null(F.col("loss"))
    grouped = df.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.max("step").alias("final_step"),
        _last("loss", order_by).alias("final_loss"), _last("learning_rate", order_by).alias("final_learning_rate"),
        _last("grad_norm", order_by).alias("final_grad_norm"), F.count(loss).alias("_losses"),
        _present("loss", order_by, F.min_by).alias("_first"), _present("loss", order_by, F.max_by).alias("_latest"))
    improvement = F.try_divide(F.col("_first") - F.col("_latest"), F.col("_first")) * 100
    return grouped.withColumn("loss_improvement_pct", F.when(F.col("_losses") > 1, improvement)).drop(
        "_losses", "_first", "_latest")


def run_performance(df: DataFrame, keys: Sequence[str] = ("run_id",), order_by: str = "seq") -> DataFrame:
    """Stages, steps and rows per run, and its loss efficiency: rate, stability, final and best loss."""
    loss = nan_to_null(F.col("loss"))
    grouped = df.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_set("stage")), ",").alias("stages"), F.max("step").alias("total_steps"),
        F.count("*").alias("rows"), F.count(loss).alias("losses"), F.stddev_samp(loss).alias("_std"),
        F.min(loss).alias("best_loss"), _present("loss", order_by, F.min_by).alias("_first"),
        _present("loss", order_by, F.max_by).alias("final_loss"))
    enough = F.col("losses") > 1
    return grouped.withColumns({
        "stages_completed": F.size(F.split("stages", ",")),
        "convergence_rate": F.when(enough, F.abs(F.col("final_loss") - F.col("_first")) / F.col("losses")),
        "stability_score": F.when(enough, 1.0 / (1.0 + F.col("_std"))),
        "final_loss": F.when(enough, F.col("final_loss")), "best_loss": F.when(enough, F.col("best_loss")),
    }).drop("_std", "_first")


def latest_metrics(df: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("run_id",),
                   order_by: str = "seq") -> DataFrame:
    """(keys, metric, current): values of the last row of each run, present ones only."""
    last = df.groupBy(*keys).agg(*[_last(m, order_by).alias(m) for m in metrics])
    return last.unpivot(list(keys), list(metrics), "metric", "current").filter(F.col("current").isNotNull())


def baseline_comparison(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Join current metrics with a baseline table (metric, baseline[, higher_is_better]).

    Lower counts as better unless the baseline table says otherwise.
    """
    joined = ordering.salted_join(current, baseline, ["metric"], ["current"])
    gain = F.try_divide(F.col("baseline") - F.col("current"), F.col("baseline"))
    if "higher_is_better" in baseline.columns:
        gain = F.when(F.coalesce("higher_is_better", F.lit(False)), -gain).otherwise(gain)
    return joined.withColumn("improvement_pct", gain * 100).withColumn("better", gain > 0)


def run_comparison(summaries: DataFrame, runs: Sequence, run: str = "run_id") -> DataFrame:
    """Metrics as rows and the given runs as columns, from (run, metric, current)."""
    return summaries.filter(F.col(run).isin(list(runs))).groupBy("metric").pivot(run, list(runs)).agg(F.first("current"))


def config_difference(config: DataFrame, run: str = "run_id", key: str = "k", value: str = "v") -> DataFrame:
    """Settings whose value differs among the runs that have them; a setting of one run never does."""
    differing = config.groupBy(key).agg(F.min(value).alias("_low"), F.max(value).alias("_high")).filter("_low <> _high")
    return ordering.salted_join(config, differing.select(key), [key], [run]).select(key, run, value)


def fingerprints(config: DataFrame, run: str = "run_id", key: str = "k", value: str = "v") -> DataFrame:
    """SHA-256 over each run's settings as JSON with sorted keys; repeated rows of a setting count once."""
    settings = config.groupBy(run, key).agg(F.max(value).alias(value))
    entries = F.sort_array(F.collect_list(F.struct(F.col(key), F.col(value))))
    return settings.groupBy(run).agg(F.sha2(F.to_json(F.map_from_entries(entries)), 256).alias("fingerprint"))


def matches_fingerprint(prints: DataFrame, reference: str) -> DataFrame:
    return prints.withColumn("matches", F.col("fingerprint") == reference)


def provenance_rollup(df: DataFrame, keys: Sequence[str] = RUN_STAGE, order_by: str = "seq") -> DataFrame:
    """Best and final loss, steps, first and last time and completion of every stage."""
    loss = nan_to_null(F.col("loss"))
    return df.groupBy(*keys).agg(
        F.min(loss).alias("best_metric"), _present("loss", order_by, F.max_by).alias("final_loss"),
        F.count("*").alias("total_steps"), F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
        F.max("ts").isNotNull().alias("completed"))


def run_rollup(stages: DataFrame, run: str = "run_id", seconds: str = "duration_seconds",
               memory: str = "memory_peak_gb") -> DataFrame:
    """Total duration, peak memory and outcome of a run from its stage rows."""
    return stages.groupBy(run).agg(
        F.count_if("success").alias("completed_stages"), F.count_if(~F.col("success")).alias("failed_stages"),
        F.coalesce(F.sum(seconds), F.lit(0.0)).alias("total_duration_seconds"),
        F.coalesce(F.max(memory), F.lit(0.0)).alias("peak_memory_gb"),
        F.sum("metrics_count").alias("metrics_count"))


def text_lengths(df: DataFrame, source: str = "text", ids: str | None = None) -> DataFrame:
    """Mean, longest and shortest text, and the same for token counts when there are ids."""
    size = F.length(source)
    parts = [F.count("*").alias("num_rows"), F.avg(size).alias("avg_text_length"),
             F.max(size).alias("max_text_length"), F.min(size).alias("min_text_length")]
    count = F.size(ids) if ids else F.size(text.tokens(F.col(source)))
    parts += [F.avg(count).alias("avg_token_length"), F.max(count).alias("max_token_length"),
              F.min(count).alias("min_token_length")]
    return df.agg(*parts)
