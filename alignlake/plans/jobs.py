"""Whole jobs built from the operators. Reports and checks run Spark jobs while they are built; results are tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.operators import evaluation, normalize, ordering, quality, reports, sampling, telemetry, tokens, turns, validate
from alignlake.session import written


def process_chats(df: DataFrame, vocab: DataFrame, max_length: int) -> DataFrame:
    """Chat rows with rendered text, ids, mask, labels and a reject reason. No row is dropped yet."""
    text = normalize.rendered(normalize.with_messages(df)).withColumnRenamed("length", "original_length")
    encoded = tokens.with_labels(tokens.tokenized(text, vocab, max_length=max_length))
    return validate.chat_reason(encoded, max_length).withColumn("token_count", F.size("input_ids")).drop("tokens")


def process_preferences(df: DataFrame, vocab: DataFrame, max_length: int) -> DataFrame:
    """Preference rows with both rendered chats, their ids and masks, and a reject reason."""
    encoded = normalize.rendered_pairs(normalize.with_preference(df))
    for side in ("chosen", "rejected"):
        encoded = tokens.tokenized(encoded, vocab, f"{side}_text", f"{side}_", max_length).drop(f"{side}_tokens")
        encoded = encoded.withColumn(f"{side}_token_count", F.size(f"{side}_input_ids"))
    return validate.preference_reason(encoded, max_length)


def vocabulary_of(df: DataFrame, kind: str, size: int) -> DataFrame:
    """Vocabulary of the rendered texts of a table, stored so that every use reads it instead of counting again."""
    if kind == "chat":
        return written(tokens.vocabulary(normalize.rendered(normalize.with_messages(df)), size=size), "vocabulary")
    pairs = normalize.rendered_pairs(normalize.with_preference(df))
    return written(tokens.vocabulary(pairs, ("chosen_text", "rejected_text"), size=size), "vocabulary")


def prepare_table(df: DataFrame, kind: str, order_by: str, max_length: int, vocab: DataFrame | int,
                  check_raw: bool = True, filter_content: bool = True, check_processed: bool = True,
                  max_rows: int = 0) -> DataFrame:
    """Cap, validate, filter, process and check a raw table; raises when a check fails.

    ``vocab`` is a vocabulary or the size of the one that is counted from the table.

    The two checks are aggregates of which one row reaches the driver. A batch result is stored before
    its check, so tokenizing runs once; streams skip that check.
    """
    if kind not in ("chat", "preference"):
        raise ValueError(f"unknown kind: {kind}")
    rows = sampling.head(df, [order_by], max_rows)
    if check_raw and not reports.validation_report(rows, kind).first()["is_valid"]:
        raise ValueError("raw table validation failed")
    if filter_content:
        rows = validate.filter_content(rows, kind)
    words = vocabulary_of(rows, kind, vocab) if isinstance(vocab, int) else vocab
    process = process_chats if kind == "chat" else process_preferences
    done = validate.successful(process(rows, words, max_length))
    if check_processed and not done.isStreaming:
        done = written(done, f"prepared-{kind}")
        if not validate.format_gate(done, kind, max_length, order_by).first()["passed"]:
            raise ValueError("processed table validation failed")
    return done


def prepare_turns(df: DataFrame, max_length: int, vocab: DataFrame | int, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                  content: str = "text", check_raw: bool = True, filter_content: bool = True, check_processed: bool = True, joined: bool = False,
                  rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """:func:`prepare_table` for a table of turns whose conversations may be of any length; none is gathered beyond ``max_length`` tokens.

    ``joined`` encodes by a join, for a vocabulary too large to look up.
    """
    said = turns.numbered(df, conversation, turn, role, content, rows_per_bucket)
    if check_raw and not reports.validation_summary(turns.raw_checks(said, rows_per_bucket)).first()["is_valid"]:
        raise ValueError("raw table validation failed")
    if filter_content:
        said = turns.without_unsafe(said)
    done = validate.successful(turns.processed(said, vocab, max_length, joined, rows_per_bucket))
    if check_processed:
        done = written(done, "prepared-turns")
        if not validate.format_gate(done, "chat", max_length, "conversation", rows_per_bucket=rows_per_bucket).first()["passed"]:
            raise ValueError("processed table validation failed")
    return done.withColumnRenamed("conversation", conversation)


def prepare_simple(df: DataFrame, max_length: int = 512) -> tuple[DataFrame, DataFrame]:
    """Render, filter by length; returns the kept rows and the counts per filter reason."""
    judged = validate.length_filter_reason(normalize.rendered(df), max_length)
    counts = reports.reason_counts(judged, good="valid_examples")
    return judged.filter(F.col("reason") == "valid_examples").drop("reason"), counts


def preference_training_split(df: DataFrame, row_id: str, max_length: int, vocab: DataFrame | int,
                              mode: str = "hash") -> DataFrame:
    """Processed preference rows with their train or eval side; ``vocab`` as in :func:`prepare_table`."""
    words = vocabulary_of(df, "preference", vocab) if isinstance(vocab, int) else vocab
    done = written(validate.successful(process_preferences(df, words, max_length)), "preference-rows")
    return sampling.train_eval_split(done, row_id, row_id, mode=mode)


def prompt_set(df: DataFrame, order_by: Sequence[str | Column], vocab: DataFrame, max_length: int,
               limit: int | None = None) -> DataFrame:
    """First prompts, tokenized to half the sequence length so the answer has room."""
    prompts = normalize.first_prompts(df, order_by, limit)
    return tokens.tokenized(prompts, vocab, "prompt", max_length=max_length // 2).drop("tokens")


def evaluation_summary(scored: DataFrame, benchmark: DataFrame, trials: DataFrame) -> DataFrame:
    """Statistics of quality, benchmark and performance tables as (topic, measure, ...) rows."""
    topics = {
        "quality": (scored, evaluation.DIMENSIONS), "benchmark": (benchmark, ["turn_1_score", "turn_2_score", "average_score"]),
        "performance": (trials, ["tokens_per_second", "memory_usage_mb", "latency_ms"])}
    result = None
    for topic, (rows, values) in topics.items():
        part = rows.select(F.lit(topic).alias("topic"), *[F.col(v).cast("double").alias(v) for v in values]).unpivot(["topic"], list(values), "measure", "value")
        result = part if result is None else result.unionByName(part)
    return evaluation.measure_stats(result, ["topic"])


def evaluation_report(model: str, scored: DataFrame, benchmark: DataFrame, trials: DataFrame) -> DataFrame:
    """One nested report row: statistics, category means and the safety summary."""
    scored = written(scored.select(*evaluation.DIMENSIONS, "is_harmful", "is_refusal"), "scores")
    benchmark = written(benchmark.select("category", "turn_1_score", "turn_2_score", "average_score"), "benchmark")
    stats = evaluation_summary(scored, benchmark, trials).agg(F.sort_array(F.collect_list(F.struct(
        "topic", "measure", "rows", "mean", "median", "std", "min", "max"))).alias("statistics"))
    categories = evaluation.category_means(benchmark).agg(F.sort_array(F.collect_list(F.struct(
        "category", "mean_score", "rows"))).alias("categories"))
    safety = evaluation.safety_summary(scored).select(F.struct("*").alias("safety"))
    return stats.select(
        F.lit(model).alias("model_name"), "statistics",
        categories.scalar().alias("categories"), safety.scalar().alias("safety"))


def arm_report(scored: DataFrame) -> DataFrame:
    """A/B report in one row: means, differences, t-test and effect size."""
    scored = written(scored.select("arm", *evaluation.DIMENSIONS), "arm-scores")
    test = evaluation.significance(scored).select(F.struct(
        "t_statistic", "p_value", "cohens_d", "significant", "effect_size").alias("test")).scalar()
    return evaluation.compare_arms(scored).withColumn("_test", test).select("*", "_test.*").drop("_test")


def training_report(history: DataFrame, keys: Sequence[str] = telemetry.RUN_STAGE, window: int = 50) -> DataFrame:
    """Performance, stability, convergence and schedule of every run and stage, side by side."""
    keys = list(keys)
    report = reports.stage_performance(history, keys)
    parts = [
        telemetry.stability_and_convergence(history, keys=keys, window=window).drop("rows"),
        telemetry.gradient_stability(history, keys=keys, window=window).withColumnRenamed(
            "final_grad_norm", "last_grad_norm"),
        telemetry.learning_rate_schedule(history, keys=keys),
    ]
    for part in parts:  # by all keys together, so that a null in one of them is a key like any other
        values = part.select(F.struct(*keys).alias("_key"), *[c for c in part.columns if c not in keys])
        report = report.join(values, F.struct(*keys).eqNullSafe(F.col("_key")), "left").drop("_key")
    return report


def quality_report(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Chats per quality band with their mean score and mean rendered length."""
    scored = quality.with_chat_quality(normalize.rendered(df, messages), messages)
    return scored.groupBy(quality.band(F.col("quality")).alias("band")).agg(
        F.count("*").alias("chats"), F.avg("quality").alias("avg_quality"), F.avg("length").alias("avg_length"))
