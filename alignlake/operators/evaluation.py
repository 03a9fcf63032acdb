"""Response tables: row scores, safety, two-turn benchmark, summaries and model comparison."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.functions import chat, patterns, scoring, text
from alignlake.operators import ordering
from alignlake.session import written

DIMENSIONS = ["overall_quality", "helpfulness", "harmlessness", "honesty"]


def with_scores(df: DataFrame, prompt: str = "prompt", response: str = "response",
                category: str | None = "category") -> DataFrame:
    """Add all heuristic scores, the safety flags and the reasoning text of each response."""
    staged = (
        df.withColumn("_response", F.coalesce(F.col(response), F.lit("")))
        .withColumn("_lower", F.lower("_response"))
        .withColumn("_prompt", F.lower(F.coalesce(F.col(prompt), F.lit(""))))
    )
    raw, low = F.col("_response"), F.col("_lower")
    scores = {
        "helpfulness": scoring.helpfulness(raw, low),
        "harmlessness": scoring.harmlessness(low),
        "honesty": scoring.honesty(low),
        "is_harmful": scoring.is_harmful_response(F.col("_prompt"), low),
        "is_refusal": scoring.is_refusal(low),
    }
    if category is not None:
        scores["benchmark_score"] = scoring.benchmark_score(raw, low, F.col(category))
    scored = staged.withColumns(scores)
    dimensions = {d: F.col(d) for d in DIMENSIONS[1:]}
    return scored.withColumns({
        "overall_quality": sum(dimensions.values()) / 3,
        "safety_score": scoring.safety_score(F.col("is_harmful"), F.col("is_refusal")),
        "reasoning": scoring.reasoning(dimensions),
    }).drop("_response", "_lower", "_prompt")


def two_turn_scores(exchanges: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                    category: str = "category", per_category: int | None = None,
                    rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """Score first and second exchanges of each conversation and their mean.

    ``per_category`` keeps that many conversations per category in conversation order.
    """
    base = exchanges.select(conversation, turn, category, "prompt", "response")
    numbered = ordering.with_index(base, turn, [conversation], name="_nr", rows_per_bucket=rows_per_bucket)
    low = F.lower("response")
    scored = numbered.filter("_nr < 2").withColumn(
        "score", scoring.benchmark_score(F.col("response"), low, F.col(category)))

    def of(nr: int, column: str) -> Column:
        return F.max(F.when(F.col("_nr") == nr, F.col(column)))

    pairs = scored.groupBy(conversation).agg(
        F.max(category).alias(category), F.count("*").alias("_n"),
        of(0, "prompt").alias("prompt_1"), of(0, "response").alias("response_1"), of(0, "score").alias("turn_1_score"),
        of(1, "prompt").alias("prompt_2"), of(1, "response").alias("response_2"), of(1, "score").alias("turn_2_score"),
    ).filter("_n = 2").drop("_n")
    result = pairs.withColumn("average_score", (F.col("turn_1_score") + F.col("turn_2_score")) / 2)
    if per_category is None:
        return result
    ranked = ordering.with_index(result, conversation, [category], name="_rank", rows_per_bucket=rows_per_bucket)
    return ranked.filter(F.col("_rank") < per_category).drop("_rank")


def with_second_prompt_context(pairs: DataFrame) -> DataFrame:
    """Add the prompt text of the second turn: the first exchange and the second question."""
    return pairs.withColumn("context", chat.two_turn_context(
        F.col("prompt_1"), F.col("response_1"), F.col("prompt_2")))


def side_by_side(base: DataFrame, tuned: DataFrame, on: str = "prompt_id") -> DataFrame:
    """Join two models' responses on the prompt and judge the tuned one."""
    left = base.select(on, F.col("response").alias("base_response"))
    right = tuned.select(on, F.col("response").alias("tuned_response"))
    facts = left.join(right, on).withColumns({
        "base_words": text.word_count(F.col("base_response")),
        "tuned_words": text.word_count(F.col("tuned_response")),
        "base_follows": scoring.follows_instruction(F.lower("base_response")),
        "tuned_follows": scoring.follows_instruction(F.lower("tuned_response")),
    })
    verdict = (
        F.when(F.col("tuned_follows") & (F.col("tuned_words") > F.col("base_words")), "more_detailed")
        .when(F.col("tuned_follows") & ~F.col("base_follows"), "better_following")
        .otherwise("inconclusive")
    )
    return facts.withColumn("verdict", verdict)


def spread_stats(df: DataFrame, values: Sequence[str], keys: Sequence[str] = (),
                 rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """Per value column and group: count, mean, exact median, sample deviation, minimum, maximum.

    The values are stored first: they are narrow, and what they come from is then computed once.
    """
    narrow = df.select(*keys, *values)
    return measure_stats(narrow.unpivot(list(keys), list(values), "measure", "value"), keys, rows_per_bucket)


def measure_stats(long: DataFrame, keys: Sequence[str] = (), rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """:func:`spread_stats` of (keys, measure, value) rows; values of several tables need one pass only."""
    keys = list(keys)
    long = written(long.filter(F.col("value").isNotNull()), "values")
    stats = long.groupBy(*keys, "measure").agg(
        F.count("value").alias("rows"), F.avg("value").alias("mean"),
        F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    medians = ordering.median_by_counts(long, "value", [*keys, "measure"], rows_per_bucket=rows_per_bucket)
    return stats.join(medians, [*keys, "measure"])


def category_means(df: DataFrame, score: str = "average_score", category: str = "category") -> DataFrame:
    return df.groupBy(category).agg(F.avg(score).alias("mean_score"), F.count(score).alias("rows"))


def safety_summary(df: DataFrame) -> DataFrame:
    """Counts of harmful and safe responses and the refusal rate."""
    return df.agg(
        F.count("*").alias("total"), F.count_if("is_harmful").alias("harmful_responses"),
        F.count_if(~F.col("is_harmful")).alias("safe_responses"),
        F.coalesce(F.avg(F.col("is_refusal").cast("double")), F.lit(0.0)).alias("refusal_rate"))


def publishing_safety(df: DataFrame, response: str = "response") -> DataFrame:
    """Share of responses that pass all publishing checks; 0 for an empty table."""
    safe = F.size(patterns.publishing_issues(F.col(response))) == 0
    return df.agg(
        F.count("*").alias("total"), F.count_if(safe).alias("safe_responses"),
        F.count_if(~safe).alias("unsafe_responses"),
        F.coalesce(F.avg(safe.cast("double")), F.lit(0.0)).alias("safety_score"))


def _arm(column: str, arm: str, fn=F.avg) -> Column:
    return fn(F.when(F.col("arm") == arm, F.col(column)))


def percent_change(new: Column, old: Column) -> Column:
    """Change in percent; 0 when the old value is not positive."""
    return F.when(old > 0, F.try_divide(new - old, old) * 100).otherwise(0.0)


def compare_arms(df: DataFrame, speed: str | None = None) -> DataFrame:
    """Means of a ``baseline`` and an ``improved`` arm, their differences and the change in percent."""
    aggregates = []
    for d in DIMENSIONS:
        aggregates += [_arm(d, a).alias(f"{a}_{d}") for a in ("baseline", "improved")]
    if speed:
        aggregates += [_arm(speed, a).alias(f"{a}_speed") for a in ("baseline", "improved")]
    means = df.agg(*aggregates)
    changes = {f"{d}_improvement": F.col(f"improved_{d}") - F.col(f"baseline_{d}") for d in DIMENSIONS}
    changes["overall_quality_percent"] = percent_change(
        F.col("improved_overall_quality"), F.col("baseline_overall_quality"))
    if speed:
        changes["speed_change"] = F.col("improved_speed") - F.col("baseline_speed")
        changes["speed_change_percent"] = percent_change(F.col("improved_speed"), F.col("baseline_speed"))
    return means.withColumns(changes)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by the modified Lentz recurrence."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 400):
        for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                          -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-14:
            break
    return value


def t_tail(t: float, dof: float) -> float:
    """Two-sided tail probability of Student's t distribution."""
    if math.isnan(t) or not dof > 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    x = dof / (dof + t * t)
    a, b = dof / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def p_value(t: Column, dof: Column) -> Column:
    """Tail probability of aggregated rows; one value per test, so the rows are few."""

    def tails(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for ts, dofs in batches:
            yield pd.Series([math.nan if pd.isna(t) else t_tail(t, n) for t, n in zip(ts, dofs)])

    return F.pandas_udf(tails, "double")(t, dof)


def significance(df: DataFrame, value: str = "overall_quality", keys: Sequence[str] = ()) -> DataFrame:
    """Equal-variance t-test and Cohen's d of the improved against the baseline arm.

    Only the moments of the two arms leave the table; the tail probability is computed on that
    aggregate. Arms without spread give d = 0 and no t statistic unless their means differ.
    """
    moments = []
    for a in ("baseline", "improved"):
        moments += [_arm(value, a, F.count).alias(f"n_{a}"), _arm(value, a).alias(f"mean_{a}"),
                    _arm(value, a, F.var_samp).alias(f"var_{a}")]
    grouped = df.groupBy(*keys).agg(*moments) if keys else df.agg(*moments)
    n0, n1 = F.col("n_baseline"), F.col("n_improved")
    pooled = F.try_divide((n0 - 1) * F.col("var_baseline") + (n1 - 1) * F.col("var_improved"), F.col("dof"))
    difference = F.col("mean_improved") - F.col("mean_baseline")
    error = F.col("pooled_std") * F.sqrt(F.try_divide(F.lit(1.0), n0) + F.try_divide(F.lit(1.0), n1))
    infinite = F.when(difference > 0, float("inf")).when(difference < 0, float("-inf")).otherwise(float("nan"))
    effect = F.abs(F.col("cohens_d"))
    return (
        grouped.withColumn("dof", n0 + n1 - 2)
        .withColumn("pooled_std", F.sqrt(pooled))
        .withColumn("t_statistic", F.when(error > 0, difference / error).otherwise(
            F.when(F.col("pooled_std").isNotNull(), infinite)))
        .withColumn("p_value", p_value(F.col("t_statistic"), F.col("dof").cast("double")))
        .withColumn("cohens_d", F.when(F.col("pooled_std") > 0, difference / F.col("pooled_std")).otherwise(0.0))
        .withColumn("significant", F.coalesce(~F.isnan("p_value") & (F.col("p_value") < 0.05), F.lit(False)))
        .withColumn("effect_size", F.when(effect >= 0.8, "large").when(effect >= 0.5, "medium").otherwise("small"))
    )


def pairwise_reward_metrics(df: DataFrame, chosen: str = "chosen_reward", rejected: str = "rejected_reward",
                            keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of "chosen scores higher", where that is always the truth."""
    hit = F.col(chosen) > F.col(rejected)
    counted = [F.count("*").alias("pairs"), F.count_if(hit).alias("_hits")]
    grouped = df.groupBy(*keys).agg(*counted) if keys else df.agg(*counted)
    recall = F.coalesce(F.try_divide(F.col("_hits"), F.col("pairs")), F.lit(0.0))
    precision = F.when(F.col("_hits") > 0, 1.0).otherwise(0.0)
    return grouped.withColumns({
        "accuracy": recall, "precision": precision, "recall": recall,
        "f1": F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)),
    }).drop("_hits")


def reward_summary(df: DataFrame, response: str = "response", reward: str = "reward") -> DataFrame:
    """Responses, mean word count and reward mean, population deviation, minimum and maximum."""
    return df.agg(
        F.count(response).alias("num_responses"),
        F.avg(text.word_count(F.col(response))).alias("avg_response_length"),
        F.avg(reward).alias("avg_reward"), F.stddev_pop(reward).alias("std_reward"),
        F.min(reward).alias("min_reward"), F.max(reward).alias("max_reward"))


def latency_trials(df: DataFrame, keys: Sequence[str] = ("batch_size", "sequence_length"),
                   new_tokens: int = 50) -> DataFrame:
    """Mean latency and memory per setting, and the token rates that follow from them."""
    means = df.groupBy(*keys).agg(F.avg("latency_ms").alias("latency_ms"), F.avg("memory_mb").alias("memory_usage_mb"))
    rate = F.try_divide(F.col("batch_size") * new_tokens, F.col("latency_ms") / 1000)
    return means.withColumn("tokens_per_second", rate).withColumn(
        "throughput_tokens_per_minute", F.col("tokens_per_second") * 60)
