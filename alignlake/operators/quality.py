"""Text quality scores, bands and their aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.functions import chat, patterns, text

# Lower bound of each quality band, from the best band down.
BANDS = {"excellent": 0.8, "good": 0.6, "fair": 0.4, "poor": 0.0}


def with_quality(df: DataFrame, source: str, out: str = "quality", harmful: str | None = None) -> DataFrame:
    """Add a score between 0 and 1 for a text column.

    Factors for length, repeated words, sentence length and unsafe words multiply up. ``harmful``
    names an existing flag column, so the unsafe-word search need not run twice.
    """
    flag = F.col(harmful) if harmful else patterns.is_harmful_lowered(F.col("_lower"))
    # Each costly fact is its own column, used more than once below, so it is evaluated once.
    staged = (
        df.withColumn("_clean", text.strip(F.coalesce(F.col(source), F.lit(""))))
        .withColumn("_lower", F.lower("_clean"))
        .withColumn("_words", text.words(F.col("_lower")))
        .withColumns({
            "_size": F.length("_clean"),
            "_count": F.size("_words"),
            "_distinct": F.size(F.array_distinct("_words")),
            "_pieces": text.piece_count(F.col("_clean")),
            "_sentence_words": text.sentence_word_count(F.col("_clean")),
            "_unsafe": flag,
        })
    )
    return with_score(staged.drop("_clean", "_lower", "_words"), out)


def with_score(facts: DataFrame, out: str = "quality") -> DataFrame:
    """The score of a text from its facts: characters, words, distinct words, pieces between full stops, words in these, unsafe words.

    The fact columns (``_size``, ``_count``, ``_distinct``, ``_pieces``, ``_sentence_words``, ``_unsafe``) are dropped.
    """
    size, count, pieces = F.col("_size"), F.col("_count"), F.col("_pieces")
    staged = facts.withColumns({
        "_variety": F.col("_distinct") / F.greatest(count, F.lit(1)),
        "_mean_words": F.col("_sentence_words") / F.greatest(pieces, F.lit(1)),
    })
    variety, mean_words = F.col("_variety"), F.col("_mean_words")
    factors = [
        F.when(size < 10, 0.3).when(size < 50, 0.7).otherwise(1.0),
        F.when(size > 5000, 0.8).otherwise(1.0),
        F.when((count > 10) & (variety < 0.3), 0.4).when((count > 10) & (variety < 0.5), 0.7).otherwise(1.0),
        F.when((pieces > 1) & (mean_words < 3), 0.6).when((pieces > 1) & (mean_words > 50), 0.8).otherwise(1.0),
        F.when(F.col("_unsafe"), 0.1).otherwise(1.0),
    ]
    score = factors[0]
    for factor in factors[1:]:
        score = score * factor
    return staged.withColumn(out, F.when(size == 0, 0.0).otherwise(score)).drop(
        "_size", "_count", "_distinct", "_pieces", "_sentence_words", "_unsafe", "_variety", "_mean_words")


def band(score: Column) -> Column:
    """Band of a score; an absent score has none."""
    names = list(BANDS)
    choice = F.lit(names[-1])
    for name in reversed(names[:-1]):
        choice = F.when(score >= BANDS[name], F.lit(name)).otherwise(choice)
    return F.when(score.isNotNull(), choice)


def with_chat_quality(df: DataFrame, messages: str = "messages", out: str = "quality") -> DataFrame:
    """Quality of all message contents joined by spaces; a row without messages scores 0."""
    joined = df.withColumn("_combined", F.coalesce(chat.combined_text(F.col(messages)), F.lit("")))
    return with_quality(joined, "_combined", out).drop("_combined")


def with_preference_quality(df: DataFrame, out: str = "quality", flags: str | None = None) -> DataFrame:
    """Weighted quality of prompt, chosen and rejected; 0 when one of them is missing.

    ``flags`` is the prefix of existing unsafe-word flags, one per field.
    """
    scored = df
    weights = {"prompt": 0.4, "chosen": 0.3, "rejected": 0.3}
    for field in weights:
        scored = with_quality(scored, field, f"_q_{field}", f"{flags}{field}" if flags else None)
    total = sum(F.col(f"_q_{field}") * weight for field, weight in weights.items())
    complete = F.lit(True)
    for field in weights:
        complete = complete & (F.coalesce(F.col(field), F.lit("")) != "")
    return scored.withColumn(out, F.when(complete, total).otherwise(0.0)).drop(*[f"_q_{f}" for f in weights])


def band_counts(df: DataFrame, score: str = "quality") -> DataFrame:
    """One row per band with its count; a band without rows is reported with 0."""
    counts = df.agg(*[F.count_if(band(F.col(score)) == name).alias(name) for name in BANDS])
    return counts.unpivot([], list(BANDS), "band", "rows")


def quality_stats(df: DataFrame, score: str = "quality") -> DataFrame:
    """Count, mean, minimum, maximum and sample deviation; the deviation of fewer than two rows is 0."""
    value = F.col(score)
    return df.agg(
        F.count(value).alias("rows"), F.avg(value).alias("avg_quality"), F.min(value).alias("min_quality"),
        F.max(value).alias("max_quality"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std_quality"))
