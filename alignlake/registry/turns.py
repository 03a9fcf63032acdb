"""Registered queries over turns: what the chat queries compute, with no conversation in one row."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.operators import quality, reports, turns
from alignlake.plans import jobs
from alignlake.registry import encoding, texts
from alignlake.registry import views as V

B = V.ROWS_PER_BUCKET


def _turns(spark, sf):
    return turns.numbered(V.conversations(spark, sf), rows_per_bucket=B)


def _odd_turns(spark, sf):
    return turns.numbered(V.conversations(spark, sf).selectExpr(*V.ODD_TURNS), rows_per_bucket=B)


def turns_quality_bands(spark, sf):
    said = _turns(spark, sf)
    lengths = turns.verdicts(said).select("conversation", "length")
    scored = turns.chat_quality(said, B).join(lengths, "conversation")
    bands = scored.groupBy(quality.band(F.col("quality")).alias("band")).agg(
        F.count("*").alias("chats"), F.avg("quality").alias("avg_quality"), F.avg("length").alias("avg_length"))
    return V.rounded(bands)


def turns_warnings(spark, sf):
    said = _odd_turns(spark, sf)
    return turns.warnings(said, turns.verdicts(said)).select(F.col("conversation").alias("conv_id"), "warning")


def turns_validation_report(spark, sf):
    return V.rounded(reports.validation_summary(turns.raw_checks(_odd_turns(spark, sf), B)))


def turns_loss_mask(spark, sf):
    rows = turns.processed(_turns(spark, sf), encoding.VOCABULARY_SIZE, encoding.LENGTH, rows_per_bucket=B)
    ids = lambda c: F.array_join(F.col(c).cast("array<string>"), " ").alias
    return rows.select(F.col("conversation").alias("conv_id"), "token_count", ids("input_ids")("ids"), ids("labels")("labels"))


def turns_reject_reasons(spark, sf):
    rows = turns.processed(_odd_turns(spark, sf), encoding.VOCABULARY_SIZE, encoding.LENGTH, rows_per_bucket=B)
    return V.rounded(reports.reason_counts(rows))


def prepared_turns(spark, sf):
    done = jobs.prepare_turns(V.conversations(spark, sf), encoding.LENGTH, encoding.VOCABULARY_SIZE, rows_per_bucket=B)
    return done.select("conv_id", F.col("original_length").cast("int").alias("original_length"), "token_count")


QUERIES = {f.__name__: f for f in (
    turns_quality_bands, turns_warnings, turns_validation_report, turns_loss_mask, turns_reject_reasons, prepared_turns)}

ORACLES = {
    "turns_quality_bands": texts.ORACLES["chat_quality_bands"],
    "turns_warnings": f"WITH {texts._warnings(True)} SELECT conv_id, unnest(string_split(warnings, ',')) AS warning FROM checked WHERE warnings <> ''",
    "turns_validation_report": texts.ORACLES["chat_validation_report"],
    "turns_loss_mask": encoding.ORACLES["chat_loss_mask"],
    "turns_reject_reasons": encoding.ORACLES["chat_reject_reasons"],
    "prepared_turns": encoding.ORACLES["prepared_chats"].replace("length(text) AS original_length", "CAST(length(text) AS INT) AS original_length"),
}
