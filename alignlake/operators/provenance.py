"""Provenance of training runs: roll-ups of stages and runs, and their nested documents in bounded pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.operators import ordering
from alignlake.operators.reports import provenance_rollup

METRICS = ("loss", "grad_norm", "learning_rate")
POINTS = 10_000


def stage_provenance(history: DataFrame, ends: DataFrame, run: str = "run_id", stage: str = "stage") -> DataFrame:
    """Roll-up of every stage with the end that was recorded for it; a stage without one is not completed.

    ``ends`` holds (run, stage, ended_at[, final_loss][, checkpoint_path]). Of several ends the latest counts, and the latest that
    names a loss or a checkpoint gives these. A recorded loss takes the place of the last one measured, which may be NaN.
    """
    facts = [F.max("ended_at").alias("end_time")]
    for name in ("final_loss", "checkpoint_path"):
        if name in ends.columns:
            facts.append(F.max_by(name, F.when(F.col(name).isNotNull(), F.col("ended_at"))).alias(f"_{name}"))
    last = ends.groupBy(F.struct(run, stage).alias("_key")).agg(*facts)
    rolled = provenance_rollup(history, [run, stage]).drop("end_time", "completed").withColumn("_key", F.struct(run, stage))
    measured = history.groupBy(F.struct(run, stage).alias("_key")).agg(
        F.max_by("loss", F.when(F.col("loss").isNotNull(), F.col("seq"))).alias("_measured"))
    joined = rolled.join(measured, "_key").join(last, "_key", "left").drop("_key").withColumn("final_loss", F.col("_measured")).drop("_measured")
    if "final_loss" in ends.columns:
        joined = joined.withColumn("final_loss", F.coalesce("_final_loss", "final_loss")).drop("_final_loss")
    available = F.col("_checkpoint_path").isNotNull() if "checkpoint_path" in ends.columns else F.lit(False)
    return joined.withColumn("checkpoint_available", available).drop("_checkpoint_path").withColumn("completed", F.col("end_time").isNotNull())


def run_provenance(stages: DataFrame, run: str = "run_id", stage: str = "stage") -> DataFrame:
    """One row per run: stages in order of their start, how many of them completed, first start, best loss, and the end once all stages have one."""
    named = F.transform(F.sort_array(F.collect_list(F.struct("start_time", F.col(stage).alias("stage")))), lambda s: s["stage"])
    return stages.groupBy(run).agg(
        F.count("*").alias("stages"), F.count_if("completed").alias("stages_completed"), named.alias("stage_names"),
        F.min("start_time").alias("start_time"), F.when(F.min("completed"), F.max("end_time")).alias("end_time"),
        F.sum("total_steps").alias("total_steps"), F.min("best_metric").alias("best_metric"),
        F.count_if("checkpoint_available").alias("checkpoints"), F.min("completed").alias("completed"))


def pipeline_summary(stages: DataFrame, run: str = "run_id", stage: str = "stage", success: str = "success", seconds: str = "duration_seconds",
                     memory: str = "memory_peak_gb") -> DataFrame:
    """One row per run from its stage results: which stages succeeded, how many failed, total duration, peak memory and each stage's facts.

    An unknown success counts as a failure, an unknown duration or memory as none.
    """
    good = F.coalesce(F.col(success), F.lit(False))
    entry = F.struct(F.col(stage).alias("stage"), good.alias("success"), F.col(seconds).alias("duration_seconds"), F.col(memory).alias("memory_peak_gb"),
                     F.coalesce("metrics_count", F.lit(0)).alias("metrics_count"))
    gathered = stages.groupBy(run).agg(
        F.count("*").alias("total_stages"), F.count_if(~good).alias("failure_count"), F.coalesce(F.sum(seconds), F.lit(0.0)).alias("total_duration_seconds"),
        F.coalesce(F.max(memory), F.lit(0.0)).alias("peak_memory_gb"), F.sum(F.coalesce("metrics_count", F.lit(0))).alias("metrics_count"),
        F.sort_array(F.collect_list(entry)).alias("stages"))
    done = F.transform(F.filter("stages", lambda s: s["success"]), lambda s: s["stage"])
    return gathered.withColumn("completed_stages", done).withColumn("completed", F.col("failure_count") == 0)


def success_by_stage(stages: DataFrame, stage: str = "stage", success: str = "success", seconds: str = "duration_seconds") -> DataFrame:
    """Runs, successes and their share, and the mean duration of every stage over all runs."""
    good = F.coalesce(F.col(success), F.lit(False))
    return stages.groupBy(stage).agg(
        F.count("*").alias("runs"), F.count_if(good).alias("succeeded"), F.avg(good.cast("double")).alias("success_rate"), F.avg(seconds).alias("avg_seconds"))


# --- nested documents -------------------------------------------------------------------------------------------------

def documents(history: DataFrame, stages: DataFrame, metrics: Sequence[str] = METRICS, points: int = POINTS, run: str = "run_id", stage: str = "stage",
              order_by: str = "seq", step: str = "step", time: str = "ts", rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """Run documents with their stages and each stage's metric history, in parts of at most ``points`` history entries.

    (run, part, parts, stages: [{stage, facts of the stage, metrics_history: [{seq, step, timestamp, metrics}]}]). The parts of a run follow each
    other, so a history of any length is split over rows; the facts of a stage stand in every part that holds entries of it.
    """
    placed = ordering.with_index(history, [stage, order_by], [run], name="_at", total="_all", rows_per_bucket=rows_per_bucket)
    entry = F.struct(F.col(order_by).alias("seq"), F.col(step).alias("step"), F.col(time).alias("timestamp"), F.struct(*metrics).alias("metrics"))
    part = F.floor(F.col("_at") / points).cast("bigint")
    pieces = placed.groupBy(F.struct(run, stage).alias("_key"), part.alias("part"), F.ceil(F.col("_all") / points).cast("bigint").alias("parts")).agg(
        F.sort_array(F.collect_list(entry)).alias("metrics_history"))
    facts = [c for c in stages.columns if c not in (run, stage)]
    known = stages.select(F.struct(run, stage).alias("_key"), F.struct(*facts).alias("_facts"))
    full = pieces.join(known, "_key", "left").select(
        F.col(f"_key.{run}").alias(run), "part", "parts",
        F.struct(F.col(f"_key.{stage}").alias("stage"), *[F.col(f"_facts.{c}").alias(c) for c in facts], "metrics_history").alias("_stage"))
    return full.groupBy(run, "part", "parts").agg(F.sort_array(F.collect_list("_stage")).alias("stages"))


def history_of(docs: DataFrame, run: str = "run_id", stage: str = "stage", order_by: str = "seq", step: str = "step", time: str = "ts") -> DataFrame:
    """The flat history that the documents were made of."""
    stages = docs.select(run, F.explode("stages").alias("_s"))
    entries = stages.select(run, F.col("_s.stage").alias(stage), F.explode("_s.metrics_history").alias("_e"))
    return entries.select(run, stage, F.col("_e.seq").alias(order_by), F.col("_e.step").alias(step), F.col("_e.timestamp").alias(time), "_e.metrics.*")


def stages_of(docs: DataFrame, run: str = "run_id", stage: str = "stage") -> DataFrame:
    """The stage rows of the documents, each once."""
    names = [f.name for f in docs.schema["stages"].dataType.elementType.fields if f.name not in ("stage", "metrics_history")]
    rows = docs.select(run, "part", F.explode("stages").alias("_s"))

    def fact(name: str) -> Column:
        return F.col(f"_first.{name}")

    first = rows.groupBy(run, F.col("_s.stage").alias(stage)).agg(F.min_by(F.struct(*[F.col(f"_s.{n}") for n in names]), "part").alias("_first"))
    return first.select(run, stage, *[fact(n) for n in names])
