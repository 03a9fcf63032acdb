"""Registered queries over the provenance of runs: roll-ups with recorded ends, and nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.operators import provenance, reports, validate
from alignlake.registry import series
from alignlake.registry import views as V
from alignlake.session import work_path, written
from alignlake.sources import writers

# every 101st event records the end of its run's stage, some with a loss and a checkpoint
ENDS = [
    "user_id % 12 AS run_id", "CASE event_type WHEN 'view' THEN 'sft' WHEN 'click' THEN 'reward' ELSE 'rloo' END AS stage", "ts AS ended_at",
    "CASE WHEN event_id % 2 = 0 THEN value END AS final_loss", "CASE WHEN user_id % 5 > 1 THEN concat('step-', event_id) END AS checkpoint_path"]
ENDED = "event_id % 101 = 0 AND user_id % 12 <> 5"


def _stages(spark, sf):
    ends = V.events(spark, sf).filter(ENDED).selectExpr(*ENDS)
    return provenance.stage_provenance(V.history(spark, sf), ends)


def stage_provenance(spark, sf):
    return V.rounded(_stages(spark, sf))


def run_provenance(spark, sf):
    runs = provenance.run_provenance(_stages(spark, sf))
    return V.rounded(runs.withColumn("stage_names", F.array_join("stage_names", ",")))


def provenance_document(spark, sf):
    """The history of every run as nested documents of at most 500 entries, written as JSON, read back and flattened."""
    history = V.history(spark, sf)
    stages = written(reports.provenance_rollup(history).drop("start_time", "end_time", "completed"), "stages")
    docs = provenance.documents(history, stages, points=500, rows_per_bucket=V.ROWS_PER_BUCKET)
    path = writers.write_documents(docs, work_path(spark, "provenance"))
    back = writers.read_documents(spark, path, docs.schema)
    known = provenance.stages_of(back).select(F.struct("run_id", "stage").alias("key"), "total_steps")
    flat = provenance.history_of(back).withColumn("key", F.struct("run_id", "stage"))
    return V.rounded(flat.join(known, "key").select("run_id", "stage", "seq", "step", "loss", "grad_norm", "total_steps"), 9)


def _results(spark, sf):
    return validate.stage_completion(series._stage_rows(spark, sf)).withColumn("success", F.col("passed"))


def pipeline_summary(spark, sf):
    found = provenance.pipeline_summary(_results(spark, sf))
    return V.rounded(found.withColumn("completed_stages", F.array_join("completed_stages", ",")).withColumn("stages", F.array_join(
        F.transform("stages", lambda s: F.concat_ws(":", s["stage"], s["success"].cast("string"), s["metrics_count"].cast("string"))), ",")))


def success_by_stage(spark, sf):
    return V.rounded(provenance.success_by_stage(_results(spark, sf)))


QUERIES = {f.__name__: f for f in (stage_provenance, run_provenance, provenance_document, pipeline_summary, success_by_stage)}

_LOSS = "CASE WHEN isnan(loss) THEN NULL ELSE loss END"
_STAGES = f"""{V.SQL_HISTORY}, ends AS (SELECT {', '.join(ENDS)} FROM events WHERE {ENDED}),
  e AS (SELECT run_id, stage, max(ended_at) AS end_time, arg_max(final_loss, ended_at) FILTER (final_loss IS NOT NULL) AS l,
    count(checkpoint_path) > 0 AS c FROM ends GROUP BY run_id, stage),
  r AS (SELECT run_id, stage, min({_LOSS}) AS best_metric, arg_max(loss, seq) FILTER (loss IS NOT NULL) AS last_loss, count(*) AS total_steps,
    min(ts) AS start_time FROM history GROUP BY run_id, stage),
  st AS (SELECT r.run_id, r.stage, best_metric, coalesce(l, last_loss) AS final_loss, total_steps, start_time, end_time, coalesce(c, false) AS checkpoint_available,
    end_time IS NOT NULL AS completed FROM r LEFT JOIN e ON e.run_id = r.run_id AND e.stage = r.stage)"""

ORACLES = {
    "stage_provenance": f"""WITH {_STAGES} SELECT run_id, stage, round(best_metric, 6) AS best_metric, round(final_loss, 6) AS final_loss, total_steps,
      start_time, end_time, checkpoint_available, completed FROM st""",
    "run_provenance": f"""WITH {_STAGES} SELECT run_id, count(*) AS stages, count(*) FILTER (completed) AS stages_completed,
      string_agg(stage, ',' ORDER BY start_time, stage) AS stage_names, min(start_time) AS start_time,
      CASE WHEN bool_and(completed) THEN max(end_time) END AS end_time, CAST(sum(total_steps) AS BIGINT) AS total_steps,
      round(min(best_metric), 6) AS best_metric, count(*) FILTER (checkpoint_available) AS checkpoints, bool_and(completed) AS completed FROM st GROUP BY run_id""",
    "provenance_document": f"""WITH {V.SQL_HISTORY} SELECT run_id, stage, seq, step, round(loss, 9) AS loss, round(grad_norm, 9) AS grad_norm,
      count(*) OVER (PARTITION BY run_id, stage) AS total_steps FROM history""",
    "pipeline_summary": f"""WITH {V.SQL_HISTORY}, {series._STAGES} SELECT run_id, count(*) AS total_stages, count(*) FILTER (fault IS NOT NULL) AS failure_count,
      round(sum(d), 6) AS total_duration_seconds, round(max(m), 6) AS peak_memory_gb, CAST(sum(c) AS BIGINT) AS metrics_count,
      string_agg(concat(stage, ':', fault IS NULL, ':', c), ',' ORDER BY stage) AS stages,
      coalesce(string_agg(stage, ',' ORDER BY stage) FILTER (fault IS NULL), '') AS completed_stages, bool_and(fault IS NULL) AS completed
      FROM judged GROUP BY run_id""",
    "success_by_stage": f"""WITH {V.SQL_HISTORY}, {series._STAGES} SELECT stage, count(*) AS runs, count(*) FILTER (fault IS NULL) AS succeeded,
      round(avg(CASE WHEN fault IS NULL THEN 1.0 ELSE 0.0 END), 6) AS success_rate, round(avg(d), 6) AS avg_seconds FROM judged GROUP BY stage""",
}
