"""Registered queries over telemetry: windows, trends, stopping rules, run and error reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.operators import reports, telemetry, validate
from alignlake.plans import jobs
from alignlake.registry import views as V

B = 90
W = 20
INF = float("inf")


def rolling_stability(spark, sf):
    rolled = telemetry.rolling_stats(V.history(spark, sf), window=W, rows_per_bucket=B)
    return rolled.select("run_id", "stage", "seq", F.round("rolling_mean", 9).alias("rolling_mean"),
                         F.round("rolling_std", 6).alias("rolling_std"))


def final_stability(spark, sf):
    return V.rounded(telemetry.stability(V.history(spark, sf), window=W, rows_per_bucket=V.ROWS_PER_BUCKET))


def trend_slope(spark, sf):
    return V.rounded(telemetry.trend_slope(V.history(spark, sf), rows_per_bucket=B))


def convergence_point(spark, sf):
    return telemetry.convergence_point(V.history(spark, sf), window=W, rows_per_bucket=B)


def gradient_stability(spark, sf):
    return V.rounded(telemetry.gradient_stability(V.history(spark, sf), window=W, rows_per_bucket=B))


def lr_schedule(spark, sf):
    return V.rounded(telemetry.learning_rate_schedule(V.history(spark, sf), rows_per_bucket=B), 9)


def loss_divergence(spark, sf):
    judged = telemetry.loss_divergence(V.history(spark, sf), rows_per_bucket=B)
    return V.rounded(judged.select("run_id", "stage", "seq", "recent_avg", "diverged"), 9)


def stepwise_divergence(spark, sf):
    judged = telemetry.stepwise_divergence(V.history(spark, sf), rows_per_bucket=B)
    return V.rounded(judged.select("run_id", "stage", "seq", "previous", "jumped", "not_finite", "suggested_lr"), 9)


def patience(spark, sf):
    followed = telemetry.running_best(V.history(spark, sf), rows_per_bucket=B)
    return V.rounded(followed.select("run_id", "stage", "seq", "best", "patience_counter", "recent_avg"), 9)


def reward_stopping(spark, sf):
    return V.rounded(telemetry.early_stopping(V.history(spark, sf), "utilisation", rows_per_bucket=B))


def rl_stopping(spark, sf):
    return V.rounded(telemetry.early_stopping(
        V.history(spark, sf), "loss", min_delta=5.0, patience=40, start=-INF, rows_per_bucket=B))


def _current(spark, sf):
    return reports.latest_metrics(V.history(spark, sf), ["loss", "grad_norm", "learning_rate"])


def run_compare(spark, sf):
    return V.rounded(reports.run_comparison(_current(spark, sf), [0, 1, 2, 3]), 9)


def config_diff(spark, sf):
    return reports.config_difference(V.config(spark, sf))


def fingerprint_match(spark, sf):
    """Which runs have the settings of the first run."""
    prints = reports.fingerprints(V.config(spark, sf))
    return reports.matches_fingerprint(prints, prints.orderBy("run_id").first()["fingerprint"]).select("run_id", "matches")


def run_fingerprint(spark, sf):
    return reports.fingerprints(V.config(spark, sf))


def series_long(spark, sf):
    return V.rounded(telemetry.series_long(V.history(spark, sf)), 9)


def memory_peaks(spark, sf):
    return V.rounded(telemetry.memory_peaks(V.history(spark, sf)))


def memory_alerts(spark, sf):
    return telemetry.memory_alerts(V.history(spark, sf)).select("run_id", "stage", "seq")


def memory_thinned(spark, sf):
    return V.rounded(telemetry.thinned(V.history(spark, sf)).select("run_id", "seq", "step", "memory_gb"))


def progress_eta(spark, sf):
    rows = V.events(spark, sf).selectExpr(
        "concat('run', user_id % 12) AS operation", "event_id AS seq", "event_id % 400 AS current_step",
        "CASE WHEN user_id % 12 <> 5 THEN 400 END AS total_steps", "value * 2 AS elapsed_seconds")
    return V.rounded(telemetry.progress(rows))


def metric_keys(spark, sf):
    rows = V.history(spark, sf).selectExpr(
        "seq", "stage", "CASE WHEN seq % 2 = 0 THEN concat(stage, '/loss') ELSE 'grad_norm' END AS metric")
    keyed = telemetry.prefixed_metrics(rows).select("seq", "stage", "metric_key", F.col("metric_key").alias("metric"))
    return telemetry.plain_metrics(keyed).select("seq", "metric_key", "metric")


def numeric_results(spark, sf):
    rows = V.events(spark, sf).selectExpr(
        "event_id", "event_type AS stage", "concat('k', user_id % 3) AS key",
        "CASE event_id % 3 WHEN 0 THEN CAST(event_id AS STRING) WHEN 1 THEN 'n/a' ELSE props END AS value")
    return telemetry.numeric_results(rows).select("event_id", "metric_key", "number")


def stage_performance(spark, sf):
    return V.rounded(reports.stage_performance(V.history(spark, sf)), 9)


def run_performance(spark, sf):
    return V.rounded(reports.run_performance(V.history(spark, sf)), 9)


def baseline_compare(spark, sf):
    # The baseline comes from the table itself: per metric, the mean over all runs.
    means = V.history(spark, sf).agg(
        F.avg(telemetry.nan_to_null(F.col("loss"))).alias("loss"), F.avg("grad_norm").alias("grad_norm"),
        F.avg("learning_rate").alias("learning_rate"))
    baseline = means.unpivot([], ["loss", "grad_norm", "learning_rate"], "metric", "baseline")
    return V.rounded(reports.baseline_comparison(_current(spark, sf), baseline))


def training_report(spark, sf):
    report = jobs.training_report(V.history(spark, sf), window=W)
    return V.rounded(report.select("run_id", "stage", "rows", "final_loss", "final_std", "trend_slope",
                                   "exploding_gradients", "lr_changes", "convergence_index"))


def provenance_rollup(spark, sf):
    return V.rounded(reports.provenance_rollup(V.history(spark, sf)))


def _stage_rows(spark, sf):
    grouped = V.history(spark, sf).groupBy("run_id", "stage").agg(
        F.max_by("loss", "seq").alias("final_loss"), F.avg("memory_gb").alias("duration_seconds"),
        F.max("memory_gb").alias("memory_peak_gb"), F.count("*").alias("metrics_count"))
    speed = F.when(F.col("run_id") == 4, F.lit(0.0)).otherwise(F.col("duration_seconds"))
    loss = F.when(F.col("run_id") == 7, F.lit(INF)).otherwise(F.col("final_loss"))
    return grouped.withColumn("steps_per_second", speed).withColumn("final_loss", loss)


def stage_completion(spark, sf):
    judged = validate.stage_completion(_stage_rows(spark, sf))
    return judged.select("run_id", "stage", "fault", "passed", "high_loss")


def run_rollup(spark, sf):
    judged = validate.stage_completion(_stage_rows(spark, sf)).withColumn("success", F.col("passed"))
    return V.rounded(reports.run_rollup(judged))


def error_stats(spark, sf):
    return V.rounded(reports.error_counts(V.errors(spark, sf)))


def recovery_by_strategy(spark, sf):
    return V.rounded(reports.recovery_by_strategy(V.errors(spark, sf)))


def recent_errors(spark, sf):
    return reports.recent_errors(V.errors(spark, sf))


def last_errors(spark, sf):
    return reports.last_errors(V.errors(spark, sf)).select("event_id", "category", "severity")


QUERIES = {f.__name__: f for f in (
    rolling_stability, final_stability, trend_slope, convergence_point, gradient_stability, lr_schedule,
    loss_divergence, stepwise_divergence, patience, reward_stopping, rl_stopping, run_compare, config_diff,
    run_fingerprint, fingerprint_match, series_long, memory_peaks, memory_alerts, memory_thinned, progress_eta, metric_keys,
    numeric_results, stage_performance, run_performance, baseline_compare, training_report, provenance_rollup,
    stage_completion, run_rollup, error_stats, recovery_by_strategy, recent_errors, last_errors)}


def _rolled(value: str) -> str:
    over = f"(PARTITION BY run_id, stage ORDER BY seq ROWS BETWEEN {W - 1} PRECEDING AND CURRENT ROW)"
    return f"""{V.SQL_HISTORY}, {V.sql_series(value)},
    rolled AS (SELECT *, CASE WHEN idx >= {W - 1} THEN avg(value) OVER {over} END AS rm,
      CASE WHEN idx >= {W - 1} THEN stddev_samp(value) OVER {over} END AS rs FROM series WHERE n > {W})"""


_CONVERGED = f"""worst AS (SELECT *, max(rs) OVER (PARTITION BY run_id, stage ORDER BY seq
      ROWS BETWEEN CURRENT ROW AND {W - 1} FOLLOWING) AS ahead, avg(rs) OVER (PARTITION BY run_id, stage) AS mean_rs FROM rolled),
  conv AS (SELECT run_id, stage, count(*) AS rows,
      min(idx) FILTER (idx >= {W} AND idx < n - {W} AND ahead < mean_rs * 0.1) AS convergence_index,
      arg_min(seq, idx) FILTER (idx >= {W} AND idx < n - {W} AND ahead < mean_rs * 0.1) AS convergence_seq
    FROM worst GROUP BY run_id, stage)"""


def _stopping(value: str, delta: float, limit: int, start: str) -> str:
    """Path-dependent best and counter, one row of each series per step of the recursion."""
    return f"""WITH RECURSIVE {V.SQL_HISTORY}, {V.sql_series(value, nan=True)},
      walk AS (
        SELECT run_id, stage, n, CAST(-1 AS BIGINT) AS idx, {start} AS best, 0 AS counter,
          CAST(NULL AS BIGINT) AS stop_index, CAST(NULL AS BIGINT) AS stop_seq FROM series WHERE idx = 0
        UNION ALL
        SELECT w.run_id, w.stage, w.n, s.idx,
          CASE WHEN NOT isnan(s.value) AND s.value > w.best + {V.num(delta)} THEN s.value ELSE w.best END,
          CASE WHEN NOT isnan(s.value) AND s.value > w.best + {V.num(delta)} THEN 0 ELSE w.counter + 1 END,
          CASE WHEN NOT (NOT isnan(s.value) AND s.value > w.best + {V.num(delta)}) AND w.counter + 1 >= {limit} THEN s.idx END,
          CASE WHEN NOT (NOT isnan(s.value) AND s.value > w.best + {V.num(delta)}) AND w.counter + 1 >= {limit} THEN s.seq END
        FROM walk w JOIN series s ON s.run_id = w.run_id AND s.stage = w.stage AND s.idx = w.idx + 1
        WHERE w.stop_index IS NULL),
      ends AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY run_id, stage ORDER BY idx DESC) = 1)
      SELECT run_id, stage, n AS rows, round(best, 6) AS best, counter AS patience_counter,
        stop_index IS NOT NULL AS stopped, stop_index, stop_seq FROM ends"""


_NN = "nullif({0}, CAST('NaN' AS DOUBLE))"
_LOSS = _NN.format("loss")
_LAST = f"""latest AS (SELECT run_id, arg_max_null({_LOSS}, seq) AS loss, arg_max_null(grad_norm, seq) AS grad_norm,
    arg_max_null(learning_rate, seq) AS learning_rate FROM history GROUP BY run_id),
  current AS (SELECT run_id, metric, current FROM (
      SELECT run_id, 'loss' AS metric, loss AS current FROM latest UNION ALL SELECT run_id, 'grad_norm', grad_norm FROM latest
      UNION ALL SELECT run_id, 'learning_rate', learning_rate FROM latest) WHERE current IS NOT NULL)"""
_STAGE_PERF = f"""perf AS (SELECT run_id, stage, count(*) AS rows, max(step) AS final_step,
    arg_max_null({_LOSS}, seq) AS final_loss, arg_max_null(learning_rate, seq) AS final_learning_rate,
    arg_max_null(grad_norm, seq) AS final_grad_norm, count({_LOSS}) AS losses,
    arg_min({_LOSS}, seq) FILTER ({_LOSS} IS NOT NULL) AS first_loss,
    arg_max({_LOSS}, seq) FILTER ({_LOSS} IS NOT NULL) AS latest_loss FROM history GROUP BY run_id, stage)"""
_STAGES = f"""st AS (SELECT run_id, stage, CASE WHEN run_id = 7 THEN CAST('inf' AS DOUBLE) ELSE arg_max(loss, seq) END AS l,
    avg(memory_gb) AS d, max(memory_gb) AS m, count(*) AS c FROM history GROUP BY run_id, stage),
  judged AS (SELECT *, CASE WHEN isnan(l) OR isinf(l) THEN 'invalid_loss'
      WHEN run_id = 4 THEN 'invalid_speed' END AS fault FROM st)"""

ORACLES = {
    "rolling_stability": f"""WITH {_rolled('loss')} SELECT run_id, stage, seq, round(rm, 9) AS rolling_mean,
      round(rs, 6) AS rolling_std FROM rolled""",
    "final_stability": f"""WITH {_rolled('loss')} SELECT run_id, stage, count(*) AS rows,
      round(arg_max(rm, idx), 6) AS final_mean, round(arg_max(rs, idx), 6) AS final_std,
      round(regr_slope(value, idx), 6) AS trend_slope,
      round(arg_max(rs, idx) / arg_max(rm, idx), 6) AS coefficient_of_variation FROM rolled GROUP BY run_id, stage""",
    "trend_slope": f"""WITH {V.SQL_HISTORY}, {V.sql_series('loss')} SELECT run_id, stage, count(*) AS rows,
      round(coalesce(regr_slope(value, idx), 0), 6) AS trend_slope FROM series GROUP BY run_id, stage""",
    "convergence_point": f"WITH {_rolled('loss')}, {_CONVERGED} SELECT * FROM conv",
    "gradient_stability": f"""WITH {_rolled('grad_norm')} SELECT run_id, stage,
      round(arg_max(value, idx), 6) AS final_grad_norm, round(arg_max(rs, idx), 6) AS grad_norm_std,
      count(*) FILTER (value > 10) AS exploding_gradients, count(*) FILTER (value < 1e-6) AS vanishing_gradients
      FROM rolled GROUP BY run_id, stage""",
    "lr_schedule": f"""WITH {V.SQL_HISTORY}, {V.sql_series('learning_rate')},
      m AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY run_id, stage ORDER BY seq)) > 1e-8 AS moved
            FROM series WHERE n > 1)
      SELECT run_id, stage, round(arg_min(value, idx), 9) AS initial_lr, round(arg_max(value, idx), 9) AS final_lr,
        count(*) FILTER (moved) AS lr_changes, round(arg_max(value, idx) / arg_min(value, idx), 9) AS lr_decay_ratio
      FROM m GROUP BY run_id, stage""",
    "loss_divergence": f"""WITH {V.SQL_HISTORY}, {V.sql_series('loss', nan=True)},
      a AS (SELECT *, avg(value) OVER w AS m, max(CASE WHEN isnan(value) THEN 1 ELSE 0 END) OVER w AS bad FROM series
            WINDOW w AS (PARTITION BY run_id, stage ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
      SELECT run_id, stage, seq, CASE WHEN bad = 1 THEN CAST('NaN' AS DOUBLE) ELSE round(m, 9) END AS recent_avg,
        idx >= 9 AND (isnan(value) OR isinf(value) OR (bad = 0 AND value > m * 2)) AS diverged FROM a""",
    "stepwise_divergence": f"""WITH {V.SQL_HISTORY}, {V.sql_series('loss', nan=True)},
      p AS (SELECT *, lag(value) OVER (PARTITION BY run_id, stage ORDER BY seq) AS previous FROM series),
      j AS (SELECT *, coalesce(NOT isnan(value) AND NOT isnan(previous) AND value > previous * 10, false) AS jumped FROM p)
      SELECT run_id, stage, seq, round(previous, 9) AS previous, jumped, isnan(value) OR isinf(value) AS not_finite,
        CASE WHEN jumped THEN round(learning_rate * 0.5, 9) END AS suggested_lr FROM j""",
    "patience": f"""WITH {V.SQL_HISTORY}, {V.sql_series('loss', nan=True)},
      c AS (SELECT *, CASE WHEN isnan(value) THEN CAST('inf' AS DOUBLE) ELSE value END AS v FROM series),
      b AS (SELECT *, coalesce(min(v) OVER (PARTITION BY run_id, stage ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST('inf' AS DOUBLE)) AS before FROM c),
      l AS (SELECT *, max(CASE WHEN v < before THEN idx END) OVER (PARTITION BY run_id, stage ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last, avg(value) OVER w AS m,
              max(CASE WHEN isnan(value) THEN 1 ELSE 0 END) OVER w AS bad FROM b
            WINDOW w AS (PARTITION BY run_id, stage ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
      SELECT run_id, stage, seq, round(least(before, v), 9) AS best, idx - coalesce(last, -1) AS patience_counter,
        CASE WHEN idx >= 9 THEN CASE WHEN bad = 1 THEN CAST('NaN' AS DOUBLE) ELSE round(m, 9) END END AS recent_avg FROM l""",
    "reward_stopping": _stopping("utilisation", 0.001, 3, V.num(0.0)),
    "rl_stopping": _stopping("loss", 5.0, 40, "CAST('-inf' AS DOUBLE)"),
    "run_compare": f"""WITH {V.SQL_HISTORY}, {_LAST} SELECT metric,
      {', '.join(f'round(max(current) FILTER (run_id = {r}), 9) AS "{r}"' for r in range(4))}
      FROM current WHERE run_id IN (0, 1, 2, 3) GROUP BY metric""",
    "config_diff": f"""WITH {V.SQL_CONFIG} SELECT k, run_id, v FROM config
      WHERE k IN (SELECT k FROM config GROUP BY k HAVING count(DISTINCT v) > 1)""",
    "run_fingerprint": f"""WITH {V.SQL_CONFIG} SELECT run_id,
      sha256(concat('{{', string_agg(concat('"', k, '":"', v, '"'), ',' ORDER BY k), '}}')) AS fingerprint
      FROM config GROUP BY run_id""",
    "series_long": f"""WITH {V.SQL_HISTORY}, l AS (
        SELECT run_id, stage, seq, 'loss' AS metric, loss AS value FROM history
        UNION ALL SELECT run_id, stage, seq, 'grad_norm', grad_norm FROM history
        UNION ALL SELECT run_id, stage, seq, 'learning_rate', learning_rate FROM history)
      SELECT run_id, stage, seq, metric, round(value, 9) AS value FROM l WHERE value IS NOT NULL AND NOT isnan(value)""",
    "memory_peaks": f"""WITH {V.SQL_HISTORY} SELECT run_id, stage, round(max(memory_gb), 6) AS peak_memory_gb,
      count(memory_gb) AS samples FROM history GROUP BY run_id, stage""",
    "memory_alerts": f"WITH {V.SQL_HISTORY} SELECT run_id, stage, seq FROM history WHERE utilisation > 0.95",
    "memory_thinned": f"""WITH {V.SQL_HISTORY} SELECT run_id, seq, step, round(memory_gb, 6) AS memory_gb FROM history
      WHERE step % 50 = 0""",
    "progress_eta": """WITH r AS (SELECT concat('run', user_id % 12) AS operation, user_id % 12 AS u, event_id AS seq,
        event_id % 400 AS c, CASE WHEN user_id % 12 <> 5 THEN 400 END AS t, value * 2 AS e FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id % 12 ORDER BY event_id DESC) = 1)
      SELECT operation, c AS current_step, round(c * 100.0 / t, 6) AS percent,
        CASE WHEN c > 0 THEN round(e / c, 6) END AS seconds_per_step,
        CASE WHEN c > 0 THEN round((t - c) * (e / c), 6) END AS eta_seconds FROM r""",
    "metric_keys": f"""WITH {V.SQL_HISTORY} SELECT seq,
      concat(stage, '/', CASE WHEN seq % 2 = 0 THEN 'loss' ELSE 'grad_norm' END) AS metric_key,
      CASE WHEN seq % 2 = 0 THEN 'loss' ELSE 'grad_norm' END AS metric FROM history""",
    "numeric_results": """WITH r AS (SELECT event_id, event_type, concat('k', user_id % 3) AS k,
        TRY_CAST(CASE event_id % 3 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN 'n/a' ELSE props END AS DOUBLE) AS v
        FROM events)
      SELECT event_id, concat(event_type, '/eval_', k) AS metric_key, v AS number FROM r WHERE v IS NOT NULL""",
    "stage_performance": f"""WITH {V.SQL_HISTORY}, {_STAGE_PERF} SELECT run_id, stage, rows, final_step,
      round(final_loss, 9) AS final_loss, round(final_learning_rate, 9) AS final_learning_rate,
      round(final_grad_norm, 9) AS final_grad_norm,
      CASE WHEN losses > 1 THEN round((first_loss - latest_loss) / first_loss * 100, 9) END AS loss_improvement_pct FROM perf""",
    "run_performance": f"""WITH {V.SQL_HISTORY}, l AS (SELECT *, {_LOSS} AS ok FROM history),
      p AS (SELECT run_id, string_agg(DISTINCT stage, ',' ORDER BY stage) AS stages, max(step) AS total_steps,
        count(*) AS rows, count(ok) AS losses, stddev_samp(ok) AS s, min(ok) AS best,
        arg_min(ok, seq) FILTER (ok IS NOT NULL) AS f, arg_max(ok, seq) FILTER (ok IS NOT NULL) AS l FROM l GROUP BY run_id)
      SELECT run_id, stages, total_steps, rows, losses, round(best, 9) AS best_loss, round(l, 9) AS final_loss,
        CAST(len(string_split(stages, ',')) AS INT) AS stages_completed, round(abs(l - f) / losses, 9) AS convergence_rate,
        round(1 / (1 + s), 9) AS stability_score FROM p""",
    "baseline_compare": f"""WITH {V.SQL_HISTORY}, {_LAST},
      m AS (SELECT avg({_LOSS}) AS loss, avg(grad_norm) AS grad_norm, avg(learning_rate) AS learning_rate FROM history),
      b AS (SELECT 'loss' AS metric, loss AS baseline FROM m UNION ALL SELECT 'grad_norm', grad_norm FROM m
            UNION ALL SELECT 'learning_rate', learning_rate FROM m)
      SELECT metric, run_id, round(current, 6) AS current, round(baseline, 6) AS baseline,
        round((baseline - current) / baseline * 100, 6) AS improvement_pct, (baseline - current) / baseline > 0 AS better
      FROM current JOIN b USING (metric)""",
    "training_report": f"""WITH {_rolled('loss')}, {_CONVERGED}, {_STAGE_PERF},
      lr AS (SELECT *, abs(learning_rate - lag(learning_rate) OVER (PARTITION BY run_id, stage ORDER BY seq)) > 1e-8 AS moved
             FROM history),
      lrs AS (SELECT run_id, stage, count(*) FILTER (moved) AS lr_changes FROM lr GROUP BY run_id, stage
             HAVING count(learning_rate) > 1),
      g AS (SELECT run_id, stage, count(*) FILTER (grad_norm > 10) AS exploding_gradients FROM history GROUP BY run_id, stage
            HAVING count(grad_norm) > {W}),
      s AS (SELECT run_id, stage, arg_max(rs, idx) AS final_std, regr_slope(value, idx) AS trend_slope FROM rolled GROUP BY ALL)
      SELECT run_id, stage, perf.rows, round(final_loss, 6) AS final_loss, round(final_std, 6) AS final_std,
        round(trend_slope, 6) AS trend_slope, exploding_gradients, lr_changes, convergence_index
      FROM perf LEFT JOIN s USING (run_id, stage) LEFT JOIN conv USING (run_id, stage)
        LEFT JOIN g USING (run_id, stage) LEFT JOIN lrs USING (run_id, stage)""",
    "provenance_rollup": f"""WITH {V.SQL_HISTORY} SELECT run_id, stage, round(min({_LOSS}), 6) AS best_metric,
      round(arg_max({_LOSS}, seq) FILTER ({_LOSS} IS NOT NULL), 6) AS final_loss, count(*) AS total_steps,
      min(ts) AS start_time, max(ts) AS end_time, true AS completed FROM history GROUP BY run_id, stage""",
    "stage_completion": f"""WITH {V.SQL_HISTORY}, {_STAGES} SELECT run_id, stage, fault, fault IS NULL AS passed,
      NOT isnan(l) AND NOT isinf(l) AND l > 100 AS high_loss FROM judged""",
    "run_rollup": f"""WITH {V.SQL_HISTORY}, {_STAGES} SELECT run_id, count(*) FILTER (fault IS NULL) AS completed_stages,
      count(*) FILTER (fault IS NOT NULL) AS failed_stages, round(sum(d), 6) AS total_duration_seconds,
      round(max(m), 6) AS peak_memory_gb, CAST(sum(c) AS BIGINT) AS metrics_count FROM judged GROUP BY run_id""",
    "error_stats": f"""WITH {V.SQL_ERRORS}, u AS (SELECT 'total' AS dimension, 'all' AS entry, recovered FROM errors
        UNION ALL SELECT 'category', category, recovered FROM errors UNION ALL SELECT 'severity', severity, recovered FROM errors)
      SELECT dimension, entry, count(*) AS errors, count(*) FILTER (recovered) AS recovered,
        round(count(*) FILTER (recovered) / count(*), 6) AS recovery_rate FROM u GROUP BY ALL""",
    "recovery_by_strategy": f"""WITH {V.SQL_ERRORS} SELECT category AS strategy,
      count(*) FILTER (recovered) AS success_count, count(*) FILTER (NOT recovered) AS failure_count,
      round(count(*) FILTER (recovered) / count(*), 6) AS success_rate FROM errors GROUP BY category""",
    "recent_errors": f"""WITH {V.SQL_ERRORS} SELECT count(*) AS recent_errors FROM errors
      WHERE ts > (SELECT max(ts) FROM errors) - INTERVAL 1 HOUR""",
    "last_errors": f"""WITH {V.SQL_ERRORS} SELECT event_id, category, severity FROM errors
      ORDER BY event_id DESC LIMIT 10""",
}
ORACLES["fingerprint_match"] = f"""WITH f AS ({ORACLES['run_fingerprint']})
  SELECT run_id, fingerprint = (SELECT fingerprint FROM f ORDER BY run_id LIMIT 1) AS matches FROM f"""
