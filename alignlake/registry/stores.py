"""Registered queries that write a table, read it back and return what a reader sees."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.functions import chat
from alignlake.operators import evaluation, normalize, reports, tokens, validate
from alignlake.plans import jobs
from alignlake.registry import views as V
from alignlake.registry.encoding import LENGTH, VOCABULARY_SIZE
from alignlake.session import work_path, written
from alignlake.sources import readers, writers

METRICS = "seq bigint, run_id bigint, stage string, step bigint, loss double, grad_norm double, learning_rate double"


def _metrics(spark, sf):
    return V.history(spark, sf).select("seq", "run_id", "stage", "step", "loss", "grad_norm", "learning_rate")


def _exported(spark, sf, fmt):
    path = writers.export_table(_metrics(spark, sf), work_path(spark, f"metrics-{fmt}"), fmt)
    return V.rounded(writers.read_export(spark, path, fmt, METRICS), 9)


def metrics_csv_roundtrip(spark, sf):
    return _exported(spark, sf, "csv")


def metrics_json_roundtrip(spark, sf):
    return _exported(spark, sf, "json")


def metrics_parquet_roundtrip(spark, sf):
    return _exported(spark, sf, "parquet")


def chat_lines_roundtrip(spark, sf):
    path = writers.export_table(V.chats(spark, sf).select("conv_id", "messages"), work_path(spark, "chats"), "json")
    lines = readers.load_table(spark, path, "json", schema=f"conv_id bigint, messages {chat.MESSAGES_TYPE}")
    return normalize.rendered(lines).select("conv_id", "text")


def split_table_head(spark, sf):
    root = work_path(spark, "split-documents")
    docs = V.documents(spark, sf).withColumn("split", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train"))
    docs.write.partitionBy("split").parquet(root)
    train = readers.load_table(spark, root, split="train", max_rows=200, order_by=["doc_id"])
    return train.select("doc_id", "lang", "split")


def fallback_load(spark, sf):
    found = readers.load_first(spark, [f"{sf}/no_such_table.parquet", f"{sf}/documents.parquet"])
    return found.groupBy("lang").agg(F.count("*").alias("rows"))


def cached_load(spark, sf):
    cache = readers.TableCache(spark)
    cache.get(f"{sf}/documents.parquet")
    rows = cache.get(f"{sf}/documents.parquet").groupBy("source").agg(F.count("*").alias("rows"))
    rows = written(rows.withColumn("tables", F.lit(len(cache))), "cached-counts")
    cache.clear()
    return rows


def evaluation_document(spark, sf):
    scored = evaluation.with_scores(V.responses(spark, sf))
    benchmark = evaluation.two_turn_scores(V.exchanges(spark, sf).withColumn("category", F.lit("writing")))
    trials = evaluation.latency_trials(V.events(spark, sf).selectExpr(*V.TRIALS))
    report = jobs.evaluation_report("improved", scored, benchmark, trials)
    path = writers.write_documents(report, work_path(spark, "report"))
    back = writers.read_documents(spark, path, report.schema)
    return back.select("model_name", F.inline("statistics")).select("model_name", "topic", "measure", "rows")


def snapshot_roundtrip(spark, sf):
    root = work_path(spark, "snapshots")
    manifest = writers.write_snapshot(root, "first", {"metrics": _metrics(spark, sf), "config": V.config(spark, sf)})
    back = writers.read_snapshot(spark, root, "first", "metrics")
    counts = back.groupBy("run_id").agg(F.count("*").alias("rows"))
    return counts.withColumn("tables", F.lit(manifest.count()))


def provenance_roundtrip(spark, sf):
    stages = reports.provenance_rollup(V.history(spark, sf)).drop("start_time", "end_time")
    path = writers.write_documents(stages, work_path(spark, "provenance"))
    return V.rounded(writers.read_documents(spark, path, stages.schema))


def training_shards(spark, sf):
    df = V.chats(spark, sf)
    rows = written(validate.successful(jobs.process_chats(df, jobs.vocabulary_of(df, "chat", VOCABULARY_SIZE), LENGTH)), "chats")
    batches = tokens.collate(tokens.with_batch(rows, "conv_id", 4, rows_per_bucket=V.ROWS_PER_BUCKET))
    path = writers.write_shards(batches, work_path(spark, "shards"), shards=4)
    back = readers.load_table(spark, path)
    width = F.size(F.get("input_ids", F.lit(0)))
    return back.select("batch_id", "batch_rows", width.alias("width"))


QUERIES = {f.__name__: f for f in (
    metrics_csv_roundtrip, metrics_json_roundtrip, metrics_parquet_roundtrip, chat_lines_roundtrip, split_table_head,
    fallback_load, cached_load, evaluation_document, snapshot_roundtrip, provenance_roundtrip, training_shards)}

_METRICS = f"""WITH {V.SQL_HISTORY} SELECT seq, run_id, stage, step, round(loss, 9) AS loss,
  round(grad_norm, 9) AS grad_norm, round(learning_rate, 9) AS learning_rate FROM history"""
_LOSS = "nullif(loss, CAST('NaN' AS DOUBLE))"

ORACLES = {
    "metrics_csv_roundtrip": _METRICS,
    "metrics_json_roundtrip": _METRICS,
    "metrics_parquet_roundtrip": _METRICS,
    "chat_lines_roundtrip": f"WITH {V.SQL_CHATS} SELECT conv_id, text FROM chats",
    "split_table_head": """SELECT doc_id, lang, 'train' AS split FROM documents WHERE doc_id % 5 <> 0
      ORDER BY doc_id LIMIT 200""",
    "fallback_load": "SELECT lang, count(*) AS rows FROM documents GROUP BY lang",
    "cached_load": "SELECT source, count(*) AS rows, CAST(1 AS INT) AS tables FROM documents GROUP BY source",
    "evaluation_document": f"""WITH {V.SQL_EXCHANGES},
      b AS (SELECT count(*) AS n FROM (SELECT conv_id FROM exchanges GROUP BY conv_id HAVING count(*) >= 2)),
      p AS (SELECT count(*) AS n FROM (SELECT DISTINCT event_id % 3, user_id % 3 FROM events)),
      m(topic, measure) AS (VALUES {', '.join(f"('quality', '{d}')" for d in evaluation.DIMENSIONS)},
        ('benchmark', 'turn_1_score'), ('benchmark', 'turn_2_score'), ('benchmark', 'average_score'),
        ('performance', 'tokens_per_second'), ('performance', 'memory_usage_mb'), ('performance', 'latency_ms'))
      SELECT 'improved' AS model_name, topic, measure, CASE topic WHEN 'quality' THEN (SELECT count(*) FROM documents)
        WHEN 'benchmark' THEN (SELECT n FROM b) ELSE (SELECT n FROM p) END AS rows FROM m""",
    "snapshot_roundtrip": f"""WITH {V.SQL_HISTORY} SELECT run_id, count(*) AS rows, CAST(2 AS INT) AS tables
      FROM history GROUP BY run_id""",
    "provenance_roundtrip": f"""WITH {V.SQL_HISTORY} SELECT run_id, stage, round(min({_LOSS}), 6) AS best_metric,
      round(arg_max({_LOSS}, seq) FILTER ({_LOSS} IS NOT NULL), 6) AS final_loss, count(*) AS total_steps,
      true AS completed FROM history GROUP BY run_id, stage""",
    "training_shards": f"""WITH {V.SQL_CHATS},
      n AS (SELECT conv_id, least(len({V.sql_tokens('text')}), {LENGTH}) AS n FROM chats),
      b AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // 4 AS batch_id FROM n WHERE n >= 3)
      SELECT batch_id, CAST(count(*) AS INT) AS batch_rows, CAST(max(n) AS INT) AS width FROM b GROUP BY batch_id""",
}
