"""Registered queries that run as file streams until everything available is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignlake.functions import patterns
from alignlake.operators import normalize, tokens, validate
from alignlake.registry import encoding
from alignlake.registry import views as V
from alignlake.sources import readers
from alignlake.session import work_path, written
from alignlake.streaming import jobs, stateful


PARTS, FILES = 3, 2


def _stream(spark, sf, name, part, newest_first=True):
    """The table as a stream of several parts, one per micro-batch, of ``FILES`` files each; ``part`` is the SQL number of a row's part."""
    df, root = V.table(spark, sf, name), work_path(spark, f"stream-{name}")
    for k in sorted(range(PARTS), reverse=newest_first):
        df.filter(f"{part} = {k}").repartition(FILES).write.mode("append").parquet(root)
    return readers.stream_table(spark, root, df.schema, files_per_batch=FILES)


def stream_filter(spark, sf):
    docs = _stream(spark, sf, "documents", f"doc_id % {PARTS}").select("doc_id", "lang", "text")
    return jobs.drain(docs.filter(~patterns.is_harmful(F.col("text"))).select("doc_id", "lang"), "clean-documents")


def stream_head(spark, sf):
    kept = jobs.drain(jobs.capped(_stream(spark, sf, "documents", f"doc_id % {PARTS}").select("doc_id"), 100), "head")
    return kept.agg(F.countDistinct("doc_id").alias("rows"))


def stream_reason_counts(spark, sf):
    docs = _stream(spark, sf, "documents", f"doc_id % {PARTS}").select(
        "doc_id", F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("messages"))
    judged = validate.length_filter_reason(normalize.rendered(docs), max_length=512)
    return jobs.running_counts(judged, ["reason"], "reasons")


def stream_error_windows(spark, sf):
    errors = _stream(spark, sf, "events", f"event_id % {PARTS}").filter("event_type = 'error'").select("ts")
    windows = jobs.windowed_counts(errors, "windows", late_by=None)
    return windows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                          F.col("window_end").cast("timestamp_ntz").alias("window_end"), "errors")


def stream_monitor(spark, sf):
    # a series must arrive in its own order, so the files follow the event number
    last = V.events(spark, sf).agg(F.max("event_id")).first()[0]
    points = _stream(spark, sf, "events", f"least({PARTS - 1}, event_id * {PARTS} div {last + 1})", newest_first=False).selectExpr(*V.HISTORY)
    return V.rounded(jobs.drain(jobs.monitor(points), "monitor").drop("loss"))


def stream_batches(spark, sf):
    # a micro-batch is two files: its rows are dealt over all cores before they grow into tokens
    dealt = _stream(spark, sf, "documents", f"doc_id % {PARTS}").select("doc_id", "text").repartition(spark.sparkContext.defaultParallelism)
    docs = dealt.select("doc_id", tokens.text.tokens(F.col("text")).alias("tokens"))
    rows = docs.select("doc_id", F.transform("tokens", lambda t: F.length(t)).alias("input_ids")).select(
        "doc_id", "input_ids", F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"),
        F.col("input_ids").alias("labels"))
    batches = jobs.shuffled_batches(rows, "doc_id", 16, "stream-batches")
    return batches.select(F.col("micro_batch").cast("int").alias("micro_batch"), "batch_id", "batch_rows", F.size(F.get("input_ids", F.lit(0))).alias("width"))


def _monitored(spark, sf):
    last = V.events(spark, sf).agg(F.max("event_id")).first()[0]
    # the newest events come first: everything waits until the end
    points = _stream(spark, sf, "events", f"least({PARTS - 1}, event_id * {PARTS} div {last + 1})").selectExpr(*V.HISTORY)
    return stateful.monitor_any_order(points, late_by=last + 1, rows_per_bucket=V.ROWS_PER_BUCKET)


def stream_monitor_any_order(spark, sf):
    judged, _ = _monitored(spark, sf)
    return V.rounded(judged.drop("loss"))


def stream_monitor_late(spark, sf):
    """Files in shuffled parts: what comes more than 100 events behind the newest one is late."""
    points = _stream(spark, sf, "events", f"event_id div 7 % {PARTS}").selectExpr(*V.HISTORY)
    judged, late = stateful.monitor_any_order(points, late_by=LATE, rows_per_bucket=V.ROWS_PER_BUCKET)
    return judged.agg(F.count("*").alias("judged")).join(late.agg(F.count("*").alias("late"), F.min("seq").alias("first_late"), F.max("seq").alias("last_late")))


def stream_shuffle_buffer(spark, sf):
    docs = _stream(spark, sf, "documents", f"doc_id % {PARTS}").select("doc_id")
    out = stateful.shuffle_buffer(docs, "doc_id", BUFFER, rows_per_bucket=V.ROWS_PER_BUCKET)
    return out.select("doc_id", F.col("micro_batch").cast("int").alias("micro_batch"), "position")


def stream_observed_counts(spark, sf):
    events = _stream(spark, sf, "events", f"event_id % {PARTS}")
    metrics = {"rows": F.count("*"), "errors": F.count_if(F.col("event_type") == "error"), "users": F.sum("user_id")}
    _, counters = stateful.observed_batches(events, metrics, build=lambda b: b.filter("event_type = 'error'").select("event_id"))
    return stateful.running_totals(counters, list(metrics)).withColumn("micro_batch", F.col("micro_batch").cast("int"))


def stream_sample(spark, sf):
    docs = _stream(spark, sf, "documents", f"doc_id % {PARTS}").select("doc_id", "lang", "text")
    return stateful.stream_sample(docs, "doc_id", 50).select("doc_id", "lang")


def stream_late_windows(spark, sf):
    errors = _stream(spark, sf, "events", f"event_id % {PARTS}").filter("event_type = 'error'").select("ts")
    windows, late = stateful.counted_windows(errors, late_by=3 * 86400.0)
    total = windows.agg(F.count("*").alias("windows"), F.sum("errors").alias("errors"))
    lost = late.select(F.col("micro_batch").cast("int").alias("micro_batch"), "late_rows")
    return lost.join(total)


def stream_prepared(spark, sf):
    pairs = written(V.pairs(spark, sf), "pairs")
    vocab = encoding.jobs.vocabulary_of(pairs, "preference", encoding.VOCABULARY_SIZE)
    root = work_path(spark, "stream-pairs")
    for k in range(PARTS):
        pairs.filter(f"pair_id % {PARTS} = {k}").repartition(2).write.parquet(f"{root}/part={k}")
    stream = readers.stream_table(spark, f"{root}/part=*", pairs.schema, files_per_batch=2)
    rows, _, _ = stateful.prepare_stream(stream, "preference", encoding.LENGTH, vocab, error_share=0.5)
    return rows.select("pair_id", "chosen_length", "rejected_length", "chosen_token_count", "rejected_token_count")


LATE, BUFFER = 100, 200


QUERIES = {f.__name__: f for f in (
    stream_monitor_any_order, stream_monitor_late, stream_shuffle_buffer, stream_observed_counts, stream_sample, stream_late_windows, stream_filter, stream_head, stream_reason_counts, stream_error_windows, stream_monitor, stream_batches, stream_prepared)}

def _place(batch: int) -> str:
    return f"row_number() OVER (ORDER BY CAST(concat('0x', substr(md5(concat('{42 + batch}|', doc_id)), 1, 15)) AS BIGINT), doc_id) - 1"


ORACLES = {
    "stream_filter": f"SELECT doc_id, lang FROM documents WHERE NOT {V.sql_harmful('text')}",
    "stream_head": "SELECT least(100, count(*)) AS rows FROM documents",
    "stream_reason_counts": f"""WITH r AS (SELECT CASE
        WHEN length({V.sql_render(V.q('user'), 'text')}) > 2048 THEN 'too_long_examples' ELSE 'valid_examples' END AS reason
        FROM documents) SELECT reason, count(*) AS rows FROM r GROUP BY reason""",
    "stream_error_windows": """WITH e AS (SELECT ts FROM events WHERE event_type = 'error'),
      w AS (SELECT unnest(range(time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 55 MINUTE,
              time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE, INTERVAL 5 MINUTE)) AS s FROM e)
      SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS errors FROM w GROUP BY s""",
    "stream_monitor": f"""WITH {V.SQL_HISTORY}, {V.sql_series('loss', nan=True)},
      a AS (SELECT *, avg(value) OVER w AS m, max(CASE WHEN isnan(value) THEN 1 ELSE 0 END) OVER w AS bad,
              CASE WHEN isnan(value) THEN CAST('inf' AS DOUBLE) ELSE value END AS v FROM series
            WINDOW w AS (PARTITION BY run_id, stage ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
      b AS (SELECT *, coalesce(min(v) OVER (PARTITION BY run_id, stage ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST('inf' AS DOUBLE)) AS before FROM a)
      SELECT run_id, stage, seq, idx >= 9 AND (isnan(value) OR (bad = 0 AND value > m * 2)) AS diverged,
        round(least(before, v), 6) AS best, idx - coalesce(max(CASE WHEN v < before THEN idx END) OVER (
          PARTITION BY run_id, stage ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1)
          AS patience_counter FROM b""",
    "stream_monitor_late": f"""WITH {V.SQL_HISTORY},
      h AS (SELECT seq, {PARTS - 1} - seq // 7 % {PARTS} AS b FROM history WHERE loss IS NOT NULL),
      m AS (SELECT b, max(max(seq)) OVER (ORDER BY b) - 100 AS mark FROM h GROUP BY b),
      j AS (SELECT h.seq, coalesce(h.seq <= m.mark, false) AS late FROM h LEFT JOIN m ON m.b = h.b - 1)
      SELECT count(*) FILTER (NOT late) AS judged, count(*) FILTER (late) AS late, min(seq) FILTER (late) AS first_late,
        max(seq) FILTER (late) AS last_late FROM j""",
    "stream_shuffle_buffer": f"""WITH RECURSIVE d AS (SELECT doc_id, {PARTS - 1} - doc_id % {PARTS} AS b FROM documents),
      s0 AS (SELECT doc_id, {_place(0)} AS p, count(*) OVER () AS n FROM d WHERE b = 0),
      s1 AS (SELECT doc_id, {_place(1)} AS p, count(*) OVER () AS n FROM (
        SELECT doc_id FROM d WHERE b = 1 UNION ALL SELECT doc_id FROM s0 WHERE p >= n - 200)),
      s2 AS (SELECT doc_id, {_place(2)} AS p, count(*) OVER () AS n FROM (
        SELECT doc_id FROM d WHERE b = 2 UNION ALL SELECT doc_id FROM s1 WHERE p >= n - 200)),
      s3 AS (SELECT doc_id, {_place(3)} AS p FROM s2 WHERE p >= n - 200)
      SELECT doc_id, 0 AS micro_batch, p AS position FROM s0 WHERE p < n - 200 UNION ALL SELECT doc_id, 1, p FROM s1 WHERE p < n - 200
      UNION ALL SELECT doc_id, 2, p FROM s2 WHERE p < n - 200 UNION ALL SELECT doc_id, 3, p FROM s3""",
    "stream_observed_counts": f"""WITH b AS (SELECT {PARTS - 1} - event_id % {PARTS} AS b, count(*) AS n, count(*) FILTER (event_type = 'error') AS e,
        sum(user_id) AS u FROM events GROUP BY 1)
      SELECT CAST(b AS INT) AS micro_batch, CAST(sum(n) OVER w AS BIGINT) AS rows, CAST(sum(e) OVER w AS BIGINT) AS errors,
        CAST(sum(u) OVER w AS BIGINT) AS users FROM b WINDOW w AS (ORDER BY b)""",
    "stream_sample": f"""SELECT doc_id, lang FROM documents
      ORDER BY CAST(concat('0x', substr(md5(concat('42|', doc_id)), 1, 15)) AS BIGINT), doc_id LIMIT 50""",
    "stream_late_windows": f"""WITH e AS (SELECT ts, {PARTS - 1} - event_id % {PARTS} AS b FROM events WHERE event_type = 'error'),
      m AS (SELECT b, max(max(ts)) OVER (ORDER BY b) - INTERVAL 3 DAY AS mark FROM e GROUP BY b),
      j AS (SELECT e.ts, e.b, coalesce(e.ts <= m.mark, false) AS late FROM e LEFT JOIN m ON m.b = e.b - 1),
      w AS (SELECT unnest(range(time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 55 MINUTE,
              time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE, INTERVAL 5 MINUTE)) AS s FROM j WHERE NOT late)
      SELECT CAST(b AS INT) AS micro_batch, count(*) FILTER (late) AS late_rows, (SELECT count(DISTINCT s) FROM w) AS windows,
        (SELECT count(*) FROM w) AS errors FROM j GROUP BY b""",
    "stream_batches": f"""WITH t AS (SELECT len({V.sql_tokens('text')}) AS n, 2 - doc_id % 3 AS m, row_number() OVER (
        PARTITION BY doc_id % 3 ORDER BY CAST(concat('0x', substr(md5(concat('42|', doc_id)), 1, 15)) AS BIGINT)) - 1 AS r FROM documents)
      SELECT CAST(m AS INT) AS micro_batch, r // 16 AS batch_id, CAST(count(*) AS INT) AS batch_rows, CAST(max(n) AS INT) AS width
      FROM t GROUP BY 1, 2""",
}
ORACLES["stream_prepared"] = f"""SELECT pair_id, chosen_length, rejected_length, chosen_token_count, rejected_token_count FROM ({encoding.ORACLES["processed_pairs"]})"""
ORACLES["stream_monitor_any_order"] = ORACLES["stream_monitor"]
