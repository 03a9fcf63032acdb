"""Streams that remember rows: what they keep between micro-batches are tables, so it may grow and is worked on by many tasks.

A micro-batch reads the tables of the one before it and writes its own, each to a folder named after it. A retried batch finds the same
input and replaces its own folders, so every row counts once. Nothing passes through one task or one state key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from alignlake.operators import ordering, sampling, validate
from alignlake.operators.ordering import ROWS_PER_BUCKET, Chunks
from alignlake.session import work_path
from alignlake.sources import readers

INF = math.inf


class Tables:
    """The tables of a stream, one folder per name and micro-batch."""

    def __init__(self, spark: SparkSession, name: str, root: str | None = None):
        self.spark, self.root = spark, root or work_path(spark, name)

    def write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/micro_batch={batch}")

    def read(self, name: str, batch: int, schema: StructType | str) -> DataFrame:
        """The table that a micro-batch left; empty before the first one."""
        reader = self.spark.read.schema(schema)
        return reader.parquet(f"{self.root}/{name}/micro_batch={batch}") if batch >= 0 else self.spark.createDataFrame([], schema)

    def whole(self, name: str) -> DataFrame:
        """All micro-batches, with the number of each in ``micro_batch``."""
        return self.spark.read.parquet(f"{self.root}/{name}")

    def run(self, stream: DataFrame, step: Callable[[DataFrame, int], None]) -> int:
        """Take every micro-batch that is available; returns the number of the next one."""
        last = -1

        def follow(batch: DataFrame, batch_id: int) -> None:
            nonlocal last
            step(batch, batch_id)
            last = batch_id

        query = (stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{self.root}/checkpoint").foreachBatch(follow).start())
        query.awaitTermination()
        return last + 1


# --- rows in any order ------------------------------------------------------------------------------------------------

class Reorder:
    """Rows of a stream in the order of ``order``, whatever the order they arrive in.

    Rows wait in a stored buffer until the mark has passed them: the highest ``order`` seen so far, less ``late_by`` (in units of
    ``order``; seconds for times). Rows that arrive behind the mark, or without ``order``, go to a side table with the mark that they missed.
    """

    def __init__(self, tables: Tables, order: str, late_by: float):
        self.tables, self.order, self.late_by = tables, order, late_by

    def _place(self) -> Column:
        return F.col(self.order).cast("double")

    def _mark(self, batch: int) -> float:
        row = self.tables.read("marks", batch, "mark double").first()
        return row["mark"] if row else -INF

    def step(self, rows: DataFrame, batch: int, last: bool = False) -> DataFrame:
        """Buffer the rows of a micro-batch; returns those that the mark has passed since the last one."""
        before = self._mark(batch - 1)
        early = self._place() > before
        self.tables.write(rows.filter(early), "buffer", batch)
        self.tables.write(rows.filter(F.coalesce(~early, F.lit(True))).withColumn("missed_mark", F.lit(before)), "late", batch)
        held = self.tables.spark.read.schema(StructType([*rows.schema, StructField("micro_batch", IntegerType())])).parquet(f"{self.tables.root}/buffer")
        seen = self.tables.read("buffer", batch, rows.schema).agg(F.max(self._place()).alias("m")).first()["m"]
        mark = INF if last else max(before, seen - self.late_by if seen is not None else -INF)
        self.tables.write(self.tables.spark.createDataFrame([(mark,)], "mark double").coalesce(1), "marks", batch)
        return held.filter((F.col("micro_batch") <= batch) & (self._place() > before) & (self._place() <= mark)).drop("micro_batch")


CARRY = "seen bigint, best double, at bigint, recent array<double>"


def followed(rows: DataFrame, carry: DataFrame, keys: Sequence[str], window: int = 10, factor: float = 2.0,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(judged rows, new carry): divergence, best loss and patience of new rows of series whose earlier rows are known by ``carry`` only.

    A series is cut into chunks. The lowest loss of a chunk and its place form a summary that merges in order, so the chunks are summed up
    and walked each on its own, and a series with a third of all rows keeps many tasks busy.
    """
    keys = list(keys)
    indexed = ordering.with_index(rows.select(*keys, "seq", "loss"), "seq", keys, name="pos", total="n", rows_per_bucket=rows_per_bucket)
    chunks = Chunks(indexed, keys, before=window - 1, chunk_rows=rows_per_bucket, index="pos")
    value = F.when(F.isnan("loss"), F.lit(INF)).otherwise(F.col("loss"))
    point = F.struct(value.alias("value"), F.col("pos").alias("at"))
    known = carry.select(F.struct(*keys).alias("series"), "seen", F.struct(F.col("best").alias("value"), (F.col("at") - F.col("seen")).alias("at")).alias("known"), "recent")

    lows = chunks.rows.filter("_home").groupBy(F.struct(*keys).alias("series"), "_chunk").agg(F.min(point).alias("low"))
    earlier = Window.partitionBy("series").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    entry = lows.join(known, "series", "left").withColumn("before", F.least(F.min("low").over(earlier), "known")).select(
        "series", "_chunk", "before", "recent", F.coalesce("seen", F.lit(0)).alias("seen"))

    fresh = chunks.rows.select(F.struct(*keys).alias("series"), "_chunk", "_home", "seq", "loss", "pos").join(entry.drop("recent"), ["series", "_chunk"])
    kind = rows.schema["seq"].dataType
    old = entry.filter("_chunk = 0").select(
        "series", "_chunk", F.lit(False).alias("_home"), F.lit(None).cast(kind).alias("seq"), F.posexplode("recent").alias("i", "loss"),
        F.size("recent").alias("size"), "before", "seen").select(
        "series", "_chunk", "_home", "seq", "loss", (F.col("i") - F.col("size")).cast("bigint").alias("pos"), "before", "seen")
    walk = Window.partitionBy("series", "_chunk").orderBy("pos")
    frame = walk.rowsBetween(-(window - 1), 0)
    walked = fresh.unionByName(old).withColumns({
        "low": F.least("before", F.min(F.when(F.col("_home"), point)).over(walk.rowsBetween(Window.unboundedPreceding, 0))),
        "mean": F.avg("loss").over(frame), "full": F.count("loss").over(frame) == window}).filter("_home")
    odd = F.isnan("loss") | (F.abs("loss") == INF)
    judged = walked.select(
        *[F.col(f"series.{k}").alias(k) for k in keys], "seq", "loss", (F.col("full") & (odd | (F.col("loss") > F.col("mean") * factor))).alias("diverged"),
        F.col("low.value").alias("best"),
        F.when(F.col("low.value") < INF, F.col("pos") - F.col("low.at")).otherwise(F.col("seen") + F.col("pos") + 1).alias("patience_counter"))

    keep = window - 1
    ends = indexed.filter(F.col("pos") >= F.col("n") - keep).groupBy(F.struct(*keys).alias("series")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "loss"))), lambda p: p["loss"]).alias("ends"), F.max("n").alias("n"))
    lowest = lows.groupBy("series").agg(F.min("low").alias("low"))
    merged = known.join(ends.join(lowest, "series"), "series", "full")
    seen, all_ends = F.coalesce("seen", F.lit(0)), F.concat(*[F.coalesce(c, F.array().cast("array<double>")) for c in ("recent", "ends")])
    low = F.least("known", "low")
    return judged, merged.select(
        *[F.col(f"series.{k}").alias(k) for k in keys], (seen + F.coalesce("n", F.lit(0))).cast("bigint").alias("seen"),
        low["value"].alias("best"), (low["at"] + seen).alias("at"),
        F.when(F.size(all_ends) > keep, F.slice(all_ends, F.size(all_ends) - keep + 1, F.lit(keep))).otherwise(all_ends).alias("recent"))


def monitor_any_order(stream: DataFrame, late_by: float, name: str = "monitor", run: str = "run_id", stage: str = "stage", seq: str = "seq",
                      loss: str = "loss", window: int = 10, factor: float = 2.0, rows_per_bucket: int = ROWS_PER_BUCKET,
                      root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(judged rows, late rows): what :func:`alignlake.streaming.jobs.monitor` finds, with rows arriving in any order.

    Runs over all that is available, then releases the rows still waiting.
    """
    keys = ["run_id", "stage"]
    points = stream.filter(F.col(loss).isNotNull()).select(
        F.col(run).alias("run_id"), F.col(stage).alias("stage"), F.col(seq).alias("seq"), F.col(loss).cast("double").alias("loss"))
    tables = Tables(stream.sparkSession, name, root)
    order = Reorder(tables, "seq", late_by)
    schema = StructType([*[points.schema[k] for k in keys], *StructType.fromDDL(CARRY)])

    def step(batch: DataFrame, batch_id: int, last: bool = False) -> None:
        ready = order.step(batch, batch_id, last)
        judged, carry = followed(ready, tables.read("carry", batch_id - 1, schema), keys, window, factor, rows_per_bucket)
        tables.write(judged, "judged", batch_id)
        tables.write(carry, "carry", batch_id)

    following = tables.run(points, step)
    step(stream.sparkSession.createDataFrame([], points.schema), following, last=True)
    return tables.whole("judged").drop("micro_batch"), tables.whole("late").drop("micro_batch")


# --- shuffling over micro-batches -------------------------------------------------------------------------------------

def shuffle_buffer(stream: DataFrame, row_id: str, buffer_size: int, name: str = "buffer", seed: int = 42,
                   rows_per_bucket: int = ROWS_PER_BUCKET, root: str | None = None) -> DataFrame:
    """The rows of a stream in a shuffled order, each once: (columns, micro_batch, position).

    ``buffer_size`` rows wait from one micro-batch to the next. Every micro-batch joins the waiting rows, the order of all is drawn
    anew by hash, and the first of them leave until ``buffer_size`` are left; the last step lets all go. Rows leave in
    the order of (micro_batch, position).
    """
    tables = Tables(stream.sparkSession, name, root)

    def step(batch: DataFrame, batch_id: int, last: bool = False) -> None:
        pool = tables.read("waiting", batch_id - 1, batch.schema).unionByName(batch)
        hashed = pool.withColumn("_hash", sampling.hash_number(F.col(row_id), seed + batch_id))
        placed = ordering.with_index(hashed, ["_hash", row_id], name="position", total="_rows", rows_per_bucket=rows_per_bucket).drop("_hash")
        tables.write(placed, "pool", batch_id)
        stored = tables.read("pool", batch_id, placed.schema)
        leaves = F.lit(True) if last else F.col("position") < F.col("_rows") - buffer_size
        tables.write(stored.filter(leaves).drop("_rows"), "out", batch_id)
        tables.write(stored.filter(~leaves).select(batch.columns), "waiting", batch_id)

    following = tables.run(stream, step)
    step(stream.sparkSession.createDataFrame([], stream.schema), following, last=True)
    return tables.whole("out")


# --- watching a stream ------------------------------------------------------------------------------------------------

def observed_batches(stream: DataFrame, metrics: Mapping[str, Column], name: str = "observed", build: Callable[[DataFrame], DataFrame] | None = None,
                     root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, counters): what ``build`` makes of every micro-batch, and its metrics, counted while the rows are written.

    ``metrics`` are aggregates over the rows of a micro-batch as they arrive; no second pass is made for them.
    """
    tables = Tables(stream.sparkSession, name, root)

    def step(batch: DataFrame, batch_id: int) -> None:
        counters = Observation(f"{name}-{batch_id}")
        watched = batch.observe(counters, *[c.alias(n) for n, c in metrics.items()])
        tables.write(build(watched) if build else watched, "rows", batch_id)
        row = counters.get
        kinds = batch.agg(*[c.alias(n) for n, c in metrics.items()]).schema
        tables.write(stream.sparkSession.createDataFrame([tuple(row.get(n) for n in metrics)], kinds).coalesce(1), "counters", batch_id)

    tables.run(stream, step)
    return tables.whole("rows"), tables.whole("counters")


def running_totals(counters: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sums of counters up to and with each micro-batch (one row per micro-batch)."""
    so_far = Window.orderBy("micro_batch").rowsBetween(Window.unboundedPreceding, 0)
    return counters.select("micro_batch", *[F.sum(n).over(so_far).alias(n) for n in names])


def stream_sample(stream: DataFrame, row_id: str, rows: int, name: str = "sample", seed: int = 42, root: str | None = None) -> DataFrame:
    """A look into a stream: the ``rows`` rows of smallest hash of all that has arrived, kept from one micro-batch to the next."""
    tables = Tables(stream.sparkSession, name, root)

    def step(batch: DataFrame, batch_id: int) -> None:
        seen = tables.read("sample", batch_id - 1, batch.schema).unionByName(batch)
        tables.write(sampling.seeded_sample(seen, row_id, rows, seed), "sample", batch_id)

    return tables.read("sample", tables.run(stream, step) - 1, stream.schema)


def counted_windows(stream: DataFrame, late_by: float, name: str = "windows", time: str = "ts", length: str = "1 hour", slide: str = "5 minutes",
                    keys: Sequence[str] = (), root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(windows, late): counts per sliding window, and per micro-batch the rows that came more than ``late_by`` seconds behind the newest one.

    Every micro-batch stores the counts that it adds, so nothing is held in memory and no row is lost without being counted.
    """
    tables = Tables(stream.sparkSession, name, root)
    timed = stream.select(F.col(time).cast("timestamp").alias(time), *keys)

    def step(batch: DataFrame, batch_id: int) -> None:
        row = tables.read("marks", batch_id - 1, "mark double").first()
        before = row["mark"] if row else -INF
        place = F.col(time).cast("double")
        inside = place > before
        counts = batch.filter(inside).groupBy(F.window(time, length, slide), *keys).agg(F.count("*").alias("errors"))
        tables.write(counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "errors"), "counts", batch_id)
        facts = batch.agg(F.max(place).alias("newest"), F.count_if(~inside).alias("late_rows"))
        known = facts.first()
        mark = max(before, known["newest"] - late_by if known["newest"] is not None else -INF)
        one = tables.spark.createDataFrame
        tables.write(one([(mark,)], "mark double").coalesce(1), "marks", batch_id)
        tables.write(one([(known["late_rows"],)], "late_rows bigint").coalesce(1), "late", batch_id)

    tables.run(timed, step)
    windows = tables.whole("counts").groupBy("window_start", "window_end", *keys).agg(F.sum("errors").alias("errors"))
    return windows, tables.whole("late")


# --- preparation of a stream ------------------------------------------------------------------------------------------

def prepare_stream(stream: DataFrame, kind: str, max_length: int, vocab: DataFrame, name: str = "prepared", filter_content: bool = True,
                   error_share: float = 0.05, root: str | None = None) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """(rows, quarantine, gates): the whole preparation of every micro-batch as it arrives.

    A micro-batch with more than ``error_share`` invalid rows goes to quarantine as a whole. Of the others, unsafe rows leave, rejected rows go to
    quarantine with their reason and processed rows that fail their check with ``failed_check``. ``gates`` tells for each micro-batch whether it
    passed; without one that did, ``rows`` is None. A micro-batch is dealt to all cores first, however few files it comes in.
    """
    from alignlake.operators import reports
    from alignlake.plans import jobs

    tables = Tables(stream.sparkSession, name, root)
    process = jobs.process_chats if kind == "chat" else jobs.process_preferences
    check = validate.check_processed_chat if kind == "chat" else validate.check_processed_preference

    def set_aside(rows: DataFrame, reason: Column) -> DataFrame:
        return rows.select(F.to_json(F.struct(*[F.col(c) for c in stream.columns])).alias("row"), reason.alias("reason"))

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = readers.dealt(batch).persist()
        report = reports.validation_report(batch, kind, error_share).first()
        if report["is_valid"]:
            rows = validate.filter_content(batch, kind) if filter_content else batch
            raw = F.struct(*[F.col(c) for c in stream.columns])
            judged = check(process(rows.withColumn("_raw", raw), vocab, max_length).withColumnRenamed("reason", "_reason"), max_length)
            reason = F.when(F.col("_reason") != "successful", F.col("_reason")).when(F.size("errors") > 0, F.lit("failed_check"))
            tables.write(judged.withColumn("_reason", reason).drop("errors", "warnings"), "judged", batch_id)
            stored = stream.sparkSession.read.parquet(f"{tables.root}/judged/micro_batch={batch_id}")
            tables.write(stored.filter("_reason IS NULL").drop("_reason", "_raw"), "rows", batch_id)
            bad = stored.filter("_reason IS NOT NULL").select("_raw.*", "_reason")
            tables.write(set_aside(bad, F.col("_reason")), "quarantine", batch_id)
        else:
            tables.write(set_aside(batch, F.lit("failed_batch")), "quarantine", batch_id)
        facts = [(bool(report["is_valid"]), report["total"], report["invalid"])]
        tables.write(stream.sparkSession.createDataFrame(facts, "passed boolean, total bigint, invalid bigint").coalesce(1), "gates", batch_id)
        batch.unpersist()

    tables.run(stream, step)
    gates = tables.whole("gates")
    rows = None if gates.filter("passed").isEmpty() else tables.whole("rows")
    return rows, tables.whole("quarantine"), gates
