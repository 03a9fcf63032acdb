"""Structured Streaming versions: filters, caps, counters, windows, monitoring and batching.

Stateless steps reuse the batch operators as they are. Results go to files below the shared folder,
never through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from alignlake.operators import sampling, tokens
from alignlake.session import work_path


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream over everything available and return what it wrote."""
    root = work_path(stream.sparkSession, name)
    query = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("path", f"{root}/data").option("checkpointLocation", f"{root}/state").start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/data")


# A reader decodes up to 4096 rows of a row group at once, padded batches to a gigabyte and more: row groups are kept small.
GROUP_BYTES = 4 << 20


def drain_batches(stream: DataFrame, name: str, build: Callable[[DataFrame], DataFrame],
                  mode: str = "append") -> DataFrame:
    """Apply a batch job to every micro-batch. Each batch owns one folder, so a retry replaces it."""
    root = work_path(stream.sparkSession, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = build(batch).write.mode("overwrite").option("parquet.block.size", str(GROUP_BYTES))
        writer.parquet(f"{root}/data/micro_batch={batch_id}")

    query = (
        stream.writeStream.outputMode(mode).trigger(availableNow=True)
        .option("checkpointLocation", f"{root}/state").foreachBatch(write).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{root}/data")


def capped(stream: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows of the whole stream, those that arrive first; 0 or less keeps everything.

    A stream has no order but that of its files, so which rows these are is not defined further.
    """
    return stream.limit(rows) if rows > 0 else stream


def running_counts(stream: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Counters per key while the stream runs; the result is their state after the last micro-batch."""
    written = drain_batches(stream.groupBy(*keys).agg(F.count("*").alias("rows")), name, lambda b: b, "complete")
    newest = written.agg(F.max("micro_batch").alias("m")).scalar()
    return written.filter(F.col("micro_batch") == newest).drop("micro_batch")


def windowed_counts(stream: DataFrame, name: str, late_by: str | None, time: str = "ts", length: str = "1 hour",
                    slide: str = "5 minutes", keys: Sequence[str] = ()) -> DataFrame:
    """Counts per sliding event-time window, open windows included.

    Every micro-batch writes the windows that it changed and the newest count of a window holds. ``late_by`` bounds
    the state: rows later than that no longer count. ``None`` keeps every window and counts every row, however late.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed if late_by is None else timed.withWatermark(time, late_by)
    counted = timed.groupBy(F.window(time, length, slide), *keys).agg(F.count("*").alias("errors")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "errors")
    changes = drain_batches(counted, name, lambda b: b, "update")
    return changes.groupBy("window_start", "window_end", *keys).agg(F.max_by("errors", "micro_batch").alias("errors"))


# Rows with their ids are wide: so many of them lie in one range while a micro-batch is put in order.
ROWS_PER_RANGE = 2_000


def shuffled_batches(stream: DataFrame, row_id: str, batch_size: int, name: str, seed: int = 42,
                     rows_per_bucket: int = ROWS_PER_RANGE) -> DataFrame:
    """Shuffle each micro-batch by hash, cut it into batches and pad them. The micro-batch is the buffer.

    A batch is known by (micro_batch, batch_id): batch numbers start anew in every micro-batch. Places have no gaps, so they
    number the batches as they are, and no task gets a whole micro-batch.
    """
    place = F.col("_position")

    def build(batch: DataFrame) -> DataFrame:
        placed = sampling.with_shuffle_position(batch, row_id, seed, "_position", rows_per_bucket=rows_per_bucket)
        return tokens.collate(placed.withColumns({
            "batch_id": F.floor(place / batch_size).cast("bigint"), "batch_pos": (place % batch_size).cast("int")}).drop("_position"))

    return drain_batches(stream, name, build)


MONITOR_STATE = "recent array<double>, best double, patience long, seen long"


def monitor(stream: DataFrame, run: str = "run_id", stage: str = "stage", seq: str = "seq", loss: str = "loss",
            window: int = 10, factor: float = 2.0) -> DataFrame:
    """Divergence, best loss and patience of every run and stage as its losses arrive.

    State per series is the last ``window`` losses, the best one and two counters, whatever the
    length of the series. Rows of one micro-batch are put in order; later batches must follow earlier
    ones. Each micro-batch is bounded by the source's files-per-batch setting.
    """

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        recent, best, patience, seen = state.get if state.exists else ([], np.inf, 0, 0)
        points = pd.concat(list(frames)).sort_values("seq")
        values = points["loss"].to_numpy(float)
        idx = np.arange(len(values))
        before = np.minimum.accumulate(np.concatenate([[best], np.where(np.isnan(values), np.inf, values)]))
        better = values < before[:-1]
        since = np.maximum.accumulate(np.where(better, idx, -1))
        counter = np.where(since >= 0, idx - since, patience + idx + 1)
        padded = np.concatenate([np.full(max(0, window - len(recent)), np.nan), np.asarray(recent, float)[-window:], values])
        # added up in the order of the rows, as a window function does: another order ends in other last bits
        means = sum(padded[1 + i:1 + i + len(values)] for i in range(window)) / window
        full = seen + idx + 1 >= window
        bad = full & (~np.isfinite(values) | (values > means * factor))
        state.update((padded[-min(window, seen + len(values)):].tolist(), float(before[-1]), int(counter[-1]), int(seen + len(values))))
        yield pd.DataFrame({
            "run_id": key[0], "stage": key[1], "seq": points["seq"].to_numpy(), "loss": values, "diverged": bad,
            "best": before[1:], "patience_counter": counter})

    points = stream.filter(F.col(loss).isNotNull()).select(
        F.col(run).alias("run_id"), F.col(stage).alias("stage"), F.col(seq).alias("seq"), F.col(loss).alias("loss"))
    return points.groupBy("run_id", "stage").applyInPandasWithState(
        follow,
        "run_id bigint, stage string, seq bigint, loss double, diverged boolean, best double, patience_counter bigint",
        MONITOR_STATE, "append", GroupStateTimeout.NoTimeout)
