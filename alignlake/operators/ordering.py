"""Row positions and row windows that hold when one series owns a large share of the table.

A plain ``Window.partitionBy(series).orderBy(seq)`` sends a whole series to one task. The helpers
here cut the order key into ranges of about equally many rows, so no (series, bucket) group exceeds the
bucket size, number the rows with per-bucket counts, and then run frame windows over fixed-length chunks of row
positions. Rows at chunk borders are copied into the neighbouring chunk so frames stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alignlake.session import written

ROWS_PER_BUCKET = 1_000_000
CHUNK_ROWS = 500_000
# Every range is a task and a file. Beyond so many, a range holds so many rows at least, however small a bucket the caller names.
FEW_RANGES = 128
RANGE_ROWS = 50_000


def _columns(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


def with_bucket(df: DataFrame, order_by: str | Sequence[str], bucket: str = "_bucket",
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add a bucket number that grows with the order key; buckets hold about equally many rows.

    The table is range-partitioned once on the key, of any type and any number of columns, and stored with the number of
    its range. As many ranges are made as the rows need, without a limit; beyond ``FEW_RANGES`` of them a range holds
    ``RANGE_ROWS`` rows or more, so that tasks and files stay few where ``rows_per_bucket`` is small.
    """
    rows = df.count()
    buckets = min(-(-rows // rows_per_bucket), max(FEW_RANGES, -(-rows // RANGE_ROWS)))
    if buckets <= 1:
        return df.withColumn(bucket, F.lit(0))
    ranged = df.repartitionByRange(buckets, *_columns(order_by)).withColumn(bucket, F.spark_partition_id())
    return written(ranged, "ranges")


def with_running_total(df: DataFrame, order_by: str | Sequence[str], keys: Sequence[str] = (), weight: Column | None = None,
                       name: str = "idx", total: str | None = None,
                       rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Sum of ``weight`` over all earlier rows of the series (exclusive, so the first row gets 0).

    ``order_by`` names one or more columns of any orderable type that together are unique inside a series (rows with equal keys
    lie in one range and get positions in no further order). Ranges are cut by order and keys, so one place of many series, such as
    the first turn of all conversations, is spread over many ranges. ``total`` names an optional column for the sum over the whole series.
    """
    keys = list(keys)
    amount = F.lit(1).cast("bigint") if weight is None else weight
    weighed = (
        with_bucket(df, [*_columns(order_by), *(k for k in keys if k not in _columns(order_by))], rows_per_bucket=rows_per_bucket)
        .withColumn("_weight", amount)
        .withColumn("_group", F.struct(*keys, "_bucket"))
    )
    per_bucket = weighed.groupBy("_group").agg(F.sum("_weight").alias("_bucket_total"))
    series = [F.col("_group")[k] for k in keys]
    earlier = (Window.partitionBy(*series).orderBy(F.col("_group")["_bucket"])
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_bucket.select(
        "_group", F.coalesce(F.sum("_bucket_total").over(earlier), F.lit(0)).alias("_offset"),
        *([F.sum("_bucket_total").over(Window.partitionBy(*series)).alias(total)] if total else []),
    )
    inside = Window.partitionBy("_group").orderBy(*_columns(order_by)).rowsBetween(Window.unboundedPreceding, -1)
    return (
        weighed.join(offsets, "_group")
        .withColumn(name, F.coalesce(F.sum("_weight").over(inside), F.lit(0)) + F.col("_offset"))
        .drop("_bucket", "_weight", "_offset", "_group")
    )


def with_index(df: DataFrame, order_by: str | Sequence[str], keys: Sequence[str] = (), name: str = "idx",
               total: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add the 0-based position of each row inside its series, and on request the series length."""
    return with_running_total(df, order_by, keys, name=name, total=total, rows_per_bucket=rows_per_bucket)


class Chunks:
    """Indexed rows cut into chunks of consecutive positions, ready for frame windows.

    ``before`` and ``after`` give how many neighbours a frame may look at; that many border rows are
    copied into the adjacent chunk. ``finish`` drops the copies again.
    """

    def __init__(self, indexed: DataFrame, keys: Sequence[str], before: int = 0, after: int = 0,
                 chunk_rows: int = CHUNK_ROWS, index: str = "idx"):
        size = max(chunk_rows, before, after, 1)
        position = F.col(index) % size
        home = F.floor(F.col(index) / size).cast("bigint")
        places = [F.struct(home.alias("chunk"), F.lit(True).alias("home"))]
        if before:
            places.append(F.when(position >= size - before, F.struct(
                (home + 1).alias("chunk"), F.lit(False).alias("home"))))
        if after:
            places.append(F.when((position < after) & (home > 0), F.struct(
                (home - 1).alias("chunk"), F.lit(False).alias("home"))))
        self.keys = [*keys, "_chunk"]
        placed = indexed.withColumn("_place", F.explode(F.array_compact(F.array(*places))))
        self.rows = placed.select(
            *[F.col(c) for c in indexed.columns],
            F.col("_place.chunk").alias("_chunk"), F.col("_place.home").alias("_home"),
        )
        self.window = Window.partitionBy(*self.keys).orderBy(index)

    def last(self, rows: int):
        """Frame of the current row and the ``rows - 1`` before it."""
        return self.window.rowsBetween(-(rows - 1), 0)

    def finish(self, df: DataFrame, keep_chunk: bool = False) -> DataFrame:
        done = df.filter("_home").drop("_home")
        return done if keep_chunk else done.drop("_chunk")


def with_neighbour(df: DataFrame, order_by: str, keys: Sequence[str], columns: dict[str, str], offset: int = 1,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add columns of the row ``offset`` places later (earlier when negative) in the same series."""
    indexed = with_index(df, order_by, keys, name="_idx", rows_per_bucket=rows_per_bucket)
    chunks = Chunks(indexed, keys, before=max(0, -offset), after=max(0, offset),
                    chunk_rows=rows_per_bucket, index="_idx")
    shifted = chunks.rows.select("*", *[
        (F.lead(c, offset) if offset > 0 else F.lag(c, -offset)).over(chunks.window).alias(out)
        for c, out in columns.items()
    ])
    return chunks.finish(shifted).drop("_idx")


def attach_group_values(df: DataFrame, keys: Sequence[str], parts: dict[str, Column],
                        totals: dict[str, Column]) -> DataFrame:
    """Give every row of a chunked series aggregates of the whole series.

    ``parts`` are aggregated per (series, chunk) and must be mergeable; ``totals`` combine the part
    columns per series. The join back is on (series, chunk), so a large series is never one join key.
    """
    keys = list(keys)
    grouped = df.withColumn("_group", F.struct(*keys, "_chunk"))
    per_chunk = grouped.groupBy("_group").agg(*[e.alias(n) for n, e in parts.items()])
    series = Window.partitionBy(*[F.col("_group")[k] for k in keys])
    values = per_chunk.select("_group", *[e.over(series).alias(n) for n, e in totals.items()])
    return grouped.join(values, "_group").drop("_group")


def salted_join(large: DataFrame, small: DataFrame, keys: Sequence[str], salt_from: Sequence[str],
                salts: int = 64) -> DataFrame:
    """Inner join that splits frequent keys: the small side is repeated per salt, large rows spread over them."""
    spread = large.withColumn("_salt", F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*keys, "_salt"]).drop("_salt")


def median_by_counts(df: DataFrame, value: str, keys: Sequence[str] = (), upper: bool = False,
                     rows_per_bucket: int = ROWS_PER_BUCKET, name: str = "median") -> DataFrame:
    """Exact median per group from value counts; ``upper`` takes the higher of two middle values.

    Equal values are counted before any ordering, so neither a frequent value nor a large group is
    gathered in one task. The counts are stored, so the table itself is read once.
    """
    keys = list(keys)
    counts = written(df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(
        F.count("*").alias("_n")), "value-counts")
    ranked = with_running_total(counts, "_v", keys, weight=F.col("_n"), name="_from", total="_size",
                                rows_per_bucket=rows_per_bucket)
    high = F.floor(F.col("_size") / 2)
    low = high if upper else F.floor((F.col("_size") - 1) / 2)

    def covers(rank: Column) -> Column:
        return (F.col("_from") <= rank) & (rank < F.col("_from") + F.col("_n"))

    middle = ranked.filter(covers(low) | covers(high))
    return middle.groupBy(*keys).agg(
        ((F.max(F.when(covers(low), F.col("_v"))) + F.max(F.when(covers(high), F.col("_v")))) / 2).alias(name))
