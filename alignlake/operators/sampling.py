"""Heads, even and seeded samples, splits and shuffles. Every operator names its order or id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.operators import ordering


def hash_number(row_id: Column, seed: int = 42) -> Column:
    """A 60-bit number per row that depends on the seed and the id only."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def head(df: DataFrame, order_by: Sequence[str | Column], rows: int) -> DataFrame:
    """First rows in key order; a cap of 0 or less keeps everything."""
    return df.orderBy(*order_by).limit(rows) if rows > 0 else df


def stride_sample(df: DataFrame, order_by: str, rows: int,
                  rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """``rows`` rows at an even stride over the ordered table; a smaller table is kept whole."""
    indexed = ordering.with_index(df, order_by, name="_row", total="_rows", rows_per_bucket=rows_per_bucket)
    step = F.greatest(F.lit(1), F.floor(F.col("_rows") / rows))
    picked = (F.col("_row") % step == 0) & (F.col("_row") < step * rows)
    return indexed.filter(picked).drop("_row", "_rows")


def seeded_sample(df: DataFrame, row_id: str, rows: int, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` rows (or all), chosen by the hash of their id."""
    hashed = df.withColumn("_hash", hash_number(F.col(row_id), seed))
    return hashed.orderBy("_hash", row_id).limit(rows).drop("_hash")


def shuffled(df: DataFrame, row_id: str, seed: int = 42) -> DataFrame:
    """The table in a seeded random order."""
    return df.orderBy(hash_number(F.col(row_id), seed), row_id)


def with_shuffle_position(df: DataFrame, row_id: str, seed: int = 42, out: str = "position",
                          rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """Add the place of each row in the seeded random order."""
    hashed = df.withColumn("_hash", hash_number(F.col(row_id), seed))
    return ordering.with_index(hashed, "_hash", name=out, rows_per_bucket=rows_per_bucket).drop("_hash")


def train_eval_split(df: DataFrame, row_id: str, order_by: str, train_share: float = 0.8, seed: int = 42,
                     mode: str = "hash", rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """Add ``split`` by the rule that the caller names; it never depends on the number of rows.

    ``hash`` needs no shuffle and its sizes are close to the share; ``exact`` ranks the hashes
    and gives the evaluation side exactly the rounded-up rest; ``position`` cuts the ordered table once.
    """
    if mode not in ("hash", "exact", "position"):
        raise ValueError(f"unknown split mode: {mode}")
    if mode == "position":
        indexed = ordering.with_index(df, order_by, name="_row", total="_rows", rows_per_bucket=rows_per_bucket)
        train = F.col("_row") < F.floor(F.col("_rows") * F.lit(train_share))
    elif mode == "exact":
        hashed = df.withColumn("_hash", hash_number(F.col(row_id), seed))
        indexed = ordering.with_index(hashed, "_hash", name="_row", total="_rows",
                                      rows_per_bucket=rows_per_bucket).drop("_hash")
        held_out = F.ceil(F.col("_rows") * F.lit(round(1 - train_share, 9)))
        train = F.col("_row") >= held_out
    else:
        indexed = df.withColumn("_row", F.lit(0)).withColumn("_rows", F.lit(0))
        train = hash_number(F.col(row_id), seed) % 100 < round(train_share * 100)
    return indexed.withColumn("split", F.when(train, "train").otherwise("eval")).drop("_row", "_rows")


def first_findings(df: DataFrame, findings: str, order_by: Sequence[str], rows: int = 10) -> DataFrame:
    """The first (or, with a descending order, last) ``rows`` entries of an array column's findings."""
    listed = df.select(*order_by, F.posexplode(findings).alias("position", "finding"))
    return listed.orderBy(*order_by, "position").limit(rows)
