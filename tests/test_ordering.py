"""Positions, frames, neighbours and medians under a series that holds most of the rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from alignlake.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = [(key, q, float(rng.randint(0, 40))) for key, n in (("hot", 3000), ("a", 200), ("b", 1), (None, 20))
            for q in rng.sample(range(10**6), n)]
    return spark.createDataFrame(rows, "key string, q bigint, v double").cache()


@pytest.mark.parametrize("rows_per_bucket", [10**6, 111])
def test_index_counts_rows_of_each_series(skewed, rows_per_bucket):
    got = ordering.with_index(skewed, "q", ["key"], total="n", rows_per_bucket=rows_per_bucket).toPandas()
    assert len(got) == 3221
    want = got.groupby("key", dropna=False)["q"].rank(method="first").astype(int) - 1
    assert (got["idx"] == want).all()
    assert (got["n"] == got.groupby("key", dropna=False)["q"].transform("size")).all()


def test_buckets_bound_a_hot_series(skewed):
    sizes = ordering.with_bucket(skewed, "q", rows_per_bucket=100).groupBy("key", "_bucket").count()
    assert sizes.agg(F.max("count")).first()[0] < 250


def test_global_index_and_ties_of_the_key(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("tied"))
    unique = ordering.with_index(df, "id", rows_per_bucket=64)
    assert unique.filter("idx <> id").count() == 0
    tied = ordering.with_index(df, "tied", rows_per_bucket=64)
    assert sorted(r.idx for r in tied.collect()) == list(range(1000))


def test_string_and_composite_keys(spark):
    df = spark.range(500).select("id", F.concat(F.lit("k"), "id").alias("name"), (F.col("id") % 7).alias("part"))
    by_name = ordering.with_index(df, "name", rows_per_bucket=40)
    assert [r.name for r in sorted(by_name.collect(), key=lambda r: r.idx)] == sorted(f"k{i}" for i in range(500))
    both = ordering.with_index(df, ["part", "name"], rows_per_bucket=40)
    assert [(r.part, r.name) for r in sorted(both.collect(), key=lambda r: r.idx)] == sorted((i % 7, f"k{i}") for i in range(500))


def test_chunk_frames_equal_plain_frames(skewed):
    indexed = ordering.with_index(skewed, "q", ["key"], rows_per_bucket=111)
    chunks = ordering.Chunks(indexed, ["key"], before=9, after=4, chunk_rows=50)
    got = chunks.finish(chunks.rows.withColumn("m", F.avg("v").over(chunks.window.rowsBetween(-9, 4))))
    plain = Window.partitionBy("key").orderBy("q").rowsBetween(-9, 4)
    assert got.count() == skewed.count()
    assert got.withColumn("p", F.avg("v").over(plain)).filter("abs(m - p) > 1e-9 OR m IS NULL").count() == 0


@pytest.mark.parametrize("offset", [1, -2])
def test_neighbour(skewed, offset):
    got = ordering.with_neighbour(skewed, "q", ["key"], {"v": "near"}, offset, rows_per_bucket=60)
    w = Window.partitionBy("key").orderBy("q")
    want = F.lead("v", offset).over(w) if offset > 0 else F.lag("v", -offset).over(w)
    assert got.withColumn("want", want).filter("NOT (near <=> want)").count() == 0
    assert got.count() == skewed.count()


@pytest.mark.parametrize("values, low, high", [
    ([1, 2, 3, 4], 2.5, 3), ([5], 5, 5), ([1, 1, 1, 9], 1, 1), ([3, 1, 2], 2, 2)])
def test_medians(spark, values, low, high):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert ordering.median_by_counts(df, "v", rows_per_bucket=1).first().median == low
    assert ordering.median_by_counts(df, "v", upper=True, rows_per_bucket=1).first().median == high


def test_median_per_group(skewed):
    got = {r.key: r.median for r in ordering.median_by_counts(skewed, "v", ["key"], rows_per_bucket=5).collect()}
    pdf = skewed.toPandas()
    for key in ("hot", "a", "b"):
        assert got[key] == pdf[pdf.key == key].v.median()


def test_group_values_reach_every_row(skewed):
    indexed = ordering.with_index(skewed, "q", ["key"]).withColumn("_chunk", F.floor(F.col("idx") / 100))
    got = ordering.attach_group_values(indexed, ["key"], {"s": F.sum("v")}, {"total": F.sum("s")})
    want = pd.Series({k: g.v.sum() for k, g in skewed.toPandas().groupby("key")})
    seen = got.groupBy("key").agg(F.min("total").alias("lo"), F.max("total").alias("hi"), F.count("*").alias("n"))
    for r in seen.filter("key IS NOT NULL").collect():
        assert r.lo == r.hi == want[r.key]
    assert got.count() == skewed.count()


def test_small_buckets_do_not_make_a_task_for_every_few_rows(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("id"))
    assert ordering.with_bucket(df, "id", rows_per_bucket=10).select("_bucket").distinct().count() <= ordering.FEW_RANGES
    assert ordering.with_index(df, "id", rows_per_bucket=10).filter("idx <> id").count() == 0
