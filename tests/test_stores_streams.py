"""Sources, sinks, the cache, and streams compared with the batch result."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from alignlake.operators import ordering, telemetry, tokens
from alignlake.session import shared_folder, work_path, written
from alignlake.sources import readers, writers
from alignlake.streaming import jobs


class Session:
    """Just the parts of a session that the folder lookup reads."""

    def __init__(self, setting, master, active=None):
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = self
        self.master = master
        self.getCheckpointDir = lambda: active


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert shared_folder(Session("hdfs://x/shared", "yarn")) == "hdfs://x/shared"
    assert work_path(Session("hdfs://x/shared", "yarn"), "t").startswith("hdfs://x/shared/t-")
    assert shared_folder(Session(None, "yarn", "hdfs://set/earlier")) == "hdfs://set/earlier"
    with pytest.raises(ValueError):
        shared_folder(Session(None, "yarn"))


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, "a,b"), (2, None, None)], "i int, v double, t string")
    for fmt in writers.EXPORT_FORMATS:
        path = writers.export_table(df, str(tmp_path / fmt), fmt.upper())
        assert writers.read_export(spark, path, fmt, "i int, v double, t string").exceptAll(df).count() == 0
    assert writers.export_table(df.limit(0), str(tmp_path / "none"), "csv") == ""
    with pytest.raises(ValueError):
        writers.export_table(df, str(tmp_path / "x"), "xlsx")


def test_loading(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("split", F.when(F.col("id") < 6, "train").otherwise("test")).write.partitionBy("split").parquet(path)
    train = readers.load_table(spark, path, split="train")
    assert train.count() == 6 and "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in readers.load_table(spark, path, max_rows=2, order_by=[F.desc("id")]).collect()] == [9, 8]
    with pytest.raises(ValueError):
        readers.load_table(spark, path, max_rows=2)
    assert readers.load_first(spark, [str(tmp_path / "no"), path]).count() == 10
    assert readers.load_first(spark, [str(tmp_path / "no")]) is None
    cache = readers.TableCache(spark)
    assert cache.get(path) is cache.get(path) and len(cache) == 1
    assert cache.get(path, split="test").count() == 4 and len(cache) == 2
    cache.clear()
    assert len(cache) == 0


def test_spread_only_touches_coarse_scans(spark):
    cores = spark.sparkContext.defaultParallelism
    assert readers.spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == cores
    many = spark.range(0, 1000, 1, 64)
    assert readers.spread(many) is many


def test_snapshot_and_documents(spark, tmp_path):
    df = spark.range(3)
    manifest = writers.write_snapshot(str(tmp_path), "s1", {"a": df, "b": df})
    assert manifest.count() == 2 and writers.read_snapshot(spark, str(tmp_path), "s1", "b").count() == 3
    nested = df.select(F.struct("id").alias("inner"), F.array("id").alias("list"))
    path = writers.write_documents(nested, str(tmp_path / "doc"))
    assert writers.read_documents(spark, path, nested.schema).exceptAll(nested).count() == 0
    assert writers.as_json(nested).first().document == '{"inner":{"id":0},"list":[0]}'
    assert written(df, "t").count() == 3


def test_shards_keep_training_order(spark, tmp_path):
    df = spark.range(20).select("id", F.array(F.lit(1)).alias("input_ids"), F.array(F.lit(1)).alias("attention_mask"),
                                F.array(F.lit(1)).alias("labels"))
    path = writers.write_shards(tokens.collate(tokens.with_batch(df, "id", 2)), str(tmp_path / "s"), 3)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("batch_id").alias("lo"), F.max("batch_id").alias("hi")).orderBy("lo").collect()
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))


@pytest.fixture
def metric_files(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = [(1, "sft", i, float("nan") if i == 31 else 100.0 if i == 25 else 10.0 / (i + 1)) for i in range(60)]
    rows += [(2, "sft", i, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "run_id bigint, stage string, seq bigint, loss double")
    for low in (0, 20, 40):
        df.filter(F.col("seq").between(low, low + 19)).coalesce(1).write.mode("append").parquet(path)
    return path, df


def test_monitor_equals_batch_over_several_micro_batches(spark, metric_files):
    path, df = metric_files
    stream = readers.stream_table(spark, path, df.schema)
    got = jobs.drain(jobs.monitor(stream), "monitor")
    batch = telemetry.running_best(df).select("run_id", "stage", "seq", "best", "patience_counter")
    assert got.select(*batch.columns).exceptAll(batch).count() == 0 and got.count() == 65
    flags = telemetry.loss_divergence(df).select("run_id", "stage", "seq", "diverged")
    assert got.select(*flags.columns).exceptAll(flags).count() == 0


def test_running_counts_and_cap(spark, metric_files):
    path, df = metric_files
    counts = jobs.running_counts(readers.stream_table(spark, path, df.schema), ["run_id"], "counts")
    assert {r.run_id: r.rows for r in counts.collect()} == {1: 60, 2: 5}
    assert jobs.drain(jobs.capped(readers.stream_table(spark, path, df.schema), 7), "cap").count() == 7


def test_stream_batches_cover_all_rows(spark, metric_files):
    path, df = metric_files
    stream = readers.stream_table(spark, path, df.schema).select(
        (F.col("seq") * 10 + F.col("run_id")).alias("id"), F.array(F.lit(1)).alias("input_ids"),
        F.array(F.lit(1)).alias("attention_mask"), F.array(F.lit(1)).alias("labels"))
    got = jobs.shuffled_batches(stream, "id", 8, "batches")
    assert got.agg(F.sum("batch_rows")).first()[0] == 65 and got.agg(F.max("batch_rows")).first()[0] == 8


def test_monitor_adds_up_in_the_order_of_the_rows(spark, tmp_path):
    """Last losses of exactly twice the mean: the flag hangs on the last bit of the sum, so batch and stream must add alike."""
    rnd, rows = random.Random(3), []
    for run in range(400):
        cents = [rnd.randrange(20_000) for _ in range(9)]
        cents[0] += -sum(cents) % 4
        rows += [(run, "sft", i, c / 100) for i, c in enumerate([*cents, sum(cents) // 4])]
    df = spark.createDataFrame(rows, "run_id bigint, stage string, seq bigint, loss double")
    df.write.parquet(str(tmp_path / "ties"))
    got = jobs.drain(jobs.monitor(readers.stream_table(spark, str(tmp_path / "ties"), df.schema, files_per_batch=100)), "monitor")
    flags = telemetry.loss_divergence(df).select("run_id", "stage", "seq", "diverged")
    assert got.select(*flags.columns).exceptAll(flags).count() == 0 and got.count() == 4000


def test_wide_micro_batches_are_put_in_order_by_ranges(spark, tmp_path, monkeypatch):
    rows = spark.range(5000).select("id", *[F.array(F.lit(1)).alias(c) for c in ("input_ids", "attention_mask", "labels")])
    rows.write.parquet(str(tmp_path / "rows"))
    passes, cut = [], ordering.with_bucket

    def counted(df, *args, **kwargs):
        out = cut(df, *args, **kwargs)
        passes.append(out.groupBy("_bucket").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(ordering, "with_bucket", counted)
    got = jobs.shuffled_batches(readers.stream_table(spark, str(tmp_path / "rows"), rows.schema, files_per_batch=100), "id", 16, "wide")
    assert len(passes) == 1 and passes[0] < 4000
    assert sorted(r.batch_id for r in got.collect()) == list(range(313)) and got.agg(F.sum("batch_rows")).first()[0] == 5000


def test_padded_batches_lie_in_small_row_groups(spark, tmp_path, monkeypatch):
    """A reader decodes thousands of rows of a row group at once, so a group of long batches must be short."""
    wide = F.transform(F.sequence(F.lit(1), F.lit(3000)), lambda i: F.pmod(F.hash("id", i), F.lit(50_000)))
    rows = spark.range(4000).select("id", wide.alias("input_ids")).selectExpr("id", "input_ids", "input_ids AS attention_mask", "input_ids AS labels")
    rows.write.parquet(str(tmp_path / "rows"))
    got = jobs.shuffled_batches(readers.stream_table(spark, str(tmp_path / "rows"), rows.schema, files_per_batch=100), "id", 4, "groups")
    files = [f.removeprefix("file://") for f in got.inputFiles()]
    groups = [g.num_rows for f in files for m in [pq.ParquetFile(f).metadata] for g in map(m.row_group, range(m.num_row_groups))]
    assert sum(groups) == 1000 and max(groups) <= 110
