"""Sinks: metric export, report and provenance documents, snapshots, training shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EXPORT_FORMATS = ("csv", "json", "parquet")


def export_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Write a table as csv, json or parquet and return the path; an empty table writes nothing."""
    kind = fmt.lower()
    if kind not in EXPORT_FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    if df.isEmpty():
        return ""
    writer = df.write.mode("errorifexists")
    if kind == "csv":
        writer = writer.option("header", "true")
    writer.format(kind).save(path)
    return path


def read_export(spark: SparkSession, path: str, fmt: str, schema: StructType | str) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("nanValue", "NaN")
    return reader.format(fmt).load(path)


def write_documents(df: DataFrame, path: str) -> str:
    """Nested rows as JSON documents, one per line (evaluation reports, provenance)."""
    df.write.mode("errorifexists").json(path)
    return path


def read_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_snapshot(root: str, snapshot: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Write every table below one snapshot name; the manifest lists them and is written last."""
    first = next(iter(tables.values()))
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/snapshot={snapshot}/{name}")
    manifest = first.sparkSession.createDataFrame(
        [(snapshot, name, f"snapshot={snapshot}/{name}") for name in sorted(tables)],
        "snapshot string, table_name string, location string")
    manifest.write.mode("errorifexists").json(f"{root}/snapshot={snapshot}/manifest")
    return manifest


def read_snapshot(spark: SparkSession, root: str, snapshot: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/snapshot={snapshot}/{table}")


def write_shards(batches: DataFrame, path: str, shards: int | None = None) -> str:
    """Padded batches in training order: files hold consecutive batch numbers."""
    parts = shards or int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = batches.repartitionByRange(parts, "batch_id").sortWithinPartitions("batch_id")
    ordered.write.mode("errorifexists").parquet(path)
    return path


def as_json(df: DataFrame, out: str = "document") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias(out))
