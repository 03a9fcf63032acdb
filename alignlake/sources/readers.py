"""Table loading: splits, row caps, fallbacks, streams and a cache registry."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from alignlake.operators.sampling import head


def spread(df: DataFrame) -> DataFrame:
    """Split a scan that is too coarse for the cores at hand; scans with enough parts stay as they are.

    A table in one small file is one task, however costly the expressions on top. Only such inputs
    pay the shuffle; a table with many files or row groups never does.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to as many tasks as the scan has, and to every core at least.

    For costly work on few coarse files: a row group is never cut, so such a scan has enough parts by its bytes and
    yet rows only in a few of them, where :func:`spread` would leave it.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None,
               split: str | None = None, split_column: str = "split", max_rows: int = 0,
               order_by: Sequence[str | Column] = (), options: dict[str, str] | None = None) -> DataFrame:
    """A chat or preference table. ``split`` filters a (partition) column; ``max_rows`` needs an order."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if split is not None:
        df = df.filter(F.col(split_column) == split)
    if max_rows > 0 and not order_by:
        raise ValueError("a row cap needs an order")
    return head(df, order_by, max_rows) if max_rows > 0 else df


def load_first(spark: SparkSession, paths: Iterable[str], fmt: str = "parquet", **kwargs) -> DataFrame | None:
    """The first path that can be read, or None. Only the schema is probed, no row is read."""
    for path in paths:
        try:
            df = load_table(spark, path, fmt, **kwargs)
            df.schema
            return df
        except AnalysisException:
            continue
    return None


def stream_table(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                 files_per_batch: int = 1, pattern: str | None = None) -> DataFrame:
    """A folder as an unbounded source; ``files_per_batch`` bounds each micro-batch, ``pattern`` picks files."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", str(files_per_batch))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


class TableCache:
    """Loaded tables by their arguments, persisted so several jobs share one scan."""

    def __init__(self, spark: SparkSession, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self._spark = spark
        self._level = level
        self._tables: dict[tuple, DataFrame] = {}

    def get(self, path: str, fmt: str = "parquet", split: str | None = None, max_rows: int = 0,
            order_by: Sequence[str] = ()) -> DataFrame:
        key = (path, fmt, split, max_rows, tuple(order_by))
        if key not in self._tables:
            loaded = load_table(self._spark, path, fmt, split=split, max_rows=max_rows, order_by=order_by)
            self._tables[key] = loaded.persist(self._level)
        return self._tables[key]

    def __len__(self) -> int:
        return len(self._tables)

    def clear(self) -> None:
        for df in self._tables.values():
            df.unpersist()
        self._tables.clear()
