"""Entry points for a user's own Python: row maps, predicates and metric callbacks.

Everything runs on Arrow batches inside tasks. None of them gathers a group: a metric callback
returns additive parts per batch, which Spark sums, or keeps a state of its own that is merged in a tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pickle
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignlake.operators import ordering
from alignlake.session import written

FAN_IN = 64
STATES = 10_000


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Rows produced by ``fn`` from each batch of rows; ``fn`` may drop or add rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def keep_where(df: DataFrame, fn: Callable[..., pd.Series], columns: Sequence[str]) -> DataFrame:
    """Rows for which ``fn`` of the named columns is true."""

    @F.pandas_udf("boolean")
    def verdict(values: pd.DataFrame) -> pd.Series:
        return fn(*[values[c] for c in columns])

    return df.filter(verdict(F.struct(*columns)))


def additive_metric(df: DataFrame, fn: Callable[[pd.DataFrame], dict[str, float]], parts: Sequence[str],
                    keys: Sequence[str] = ()) -> DataFrame:
    """Sums of the parts that ``fn`` returns for each batch, per key when keys are given.

    Ratios such as accuracy follow from the sums. The callback sees the rows of one key at a time.
    """
    keys, parts = list(keys), list(parts)
    types = dict(df.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], *[f"`{p}` double" for p in parts]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups = batch.groupby(keys, dropna=False, sort=False) if keys else [((), batch)]
            rows = []
            for key, rows_of_key in groups:
                sums = fn(rows_of_key)
                rows.append([*(key if isinstance(key, tuple) else (key,)), *[float(sums[p]) for p in parts]])
            yield pd.DataFrame(rows, columns=[*keys, *parts])

    return df.mapInPandas(run, schema).groupBy(*keys).agg(*[F.sum(p).alias(p) for p in parts])


class Metric(Protocol):
    """A user's metric. States travel as bytes, so they should stay small."""

    def init(self) -> Any: ...

    def update(self, state: Any, rows: pd.DataFrame) -> Any: ...

    def merge(self, state: Any, other: Any) -> Any: ...

    def finish(self, state: Any) -> dict[str, Any]: ...


def merged_metric(df: DataFrame, metric: Metric, schema: str, keys: Sequence[str] = (), fan_in: int = FAN_IN) -> DataFrame:
    """What ``metric`` makes of the rows of each key, in the columns of ``schema``.

    Every task updates one state per key as its batches come, so no rows are shuffled or gathered. The states of a key are then merged
    ``fan_in`` at a time, round by round in tasks of their own, until one is left and finished. Merging must not depend on the order.
    """
    keys = list(keys)
    types = dict(df.dtypes)
    named = [f"`{k}` {types[k]}" for k in keys]
    states = ", ".join([*named, "part bigint, state binary"])

    def update(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple[tuple, Any]] = {}

        def out() -> pd.DataFrame:
            return pd.DataFrame([[*key, 0, pickle.dumps(state)] for key, state in held.values()], columns=[*keys, "part", "state"])

        for batch in batches:
            for key, rows in batch.groupby(keys, dropna=False, sort=False) if keys else [((), batch)]:
                key = key if isinstance(key, tuple) else (key,)
                plain = tuple(None if pd.isna(k) else k for k in key)
                state = held[plain][1] if plain in held else metric.init()
                held[plain] = (plain, metric.update(state, rows.reset_index(drop=True)))
            if len(held) >= STATES:
                yield out()
                held.clear()
        if held:
            yield out()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        first, *others = (pickle.loads(s) for s in group["state"])
        for other in others:
            first = metric.merge(first, other)
        row = group.iloc[:1].copy()
        row["state"] = [pickle.dumps(first)]
        return row

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = pd.DataFrame([metric.finish(pickle.loads(s)) for s in batch["state"]], index=batch.index)
            yield pd.concat([batch[keys], done], axis=1)

    partial = df.mapInPandas(update, states).withColumn("part", F.monotonically_increasing_id())
    partial = written(ordering.with_index(written(partial, "states"), "part", keys, name="_place"), "states").withColumn("part", F.col("_place")).drop("_place")
    while (partial.agg(F.max("part")).first()[0] or 0) > 0:
        group = partial.withColumn("part", F.floor(F.col("part") / fan_in).cast("bigint"))
        partial = written(group.groupBy(*keys, "part").applyInPandas(merge, states), "states")
    return partial.mapInPandas(finish, ", ".join([*named, schema]))


def roc_area(df: DataFrame, label: str, score: str, keys: Sequence[str] = (), rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """(keys, positives, negatives, roc_area): how often a positive row scores above a negative one, ties half.

    Equal scores are counted first; the negatives below each score are a running total over ranges of scores, so neither a frequent
    score nor a large key is gathered. Without rows of both kinds the area is NULL; rows without label or score are left out.
    """
    keys = list(keys)
    value = F.col(score).cast("double")
    counts = written(df.filter(F.col(label).isNotNull() & value.isNotNull() & ~F.isnan(value)).groupBy(*keys, value.alias("_score")).agg(
        F.count_if(F.col(label)).alias("_pos"), F.count_if(~F.col(label)).alias("_neg")), "score-counts")
    ranked = ordering.with_running_total(counts, "_score", keys, weight=F.col("_neg"), name="_below", rows_per_bucket=rows_per_bucket)
    sums = ranked.groupBy(*keys).agg(F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"),
                                     F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2)).alias("_wins"))
    return sums.select(*keys, "positives", "negatives", F.try_divide(F.col("_wins"), F.col("positives") * F.col("negatives")).alias("roc_area"))


def expand_rows(df: DataFrame, handler: type, schema: str, columns: Sequence[str], keep_empty: bool = False) -> DataFrame:
    """The rows that a user's table function makes of each row, beside the columns of that row.

    ``handler`` is a class with ``eval(*values)`` that yields tuples of ``schema``, once per row; values and results travel in Arrow batches. Rows without
    results leave, unless ``keep_empty`` keeps them with nulls.
    """
    table = F.udtf(handler, returnType=schema, useArrow=True)
    arguments: list[Column] = [F.col(c).outer() for c in columns]
    return df.lateralJoin(table(*arguments), on=F.lit(True), how="left") if keep_empty else df.lateralJoin(table(*arguments))
