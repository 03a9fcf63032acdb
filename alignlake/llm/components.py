"""Connected components of a link table by repeated contraction, as Spark jobs over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignlake.session import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link to another node.

    Each round maps a node to the smallest node among itself and its neighbours and relabels the links,
    so a chain shrinks by more than a constant factor a round and a star of any size needs two rounds.
    Links of a busy node are aggregated before the shuffle; a skewed join on it can be split. Every round
    is written to the shared folder, which also ends the lineage. Without links the result is empty.
    """
    x, y = F.col(a), F.col(b)
    edges = written(links.filter(x != y).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct(), "edges")
    labels = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    first = True
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("child"), F.least("a", "m").alias("parent")), "parents")
        labels = written(
            parents.select(F.col("child").alias("node"), F.col("parent").alias("component")) if first
            else labels.join(parents, labels.component == parents.child, "left").select(
                "node", F.coalesce("parent", "component").alias("component")), "labels")
        first = False
        edges = written(
            edges.join(parents.select(F.col("child").alias("a"), F.col("parent").alias("pa")), "a")
            .join(parents.select(F.col("child").alias("b"), F.col("parent").alias("pb")), "b")
            .filter("pa != pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    return labels
