"""Connected components of a link table, by repeated contraction of a scrambled order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored


def _scrambled(df: DataFrame, col: str) -> DataFrame:
    """Replace a long by an xor-shift of it, a bijection: contraction by the smaller key then needs few rounds
    whatever the order of the ids along a chain."""
    def step(c: Column, shift, n: int) -> Column:
        return c.bitwiseXOR(shift(c, n))

    for shift, n in ((F.shiftleft, 13), (F.shiftrightunsigned, 7), (F.shiftleft, 17)) * 2:
        df = df.withColumn(col, step(F.col(col), shift, n))
    return df


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``label`` (smallest node of its component) for every node of ``edges`` (long a, b).

    Each round maps every node to the smallest key among itself and its neighbours and contracts the links; a
    star is done after one round, a chain shrinks by a constant factor.  Hub rows are pre-aggregated before
    their shuffle and joins on a hub are left to AQE's skew splitting.  Null ends drop the link; self links
    only name their node.  Nothing is collected; a round ends with an emptiness test.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stored(_scrambled(nodes.withColumn("key", F.col("node")), "key"), "labels")
    links = stored(_scrambled(_scrambled(edges.where("a <> b"), "a"), "b").distinct(), "links")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        to = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("key"), F.least("a", "b").alias("to")), "to")
        links = stored(
            links.join(to.toDF("a", "ta"), "a").join(to.toDF("b", "tb"), "b").where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "links")
        labels = stored(labels.join(to, "key", "left").select("node", F.coalesce("to", "key").alias("key")), "labels")
    smallest = labels.groupBy("key").agg(F.min("node").alias("label"))
    return labels.join(smallest, "key").select("node", "label")
