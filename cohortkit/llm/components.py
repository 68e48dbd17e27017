"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import saved


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of links ``(a, b)`` with ``a > b``; links may come out repeated.

    Large star: every node's larger neighbours are linked to the least node
    around it. Small star: its smaller neighbours and itself are.
    """
    # the aggregate and the join read one shuffle: the join's filters on its side alone would make it two
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    flipped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = (links.unionByName(flipped) if large else links).repartition("a")
    least = around.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("low"))
    joined = around.join(least, F.col("a") == F.col("node"))
    if large:
        # low <= a: named here so that the filter stays above the join
        return joined.where(F.col("b") > F.greatest("a", "low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    # a node's link to its least is among those kept here: ``a`` itself and its other neighbours
    out = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    return out.where(F.col("a") != F.col("b"))


def _settled(links: DataFrame) -> bool:
    """Whether every node is linked to one smaller node, which is linked to none: each
    component is a star around its smallest node then, and a contraction changes nothing."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e"))
    of = ends.groupBy("e.node").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("least"))
    return of.where((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("least") == 0))).isEmpty()


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for the nodes of the links ``(a, b)``: the smallest node each can reach.

    Every round is written to the shared checkpoint folder. Nodes without a
    link to another are not listed.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where(F.col("a") != F.col("b")).distinct(), "links")
    for _ in range(max_rounds):
        if _settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        edges = saved(_star(_star(edges, large=True), large=False).distinct(), "links")
    raise RuntimeError("components did not settle")
