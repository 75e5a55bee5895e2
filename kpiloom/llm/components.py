"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and an equi-join;
the link table never grows beyond its first size, and nothing reaches the
driver but two numbers a round. A node with very many links is split by the
adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: a > b, distinct. Link the larger (or else smaller) neighbours of each node to its smallest one."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        to = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        to = edges.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return to.where("a > b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
    return tuple(row)


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """node, component: the smallest node that each linked node reaches. Nodes without links have no row."""
    edges = written(links.where(F.col(one) != F.col(other)).select(F.greatest(one, other).alias("a"), F.least(one, other).alias("b")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = written(_star(_star(edges, True), False), "links")
        if (now := _state(edges)) == state:
            break
        state = now
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(edges.select(F.col("b"), F.col("b")).distinct())
