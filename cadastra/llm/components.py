"""Connected components by alternating large-star and small-star rounds, all in distributed joins.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). No edge or label ever reaches the driver; only
two scalars a round do, which tell whether the edges still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import discard, staged


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come with u > v: every u and its smaller neighbours hang on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved)


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(u, v), any order and repeated; returns (node, root) with root the smallest node of the component.

    Rounds go on until one changes nothing; their number grows with the logarithm of the longest path.
    Nodes without an edge to another node do not appear. Self-loops and nulls are ignored. An empty input gives an
    empty result.
    """
    now = staged(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    while mark[0]:
        new = staged(_small_star(_large_star(now).distinct()).distinct(), "edges")
        discard(now)
        now, before, mark = new, mark, _mark(new)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
