"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, saved


#: Rows that a task writes at least: a small graph, looked at in many steps, is not spread over a file a partition.
ROWS = 20_000


def _few(df: DataFrame, rows: int) -> DataFrame:
    """df, of so many rows at most, in no more partitions than it needs."""
    return df.coalesce(max(1, -(-rows // ROWS)))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b); root is the component's least node.

    Alternates large-star and small-star steps until no edge changes. Each step
    joins edges with a node's least neighbour (a partial aggregate; hot nodes are
    broadcast), never gathers a node's neighbours, and is written to the shared
    folder. Loops and repeated edges are allowed; no edges give no rows.
    """
    a, b = F.col("a"), F.col("b")
    now = saved(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        n = mark[0]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        least = saved(_few(least.select("u", F.least("u", "m").alias("m"), "n"), 2 * n), "least")
        large = join_counted(both, least, ["u"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(_few(large, 2 * n), "large-star")
        low = saved(_few(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), 2 * n), "low")
        small = join_counted(large, low, ["u"]).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        small = small.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        now = saved(_few(small, 4 * n), "small-star")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
