"""Connected components of an edge table, by alternating stars.

Every round links each node's larger neighbours to the smallest node it knows
(large star), then each node and its smaller neighbours to the smallest of
them (small star). The components stay the same, the paths shrink, and when a
round changes nothing every edge runs from a node to its component's smallest
node. Rounds grow with the logarithm of the component size. Each round is
written to the shared folder and read back, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roomtide.session import scratch_path


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "edges")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def smallest_nodes(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge but the roots.

    ``edges`` has columns ``a`` and ``b`` of one type with an order; loops and
    repeated edges don't matter.
    """
    edges = _stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = _sum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = _stored(small.where("a != b").distinct())
        after = _sum(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
