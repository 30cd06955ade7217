"""Connected components by alternating stars, written down between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.session import cut_lineage


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and component (its smallest node) for every node of ``edges`` (a, b); nulls and loops are no edges.

    Each round hands the larger neighbours of a node to its smallest one, then the smaller ones; paths
    shorten by half at least. A node with very many neighbours is grouped by partial minima, and its
    joins are left to adaptive splitting. It ends when a round changes nothing.
    """
    now = cut_lineage(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(now)
    for _ in range(rounds):
        now = cut_lineage(_small(_large(now)))
        before, mark = mark, _mark(now)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components were not settled after {rounds} rounds")
    tops = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return out.union(least.select("a", F.col("m").alias("b"))).distinct()
