"""Gapless numbers in a global order, without a window over all rows of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gevel.session import cut_lineage


def number(rows: DataFrame, group: str, *order: str, name: str = "number") -> DataFrame:
    """Adds the place of each row, from 0, in its group's order.

    Rows are dealt by ranges of (group, order); a range knows its rows' places, and the counts of the
    ranges, one row for each range and group, give the offsets. Groups of any size are spread.
    """
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    at = F.monotonically_increasing_id()
    placed = cut_lineage(dealt.withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)))
    ranges = placed.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    out = placed.join(ranges, [group, "_part"])
    return out.withColumn(name, F.col("_at") + F.col("_offset")).drop("_at", "_part", "_offset")
