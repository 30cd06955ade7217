"""Row helpers that keep plans from repeating work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, *cols: Column | str) -> DataFrame:
    """Selects columns so that each is computed once per row.

    A plain select may be merged into later steps and its expressions repeated there,
    which is costly for higher-order functions, regular expressions and JSON parsing;
    the output of a generator is not.
    """
    return df.select(F.inline(F.array(F.struct(*(cols or df.columns)))))


def by_merge(df: DataFrame) -> DataFrame:
    """Side of a join that is never broadcast.

    Spark takes a column of lists for one with a single member, and the rows of an exploded list for one row. A table
    of geometries or grid cells is then sent whole through the driver although it is many times the broadcast limit.
    """
    return df.hint("merge")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt over all cores, ahead of costly work: a small table is otherwise read, or put together again, by one task."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once: named several times, an expression in a lambda is computed each time."""
    return F.transform(F.array(value), f)[0]
