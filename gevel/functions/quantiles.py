"""Exact quantiles that never bring a whole group to one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gevel.functions.rows import by_merge
from gevel.session import cut_lineage

#: distinct values that one task orders, parts a range is divided into, and rounds at most
MOST, PARTS, ROUNDS = 1000, 1024, 400


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], count: str | None = None, most: int = MOST,
) -> DataFrame:
    """Linear-interpolated quantiles per group, NULL values ignored; one column per entry.

    ``count`` names a column with the number of rows per value, where they are already counted.

    Equal values are counted first and written once. ``narrowed`` gives the ranges of values that hold the wanted
    ranks, of at most ``most`` distinct values each, and only those are ordered value by value. So no
    task has more of a group than that, wherever its values lie.
    """
    known = df.filter(F.col(value).isNotNull())
    if count is None:
        counted = known.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    else:
        counted = known.select(*keys, F.col(value).alias("_v"), F.col(count).alias("_c"))
    counted = cut_lineage(counted)
    ranges = narrowed(counted, keys, probs, most)
    order = Window.partitionBy(*keys, "_lo").orderBy("_v")
    picked = _within(counted, ranges.drop("_ranks", "_d"), keys).withColumn("_end", F.col("_below") + F.sum("_c").over(order))
    picked = picked.withColumn("_start", F.col("_end") - F.col("_c"))
    out = []
    for name, p in probs.items():
        lo, hi = (_rank(p, kind) for kind in (F.floor, F.ceil))
        for end, r in (("lo", lo), ("hi", hi)):
            out.append(F.max(F.when((r >= F.col("_start")) & (r < F.col("_end")), F.col("_v"))).alias(f"_{name}_{end}"))
        out.append(F.max((F.col("_n") - 1) * F.lit(float(p)) - lo).alias(f"_{name}_f"))
    found = picked.groupBy(*keys).agg(*out)
    return found.select(*keys, *[(F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_f")).alias(n) for n in probs])


def _rank(p: float, kind):
    return kind((F.col("_n") - 1) * F.lit(float(p)))


def _within(counted: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counted.join(by_merge(ranges), list(keys)).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def narrowed(counted: DataFrame, keys: Sequence[str], probs: Mapping[str, float], most: int = MOST) -> DataFrame:
    """The ranges of values of ``counted`` (keys, _v, _c) that hold the ranks of the quantiles: keys, _n, _lo, _hi, _below, _d, _ranks.

    A range of more than ``most`` distinct values (``_d``) is cut into equal parts; the rows in each are counted, with
    partial sums before the shuffle, and the parts that hold a wanted rank go on, shrunk to the values in them.
    """
    stats = counted.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.count("*").alias("_d"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = F.array_distinct(F.array(*[_rank(p, kind) for p in probs.values() for kind in (F.floor, F.ceil)]))
    ranges = stats.select(*keys, "_n", "_lo", "_hi", F.lit(0).cast("long").alias("_below"), "_d", wanted.alias("_ranks"))
    done = []
    for _ in range(ROUNDS):
        ranges = cut_lineage(ranges)
        done.append(ranges.where(F.col("_d") <= most))
        wide = ranges.where(F.col("_d") > most)
        if wide.isEmpty():
            break
        share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1))
        inside = _within(counted, wide.drop("_d"), keys).groupBy(*keys, "_lo", part.alias("_part"))
        parts = inside.agg(
            F.sum("_c").alias("_m"), F.count("*").alias("_d"), F.min("_v").alias("_first"), F.max("_v").alias("_last"),
            *[F.first(c).alias(c) for c in ("_n", "_below", "_ranks")],
        )
        upto = F.col("_below") + F.sum("_m").over(Window.partitionBy(*keys, "_lo").orderBy("_part"))
        parts = parts.withColumn("_upto", upto)
        mine = F.filter("_ranks", lambda r: (r >= F.col("_upto") - F.col("_m")) & (r < F.col("_upto")))
        ranges = parts.withColumn("_ranks", mine).where(F.size("_ranks") > 0).select(
            *keys, "_n", F.col("_first").alias("_lo"), F.col("_last").alias("_hi"), (F.col("_upto") - F.col("_m")).alias("_below"), "_d", "_ranks"
        )
    else:
        raise RuntimeError(f"ranges were not narrow after {ROUNDS} rounds; are there infinite values?")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
