"""Point clouds as tables: statistics, roof heights, choice of cloud."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions.quantiles import group_quantiles
from gevel.functions.rows import by_merge, settle
from gevel.operators.spatial import points_in
from gevel.session import cut_lineage

ROOF_CLASS, GROUND_CLASS = 6, 2
# Quality rank given with each cloud (higher is older).
CLOUD_QUALITY = {"AHN3": 2, "AHN4": 1, "AHN5": 0}


def point_stats(points: DataFrame, key: str = "tile_id") -> DataFrame:
    """Count, range, mean and deviation of the coordinates per tile."""
    aggs = [F.count("*").alias("n_points")]
    for c in ("x", "y", "z"):
        aggs += [
            F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
            F.avg(c).alias(f"{c}_avg"), F.stddev_samp(c).alias(f"{c}_stddev"),
        ]
    return points.groupBy(key).agg(*aggs)


def point_stats_json(points: DataFrame, key: str = "tile_id") -> DataFrame:
    """The same as one JSON text per tile."""
    stats = point_stats(points, key)
    return stats.select(key, F.to_json(F.struct(*[c for c in stats.columns if c != key])).alias("info"))


def alike(footprints: DataFrame, id: str) -> tuple[DataFrame, DataFrame]:
    """Distinct geometries (``_shape``, box, ``rings``) and the ``_shape`` of each id.

    Ids with the same footprint, or the same several ones, share a ``_shape``, so points are joined to it once.
    """
    own = footprints.groupBy(id).agg(F.array_sort(F.collect_list(F.struct(*G.BOX, "rings"))).alias("_own"))
    sets = own.groupBy(F.col("_own").alias("_set")).agg(F.min(id).alias("_least"))
    sets = cut_lineage(sets.select("_set", F.struct("_least").alias("_shape")))
    back = own.join(by_merge(sets), F.col("_own") == F.col("_set")).select(id, "_shape")
    return sets.select("_shape", F.inline("_set")), back


def points_and_tiles(points: DataFrame, footprints: DataFrame, id: str, tile: str) -> DataFrame:
    """Number of points, and of different tiles, under the box of each footprint; footprints without points are not listed."""
    shapes, back = alike(footprints, id)
    counted = points_in(points, shapes, "_shape").groupBy("_shape").agg(F.count("*").alias("n_points"), F.countDistinct(tile).alias("n_tiles"))
    return back.join(by_merge(counted), "_shape").drop("_shape")


def roof_heights(
    points: DataFrame, footprints: DataFrame, id: str = "identificatie", by: str | None = None,
    materialise: bool = True,
) -> DataFrame:
    """Roof height 50th/70th percentile, range, ground height and density per building.

    Definitions are ours: roof points are class 6 and ground points class 2 inside the
    footprint polygon; ground height is the median; density is roof points per area.
    ``by`` separates point clouds. ``materialise`` writes the counts per height once, as
    three later steps read them.
    """
    keys = ["_shape"] if by is None else ["_shape", by]
    kinds = [ROOF_CLASS, GROUND_CLASS]
    shapes, back = alike(footprints, id)
    shape = settle(shapes, "_shape", *G.BOX, "rings", G.is_box("rings").alias("_plain"))
    shape = shape.withColumn("rings", F.when(~F.col("_plain"), F.col("rings")))
    inside = points_in(points.filter(F.col("class").isin(*kinds) & F.col("z").isNotNull()), shape, "_shape", keep=["rings", "_plain"])
    inside = inside.filter(F.col("_plain") | G.point_in("rings", "x", "y", boundary=True))
    # everything below reads these counts: one row per building and height, not per point
    counted = inside.groupBy(*keys, "class", "z").agg(F.count("*").alias("n"))
    if materialise:
        counted = cut_lineage(counted)
    mid = group_quantiles(counted, [*keys, "class"], "z", {"p50": 0.5, "p70": 0.7}, count="n")
    ends = counted.groupBy(*keys, "class").agg(F.min("z").alias("low"), F.max("z").alias("high"), F.sum("n").alias("n"))
    both = ends.join(by_merge(mid), [*keys, "class"])
    roof, ground = F.col("class") == ROOF_CLASS, F.col("class") == GROUND_CLASS

    def pick(cond, c: str, name: str):
        return F.max(F.when(cond, F.col(c))).alias(name)

    wide = both.groupBy(*keys).agg(
        pick(roof, "low", "h_roof_min"), pick(roof, "high", "h_roof_max"), pick(roof, "n", "n_roof"),
        pick(roof, "p50", "h_roof_50p"), pick(roof, "p70", "h_roof_70p"), pick(ground, "p50", "h_ground"),
    ).filter("n_roof IS NOT NULL")
    areas = footprints.select(id, G.area("rings").alias("_area"))
    return back.join(by_merge(wide), "_shape").drop("_shape").join(by_merge(areas), id).withColumn(
        "pt_density", F.col("n_roof") / F.nullif(F.col("_area"), F.lit(0.0))
    ).drop("_area")


def best_cloud(stats: DataFrame, id: str = "identificatie") -> DataFrame:
    """The cloud that covers a building best; equal coverage goes to the lower quality rank.

    ``stats(id, cloud, coverage, quality)``. The reason says what decided.
    """
    same = stats.groupBy(id, "coverage").agg(F.count("*").alias("_k"), F.min(F.struct("quality", "cloud")).alias("_first"))
    best = same.groupBy(id).agg(F.max(F.struct("coverage", "_k", "_first")).alias("_b"), F.sum("_k").alias("_n"))
    tied = F.col("_b.coverage").isNotNull() & (F.col("_b._k") > 1)
    reason = F.when(F.col("_n") == 1, "only").when(tied, "quality").otherwise("coverage")
    return best.select(id, F.col("_b._first.cloud").alias("cloud"), F.col("_b.coverage").alias("coverage"), reason.alias("reason"))
