"""Input of the reconstruction: repaired current buildings with overlap and label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions import repair as RP
from gevel.functions.rows import settle
from gevel.operators import history as H
from gevel.operators import spatial as S
from gevel.session import cut_lineage


def current_buildings(register: DataFrame, t: Column) -> DataFrame:
    """Current buildings, one polygon each.

    ``geometry`` holds the parts of the registered shape. Every part is repaired; one that
    falls into several polygons, or leaves lines, is no building polygon. A building with
    several polygons, or listed several times, keeps the largest.
    """
    cut = H.snapshot_as_of(register, t, H.EXCLUDED_STATUSES["pand"])
    parts = repair_parts(G.explode_parts(cut, "geometry"))
    parts = G.filter_geometry_type(parts, "POLYGON").withColumn("rings", F.col("parts")[0]).drop("parts", "geometry_type")
    parts = parts.withColumn("_area", G.area("rings"))
    one = H.dedupe(parts, "identificatie", [F.col("_area").desc(), "ogc_fid"])
    cols = [c for c in ("oorspronkelijkbouwjaar", *H.HISTORY_COLUMNS) if c in register.columns]
    return G.with_bbox(one.select(F.col("ogc_fid").alias("fid"), *cols, "rings"))


def repair_parts(df: DataFrame, rings: str = "rings") -> DataFrame:
    """``parts``, the valid polygons of a shape, and ``geometry_type`` instead of its rings; NULL where nothing of area is left."""
    rest = [c for c in df.columns if c != rings]
    tidy = settle(df, *rest, G.normalise(G.force_2d(rings)).alias("_tidy"))
    tidy = settle(tidy, *rest, "_tidy", G.is_box("_tidy").alias("_box"))
    made = tidy.select(*rest, RP.repaired("_tidy", "_box").alias("_made"))
    return made.select(*rest, F.col("_made.parts").alias("parts"), RP.repaired_type("_made").alias("geometry_type"))


def topographic_buildings(layer: DataFrame) -> DataFrame:
    """Topographic buildings with polygon shape, in their typed columns."""
    def short(c: str, n: int) -> Column:
        return F.substring(F.col(c).cast("string"), 1, n).alias(c)

    casts = {
        "bronactualiteit": "date", "bronbeschrijving": "string", "bronnauwkeurigheid": "float",
        "mutatietype": "string", "typegebouw": "array<string>", "hoogteklasse": "string",
        "hoogteniveau": "smallint", "status": "string", "soortnaam": "string", "naam": "array<string>",
        "objectbegintijd": "timestamp", "tijdstipregistratie": "timestamp", "visualisatiecode": "smallint",
        "tdncode": "smallint",
    }
    one = layer.filter(G.geometry_type("geometry") == "POLYGON")
    return G.with_bbox(
        one.select(
            F.col("ogc_fid").alias("fid"), short("namespace", 10), F.col("lokaalid").cast("int").alias("lokaalid"),
            short("brontype", 12), *[F.col(c).cast(t).alias(c) for c, t in casts.items()],
            G.force_2d(F.col("geometry")[0]).alias("rings"),
        )
    )


def reconstruction_input(buildings: DataFrame, topographic: DataFrame, materialise: bool = True) -> DataFrame:
    """Current buildings with ``b3_kas_warenhuis`` and ``b3_bag_bag_overlap``."""
    if materialise:
        buildings = cut_lineage(buildings)
    label = S.label_by_overlap(buildings, topographic).withColumnRenamed("kas_warenhuis", "b3_kas_warenhuis")
    overlap = S.overlap_area(buildings)
    both = buildings.join(label, "fid", "left").join(overlap, "fid", "left")
    return H.dedupe(both, "identificatie", [G.area("rings").desc(), F.col("fid")])


def reconstruction_excluded(buildings: DataFrame, label: DataFrame) -> DataFrame:
    """Schema of the excluded buildings; nothing is excluded."""
    return buildings.join(label, "fid", "left").select("fid", "identificatie", "b3_kas_warenhuis", "rings").limit(0)
