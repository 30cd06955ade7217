"""Per-building feature tables for the floor model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions import kernels as K
from gevel.functions.text import building_id
from gevel.operators import regions as RN
from gevel.operators import spatial as S
from gevel.session import cut_lineage

LIVING, OTHER_USE = "woonfunctie", "overige gebruiksfunctie"
# Codes of the dwelling types; any other text is 5.
BUILDING_TYPES = {
    "twee-onder-een-kap": 0,
    "vrijstaande woning": 1,
    "appartement": 2,
    "hoekwoning": 3,
    "tussenwoning/geschakeld": 4,
}
# Codes of the roof types; any other text is NULL.
ROOF_TYPES = {"horizontal": 0, "multiple horizontal": 0, "slanted": 1}
# Model columns and the document attribute each comes from.
MODEL_ATTRIBUTES = {
    "construction_year": ("oorspronkelijkbouwjaar", "int"),
    "roof_type": ("b3_dak_type", "string"),
    "h_roof_50p": ("b3_h_dak_50p", "double"),
    "h_roof_70p": ("b3_h_dak_70p", "double"),
    "h_roof_max": ("b3_h_dak_max", "double"),
    "h_roof_min": ("b3_h_dak_min", "double"),
    "area_roof_flat": ("b3_opp_dak_plat", "double"),
    "area_roof_sloped": ("b3_opp_dak_schuin", "double"),
    "area_ext_walls": ("b3_opp_buitenmuur", "double"),
    "area_party_walls": ("b3_opp_scheidingsmuur", "double"),
    "area_ground": ("b3_opp_grond", "double"),
    "volume_lod22": ("b3_volume_lod22", "double"),
    "volume_lod12": ("b3_volume_lod12", "double"),
}


def _coded(c: Column, codes: dict, default=None) -> Column:
    out = None
    for text, code in codes.items():
        out = F.when(c == text, code) if out is None else out.when(c == text, code)
    return out.otherwise(F.lit(default).cast("int"))


def array_concat(arrays: str) -> Column:
    """Aggregate: the distinct arrays one after the other; elements may repeat."""
    kept = F.collect_set(arrays)
    return F.when(F.size(kept) > 0, F.flatten(F.array_sort(kept)))


def unit_features(units: DataFrame) -> DataFrame:
    """Per building: number of units, floor area and uses; a unit counts for each building."""
    one = units.select(F.explode("pandref").alias("pandid"), "identificatie", "oppervlakte", "gebruiksdoel")
    return one.groupBy("pandid").agg(
        F.count("identificatie").alias("no_units"),
        F.sum("oppervlakte").alias("net_area"),
        array_concat("gebruiksdoel").alias("uses"),
    )


def building_function(uses: Column | str) -> Column:
    """0 living only, 1 living mixed, 2 one other use, 3 several, 4 rest use, 5 unknown."""
    uses = F.col(uses) if isinstance(uses, str) else uses
    n = F.size(uses)
    return (
        F.when(F.array_contains(uses, LIVING), F.when(n == 1, 0).otherwise(1))
        .when((n == 1) & (uses[0] == OTHER_USE), 4)
        .when(n == 1, 2)
        .when(n > 1, 3)
        .otherwise(5)
    )


def building_type(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return _coded(text, BUILDING_TYPES, 5)


def roof_type(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return _coded(text, ROOF_TYPES)


def update_from(target: DataFrame, updates: DataFrame, key: str, cols, order=None) -> DataFrame:
    """Matched rows take the new values, others keep theirs; the row count stays.

    Several updates for a key: the smallest by ``order`` (default: by the values) wins.
    """
    order = list(order or cols)
    best = updates.groupBy(key).agg(F.min(F.struct(*order, *[c for c in cols if c not in order])).alias("_u"))
    had = target.columns
    return target.join(best, key, "left").select(
        *[
            F.when(F.col("_u").isNotNull(), F.col(f"_u.{c}")).otherwise(F.col(c) if c in had else None).alias(c)
            if c in cols
            else F.col(c)
            for c in [*had, *[c for c in cols if c not in had]]
        ]
    )


def neighbourhoods(stats_new: DataFrame, stats_old: DataFrame, areas: DataFrame) -> DataFrame:
    """Neighbourhood figures of two years with their polygons."""
    new = stats_new.filter(F.col("SoortRegio_2") == "Buurt").select(
        F.col("WijkenEnBuurten").alias("bu_code"),
        F.col("PercentageMeergezinswoning_38").cast("int").alias("cbs_percent_multihousehold"),
        F.col("Bevolkingsdichtheid_34").cast("int").alias("cbs_pop_per_km2"),
    )
    old = stats_old.select(
        F.col("WijkenEnBuurten").alias("bu_code"), F.col("GIHandelEnHoreca_94").cast("int").alias("cbs_dist_to_horeca")
    )
    return areas.select("bu_code", *G.BOX, "rings").join(new, "bu_code").join(old, "bu_code")


def external_features(
    buildings: DataFrame, units: DataFrame, stats_new: DataFrame, stats_old: DataFrame,
    areas: DataFrame, types: DataFrame, grow: float = 0.1, radius: float = 100.0, materialise: bool = True,
) -> DataFrame:
    """Features from the registers: geometry, units, neighbours, neighbourhood, type.

    ``materialise`` writes the base rows once to the shared folder, because four joins
    read them.
    """
    in_use = buildings.filter(F.col("status").startswith("Pand in gebruik") & F.col("eindgeldigheid").isNull())
    base = (
        in_use.select("identificatie", "rings", *G.BOX)
        .join(unit_features(units), F.col("identificatie") == F.col("pandid")).drop("pandid")
        .withColumn("building_function", building_function("uses"))
        .withColumn("_c", G.centroid("rings"))
        .withColumn("cx", F.col("_c.x")).withColumn("cy", F.col("_c.y")).drop("_c")
    )
    if materialise:
        base = cut_lineage(base)
    known = base.filter(~F.col("building_function").isin(4, 5))
    beside = S.adjacent_count(known, dist=grow)
    around = S.neighbours_within(known, radius)
    values = ("cbs_percent_multihousehold", "cbs_pop_per_km2", "cbs_dist_to_horeca")
    hood = RN.assign_region(base, neighbourhoods(stats_new, stats_old, areas), "bu_code", "identificatie", values=values)
    kind = (
        types.groupBy(building_id("identificatie").alias("identificatie"))
        .agg(F.min(building_type("woningtypering")).alias("buildingtype"))
    )
    scalars = base.select(
        "identificatie",
        K.simplified_count(F.col("rings"), 0.1).alias("no_vertices"),
        G.perimeter("rings").alias("perimeter"),
        "no_units", "net_area", "uses", "building_function",
    )
    return (
        scalars.join(around.withColumnRenamed("no_neighbours", "no_neighbours_100"), "identificatie", "left")
        .join(beside.withColumnRenamed("no_adjacent", "no_adjacent_neighbours"), "identificatie", "left")
        .join(hood.select("identificatie", *values), "identificatie", "left")
        .join(kind, "identificatie", "left")
    )


def building_features(attributes: DataFrame) -> DataFrame:
    """Model columns of each building from its attribute map; of several rows of an id the smallest stays.

    The roof area is NULL where a part is unknown; the building is kept.
    """
    cols = [
        F.col("attributes")[source].cast(kind).alias(name) for name, (source, kind) in MODEL_ATTRIBUTES.items()
    ]
    names = list(MODEL_ATTRIBUTES)
    flat = attributes.select("id", *cols).groupBy("id").agg(F.min(F.struct(*names)).alias("_least")).select("id", "_least.*")
    return flat.select(
        "id", "construction_year", "roof_type", "h_roof_50p", "h_roof_70p", "h_roof_max", "h_roof_min",
        (F.col("area_roof_flat") + F.col("area_roof_sloped")).alias("area_roof"),
        "area_ext_walls", "area_party_walls", "area_ground", "volume_lod22", "volume_lod12",
    )


def all_features(external: DataFrame, building: DataFrame) -> DataFrame:
    """Both feature tables of residential buildings, one row per building."""
    homes = external.filter(F.col("building_function").isin(0, 1))
    both = homes.join(building, homes["identificatie"] == building["id"])
    return both.select(
        "identificatie", "no_vertices", "perimeter", "no_units", "net_area", "building_function",
        "no_neighbours_100", "no_adjacent_neighbours", "cbs_percent_multihousehold", "cbs_pop_per_km2",
        "cbs_dist_to_horeca", "buildingtype", "construction_year", roof_type("roof_type").alias("roof_type"),
        "h_roof_50p", "h_roof_70p", "h_roof_max", "h_roof_min", "area_roof", "area_ext_walls",
        "area_party_walls", "area_ground", "volume_lod22", "volume_lod12",
    )


def training_filter(df: DataFrame) -> DataFrame:
    """Plausible years and heights; the 70th height percentile must be known."""
    year = F.col("construction_year")
    return df.filter((year > 1005) & (year < 2025) & (F.col("h_roof_max") < 300)).dropna(subset=["h_roof_70p"])
