"""Per-building JSON documents and the surfaces of building models.

A document is one row with its text in ``doc``. Rewriting goes through VARIANT values, so
members that are not touched keep their JSON types.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions import kernels as K
from gevel.functions.rows import by_merge, settle
from gevel.operators.spatial import candidates
from gevel.session import cut_lineage

OBJECTS_DDL = (
    "CityObjects map<string, struct<type: string, attributes: map<string, string>, "
    "geometry: array<struct<lod: string>>>>"
)
LODS = {"lod_0": "0", "lod_12": "1.2", "lod_13": "1.3", "lod_22": "2.2"}
# Attributes listed in the evaluation of the features.
EVALUATED = [
    "b3_pw_selectie_reden", "b3_pw_bron", "b3_puntdichtheid_AHN3", "b3_puntdichtheid_AHN4",
    "b3_puntdichtheid_AHN5", "b3_mutatie_AHN3_AHN4", "b3_mutatie_AHN4_AHN5", "b3_nodata_fractie_AHN3",
    "b3_nodata_fractie_AHN4", "b3_nodata_fractie_AHN5", "b3_nodata_radius_AHN3", "b3_nodata_radius_AHN4",
    "b3_nodata_radius_AHN5",
]
# Document attribute of each surface statistic.
SURFACE_ATTRIBUTES = {
    "area_ground": "b3_opp_grond",
    "area_roof_flat": "b3_opp_dak_plat",
    "area_roof_sloped": "b3_opp_dak_schuin",
    "area_shared_wall": "b3_opp_scheidingsmuur",
    "area_exterior_wall": "b3_opp_buitenmuur",
}
# Quantisation of the model coordinates.
SCALE = (0.001, 0.001, 0.001)
TRANSLATE = (171800.0, 472700.0, 0.0)
FLAT_DEGREES = 4.0


def city_objects(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One row per city object: ``coid``, ``type``, ``attributes``, ``geometry``."""
    parsed = F.from_json(doc, OBJECTS_DDL)["CityObjects"]
    rest = [c for c in docs.columns if c != doc]
    return docs.select(*rest, F.explode(parsed).alias("coid", "_o")).select(
        *rest, "coid", F.col("_o.type").alias("type"), F.col("_o.attributes").alias("attributes"),
        F.col("_o.geometry").alias("geometry"),
    )


def get_attributes(docs: DataFrame, id: str = "id", doc: str = "doc") -> DataFrame:
    """Attribute map of the building a document is named after."""
    objects = F.from_json(doc, OBJECTS_DDL)["CityObjects"]
    found = F.element_at(objects, F.col(id))
    return settle(docs, F.col(id).alias("id"), found["attributes"].alias("attributes")).filter(
        F.col("attributes").isNotNull()
    )


def set_attributes(
    docs: DataFrame, values: DataFrame, names: dict[str, str], id: str = "id", doc: str = "doc", how: str = "inner",
) -> tuple[DataFrame, DataFrame]:
    """Writes value columns into the attributes of the named building.

    ``names`` maps value columns to attribute names; values must be unique per id. With
    ``how='left'`` documents without values get NULL attributes. Returns the rewritten
    documents and the ids of values without a document.
    """
    keep = [c for c in docs.columns if c != doc]
    nothing = F.parse_json(F.lit("null"))

    # a value becomes a variant through its JSON text, so that its type stays
    def scalar(c: str) -> Column:
        text = F.to_json(F.array(F.col(c)))
        return F.when(F.col(c).isNull(), nothing).otherwise(
            F.parse_json(F.substring(text, F.lit(2), F.length(text) - 2))
        )

    new = F.map_from_arrays(F.array(*[F.lit(a) for a in names.values()]), F.array(*[scalar(c) for c in names]))
    joined = docs.join(by_merge(values.select(id, *names)), id, how)
    rows = settle(joined, *keep, F.from_json(doc, "map<string, variant>").alias("_top"), new.alias("_new"))
    # members are taken out of the parsed document as they are: it is read once and written once
    objects = F.col("_top")["CityObjects"].try_cast("map<string, map<string, variant>>")
    rows = settle(rows, *keep, "_top", "_new", objects.alias("_objects"))
    own = F.element_at("_objects", F.col(id))
    had = F.coalesce(
        own["attributes"].try_cast("map<string, variant>"),
        F.create_map().cast("map<string, variant>"),
    )
    kept = F.map_filter(had, lambda k, _: ~k.isin(*names.values()))
    rows = settle(rows, *keep, "_top", "_objects", F.to_variant_object(F.map_concat(kept, "_new")).alias("_attr"))
    changed = F.transform_values(
        "_objects",
        lambda k, o: F.when(
            k == F.col(id),
            F.map_concat(F.map_filter(o, lambda m, _: m != "attributes"), F.create_map(F.lit("attributes"), F.col("_attr"))),
        ).otherwise(o),
    )
    whole = F.map_concat(
        F.map_filter("_top", lambda k, _: k != "CityObjects"),
        F.create_map(F.lit("CityObjects"), F.to_variant_object(changed)),
    )
    out = rows.select(*keep, F.to_json(whole).alias(doc))
    misses = values.select(id).join(by_merge(docs.select(id)), id, "left_anti")
    return out.select(*docs.columns), misses


def set_surface_areas(docs: DataFrame, stats: DataFrame, id: str = "id", doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Puts the five surface areas into the documents."""
    return set_attributes(docs, stats, SURFACE_ATTRIBUTES, id, doc)


def lod_presence(docs: DataFrame, doc: str = "doc", per_object: bool = False) -> DataFrame:
    """Levels of detail and evaluated attributes of each city object.

    By default all objects of a document share the union of the flags, and the attributes
    of the last object that has any. ``per_object`` reads every object on its own.
    """
    objects = F.map_entries(F.from_json(doc, OBJECTS_DDL)["CityObjects"])

    def lods(scope: Column) -> Column:
        none = F.array().cast("array<struct<lod:string>>")
        shapes = F.flatten(F.transform(scope, lambda o: F.coalesce(o.value.geometry, none)))
        return F.transform(shapes, lambda g: g.lod)

    def last(scope: Column) -> Column:
        filled = F.filter(scope, lambda o: F.coalesce(F.size(o.value.attributes), F.lit(0)) > 0)
        return F.try_element_at(filled, F.lit(-1))["value"]["attributes"]

    rows = settle(docs, objects.alias("_all"))
    if per_object:
        one = rows.select(F.explode("_all").alias("_o"))
        scope = F.array(F.col("_o"))
        rows = settle(one, F.col("_o.key").alias("id"), lods(scope).alias("_lods"), last(scope).alias("_attr"))
    else:
        # flags and attributes once per document, then one row per object
        scope = F.col("_all")
        shared = settle(rows, scope.key.alias("_ids"), lods(scope).alias("_lods"), last(scope).alias("_attr"))
        rows = shared.select(F.explode("_ids").alias("id"), "_lods", "_attr")
    return rows.select(
        "id",
        F.substring("id", 1, 30).alias("identificatie"),
        *[F.array_contains("_lods", v).cast("int").alias(k) for k, v in LODS.items()],
        (F.size("_lods") > 0).alias("has_geometry"),
        *[F.col("_attr")[a].alias(a) for a in EVALUATED],
    )


def feature_rows(presence: DataFrame, missing: DataFrame, id: str = "identificatie") -> DataFrame:
    """Evaluation rows; buildings without a model get zero flags and no attributes."""
    blank = missing.select(
        F.col(id).alias("id"), F.substring(F.col(id), 1, 30).alias("identificatie"),
        *[F.lit(0).alias(k) for k in LODS], F.lit(False).alias("has_geometry"),
        *[F.lit(None).cast("string").alias(a) for a in EVALUATED],
    )
    return presence.unionByName(blank)


def dequantise(vertices: Column | str, scale: Sequence[float] = SCALE, translate: Sequence[float] = TRANSLATE) -> Column:
    """Integer vertex triples as coordinates."""
    v = F.col(vertices) if isinstance(vertices, str) else vertices
    return F.transform(
        v,
        lambda p: F.struct(
            *[(p[i] * F.lit(scale[i]) + F.lit(translate[i])).alias(n) for i, n in enumerate(("x", "y", "z"))]
        ),
    )


def publish_floors(df: DataFrame, floors: str = "floors", limit: int = 5) -> DataFrame:
    """Rounded half to even; more than ``limit`` floors are not published."""
    n = F.rint(floors)
    return df.withColumn("floors_int", n).withColumn(
        "b3_bouwlagen", F.when(n <= limit, n.cast("int"))
    )


# --- surfaces ---------------------------------------------------------------------------


def surface_normal(ring: Column | str) -> Column:
    """Newell normal of a closed 3D ring; its length is twice the area."""
    ring = F.col(ring) if isinstance(ring, str) else ring
    o = ring[0]

    def part(s: Column) -> Column:
        ax, ay, az = s.a.x - o.x, s.a.y - o.y, s.a.z - o.z
        bx, by, bz = s.b.x - o.x, s.b.y - o.y, s.b.z - o.z
        return F.struct(
            (ay * bz - az * by).alias("x"), (az * bx - ax * bz).alias("y"), (ax * by - ay * bx).alias("z")
        )

    zero = F.struct(*[F.lit(0.0).alias(c) for c in "xyz"])
    return F.aggregate(
        F.transform(G.segments(ring), part), zero,
        lambda t, v: F.struct(*[(t[c] + v[c]).alias(c) for c in "xyz"]),
    )


def surface_areas(
    surfaces: DataFrame, id: str = "identificatie", sid: str = "surface_id", flat_degrees: float = FLAT_DEGREES,
    snap: float = 0.05, angle: float = 1.0, materialise: bool = True,
) -> DataFrame:
    """Ground, flat roof, sloped roof, shared and exterior wall area per building.

    Definitions are ours: a roof is flat up to ``flat_degrees`` of slope; a wall is shared where the
    union of walls of other buildings in its plane covers it, and the rest of it is exterior. Another
    wall is in the plane when its direction differs by at most ``angle`` degrees and none of its corners
    lies farther than ``snap`` from the plane. Planes are taken from each wall's own corner, so neither
    the direction nor the size of the coordinates matters. ``materialise`` writes the surfaces with
    their normals once.
    """
    n = surface_normal("ring")
    df = settle(surfaces, id, sid, "type", "ring", n.alias("_n"))
    if materialise:
        df = cut_lineage(df)
    length = F.sqrt(F.col("_n.x") ** 2 + F.col("_n.y") ** 2 + F.col("_n.z") ** 2)
    flat = F.abs(F.col("_n.z")) >= math.cos(math.radians(flat_degrees)) * F.col("_l")
    kind, size = F.col("type"), 0.5 * F.col("_l")
    sums = df.withColumn("_l", length).groupBy(id).agg(
        *[
            F.coalesce(F.sum(F.when(cond, size)), F.lit(0.0)).alias(name)
            for name, cond in (
                ("area_ground", kind == "GroundSurface"),
                ("area_roof_flat", (kind == "RoofSurface") & flat),
                ("area_roof_sloped", (kind == "RoofSurface") & ~flat),
                ("_wall", kind == "WallSurface"),
            )
        ]
    )
    per_building = shared_walls(df, id, sid, snap, angle).groupBy(id).agg(F.sum("_shared").alias("_shared"))
    both = sums.join(by_merge(per_building), id, "left").withColumn("area_shared_wall", F.coalesce("_shared", F.lit(0.0)))
    return both.select(
        id, "area_ground", "area_roof_flat", "area_roof_sloped", "area_shared_wall",
        (F.col("_wall") - F.col("area_shared_wall")).alias("area_exterior_wall"),
    )


def shared_walls(df: DataFrame, id: str, sid: str, snap: float, angle: float) -> DataFrame:
    """Area of each wall that the union of other buildings' walls in its plane covers.

    Walls whose boxes in plan meet are compared exactly, in coordinates along the wall and upwards;
    equal walls of any number of other buildings count once.
    """
    flat = F.sqrt(F.col("_n.x") ** 2 + F.col("_n.y") ** 2)
    walls = df.filter((F.col("type") == "WallSurface") & (flat > 0))
    # corners as seen from the first one
    first = F.col("ring")[0]
    walls = settle(walls, id, sid, "ring", (F.col("_n.x") / flat).alias("nx"), (F.col("_n.y") / flat).alias("ny"), first.x.alias("ox"), first.y.alias("oy"))

    def ends(pick, axis: str, by: float):
        return pick(F.transform("ring", lambda v: v[axis])) + by

    box = [ends(F.array_min, "x", -snap), ends(F.array_min, "y", -snap), ends(F.array_max, "x", snap), ends(F.array_max, "y", snap)]
    walls = settle(walls, *walls.columns, *(b.alias(c) for b, c in zip(box, G.BOX)))
    others = walls.select(
        F.col(id).alias("_other"), F.col("ring").alias("rring"), F.col("nx").alias("rnx"), F.col("ny").alias("rny"), *[F.col(c).alias("r" + c) for c in G.BOX]
    ).distinct()
    pairs = candidates(walls, others).filter(F.col(id) != F.col("_other"))
    cross = F.abs(F.col("nx") * F.col("rny") - F.col("ny") * F.col("rnx"))
    away = F.exists("rring", lambda v: F.abs((v.x - F.col("ox")) * F.col("nx") + (v.y - F.col("oy")) * F.col("ny")) > snap)
    pairs = pairs.filter((cross <= math.sin(math.radians(angle))) & ~away)

    def upright(ring: str):
        return F.array(F.transform(ring, lambda v: G.point((v.y - F.col("oy")) * F.col("nx") - (v.x - F.col("ox")) * F.col("ny"), v.z)))

    drawn = settle(pairs, id, sid, upright("ring").alias("_own"), upright("rring").alias("_met"))
    per_wall = drawn.groupBy(id, sid).agg(F.first("_own").alias("_own"), F.collect_set("_met").alias("_met"))
    return per_wall.select(id, sid, K.covered_area("_own", "_met", G.no_rings()).alias("_shared"))
