"""Profiles, key checks, completeness and validation summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gevel.functions import geometry as G
from gevel.functions.rows import by_merge
from gevel.functions.text import bracket_list, download_link, file_id

HEAD_WIDTH = 23
REPORT_SCHEMA = (
    "features array<struct<id: string, validity: boolean, primitives: array<struct<id: string, "
    "validity: boolean, errors: array<struct<code: int>>>>>>"
)
# Position of each level of detail among a feature's primitives.
PRIMITIVE_AT = {"lod12": 1, "lod13": 2, "lod22": 3}

_COUNTS = ["nr_building", "nr_buildingpart", "nr_invalid_building"] + [
    f"nr_invalid_buildingpart_{lod}" for lod in PRIMITIVE_AT
]


def _result_schema() -> T.StructType:
    """Columns of a tile validation, per format prefix."""
    s = T.StructType([T.StructField("tile_id", T.StringType())])
    ints, codes = T.IntegerType(), T.ArrayType(T.IntegerType())
    for prefix in ("cj", "obj"):
        s.add(f"{prefix}_zip_ok", T.BooleanType())
        for c in _COUNTS:
            s.add(f"{prefix}_{c}", ints)
        for lod in PRIMITIVE_AT:
            s.add(f"{prefix}_errors_{lod}", codes)
        if prefix == "cj":
            for lod in PRIMITIVE_AT:
                s.add(f"cj_nr_mismatch_errors_{lod}", ints)
            s.add("cj_lod", T.ArrayType(T.StringType()))
            s.add("cj_schema_valid", T.BooleanType())
            s.add("cj_schema_warnings", T.BooleanType())
        s.add(f"{prefix}_download", T.StringType())
        s.add(f"{prefix}_sha256", T.StringType())
    s.add("gpkg_zip_ok", T.BooleanType()).add("gpkg_file_ok", T.BooleanType())
    s.add("gpkg_nr_building", ints).add("gpkg_nr_buildingpart", ints)
    return s.add("gpkg_download", T.StringType()).add("gpkg_sha256", T.StringType())


VALIDATION_SCHEMA = _result_schema()


# --- tables -----------------------------------------------------------------------------


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, NULL count and the table's row count, in one pass."""
    sums = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("column_type"), F.col(f"_n{i}").alias("missing_values"))
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return sums.select(F.inline(rows), F.col("_rows").alias("row_count")).select(
        "column_name", "column_type", "missing_values", "row_count"
    )


def head(df: DataFrame, n: int = 5, width: int = HEAD_WIDTH) -> DataFrame:
    """The first rows as text, cut to ``width`` characters."""
    return df.limit(n).select(*[F.substring(F.col(c).cast("string"), 1, width).alias(c) for c in df.columns])


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once; must be empty."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def assert_references(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent does not have; must be empty."""
    return child.join(parent.select(key), key, "left_anti")


def require_empty(violations: DataFrame, what: str) -> None:
    """Fails the build when a check found anything."""
    if not violations.isEmpty():
        raise ValueError(f"{what}: {violations.limit(5).collect()}")


def extent(df: DataFrame, swap: bool = False, rings: str | None = None) -> DataFrame:
    """Overall box; ``swap`` exchanges the axes, ``rings`` reads vertices instead of boxes."""
    src = df.select(G.bbox(rings).alias("_b")).select("_b.*") if rings else df
    box = src.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    if swap:
        box = box.select(F.col("y0").alias("x0"), F.col("x0").alias("y0"), F.col("y1").alias("x1"), F.col("x1").alias("y1"))
    return box


def layer_info(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Per attribute: type and whether it may be NULL, with feature count and extent."""
    box = [c for c in G.BOX if c in df.columns]
    sums = df.agg(
        F.count("*").alias("feature_count"),
        *[(F.min if c in ("x0", "y0") else F.max)(c).alias(c) for c in box],
    )
    names = [(c, t) for c, t in df.dtypes if c not in (*G.BOX, "rings")]
    attrs = F.array(
        *[
            F.struct(
                F.lit(c).alias("attribute"), F.lit(t).alias("type"),
                F.lit("NOT NULL" if c in required else "").alias("constraint"),
            )
            for c, t in names
        ]
    )
    return sums.select("feature_count", *box, F.inline(attrs))


# --- completeness -----------------------------------------------------------------------


def not_reconstructed(inputs: DataFrame, outputs: DataFrame, key: str = "identificatie") -> DataFrame:
    return inputs.select(key).distinct().join(outputs.select(key), key, "left_anti")


def list_drift(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys that only one of the two lists has."""
    l = new.select(key).distinct().withColumn("_l", F.lit(True))
    r = known.select(key).distinct().withColumn("_r", F.lit(True))
    return l.join(r, key, "full").filter(F.col("_l").isNull() | F.col("_r").isNull()).select(
        key, F.when(F.col("_r").isNull(), "new").otherwise("known").alias("only_in")
    )


def content_hash(content: Column | str, algorithm: str) -> Column:
    """``algorithm:hex`` of binary or text content (``md5`` or ``sha256``)."""
    digest = F.md5(content) if algorithm == "md5" else F.sha2(content, 256)
    return F.concat(F.lit(algorithm + ":"), digest)


def verify_checksums(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Status of each file against the manifest: ok, mismatch, no_hash or unlisted."""
    m = manifest.select("file", F.col("hash").alias("_want"), F.lit(True).alias("_listed"))
    status = (
        F.when(F.col("_listed").isNull(), "unlisted")
        .when(F.coalesce(F.length("_want"), F.lit(0)) == 0, "no_hash")
        .when(F.col("_want") == F.col("hash"), "ok")
        .otherwise("mismatch")
    )
    return files.join(m, "file", "left").select("file", "hash", status.alias("status"))


def layer_counts(layers: DataFrame) -> DataFrame:
    """Buildings and parts per tile: the smallest count among the tile's layers."""
    per_layer = layers.groupBy("tile_id", "layer").agg(
        F.count("identificatie").alias("_parts"), F.countDistinct("identificatie").alias("_ids")
    )
    return per_layer.groupBy("tile_id").agg(
        F.min("_ids").alias("nr_building"), F.min("_parts").alias("nr_buildingpart")
    )


# --- validation reports -----------------------------------------------------------------


def _invalid(c: Column) -> Column:
    return F.coalesce(~c, F.lit(True)).cast("int")


def summarise_reports(features: DataFrame, attributes: DataFrame | None = None) -> DataFrame:
    """Per tile: invalid buildings, invalid parts and error codes per level of detail.

    ``features`` has one report feature per row (``tile_id, id, validity, primitives``).
    ``attributes(tile_id, id, lod12, lod13, lod22)`` holds the codes stored with the
    building as bracket lists; differing sets are counted, unknown buildings skipped.
    A tile with a feature that lacks a level's primitive gets NULL in all fields.
    """
    f = features.select("tile_id", "id", "validity", "primitives")
    for lod, i in PRIMITIVE_AT.items():
        p = F.get("primitives", F.lit(i))
        f = f.withColumn(f"_lacks_{lod}", p.isNull()).withColumn(f"_bad_{lod}", _invalid(p["validity"])).withColumn(
            f"_codes_{lod}",
            F.array_sort(F.array_distinct(F.coalesce(p["errors"]["code"], F.array().cast("array<int>")))),
        )
    if attributes is not None:
        known = attributes.select(
            "tile_id", "id", F.lit(True).alias("_known"),
            *[F.array_sort(F.array_distinct(bracket_list(lod))).alias(f"_at_{lod}") for lod in PRIMITIVE_AT],
        )
        f = f.join(by_merge(known), ["tile_id", "id"], "left")
    aggs = [F.sum((F.col("validity") == F.lit(False)).cast("int")).alias("nr_invalid_building")]
    aggs += [F.sum(f"_bad_{lod}").alias(f"nr_invalid_buildingpart_{lod}") for lod in PRIMITIVE_AT]
    aggs += [
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(f"_codes_{lod}")))).alias(f"errors_{lod}")
        for lod in PRIMITIVE_AT
    ]
    if attributes is not None:
        aggs += [
            F.count_if(F.col("_known") & (F.col(f"_codes_{lod}") != F.col(f"_at_{lod}"))).cast("int")
            .alias(f"nr_mismatch_errors_{lod}")
            for lod in PRIMITIVE_AT
        ]
    lacks = F.lit(False)
    for lod in PRIMITIVE_AT:
        lacks = lacks | F.col(f"_lacks_{lod}")
    out = f.groupBy("tile_id").agg(F.max(lacks).alias("_lacks"), *aggs)
    fields = [c for c in out.columns if c not in ("tile_id", "_lacks")]
    known = [F.when(~F.col("_lacks"), F.col(c).cast("int") if c.startswith("nr_") else F.col(c)).alias(c) for c in fields]
    return out.select("tile_id", *known)


OBJECT_LINE = r"o (NL\.IMBAG\.Pand\.\d{16})"


def obj_ids(lines: DataFrame, line: str = "line") -> DataFrame:
    """Object-name lines with the building id; other lines are dropped."""
    id = F.regexp_extract(line, OBJECT_LINE, 1)
    return lines.withColumn("identificatie", id).filter("identificatie <> ''").drop(line)


def summarise_obj(ids: DataFrame, primitives: DataFrame) -> DataFrame:
    """Per tile from object names and reports of the three OBJ files.

    ``ids(tile_id, lod, identificatie)``; ``primitives(tile_id, lod, id, validity, codes)``.
    Buildings and parts are the smallest count over the levels, invalid buildings the
    largest; the building of a primitive is the first 30 characters of its id.
    """
    named = ids.groupBy("tile_id", "lod").agg(
        F.countDistinct("identificatie").alias("_b"), F.count("*").alias("_p")
    ).groupBy("tile_id").agg(
        # a level without any named object counts as zero
        F.when(F.count("*") < len(PRIMITIVE_AT), 0).otherwise(F.min("_b")).alias("nr_building"),
        F.when(F.count("*") < len(PRIMITIVE_AT), 0).otherwise(F.min("_p")).alias("nr_buildingpart"),
    )
    bad = primitives.filter(~F.col("validity"))
    per_lod = bad.groupBy("tile_id", "lod").agg(F.countDistinct(F.substring("id", 1, 30)).alias("_b"))
    worst = per_lod.groupBy("tile_id").agg(F.max("_b").alias("nr_invalid_building"))
    lods = [lod[3:] for lod in PRIMITIVE_AT]
    per_tile = bad.groupBy("tile_id").agg(
        *[F.count_if(F.col("lod") == v).alias(f"nr_invalid_buildingpart_lod{v}") for v in lods],
        *[
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("lod") == v, F.col("codes"))))))
            .alias(f"errors_lod{v}")
            for v in lods
        ],
    )
    # a tile with reports but without named objects has no buildings
    tiles = ids.select("tile_id").union(primitives.select("tile_id")).distinct()
    out = tiles.join(named, "tile_id", "left").join(worst, "tile_id", "left").join(per_tile, "tile_id", "left")
    counts = [c for c in out.columns if c.startswith("nr_")]
    return out.select(
        "tile_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in counts],
        *[F.coalesce(F.col(f"errors_lod{v}"), F.array().cast("array<int>")).alias(f"errors_lod{v}") for v in lods],
    )


def summarise_cityjson(objects: DataFrame) -> DataFrame:
    """Per tile from its city objects (``tile_id, type, geometry``): buildings, parts and levels of detail in order."""
    def of(kind: str) -> Column:
        return F.count_if(F.col("type") == kind).cast("int")

    levels = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce(F.col("geometry.lod"), F.array().cast("array<string>"))))))
    return objects.groupBy("tile_id").agg(of("Building").alias("nr_building"), of("BuildingPart").alias("nr_buildingpart"), levels.alias("lod"))


def validate_tiles(
    index: DataFrame, archives: DataFrame, hashes: DataFrame, root: str, version: str,
    cityjson: DataFrame | None = None, obj: DataFrame | None = None, gpkg: DataFrame | None = None, reports: DataFrame | None = None,
) -> DataFrame:
    """One row per tile in the columns of :data:`VALIDATION_SCHEMA`.

    ``archives(tile_id, format, zip_ok)`` and ``hashes(tile_id, format, sha256)`` hold one
    row per tile and format; the per-format summaries are joined where they exist and
    leave NULL where they do not. ``reports`` (see ``summarise_reports``) tells of the CityJSON files.
    """
    out = index.select("tile_id")
    if reports is not None:
        cityjson = reports if cityjson is None else cityjson.join(reports, "tile_id", "full")
    formats = {"cj": "cityjson", "obj": "obj", "gpkg": "gpkg"}
    for prefix, fmt in formats.items():
        zips = archives.filter(F.col("format") == fmt).select("tile_id", F.col("zip_ok").alias(f"{prefix}_zip_ok"))
        sums = hashes.filter(F.col("format") == fmt).select(
            "tile_id", F.col("sha256").alias(f"{prefix}_sha256"),
            download_link(F.lit(fmt), file_id("tile_id"), F.lit(version), root).alias(f"{prefix}_download"),
        )
        out = out.join(zips, "tile_id", "left").join(sums, "tile_id", "left")
        part = {"cj": cityjson, "obj": obj, "gpkg": gpkg}[prefix]
        if part is not None:
            named = part.select("tile_id", *[F.col(c).alias(f"{prefix}_{c}") for c in part.columns if c != "tile_id"])
            out = out.join(named, "tile_id", "left")
    return out.select(
        *[
            (F.col(f.name) if f.name in out.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in VALIDATION_SCHEMA.fields
        ]
    )
