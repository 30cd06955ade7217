"""Grid, tile, export and validation queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gevel import sinks
from gevel.catalog import adapters as A
from gevel.catalog.spatial import ORDER_BOXES, order_boxes
from gevel.functions import geometry as G
from gevel.functions import text as TX
from gevel.operators import lineage as L
from gevel.operators import points as PT
from gevel.operators import documents as D
from gevel.operators import quality as Q
from gevel.operators import tiling as TI
from gevel.operators import webservice as W
from gevel.session import cut_lineage, shared_dir
from gevel.sources import files as SF

GRID = TI.Grid(0.0, 0.0, 200.0, 12, 12)
WIDE = TI.Grid(0.0, 0.0, 200.0, 1 << 30, 12)


def grid(spark, sf):
    """Tiles of each grid cell; empty cells keep a zero."""
    tiles = A.boxes(A.table(spark, sf, "supplier"), "s_suppkey", "s_suppkey AS tile_id", **A.TILE).drop("rings")
    cells = TI.regular_grid(spark, GRID.bbox, GRID.cell)
    got = cells.join(TI.cells_of_tiles(tiles, GRID), "cell_id", "left")
    got = got.withColumn("tiles", F.array_join("tile_ids", ",")).withColumn("n", F.coalesce(F.size("tile_ids"), F.lit(0)))
    return A.shaped(got, "cell_id:l x0:d y0:d x1:d y1:d tiles:s n:l")


def tile_cells(spark, sf):
    """Grid cells touched by the buildings of a tile."""
    index = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("fid"), F.col("o_orderpriority").alias("tile_id"))
    return A.shaped(TI.cells_of_features(order_boxes(spark, sf), index, WIDE), "tile_id:s cell_id:l")


CELL, CAPACITY, DEPTH = 16, 500, 8


def quad_points(spark, sf):
    return A.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS fid", "CAST((l_partkey % 64) * (l_orderkey % 65) AS double) AS cx",
        "CAST((l_suppkey % 64) * (l_linenumber * 9) AS double) AS cy", "l_quantity AS w",
    )


QUAD_CTE = f"""
p AS (SELECT l_orderkey*8 + l_linenumber AS fid, ((l_partkey % 64) * (l_orderkey % 65))//{CELL} AS i,
  ((l_suppkey % 64) * (l_linenumber * 9))//{CELL} AS j, l_quantity AS w FROM lineitem),
lv AS (SELECT unnest(generate_series(0, {DEPTH})) AS k),
n AS (SELECT k, i // CAST(pow(2, k) AS BIGINT) AS nx, j // CAST(pow(2, k) AS BIGINT) AS ny, sum(WEIGHT) AS n
  FROM p, lv GROUP BY 1, 2, 3),
leaf AS (SELECT c.*, ({DEPTH} - c.k) || '/' || c.nx || '/' || c.ny AS tile_id FROM n c LEFT JOIN n q ON q.k = c.k + 1 AND q.nx = c.nx // 2 AND q.ny = c.ny // 2
  WHERE (c.n <= CAP OR c.k = 0) AND (c.k = {DEPTH} OR q.n > CAP))"""


def quadtree(spark, sf):
    """Quadtree leaves over the number of points, with their boxes."""
    tiles, _ = TI.quadtree_tiles(quad_points(spark, sf), CELL, CAPACITY, depth=DEPTH)
    return A.shaped(tiles, "tile_id:s level:l nr_items:l x0:d y0:d x1:d y1:d")


def quadtree_index(spark, sf):
    """The leaf of every point, by weight."""
    pts = quad_points(spark, sf)
    _, index = TI.quadtree_tiles(pts, CELL, CAPACITY * 20, depth=DEPTH, weight="w")
    got = index.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum("fid").alias("fids"))
    return A.shaped(got, "tile_id:s n:l fids:l")


def tile_members(spark, sf):
    """Buildings with the tile they belong to."""
    o = order_boxes(spark, sf).withColumns({"cx": F.col("x0"), "cy": F.col("y0")})
    _, index = TI.quadtree_tiles(o, 256, 300, depth=4)
    got = TI.tile_members(o, index)
    return A.shaped(got.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum(G.area("rings")).alias("area")), "tile_id:s n:l area:d")


def point_stats(spark, sf):
    """Point statistics per grid cell."""
    pts = TI.partition_points(A.line_points(spark, sf, "l_quantity AS z"), GRID)
    got = PT.point_stats(pts, "cell_id")
    rounded = [F.round(c, 6).alias(c) if c.endswith(("_avg", "_stddev")) else F.col(c) for c in got.columns]
    return A.shaped(got.select(*rounded), "cell_id:l n_points:l " + " ".join(f"{c}:d" for c in got.columns[2:]))


POINT_STATS = ", ".join(
    f"min({c}) AS {c}_min, max({c}) AS {c}_max, round(avg({c}), 6) AS {c}_avg, round(stddev_samp({c}), 6) AS {c}_stddev" for c in "xyz"
)


def best_cloud(spark, sf):
    """The cloud with the best coverage."""
    li = A.table(spark, sf, "lineitem")
    stats = li.groupBy(F.col("l_orderkey").alias("identificatie"), F.col("l_returnflag").alias("cloud")).agg(
        F.max("l_quantity").alias("coverage"), F.min("l_linenumber").alias("quality")
    )
    return A.shaped(PT.best_cloud(stats), "identificatie:l cloud:s coverage:d reason:s")


TILE_ID = "concat('10/', CAST(o_orderkey % 1000 AS string), '/', CAST(CAST((o_orderkey - o_orderkey % 1000) / 1000 AS bigint) AS string))"
TILE_ID_SQL = "'10/' || (o_orderkey % 1000) || '/' || (o_orderkey // 1000)"


def export_index(spark, sf):
    """Leaf tiles with the formats that are there."""
    o = A.table(spark, sf, "orders").withColumn("tile", F.expr(TILE_ID))
    lines = o.select(
        F.concat_ws(
            "\t", "tile", F.lit("10"), (F.col("o_custkey") % 7).cast("string"),
            F.when(F.col("o_orderstatus") == "O", "false").otherwise("true"),
            G.bbox_to_wkt(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderkey") + 10, F.col("o_custkey") + 10),
        ).alias("value")
    )
    stem = F.translate("tile", "/", "-")
    names = F.array(
        F.when(F.col("o_custkey") % 2 == 0, F.concat(stem, F.lit(".city.json"))),
        F.when(F.col("o_custkey") % 3 == 0, F.concat(stem, F.lit(".gpkg"))),
        F.when(F.col("o_custkey") % 5 > 0, F.concat(stem, F.lit("-LoD12-3D.obj"))),
        F.when(F.col("o_custkey") % 5 > 1, F.concat(stem, F.lit("-LoD13-3D.obj"))),
        F.when(F.col("o_custkey") % 5 > 2, F.concat(stem, F.lit("-LoD22-3D.obj"))),
        F.when(F.col("o_custkey") % 5 > 3, F.concat(stem, F.lit("-other.obj"))),
    )
    files = o.select("tile", F.explode(F.array_compact(names)).alias("f")).select(
        F.concat_ws("/", F.lit("/data/export/tiles"), "tile", "f").alias("path")
    )
    index = TI.export_index(SF.parse_quadtree(lines), files)
    boxed = TI.distribution_tile_index(index).select("tile_id", "x0", "y0", "x1", "y1")
    return A.shaped(
        index.join(boxed, "tile_id", "left"), "tile_id:s has_cityjson:b has_gpkg:b has_obj:b wkt:s x0:d y0:d x1:d y1:d"
    )


EXPORT_SQL = f"""
WITH o AS (SELECT {TILE_ID_SQL} AS tile_id, o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders)
SELECT tile_id, c % 2 = 0 AS has_cityjson, c % 3 = 0 AS has_gpkg, c % 5 = 3 AS has_obj,
  'POLYGON ((' || k || ' ' || c || ', ' || (k+10) || ' ' || c || ', ' || (k+10) || ' ' || (c+10) || ', ' || k || ' ' || (c+10) || ', ' || k || ' ' || c || '))' AS wkt,
  CASE WHEN c % 2 = 0 THEN CAST(k AS DOUBLE) END AS x0, CASE WHEN c % 2 = 0 THEN CAST(c AS DOUBLE) END AS y0,
  CASE WHEN c % 2 = 0 THEN CAST(k+10 AS DOUBLE) END AS x1, CASE WHEN c % 2 = 0 THEN CAST(c+10 AS DOUBLE) END AS y1
FROM o WHERE s <> 'O' AND c % 7 > 0 AND NOT (c % 2 <> 0 AND c % 3 <> 0 AND c % 5 = 0)"""


def links(spark, sf):
    """Download address per tile and format."""
    o = A.table(spark, sf, "orders").select(
        F.expr(TILE_ID).alias("tile_id"),
        F.when(F.col("o_orderstatus") == "F", "cityjson").when(F.col("o_orderstatus") == "O", "gpkg").otherwise("obj").alias("fmt"),
        F.concat(F.lit("v"), TX.version_date("o_orderdate")).alias("version"),
    )
    got = o.withColumn("link", TX.download_link("fmt", TX.file_id("tile_id"), "version", "https://example.org"))
    return A.shaped(got, "tile_id:s fmt:s link:s")


WEB_SCHEMA = T.StructType(
    [
        T.StructField("tile_id", T.StringType()),
        T.StructField("cj_zip_ok", T.BooleanType()),
        T.StructField("cj_nr_building", T.IntegerType()),
        T.StructField("cj_errors_lod12", T.ArrayType(T.IntegerType())),
        T.StructField("cj_lod", T.ArrayType(T.StringType())),
        T.StructField("cj_sha256", T.StringType()),
    ]
)


def blank_casts(spark, sf):
    """Text columns to types, bracket lists to arrays."""
    o = A.table(spark, sf, "orders")
    text = o.selectExpr(
        "CAST(o_orderkey AS string) AS tile_id",
        "CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'False' ELSE '' END AS cj_zip_ok",
        "CASE WHEN o_custkey % 3 = 0 THEN '' WHEN o_custkey % 3 = 1 THEN NULL ELSE CAST(o_custkey AS string) END AS cj_nr_building",
        "CASE o_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '[]' WHEN 2 THEN concat('[', o_custkey, ']') "
        "ELSE concat('[', o_custkey, ', ', o_orderkey, ']') END AS cj_errors_lod12",
        "CASE WHEN o_custkey % 5 = 0 THEN '[]' ELSE concat('[''1.2'', ''', o_orderpriority, ''']') END AS cj_lod",
        "o_orderpriority AS cj_sha256",
    )
    index = o.selectExpr("CAST(o_orderkey AS string) AS tile_id", "concat('POLYGON(', o_orderkey, ')') AS wkt")
    got = W.webservice_tiles(index, text, WEB_SCHEMA)
    got = got.withColumn("n_errors", F.size("cj_errors_lod12")).withColumn(
        "errors", F.array_join(F.col("cj_errors_lod12").cast("array<string>"), "|")
    ).withColumn("lods", F.array_join("cj_lod", "|")).withColumn("n_lods", F.size("cj_lod"))
    got = got.withColumn("n_errors", F.when(F.col("cj_errors_lod12").isNotNull(), F.col("n_errors")))
    return A.shaped(
        got, "tile_id:s cj_zip_ok:b cj_nr_building:l n_errors:l errors:s n_lods:l lods:s cj_sha256:s geometry:s"
    )


BLANK_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS tile_id, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS cj_zip_ok,
  CASE WHEN o_custkey % 3 = 2 THEN o_custkey END AS cj_nr_building,
  CAST(CASE o_custkey % 4 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 END AS BIGINT) AS n_errors,
  CASE o_custkey % 4 WHEN 1 THEN '' WHEN 2 THEN CAST(o_custkey AS VARCHAR) WHEN 3 THEN o_custkey || '|' || o_orderkey END AS errors,
  CAST(CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE 2 END AS BIGINT) AS n_lods,
  CASE WHEN o_custkey % 5 = 0 THEN '' ELSE '''1.2''| ''' || o_orderpriority || '''' END AS lods,
  o_orderpriority AS cj_sha256, 'POLYGON(' || o_orderkey || ')' AS geometry FROM orders"""


def layer_rows(spark, sf):
    return A.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_suppkey AS string) AS tile_id", "l_returnflag AS layer", "CAST(l_partkey AS string) AS identificatie"
    )


LAYER_CTE = """
lc AS (SELECT l_suppkey, l_returnflag, count(*) AS p, count(DISTINCT l_partkey) AS b FROM lineitem GROUP BY 1, 2),
gpkg AS (SELECT CAST(l_suppkey AS VARCHAR) AS tile_id, min(b) AS nr_building, min(p) AS nr_buildingpart FROM lc GROUP BY 1)"""


def layer_counts(spark, sf):
    """Smallest building and part count among the layers of a tile."""
    return A.shaped(Q.layer_counts(layer_rows(spark, sf)), "tile_id:s nr_building:l nr_buildingpart:l")


def obj_tables(spark, sf):
    li = A.table(spark, sf, "lineitem")
    lod = "CASE l_returnflag WHEN 'A' THEN '12' WHEN 'N' THEN '13' ELSE '22' END AS lod"
    name = "concat('NL.IMBAG.Pand.', lpad(CAST(l_orderkey AS string), 16, '0'))"
    lines = li.selectExpr(
        "CAST(l_suppkey AS string) AS tile_id", lod,
        f"CASE WHEN l_linenumber <= 5 THEN concat('o ', {name}, CASE WHEN l_linenumber % 2 = 0 THEN '-0' ELSE '' END) ELSE 'v 1 2 3' END AS line",
    )
    primitives = li.selectExpr(
        "CAST(l_suppkey AS string) AS tile_id", lod, f"concat({name}, '-0') AS id", "l_discount <= 0.085 AS validity",
        "array(CAST(100 + l_linenumber AS int)) AS codes",
    )
    return Q.obj_ids(lines), primitives


OBJ_CTE = """
ol AS (SELECT l_suppkey, CASE l_returnflag WHEN 'A' THEN '12' WHEN 'N' THEN '13' ELSE '22' END AS lod, l_orderkey, l_linenumber, l_discount FROM lineitem),
oc AS (SELECT l_suppkey, lod, count(*) AS p, count(DISTINCT l_orderkey) AS b FROM ol WHERE l_linenumber <= 5 GROUP BY 1, 2),
on_ AS (SELECT l_suppkey, CASE WHEN count(*) < 3 THEN 0 ELSE min(b) END AS nr_building, CASE WHEN count(*) < 3 THEN 0 ELSE min(p) END AS nr_buildingpart FROM oc GROUP BY 1),
ob AS (SELECT l_suppkey, lod, count(DISTINCT l_orderkey) AS b, count(*) AS n,
  array_to_string(list_sort(list(DISTINCT 100 + l_linenumber)), ',') AS codes FROM ol WHERE l_discount > 0.085 GROUP BY 1, 2),
obj AS (SELECT CAST(on_.l_suppkey AS VARCHAR) AS tile_id, on_.nr_building, on_.nr_buildingpart, coalesce(max(ob.b), 0) AS nr_invalid_building,
  CAST(coalesce(sum(n) FILTER (lod = '12'), 0) AS BIGINT) AS nr_invalid_buildingpart_lod12,
  CAST(coalesce(sum(n) FILTER (lod = '13'), 0) AS BIGINT) AS nr_invalid_buildingpart_lod13,
  CAST(coalesce(sum(n) FILTER (lod = '22'), 0) AS BIGINT) AS nr_invalid_buildingpart_lod22,
  coalesce(max(codes) FILTER (lod = '12'), '') AS errors_lod12, coalesce(max(codes) FILTER (lod = '13'), '') AS errors_lod13,
  coalesce(max(codes) FILTER (lod = '22'), '') AS errors_lod22
  FROM on_ LEFT JOIN ob ON on_.l_suppkey = ob.l_suppkey GROUP BY 1, 2, 3)"""


def _codes_as_text(df, cols):
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in cols})


OBJ_DDL = (
    "tile_id:s nr_building:l nr_buildingpart:l nr_invalid_building:l nr_invalid_buildingpart_lod12:l "
    "nr_invalid_buildingpart_lod13:l nr_invalid_buildingpart_lod22:l errors_lod12:s errors_lod13:s errors_lod22:s"
)


def obj_lines(spark, sf):
    """Object names and reports of the OBJ files of a tile."""
    got = Q.summarise_obj(*obj_tables(spark, sf))
    return A.shaped(_codes_as_text(got, ["errors_lod12", "errors_lod13", "errors_lod22"]), OBJ_DDL)


REPORT_DOC = (
    "concat('{\"features\":[{\"id\":\"', id, '\",\"validity\":', CASE WHEN event_type = 'error' THEN 'false' ELSE 'true' END, "
    "',\"primitives\":[', p0, ',', p1, ',', p2, ',', p3, ']}]}')"
)


def report_rows(spark, sf):
    """Events as report features of the tile of their user, and the codes stored for most of them."""
    e = A.table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    e = e.withColumn("tile_id", F.col("user_id").cast("string")).withColumn("id", F.col("event_id").cast("string"))
    for i in range(4):
        ok = F.col("k") % (i + 2) != 0
        code = (100 + F.col("k") % 3).cast("string")
        text = F.when(ok, F.lit('{"validity":true,"errors":[]}')).otherwise(
            F.concat(F.lit('{"validity":false,"errors":[{"code":'), code, F.lit('},{"code":'), code, F.lit("}]}"))
        )
        e = e.withColumn(f"p{i}", text)
    docs = e.select("tile_id", F.expr(REPORT_DOC).alias("doc"))
    stored = e.filter("event_type <> 'view'").select(
        "tile_id", "id", *[F.when(F.col("value") > 50, "[100]").otherwise("[]").alias(lod) for lod in Q.PRIMITIVE_AT]
    )
    return Q.summarise_reports(SF.parse_reports(docs), stored)


def reports(spark, sf):
    """Validity, error codes and mismatches per tile."""
    got = _codes_as_text(report_rows(spark, sf), ["errors_lod12", "errors_lod13", "errors_lod22"])
    return A.shaped(got, "tile_id:s " + " ".join(f"{c}:{'s' if c.startswith('errors') else 'l'}" for c in got.columns[1:]))


def _report_sql() -> str:
    bad, codes, mism = [], [], []
    for lod, i in (("lod12", 3), ("lod13", 4), ("lod22", 5)):
        bad.append(f"count(*) FILTER (k % {i} = 0) AS nr_invalid_buildingpart_{lod}")
        codes.append(
            f"coalesce(array_to_string(list_sort(list(DISTINCT 100 + k % 3) FILTER (k % {i} = 0)), ','), '') AS errors_{lod}"
        )
        have = f"CASE WHEN k % {i} = 0 THEN CAST(100 + k % 3 AS VARCHAR) ELSE '' END"
        mism.append(
            f"count(*) FILTER (event_type <> 'view' AND {have} <> CASE WHEN value > 50 THEN '100' ELSE '' END) AS nr_mismatch_errors_{lod}"
        )
    return (
        "WITH e AS (SELECT CAST(user_id AS VARCHAR) AS tile_id, event_type, value, CAST(regexp_extract(props, '(-?\\d+)', 1) AS BIGINT) AS k FROM events) "
        "SELECT tile_id, count(*) FILTER (event_type = 'error') AS nr_invalid_building, " + ", ".join(bad + codes + mism) + " FROM e GROUP BY 1"
    )


def validate_tiles(spark, sf):
    """One validation row per tile from all parts."""
    s = A.table(spark, sf, "supplier")
    index = s.select(F.col("s_suppkey").cast("string").alias("tile_id"))
    each = s.select(F.col("s_suppkey").cast("string").alias("tile_id"), "s_name", "s_acctbal", F.explode(F.array(*map(F.lit, ("cityjson", "obj", "gpkg")))).alias("format"))
    archives = each.filter("format <> 'obj' OR s_acctbal > 0").select("tile_id", "format", (F.col("s_acctbal") < 9000).alias("zip_ok"))
    # a file for each tile and format, and the hashes of these files
    path = f"{shared_dir(spark).rstrip('/')}/gevel-tiles-{uuid.uuid4().hex}"
    sinks.write_texts(each, path, ["format", "tile_id"], "s_name")
    tile = lambda c: F.regexp_extract("path", rf"{c}=([^/]+?)(?:/|\.txt$)", 1).alias(c)
    # read once, not again for each format
    hashes = cut_lineage(SF.read_file_hashes(spark, path, "*.txt").select(tile("tile_id"), tile("format"), "sha256"))
    # one building per tile, with a part of two levels unless the key is a multiple of three
    doc = F.expr(
        "concat('{\"CityObjects\":{\"B', s_suppkey, '\":{\"type\":\"Building\",\"geometry\":[{\"lod\":\"0\"}]}', CASE WHEN s_suppkey % 3 > 0 THEN "
        "concat(',\"B', s_suppkey, '-0\":{\"type\":\"BuildingPart\",\"geometry\":[{\"lod\":\"2.2\"},{\"lod\":\"1.2\"}]}') ELSE '' END, '}}')"
    )
    objects = D.city_objects(s.select(F.col("s_suppkey").cast("string").alias("tile_id"), doc.alias("doc")).filter("s_suppkey % 5 > 0"))
    got = Q.validate_tiles(
        index, archives, hashes, "https://example.org", "v2024.01.01", cityjson=Q.summarise_cityjson(objects),
        obj=Q.summarise_obj(*obj_tables(spark, sf)), gpkg=Q.layer_counts(layer_rows(spark, sf)), reports=report_rows(spark, sf),
    )
    got = _codes_as_text(got, ["obj_errors_lod12", "cj_errors_lod13"]).withColumn("cj_lod", F.array_join("cj_lod", " "))
    return A.shaped(
        got, "tile_id:s cj_zip_ok:b cj_nr_building:l cj_nr_buildingpart:l cj_lod:s cj_sha256:s cj_download:s obj_zip_ok:b obj_nr_building:l obj_nr_invalid_building:l "
        "obj_errors_lod12:s obj_download:s gpkg_zip_ok:b gpkg_nr_building:l gpkg_nr_buildingpart:l "
        "cj_nr_invalid_building:l cj_nr_invalid_buildingpart_lod22:l cj_errors_lod13:s cj_nr_mismatch_errors_lod12:l obj_sha256:s",
    )


VALIDATE_SQL = f"""
WITH {OBJ_CTE}, {LAYER_CTE}, s AS (SELECT CAST(s_suppkey AS VARCHAR) AS tile_id, s_suppkey AS k, s_name, s_acctbal FROM supplier)
SELECT s.tile_id, s_acctbal < 9000 AS cj_zip_ok, CASE WHEN k % 5 > 0 THEN 1 END AS cj_nr_building, CASE WHEN k % 5 > 0 THEN CAST(k % 3 > 0 AS BIGINT) END AS cj_nr_buildingpart,
  CASE WHEN k % 5 > 0 THEN CASE WHEN k % 3 > 0 THEN '0 1.2 2.2' ELSE '0' END END AS cj_lod, sha256(s_name || chr(10)) AS cj_sha256,
  'https://example.org/v20240101/tiles/' || s.tile_id || '/' || s.tile_id || '.city.json.gz' AS cj_download,
  CASE WHEN s_acctbal > 0 THEN s_acctbal < 9000 END AS obj_zip_ok, obj.nr_building AS obj_nr_building,
  obj.nr_invalid_building AS obj_nr_invalid_building, obj.errors_lod12 AS obj_errors_lod12,
  'https://example.org/v20240101/tiles/' || s.tile_id || '/' || s.tile_id || '-obj.zip' AS obj_download,
  s_acctbal < 9000 AS gpkg_zip_ok, gpkg.nr_building AS gpkg_nr_building, gpkg.nr_buildingpart AS gpkg_nr_buildingpart,
  rep.nr_invalid_building AS cj_nr_invalid_building, rep.nr_invalid_buildingpart_lod22 AS cj_nr_invalid_buildingpart_lod22,
  rep.errors_lod13 AS cj_errors_lod13, rep.nr_mismatch_errors_lod12 AS cj_nr_mismatch_errors_lod12, sha256(s_name || chr(10)) AS obj_sha256
FROM s LEFT JOIN obj ON s.tile_id = obj.tile_id LEFT JOIN gpkg ON s.tile_id = gpkg.tile_id LEFT JOIN ({_report_sql()}) rep ON s.tile_id = rep.tile_id"""


def layers_union(spark, sf):
    """Gzipped layers per tile, read back as one; tiles without data are reported."""
    root = f"{shared_dir(spark).rstrip('/')}/gevel-layers-{uuid.uuid4().hex}"
    li = A.table(spark, sf, "lineitem").selectExpr("concat('r', l_returnflag) AS tile_id", "l_linestatus", "l_orderkey", "l_quantity")
    layers = {"lod12": "O", "lod13": "F"}
    for name, status in layers.items():
        sinks.write_tiles_gz(li.filter(F.col("l_linestatus") == status).drop("l_linestatus"), f"{root}/{name}", "json")
    tiles = A.table(spark, sf, "lineitem").selectExpr("concat('r', l_returnflag) AS tile_id").distinct().unionByName(
        A.table(spark, sf, "orders").selectExpr("concat('o', o_orderstatus) AS tile_id").distinct()
    )
    every, missing = sinks.union_layers(spark, tiles, {n: f"{root}/{n}" for n in layers}, "json", schemas=dict.fromkeys(layers, "tile_id string, l_orderkey long, l_quantity double"))
    got = every.groupBy("layer", "tile_id").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    gone = missing.select("layer", "tile_id", F.lit(0).alias("n"), F.lit(0.0).alias("qty"))
    return A.shaped(got.unionByName(gone), "layer:s tile_id:s n:l qty:d")


LAYERS_UNION_SQL = """
SELECT CASE l_linestatus WHEN 'O' THEN 'lod12' ELSE 'lod13' END AS layer, 'r' || l_returnflag AS tile_id, count(*) AS n, sum(l_quantity) AS qty
FROM lineitem GROUP BY 1, 2
UNION ALL SELECT l.layer, 'o' || s.o_orderstatus, 0, 0.0 FROM (SELECT DISTINCT o_orderstatus FROM orders) s, (VALUES ('lod12'), ('lod13')) l(layer)"""


def sizes(spark, sf):
    """Total sizes."""
    d = A.table(spark, sf, "documents").select("lang", F.col("n_chars").alias("length"))
    got = L.sizes(d, per=["lang"]).withColumn("size_gb", F.round("size_gb", 9))
    return A.shaped(got, "lang:s n_files:l size_mb:d size_gb:d")


def bbox_filter(spark, sf):
    """buildings whose box meets the extent of a polygon text."""
    area = G.bbox_from_wkt(F.lit("POLYGON ((300 500, 900 400, 1000 1100, 300 500))"))
    o = order_boxes(spark, sf).withColumn("_b", area)
    return A.shaped(o.filter(G.in_bbox(F.col("_b.x0"), F.col("_b.y0"), F.col("_b.x1"), F.col("_b.y1"))), "fid:l x0:d y0:d")


CLOSED_CELLS = """
SELECT DISTINCT tile_id, j * 1073741824 + i + 1 AS cell_id FROM (
  SELECT tile_id, i, unnest(generate_series(greatest(CAST(ceil(y0/200) AS BIGINT) - 1, 0), least(CAST(floor(y1/200) AS BIGINT), 11))) AS j FROM (
    SELECT o_orderpriority AS tile_id, y0, y1, unnest(generate_series(greatest(CAST(ceil(x0/200) AS BIGINT) - 1, 0), CAST(floor(x1/200) AS BIGINT))) AS i
    FROM b JOIN orders ON fid = o_orderkey))"""

VIEW = (300.0, 250.0, 700.0, 640.0)


def clustered_box(spark, sf):
    """Buildings written in Morton order, and those of a box read back from the files that it meets."""
    path = f"{shared_dir(spark).rstrip('/')}/gevel-clustered-{uuid.uuid4().hex}"
    sinks.write_clustered(order_boxes(spark, sf).drop("rings"), path, files=16)
    return A.shaped(SF.read_box(spark, path, *VIEW), "fid:l x0:d y0:d x1:d y1:d")


def incremental_build(spark, sf):
    """Totals per partition after two runs, the second over changed files only."""
    path = f"{shared_dir(spark).rstrip('/')}/gevel-build-{uuid.uuid4().hex}"
    files = A.table(spark, sf, "orders").selectExpr("o_custkey % 97 AS tile_id", "CAST(o_orderkey AS string) AS file", "md5(CAST(o_totalprice AS string)) AS hash", "CAST(o_totalprice AS bigint) AS size")
    later = files.withColumn("hash", F.when(F.expr("tile_id % 7 = 3 AND CAST(file AS bigint) % 5 = 0"), F.md5("file")).otherwise(F.col("hash")))

    def build(run: int):
        return lambda rows: rows.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.lit(run).alias("run"))

    for run, now in enumerate((files, later, later), 1):
        sinks.build_changed(now, build(run), path)
    return A.shaped(spark.read.parquet(f"{path}/data"), "tile_id:l n:l total:l run:l")


QUERIES = {
    "clustered_box": (
        clustered_box,
        f"SELECT * FROM ({ORDER_BOXES}) WHERE x0 <= {VIEW[2]} AND x1 >= {VIEW[0]} AND y0 <= {VIEW[3]} AND y1 >= {VIEW[1]}",
    ),
    "incremental_build": (
        incremental_build,
        """SELECT o_custkey % 97 AS tile_id, count(*) AS n, CAST(sum(CAST(trunc(o_totalprice) AS BIGINT)) AS BIGINT) AS total,
        CAST(CASE WHEN o_custkey % 97 % 7 = 3 AND count(*) FILTER (o_orderkey % 5 = 0) > 0 THEN 2 ELSE 1 END AS BIGINT) AS run FROM orders GROUP BY 1""",
    ),
    "grid": (
        grid,
        f"""WITH t AS (SELECT s_suppkey AS tile_id, {A.box_sql('s_suppkey', **A.TILE)} FROM supplier),
        g AS (SELECT j*12 + i + 1 AS cell_id, i*200.0 AS x0, j*200.0 AS y0, i*200.0 + 200 AS x1, j*200.0 + 200 AS y1
          FROM (SELECT unnest(generate_series(0, 11)) AS i) a, (SELECT unnest(generate_series(0, 11)) AS j) b),
        m AS (SELECT g.cell_id, t.tile_id FROM g JOIN t ON t.x0 < g.x1 AND g.x0 < t.x1 AND t.y0 < g.y1 AND g.y0 < t.y1
          WHERE NOT (t.x0 >= g.x0 AND t.x1 <= g.x1 AND t.y0 >= g.y0 AND t.y1 <= g.y1) OR (t.x0 = g.x0 AND t.x1 = g.x1 AND t.y0 = g.y0 AND t.y1 = g.y1))
        SELECT CAST(g.cell_id AS BIGINT) AS cell_id, CAST(g.x0 AS DOUBLE) AS x0, CAST(g.y0 AS DOUBLE) AS y0, CAST(g.x1 AS DOUBLE) AS x1, CAST(g.y1 AS DOUBLE) AS y1,
          array_to_string(list_sort(list(m.tile_id) FILTER (m.tile_id IS NOT NULL)), ',') AS tiles, count(m.tile_id) AS n
        FROM g LEFT JOIN m ON g.cell_id = m.cell_id GROUP BY ALL""",
    ),
    "tile_cells": (tile_cells, f"WITH b AS ({ORDER_BOXES}) {CLOSED_CELLS}"),
    "quadtree": (
        quadtree,
        f"""WITH {QUAD_CTE.replace('WEIGHT', '1').replace('CAP', str(CAPACITY))}
        SELECT tile_id, CAST({DEPTH} - k AS BIGINT) AS level, CAST(n AS BIGINT) AS nr_items, nx*pow(2,k)*{CELL} AS x0, ny*pow(2,k)*{CELL} AS y0,
          (nx+1)*pow(2,k)*{CELL} AS x1, (ny+1)*pow(2,k)*{CELL} AS y1 FROM leaf""",
    ),
    "quadtree_index": (
        quadtree_index,
        f"""WITH {QUAD_CTE.replace('WEIGHT', 'w').replace('CAP', str(CAPACITY * 20))}
        SELECT tile_id, count(*) AS n, CAST(sum(fid) AS BIGINT) AS fids FROM p JOIN leaf
          ON p.i // CAST(pow(2, k) AS BIGINT) = nx AND p.j // CAST(pow(2, k) AS BIGINT) = ny GROUP BY 1""",
    ),
    "tile_members": (
        tile_members,
        f"""WITH p AS (SELECT (x1-x0)*(y1-y0) AS a, CAST(floor(x0/256) AS BIGINT) AS i, CAST(floor(y0/256) AS BIGINT) AS j FROM ({ORDER_BOXES})),
        lv AS (SELECT unnest(generate_series(0, 4)) AS k),
        n AS (SELECT k, i // CAST(pow(2, k) AS BIGINT) AS nx, j // CAST(pow(2, k) AS BIGINT) AS ny, count(*) AS n FROM p, lv GROUP BY 1, 2, 3),
        leaf AS (SELECT c.*, (4 - c.k) || '/' || c.nx || '/' || c.ny AS tile_id FROM n c LEFT JOIN n q ON q.k = c.k + 1 AND q.nx = c.nx // 2 AND q.ny = c.ny // 2
          WHERE (c.n <= 300 OR c.k = 0) AND (c.k = 4 OR q.n > 300))
        SELECT tile_id, count(*) AS n, sum(a) AS area FROM p JOIN leaf
          ON p.i // CAST(pow(2, k) AS BIGINT) = nx AND p.j // CAST(pow(2, k) AS BIGINT) = ny GROUP BY 1""",
    ),
    "point_stats": (
        point_stats,
        f"""WITH p AS (SELECT l_quantity AS z, {A.LINE_POINT} FROM lineitem)
        SELECT CAST(floor(y/200)*12 + floor(x/200) + 1 AS BIGINT) AS cell_id, count(*) AS n_points, {POINT_STATS} FROM p GROUP BY 1""",
    ),
    "best_cloud": (
        best_cloud,
        """WITH s AS (SELECT l_orderkey AS id, l_returnflag AS cloud, max(l_quantity) AS coverage, min(l_linenumber) AS q FROM lineitem GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coverage DESC, q, cloud) AS rn, count(*) OVER (PARTITION BY id) AS n,
          max(coverage) OVER (PARTITION BY id) AS top FROM s),
        t AS (SELECT id, count(*) FILTER (coverage = top) AS k FROM r GROUP BY 1)
        SELECT r.id AS identificatie, cloud, coverage, CASE WHEN n = 1 THEN 'only' WHEN k > 1 THEN 'quality' ELSE 'coverage' END AS reason
        FROM r JOIN t ON r.id = t.id WHERE rn = 1""",
    ),
    "export_index": (export_index, EXPORT_SQL),
    "links": (
        links,
        f"""SELECT {TILE_ID_SQL} AS tile_id, CASE o_orderstatus WHEN 'F' THEN 'cityjson' WHEN 'O' THEN 'gpkg' ELSE 'obj' END AS fmt,
        'https://example.org/v' || strftime(o_orderdate, '%Y%m%d') || '/tiles/' || {TILE_ID_SQL} || '/' || replace({TILE_ID_SQL}, '/', '-') ||
        CASE o_orderstatus WHEN 'F' THEN '.city.json.gz' WHEN 'O' THEN '.gpkg.gz' ELSE '-obj.zip' END AS link FROM orders""",
    ),
    "blank_casts": (blank_casts, BLANK_SQL),
    "layer_counts": (layer_counts, f"WITH {LAYER_CTE} SELECT * FROM gpkg"),
    "obj_lines": (obj_lines, f"WITH {OBJ_CTE} SELECT * FROM obj"),
    "reports": (reports, _report_sql()),
    "validate_tiles": (validate_tiles, VALIDATE_SQL),
    "layers_union": (layers_union, LAYERS_UNION_SQL),
    "sizes": (
        sizes,
        "SELECT lang, count(*) AS n_files, round(sum(n_chars)/1e6, 2) AS size_mb, round(sum(n_chars)/1e9, 9) AS size_gb FROM documents GROUP BY 1",
    ),
    "bbox_filter": (
        bbox_filter, f"SELECT fid, x0, y0 FROM ({ORDER_BOXES}) WHERE x0 <= 1000 AND x1 >= 300 AND y0 <= 1100 AND y1 >= 400",
    ),
}
