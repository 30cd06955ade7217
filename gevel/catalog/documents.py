"""Document, surface and file-format queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gevel import sinks
from gevel.catalog import adapters as A
from gevel.functions import geometry as G
from gevel.functions.rows import spread
from gevel.operators import documents as D
from gevel.operators import features as FE
from gevel.operators import history as H
from gevel.session import shared_dir
from gevel.sources import files as SF
from gevel.sources import register as RG

PAND = "concat('NL.IMBAG.Pand.', lpad(CAST(event_id AS string), 16, '0'))"
PAND_SQL = "'NL.IMBAG.Pand.' || lpad(CAST(event_id AS VARCHAR), 16, '0')"


def event_docs(spark, sf):
    """Events as building documents: a building and, for views and clicks, one part."""
    building = (
        "concat('\"', id, '\":{\"type\":\"Building\",\"attributes\":{\"b3_pw_bron\":\"', event_type, '\",\"b3_puntdichtheid_AHN3\":', value, "
        "',\"b3_opp_grond\":null,\"user\":', user_id, ',\"kas\":', CAST(value > 50 AS string), '},\"geometry\":[', "
        "CASE WHEN event_type = 'purchase' THEN '' ELSE '{\"lod\":\"0\"}' END, ']}')"
    )
    part = (
        "CASE WHEN event_type IN ('view', 'click') THEN concat(',\"', id, '-0\":{\"type\":\"BuildingPart\",\"geometry\":[{\"lod\":\"1.2\"},"
        "{\"lod\":\"', CASE WHEN value > 50 THEN '2.2' ELSE '1.3' END, '\"}]}') ELSE '' END"
    )
    e = A.table(spark, sf, "events").withColumn("id", F.expr(PAND))
    doc = f"concat('{{\"type\":\"CityJSONFeature\",\"id\":\"', id, '\",\"vertices\":[[1,2,3]],\"CityObjects\":{{', {building}, {part}, '}}}}')"
    return e.selectExpr("id", "user_id", "event_type", "value", f"{doc} AS doc")


def presence(spark, sf):
    """Flags and attributes shared by the objects of a document."""
    got = D.lod_presence(event_docs(spark, sf))
    return A.shaped(
        got, "id:s identificatie:s lod_0:l lod_12:l lod_13:l lod_22:l has_geometry:b b3_pw_bron:s b3_puntdichtheid_AHN3:d b3_pw_selectie_reden:s"
    )


def presence_per_object(spark, sf):
    """P12 read object by object."""
    got = D.lod_presence(event_docs(spark, sf), per_object=True)
    return A.shaped(got, "id:s lod_0:l lod_12:l lod_13:l lod_22:l has_geometry:b b3_pw_bron:s")


PRESENCE_CTE = f"""e AS (SELECT {PAND_SQL} AS id, event_type, value, event_type IN ('view', 'click') AS part FROM events),
o AS (SELECT id AS oid, false AS is_part, * FROM e UNION ALL SELECT id || '-0', true, * FROM e WHERE part)"""


def attributes(spark, sf):
    """Documents after new attribute values, read back."""
    docs = event_docs(spark, sf)
    values = A.table(spark, sf, "events").filter("value > 20").select(
        F.expr(PAND).alias("id"), F.col("value").alias("area_ground"), F.round(F.col("value") / 2, 3).alias("area_roof_flat"),
        F.lit(None).cast("double").alias("area_roof_sloped"), F.col("user_id").cast("double").alias("area_shared_wall"),
        F.lit(1.5).alias("area_exterior_wall"),
    )
    new, _ = D.set_surface_areas(docs.select("id", "doc"), values)
    got = D.get_attributes(new).select(
        "id", *[F.col("attributes")[k].alias(k) for k in ("b3_pw_bron", "user", "kas", *D.SURFACE_ATTRIBUTES.values())]
    )
    return A.shaped(
        got, "id:s b3_pw_bron:s user:l kas:b b3_opp_grond:d b3_opp_dak_plat:d b3_opp_dak_schuin:d b3_opp_scheidingsmuur:d b3_opp_buitenmuur:d"
    )


def write_back(spark, sf):
    """Documents written below their tile and read again."""
    docs = event_docs(spark, sf).withColumn("tile_id", F.concat(F.lit("t"), "event_type"))
    values = docs.filter("value <= 50").select("id", F.rint(F.col("value") / 8).cast("int").alias("n"))
    new, _ = D.set_attributes(docs.select("id", "tile_id", "doc"), values, {"n": "b3_bouwlagen"}, how="left")
    path = f"{shared_dir(spark).rstrip('/')}/gevel-docs-{uuid.uuid4().hex}"
    sinks.write_features(new, path)
    back = SF.read_features(spark, path).withColumn("tile_id", F.regexp_extract("path", "tile_id=([^/]+)/", 1))
    objects = D.city_objects(back.select("tile_id", "id", "doc")).filter("type = 'Building' AND coid = id")
    got = objects.select("tile_id", "id", F.col("attributes")["b3_bouwlagen"].alias("b3_bouwlagen"))
    return A.shaped(got, "tile_id:s id:s b3_bouwlagen:l")


MODEL_JSON = {
    "oorspronkelijkbouwjaar": "1900 + p_size", "b3_dak_type": "p_type", "b3_h_dak_50p": "p_size / 2.0", "b3_h_dak_70p": "p_size / 2.0 + 1",
    "b3_h_dak_max": "p_size * 1.5", "b3_h_dak_min": "p_size / 4.0", "b3_opp_dak_plat": "CASE WHEN p_size % 5 > 0 THEN p_size * 3.0 END",
    "b3_opp_dak_schuin": "p_size * 0.25", "b3_opp_buitenmuur": "p_size * 4.0", "b3_opp_scheidingsmuur": "p_size * 0.5", "b3_opp_grond": "p_size * 2.0",
    "b3_volume_lod22": "p_size * 20.0", "b3_volume_lod12": "p_size * 21.0",
}


def building_features(spark, sf):
    """Model columns from the document attributes."""
    p = A.table(spark, sf, "part")
    fields = F.struct(*[F.expr(e).cast("string" if n == "b3_dak_type" else "double").alias(n) for n, e in MODEL_JSON.items()])
    id = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    body = F.to_json(fields, {"ignoreNullFields": "false"})
    doc = F.concat(F.lit('{"CityObjects":{"'), id, F.lit('":{"type":"Building","attributes":'), body, F.lit("}}}"))
    docs = p.select(id.alias("id"), doc.alias("doc"))
    # the year is a whole number in the documents
    docs = docs.withColumn("doc", F.regexp_replace("doc", r'("oorspronkelijkbouwjaar":\d+)\.0', "$1"))
    got = FE.building_features(D.get_attributes(docs.unionByName(docs)))
    ddl = "id:s construction_year:l roof_type:s " + " ".join(f"{c}:d" for c in got.columns[3:])
    return A.shaped(got, ddl)


def dequantised(spark, sf):
    """Integer vertices as coordinates."""
    o = A.table(spark, sf, "orders").select("o_orderkey", F.array(F.array("o_orderkey", "o_custkey", F.lit(5).cast("long"))).alias("v"))
    got = o.select("o_orderkey", F.inline(D.dequantise("v")))
    return A.shaped(got.select("o_orderkey", *[F.round(c, 6).alias(c) for c in "xyz"]), "o_orderkey:l x:d y:d z:d")


def row_houses(spark, sf):
    """Parts as box houses in rows of ten, turned by the angle of (3, 4, 5); neighbours share a wall as high as the lower one."""
    k = F.col("p_partkey")
    x0, y0, h = ((k % 10) * 10).cast("double"), (F.floor(k / 10) * 30).cast("double"), F.col("p_size").cast("double")
    df = spread(A.table(spark, sf, "part")).select(k.alias("identificatie"), x0.alias("x0"), y0.alias("y0"), (x0 + 10).alias("x1"), (y0 + 10).alias("y1"), h.alias("h"))
    zero = F.lit(0.0)

    def face(kind, *corners):
        turned = [(x * 0.6 - y * 0.8, x * 0.8 + y * 0.6, z) for x, y, z in corners]
        ring = [F.struct(*[v.alias(n) for n, v in zip("xyz", c)]) for c in (*turned, turned[0])]
        return F.struct(F.lit(kind).alias("type"), F.array(*ring).alias("ring"))

    a, b, c, d, e = (F.col(n) for n in ("x0", "y0", "x1", "y1", "h"))
    ridge = e + 5
    faces = F.array(
        face("GroundSurface", (a, b, zero), (a, d, zero), (c, d, zero), (c, b, zero)),
        face("RoofSurface", (a, b, e), (c, b, e), (c, b + 5, e), (a, b + 5, e)),
        face("RoofSurface", (a, b + 5, e), (c, b + 5, e), (c, d, ridge), (a, d, ridge)),
        face("WallSurface", (a, b, zero), (c, b, zero), (c, b, e), (a, b, e)),
        face("WallSurface", (c, d, zero), (a, d, zero), (a, d, ridge), (c, d, ridge)),
        face("WallSurface", (c, b, zero), (c, d, zero), (c, d, e), (c, b, e)),
        face("WallSurface", (a, d, zero), (a, b, zero), (a, b, e), (a, d, e)),
    )
    out = df.select("identificatie", F.posexplode(faces).alias("n", "f"))
    return out.select("identificatie", (F.col("identificatie") * 8 + F.col("n")).alias("surface_id"), "f.type", "f.ring")


def surfaces(spark, sf):
    """Ground, roof, shared and exterior wall areas."""
    got = D.surface_areas(row_houses(spark, sf))
    cols = [c for c in got.columns if c != "identificatie"]
    return A.shaped(got.select("identificatie", *[F.round(c, 6).alias(c) for c in cols]), "identificatie:l " + " ".join(f"{c}:d" for c in cols))


SURFACE_SQL = """
WITH p AS (SELECT p_partkey AS k, CAST(p_size AS DOUBLE) AS h FROM part),
s AS (SELECT p.k, p.h, coalesce(l.h, 0) AS lh, coalesce(r.h, 0) AS rh FROM p LEFT JOIN p l ON l.k = p.k - 1 AND p.k % 10 > 0
  LEFT JOIN p r ON r.k = p.k + 1 AND p.k % 10 < 9),
t AS (SELECT k, h, 10*least(h, lh) + 10*least(h, rh) AS shared FROM s)
SELECT k AS identificatie, 100.0::DOUBLE AS area_ground, 50.0::DOUBLE AS area_roof_flat, round(10*sqrt(50.0), 6) AS area_roof_sloped,
  round(shared, 6) AS area_shared_wall, round(10*h + 10*(h+5) + 20*h - shared, 6) AS area_exterior_wall FROM t"""


def register_xml(spark, sf):
    """Register objects from XML text, with their polygon parts."""
    o = A.boxes(A.table(spark, sf, "orders"), "o_orderkey", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    ix = [f"CAST(CAST({c} AS bigint) AS string)" for c in G.BOX]
    pos = f"concat_ws(' ', {ix[0]}, {ix[1]}, '0', {ix[2]}, {ix[1]}, '0', {ix[2]}, {ix[3]}, '0', {ix[0]}, {ix[3]}, '0', {ix[0]}, {ix[1]}, '0')"
    when = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")"
    xml = o.selectExpr(
        "o_orderkey AS ogc_fid",
        "concat('<Objecten:Pand xmlns:Objecten=\"o\" xmlns:Historie=\"h\" xmlns:gml=\"g\"><Objecten:identificatie domein=\"NL.IMBAG.Pand\">', "
        "lpad(CAST(o_orderkey AS string), 16, '0'), '</Objecten:identificatie><Objecten:geometrie><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>', "
        f"{pos}, '</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></Objecten:geometrie>', "
        "'<Objecten:oorspronkelijkBouwjaar>', 1900 + o_custkey % 100, '</Objecten:oorspronkelijkBouwjaar><Objecten:status>Pand ', o_orderstatus, "
        "'</Objecten:status><Objecten:geconstateerd>', CASE WHEN o_custkey % 2 = 0 THEN 'J' ELSE 'N' END, '</Objecten:geconstateerd>', "
        "'<Objecten:voorkomen><Historie:Voorkomen><Historie:voorkomenidentificatie>1</Historie:voorkomenidentificatie><Historie:beginGeldigheid>', "
        f"{when}, '</Historie:beginGeldigheid><Historie:BeschikbaarLV><Historie:tijdstipRegistratieLV>', {when}, "
        "'</Historie:tijdstipRegistratieLV></Historie:BeschikbaarLV></Historie:Voorkomen></Objecten:voorkomen></Objecten:Pand>') AS xml",
    )
    rows = RG.parse_register(xml, "pand")
    now = H.snapshot_as_of(rows, H.reference_date("1998-06-01"), ["Pand O"])
    got = G.explode_parts(now, "geometry").withColumn("area", G.area("rings"))
    return A.shaped(got, "ogc_fid:l identificatie:s oorspronkelijkbouwjaar:l status:s geconstateerd:b voorkomenidentificatie:l area:d")


def geojson(spark, sf):
    """Features of a collection with a link and a polygon."""
    s = A.table(spark, sf, "supplier")
    doc = F.expr(
        "concat('{\"features\":[{\"properties\":{\"AHN\":\"T', s_suppkey, '\",\"link\":\"', s_name, '\"},\"geometry\":{\"type\":\"Polygon\",\"coordinates\":[[[0,0],[', "
        "s_suppkey, ',0],[', s_suppkey, ',4],[0,4],[0,0]]]}}]}')"
    )
    got = SF.parse_geojson(s.select(doc.alias("doc")), "doc", "AHN", ["link"])
    return A.shaped(got.select("tile_id", "link", G.area("rings").alias("area"), G.to_wkt("rings").alias("wkt")), "tile_id:s link:s area:d wkt:s")


def multipart_regions(spark, sf):
    """Every part of regions with several parts, from GeoJSON and from text."""
    s = A.table(spark, sf, "supplier")
    parts = "[[[0,0],[4,0],[4,3],[0,3],[0,0]]],[[[9,0],[', 9 + s_suppkey, ',0],[', 9 + s_suppkey, ',2],[9,2],[9,0]],[[10,0.5],[10.5,0.5],[10.5,1],[10,1],[10,0.5]]]"
    doc = F.expr(f"concat('{{\"features\":\n[{{\"properties\":{{\"AHN\":\"T', s_suppkey, '\"}},\n\"geometry\":{{\"type\":\"MultiPolygon\",\"coordinates\":[{parts}]}}}}]}}')")
    got = SF.parse_geojson(s.select(doc.alias("doc")), "doc", "AHN").select("tile_id", "rings")
    text = F.expr("concat('MULTIPOLYGON (((0 0, 4 0, 4 3, 0 3, 0 0)), ((9 0, ', 9 + s_suppkey, ' 0, ', 9 + s_suppkey, ' 2, 9 2, 9 0), (10 0.5, 10.5 0.5, 10.5 1, 10 1, 10 0.5)))')")
    wkt = s.select(F.expr("concat('w', s_suppkey)").alias("tile_id"), F.explode(G.parts_from_wkt(text)).alias("rings"))
    return A.shaped(got.unionByName(wkt).select("tile_id", F.size("rings").alias("n_rings"), F.round(G.area("rings"), 6).alias("area")), "tile_id:s n_rings:l area:d")


def file_index(spark, sf):
    """Building documents found by their path, in both layouts."""
    o = A.table(spark, sf, "orders")
    path = F.when(
        F.col("o_custkey") % 3 == 0, F.expr("concat('/f/6/240/', o_custkey, '/objects/P', o_orderkey, '/reconstruct/P', o_orderkey, '.city.jsonl')")
    ).when(F.col("o_custkey") % 3 == 1, F.expr("concat('/f/6/240/', o_custkey, '/P', o_orderkey, '.city.jsonl')")).otherwise(
        F.expr("concat('/f/6/240/', o_custkey, '/objects/P', o_orderkey, '/reconstruct/other.city.jsonl')")
    )
    files = o.select(path.alias("path"))
    a = SF.index_features(files, "objects").withColumn("layout", F.lit("objects"))
    b = SF.index_features(files, "tiles").withColumn("layout", F.lit("tiles"))
    return A.shaped(a.unionByName(b), "layout:s id:s tile_id:s")


QUERIES = {
    "presence": (
        presence,
        f"""WITH {PRESENCE_CTE}
        SELECT oid AS id, id AS identificatie, CAST(event_type <> 'purchase' AS BIGINT) AS lod_0, CAST(part AS BIGINT) AS lod_12, CAST(part AND value <= 50 AS BIGINT) AS lod_13,
        CAST(part AND value > 50 AS BIGINT) AS lod_22, event_type <> 'purchase' AS has_geometry, event_type AS b3_pw_bron, value AS "b3_puntdichtheid_AHN3",
        CAST(NULL AS VARCHAR) AS b3_pw_selectie_reden FROM o""",
    ),
    "presence_per_object": (
        presence_per_object,
        f"""WITH {PRESENCE_CTE}
        SELECT oid AS id, CAST(NOT is_part AND event_type <> 'purchase' AS BIGINT) AS lod_0, CAST(is_part AS BIGINT) AS lod_12, CAST(is_part AND value <= 50 AS BIGINT) AS lod_13,
        CAST(is_part AND value > 50 AS BIGINT) AS lod_22, is_part OR event_type <> 'purchase' AS has_geometry, CASE WHEN NOT is_part THEN event_type END AS b3_pw_bron FROM o""",
    ),
    "attributes": (
        attributes,
        f"""SELECT {PAND_SQL} AS id, event_type AS b3_pw_bron, user_id AS "user", value > 50 AS kas, value AS b3_opp_grond, round(value / 2, 3) AS b3_opp_dak_plat,
        CAST(NULL AS DOUBLE) AS b3_opp_dak_schuin, CAST(user_id AS DOUBLE) AS b3_opp_scheidingsmuur, CAST(1.5 AS DOUBLE) AS b3_opp_buitenmuur FROM events WHERE value > 20""",
    ),
    "write_back": (
        write_back,
        f"SELECT 't' || event_type AS tile_id, {PAND_SQL} AS id, CASE WHEN value <= 50 THEN CAST(round_even(value / 8, 0) AS BIGINT) END AS b3_bouwlagen FROM events",
    ),
    "building_features": (
        building_features,
        """SELECT 'P' || p_partkey AS id, CAST(1900 + p_size AS BIGINT) AS construction_year, p_type AS roof_type, p_size/2.0 AS h_roof_50p, p_size/2.0+1 AS h_roof_70p,
        CAST(p_size*1.5 AS DOUBLE) AS h_roof_max, p_size/4.0 AS h_roof_min, CAST(CASE WHEN p_size % 5 > 0 THEN p_size*3.25 END AS DOUBLE) AS area_roof,
        CAST(p_size*4.0 AS DOUBLE) AS area_ext_walls, CAST(p_size*0.5 AS DOUBLE) AS area_party_walls, CAST(p_size*2.0 AS DOUBLE) AS area_ground,
        CAST(p_size*20.0 AS DOUBLE) AS volume_lod22, CAST(p_size*21.0 AS DOUBLE) AS volume_lod12 FROM part""",
    ),
    "dequantised": (
        dequantised,
        "SELECT o_orderkey, round(o_orderkey*0.001::DOUBLE + 171800, 6) AS x, round(o_custkey*0.001::DOUBLE + 472700, 6) AS y, round(5*0.001::DOUBLE, 6) AS z FROM orders",
    ),
    "surfaces": (surfaces, SURFACE_SQL),
    "register_xml": (
        register_xml,
        f"""SELECT o_orderkey AS ogc_fid, 'NL.IMBAG.Pand.' || lpad(CAST(o_orderkey AS VARCHAR), 16, '0') AS identificatie, 1900 + o_custkey % 100 AS oorspronkelijkbouwjaar,
        'Pand ' || o_orderstatus AS status, o_custkey % 2 = 0 AS geconstateerd, CAST(1 AS BIGINT) AS voorkomenidentificatie, (x1-x0)*(y1-y0) AS area
        FROM (SELECT *, {A.box_sql('o_orderkey')} FROM orders) WHERE o_orderdate <= TIMESTAMP '1998-06-01' AND o_orderstatus <> 'O'""",
    ),
    "geojson": (
        geojson,
        """SELECT 't' || s_suppkey AS tile_id, s_name AS link, CAST(s_suppkey*4 AS DOUBLE) AS area, 'POLYGON((0.0 0.0,' || s_suppkey || '.0 0.0,' || s_suppkey || '.0 4.0,0.0 4.0,0.0 0.0))' AS wkt
        FROM supplier""",
    ),
    "multipart_regions": (
        multipart_regions,
        """SELECT k || s_suppkey AS tile_id, CAST(n AS BIGINT) AS n_rings, CAST(CASE n WHEN 1 THEN 12 ELSE 2 * s_suppkey - 0.25 END AS DOUBLE) AS area
        FROM supplier, (VALUES ('t'), ('w')) a(k), (VALUES (1), (2)) b(n)""",
    ),
    "file_index": (
        file_index,
        """SELECT CASE WHEN o_custkey % 3 = 0 THEN 'objects' ELSE 'tiles' END AS layout, 'P' || o_orderkey AS id, '6/240/' || o_custkey AS tile_id FROM orders WHERE o_custkey % 3 < 2""",
    ),
}
