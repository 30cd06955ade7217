"""Spatial queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gevel.catalog import adapters as A
from gevel.functions import geometry as G
from gevel.functions.rows import by_merge, settle, spread
from gevel.operators import features as FE
from gevel.operators import history as H
from gevel.operators import points as PT
from gevel.operators import regions as RN
from gevel.operators import spatial as S
from gevel.plans import reconstruction as R


def order_boxes(spark, sf):
    return A.boxes(A.table(spark, sf, "orders"), "o_orderkey", "o_orderkey AS fid")


ORDER_BOXES = f"SELECT o_orderkey AS fid, {A.box_sql('o_orderkey')} FROM orders"


def part_boxes(spark, sf, *cols, **size):
    return A.boxes(A.table(spark, sf, "part"), "p_partkey", "p_partkey AS fid", *cols, **size)


def part_sql(cols: str = "", **size) -> str:
    return f"SELECT p_partkey AS fid, {cols} {A.box_sql('p_partkey', **size)} FROM part"


# area of the union of intersections = number of distinct unit cells covered by a neighbour
OVERLAP_CTE = """
pairs AS (
  SELECT a.fid, greatest(a.x0, n.x0) AS gx0, greatest(a.y0, n.y0) AS gy0, least(a.x1, n.x1) AS gx1, least(a.y1, n.y1) AS gy1
  FROM b a JOIN b n ON a.fid <> n.fid AND a.x0 <= n.x1 AND n.x0 <= a.x1 AND a.y0 <= n.y1 AND n.y0 <= a.y1),
cells AS (
  SELECT DISTINCT fid, ux, uy FROM (
    SELECT fid, gy0, gy1, unnest(generate_series(CAST(gx0 AS BIGINT), CAST(gx1 AS BIGINT) - 1)) AS ux FROM pairs) t,
    LATERAL (SELECT unnest(generate_series(CAST(gy0 AS BIGINT), CAST(gy1 AS BIGINT) - 1)) AS uy) u),
overlap AS (
  SELECT p.fid, CAST(CASE WHEN count(c.ux) < 1 THEN 0 ELSE count(c.ux) END AS DOUBLE) AS b3_bag_bag_overlap
  FROM (SELECT DISTINCT fid FROM pairs) p LEFT JOIN cells c ON p.fid = c.fid GROUP BY p.fid)"""


def overlap(spark, sf):
    """Area shared with the union of all touching buildings."""
    return A.shaped(S.overlap_area(order_boxes(spark, sf)), "fid:l b3_bag_bag_overlap:d")


# places where hundreds of outlines meet in a cell: two thousand keys share an area of 200 by 200
CROWD_BOX = (
    "CAST({k} - {k} % 2000 + {k} % 2000 * 7919 % 199 AS DOUBLE) AS x0, CAST({k} % 2000 * 104729 % 197 AS DOUBLE) AS y0, "
    "CAST({k} - {k} % 2000 + {k} % 2000 * 7919 % 199 + 5 + {k} % 11 AS DOUBLE) AS x1, CAST({k} % 2000 * 104729 % 197 + 5 + {k} % 7 AS DOUBLE) AS y1"
).format(k="p_partkey")


def overlap_crowd(spark, sf):
    """Overlap where so many outlines meet that cells are split."""
    b = A.table(spark, sf, "part").selectExpr("p_partkey AS fid", *CROWD_BOX.split(", ")).withColumn("rings", G.box_rings(*G.BOX))
    return A.shaped(S.overlap_area(b, crowd=64), "fid:l b3_bag_bag_overlap:d")


def overlap_by_brand(spark, sf):
    """J1 with further equal keys: overlap among the parts of one brand."""
    parts = part_boxes(spark, sf, "p_brand", **A.GREENHOUSE)
    return A.shaped(S.overlap_area(parts, on=["p_brand"]), "fid:l p_brand:s b3_bag_bag_overlap:d")


WANTED = ("ECONOMY", "Brand#1")


def greenhouses(spark, sf):
    return part_boxes(spark, sf, "array(p_type, p_brand) AS typegebouw", **A.GREENHOUSE)


LABEL_CTE = f"""
g AS ({part_sql("p_type, p_brand,", **A.GREENHOUSE)}),
isect AS (
  SELECT b.fid, sum((least(b.x1, g.x1) - greatest(b.x0, g.x0)) * (least(b.y1, g.y1) - greatest(b.y0, g.y0))) AS a
  FROM b JOIN g ON b.x0 <= g.x1 AND g.x0 <= b.x1 AND b.y0 <= g.y1 AND g.y0 <= b.y1
  WHERE g.p_type = 'ECONOMY' OR g.p_brand = 'Brand#1' GROUP BY b.fid),
label AS (
  SELECT b.fid, coalesce(i.a / ((b.x1 - b.x0) * (b.y1 - b.y0)) > 0.11, false) AS kas_warenhuis
  FROM b LEFT JOIN isect i ON b.fid = i.fid)"""


def label(spark, sf):
    """Buildings largely covered by polygons of chosen kinds."""
    out = S.label_by_overlap(order_boxes(spark, sf), greenhouses(spark, sf), wanted=WANTED)
    return A.shaped(out, "fid:l kas_warenhuis:b")


def overlap_slanted(spark, sf):
    """The same buildings turned by 45 degrees, so that no shape is an upright box."""
    got = S.overlap_area(A.slanted(order_boxes(spark, sf)), min_area=0.5)
    return A.shaped(got.withColumn("b3_bag_bag_overlap", F.round(F.col("b3_bag_bag_overlap") * 2, 6)), "fid:l b3_bag_bag_overlap:d")


def label_slanted(spark, sf):
    """Buildings and greenhouses turned by 45 degrees."""
    out = S.label_by_overlap(A.slanted(order_boxes(spark, sf)), A.slanted(greenhouses(spark, sf)), wanted=WANTED)
    return A.shaped(out, "fid:l kas_warenhuis:b")


def customer_points(spark, sf):
    c = A.boxes(A.table(spark, sf, "customer"), "c_custkey", "c_custkey")
    return c.select("c_custkey", F.col("x0").alias("cx"), F.col("y0").alias("cy"))


CUSTOMER_POINTS = f"SELECT c_custkey, x0 AS cx, y0 AS cy FROM (SELECT c_custkey, {A.box_sql('c_custkey')} FROM customer)"


def neighbours(spark, sf):
    """Other points within 100 units; none is NULL."""
    pts = customer_points(spark, sf)
    n = S.neighbours_within(pts, 100.0, id="c_custkey")
    return A.shaped(pts.join(n, "c_custkey", "left"), "c_custkey:l no_neighbours:l")


def adjacent(spark, sf):
    """Buildings that meet the building grown by 0.1."""
    parts = part_boxes(spark, sf, **A.GREENHOUSE)
    n = S.adjacent_count(parts, "fid")
    return A.shaped(parts.select("fid").join(by_merge(n), "fid", "left"), "fid:l no_adjacent:l")


def adjacent_slanted(spark, sf):
    """The same buildings turned by 45 degrees, so that the grown shapes are no upright boxes."""
    parts = A.slanted(part_boxes(spark, sf, **A.GREENHOUSE))
    return A.shaped(parts.select("fid").join(by_merge(S.adjacent_count(parts, "fid")), "fid", "left"), "fid:l no_adjacent:l")


ADJACENT_SQL = f"""WITH b AS ({part_sql(**A.GREENHOUSE)}), n AS (SELECT a.fid, count(*) AS c FROM b a JOIN b n ON a.fid <> n.fid
          AND a.x0 - 0.1 <= n.x1 AND n.x0 <= a.x1 + 0.1 AND a.y0 - 0.1 <= n.y1 AND n.y0 <= a.y1 + 0.1 GROUP BY 1)
        SELECT b.fid, n.c AS no_adjacent FROM b LEFT JOIN n ON b.fid = n.fid"""


def region_of_point(spark, sf):
    """The region whose interior holds the point."""
    pts = A.boxes(A.table(spark, sf, "customer"), "c_custkey", "c_custkey", town=False)
    pts = pts.select("c_custkey", F.col("x0").alias("px"), F.col("y0").alias("py"))
    got = RN.assign_region(pts, A.nations(spark, sf), "n_name", "c_custkey", "contains")
    return A.shaped(got, "c_custkey:l n_name:s")


def region_of_slanted(spark, sf):
    """Points and buildings in regions turned by 45 degrees."""
    pts = A.boxes(A.table(spark, sf, "customer"), "c_custkey", "c_custkey", town=False)
    pts = pts.select(F.col("c_custkey").alias("id"), ((F.col("x0") + F.col("y0")) / 2).alias("px"), ((F.col("x0") - F.col("y0")) / 2).alias("py"))
    regions = A.slanted(A.nations(spark, sf))
    points = RN.assign_region(pts, regions, "n_name", "id", "contains").withColumn("kind", F.lit("point"))
    parts = A.slanted(part_boxes(spark, sf, town=False)).withColumnRenamed("fid", "id")
    shapes = RN.assign_region(parts, regions, "n_name", "id").withColumn("kind", F.lit("shape"))
    return A.shaped(points.unionByName(shapes), "kind:s id:l n_name:s")


STEPS = 2500


def regions_of_many_vertices(spark, sf):
    """Points and buildings in regions of ten thousand vertices, whose every second edge point lies a little further in."""
    nat = A.nations(spark, sf)
    edge = F.sequence(F.lit(0), F.lit(STEPS - 1))
    corners = [("x0", "y0", 1, 0), ("x1", "y0", 0, 1), ("x1", "y1", -1, 0), ("x0", "y1", 0, -1)]

    def side(x: str, y: str, dx: int, dy: int):
        """Points along one side; the inside is to the left of (dx, dy)."""
        step = 400.0 / STEPS
        far = lambda i: F.when(i % 2 == 1, 0.25).otherwise(0.0)
        return F.transform(edge, lambda i: G.point(F.col(x) + i * step * dx - far(i) * dy, F.col(y) + i * step * dy + far(i) * dx))

    ring = F.concat(*[side(*c) for c in corners], F.array(G.point("x0", "y0")))
    fine = nat.select("n_name", F.array(ring).alias("rings"))
    pts = A.boxes(A.table(spark, sf, "customer"), "c_custkey", "c_custkey", town=False)
    # places between whole numbers stay clear of the saw teeth
    pts = pts.select(F.col("c_custkey").alias("id"), (F.col("x0") + 0.5).alias("px"), (F.col("y0") + 0.5).alias("py"))
    points = RN.assign_region(pts, fine, "n_name", "id", "contains").withColumn("kind", F.lit("point"))
    parts = part_boxes(spark, sf, town=False, **A.GREENHOUSE).withColumnRenamed("fid", "id")
    shapes = RN.assign_region(parts, fine, "n_name", "id").withColumn("kind", F.lit("shape"))
    return A.shaped(points.unionByName(shapes), "kind:s id:l n_name:s")


def region_of_building(spark, sf):
    """The smallest code among the regions a building meets."""
    parts = part_boxes(spark, sf, town=False)
    got = RN.assign_region(parts, A.nations(spark, sf), "n_name", "fid", values=["k"])
    return A.shaped(got, "fid:l n_name:s k:l")


def region_tiles(spark, sf):
    """Tiles that meet a region, all pairs."""
    tiles = A.boxes(A.table(spark, sf, "supplier"), "s_suppkey", "s_suppkey", **A.TILE)
    pairs = RN.shapes_in_regions(tiles, RN.index_regions(A.nations(spark, sf), ["n_name"]), "s_suppkey", ["n_name"]).distinct()
    return A.shaped(pairs, "s_suppkey:l n_name:s")


def tile_neighbours(spark, sf):
    """Tiles whose boxes meet."""
    tiles = A.boxes(A.table(spark, sf, "supplier"), "s_suppkey", "s_suppkey AS tile_id", w="60+j%31", h="60+j%29")
    return A.shaped(S.neighbour_tiles(tiles), "tile_id:l neighbour:l")


def points_in_box(spark, sf):
    """Point statistics inside footprints."""
    pts = A.line_points(spark, sf, "l_quantity AS z", "CASE l_returnflag WHEN 'R' THEN 2 ELSE 6 END AS class", "l_linestatus AS cloud")
    foot = part_boxes(spark, sf, town=False, **{k: v for k, v in A.GREENHOUSE.items()})
    got = PT.roof_heights(pts, foot, "fid", by="cloud")
    for c in ("h_roof_50p", "h_roof_70p", "h_ground"):
        got = got.withColumn(c, F.round(c, 6))
    return A.shaped(
        got, "fid:l cloud:s h_roof_min:d h_roof_max:d n_roof:l h_roof_50p:d h_roof_70p:d h_ground:d pt_density:d"
    )


def point_tiles(spark, sf):
    """Number of points and of point tiles under each footprint's box."""
    pts = A.line_points(spark, sf, "l_suppkey AS tile")
    foot = part_boxes(spark, sf, town=False, **A.GREENHOUSE)
    got = PT.points_and_tiles(pts, foot, "fid", "tile")
    return A.shaped(got, "fid:l n_points:l n_tiles:l")


# a house shape: a rectangle with a pointed side below and a shifted peak above
HOUSE = [("x", "y"), ("x+a", "y-b"), ("x+2*a", "y"), ("x+2*a", "y+c"), ("x+a", "y+c+b+1"), ("x", "y+c"), ("x", "y")]
HOUSE_SQL = (
    "SELECT p_partkey AS fid, CAST(p_partkey % 997 AS DOUBLE) AS x, CAST(p_partkey % 1009 AS DOUBLE) AS y, "
    "CAST(3 + p_size AS DOUBLE) AS a, CAST(1 + p_partkey % 4 AS DOUBLE) AS b, CAST(5 + p_partkey % 13 AS DOUBLE) AS c FROM part"
)


def houses(spark, sf):
    spread(A.table(spark, sf, "part")).createOrReplaceTempView("gevel_part")
    df = spark.sql(HOUSE_SQL.replace("FROM part", "FROM gevel_part"))
    ring = F.array(*[G.point(F.expr(px), F.expr(py)) for px, py in HOUSE])
    return df.select("fid", F.array(ring).alias("rings"))


def _house_terms(term: str, parts: str) -> str:
    out = []
    for (ax, ay), (bx, by) in zip(HOUSE, HOUSE[1:]):
        t = term.replace("AX", f"({ax}-x)").replace("AY", f"({ay}-y)").replace("BX", f"({bx}-x)").replace("BY", f"({by}-y)")
        out.append(t)
    return parts.join(out)


def geom_scalars(spark, sf):
    """Area, perimeter, centroid, box and text forms of polygons."""
    h = settle(houses(spark, sf))
    h = settle(h, "fid", "rings", G.bbox("rings").alias("b"), G.centroid("rings").alias("c"), G.to_wkt("rings").alias("text"))
    h = settle(h, "fid", "rings", "b", "c", G.from_wkt("text").alias("back"), G.bbox_from_wkt("text").alias("b_text"))
    b, c = F.col("b"), F.col("c")
    out = h.select(
        "fid", F.round(G.area("rings"), 6).alias("area"), F.round(G.perimeter("rings"), 6).alias("perimeter"),
        G.n_points("rings").alias("n_points"), F.round(c.x, 6).alias("cx"), F.round(c.y, 6).alias("cy"),
        b.x0.alias("x0"), b.y0.alias("y0"), b.x1.alias("x1"), b.y1.alias("y1"),
        F.round(G.area("back"), 6).alias("area_text"), (F.col("b_text") == b).alias("same_box"),
    )
    return A.shaped(out, "fid:l area:d perimeter:d n_points:l cx:d cy:d x0:d y0:d x1:d y1:d area_text:d same_box:b")


# outlines with faults, by the remainder of p_partkey; a and b are the width and height of the sound outline
FAULTY = {
    0: ["x, y; x+a, y+b; x+a, y; x, y+b; x, y"],  # bow-tie
    1: ["x, y; x+a, y+b; x+a, y; x, y+3*b; x, y"],  # bow-tie of unequal halves
    2: ["x, y; x+a, y; x+a, y+b; x+2*a, y+2*b; x+a, y+b; x, y+b; x, y"],  # spike
    3: ["x, y; x+a, y; x+a, y+b; x, y+b; x, y", "x+a/2, y+b/4; x+3*a/2, y+b/4; x+3*a/2, y+3*b/4; x+a/2, y+3*b/4; x+a/2, y+b/4"],  # hole across the outline
    4: ["x, y; x+a, y; x+a, y+b; x, y+b; x, y", "x+a/4, y+b/4; x+a/2, y+b/2; x+3*a/4, y+b/4; x+3*a/4, y+3*b/4; x+a/2, y+b/2; x+a/4, y+3*b/4; x+a/4, y+b/4"],  # hole that meets itself
    5: ["x, y; x+a, y; x, y; x, y"],  # no area
    6: ["x, y; x+2*a, y+b; x+a, y+2*b; x, y+b; x, y"],  # sound
}


def faulty(spark, sf):
    p = A.table(spark, sf, "part").selectExpr(
        "p_partkey AS fid", "p_partkey % 7 AS kind", "CAST(p_partkey % 997 AS DOUBLE) AS x", "CAST(p_partkey % 1009 AS DOUBLE) AS y",
        "CAST(4 * p_size AS DOUBLE) AS a", "CAST(4 + 4 * (p_partkey % 5) AS DOUBLE) AS b",
    )
    shape = F.lit(None).cast(G.RINGS)
    for kind, rings in FAULTY.items():
        made = F.array(*[F.array(*[G.point(*map(F.expr, pair.split(","))) for pair in ring.split(";")]) for ring in rings])
        shape = F.when(F.col("kind") == kind, made).otherwise(shape)
    return p.withColumn("rings", shape)


def repaired_parts(spark, sf):
    """Valid parts of outlines that cross or touch themselves, numbered from the largest."""
    made = R.repair_parts(faulty(spark, sf)).withColumn("n_parts", F.size("parts"))
    got = made.select("fid", "geometry_type", "n_parts", F.posexplode_outer("parts").alias("part", "one"))
    got = got.select("fid", "geometry_type", "n_parts", "part", F.round(G.area("one"), 6).alias("area"), F.size("one").alias("n_rings"), G.n_points("one").alias("n_points"))
    return A.shaped(got, "fid:l geometry_type:s n_parts:l part:l area:d n_rings:l n_points:l")


REPAIR_SQL = """
WITH p AS (SELECT p_partkey AS fid, p_partkey % 7 AS kind, CAST(4 * p_size AS DOUBLE) AS a, CAST(4 + 4 * (p_partkey % 5) AS DOUBLE) AS b FROM part),
-- kind, type, parts, part, area in parts of a * b, rings, points
want(kind, geometry_type, n_parts, part, share, n_rings, n_points) AS (VALUES
  (0, 'MULTIPOLYGON', 2, 0, 1/4.0, 1, 4), (0, 'MULTIPOLYGON', 2, 1, 1/4.0, 1, 4),
  (1, 'MULTIPOLYGON', 2, 0, 9/8.0, 1, 4), (1, 'MULTIPOLYGON', 2, 1, 1/8.0, 1, 4),
  (2, 'GEOMETRYCOLLECTION', 1, 0, 1.0, 1, 5),
  (3, 'MULTIPOLYGON', 2, 0, 3/4.0, 1, 9), (3, 'MULTIPOLYGON', 2, 1, 1/4.0, 1, 5),
  (4, 'POLYGON', 1, 0, 7/8.0, 3, 13),
  (5, 'MULTILINESTRING', 0, NULL, NULL, NULL, NULL),
  (6, 'POLYGON', 1, 0, 2.0, 1, 5))
SELECT fid, geometry_type, CAST(n_parts AS BIGINT) AS n_parts, CAST(part AS BIGINT) AS part, round(share * a * b, 6) AS area,
  CAST(n_rings AS BIGINT) AS n_rings, CAST(n_points AS BIGINT) AS n_points FROM p JOIN want USING (kind)"""

AREA2 = _house_terms("(AX*BY - BX*AY)", " + ")
GEOM_SQL = f"""
WITH h AS ({HOUSE_SQL}), s AS (
  SELECT *, {AREA2} AS w, {_house_terms('(AX+BX)*(AX*BY - BX*AY)', ' + ')} AS mx,
    {_house_terms('(AY+BY)*(AX*BY - BX*AY)', ' + ')} AS my,
    {_house_terms('sqrt((BX-AX)*(BX-AX) + (BY-AY)*(BY-AY))', ' + ')} AS len FROM h)
SELECT fid, round(w/2, 6) AS area, round(len, 6) AS perimeter, CAST(7 AS BIGINT) AS n_points,
  round(x + mx/(3*w), 6) AS cx, round(y + my/(3*w), 6) AS cy, x AS x0, y-b AS y0, x+2*a AS x1, y+c+b+1 AS y1,
  round(w/2, 6) AS area_text, true AS same_box FROM s"""


def register_rows(spark, sf):
    """Orders as historised building rows; some have two parts or a copy of an id."""
    o = A.boxes(
        A.table(spark, sf, "orders"), "o_orderkey", "o_orderkey AS ogc_fid",
        "concat('NL.IMBAG.Pand.', lpad(CAST(o_orderkey - o_orderkey % 3 AS string), 16, '0')) AS identificatie",
        "CASE o_orderstatus WHEN 'F' THEN 'Pand in gebruik' WHEN 'O' THEN 'Pand gesloopt' "
        "WHEN 'P' THEN CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'Bouw gestart' END END AS status",
        "o_orderdate AS begingeldigheid",
        "CASE WHEN o_custkey % 4 = 0 THEN o_orderdate WHEN o_custkey % 4 = 1 THEN o_orderdate + INTERVAL '400' DAY END AS eindgeldigheid",
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate + INTERVAL '10' DAY END AS tijdstipregistratielv",
        "CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL '900' DAY END AS tijdstipeindregistratielv",
        "CASE WHEN o_orderkey % 13 = 0 THEN o_orderdate + INTERVAL '300' DAY END AS tijdstipinactieflv",
        "CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate + INTERVAL '500' DAY END AS tijdstipnietbaglv",
    )
    second = G.box_rings(F.col("x0"), F.col("y0"), F.col("x0") + 1, F.col("y0") + 1)
    # corners in the order of a bow-tie: the shape falls into two triangles
    tie = F.array(F.array(*[G.point(F.col(x), F.col(y)) for x, y in (("x0", "y0"), ("x1", "y1"), ("x1", "y0"), ("x0", "y1"), ("x0", "y0"))]))
    parts = F.when(F.col("ogc_fid") % 16 == 5, F.array(tie)).when(F.col("ogc_fid") % 9 == 0, F.array(second, "rings")).otherwise(F.array("rings"))
    return o.withColumn("geometry", parts).drop("rings", *G.BOX)


REGISTER_SQL = f"""
SELECT o_orderkey AS ogc_fid, 'NL.IMBAG.Pand.' || lpad(CAST(o_orderkey - o_orderkey % 3 AS VARCHAR), 16, '0') AS identificatie,
  CASE o_orderstatus WHEN 'F' THEN 'Pand in gebruik' WHEN 'O' THEN 'Pand gesloopt'
    WHEN 'P' THEN CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'Bouw gestart' END END AS status,
  o_orderdate AS begingeldigheid,
  CASE WHEN o_custkey % 4 = 0 THEN o_orderdate WHEN o_custkey % 4 = 1 THEN o_orderdate + INTERVAL '400' DAY END AS eindgeldigheid,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate + INTERVAL '10' DAY END AS tijdstipregistratielv,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL '900' DAY END AS tijdstipeindregistratielv,
  CASE WHEN o_orderkey % 13 = 0 THEN o_orderdate + INTERVAL '300' DAY END AS tijdstipinactieflv,
  CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate + INTERVAL '500' DAY END AS tijdstipnietbaglv,
  {A.box_sql('o_orderkey')} FROM orders"""

AS_OF = "1998-06-01"
CURRENT_SQL = f"""
  SELECT * FROM r WHERE (tijdstipinactieflv IS NULL OR tijdstipinactieflv > TIMESTAMP '{AS_OF}')
    AND (tijdstipnietbaglv IS NULL OR tijdstipnietbaglv > TIMESTAMP '{AS_OF}')
    AND tijdstipregistratielv <= TIMESTAMP '{AS_OF}'
    AND (tijdstipeindregistratielv IS NULL OR tijdstipeindregistratielv > TIMESTAMP '{AS_OF}')
    AND begingeldigheid <= TIMESTAMP '{AS_OF}'
    AND (eindgeldigheid = begingeldigheid OR eindgeldigheid > TIMESTAMP '{AS_OF}' OR eindgeldigheid IS NULL)
    AND status NOT IN ('Niet gerealiseerd pand', 'Pand gesloopt', 'Bouwvergunning verleend')"""


def snapshot(spark, sf):
    """rows current at a date."""
    rows = H.snapshot_as_of(register_rows(spark, sf), H.reference_date(AS_OF), H.EXCLUDED_STATUSES["pand"])
    return A.shaped(rows, "ogc_fid:l identificatie:s status:s")


def reconstruction_input(spark, sf):
    """Snapshot, parts, survivors, overlap and label in one plan."""
    now = R.current_buildings(register_rows(spark, sf), H.reference_date(AS_OF))
    top = greenhouses(spark, sf).withColumn(
        "typegebouw", F.transform("typegebouw", lambda v: F.when(v.isin(*WANTED), "kas, warenhuis").otherwise(v))
    )
    out = R.reconstruction_input(now, top)
    out = out.withColumn("area", G.area("rings"))
    return A.shaped(out, "fid:l identificatie:s status:s b3_kas_warenhuis:b b3_bag_bag_overlap:d area:d")


RECON_SQL = f"""
WITH r AS ({REGISTER_SQL}), cur AS ({CURRENT_SQL}),
b AS (SELECT * FROM (
  SELECT ogc_fid AS fid, identificatie, status, x0, y0, x1, y1,
    row_number() OVER (PARTITION BY identificatie ORDER BY (x1-x0)*(y1-y0) DESC, ogc_fid) AS rn FROM cur WHERE ogc_fid % 16 <> 5) WHERE rn = 1),
{OVERLAP_CTE}, {LABEL_CTE}
SELECT b.fid, b.identificatie, b.status, l.kas_warenhuis AS b3_kas_warenhuis, o.b3_bag_bag_overlap,
  (b.x1 - b.x0) * (b.y1 - b.y0) AS area
FROM b LEFT JOIN overlap o ON b.fid = o.fid LEFT JOIN label l ON b.fid = l.fid"""


def unit_rows(spark, sf):
    """Orders as dwellings: each refers to a shared building and to its customer's."""
    return A.table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS string) AS identificatie", "CAST(o_totalprice AS bigint) AS oppervlakte",
        "array(concat('NL.IMBAG.Pand.', lpad(CAST(CAST((o_orderkey - o_orderkey % 2) / 2 AS bigint) AS string), 16, '0')), "
        "concat('C', CAST(o_custkey AS string))) AS pandref",
        "CASE WHEN o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN array('kantoorfunctie') "
        "WHEN o_orderstatus = 'F' THEN array('woonfunctie') WHEN o_orderstatus = 'O' THEN array('overige gebruiksfunctie') "
        "ELSE array('woonfunctie', 'winkelfunctie') END AS gebruiksdoel",
    )


UNITS_CTE = """
u AS (SELECT CAST(o_orderkey AS VARCHAR) AS identificatie, CAST(trunc(o_totalprice) AS BIGINT) AS oppervlakte,
  ['NL.IMBAG.Pand.' || lpad(CAST(o_orderkey // 2 AS VARCHAR), 16, '0'), 'C' || CAST(o_custkey AS VARCHAR)] AS pandref,
  CASE WHEN o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN ['kantoorfunctie']
    WHEN o_orderstatus = 'F' THEN ['woonfunctie'] WHEN o_orderstatus = 'O' THEN ['overige gebruiksfunctie']
    ELSE ['woonfunctie', 'winkelfunctie'] END AS gebruiksdoel FROM orders),
e AS (SELECT unnest(pandref) AS pandid, identificatie, oppervlakte, gebruiksdoel FROM u),
uf AS (SELECT pandid, count(identificatie) AS no_units, CAST(sum(oppervlakte) AS BIGINT) AS net_area,
  flatten(list_sort(list_distinct(list(gebruiksdoel) FILTER (gebruiksdoel IS NOT NULL)))) AS uses FROM e GROUP BY pandid),
ufc AS (SELECT *, CAST(CASE WHEN list_contains(uses, 'woonfunctie') THEN CASE WHEN len(uses) = 1 THEN 0 ELSE 1 END
    WHEN uses = ['overige gebruiksfunctie'] THEN 4 WHEN len(uses) = 1 THEN 2 WHEN len(uses) > 1 THEN 3 ELSE 5 END AS BIGINT) AS building_function
  FROM uf)"""


def units(spark, sf):
    """Units, area, uses and function per building."""
    f = FE.unit_features(unit_rows(spark, sf)).withColumn("building_function", FE.building_function("uses"))
    f = f.withColumn("uses", F.array_join("uses", ","))
    return A.shaped(f, "pandid:s no_units:l net_area:l uses:s building_function:l")


def external(spark, sf):
    """All register features of the buildings in use."""
    b = A.boxes(
        A.table(spark, sf, "part"), "p_partkey",
        "concat('NL.IMBAG.Pand.', lpad(CAST(p_partkey AS string), 16, '0')) AS identificatie",
        "CASE WHEN p_size > 5 THEN 'Pand in gebruik' ELSE 'Pand gesloopt' END AS status", "CAST(NULL AS timestamp) AS eindgeldigheid",
        town=False, **A.GREENHOUSE,
    )
    nat = A.nations(spark, sf)
    stats = nat.select(
        F.col("n_name").alias("WijkenEnBuurten"), F.when(F.col("k") % 6 == 5, "Gemeente").otherwise("Buurt").alias("SoortRegio_2"),
        (F.col("k") * 3).alias("PercentageMeergezinswoning_38"), (F.col("k") * 100).alias("Bevolkingsdichtheid_34"),
        (F.col("k") + 1).alias("GIHandelEnHoreca_94"),
    )
    areas = nat.select(F.col("n_name").alias("bu_code"), *G.BOX, "rings")
    types = A.table(spark, sf, "customer").selectExpr(
        "lpad(CAST(c_custkey AS string), 16, '0') AS identificatie",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'appartement' WHEN 'MACHINERY' THEN 'hoekwoning' ELSE 'anders' END AS woningtypering",
    )
    out = FE.external_features(b, unit_rows(spark, sf), stats, stats, areas, types)
    return A.shaped(
        out,
        "identificatie:s no_vertices:l perimeter:d no_units:l net_area:l building_function:l no_neighbours_100:l "
        "no_adjacent_neighbours:l cbs_percent_multihousehold:l cbs_pop_per_km2:l cbs_dist_to_horeca:l buildingtype:l",
    )


EXTERNAL_SQL = f"""
WITH {UNITS_CTE},
p AS (SELECT 'NL.IMBAG.Pand.' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') AS identificatie, p_partkey,
  {A.box_sql('p_partkey', town=False, **A.GREENHOUSE)} FROM part WHERE p_size > 5),
b AS (SELECT p.*, (x0+x1)/2 AS cx, (y0+y1)/2 AS cy, v.no_units, v.net_area, v.building_function FROM p JOIN ufc v ON p.identificatie = v.pandid),
k AS (SELECT * FROM b WHERE building_function NOT IN (4, 5)),
adj AS (SELECT a.identificatie, count(*) AS n FROM k a JOIN k c ON a.identificatie <> c.identificatie
  AND a.x0 - 0.1 <= c.x1 AND c.x0 <= a.x1 + 0.1 AND a.y0 - 0.1 <= c.y1 AND c.y0 <= a.y1 + 0.1 GROUP BY 1),
nb AS (SELECT a.identificatie, count(*) AS n FROM k a JOIN k c ON a.identificatie <> c.identificatie
  AND (a.cx-c.cx)*(a.cx-c.cx) + (a.cy-c.cy)*(a.cy-c.cy) <= 10000 GROUP BY 1),
r AS ({A.NATION_SQL}),
hood AS (SELECT b.identificatie, arg_min(r.k, r.n_name) AS k FROM b JOIN r
  ON b.x0 <= r.x1 AND r.x0 <= b.x1 AND b.y0 <= r.y1 AND r.y0 <= b.y1 WHERE r.k % 6 <> 5 GROUP BY 1),
t AS (SELECT 'NL.IMBAG.Pand.' || lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS identificatie,
  CASE c_mktsegment WHEN 'BUILDING' THEN 2 WHEN 'MACHINERY' THEN 3 ELSE 5 END AS buildingtype FROM customer)
SELECT b.identificatie, CAST(5 AS BIGINT) AS no_vertices, 2*(x1-x0 + y1-y0) AS perimeter, b.no_units, b.net_area, b.building_function,
  nb.n AS no_neighbours_100, adj.n AS no_adjacent_neighbours, CAST(hood.k*3 AS BIGINT) AS cbs_percent_multihousehold,
  CAST(hood.k*100 AS BIGINT) AS cbs_pop_per_km2, CAST(hood.k+1 AS BIGINT) AS cbs_dist_to_horeca, CAST(t.buildingtype AS BIGINT) AS buildingtype
FROM b LEFT JOIN nb ON b.identificatie = nb.identificatie LEFT JOIN adj ON b.identificatie = adj.identificatie
LEFT JOIN hood ON b.identificatie = hood.identificatie LEFT JOIN t ON b.identificatie = t.identificatie"""

BOX_MEET = "a.x0 <= n.x1 AND n.x0 <= a.x1 AND a.y0 <= n.y1 AND n.y0 <= a.y1"

QUERIES = {
    "overlap_crowd": (overlap_crowd, f"WITH b AS (SELECT p_partkey AS fid, {CROWD_BOX} FROM part), {OVERLAP_CTE} SELECT fid, b3_bag_bag_overlap FROM overlap"),
    "overlap": (overlap, f"WITH b AS ({ORDER_BOXES}), {OVERLAP_CTE} SELECT fid, b3_bag_bag_overlap FROM overlap"),
    "overlap_slanted": (overlap_slanted, f"WITH b AS ({ORDER_BOXES}), {OVERLAP_CTE} SELECT fid, round(b3_bag_bag_overlap, 6) AS b3_bag_bag_overlap FROM overlap"),
    "label_slanted": (label_slanted, f"WITH b AS ({ORDER_BOXES}), {LABEL_CTE} SELECT fid, kas_warenhuis FROM label"),
    "overlap_by_key": (
        overlap_by_brand,
        f"""WITH b AS ({part_sql('p_brand,', **A.GREENHOUSE)}), {OVERLAP_CTE.replace('a.fid <> n.fid', 'a.fid <> n.fid AND a.p_brand = n.p_brand')}
        SELECT o.fid, b.p_brand, o.b3_bag_bag_overlap FROM overlap o JOIN b ON o.fid = b.fid""",
    ),
    "label": (label, f"WITH b AS ({ORDER_BOXES}), {LABEL_CTE} SELECT fid, kas_warenhuis FROM label"),
    "neighbours": (
        neighbours,
        f"""WITH p AS ({CUSTOMER_POINTS}), n AS (SELECT a.c_custkey, count(*) AS c FROM p a JOIN p b ON a.c_custkey <> b.c_custkey
          AND (a.cx-b.cx)*(a.cx-b.cx) + (a.cy-b.cy)*(a.cy-b.cy) <= 10000 GROUP BY 1)
        SELECT p.c_custkey, n.c AS no_neighbours FROM p LEFT JOIN n ON p.c_custkey = n.c_custkey""",
    ),
    "adjacent": (adjacent, ADJACENT_SQL),
    "adjacent_slanted": (adjacent_slanted, ADJACENT_SQL),
    "region_of_point": (
        region_of_point,
        f"""WITH p AS (SELECT c_custkey, {A.box_sql('c_custkey', town=False)} FROM customer), r AS ({A.NATION_SQL})
        SELECT c_custkey, min(n_name) AS n_name FROM p JOIN r ON p.x0 > r.x0 AND p.x0 < r.x1 AND p.y0 > r.y0 AND p.y0 < r.y1 GROUP BY 1""",
    ),
    "region_of_slanted": (
        region_of_slanted,
        f"""WITH p AS (SELECT c_custkey, {A.box_sql('c_custkey', town=False)} FROM customer), r AS ({A.NATION_SQL}), a AS ({part_sql(town=False)}), n AS (SELECT * FROM r)
        SELECT 'point' AS kind, c_custkey AS id, min(n_name) AS n_name FROM p JOIN r ON p.x0 > r.x0 AND p.x0 < r.x1 AND p.y0 > r.y0 AND p.y0 < r.y1 GROUP BY 1, 2
        UNION ALL SELECT 'shape', a.fid, min(n.n_name) FROM a JOIN n ON {BOX_MEET} GROUP BY 1, 2""",
    ),
    "regions_of_many_vertices": (
        regions_of_many_vertices,
        f"""WITH p AS (SELECT c_custkey, {A.box_sql('c_custkey', town=False)} FROM customer), r AS ({A.NATION_SQL}), a AS ({part_sql(town=False, **A.GREENHOUSE)}), n AS (SELECT * FROM r)
        SELECT 'point' AS kind, c_custkey AS id, min(n_name) AS n_name FROM p JOIN r ON p.x0 + 0.5 BETWEEN r.x0 AND r.x1 AND p.y0 + 0.5 BETWEEN r.y0 AND r.y1 GROUP BY 1, 2
        UNION ALL SELECT 'shape', a.fid, min(n.n_name) FROM a JOIN n ON {BOX_MEET} GROUP BY 1, 2""",
    ),
    "region_of_building": (
        region_of_building,
        f"""WITH a AS ({part_sql(town=False)}), n AS ({A.NATION_SQL})
        SELECT a.fid, min(n.n_name) AS n_name, CAST(arg_min(n.k, n.n_name) AS BIGINT) AS k FROM a JOIN n ON {BOX_MEET} GROUP BY 1""",
    ),
    "region_tiles": (
        region_tiles,
        f"""WITH a AS (SELECT s_suppkey, {A.box_sql('s_suppkey', **A.TILE)} FROM supplier), n AS ({A.NATION_SQL})
        SELECT s_suppkey, n_name FROM a JOIN n ON {BOX_MEET}""",
    ),
    "tile_neighbours": (
        tile_neighbours,
        f"""WITH t AS (SELECT s_suppkey AS tile_id, {A.box_sql('s_suppkey', '60+j%31', '60+j%29')} FROM supplier)
        SELECT a.tile_id, n.tile_id AS neighbour FROM t a JOIN t n ON a.tile_id <> n.tile_id AND {BOX_MEET}""",
    ),
    "points_in_box": (
        points_in_box,
        f"""WITH p AS (SELECT l_quantity AS z, CASE l_returnflag WHEN 'R' THEN 2 ELSE 6 END AS class, l_linestatus AS cloud, {A.LINE_POINT} FROM lineitem),
        f AS ({part_sql(town=False, **A.GREENHOUSE)}),
        i AS (SELECT f.fid, (x1-x0)*(y1-y0) AS a, p.* FROM p JOIN f ON p.x BETWEEN f.x0 AND f.x1 AND p.y BETWEEN f.y0 AND f.y1),
        g AS (SELECT fid, cloud, quantile_cont(z, 0.5) AS h_ground FROM i WHERE class = 2 GROUP BY 1, 2),
        s AS (SELECT fid, cloud, min(z) AS h_roof_min, max(z) AS h_roof_max, count(*) AS n_roof, quantile_cont(z, 0.5) AS q5,
          quantile_cont(z, 0.7) AS q7, max(a) AS a FROM i WHERE class = 6 GROUP BY 1, 2)
        SELECT s.fid, s.cloud, h_roof_min, h_roof_max, n_roof, round(q5, 6) AS h_roof_50p, round(q7, 6) AS h_roof_70p,
          round(h_ground, 6) AS h_ground, n_roof / a AS pt_density FROM s LEFT JOIN g ON s.fid = g.fid AND s.cloud = g.cloud""",
    ),
    "point_tiles": (
        point_tiles,
        f"""WITH p AS (SELECT l_suppkey AS tile, {A.LINE_POINT} FROM lineitem), f AS ({part_sql(town=False, **A.GREENHOUSE)})
        SELECT f.fid, count(*) AS n_points, count(DISTINCT tile) AS n_tiles FROM p JOIN f
          ON p.x BETWEEN f.x0 AND f.x1 AND p.y BETWEEN f.y0 AND f.y1 GROUP BY 1""",
    ),
    "geom_scalars": (geom_scalars, GEOM_SQL),
    "repaired_parts": (repaired_parts, REPAIR_SQL),
    "snapshot": (snapshot, f"WITH r AS ({REGISTER_SQL}) SELECT ogc_fid, identificatie, status FROM ({CURRENT_SQL})"),
    "reconstruction_input": (reconstruction_input, RECON_SQL),
    "units": (
        units,
        f"WITH {UNITS_CTE} SELECT pandid, no_units, net_area, array_to_string(uses, ',') AS uses, building_function FROM ufc",
    ),
    "external_features": (external, EXTERNAL_SQL),
}
