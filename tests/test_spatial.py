import random

import pytest
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.operators import regions as RN
from gevel.operators import spatial as S
from tests.shapes import HOLED, box, frame, rings


def pairs_of(df, a, b):
    return sorted((r[a], r[b]) for r in df.collect())


def test_candidates_equal_brute_force_for_mixed_sizes(spark):
    rng = random.Random(5)

    def some(n):
        out = []
        for i in range(n):
            side = rng.choice([0, 1, 3, 20, 90, 700])
            x, y = rng.uniform(-500, 500), rng.uniform(-500, 500)
            x, y = (round(x), round(y)) if rng.random() < 0.5 else (x, y)
            out.append((i, float(x), float(y), float(x + side), float(y + side * rng.random())))
        return out

    l, r = some(150), some(120)
    ldf = spark.createDataFrame(l, "a long, x0 double, y0 double, x1 double, y1 double")
    rdf = spark.createDataFrame(r, "b long, rx0 double, ry0 double, rx1 double, ry1 double")
    want = sorted(
        (i, j) for i, a, b, c, d in l for j, e, f, g, h in r if a <= g and e <= c and b <= h and f <= d
    )
    assert pairs_of(S.candidates(ldf, rdf), "a", "b") == want
    assert pairs_of(S.candidates(ldf, rdf, salt=3), "a", "b") == want


def test_overlap_by_hand(spark):
    shapes = [
        box(0, 0, 4, 4), box(2, 2, 6, 6),  # offset squares: 4 each
        box(100, 0, 104, 4), box(98, 0, 102, 4), box(101, 0, 102, 4),  # union, not sum
        HOLED, box(0, 50, 1, 51),
        box(200, 0, 204, 4), box(204, 0, 208, 4),  # edge
        box(300, 0, 301, 1), box(300.5, 0, 301.5, 1),  # below the limit
    ]
    shapes[5] = [[{"x": p["x"] + 400, "y": p["y"]} for p in ring] for ring in HOLED]
    shapes.append(box(400, 0, 404, 2))
    got = {r.fid: r.b3_bag_bag_overlap for r in S.overlap_area(frame(spark, shapes)).collect()}
    assert got[0] == got[1] == 4.0
    assert got[2] == 8.0
    assert got[7] == got[8] == 0.0 and got[9] == got[10] == 0.0
    assert got[5] == pytest.approx(6.0)
    assert 6 not in got


def test_overlap_of_copies_is_the_whole_shape(spark):
    pile = [box(0, 0, 3, 3)] * 400 + [rings([(0, 0), (2, 0), (1, 2)])] + [box(50, 50, 60, 60)]
    got = {r.fid: r.b3_bag_bag_overlap for r in S.overlap_area(frame(spark, pile)).collect()}
    assert len(got) == 401 and all(got[i] == 9.0 for i in range(400)) and got[400] == pytest.approx(2.0)


def test_overlap_is_the_same_in_pieces(spark):
    rng = random.Random(2)
    shapes = [box(0, 0, 200, 150)]
    for _ in range(60):
        x, y = rng.uniform(-10, 200), rng.uniform(-10, 150)
        shapes.append(rings([(x, y), (x + rng.uniform(2, 40), y + 1), (x + 3, y + rng.uniform(2, 30))]))
    df = frame(spark, shapes)
    small = {r.fid: r.b3_bag_bag_overlap for r in S.overlap_area(df, tile=16.0).collect()}
    large = {r.fid: r.b3_bag_bag_overlap for r in S.overlap_area(df, tile=1e6).collect()}
    split = {r.fid: r.b3_bag_bag_overlap for r in S.overlap_area(df, crowd=3).collect()}
    assert small.keys() == large.keys() == split.keys()
    assert all(small[k] == pytest.approx(large[k]) == pytest.approx(split[k]) for k in small)


def test_crowded_cells_are_split_until_few_outlines_meet(spark):
    rng = random.Random(5)
    shapes = [box(0, 0, 100, 100)]
    for _ in range(3000):
        x, y = rng.uniform(0, 100), rng.uniform(0, 60)
        shapes.append(rings([(x, y), (x + rng.uniform(1, 5), y + 1), (x + 1, y + rng.uniform(1, 5))]))
    df = S.distinct_shapes(frame(spark, shapes), "fid")
    cells = S.crowded_cells(df, 64.0, crowd=40)
    tiles = cells.groupBy("_tx", "_ty").agg(F.sum(F.col("_fs") * F.col("_fs")).alias("area"), F.min("_fs").alias("least")).collect()
    assert {(r["_tx"], r["_ty"]) for r in tiles} >= {(0, 0), (1, 0)} and all(r["area"] == 64.0 * 64.0 for r in tiles)
    fx, fy, fs = F.col("_fx"), F.col("_fy"), F.col("_fs")
    met = cells.join(F.broadcast(df), G.outline_meets("rings", fx, fy, fx + fs, fy + fs)).groupBy("_fx", "_fy", "_fs").count()
    assert met.filter("_fs > 1").agg(F.max("count")).first()[0] <= 40
    assert S.crowded_cells(df, 64.0, crowd=5000) is None


def test_label_threshold_is_strict_and_parts_add_up(spark):
    b = frame(spark, [box(0, 0, 10, 10), box(100, 0, 110, 10), box(200, 0, 210, 10), box(300, 0, 310, 10)])
    shapes = [box(0, 0, 1.1, 10), box(100, 0, 101.2, 10), box(200, 0, 200.6, 10), box(209.4, 0, 210, 10), box(300, 0, 310, 10)]
    kinds = [["kas, warenhuis"]] * 4 + [["overig"]]
    p = frame(spark, shapes)
    k = spark.createDataFrame(list(enumerate(kinds)), "fid long, typegebouw array<string>")
    got = {r.fid: r.kas_warenhuis for r in S.label_by_overlap(b, p.join(k, "fid")).collect()}
    assert got == {0: False, 1: True, 2: True, 3: False}


def test_adjacent_counts_and_copies(spark):
    shapes = [box(0, 0, 5, 5), box(5.05, 0, 10, 5), box(10.2, 0, 12, 5), box(5.05, 0, 10, 5), box(50, 50, 51, 51)]
    got = {r.fid: r.no_adjacent for r in S.adjacent_count(frame(spark, shapes), "fid").collect()}
    assert got == {0: 2, 1: 2, 3: 2}


def test_neighbours_equal_brute_force_with_a_pile(spark):
    rng = random.Random(9)
    pts = [(rng.uniform(0, 900), rng.uniform(0, 900)) for _ in range(250)]
    pts += [(400.0, 400.0)] * 120 + [(500.0, 400.0)] * 3 + [(1000.0 * i, 5000.0) for i in range(5)]
    pts += [(400 + rng.uniform(0, 30), 400 + rng.uniform(0, 30)) for _ in range(200)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id long, cx double, cy double")
    want = {}
    for i, (a, b) in enumerate(pts):
        n = sum((a - c) ** 2 + (b - d) ** 2 <= 100.0**2 for c, d in pts) - 1
        if n:
            want[i] = n
    for fine in (1, 4, 16):
        got = {r.id: r.no_neighbours for r in S.neighbours_within(df, 100.0, "id", fine=fine).collect()}
        assert got == want


def test_region_on_a_border_takes_the_smaller_code(spark):
    regions = frame(spark, [box(0, 0, 10, 10), box(10, 0, 20, 10)]).withColumn("code", F.concat(F.lit("B"), 9 - F.col("fid"))).drop("fid")
    b = frame(spark, [box(9, 1, 11, 2), box(1, 1, 2, 2), box(30, 30, 31, 31)])
    got = {r.fid: r.code for r in RN.assign_region(b, regions, "code", "fid").collect()}
    assert got == {0: "B8", 1: "B9"}
    pts = b.select("fid", F.lit(10.0).alias("px"), F.lit(5.0).alias("py"))
    assert RN.assign_region(pts, regions, "code", "fid", "contains").count() == 0


def test_point_in_polygon_and_text(spark):
    df = frame(spark, [HOLED])
    got = df.select(
        *[G.point_in("rings", F.lit(x), F.lit(y)).alias(n) for n, x, y in (("ring", 0.5, 0.5), ("hole", 2.0, 2.0), ("edge", 1.0, 2.0))],
        G.point_in("rings", F.lit(1.0), F.lit(2.0), boundary=True).alias("on"),
        G.area("rings").alias("area"), G.perimeter("rings").alias("len"), G.area(G.from_wkt(G.to_wkt("rings"))).alias("back"),
        G.from_wkt(F.lit("LINESTRING (0 0, 1 1)")).alias("line"),
    ).first()
    assert (got.ring, got.hole, got.edge, got.on) == (True, False, False, True)
    assert (got.area, got.len, got.back, got.line) == (12.0, 24.0, 12.0, None)


def test_normalise_closes_and_orients(spark):
    open_cw = [[(0.0, 0.0), (0.0, 2.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0)]]
    df = spark.createDataFrame([(1, open_cw)], "fid long, rings array<array<struct<x:double,y:double>>>")
    r = df.select(G.normalise("rings").alias("r"), G.area(G.normalise("rings")).alias("a"), G.signed_area(G.normalise("rings")[0]).alias("s")).first()
    assert len(r.r[0]) == 5 and r.a == 4.0 and r.s == 4.0


def test_geojson_other_kind_is_an_error(spark):
    doc = '{"type":"Point","coordinates":[[[1,2]]]}'
    with pytest.raises(Exception, match="Must be a Polygon"):
        spark.createDataFrame([(doc,)], "g string").select(G.from_geojson("g")).collect()


def test_morton_keeps_neighbours_together(spark):
    df = spark.range(64).select((F.col("id") % 8).cast("double").alias("x"), F.floor(F.col("id") / 8).cast("double").alias("y"))
    rows = df.withColumn("m", G.morton("x", "y")).orderBy("m").collect()
    assert len({r.m for r in rows}) == 64
    assert {(r.x, r.y) for r in rows[:4]} == {(0, 0), (1, 0), (0, 1), (1, 1)}


@pytest.mark.parametrize("mixed", [False, True])
def test_points_in_boxes_of_any_size(spark, mixed):
    rng = random.Random(9)
    sides = [0, 0.5, 3, 40, 900, 5000] if mixed else [10, 14, 30]
    boxes = []
    for _ in range(150):
        x, y = rng.uniform(-500, 500), rng.choice([0.0, rng.uniform(-500, 500)])
        boxes.append((x, y, x + rng.choice(sides), y + rng.choice(sides)))
    pts = [(b[0], b[1]) for b in boxes[:80]] + [(b[2], b[3]) for b in boxes[:80]] + [(rng.uniform(-600, 600), rng.uniform(-600, 600)) for _ in range(400)]
    p = spark.createDataFrame([(i, *v) for i, v in enumerate(pts)] + [(-1, None, 1.0)], "pid long, x double, y double")
    f = spark.createDataFrame([(i, *b) for i, b in enumerate(boxes)] + [(-1, None, None, None, None)], "fid long, x0 double, y0 double, x1 double, y1 double")
    want = sorted((i, j) for i, (x, y) in enumerate(pts) for j, b in enumerate(boxes) if b[0] <= x <= b[2] and b[1] <= y <= b[3])
    for salt in (1, 3):
        got = S.points_in(p, f, "fid", salt=salt)
        assert pairs_of(got, "pid", "fid") == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert (len(S.size_classes(f)) > 1) == mixed
    # a point is one row of the exchange unless sizes are mixed
    assert ("explode([" in plan or "explode(array(" in plan) == mixed
    assert S.points_in(p, f.limit(0), "fid").count() == 0
