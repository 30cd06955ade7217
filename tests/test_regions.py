"""The index of clipped edges against whole polygons."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions import kernels as K
from gevel.operators import regions as RN
from tests.shapes import HOLED, box, frame, rings


def star(rng, cx, cy, size, n):
    """A ring around (cx, cy) on whole numbers, not crossing itself much; the even-odd rule holds for any."""
    pts = [(round(cx + size * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n)), round(cy + size * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n))) for k in range(n)]
    return rings([*pts, pts[0]])


def regions(rng):
    out = [star(rng, rng.randint(-40, 40), rng.randint(-40, 40), rng.choice([3, 10, 40]), rng.choice([3, 4, 7, 40, 300])) for _ in range(12)]
    return out + [HOLED, box(0, 0, 16, 16), box(-7, -7, -3, 60), box(5, 5, 5, 9)]


@pytest.mark.parametrize("seed", range(2))
def test_points_on_whole_numbers_and_between(spark, seed):
    rng = random.Random(seed)
    r = frame(spark, regions(rng)).withColumnRenamed("fid", "code")
    pts = [(float(x), float(y)) for x in range(-50, 51, 3) for y in range(-50, 51, 3)] + [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(600)]
    p = spark.createDataFrame([(i, *v) for i, v in enumerate(pts)] + [(-1, None, 1.0)], "id long, px double, py double")
    index = RN.index_regions(r, ["code"])
    got = {(v["id"], v["code"]) for v in RN.points_in_regions(p, index, ["code"]).collect()}
    want = {(v["id"], v["code"]) for v in p.crossJoin(F.broadcast(r)).where(G.point_in("rings", "px", "py")).select("id", "code").collect()}
    assert got == want and len(want) > 500


@pytest.mark.parametrize("seed", range(2))
def test_shapes_that_meet_hold_or_lie_in_regions(spark, seed):
    rng = random.Random(seed)
    r = frame(spark, regions(rng)).withColumnRenamed("fid", "code")
    shapes = [star(rng, rng.randint(-50, 50), rng.randint(-50, 50), rng.choice([2, 6, 25]), rng.choice([3, 5])) for _ in range(120)]
    shapes += [box(x, y, x + rng.choice([0, 1, 9]), y + rng.choice([1, 30])) for x, y in ((rng.randint(-50, 50), rng.randint(-50, 50)) for _ in range(120))]
    s = frame(spark, [*shapes, box(-90, -90, 90, 90), rings([(-90, -80), (80, -90), (90, 90), (-85, 80), (-90, -80)])]).withColumnRenamed("fid", "id")
    got = {(v["id"], v["code"]) for v in RN.shapes_in_regions(s, RN.index_regions(r, ["code"]), "id", ["code"]).collect()}
    both = s.select("id", "rings").crossJoin(F.broadcast(r.select("code", F.col("rings").alias("other"))))
    want = {(v["id"], v["code"]) for v in both.where(K.polygons_intersect("rings", "other")).select("id", "code").collect()}
    # the box of no width is a line, which the even-odd test of whole polygons cannot hold
    assert got == want and len(want) > 200


def test_a_region_of_many_vertices_is_read_in_small_pieces(spark):
    n = 10_000
    ring = [(1000 * math.cos(2 * math.pi * k / n), 1000 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    r = frame(spark, [rings([*ring, ring[0]])]).withColumnRenamed("fid", "code")
    index = RN.index_regions(r, ["code"])
    most, rows = index.agg(F.max(F.size("edges")), F.count("*")).first()
    assert most < 200 and rows < 4 * n
    p = spark.createDataFrame([(i, 1100 * math.cos(i), (i % 1100) * math.sin(i)) for i in range(3000)], "id long, px double, py double")
    met = RN.points_in_regions(p, index, ["code"])
    inside = {v["id"] for v in met.collect()}
    assert inside == {v["id"] for v in p.collect() if v["px"] ** 2 + v["py"] ** 2 < 999_999.8}
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "rings" not in plan.split("Join", 1)[0]


def test_no_regions_and_no_rows(spark):
    r = frame(spark, [HOLED]).withColumn("code", F.lit("x"))
    assert RN.assign_region(frame(spark, [HOLED]), r.limit(0), "code", "fid").collect() == []
    assert RN.assign_region(frame(spark, [HOLED]).limit(0), r, "code", "fid").collect() == []
    with pytest.raises(ValueError):
        RN.assign_region(r, r, "code", "fid", "near")
