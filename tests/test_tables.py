import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gevel.functions import text as TX
from gevel.functions.quantiles import group_quantiles
from gevel.operators import features as FE
from gevel.operators import history as H
from gevel.operators import lineage as L
from gevel.operators import points as PT
from gevel.operators import quality as Q
from gevel.operators import tiling as TI
from gevel.operators import webservice as W
from tests.shapes import box, frame

DAY = dt.datetime(2022, 10, 8)


def register(spark, cases):
    base = dict(
        identificatie="a", status="Pand in gebruik", begingeldigheid=DAY - dt.timedelta(100), eindgeldigheid=None,
        tijdstipregistratielv=DAY - dt.timedelta(90), tijdstipeindregistratielv=None, tijdstipinactieflv=None, tijdstipnietbaglv=None,
    )
    schema = "name string, identificatie string, status string, begingeldigheid timestamp, eindgeldigheid timestamp, " + ", ".join(
        f"{c} timestamp" for c in ("tijdstipregistratielv", "tijdstipeindregistratielv", "tijdstipinactieflv", "tijdstipnietbaglv")
    )
    rows = [{"name": n, **base, **c} for n, c in cases.items()]
    return spark.createDataFrame([[r[f.split()[0]] for f in schema.split(", ")] for r in rows], schema)


def test_snapshot_cases(spark):
    cases = {
        "current": {},
        "ends_when_it_begins": {"eindgeldigheid": DAY - dt.timedelta(100)},
        "ended": {"eindgeldigheid": DAY - dt.timedelta(1)},
        "starts_tomorrow": {"begingeldigheid": DAY + dt.timedelta(1)},
        "inactive_tomorrow": {"tijdstipinactieflv": DAY + dt.timedelta(1)},
        "inactive_yesterday": {"tijdstipinactieflv": DAY - dt.timedelta(1)},
        "outside": {"tijdstipnietbaglv": DAY},
        "unregistered": {"tijdstipregistratielv": None},
        "registration_ended": {"tijdstipeindregistratielv": DAY},
        "no_status": {"status": None},
        "demolished": {"status": "Pand gesloopt"},
    }
    rows = H.snapshot_as_of(register(spark, cases), H.reference_date("2022-10-08"), H.EXCLUDED_STATUSES["pand"])
    assert {r.name for r in rows.collect()} == {"current", "ends_when_it_begins", "inactive_tomorrow"}


def test_withdrawn_units_pass_by_default(spark):
    df = register(spark, {"w": {"status": "Verblijfsobject ingetrokken"}})
    t = H.reference_date("2022-10-08")
    assert H.snapshot_as_of(df, t, H.EXCLUDED_STATUSES["verblijfsobject"]).count() == 1
    assert H.snapshot_as_of(df, t, H.UNIT_STATUSES_CORRECTED).count() == 0


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    one = H.dedupe(df, "k", [F.col("id").desc()])
    assert {(r.k, r.id) for r in one.collect()} == {(0, 999), (1, 997), (2, 998)}
    assert "WindowGroupLimit" in one._jdf.queryExecution().optimizedPlan().toString()


def test_quantiles_with_one_large_group(spark):
    rng = random.Random(1)
    rows = [("big", round(rng.gauss(10, 4), 2)) for _ in range(3000)] + [("small", v) for v in (1.0, 2.0, 4.0)] + [("one", 7.5), ("one", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in group_quantiles(df, ["k"], "v", {"a": 0.5, "b": 0.7, "c": 0.0, "d": 1.0}).collect()}
    for k in ("big", "small", "one"):
        vs = [v for g, v in rows if g == k and v is not None]
        want = np.quantile(vs, [0.5, 0.7, 0.0, 1.0])
        assert [got[k].a, got[k].b, got[k].c, got[k].d] == pytest.approx(list(want))


def recursive_leaves(points, cell, cap, depth):
    out = {}

    def go(level, nx, ny, pts):
        if not pts:
            return
        if len(pts) <= cap or level == 0:
            out[f"{depth - level}/{nx}/{ny}"] = len(pts)
            return
        half = 2 ** (level - 1) * cell
        for dx in (0, 1):
            for dy in (0, 1):
                x, y = 2 * nx + dx, 2 * ny + dy
                go(level - 1, x, y, [p for p in pts if p[0] // half == x and p[1] // half == y])

    side = 2**depth * cell
    for nx in {p[0] // side for p in points}:
        for ny in {p[1] // side for p in points}:
            go(depth, int(nx), int(ny), [p for p in points if p[0] // side == nx and p[1] // side == ny])
    return out


def test_quadtree_equals_the_recursive_split(spark):
    rng = random.Random(4)
    pts = [(rng.random() ** 3 * 300, rng.random() ** 2 * 300) for _ in range(800)] + [(10.0, 10.0)] * 300
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "fid long, cx double, cy double")
    tiles, index = TI.quadtree_tiles(df, 10, 40, depth=4)
    got = {r.tile_id: r.nr_items for r in tiles.collect()}
    assert got == recursive_leaves(pts, 10, 40, 4)
    assert {r.tile_id: r["count"] for r in index.groupBy("tile_id").count().collect()} == got
    assert Q.assert_unique(index, "fid").isEmpty()


def test_regular_grid_of_the_country(spark):
    g = TI.Grid.over((13000, 306250, 279000, 616250), 200)
    assert (g.nx, g.ny) == (1330, 1550)
    small = TI.regular_grid(spark, (0, 0, 401, 399), 200).orderBy("cell_id").collect()
    assert len(small) == 6 and (small[3].x0, small[3].y0) == (0.0, 200.0)


def test_cells_of_tiles_edges(spark):
    tiles = frame(spark, [box(0, 0, 10, 10), box(10, 0, 30, 10), box(12, 2, 14, 4)]).withColumnRenamed("fid", "tile_id")
    g = TI.Grid(0, 0, 10, 3, 1)
    got = {r.cell_id: list(r.tile_ids) for r in TI.cells_of_tiles(tiles, g).collect()}
    assert got == {1: [0], 2: [1], 3: [1]}


def test_tiles_in_polygon(spark):
    t = frame(spark, [box(0, 0, 10, 10), box(20, 0, 30, 10)]).withColumnRenamed("fid", "tile_id")
    assert [r.tile_id for r in TI.tiles_in(t, "POLYGON ((10 10, 15 10, 15 15, 10 10))").collect()] == [0]
    assert TI.tiles_in(t).count() == 2


def test_building_function_codes(spark):
    uses = [["woonfunctie"], ["woonfunctie", "winkelfunctie"], ["kantoorfunctie"], ["a", "b"], ["overige gebruiksfunctie"], None, ["woonfunctie", "woonfunctie"], []]
    df = spark.createDataFrame(list(enumerate(uses)), "i int, uses array<string>")
    got = [r.f for r in df.select("i", FE.building_function("uses").alias("f")).orderBy("i").collect()]
    assert got == [0, 1, 2, 3, 4, 5, 1, 5]


def test_unit_features_repeat_uses_of_distinct_lists(spark):
    rows = [("v1", ["p1", "p2"], 10, ["woonfunctie"]), ("v2", ["p1"], None, ["woonfunctie"]), ("v3", ["p1"], 5, ["a", "woonfunctie"])]
    u = spark.createDataFrame(rows, "identificatie string, pandref array<string>, oppervlakte int, gebruiksdoel array<string>")
    got = {r.pandid: (r.no_units, r.net_area, r.uses) for r in FE.unit_features(u).collect()}
    assert got == {"p1": (3, 15, ["a", "woonfunctie", "woonfunctie"]), "p2": (1, 10, ["woonfunctie"])}


def test_update_from_keeps_rows(spark):
    t = spark.createDataFrame([(1, 7), (2, None), (3, 9)], "k int, v int")
    u = spark.createDataFrame([(1, 5), (1, 4), (2, 1), (8, 8)], "k int, v int")
    assert sorted((r.k, r.v) for r in FE.update_from(t, u, "k", ["v"]).collect()) == [(1, 4), (2, 1), (3, 9)]


def test_training_filter_limits(spark):
    df = spark.createDataFrame(
        [(1005, 9.0, 1.0), (1006, 9.0, 1.0), (2025, 9.0, 1.0), (2000, 300.0, 1.0), (2000, None, 1.0), (2000, 9.0, None)],
        "construction_year int, h_roof_max double, h_roof_70p double",
    )
    assert [r.construction_year for r in FE.training_filter(df).collect()] == [1006]


def test_typed_casts_and_bracket_lists(spark):
    schema = T.StructType(
        [T.StructField("a", T.BooleanType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.ArrayType(T.IntegerType())), T.StructField("d", T.ArrayType(T.StringType()))]
    )
    rows = [("True", "7", "[102, 203]", "['1.2', '2.2']"), ("", "", "[]", "[]"), (None, None, "", None)]
    got = [tuple(r) for r in TX.typed_or_null(spark.createDataFrame(rows, "a string, b string, c string, d string"), schema).collect()]
    assert got == [(True, 7, [102, 203], ["'1.2'", " '2.2'"]), (None, None, [], []), (None, None, None, None)]


def test_download_link_rejects_other_formats(spark):
    df = spark.createDataFrame([("pdf",)], "f string")
    with pytest.raises(Exception, match="only cityjson, obj, gpkg"):
        df.select(TX.download_link("f", F.lit("1-2-3"), F.lit("v1.2"), "r")).collect()


def test_layer_attributes_are_complete():
    assert len(W.LAYER_ATTRIBUTES) == len(set(W.LAYER_ATTRIBUTES)) == 55
    assert len(Q.VALIDATION_SCHEMA.fields) == 37


def test_summaries_of_reports(spark):
    ok, bad = (True, []), (False, [(102,), (102,), (203,)])
    rows = [("t", "b1", False, [("p", *ok), ("p", *bad), ("p", *ok), ("p", *ok)]), ("t", "b2", True, [("p", *ok)] * 4), ("t", "b3", True, [("p", *ok)] * 4)]
    f = spark.createDataFrame(rows, "tile_id string, id string, validity boolean, primitives array<struct<id:string,validity:boolean,errors:array<struct<code:int>>>>")
    a = spark.createDataFrame([("t", "b1", "[203, 102]", "[]", "[1]"), ("t", "b2", "[5]", "[]", "[]")], "tile_id string, id string, lod12 string, lod13 string, lod22 string")
    r = Q.summarise_reports(f, a).first()
    assert (r.nr_invalid_building, r.nr_invalid_buildingpart_lod12, r.errors_lod12) == (1, 1, [102, 203])
    assert (r.nr_mismatch_errors_lod12, r.nr_mismatch_errors_lod13, r.nr_mismatch_errors_lod22) == (1, 0, 1)


def test_profile_head_and_checks(spark):
    df = spark.createDataFrame([(1, "x" * 40), (2, None), (2, "y")], "k int, s string")
    got = {r.column_name: (r.column_type, r.missing_values, r.row_count) for r in Q.profile(df).collect()}
    assert got == {"k": ("int", 0, 3), "s": ("string", 1, 3)}
    assert len(Q.head(df, 1).first().s) == 23
    with pytest.raises(ValueError, match="key"):
        Q.require_empty(Q.assert_unique(df, "k"), "key")
    Q.require_empty(Q.assert_references(df, df, "k"), "references")


SAMPLE = (
    "[debug] [reconstructor t] /d/6/1/2/objects/P1/reconstruct/P1.city.jsonl ((ArrangementOptimiser, 0),(ArrangementBuilder, 1),(SegmentRasteriser, 6),"
    "(LineRegulariser, 0),(PlaneIntersector, 0),(extrude, 2),(LineDetector, 0),(AlphaShaper_ground, 1),(PlaneDetector_ground, 2),(AlphaShaper, 0),(PlaneDetector, 1),)"
)


def test_log_lines(spark):
    lines = [
        SAMPLE, SAMPLE.replace("P1", "P4").replace("(extrude, 2)", "(extrude, 2),(extrude, 9)"), SAMPLE.replace("P1", "P5").replace("extrude", "other"), SAMPLE.replace("P1", "P2").replace("extrude, 2", "extrude, x"), SAMPLE.replace("P1", "P3").replace("extrude, 2", "extrude"), "noise",
        "[reconstructor] start: /d/o/A.city.jsonl", "[reconstructor] finish: /d/o/A.city.jsonl", "[reconstructor] start: /d/o/B.city.jsonl",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = L.log_timings(df).collect()
    assert sorted((r.building_id, r.SegmentRasteriser, r.PlaneDetector, r.extrude) for r in got) == [("P1", 6, 1, 2), ("P4", 6, 1, 9)]
    assert [r.building_id for r in L.unfinished(df).collect()] == ["B"]


def test_log_lines_are_made_once_and_searched_only_if_unusual(spark):
    """The expression that makes a line stands once in the plan; lines in other spacing, order or length give what the usual ones give."""
    made = spark.range(1).select(F.concat(F.lit("marker "), F.col("id").cast("string")).alias("value"))
    plan = L.log_timings(made)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("marker") == 1
    other = [SAMPLE.replace("(extrude, 2)", "( extrude,2 )"), SAMPLE.replace(",)", ""), SAMPLE.replace("extrude, 2", "extrude, 7),(extrude, 2"), SAMPLE.replace(", 2),(LineDetector, 0)", ", 02),(LineDetector, +0)"), SAMPLE.replace("(AlphaShaper, 0),(PlaneDetector, 1)", "(PlaneDetector, 1),(AlphaShaper, 0)")]
    got = L.log_timings(spark.createDataFrame([(x,) for x in [SAMPLE, *other, None]], "value string")).collect()
    assert len(got) == 6 and len(set(got)) == 1
    part = L.log_timings(spark.createDataFrame([(SAMPLE.replace("(extrude, 2),", ""),)], "value string")).first()
    assert part.extrude is None and part.PlaneDetector == 1


def test_best_cloud(spark):
    s = spark.createDataFrame([("a", "AHN3", 0.9, 2), ("a", "AHN5", 0.9, 0), ("b", "AHN3", 0.9, 2), ("b", "AHN4", 0.5, 1), ("c", "AHN4", None, 1)], "identificatie string, cloud string, coverage double, quality int")
    got = {r.identificatie: (r.cloud, r.reason) for r in PT.best_cloud(s).collect()}
    assert got == {"a": ("AHN5", "quality"), "b": ("AHN3", "coverage"), "c": ("AHN4", "only")}


def test_floors_of_the_feature_matrix(spark, sf):
    from gevel.catalog import all_queries

    features = {r["identificatie"] for r in all_queries()["features"](spark, sf).collect()}
    got = all_queries()["floors_of_features"](spark, sf).collect()
    assert features and sorted(r["identificatie"] for r in got) == sorted(features)
    assert all(r["b3_bouwlagen"] is not None for r in got) and len({r["b3_bouwlagen"] for r in got}) > 1
