"""Repair of polygons: hand cases, and random rings against the even-odd rule at points."""

import random

import numpy as np
import pyarrow as pa
import pytest

from gevel.functions import kernels as K
from gevel.functions import repair as R
from gevel.plans import reconstruction

TYPE = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
SQUARE = [(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)]


def column(polygons):
    return pa.array([None if p is None else [[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in polygons], TYPE)


def repair(*polygons):
    parts, lines = R.repair_batch(column(polygons))
    return [([[[(v["x"], v["y"]) for v in ring] for ring in part] for part in p], bool(flag)) for p, flag in zip(parts.to_pylist(), lines, strict=True)]


def test_hand_cases_in_one_batch():
    tie = [[(0, 0), (4, 2), (4, 0), (0, 2), (0, 0)]]
    knot = [[(0, 0), (2, 1), (4, 0), (4, 2), (2, 1), (0, 2), (0, 0)]]
    halves = [[[(0, 0), (2, 1), (0, 2), (0, 0)]], [[(2, 1), (4, 0), (4, 2), (2, 1)]]]
    spike = [[(0, 0), (9, 0), (9, 9), (12, 12), (9, 9), (0, 9), (0, 0)]]
    slit = [[(0, 0), (4, 0), (4, 4), (2, 4), (2, 0), (2, 4), (0, 4), (0, 0)]]
    island = [SQUARE, [(1, 1), (1, 8), (8, 8), (8, 1), (1, 1)], [(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]]
    corner = [SQUARE, [(0, 0), (1, 2), (2, 1), (0, 0)]]
    got = repair(tie, knot, [SQUARE], spike, slit, island, corner, [[(0, 0), (1, 0), (0, 0)]])
    assert got[0] == (halves, False) and got[1] == (halves, False)
    assert got[2] == ([[SQUARE]], False) and got[3] == ([[SQUARE]], True)
    assert got[4][0][0][0][0] == (0, 0) and not got[4][1]  # a line inside the area is no line of its own
    assert [len(p) for p in got[5][0]] == [2, 1]
    assert got[6] == ([corner], False)  # a hole may touch the outline in a point
    assert got[7] == ([], True)


def test_sound_rows_stay_as_they_are():
    rows = [[SQUARE], [SQUARE, [(1, 1), (1, 2), (2, 2), (1, 1)]], [[(5, 5), (9, 5), (5, 9), (5, 5)]]]
    assert repair(*rows) == [([r], False) for r in rows]


@pytest.mark.parametrize("seed", range(4))
def test_random_rings_keep_their_area(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(150):
        rings = []
        for _ in range(rng.choice([1, 1, 2])):
            ring = [(rng.randint(0, 8), rng.randint(0, 8)) for _ in range(rng.randint(3, 9))]
            rings.append([*ring, ring[0]])
        rows.append(rings)
    for k, (row, (parts, _)) in enumerate(zip(rows, repair(*rows), strict=True)):
        x, y = np.random.default_rng(k).uniform(-0.5, 8.5, (2, 300))

        def inside(polygon, x=x, y=y):
            hits = np.zeros(len(x), int)
            for ring in polygon:
                for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                    if ay != by:
                        hits += ((ay > y) != (by > y)) & (ax + (y - ay) * (bx - ax) / (by - ay) > x)
            return hits % 2

        assert (sum(map(inside, parts), np.zeros(300, int)) == inside(row)).all()
        if parts:
            assert K.simple_batch(column(parts)).all()
            again = R.repair_batch(column(parts))[0].to_pylist()
            assert [len(p) for p in again] == [1] * len(parts)  # repaired parts are valid


def test_only_single_polygons_are_buildings(spark):
    tie = [[(0.0, 0.0), (4.0, 2.0), (4.0, 0.0), (0.0, 2.0), (0.0, 0.0)]]
    rows = [(1, tie), (2, [SQUARE]), (3, None), (4, [[(1.0, 1.0), (2.0, 2.0), (1.0, 1.0)]])]
    df = spark.createDataFrame([(i, None if r is None else [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in r]) for i, r in rows], "fid long, rings array<array<struct<x:double,y:double>>>")
    got = {r["fid"]: (r["geometry_type"], len(r["parts"] or [])) for r in reconstruction.repair_parts(df).collect()}
    assert got == {1: ("MULTIPOLYGON", 2), 2: ("POLYGON", 1), 3: (None, 0), 4: ("MULTILINESTRING", 0)}
