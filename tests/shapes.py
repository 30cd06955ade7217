"""Small shapes for the tests."""

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from gevel.functions.geometry import RINGS

ARROW_RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
SCHEMA = T.StructType([T.StructField("fid", T.LongType()), T.StructField("rings", RINGS)])


def rings(*outlines):
    return [[{"x": float(x), "y": float(y)} for x, y in [*o, o[0]]] for o in outlines]


def box(x0, y0, x1, y1):
    return rings([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def frame(spark, shapes):
    from gevel.functions import geometry as G

    rows = [(i, [[(p["x"], p["y"]) for p in r] for r in s]) for i, s in enumerate(shapes)]
    return G.with_bbox(spark.createDataFrame(rows, SCHEMA))


def inside(shape, x, y):
    """Even-odd rule on arrays of positions."""
    c = np.zeros(np.shape(x), bool)
    for ring in shape:
        for a, b in zip(ring, ring[1:]):
            spans = (a["y"] > y) != (b["y"] > y)
            with np.errstate(all="ignore"):
                at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"])
            c ^= spans & (x < at)
    return c


def raster(size=4.0, n=800):
    g = (np.arange(n) + 0.5) * size / n
    x, y = np.meshgrid(g, g)
    return x.ravel(), y.ravel(), (size / n) ** 2


HOLED = rings([(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)])
