"""Polygons as Spark columns.

A polygon is ``array<array<struct<x,y>>>``: closed rings, the first one outer, the
others holes. Everything here is a JVM expression (higher-order functions); the exact
polygon-against-polygon tests live in :mod:`gevel.functions.kernels`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gevel.functions.rows import bind, settle

POINT = T.StructType(
    [T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
)
RING = T.ArrayType(POINT)
RINGS = T.ArrayType(RING)
POINT3 = T.StructType(POINT.fields + [T.StructField("z", T.DoubleType())])

BOX = ("x0", "y0", "x1", "y1")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def no_rings() -> Column:
    """An empty polygon. Long runs of NULL lists are slow to hand to Python, empty ones not."""
    return F.array().cast(RINGS)


def point(x: Column | str, y: Column | str) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def box_rings(x0, y0, x1, y1) -> Column:
    """Rectangle as a one-ring polygon, counter-clockwise."""
    if all(isinstance(v, str) for v in (x0, y0, x1, y1)):
        corners = ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
        pts = ", ".join(f"named_struct('x', double({x}), 'y', double({y}))" for x, y in corners)
        return F.expr(f"array(array({pts}))")
    return F.array(
        F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))
    )


def segments(ring: Column) -> Column:
    """Consecutive vertex pairs of a closed ring as ``array<struct<a,b>>``."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def signed_area(ring: Column) -> Column:
    """Signed ring area, taken relative to the first vertex to keep digits."""
    o = ring[0]
    return 0.5 * _total(
        F.transform(
            segments(ring),
            lambda s: (s.a.x - o.x) * (s.b.y - o.y) - (s.b.x - o.x) * (s.a.y - o.y),
        )
    )


def area(rings: Column | str) -> Column:
    """Outer area minus hole areas."""
    rings = _c(rings)
    sizes = F.transform(rings, lambda r: F.abs(signed_area(r)))
    return bind(sizes, lambda s: 2 * s[0] - _total(s))


def perimeter(rings: Column | str) -> Column:
    def length(ring: Column) -> Column:
        return _total(
            F.transform(segments(ring), lambda s: F.hypot(s.b.x - s.a.x, s.b.y - s.a.y))
        )

    return _total(F.transform(_c(rings), length))


def n_points(rings: Column | str) -> Column:
    return F.aggregate(_c(rings), F.lit(0), lambda acc, r: acc + F.size(r))


def centroid(rings: Column | str) -> Column:
    """Area-weighted centroid; holes count negatively."""
    rings = _c(rings)
    o = rings[0][0]

    def moments(ring: Column, i: Column) -> Column:
        def part(s: Column) -> Column:
            ax, ay, bx, by = s.a.x - o.x, s.a.y - o.y, s.b.x - o.x, s.b.y - o.y
            w = ax * by - bx * ay
            return F.struct(w.alias("w"), ((ax + bx) * w).alias("mx"), ((ay + by) * w).alias("my"))

        raw = F.aggregate(
            F.transform(segments(ring), part),
            F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my")),
            _add_moments,
        )

        def signed(m: Column) -> Column:
            flip = F.when(m.w < 0, -1.0).otherwise(1.0) * F.when(i == 0, 1.0).otherwise(-1.0)
            return F.struct((m.w * flip).alias("w"), (m.mx * flip).alias("mx"), (m.my * flip).alias("my"))

        return bind(raw, signed)

    m = F.aggregate(
        F.transform(rings, moments),
        F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my")),
        _add_moments,
    )

    def middle(m: Column) -> Column:
        w = F.nullif(3 * m.w, F.lit(0.0))
        return F.struct((o.x + m.mx / w).alias("x"), (o.y + m.my / w).alias("y"))

    return bind(m, middle)


def _add_moments(acc: Column, v: Column) -> Column:
    return F.struct(
        (acc.w + v.w).alias("w"), (acc.mx + v.mx).alias("mx"), (acc.my + v.my).alias("my")
    )


def bbox(rings: Column | str) -> Column:
    """``struct<x0,y0,x1,y1>`` of the outer ring."""
    outer = _c(rings)[0]
    xs = F.transform(outer, lambda p: p.x)
    ys = F.transform(outer, lambda p: p.y)
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )


def with_bbox(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Adds the four box columns that scans can filter on."""
    df = settle(df)
    return df.select(*df.columns, F.inline(F.array(bbox(rings))))


def is_box(rings: Column | str) -> Column:
    """Axis-parallel rectangle without holes: its box test is already exact."""
    rings = _c(rings)
    outer = rings[0]
    straight = F.forall(
        segments(outer), lambda s: (s.a.x == s.b.x) | (s.a.y == s.b.y)
    )
    return (F.size(rings) == 1) & (F.size(outer) == 5) & straight


def in_bbox(x0, y0, x1, y1, names=BOX) -> Column:
    """Box columns touch the given box; plain comparisons, so scans can prune on them."""
    a, b, c, d = (F.col(n) for n in names)
    return (a <= x1) & (c >= x0) & (b <= y1) & (d >= y0)


def point_in(rings: Column | str, x: Column | str, y: Column | str, boundary: bool = False) -> Column:
    """Even-odd point test; points on an edge count only with ``boundary``."""
    rings, x, y = _c(rings), _c(x), _c(y)

    def crosses(s: Column) -> Column:
        spans = (s.a.y > y) != (s.b.y > y)
        at = s.a.x + (y - s.a.y) * (s.b.x - s.a.x) / F.nullif(s.b.y - s.a.y, F.lit(0.0))
        return spans & F.coalesce(x < at, F.lit(False))

    def on_edge(s: Column) -> Column:
        return (
            ((s.b.x - s.a.x) * (y - s.a.y) == (s.b.y - s.a.y) * (x - s.a.x))
            & x.between(F.least(s.a.x, s.b.x), F.greatest(s.a.x, s.b.x))
            & y.between(F.least(s.a.y, s.b.y), F.greatest(s.a.y, s.b.y))
        )

    edges = F.flatten(F.transform(rings, segments))
    inside = F.size(F.filter(edges, crosses)) % 2 == 1
    touching = F.exists(edges, on_edge)
    return (inside | touching) if boundary else (inside & ~touching)


def outline_meets(rings: Column | str, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether an edge meets the closed box; otherwise the polygon holds all of the box or none of it."""

    def meets(s: Column) -> Column:
        near = (F.least(s.a.x, s.b.x) <= x1) & (F.greatest(s.a.x, s.b.x) >= x0) & (F.least(s.a.y, s.b.y) <= y1) & (F.greatest(s.a.y, s.b.y) >= y0)
        sides = [F.signum((s.b.x - s.a.x) * (y - s.a.y) - (s.b.y - s.a.y) * (x - s.a.x)) for x in (x0, x1) for y in (y0, y1)]
        return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    return F.exists(F.flatten(F.transform(_c(rings), segments)), meets)


# --- repair -------------------------------------------------------------------------


def force_2d(rings: Column | str) -> Column:
    return F.transform(_c(rings), lambda r: F.transform(r, lambda p: point(p.x, p.y)))


def normalise(rings: Column | str) -> Column:
    """Close rings, drop repeated vertices, outer ring counter-clockwise, holes clockwise."""

    def tidy(ring: Column, i: Column) -> Column:
        closed = F.when(ring[0] == F.element_at(ring, -1), ring).otherwise(
            F.concat(ring, F.slice(ring, 1, 1))
        )
        kept = F.filter(closed, lambda p, k: (k == 0) | (p != F.get(closed, k - 1)))
        ccw = signed_area(kept) >= 0
        return F.when(ccw == (i == 0), kept).otherwise(F.reverse(kept))

    return F.transform(_c(rings), tidy)


def explode_parts(df: DataFrame, parts: str, rings: str = "rings") -> DataFrame:
    """One row per part of a multi-part geometry; the other columns repeat."""
    rest = [c for c in df.columns if c != parts]
    return df.select(*rest, F.explode(parts).alias(rings))


def geometry_type(parts: Column | str) -> Column:
    """``POLYGON`` for one part, ``MULTIPOLYGON`` for several."""
    n = F.size(_c(parts))
    return F.when(n == 1, "POLYGON").when(n > 1, "MULTIPOLYGON")


def filter_geometry_type(df: DataFrame, kind: str, col: str = "geometry_type") -> DataFrame:
    return df.filter(F.upper(F.col(col)) == kind.upper())


# --- text forms -----------------------------------------------------------------------


def bbox_to_wkt(x0, y0, x1, y1) -> Column:
    """``POLYGON ((minx miny, maxx miny, maxx maxy, minx maxy, minx miny))``."""
    x0, y0, x1, y1 = (_c(v).cast("string") for v in (x0, y0, x1, y1))
    corner = [F.concat_ws(" ", a, b) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *corner), F.lit("))"))


def from_wkt(wkt: Column | str) -> Column:
    """Rings of a ``POLYGON`` text; NULL for any other kind."""
    wkt = _c(wkt)
    rings = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))

    def ring(text: Column) -> Column:
        return F.transform(
            F.split(text, ","),
            lambda pair: bind(F.split(F.trim(pair), r"\s+"), lambda xy: point(xy[0], xy[1])),
        )

    return F.when(wkt.rlike(r"(?i)^\s*(SRID=\d+;)?\s*polygon"), F.transform(rings, ring))


def parts_from_wkt(wkt: Column | str) -> Column:
    """Rings of each part of a ``POLYGON`` or ``MULTIPOLYGON`` text; NULL for any other kind."""
    wkt = _c(wkt)
    bodies = F.regexp_extract_all(wkt, F.lit(r"\((\s*\([^()]+\)(?:\s*,\s*\([^()]+\))*\s*)\)"), F.lit(1))
    parts = F.transform(bodies, lambda body: from_wkt(F.concat(F.lit("POLYGON("), body, F.lit(")"))))
    return F.when(wkt.rlike(r"(?i)^\s*(SRID=\d+;)?\s*(multi)?polygon"), parts)


def to_wkt(rings: Column | str) -> Column:
    def ring(r: Column) -> Column:
        text = F.transform(r, lambda p: F.concat_ws(" ", p.x.cast("string"), p.y.cast("string")))
        return F.concat(F.lit("("), F.array_join(text, ","), F.lit(")"))

    return F.concat(F.lit("POLYGON("), F.array_join(F.transform(_c(rings), ring), ","), F.lit(")"))


def from_geojson(geometry: Column | str) -> Column:
    """Rings of a GeoJSON ``Polygon`` document; anything else is an error."""
    doc = F.from_json(_c(geometry), "type string, coordinates array<array<array<double>>>")
    rings = F.transform(doc.coordinates, lambda r: F.transform(r, lambda p: point(p[0], p[1])))
    return F.when(F.lower(doc["type"]) == "polygon", rings).when(
        _c(geometry).isNotNull(),
        F.raise_error(F.concat(F.lit("Must be a Polygon, but it is a "), doc["type"])).cast(RINGS),
    )


def parts_from_geojson(geometry: Column | str) -> Column:
    """Rings of each part of a GeoJSON ``Polygon`` or ``MultiPolygon`` document; NULL for any other kind."""
    doc = F.from_json(_c(geometry), "type string, coordinates string")
    polygon = "array<array<array<double>>>"

    def shape(rings: Column) -> Column:
        return F.transform(rings, lambda r: F.transform(r, lambda p: point(p[0], p[1])))

    one = F.array(shape(F.from_json(doc.coordinates, polygon)))
    many = F.transform(F.from_json(doc.coordinates, f"array<{polygon}>"), shape)
    kind = F.lower(doc["type"])
    return F.when(kind == "polygon", one).when(kind == "multipolygon", many)


def bbox_from_wkt(wkt: Column | str) -> Column:
    return bbox(from_wkt(wkt))


# --- location order -------------------------------------------------------------------


def morton(x: Column | str, y: Column | str, cell: float = 1.0) -> Column:
    """Interleaved bits of the two 31-bit cell numbers: near in space, near in order."""

    def spread(v: Column) -> Column:
        v = v.bitwiseAND(F.lit(0x7FFFFFFF))
        for shift, mask in (
            (16, 0x0000FFFF0000FFFF),
            (8, 0x00FF00FF00FF00FF),
            (4, 0x0F0F0F0F0F0F0F0F),
            (2, 0x3333333333333333),
            (1, 0x5555555555555555),
        ):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    cx = F.floor(_c(x) / cell).cast("long") + F.lit(1 << 30)
    cy = F.floor(_c(y) / cell).cast("long") + F.lit(1 << 30)
    return spread(cx).bitwiseOR(F.shiftleft(spread(cy), 1))
