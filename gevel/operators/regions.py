"""Points and shapes in regions, through an index of clipped edges.

Each region is laid on a grid of about as many cells as it has vertices. A cell holds the edges that meet it and whether
its lower right corner is inside; a cell without edges is wholly inside, and cells outside are left out. A point
is joined to its cell only. It is inside if the corner is, turned around for each edge that the way from the
point to the right border and down to the corner crosses. So neither the join nor the test sees a whole region.

Corners, and the bend of that way, are taken to lie a little to the right and, by more, above their place. That
decides every tie alike, in the index and in the test, and needs no tolerance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions import kernels as K
from gevel.functions.rows import by_merge, settle
from gevel.session import cut_lineage

#: a region has at least so many cells
LEAST = 16
#: cells are four times as wide from one level to the next, so that few levels are in use
STEP = 2
EDGE = ("ax", "ay", "bx", "by")
_MARGIN = 1e-9


def _left(ax, ay, bx, by, x: Column, y: Column) -> Column:
    """Whether a place lies to the left of an edge's line, seen along the edge; ties as stated above."""
    cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
    return (cross > 0) | ((cross == 0) & ((bx > ax) | ((bx == ax) & (by < ay))))


def _size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def index_regions(regions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """level, cx, cy, edges, inside and the ``keep`` columns: the cells of each region that are not outside it.

    ``regions`` carries ``rings``. A ring without points is no region. The work and the rows grow with the number of vertices.
    """
    spread = F.flatten(F.transform("rings", G.segments))
    named = settle(regions.where(F.size("rings") > 0), F.monotonically_increasing_id().alias("_r"), *keep, "rings", spread.alias("_edges"), G.bbox("rings").alias("_box"))
    wide, high, count = F.col("_box.x1") - F.col("_box.x0"), F.col("_box.y1") - F.col("_box.y0"), F.greatest(F.size("_edges"), F.lit(LEAST))
    # a side of no length counts as a thousandth of the other, so that thin regions have cells too
    one = F.sqrt(F.greatest(wide, high / 1000, F.lit(1e-6)) * F.greatest(high, wide / 1000, F.lit(1e-6)) / count)
    level = (F.ceil(F.log2(one) / STEP) * STEP).cast("int")
    named = cut_lineage(named.select("_r", *keep, level.alias("level"), "_box", "_edges"))
    edges = settle(named.select("_r", "level", F.explode("_edges").alias("e")), "_r", "level", *[F.col(f"e.{p}.{c}").alias(p + c) for p in "ab" for c in "xy"])
    edges = edges.where("ax <> bx OR ay <> by").withColumn("s", _size(F.col("level")))
    held = _cells_of_edges(edges).groupBy("_r", "cx", "cy").agg(F.collect_list(F.struct(*EDGE)).alias("edges"))
    corners = _corners(named, edges)
    none = F.array().cast("array<struct<ax:double,ay:double,bx:double,by:double>>")
    cells = corners.join(by_merge(held), ["_r", "cx", "cy"], "left").where("inside OR edges IS NOT NULL").withColumn("edges", F.coalesce("edges", none))
    return cells.join(named.select("_r", "level", *keep), "_r").drop("_r")


def _cells_of_edges(edges: DataFrame) -> DataFrame:
    """Each edge in every cell it may meet, borders included: column by column, the cells its part there runs through."""
    x0, x1, s = F.least("ax", "bx"), F.greatest("ax", "bx"), F.col("s")
    by_column = edges.withColumn("cx", F.explode(F.sequence(F.floor(x0 / s - _MARGIN), F.floor(x1 / s + _MARGIN))))
    slope = (F.col("by") - F.col("ay")) / F.nullif(F.col("bx") - F.col("ax"), F.lit(0.0))

    def height(x: Column) -> Column:
        return F.greatest(F.least(F.col("ay") + (x - F.col("ax")) * slope, F.greatest("ay", "by")), F.least("ay", "by"))

    left, right = F.greatest(x0, F.col("cx") * s), F.least(x1, (F.col("cx") + 1) * s)
    upright = F.col("ax") == F.col("bx")
    low = F.when(upright, F.least("ay", "by")).otherwise(F.least(height(left), height(right)))
    high = F.when(upright, F.greatest("ay", "by")).otherwise(F.greatest(height(left), height(right)))
    by_column = by_column.select("_r", "s", "cx", *EDGE, low.alias("_low"), high.alias("_high"))
    # rounding of a steep edge within a column is far below this share of a cell
    return by_column.withColumn("cy", F.explode(F.sequence(F.floor(F.col("_low") / s - 1e-6), F.floor(F.col("_high") / s + 1e-6))))


def _corners(named: DataFrame, edges: DataFrame) -> DataFrame:
    """_r, cx, cy and inside, for the lower right corner, of every cell in the box of a region.

    An edge that a row's lower border crosses turns all corners around that lie to the left of it; a running
    count from the right over the row gives how often.
    """
    s = F.col("s")
    grid = named.select("_r", "_box", _size(F.col("level")).alias("s"))
    rows = grid.withColumn("cy", F.explode(F.sequence(F.floor(F.col("_box.y0") / s - _MARGIN), F.floor(F.col("_box.y1") / s + _MARGIN))))
    cells = rows.select("_r", "cy", F.explode(F.sequence(F.floor(F.col("_box.x0") / s - _MARGIN), F.floor(F.col("_box.x1") / s + _MARGIN))).alias("cx"), F.lit(0).alias("turn"))
    y0 = F.col("cy") * s
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    crossed = edges.where(low < high).withColumn("cy", F.explode(F.sequence(F.floor(low / s), F.floor(high / s)))).where((low <= y0) & (high > y0))
    at = F.col("ax") + (y0 - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    crossed = crossed.withColumn("_k", F.floor(at / s) - 2)

    def beyond(k: int) -> Column:
        """Whether the edge is to the right of the corner of the k-th cell from there."""
        left = _left(*map(F.col, EDGE), (F.col("_k") + k + 1) * s, y0)
        return (left == (F.col("by") > F.col("ay"))).cast("int")

    turns = crossed.select("_r", "cy", (F.col("_k") + beyond(1) + beyond(2)).alias("cx"), F.lit(1).alias("turn"))
    order = Window.partitionBy("_r", "cy").orderBy(F.col("cx").desc(), F.col("turn").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return cells.unionByName(turns).withColumn("_n", F.sum("turn").over(order)).where("turn = 0").select("_r", "cx", "cy", (F.col("_n") % 2 == 1).alias("inside"))


def _levels(index: DataFrame) -> Column:
    """Levels in use, a scalar subquery of few small numbers."""
    return index.agg(F.collect_set("level")).scalar()


def _inside(x: Column, y: Column) -> Column:
    """Whether a place in the cell is inside the region; on an edge it is either."""
    s = _size(F.col("level"))
    right, low = (F.col("cx") + 1) * s, F.col("cy") * s

    def crosses(e: Column) -> Column:
        edge = [e[c] for c in EDGE]
        bend = _left(*edge, right, y)
        across = ((e.ay > y) != (e.by > y)) & (_left(*edge, x, y) != bend)
        down = ((e.ax > right) != (e.bx > right)) & (bend != _left(*edge, right, low))
        return across != down

    return F.col("inside") != (F.size(F.filter("edges", crosses)) % 2 == 1)


def _on_edge(x: Column, y: Column) -> Column:
    return F.exists(
        "edges",
        lambda e: ((e.bx - e.ax) * (y - e.ay) == (e.by - e.ay) * (x - e.ax)) & x.between(F.least(e.ax, e.bx), F.greatest(e.ax, e.bx)) & y.between(F.least(e.ay, e.by), F.greatest(e.ay, e.by)),
    )


def points_in_regions(points: DataFrame, index: DataFrame, keep: Sequence[str], x: str = "px", y: str = "py") -> DataFrame:
    """Each point with the ``keep`` columns of every region whose interior holds it; points without a place are in none."""
    at = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("level", F.explode(_levels(index)))
    at = at.withColumn("cx", F.floor(F.col(x) / _size(F.col("level")))).withColumn("cy", F.floor(F.col(y) / _size(F.col("level"))))
    met = at.join(by_merge(index), ["level", "cx", "cy"])
    held = (F.size("edges") == 0) | (_inside(F.col(x), F.col(y)) & ~_on_edge(F.col(x), F.col(y)))
    return met.where(held).select(*points.columns, *keep)


def shapes_in_regions(shapes: DataFrame, index: DataFrame, id: str, keep: Sequence[str]) -> DataFrame:
    """``id`` of each shape with the ``keep`` columns of every region it meets, touching included; pairs may be repeated.

    A shape meets a region if an edge of the region meets it, which its cell shows, or if its first point is inside.
    """
    s = _size(F.col("level"))
    first = F.col("rings")[0][0]
    boxed = G.is_box("rings")
    at = settle(shapes.where(F.col("x0").isNotNull()), id, *G.BOX, F.when(boxed, G.no_rings()).otherwise(F.col("rings")).alias("rings"), boxed.alias("boxed"), first.x.alias("fx"), first.y.alias("fy"))
    at = at.withColumn("level", F.explode(_levels(index)))
    at = at.withColumn("cx", F.explode(F.sequence(F.floor(F.col("x0") / s), F.floor(F.col("x1") / s)))).withColumn("cy", F.explode(F.sequence(F.floor(F.col("y0") / s), F.floor(F.col("y1") / s))))
    met = at.join(by_merge(index), ["level", "cx", "cy"])
    starts = (F.floor(F.col("fx") / s) == F.col("cx")) & (F.floor(F.col("fy") / s) == F.col("cy"))
    x0, y0, x1, y1 = (F.col(c) for c in G.BOX)

    def meets_box(e: Column) -> Column:
        near = (F.least(e.ax, e.bx) <= x1) & (F.greatest(e.ax, e.bx) >= x0) & (F.least(e.ay, e.by) <= y1) & (F.greatest(e.ay, e.by) >= y0)
        side = [F.signum((e.bx - e.ax) * (cy - e.ay) - (e.by - e.ay) * (cx - e.ax)) for cx in (x0, x1) for cy in (y0, y1)]
        return near & (F.least(*side) <= 0) & (F.greatest(*side) >= 0)

    empty = F.size("edges") == 0
    certain = (F.col("boxed") & (empty | F.exists("edges", meets_box))) | (starts & F.when(empty, F.lit(True)).otherwise(_inside(F.col("fx"), F.col("fy"))))
    met = settle(met, id, *keep, "rings", "edges", certain.alias("certain"), (~F.col("boxed") & ~empty).alias("ask"))
    met = met.where("certain OR ask")
    ask = F.col("ask") & ~F.col("certain")
    rings, edges = F.when(ask, F.col("rings")).otherwise(G.no_rings()), F.when(ask, F.col("edges")).otherwise(F.slice("edges", 1, 0))
    return met.where(F.col("certain") | K.polygon_meets_edges(rings, edges)).select(id, *keep)


def assign_region(df: DataFrame, regions: DataFrame, code: str, id: str, predicate: str = "intersects", values: Sequence[str] = ()) -> DataFrame:
    """The region of each row; one that meets several gets the smallest code. Rows in no region are not listed.

    ``intersects`` includes touching boundaries and takes ``rings`` and the box columns; ``contains`` asks
    whether the interior holds the point ``px``, ``py``. ``values`` are further region columns, taken from the same region.
    """
    keep = [code, *values]
    index = cut_lineage(index_regions(regions, keep))
    if predicate == "contains":
        pairs = points_in_regions(df.select(id, "px", "py"), index, keep)
    elif predicate == "intersects":
        pairs = shapes_in_regions(df.select(id, *G.BOX, "rings"), index, id, keep)
    else:
        raise ValueError(f"unknown predicate {predicate!r}")
    return pairs.groupBy(id).agg(F.min(F.struct(*keep)).alias("_best")).select(id, *[F.col(f"_best.{c}") for c in keep])
