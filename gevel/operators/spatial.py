"""Spatial joins and the aggregates built on them.

All joins go through :func:`candidates`: every box belongs to the grid level whose cell
is just larger than the box, so it touches at most four cells there, however mixed the
sizes are. Two boxes meet at the coarser of their two levels. The join is a plain
equi-join on (level, cell), each pair comes out once, and no second shuffle is needed to
remove repeats. Copies of one geometry are collapsed to one row with a weight before any
join, so a pile of identical footprints costs one row, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions import kernels as K
from gevel.functions.rows import by_merge, settle, spread
from gevel.session import cut_lineage

BASE = 4.0
LEVELS = 22  # the coarsest cells are then wider than any country
STEP_BITS = 2  # each level's cells are four times as wide as the one before
PIECE_ROWS = 2048  # shapes of one piece that a task compares with all others there
CLASS_BITS = 5  # footprints of one class of sizes differ by up to 32 times


def _level(box: Sequence[str], base: float, bits: int) -> Column:
    """Number of cell sizes smaller than the box."""
    x0, y0, x1, y1 = box
    side = f"greatest({x1} - {x0}, {y1} - {y0})"
    whens = " ".join(f"WHEN {side} <= {base * 2.0 ** (bits * k)}D THEN {k}" for k in range(LEVELS - 1))
    return F.expr(f"CASE {whens} ELSE {LEVELS - 1} END")


def _cell_size(level: str, base: float, bits: int) -> Column:
    return F.expr(f"{base}D * shiftleft(1L, {bits} * {level})")


def _cell(v: Column, size: Column) -> Column:
    return F.floor(v / size).cast("long")


def _range(lo: Column, hi: Column) -> Column:
    return F.sequence(lo, hi)


def _on_grid(
    df: DataFrame, box: Sequence[str], own: str, other_levels: Column, base: float, bits: int,
) -> DataFrame:
    """One row per (level, cell) at which a box can meet a box of the other side."""
    x0, y0, x1, y1 = (F.col(c) for c in box)
    size = _cell_size("_k", base, bits)
    level = _level(box, base, bits)
    coarser = F.array_intersect(other_levels, F.sequence(F.col(own) + 1, F.lit(LEVELS)))
    levels = F.array_union(F.array(F.col(own)), coarser)
    return (
        df.select("*", level.alias(own))
        .withColumn("_k", F.explode(levels))
        .withColumn("_cx", F.explode(_range(_cell(x0, size), _cell(x1, size))))
        .withColumn("_cy", F.explode(_range(_cell(y0, size), _cell(y1, size))))
    )


def _levels_of(df: DataFrame, box: Sequence[str], base: float = BASE, bits: int = STEP_BITS) -> Column:
    """Grid levels in use, as a scalar subquery (at most ``LEVELS`` small integers)."""
    return df.select(_level(box, base, bits).alias("_k")).agg(F.collect_set("_k").alias("ks")).scalar()


def candidates(
    left: DataFrame,
    right: DataFrame,
    left_box: Sequence[str] = G.BOX,
    right_box: Sequence[str] = ("rx0", "ry0", "rx1", "ry1"),
    on: Sequence[str] = (),
    base: float = BASE,
    salt: int = 1,
    left_levels: Column | None = None,
    right_levels: Column | None = None,
    bits: int = STEP_BITS,
) -> DataFrame:
    """All pairs of rows whose closed boxes meet, each pair once.

    Cells of level ``k`` are ``base * 2 ** (bits * k)`` wide.

    ``on`` adds equality keys shared by name. ``salt`` spreads the left rows of one cell
    over that many tasks and repeats the right rows; use it where the right side is a
    short list of large areas. Other hot cells are split by adaptive skew handling.
    ``left_levels`` and ``right_levels`` give the levels in use where a cheaper source
    for them exists than the sides themselves.
    """
    left = left.filter(F.col(left_box[0]).isNotNull())
    right = right.filter(F.col(right_box[0]).isNotNull())
    if left_levels is None:
        left_levels = _levels_of(left, left_box, base, bits)
    if right_levels is None:
        right_levels = _levels_of(right, right_box, base, bits)
    l = _on_grid(left, left_box, "_lk", right_levels, base, bits)
    r = _on_grid(right, right_box, "_rk", left_levels, base, bits)
    keys = ["_k", "_cx", "_cy", *on]
    if salt > 1:
        dealt = F.pmod(F.xxhash64(*[c for c in left.columns if c not in on]), F.lit(salt)).cast("int")
        l = l.withColumn("_salt", dealt)
        r = r.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        keys.append("_salt")
    lx0, ly0, lx1, ly1 = (F.col(c) for c in left_box)
    rx0, ry0, rx1, ry1 = (F.col(c) for c in right_box)
    size = _cell_size("_k", base, bits)
    meet = (lx0 <= rx1) & (rx0 <= lx1) & (ly0 <= ry1) & (ry0 <= ly1)
    once = (
        (F.col("_k") == F.greatest("_lk", "_rk"))
        & (F.col("_cx") == _cell(F.greatest(lx0, rx0), size))
        & (F.col("_cy") == _cell(F.greatest(ly0, ry0), size))
    )
    joined = l.join(by_merge(r), keys).filter(meet & once)
    return joined.drop("_k", "_cx", "_cy", "_lk", "_rk", "_salt")


def _plain(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Marks rectangles before the join, so that pairs only read the mark."""
    return df.withColumn("plain", G.is_box(rings))


def as_right(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Right side of a join: geometry columns get an ``r`` prefix."""
    return df.select(
        *[F.col(c).alias("r" + c) for c in (*G.BOX, "rings", "plain") if c in df.columns],
        *[c for c in df.columns if c in keep],
    )


def _met(pairs: DataFrame) -> DataFrame:
    """Adds ``_met``, the exact intersection; two plain boxes are already decided by the box test."""
    both = F.col("plain") & F.col("rplain")
    a = F.when(both, G.no_rings()).otherwise(F.col("rings"))
    b = F.when(both, G.no_rings()).otherwise(F.col("rrings"))
    return pairs.withColumn("_met", K.polygons_intersect(a, b))


def _refine(pairs: DataFrame) -> DataFrame:
    """Pairs that meet exactly."""
    return _met(pairs).filter("_met").drop("_met")


def spatial_join(
    left: DataFrame,
    right: DataFrame,
    predicate: str = "intersects",
    keep: Sequence[str] | None = None,
    base: float = BASE,
    salt: int = 1,
) -> DataFrame:
    """Inner join on geometry. Both sides carry ``rings`` and the box columns.

    ``intersects`` includes touching boundaries. ``contains`` asks whether the right
    polygon contains the left centroid (columns ``px``, ``py``), boundary excluded.
    ``keep`` names the right columns to bring along.
    """
    keep = [c for c in right.columns if c not in (*G.BOX, "rings")] if keep is None else keep
    r = as_right(_plain(right), keep)
    if predicate == "intersects":
        pairs = _refine(candidates(_plain(left), r, base=base, salt=salt))
    elif predicate == "contains":
        pairs = points_on_grid(left, r, "px", "py", salt).filter(G.point_in("rrings", "px", "py"))
    else:
        raise ValueError(f"unknown predicate {predicate!r}")
    return pairs.drop("rx0", "ry0", "rx1", "ry1", "rrings", "plain", "rplain")


# --- copies ---------------------------------------------------------------------------


def distinct_shapes(df: DataFrame, id: str, on: Sequence[str] = ()) -> DataFrame:
    """One row per distinct geometry: a representative id and the number of copies."""
    return _plain(
        df.groupBy(*on, *G.BOX, "rings").agg(F.min(id).alias("shape"), F.count("*").alias("copies"))
    )


def _as_other(shapes: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    return shapes.select(*on, *[F.col(c).alias("r" + c) for c in (*G.BOX, "rings", "plain", "shape", "copies")])


def _back_to_ids(
    df: DataFrame, per_shape: DataFrame, id: str, value: str, on: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """Gives each id the value of its geometry (join on the geometry itself)."""
    keys = [*on, *G.BOX, "rings"]
    right = per_shape.select(*[F.col(c).alias("_" + c) for c in keys], value)
    same = F.col(keys[0]) == F.col("_" + keys[0])
    for c in keys[1:]:
        same &= F.col(c) == F.col("_" + c)
    return df.select(id, *keys).join(by_merge(right), same, how).select(id, *on, value)


# --- overlap of buildings ---------------------------------------------------------------


def crowded_cells(shapes: DataFrame, tile: float, on: Sequence[str] = (), crowd: int = 256, depth: int = 6) -> DataFrame | None:
    """Pieces (_fx, _fy, _fs: corner and width) of the crowded ``tile`` cells (_tx, _ty), or None where no cell is crowded.

    A cell that the outlines of more than ``crowd`` shapes meet is cut into four, and so are its quarters, ``depth`` times
    at most: outlines that run through one place cannot be parted. The cells are counted, not their pairs; only
    crowded ones are read with their shapes.
    """
    size = F.lit(float(tile))
    x0, y0, x1, y1 = (F.col(c) for c in G.BOX)
    fx, fy, fs = F.col("_fx"), F.col("_fy"), F.col("_fs")
    at = shapes.withColumn("_tx", F.explode(_range(_cell(x0, size), _cell(x1, size)))).withColumn("_ty", F.explode(_range(_cell(y0, size), _cell(y1, size))))
    at = at.withColumns({"_fx": F.col("_tx") * size, "_fy": F.col("_ty") * size, "_fs": size})
    around = F.col("plain") & (x0 < fx) & (y0 < fy) & (x1 > fx + fs) & (y1 > fy + fs)
    place = [*on, "_tx", "_ty", "_fx", "_fy", "_fs"]
    cells = cut_lineage(at.filter(~around).groupBy(*place).count().filter(F.col("count") > crowd).drop("count"))
    if cells.isEmpty():
        return None
    members = at.join(by_merge(cells.select(*on, "_tx", "_ty")), [*on, "_tx", "_ty"], "left_semi").select(*place, "rings")
    corners = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])

    def quarters(df: DataFrame) -> DataFrame:
        cut = df.withColumn("_q", F.explode(corners)).withColumn("_fs", fs / 2)
        return cut.withColumns({"_fx": fx + F.col("_q.i") * fs, "_fy": fy + F.col("_q.j") * fs}).drop("_q")

    whole = []
    for _ in range(depth):
        members = quarters(members).filter(G.outline_meets("rings", fx, fy, fx + fs, fy + fs))
        members = cut_lineage(members)
        full = cut_lineage(members.groupBy(*place).count().filter(F.col("count") > crowd).drop("count"))
        cells = quarters(cells)
        whole.append(cells.join(by_merge(full), place, "left_anti"))
        cells = full
        if cells.isEmpty():
            break
        members = members.join(by_merge(full), place, "left_semi")
    else:
        whole.append(cells)
    out = whole[0]
    for more in whole[1:]:
        out = out.unionByName(more)
    return cut_lineage(out)


def overlap_area(
    df: DataFrame, id: str = "fid", min_area: float = 1.0, tile: float = 64.0, on: Sequence[str] = (), crowd: int = 256,
) -> DataFrame:
    """Per building the area it shares with the union of all others it meets.

    Buildings that meet no other are not listed; less than ``min_area`` is reported as 0.
    ``on`` restricts the comparison to rows with equal keys.

    The union is taken per building and ``tile`` cell, so a large shape with very many
    neighbours is worked on in pieces, and a piece that one neighbour covers completely
    keeps only that neighbour. Cells that the outlines of more than ``crowd`` shapes meet are split
    further, see ``crowded_cells``. A shape meets itself when it has copies.
    """
    shapes = distinct_shapes(df, id, on).filter(F.col("x0").isNotNull())
    size, piece = F.lit(float(tile)), [*on, "_i", "_j", "_d"]
    cells = crowded_cells(shapes, tile, on, crowd)
    fx0, fy0, fs = F.col("_fx"), F.col("_fy"), F.col("_fs")
    x0, y0, x1, y1 = (F.col(c) for c in G.BOX)
    placed = (
        shapes.withColumn("_tx", F.explode(_range(_cell(x0, size), _cell(x1, size))))
        .withColumn("_ty", F.explode(_range(_cell(y0, size), _cell(y1, size))))
    )
    if cells is None:
        placed = placed.withColumns({"_fx": F.col("_tx") * size, "_fy": F.col("_ty") * size, "_fs": size, "_split": F.lit(False)})
    else:
        placed = placed.join(by_merge(cells), [*on, "_tx", "_ty"], "left").withColumn("_split", fs.isNotNull())
        placed = placed.filter(~F.col("_split") | ((fx0 <= x1) & (fy0 <= y1) & (fx0 + fs >= x0) & (fy0 + fs >= y0)))
        placed = placed.withColumns({"_fx": F.coalesce("_fx", F.col("_tx") * size), "_fy": F.coalesce("_fy", F.col("_ty") * size), "_fs": F.coalesce("_fs", size)})
    # whole numbers as keys: Spark rewrites keys that are doubles, and would then shuffle the pairs again
    placed = placed.withColumns({"_i": F.rint(fx0 / fs).cast("long"), "_j": F.rint(fy0 / fs).cast("long"), "_d": F.rint(F.log2(size / fs)).cast("int")})
    placed = cut_lineage(placed.drop("_tx", "_ty"))
    # a piece with very many shapes is shared among tasks
    full = cut_lineage(placed.groupBy(*piece).count().filter(F.col("count") > PIECE_ROWS))
    if full.isEmpty():
        placed = placed.withColumn("_tasks", F.lit(1))
    else:
        placed = placed.join(by_merge(full), piece, "left").withColumn("_tasks", F.ceil(F.coalesce("count", F.lit(1)) / PIECE_ROWS).cast("int")).drop("count")
    l = placed.withColumn("_task", F.pmod(F.xxhash64("shape"), F.col("_tasks")).cast("int")).drop("_tasks")
    r = _as_other(placed.withColumn("_task", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1))), [*piece, "_task"])
    gx0, gy0 = F.greatest("x0", "rx0"), F.greatest("y0", "ry0")
    gx1, gy1 = F.least("x1", "rx1"), F.least("y1", "ry1")
    meet = (gx0 <= gx1) & (gy0 <= gy1) & (~F.col("_split") | ((fx0 <= gx1) & (fy0 <= gy1) & (fx0 + fs >= gx0) & (fy0 + fs >= gy0)))
    # shapes meet in their pieces, so that pairs stay in the task where they are found
    own = F.col("shape") == F.col("rshape")
    l, r = (spread(side, *piece, "_task") for side in (l, r))
    pieces = l.join(by_merge(r), [*piece, "_task"]).filter(meet)
    # boxes that meet need no exact test, and without one rows are grouped where they are, with no shuffle of pairs
    pieces = pieces.withColumn("_met", F.lit(True)) if placed.filter(~F.col("plain")).isEmpty() else _met(pieces)
    # a shape meets itself wherever it meets another, so that row alone carries its rings
    pieces = pieces.filter(F.col("_met") | own).withColumns({
        "rrings": F.when(~own | (F.col("_met") & (F.col("copies") + F.col("rcopies") > 2)), F.col("rrings")),
        "rings": F.when(own, F.col("rings")),
    }).drop("_met")
    px0, py0 = F.greatest("x0", fx0), F.greatest("y0", fy0)
    px1, py1 = F.least("x1", fx0 + fs), F.least("y1", fy0 + fs)
    covers = own | (
        F.col("rplain")
        & (F.col("rx0") <= px0) & (F.col("ry0") <= py0) & (F.col("rx1") >= px1) & (F.col("ry1") >= py1)
    )
    if cells is not None:
        # in a split place the others are told apart exactly: all of the piece, none of it, or a part
        once = lambda value, name: pieces.select("*", F.inline(F.array(F.struct(value.alias(name)))))
        pieces = once(F.col("_split") & ~G.outline_meets("rrings", px0, py0, px1, py1), "_clear")
        pieces = once(F.col("_clear") & G.point_in("rrings", (px0 + px1) / 2, (py0 + py1) / 2, boundary=True), "_all")
        pieces = pieces.filter(own | F.col("rrings").isNull() | ~F.col("_clear") | F.col("_all"))
        covers = covers | F.coalesce("_all", F.lit(False))
    alone = (fx0 <= F.col("x0")) & (fy0 <= F.col("y0")) & (fx0 + fs >= F.col("x1")) & (fy0 + fs >= F.col("y1"))
    frame = F.when(alone, G.no_rings()).otherwise(G.box_rings(fx0, fy0, fx0 + fs, fy0 + fs))
    per_piece = (
        pieces.withColumn("_full", F.when(covers, F.col("rrings")))
        .withColumn("_part", F.when(~covers, F.col("rrings")))
        .withColumn("_frame", frame)
        .groupBy(*piece, "_task", "shape")
        .agg(
            F.first("rings", ignorenulls=True).alias("_p"),
            F.first("_frame").alias("_frame"),
            F.first("_full", ignorenulls=True).alias("_full"),
            F.collect_list("_part").alias("_n"),
        )
        .withColumn("_n", F.when(F.col("_full").isNotNull(), F.array("_full")).otherwise(F.col("_n")))
        .filter(F.size("_n") > 0)
    )
    met = per_piece.select(*on, "shape", "_p", K.covered_area("_p", "_n", "_frame").alias("_a"))
    total = met.groupBy(*on, "shape").agg(F.first("_p").alias("rings"), F.sum("_a").alias("_a"))
    listed = G.with_bbox(total).withColumn(
        "b3_bag_bag_overlap",
        F.when(F.col("_a").isNull() | (F.col("_a") < min_area), 0.0).otherwise(F.col("_a")),
    )
    return _back_to_ids(df, listed, id, "b3_bag_bag_overlap", on)


def label_by_overlap(
    df: DataFrame, polys: DataFrame, id: str = "fid", ratio: float = 0.11,
    kinds: str = "typegebouw", wanted: Sequence[str] = ("kas, warenhuis",),
) -> DataFrame:
    """True where polygons of the wanted kinds cover more than ``ratio`` of the building.

    Areas of the single intersections are summed, so overlapping polygons count twice.
    """
    chosen = polys.filter(F.arrays_overlap(F.col(kinds), F.array(*[F.lit(w) for w in wanted])))
    right = (
        chosen.groupBy(*G.BOX, "rings").agg(F.count("*").alias("_times"))
        .select(*[F.col(c).alias("r" + c) for c in (*G.BOX, "rings")], "_times", G.is_box("rings").alias("rplain"))
    )
    pairs = _refine(
        candidates(
            distinct_shapes(df, id).drop("copies"), right,
            left_levels=_levels_of(df, G.BOX), right_levels=_levels_of(chosen, G.BOX),
        )
    )
    parts = pairs.select("shape", "rings", (K.shared_area("rings", "rrings") * F.col("_times")).alias("_a"))
    summed = parts.groupBy("shape").agg(F.first("rings").alias("rings"), F.sum("_a").alias("_isect"))
    label = G.with_bbox(summed).withColumn(
        "kas_warenhuis", F.col("_isect") / F.nullif(G.area("rings"), F.lit(0.0)) > ratio
    )
    every = _back_to_ids(df, label, id, "kas_warenhuis", how="left")
    return every.withColumn("kas_warenhuis", F.coalesce("kas_warenhuis", F.lit(False)))


# --- neighbours -------------------------------------------------------------------------


def adjacent_count(df: DataFrame, id: str = "identificatie", dist: float = 0.1) -> DataFrame:
    """Number of other buildings that meet the building grown by ``dist`` (mitred).

    Buildings without any are not listed. Counts come from distinct geometries and their
    copies, so no pair is kept; a shape meets its own copies but not itself.
    """
    shapes = distinct_shapes(df, id)
    grown = G.with_bbox(
        shapes.select("shape", "copies", F.col("rings").alias("_own"), K.mitre_buffer(F.col("rings"), dist).alias("rings"))
    )
    grown = _plain(grown)
    pairs = _refine(
        candidates(grown, _as_other(shapes), right_levels=_levels_of(df, G.BOX))
    )
    times = F.when(F.col("shape") == F.col("rshape"), F.col("copies") - 1).otherwise(F.col("rcopies"))
    met = (
        pairs.groupBy("shape").agg(F.first("_own").alias("rings"), F.sum(times).alias("no_adjacent"))
        .filter("no_adjacent > 0")
    )
    return _back_to_ids(df, G.with_bbox(met), id, "no_adjacent")


def neighbours_within(
    df: DataFrame, radius: float = 100.0, id: str = "identificatie", x: str = "cx", y: str = "cy", fine: int = 16,
) -> DataFrame:
    """Number of other points within ``radius`` (closed); points without any are not listed.

    Points with one position are one row with a weight. Cells as wide as the radius are
    divided into ``fine`` x ``fine`` parts. A part whose own extent lies wholly inside the
    circle adds its count, one wholly outside is dropped, and only parts cut by the circle
    are compared point by point; a part with one position is never cut.
    """
    spots = (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("w"))
    )
    # a hair wider than the radius, so that rounding cannot skip a cell
    part = radius * (1 + 1e-9) / fine
    sx, sy = _cell(F.col("x"), F.lit(part)), _cell(F.col("y"), F.lit(part))
    placed = spots.withColumn("sx", sx).withColumn("sy", sy)
    parts = (
        placed.groupBy("sx", "sy").agg(
            F.sum("w").alias("n"),
            F.min("x").alias("bx0"), F.min("y").alias("by0"), F.max("x").alias("bx1"), F.max("y").alias("by1"),
        )
        .withColumn("ix", F.floor(F.col("sx") / fine)).withColumn("iy", F.floor(F.col("sy") / fine))
    )
    hops = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    asking = (
        spots.select("x", "y")
        .withColumn("ix", F.explode(F.transform(hops, lambda h: F.floor(sx / fine) + h)))
        .withColumn("iy", F.explode(F.transform(hops, lambda h: F.floor(sy / fine) + h)))
    )
    r2 = radius * radius
    far_x = F.greatest(F.col("x") - F.col("bx0"), F.col("bx1") - F.col("x"))
    far_y = F.greatest(F.col("y") - F.col("by0"), F.col("by1") - F.col("y"))
    near_x = F.greatest(F.col("bx0") - F.col("x"), F.col("x") - F.col("bx1"), F.lit(0.0))
    near_y = F.greatest(F.col("by0") - F.col("y"), F.col("y") - F.col("by1"), F.lit(0.0))
    all_in = far_x * far_x + far_y * far_y <= r2
    reached = near_x * near_x + near_y * near_y <= r2
    seen = asking.join(parts, ["ix", "iy"]).filter(reached)
    whole = seen.filter(all_in).select("x", "y", "n")
    cut = seen.filter(~all_in).select("x", "y", "sx", "sy")
    there = placed.select("sx", "sy", F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("w").alias("n"))
    dx, dy = F.col("x") - F.col("ox"), F.col("y") - F.col("oy")
    compared = cut.join(there, ["sx", "sy"]).filter(dx * dx + dy * dy <= r2).select("x", "y", "n")
    counts = (
        whole.unionByName(compared).groupBy("x", "y").agg((F.sum("n") - 1).alias("no_neighbours"))
        .filter("no_neighbours > 0").withColumnsRenamed({"x": "_x", "y": "_y"})
    )
    return df.join(counts, (F.col(x) == F.col("_x")) & (F.col(y) == F.col("_y"))).select(id, "no_neighbours")


# --- tiles and points ---------------------------------------------------------------------


def neighbour_tiles(tiles: DataFrame, id: str = "tile_id") -> DataFrame:
    """Pairs of different tiles whose boxes meet."""
    l = tiles.select(id, *G.BOX)
    r = tiles.select(F.col(id).alias("neighbour"), *[F.col(c).alias("r" + c) for c in G.BOX])
    return candidates(l, r).filter(F.col(id) != F.col("neighbour")).select(id, "neighbour")


def size_classes(boxes: DataFrame, box: Sequence[str] = G.BOX) -> list[tuple[int, float]]:
    """Classes of box sizes in use, at most a few tens, and the width of the cells for each.

    A cell has the mean area of the boxes of its class, or their mean side where that is more. The boxes then touch
    at most about four cells each on average, whatever their sizes.
    """
    x0, y0, x1, y1 = (F.col(c) for c in box)
    side = F.greatest(x1 - x0, y1 - y0, F.lit(1e-3))
    rows = boxes.filter(x0.isNotNull()).groupBy(F.floor(F.log2(side) / CLASS_BITS).cast("int").alias("k"))
    found = rows.agg(F.greatest(F.sqrt(F.avg((x1 - x0) * (y1 - y0))), F.avg(x1 - x0 + y1 - y0) / 2, F.lit(1e-3)).alias("c")).collect()
    return sorted((r["k"], r["c"]) for r in found)


def points_on_grid(points: DataFrame, boxes: DataFrame, x: str = "x", y: str = "y", salt: int = 1, box: Sequence[str] = ("rx0", "ry0", "rx1", "ry1")) -> DataFrame:
    """All pairs of a point and a closed box around it.

    The boxes, of which there are far fewer, are copied to the cells they touch, by ``size_classes``; a point goes through the
    shuffle once for each class, which is once unless some boxes are 32 times larger than others. Points
    outside of all boxes are dropped at the scan.
    """
    x0, y0, x1, y1 = (F.col(c) for c in box)
    classes = size_classes(boxes, box)
    if not classes:
        classes = [(0, 1.0)]
    width = F.element_at(F.create_map(*[F.lit(v) for k, c in classes for v in (k, float(c))]), F.col("_k"))
    kind = F.floor(F.log2(F.greatest(x1 - x0, y1 - y0, F.lit(1e-3))) / CLASS_BITS).cast("int")
    r = boxes.filter(x0.isNotNull()).withColumn("_k", kind).withColumn("_c", width)
    r = r.withColumn("_cx", F.explode(_range(_cell(x0, F.col("_c")), _cell(x1, F.col("_c"))))).withColumn("_cy", F.explode(_range(_cell(y0, F.col("_c")), _cell(y1, F.col("_c"))))).drop("_c")
    extent = boxes.agg(F.min(x0), F.min(y0), F.max(x1), F.max(y1)).first()
    near = F.lit(False) if extent[0] is None else F.col(x).between(extent[0], extent[2]) & F.col(y).between(extent[1], extent[3])
    ks = F.lit(classes[0][0]) if len(classes) == 1 else F.explode(F.array(*[F.lit(k) for k, _ in classes]))
    l = points.filter(near).withColumn("_k", ks)
    l = l.withColumn("_cx", _cell(F.col(x), width)).withColumn("_cy", _cell(F.col(y), width))
    keys = ["_k", "_cx", "_cy"]
    if salt > 1:
        l = l.withColumn("_salt", F.pmod(F.xxhash64(*points.columns), F.lit(salt)).cast("int"))
        r = r.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        keys.append("_salt")
    met = l.join(by_merge(r), keys).filter(F.col(x).between(x0, x1) & F.col(y).between(y0, y1))
    return met.drop("_k", "_cx", "_cy", "_salt")


def points_in(
    points: DataFrame, footprints: DataFrame, id: str, salt: int = 1, keep: Sequence[str] = (),
) -> DataFrame:
    """Points inside a footprint's bounding box, with the footprint id and ``keep`` columns."""
    r = footprints.select(id, *keep, *[F.col(c).alias("r" + c) for c in G.BOX])
    return points_on_grid(points, r, salt=salt).drop("rx0", "ry0", "rx1", "ry1")
