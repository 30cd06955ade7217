"""Regular grids, quadtrees and tile membership."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions import kernels as K
from gevel.functions.text import file_id


@dataclass(frozen=True)
class Grid:
    """Cells of one size from a lower-left origin, numbered from 1, x fastest."""

    x0: float
    y0: float
    cell: float
    nx: int
    ny: int

    @staticmethod
    def over(bbox: Sequence[float], cell: float) -> Grid:
        """Grid that covers the box; it grows to full cells on the upper sides."""
        x0, y0, x1, y1 = bbox
        return Grid(x0, y0, cell, math.ceil((x1 - x0) / cell), math.ceil((y1 - y0) / cell))

    @property
    def bbox(self) -> tuple[float, float, float, float]:
        return (self.x0, self.y0, self.x0 + self.nx * self.cell, self.y0 + self.ny * self.cell)

    def left(self, i: Column) -> Column:
        return F.lit(float(self.x0)) + i * float(self.cell)

    def bottom(self, j: Column) -> Column:
        return F.lit(float(self.y0)) + j * float(self.cell)

    def cell_id(self, i: Column, j: Column) -> Column:
        return (j * self.nx + i + 1).cast("long")

    def column_of(self, x: Column) -> Column:
        return F.floor((x - self.x0) / self.cell).cast("long")

    def row_of(self, y: Column) -> Column:
        return F.floor((y - self.y0) / self.cell).cast("long")


def regular_grid(spark: SparkSession, bbox: Sequence[float], cell: float) -> DataFrame:
    """All cells of a grid with their boxes, ids in y-major order."""
    g = Grid.over(bbox, cell)
    i, j = F.col("id") % g.nx, F.floor(F.col("id") / g.nx).cast("long")
    return spark.range(g.nx * g.ny).select(
        g.cell_id(i, j).alias("cell_id"),
        g.left(i).alias("x0"), g.bottom(j).alias("y0"), g.left(i + 1).alias("x1"), g.bottom(j + 1).alias("y1"),
    )


def _clipped(lo: Column, hi: Column, n: int) -> Column:
    lo, hi = F.greatest(lo, F.lit(0)), F.least(hi, F.lit(n - 1))
    return F.explode(F.when(lo <= hi, F.sequence(lo.cast("long"), hi.cast("long"))))


def cells_of_tiles(tiles: DataFrame, grid: Grid, id: str = "tile_id", collect: bool = True) -> DataFrame:
    """Tiles whose interior meets a cell, unless the tile lies inside the cell.

    The cells of a tile follow from its box by arithmetic, so nothing is joined. With
    ``collect`` the tile ids come as one sorted array per cell.
    """
    x0, y0, x1, y1 = (F.col(c) for c in G.BOX)
    polygons = "rings" in tiles.columns
    hit = (
        tiles.select(id, *G.BOX, *(["rings"] if polygons else []))
        .withColumn("_i", _clipped(grid.column_of(x0), F.ceil((x1 - grid.x0) / grid.cell) - 1, grid.nx))
        .withColumn("_j", _clipped(grid.row_of(y0), F.ceil((y1 - grid.y0) / grid.cell) - 1, grid.ny))
    )
    cx0, cy0 = grid.left(F.col("_i")), grid.bottom(F.col("_j"))
    cx1, cy1 = cx0 + grid.cell, cy0 + grid.cell
    meets = (x0 < cx1) & (cx0 < x1) & (y0 < cy1) & (cy0 < y1)
    within = (x0 >= cx0) & (x1 <= cx1) & (y0 >= cy0) & (y1 <= cy1)
    equal = (x0 == cx0) & (x1 == cx1) & (y0 == cy0) & (y1 == cy1)
    hit = hit.filter(meets & (~within | equal))
    if polygons:
        hit = hit.filter(K.shared_area(F.col("rings"), G.box_rings(cx0, cy0, cx1, cy1)) > 0)
    rows = hit.select(
        grid.cell_id(F.col("_i"), F.col("_j")).alias("cell_id"), cx0.alias("xmin"), cy0.alias("ymin"), id
    )
    if not collect:
        return rows
    return rows.groupBy("cell_id", "xmin", "ymin").agg(F.array_sort(F.collect_list(id)).alias("tile_ids"))


def cells_of_features(df: DataFrame, index: DataFrame, grid: Grid, id: str = "fid") -> DataFrame:
    """Distinct (tile_id, cell_id) touched by any building of the tile, borders included."""
    x0, y0, x1, y1 = (F.col(c) for c in G.BOX)
    cells = (
        df.select(id, *G.BOX, "rings").join(index.select(id, "tile_id"), id).withColumn("_plain", G.is_box("rings"))
        .withColumn("_i", _clipped(F.ceil((x0 - grid.x0) / grid.cell) - 1, grid.column_of(x1), grid.nx))
        .withColumn("_j", _clipped(F.ceil((y0 - grid.y0) / grid.cell) - 1, grid.row_of(y1), grid.ny))
    )
    cx0, cy0 = grid.left(F.col("_i")), grid.bottom(F.col("_j"))
    plain = F.col("_plain")
    touch = K.polygons_intersect(
        F.when(plain, G.no_rings()).otherwise(F.col("rings")),
        F.when(plain, G.no_rings()).otherwise(G.box_rings(cx0, cy0, cx0 + grid.cell, cy0 + grid.cell)),
    )
    return cells.filter(touch).select(
        "tile_id", grid.cell_id(F.col("_i"), F.col("_j")).alias("cell_id")
    ).distinct()


def quadtree_tiles(
    df: DataFrame, cell: float, capacity: float, id: str = "fid", x: str = "cx", y: str = "cy",
    weight: str | None = None, depth: int = 12, origin: tuple[float, float] = (0.0, 0.0),
) -> tuple[DataFrame, DataFrame]:
    """Quadtree leaves over weighted points, and the leaf of every row.

    A node is a leaf when it holds at most ``capacity`` or is a base cell, and its parent
    holds more (or it has none). All levels are counted in one pass over the base cells.
    Returns ``tiles(tile_id, level, nr_items, x0, y0, x1, y1)`` and ``index(id, tile_id)``;
    the tile id is ``level/x/y`` with level 0 the coarsest.
    """
    i = F.floor((F.col(x) - origin[0]) / cell).cast("long")
    j = F.floor((F.col(y) - origin[1]) / cell).cast("long")
    w = F.col(weight) if weight else F.lit(1)
    placed = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(id, i.alias("_i"), j.alias("_j"), w.alias("_w"))
    base = placed.groupBy("_i", "_j").agg(F.sum("_w").alias("_w"))

    def up(c: str, k) -> Column:
        return F.floor(F.col(c) / F.pow(F.lit(2.0), k)).cast("long")

    levels = base.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    nodes = (
        levels.groupBy("_k", up("_i", F.col("_k")).alias("_nx"), up("_j", F.col("_k")).alias("_ny"))
        .agg(F.sum("_w").alias("_n"))
    )
    parents = nodes.filter(F.col("_n") > capacity).select(
        (F.col("_k") - 1).alias("_pk"), F.col("_nx").alias("_px"), F.col("_ny").alias("_py")
    )
    small = nodes.filter((F.col("_n") <= capacity) | (F.col("_k") == 0))
    split = (
        (F.col("_k") == F.col("_pk"))
        & (F.floor(F.col("_nx") / 2) == F.col("_px"))
        & (F.floor(F.col("_ny") / 2) == F.col("_py"))
    )
    leaves = small.filter(F.col("_k") < depth).join(parents, split, "left_semi").unionByName(
        small.filter(F.col("_k") == depth)
    )
    side = F.pow(F.lit(2.0), F.col("_k")) * cell
    name = F.concat_ws("/", (depth - F.col("_k")).cast("string"), F.col("_nx").cast("string"), F.col("_ny").cast("string"))
    tiles = leaves.select(
        name.alias("tile_id"), (depth - F.col("_k")).alias("level"), F.col("_n").alias("nr_items"),
        (origin[0] + F.col("_nx") * side).alias("x0"), (origin[1] + F.col("_ny") * side).alias("y0"),
        (origin[0] + (F.col("_nx") + 1) * side).alias("x1"), (origin[1] + (F.col("_ny") + 1) * side).alias("y1"),
    )
    owners = leaves.select(F.col("_k").alias("_lk"), F.col("_nx").alias("_lx"), F.col("_ny").alias("_ly"), name.alias("tile_id"))
    leaf_of = levels.select("_i", "_j", "_k", up("_i", F.col("_k")).alias("_lx"), up("_j", F.col("_k")).alias("_ly"))
    leaf_of = leaf_of.join(owners, (leaf_of["_k"] == owners["_lk"]) & (leaf_of["_lx"] == owners["_lx"]) & (leaf_of["_ly"] == owners["_ly"]))
    index = placed.join(leaf_of.select("_i", "_j", "tile_id"), ["_i", "_j"]).select(id, "tile_id")
    return tiles, index


def partition_points(points: DataFrame, grid: Grid, x: str = "x", y: str = "y") -> DataFrame:
    """Points with the grid cell they lie in (lower and left edges included)."""
    i, j = grid.column_of(F.col(x)), grid.row_of(F.col(y))
    inside = i.between(0, grid.nx - 1) & j.between(0, grid.ny - 1)
    return points.filter(inside).withColumn("cell_id", grid.cell_id(i, j))


def tile_members(df: DataFrame, index: DataFrame, tile_id: str | None = None, id: str = "fid") -> DataFrame:
    """Buildings with their tile, or those of one tile."""
    wanted = index if tile_id is None else index.filter(F.col("tile_id") == tile_id)
    return df.join(wanted.select(id, "tile_id"), id)


def tiles_in(tiles: DataFrame, wkt: str | None = None) -> DataFrame:
    """Ids of the tiles that meet a polygon (all without one), sorted."""
    if wkt is not None:
        area = G.from_wkt(F.lit(wkt))
        b = G.bbox(area)
        near = tiles.withColumn("_b", b).filter(G.in_bbox(F.col("_b.x0"), F.col("_b.y0"), F.col("_b.x1"), F.col("_b.y1")))
        tiles = near.filter(K.polygons_intersect(G.box_rings(*G.BOX), area))
    return tiles.select("tile_id").orderBy("tile_id")


def leaf_tiles(quadtree: DataFrame) -> DataFrame:
    """Leaves that hold items (``leaf`` is the text ``true``)."""
    return quadtree.filter((F.col("leaf") == "true") & (F.col("nr_items").cast("long") > 0))


def export_index(quadtree: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Leaf tiles that have a directory, with the formats present there.

    ``files`` lists paths like ``…/tiles/<level>/<x>/<y>/<name>``; a tile without any file
    is left out. OBJ needs exactly three files.
    """
    leaves = leaf_tiles(quadtree).select(F.col("id").alias("tile_id"), "wkt")
    named = files.select(
        F.regexp_extract(path, r"tiles/(\d+/\d+/\d+)/[^/]+$", 1).alias("tile_id"),
        F.regexp_extract(path, r"([^/]+)$", 1).alias("_f"),
    ).filter("tile_id <> ''")
    stem = file_id("tile_id")
    found = named.groupBy("tile_id").agg(
        F.max(F.col("_f") == F.concat(stem, F.lit(".city.json"))).alias("has_cityjson"),
        F.max(F.col("_f") == F.concat(stem, F.lit(".gpkg"))).alias("has_gpkg"),
        (F.count_if(F.col("_f").endswith(".obj")) == 3).alias("has_obj"),
    )
    return leaves.join(found, "tile_id").select("tile_id", "has_cityjson", "has_gpkg", "has_obj", "wkt")


def distribution_tile_index(index: DataFrame) -> DataFrame:
    """Tiles with a CityJSON file, their polygon and box."""
    rings = index.filter("has_cityjson").withColumn("rings", G.from_wkt("wkt"))
    return G.with_bbox(rings).drop("wkt")


def cluster_by_location(df: DataFrame, n: int, cell: float = 50.0, x: str = "x0", y: str = "y0") -> DataFrame:
    """Rows near each other in space end up in the same file, files in Morton order; rows without a place last.

    Rows of one cell are told apart by their place within it, so that a crowded cell does not become one task.
    """
    df = df.withColumn("_m", F.coalesce(G.morton(x, y, cell), F.lit((1 << 63) - 1)))
    return df.repartitionByRange(n, "_m", x, y).sortWithinPartitions("_m", x, y).drop("_m")
