"""Valid polygons from rings that cross, touch or overlap themselves or each other.

The rings of a row are noded: every edge is cut where it meets another one, and pieces that lie on each
other an even number of times leave. Each piece that is left has the inside (even-odd rule) on exactly one
side, and is turned so that it is on the left. At a vertex the walk goes on with the first piece clockwise
from the one it came by, which keeps parts that meet in a point apart; a vertex met twice closes a ring.
Counter-clockwise rings are parts, clockwise ones the holes of the smallest part around them.

A row without any such place is left as it is. The others of an Arrow batch are noded together.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gevel.functions import geometry as G
from gevel.functions.kernels import Edges, _cross, _flat, _lengths, _row_pairs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: digits of the places where edges cross
DIGITS = 7
REPAIRED = T.StructType([T.StructField("parts", T.ArrayType(G.RINGS)), T.StructField("lines", T.BooleanType())])


def _touches(e: Edges, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where edges of one row meet other than in a shared end: edge, x and y of each cut, and the rows that need work."""
    edge, xs, ys, bad = [], [], [], np.zeros(n, bool)
    for i, j in _row_pairs(e.row, e.row, n):
        near = (
            (i < j)
            & (np.minimum(e.ax, e.bx)[i] <= np.maximum(e.ax, e.bx)[j]) & (np.minimum(e.ax, e.bx)[j] <= np.maximum(e.ax, e.bx)[i])
            & (np.minimum(e.ay, e.by)[i] <= np.maximum(e.ay, e.by)[j]) & (np.minimum(e.ay, e.by)[j] <= np.maximum(e.ay, e.by)[i])
        )
        i, j = i[near], j[near]
        p, q, r, s = (e.ax[i], e.ay[i]), (e.bx[i], e.by[i]), (e.ax[j], e.ay[j]), (e.bx[j], e.by[j])
        at_p, at_q, at_r, at_s = _cross(*r, *s, *p), _cross(*r, *s, *q), _cross(*p, *q, *r), _cross(*p, *q, *s)
        proper = (np.sign(at_p) * np.sign(at_q) < 0) & (np.sign(at_r) * np.sign(at_s) < 0)
        t = np.divide(at_p, at_p - at_q, out=np.zeros(len(i)), where=proper)
        x, y = np.round(p[0] + t * (q[0] - p[0]), DIGITS), np.round(p[1] + t * (q[1] - p[1]), DIGITS)
        for k in (i, j):
            edge.append(k[proper])
            xs.append(x[proper])
            ys.append(y[proper])
        bad[e.row[i[proper]]] = True
        for side, point, cut, (a, b) in ((at_p, p, j, (r, s)), (at_q, q, j, (r, s)), (at_r, r, i, (p, q)), (at_s, s, i, (p, q))):
            inside = (
                (side == 0)
                & (point[0] >= np.minimum(a[0], b[0])) & (point[0] <= np.maximum(a[0], b[0])) & (point[1] >= np.minimum(a[1], b[1])) & (point[1] <= np.maximum(a[1], b[1]))
                & ((point[0] != a[0]) | (point[1] != a[1])) & ((point[0] != b[0]) | (point[1] != b[1]))
            )
            edge.append(cut[inside])
            xs.append(point[0][inside])
            ys.append(point[1][inside])
            bad[e.row[i[inside]]] = True
        same = ((p[0] == r[0]) & (p[1] == r[1]) & (q[0] == s[0]) & (q[1] == s[1])) | ((p[0] == s[0]) & (p[1] == s[1]) & (q[0] == r[0]) & (q[1] == r[1]))
        bad[e.row[i[same]]] = True
    if not edge:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0), bad
    return np.concatenate(edge), np.concatenate(xs), np.concatenate(ys), bad


class Noded:
    """Pieces between vertices of the noded rows, the inside on their left; and rows with pieces that enclose nothing."""

    def __init__(self, e: Edges, n: int, edge: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        every = np.concatenate([np.arange(len(e.row)), np.arange(len(e.row)), edge])
        px, py = np.concatenate([e.ax, e.bx, x]), np.concatenate([e.ay, e.by, y])
        along = (px - e.ax[every]) * (e.bx - e.ax)[every] + (py - e.ay[every]) * (e.by - e.ay)[every]
        order = np.lexsort((along, every))
        every, px, py = every[order], px[order], py[order]
        spots, vertex = np.unique(np.stack([e.row[every].astype(float), px, py]), axis=1, return_inverse=True)
        vertex = vertex.ravel()
        self.row_of, self.x, self.y = spots[0].astype(np.int64), spots[1], spots[2]
        keep = (every[1:] == every[:-1]) & (vertex[1:] != vertex[:-1])
        ends = np.sort(np.stack([vertex[:-1][keep], vertex[1:][keep]]), axis=0)
        ends, times = np.unique(ends, axis=1, return_counts=True)
        a, b = ends[:, times % 2 == 1]
        # vertices are in order of row, x and y: the first end of a piece is its left or lower one
        self.a, self.b = a, b
        up = self._odd_beyond(a, b, n)
        upright = self.x[a] == self.x[b]
        turn = np.where(upright, up, ~up)  # the odd side of an upright piece is its right
        self.a, self.b = np.where(turn, b, a), np.where(turn, a, b)
        c, d = ends[:, times % 2 == 0]
        loose = ~self._odd_beyond(c, d, n)
        self.lines = np.zeros(n, bool)
        self.lines[self.row_of[c[loose]]] = True

    def _odd_beyond(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        """Whether the inside lies just above the middle of each piece, or just to the right of an upright one."""
        row, mx, my = self.row_of[a], (self.x[a] + self.x[b]) / 2, (self.y[a] + self.y[b]) / 2
        upright = self.x[a] == self.x[b]
        order = np.argsort(self.row_of[self.a], kind="stable")
        fa, fb = self.a[order], self.b[order]
        ax, ay, bx, by = self.x[fa], self.y[fa], self.x[fb], self.y[fb]
        mine = np.argsort(row, kind="stable")
        odd = np.zeros(len(a), np.int64)
        for i, j in _row_pairs(row[mine], self.row_of[fa], n):
            i = mine[i]
            with np.errstate(divide="ignore", invalid="ignore"):
                y = ay[j] + (mx[i] - ax[j]) * (by[j] - ay[j]) / (bx[j] - ax[j])
                x = ax[j] + (my[i] - ay[j]) * (bx[j] - ax[j]) / (by[j] - ay[j])
            above = ((ax[j] > mx[i]) != (bx[j] > mx[i])) & (y > my[i])
            right = ((ay[j] > my[i]) != (by[j] > my[i])) & (x > mx[i])
            own = (fa[j] == a[i]) & (fb[j] == b[i])
            np.add.at(odd, i, (np.where(upright[i], right, above) & ~own).astype(np.int64))
        return odd % 2 == 1

    def following(self) -> np.ndarray:
        """The piece after each piece; -1 where the pieces around a vertex do not take turns."""
        m = len(self.a)
        vertex = np.concatenate([self.a, self.b])
        other = np.concatenate([self.b, self.a])
        out = np.arange(2 * m) < m
        angle = np.arctan2(self.y[other] - self.y[vertex], self.x[other] - self.x[vertex])
        order = np.lexsort((angle, vertex))
        v = vertex[order]
        first = np.searchsorted(v, v)
        last = np.searchsorted(v, v, side="right") - 1
        place = np.arange(2 * m)
        before = order[np.where(place == first, last, place - 1)]
        coming = np.flatnonzero(~out[order])
        after = np.full(m, -1, np.int64)
        after[order[coming] - m] = np.where(out[before[coming]], before[coming], -1)
        return after


def _walk(noded: Noded) -> tuple[dict[int, list[np.ndarray]], set[int]]:
    """Simple rings, as vertices, of each row; and the rows that could not be walked."""
    after, start = noded.following().tolist(), noded.a.tolist()
    row_of = noded.row_of
    rings: dict[int, list[np.ndarray]] = {}
    failed = {int(row_of[start[i]]) for i, k in enumerate(after) if k < 0}
    seen = [False] * len(after)
    for first in range(len(after)):
        row = int(row_of[start[first]])
        if seen[first] or row in failed:
            continue
        path: list[int] = []
        place: dict[int, int] = {}
        now = first
        while not seen[now]:
            seen[now] = True
            v = start[now]
            if v in place:  # back at a vertex: what lies between is a ring
                at = place[v]
                rings.setdefault(row, []).append(np.array(path[at:]))
                for u in path[at:]:
                    del place[u]
                del path[at:]
            place[v] = len(path)
            path.append(v)
            now = after[now]
        rings.setdefault(row, []).append(np.array(path))
    return rings, failed


def _assemble(rings: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[list[np.ndarray]]:
    """Parts, the largest first, each with its outer ring and then its holes; rings start at their least vertex."""
    closed, areas = [], []
    for ring in rings:
        ring = np.roll(ring, -int(np.argmin(ring)))
        px, py = x[ring] - x[ring[0]], y[ring] - y[ring[0]]
        areas.append(float(np.sum(px * np.roll(py, -1) - np.roll(px, -1) * py)) / 2)
        closed.append(np.append(ring, ring[0]))
    outer = sorted((k for k, a in enumerate(areas) if a > 0), key=lambda k: (-areas[k], closed[k][0]))
    parts = {k: [closed[k]] for k in outer}
    for k in sorted((k for k, a in enumerate(areas) if a < 0), key=lambda k: closed[k][0]):
        u, v = closed[k][0], closed[k][1]
        mx, my = (x[u] + x[v]) / 2, (y[u] + y[v]) / 2
        for o in reversed(outer):  # the smallest part around the hole
            ax, ay, bx, by = x[closed[o][:-1]], y[closed[o][:-1]], x[closed[o][1:]], y[closed[o][1:]]
            spans = (ay > my) != (by > my)
            at = ax[spans] + (my - ay[spans]) * (bx - ax)[spans] / (by - ay)[spans]
            if np.count_nonzero(at > mx) % 2:
                parts[o].append(closed[k])
                break
    return [parts[k] for k in outer]


def repair_batch(rings) -> tuple[pa.Array, np.ndarray]:
    """Parts of each polygon, and whether something of no area was left over; a row that cannot be walked keeps no part."""
    rings = _flat(rings)
    n = len(rings)
    e = Edges.of(rings)
    edge, x, y, bad = _touches(e, n)
    work = bad | (_lengths(rings) > 1)
    starts, times = np.unique(np.stack([e.row.astype(float), e.ax, e.ay]), axis=1, return_counts=True)
    work[starts[0][times > 1].astype(np.int64)] = True  # a vertex met twice
    lines = np.zeros(n, bool)
    parts: dict[int, list[list[np.ndarray]]] = {}
    noded = None
    if work.any():
        number = np.cumsum(work[e.row]) - 1
        mine = work[e.row[edge]]
        noded = Noded(e.take(np.flatnonzero(work[e.row])), n, number[edge[mine]], x[mine], y[mine])
        found, failed = _walk(noded)
        parts = {row: _assemble(r, noded.x, noded.y) for row, r in found.items() if row not in failed}
        lines = noded.lines
        whole = np.bincount(e.row, minlength=n)
        for row in np.flatnonzero(work & ~bad):  # rings that meet in vertices at most: unchanged unless a part or a hole comes to light
            made = parts.get(int(row), [])
            if len(made) == 1 and sum(len(r) - 1 for r in made[0]) == whole[row] and len(made[0]) == len(rings[int(row)]):
                work[row] = False
    return _as_arrow(rings, work, parts, noded), lines


def _as_arrow(rings: pa.Array, work: np.ndarray, parts: dict, noded: Noded | None) -> pa.Array:
    """Repaired rows from ``parts``, the others as their own only part."""
    n = len(rings)
    made = [parts.get(int(row), []) for row in np.flatnonzero(work)]
    vertices = [r for row in made for part in row for r in part]
    flat = np.concatenate(vertices) if vertices else np.zeros(0, np.int64)
    x, y = (noded.x[flat], noded.y[flat]) if noded is not None else (np.zeros(0), np.zeros(0))
    points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
    ring = pa.ListArray.from_arrays(_offsets(map(len, vertices)), points)
    new = pa.ListArray.from_arrays(_offsets(len(part) for row in made for part in row), ring)
    count = np.ones(n, np.int64)
    count[work] = [len(row) for row in made]
    # a part of each unchanged row is that row; parts of the others follow in their order
    source = np.zeros(int(count.sum()), np.int64)
    owner = np.repeat(np.arange(n), count)
    source[~work[owner]] = owner[~work[owner]]
    source[work[owner]] = n + np.arange(int(work[owner].sum()))
    both = pa.concat_arrays([rings.cast(new.type), new])
    return pa.ListArray.from_arrays(_offsets(count), both.take(pa.array(source)))


def _offsets(sizes) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(np.fromiter(sizes, np.int64))]).astype(np.int32))


@F.arrow_udf(REPAIRED)
def _repaired(rings: pa.Array) -> pa.Array:
    parts, lines = repair_batch(rings)
    return pa.StructArray.from_arrays([parts, pa.array(lines)], ["parts", "lines"])


def repaired(rings: str, box: str) -> Column:
    """``parts``: the valid polygons of the same even-odd area, largest first; ``lines``: something of no area was left over.

    Rows marked by ``box`` are upright boxes, which need no test and do not go to Python. No rings, or rings
    without area, have no parts.
    """
    rings, box = F.col(rings), F.coalesce(F.col(box), F.lit(False))
    made = _repaired(F.when(box | rings.isNull(), G.no_rings()).otherwise(rings))
    return F.when(box, F.struct(F.array(rings).alias("parts"), F.lit(False).alias("lines"))).otherwise(
        F.struct(F.filter(made.parts, lambda p: F.size(p) > 0).alias("parts"), made.lines.alias("lines"))
    )


def repaired_type(made: Column | str) -> Column:
    """Geometry type of a repaired shape; areas with lines left over are a collection."""
    made = F.col(made) if isinstance(made, str) else made
    n = F.size(made["parts"])
    return F.when(made["lines"], F.when(n > 0, "GEOMETRYCOLLECTION").otherwise("MULTILINESTRING")).otherwise(G.geometry_type(made["parts"]))
