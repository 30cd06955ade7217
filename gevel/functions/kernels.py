"""Exact polygon work on Arrow batches.

Spark partitions and shuffles the rows; each function sees one Arrow batch and treats
all polygons of the batch in the same numpy calls.

The overlap area uses slabs: cut the plane at every vertex and every edge crossing.
Inside one slab no two edges cross, so the edges are ordered by height and the covered
part is read off with two running counts (inside the subject, inside any neighbour).
Union semantics and holes (even-odd rule) need no overlay geometry.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gevel.functions.geometry import RINGS

# Workers get these functions with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIR_BLOCK = 2_000_000


def _flat(arr) -> pa.Array:
    return arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr


def _lengths(arr: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64)


class Edges:
    """All edges of a column of polygons, with the row each belongs to."""

    def __init__(self, row, ax, ay, bx, by):
        self.row, self.ax, self.ay, self.bx, self.by = row, ax, ay, bx, by

    @staticmethod
    def of(rings) -> Edges:
        rings = _flat(rings)
        e = Edges.of_rings(rings.flatten())
        return Edges(np.repeat(np.arange(len(rings)), _lengths(rings))[e.row], e.ax, e.ay, e.bx, e.by)

    @staticmethod
    def of_rings(rings) -> Edges:
        per_ring = _lengths(rings)
        pts = rings.flatten()
        x = pc.struct_field(pts, "x").to_numpy(zero_copy_only=False).astype(float)
        y = pc.struct_field(pts, "y").to_numpy(zero_copy_only=False).astype(float)
        start = np.cumsum(per_ring) - per_ring
        ring = np.repeat(np.arange(len(per_ring)), per_ring)
        nxt = np.arange(len(x)) + 1
        last = (start + per_ring - 1)[per_ring > 0]
        nxt[last] = start[per_ring > 0]
        keep = (x != x[nxt]) | (y != y[nxt])
        return Edges(ring[keep], x[keep], y[keep], x[nxt][keep], y[nxt][keep])

    def take(self, keep) -> Edges:
        return Edges(*(v[keep] for v in (self.row, self.ax, self.ay, self.bx, self.by)))


def _row_pairs(left_row, right_row, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with equal row, in blocks; both inputs are sorted by row."""
    count = np.bincount(right_row, minlength=n)
    first = np.cumsum(count) - count
    width = count[left_row]
    total = np.cumsum(width)
    lo = 0
    while lo < len(left_row):
        base = total[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(total, base + PAIR_BLOCK, side="right")), lo + 1)
        w = width[lo:hi]
        i = np.repeat(np.arange(lo, hi), w)
        j = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w) + first[left_row[i]]
        yield i, j
        lo = hi


def _cross(ox, oy, px, py, qx, qy):
    return (px - ox) * (qy - oy) - (qx - ox) * (py - oy)


def _points_inside(x, y, has, e: Edges, n: int) -> np.ndarray:
    """Even-odd test of one point per row against that row's edges."""
    px, py = x[e.row], y[e.row]
    spans = (e.ay > py) != (e.by > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = e.ax + (py - e.ay) * (e.bx - e.ax) / (e.by - e.ay)
    hits = np.bincount(e.row[spans & (px < at)], minlength=n)
    return (hits % 2 == 1) & has


def _first_point(e: Edges, n: int):
    x, y, has = np.zeros(n), np.zeros(n), np.zeros(n, bool)
    x[e.row[::-1]], y[e.row[::-1]], has[e.row] = e.ax[::-1], e.ay[::-1], True
    return x, y, has


def intersects_batch(left, right) -> np.ndarray:
    """Row-wise closed intersection of two polygon columns (touching counts)."""
    n = len(left)
    a, b = Edges.of(left), Edges.of(right)
    hit = np.zeros(n, bool)
    for i, j in _row_pairs(a.row, b.row, n):
        near = (
            (np.minimum(a.ax, a.bx)[i] <= np.maximum(b.ax, b.bx)[j])
            & (np.minimum(b.ax, b.bx)[j] <= np.maximum(a.ax, a.bx)[i])
            & (np.minimum(a.ay, a.by)[i] <= np.maximum(b.ay, b.by)[j])
            & (np.minimum(b.ay, b.by)[j] <= np.maximum(a.ay, a.by)[i])
        )
        i, j = i[near], j[near]
        p, q, r, s = (a.ax[i], a.ay[i]), (a.bx[i], a.by[i]), (b.ax[j], b.ay[j]), (b.bx[j], b.by[j])
        ok = (_cross(*r, *s, *p) * _cross(*r, *s, *q) <= 0) & (
            _cross(*p, *q, *r) * _cross(*p, *q, *s) <= 0
        )
        hit[a.row[i[ok]]] = True
    hit |= _points_inside(*_first_point(a, n), b, n)
    hit |= _points_inside(*_first_point(b, n), a, n)
    return hit


def meets_edges_batch(rings, edges) -> np.ndarray:
    """Rows whose polygon meets one of the row's edges, or holds one; touching counts."""
    n = len(rings)
    a = Edges.of(rings)
    edges = _flat(edges)
    flat = edges.flatten()
    b = Edges(
        np.repeat(np.arange(n), _lengths(edges)),
        *(pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(float) for c in ("ax", "ay", "bx", "by")),
    )
    hit = np.zeros(n, bool)
    inside = np.zeros(len(b.row), np.int64)
    for i, j in _row_pairs(a.row, b.row, n):
        p, q, r, s = (a.ax[i], a.ay[i]), (a.bx[i], a.by[i]), (b.ax[j], b.ay[j]), (b.bx[j], b.by[j])
        near = np.ones(len(i), bool)
        for k in (0, 1):
            near &= (np.minimum(p[k], q[k]) <= np.maximum(r[k], s[k])) & (np.minimum(r[k], s[k]) <= np.maximum(p[k], q[k]))
        ok = near & (_cross(*r, *s, *p) * _cross(*r, *s, *q) <= 0) & (_cross(*p, *q, *r) * _cross(*p, *q, *s) <= 0)
        hit[a.row[i[ok]]] = True
        spans = (p[1] > r[1]) != (q[1] > r[1])
        with np.errstate(divide="ignore", invalid="ignore"):
            at = p[0] + (r[1] - p[1]) * (q[0] - p[0]) / (q[1] - p[1])
        np.add.at(inside, j, spans & (r[0] < at))
    hit[b.row[inside % 2 == 1]] = True
    return hit


def _crossings(e: Edges, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and x of proper crossings between non-vertical edges of the same row."""
    sloped = np.bincount(e.row[e.ay != e.by], minlength=n) > 0
    idx = np.flatnonzero(sloped[e.row])
    rows, xs = [], []
    if len(idx):
        s = e.take(idx)
        k = (s.by - s.ay) / (s.bx - s.ax)
        ylo, yhi = np.minimum(s.ay, s.by), np.maximum(s.ay, s.by)
        for i, j in _row_pairs(s.row, s.row, n):
            keep = (
                (i < j)
                & (s.ax[i] < s.bx[j])
                & (s.ax[j] < s.bx[i])
                & (ylo[i] <= yhi[j])
                & (ylo[j] <= yhi[i])
                & (k[i] != k[j])
            )
            i, j = i[keep], j[keep]
            x = ((s.ay[j] - k[j] * s.ax[j]) - (s.ay[i] - k[i] * s.ax[i])) / (k[i] - k[j])
            ok = (x > np.maximum(s.ax[i], s.ax[j])) & (x < np.minimum(s.bx[i], s.bx[j]))
            rows.append(s.row[i[ok]])
            xs.append(x[ok])
    if not rows:
        return np.empty(0, np.int64), np.empty(0)
    return np.concatenate(rows), np.concatenate(xs)


def covered_area_batch(subject, others, frame=None) -> np.ndarray:
    """Area of ``subject ∩ (∪ others)``, inside ``frame`` where one is given.

    subject: rings per row; others: list of rings per row; frame: rings per row, empty
    where the whole subject counts.
    """
    n = len(subject)
    s = Edges.of(subject)
    others = _flat(others)
    other_row = np.repeat(np.arange(n), _lengths(others))
    o = Edges.of(others.flatten())
    sets = [(s.row, s.row, s, 0), (other_row[o.row] if len(o.row) else o.row, n + o.row, o, 1)]
    framed = np.zeros(n, bool)
    if frame is not None:
        f = Edges.of(frame)
        framed[f.row] = True
        sets.append((f.row, n + len(other_row) + f.row, f, 2))
    row = np.concatenate([g for g, _, _, _ in sets])
    poly = np.concatenate([p for _, p, _, _ in sets])
    kind = np.concatenate([np.full(len(g), k) for g, _, _, k in sets])
    ax, ay, bx, by = (
        np.concatenate([getattr(e, c) for _, _, e, _ in sets]) for c in ("ax", "ay", "bx", "by")
    )
    lo, hi = np.full(n, np.inf), np.full(n, -np.inf)
    np.minimum.at(lo, s.row, np.minimum(s.ax, s.bx))
    np.maximum.at(hi, s.row, np.maximum(s.ax, s.bx))

    flip = ax > bx
    ax, bx = np.where(flip, bx, ax), np.where(flip, ax, bx)
    ay, by = np.where(flip, by, ay), np.where(flip, ay, by)
    keep = (ax < bx) & (bx > lo[row]) & (ax < hi[row])
    order = np.argsort(row[keep], kind="stable")
    row, poly, kind, ax, ay, bx, by = (
        v[keep][order] for v in (row, poly, kind, ax, ay, bx, by)
    )
    if not len(row):
        return np.zeros(n)
    e = Edges(row, ax, ay, bx, by)
    cross_row, cross_x = _crossings(e, n)
    inner = (cross_x > lo[cross_row]) & (cross_x < hi[cross_row])

    cut_row = np.concatenate([row, row, cross_row[inner]])
    cut_x = np.concatenate([np.maximum(ax, lo[row]), np.minimum(bx, hi[row]), cross_x[inner]])
    order = np.lexsort((cut_x, cut_row))
    r, x = cut_row[order], cut_x[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    place = np.empty(len(r), np.int64)
    place[order] = np.cumsum(new) - 1
    cuts = x[new]
    first, last = place[: len(row)], place[len(row) : 2 * len(row)]

    width = last - first
    edge = np.repeat(np.arange(len(row)), width)
    slab = np.arange(len(edge)) - np.repeat(np.cumsum(width) - width, width) + first[edge]
    mid = 0.5 * (cuts[slab] + cuts[slab + 1])
    y = ay[edge] + (mid - ax[edge]) * (by[edge] - ay[edge]) / (bx[edge] - ax[edge])

    order = np.lexsort((y, poly[edge], slab))
    p, q = poly[edge[order]], slab[order]
    head = np.ones(len(p), bool)
    head[1:] = (p[1:] != p[:-1]) | (q[1:] != q[:-1])
    at = np.arange(len(p))
    rank = at - np.maximum.accumulate(np.where(head, at, 0))
    step = np.empty(len(p), np.int64)
    step[order] = np.where(rank % 2 == 0, 1, -1)

    order = np.lexsort((-step, y, slab))
    edge, slab, y, step = edge[order], slab[order], y[order], step[order]
    inside = [np.cumsum(np.where(kind[edge] == k, step, 0)) for k in (0, 1, 2)]
    ok = (inside[0] > 0) & (inside[1] > 0) & ((inside[2] > 0) | ~framed[row[edge]])
    ok[:-1] &= slab[1:] == slab[:-1]
    ok[-1] = False
    i = np.flatnonzero(ok)
    part = (y[i + 1] - y[i]) * (cuts[slab[i] + 1] - cuts[slab[i]])
    return np.bincount(row[edge[i]], weights=part, minlength=n)


def simple_batch(rings) -> np.ndarray:
    """True where no two edges of a polygon cross or overlap properly (validity flag)."""
    n = len(rings)
    e = Edges.of(rings)
    bad = np.zeros(n, bool)
    for i, j in _row_pairs(e.row, e.row, n):
        keep = i < j
        i, j = i[keep], j[keep]
        p, q, r, s = (e.ax[i], e.ay[i]), (e.bx[i], e.by[i]), (e.ax[j], e.ay[j]), (e.bx[j], e.by[j])
        ok = (_cross(*r, *s, *p) * _cross(*r, *s, *q) < 0) & (
            _cross(*p, *q, *r) * _cross(*p, *q, *s) < 0
        )
        bad[e.row[i[ok]]] = True
    return ~bad


def mitre_batch(rings, distance: float, limit: float = 5.0) -> pa.Array:
    """Grow polygons by ``distance`` with mitred corners; holes shrink.

    A corner whose mitre would reach further than ``limit`` distances is cut off there.
    """
    rings = _flat(rings)
    per_row = _lengths(rings)
    e = Edges.of_rings(rings.flatten())
    n_rings = int(per_row.sum())
    count = np.bincount(e.row, minlength=n_rings)
    start = np.cumsum(count) - count
    hole = np.arange(n_rings) != np.repeat(np.cumsum(per_row) - per_row, per_row)
    twice = np.bincount(e.row, weights=e.ax * e.by - e.bx * e.ay, minlength=n_rings)
    side = np.where((twice > 0) != hole, 1.0, -1.0)[e.row] * distance
    length = np.hypot(e.bx - e.ax, e.by - e.ay)
    dx, dy = (e.bx - e.ax) / length, (e.by - e.ay) / length
    nx, ny = dy, -dx
    prev = np.arange(len(e.row)) - 1
    prev[start[count > 0]] = (start + count - 1)[count > 0]
    sx, sy = nx + nx[prev], ny + ny[prev]
    size = sx * sx + sy * sy
    with np.errstate(divide="ignore", invalid="ignore"):
        reach = 2.0 / np.sqrt(size)
        mx, my = 2 * sx / size, 2 * sy / size
        ux, uy = sx / np.sqrt(size), sy / np.sqrt(size)
        along = (limit - np.sqrt(size) / 2) / (dx[prev] * ux + dy[prev] * uy)
    outward = (dx[prev] * dy - dy[prev] * dx) * side > 0
    sharp = outward & ~(reach <= limit)
    flat_turn = sharp & (size < 1e-18)
    ux, uy = np.where(flat_turn, dx[prev], ux), np.where(flat_turn, dy[prev], uy)
    along = np.where(flat_turn, limit, along)
    ok = size >= 1e-18
    mx, my = np.where(ok, mx, nx), np.where(ok, my, ny)
    x1 = np.where(sharp, e.ax + side * nx[prev] + np.abs(side) * along * dx[prev], e.ax + side * mx)
    y1 = np.where(sharp, e.ay + side * ny[prev] + np.abs(side) * along * dy[prev], e.ay + side * my)
    x2 = e.ax + side * nx - np.abs(side) * along * dx
    y2 = e.ay + side * ny - np.abs(side) * along * dy

    made = np.where(sharp, 2, 1)
    total = np.bincount(e.row, weights=made, minlength=n_rings).astype(np.int64)
    out_start = np.cumsum(total + (total > 0)) - (total + (total > 0))
    pos = np.cumsum(made) - made
    pos = pos - np.repeat(pos[start[count > 0]], count[count > 0]) + out_start[e.row]
    x, y = np.zeros(int((total + (total > 0)).sum())), np.zeros(int((total + (total > 0)).sum()))
    x[pos], y[pos] = x1, y1
    x[pos[sharp] + 1], y[pos[sharp] + 1] = x2[sharp], y2[sharp]
    live = total > 0
    x[(out_start + total)[live]], y[(out_start + total)[live]] = x[out_start[live]], y[out_start[live]]
    pts = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
    ring_off = np.append(out_start, len(x)).astype(np.int32)
    row_off = np.append(0, np.cumsum(per_row)).astype(np.int32)
    return pa.ListArray.from_arrays(row_off, pa.ListArray.from_arrays(ring_off, pts))


def _kept_vertices(x: np.ndarray, y: np.ndarray, tolerance: float) -> int:
    """Douglas–Peucker on one closed ring; at least four vertices stay."""
    stack, kept = [(0, len(x) - 1)], 2
    while stack:
        i, j = stack.pop()
        if j - i < 2:
            continue
        px, py = x[i + 1 : j] - x[i], y[i + 1 : j] - y[i]
        dx, dy = x[j] - x[i], y[j] - y[i]
        sq = dx * dx + dy * dy
        t = np.clip((px * dx + py * dy) / sq, 0, 1) if sq > 0 else np.zeros(len(px))
        d = np.hypot(px - t * dx, py - t * dy)
        k = int(np.argmax(d))
        if d[k] > tolerance:
            kept += 1
            stack += [(i, i + 1 + k), (i + 1 + k, j)]
    return max(kept, min(4, len(x)))


def simplified_count_batch(rings, tolerance: float) -> np.ndarray:
    rings = _flat(rings)
    per_row = _lengths(rings)
    flat = rings.flatten()
    per_ring = _lengths(flat)
    pts = flat.flatten()
    x = pc.struct_field(pts, "x").to_numpy(zero_copy_only=False).astype(float)
    y = pc.struct_field(pts, "y").to_numpy(zero_copy_only=False).astype(float)
    ends = np.cumsum(per_ring)
    kept = np.array(
        [_kept_vertices(x[b - k : b], y[b - k : b], tolerance) if k > 4 else k for b, k in zip(ends, per_ring)],
        dtype=float,
    )
    row = np.repeat(np.arange(len(rings)), per_row)
    return np.bincount(row, weights=kept, minlength=len(rings)).astype(np.int64)


# --- Spark functions ------------------------------------------------------------------

@F.arrow_udf(T.BooleanType())
def polygons_intersect(left: pa.Array, right: pa.Array) -> pa.Array:
    """Closed intersection; rows where both sides are empty count as already decided."""
    decided = (_lengths(left) == 0) & (_lengths(right) == 0)
    if decided.all():
        return pa.array(decided)
    return pa.array(decided | intersects_batch(left, right))


@F.arrow_udf(T.BooleanType())
def polygon_meets_edges(rings: pa.Array, edges: pa.Array) -> pa.Array:
    """Whether a polygon meets one of the edges beside it; never where either side is empty."""
    if not len(_flat(rings).flatten()):
        return pa.array(np.zeros(len(rings), bool))
    return pa.array(meets_edges_batch(rings, edges))


@F.arrow_udf(T.DoubleType())
def shared_area(left: pa.Array, right: pa.Array) -> pa.Array:
    """Area of the intersection of two polygons."""
    right = _flat(right)
    one = pa.ListArray.from_arrays(pa.array(np.arange(len(right) + 1, dtype=np.int32)), right)
    return pa.array(covered_area_batch(left, one))


@F.arrow_udf(T.DoubleType())
def covered_area(subject: pa.Array, others: pa.Array, frame: pa.Array) -> pa.Array:
    """Area of the subject covered by the union of the others, inside the frame."""
    return pa.array(covered_area_batch(subject, others, frame))


@F.arrow_udf(T.BooleanType())
def is_simple(rings: pa.Array) -> pa.Array:
    return pa.array(simple_batch(rings))


def mitre_buffer(rings, distance: float):
    @F.arrow_udf(RINGS)
    def grow(col: pa.Array) -> pa.Array:
        return mitre_batch(col, distance)

    return grow(rings)


def simplified_count(rings, tolerance: float):
    @F.arrow_udf(T.IntegerType())
    def count(col: pa.Array) -> pa.Array:
        return pa.array(simplified_count_batch(col, tolerance).astype(np.int32))

    return count(rings)
