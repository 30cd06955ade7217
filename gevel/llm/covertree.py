"""Exact top-k by inner product with two cover trees, one of the queries and one of the data.

Vectors are dealt to the nearest of a few pivots and into blocks of bounded size; each block becomes a
tree whose nodes hold a centre and a covering radius. A pair of nodes is left out when no product
between their balls can reach the worst kth score of the node's queries. A first search in a block
nearby sets these scores; all other blocks are then searched unless the bound of their pivot rules
them out. For that, blocks of data lie on shelves: a task builds the trees of one shelf, and blocks of
queries pass by, one in memory at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gevel.functions.rows import by_merge, spread
from gevel.session import cut_lineage

FAN, SLACK = 12, 1e-6
SHELF_BYTES = 1 << 26  # of the points of a shelf, as doubles
DEAL = 64  # blocks of queries that pass by a shelf in one task, on average
HIT = "query_id long, vec_id long, score long"


class Tree:
    """A cover tree over the rows of ``points``: every child lies in its parent's ball, and centres are points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int) -> None:
        self.ids, self.points = ids, points
        order, self.start, self.end, self.radius, self.children, middle = [], [], [], [], [], []
        stack = [(np.arange(len(ids)), 0 if len(ids) else -1, -1)]
        while stack:
            rows, centre, parent = stack.pop()
            node = len(self.start)
            if parent >= 0:
                self.children[parent].append(node)
            gap = np.sqrt(((points[rows] - points[centre]) ** 2).sum(1))
            self.radius.append(float(gap.max(initial=0)))
            self.children.append([])
            middle.append(centre)
            self.start.append(len(order))
            self.end.append(len(order) + len(rows))
            if len(rows) <= leaf or self.radius[-1] == 0:
                order.extend(rows.tolist())
                continue
            # far points become centres of the next level until all lie within half the radius
            centres, near, whose = [centre], gap.copy(), np.zeros(len(rows), np.int64)
            while len(centres) < FAN and near.max() > self.radius[node] / 2:
                far = int(rows[int(near.argmax())])
                other = np.sqrt(((points[rows] - points[far]) ** 2).sum(1))
                whose[other < near] = len(centres)
                near = np.minimum(near, other)
                centres.append(far)
            parts = [(rows[whose == i], c, node) for i, c in enumerate(centres)]
            # depth first, so that a node's rows are in one piece
            stack.extend(reversed([p for p in parts if len(p[0])]))
        self.order = np.array(order, np.int64)
        self.ids, self.points = ids[self.order], points[self.order]
        self.centre = points[middle] if len(ids) else points[:0]
        self.length = np.sqrt((self.centre**2).sum(1))


def _pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` of the points, each far from those before it."""
    if not len(points):
        return points
    chosen, near = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


class Best:
    """The k best of each query so far, best first; ties go to the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None) -> None:
        self.score, self.id = np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max)
        self.floor = np.full(queries, -np.inf) if floor is None else floor

    def worst(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.floor)

    def add(self, rows: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        some = np.flatnonzero((scores >= self.worst()[rows, None]).any(0))
        if not len(some):
            return
        score = np.concatenate([self.score[rows], scores[:, some]], 1)
        every = np.concatenate([self.id[rows], np.broadcast_to(ids[some], (len(scores), len(some)))], 1)
        order = np.lexsort((every, -score))[:, :k]
        self.score[rows], self.id[rows] = np.take_along_axis(score, order, 1), np.take_along_axis(every, order, 1)


def search(queries: Tree, data: Tree, best: Best) -> None:
    """Goes through pairs of nodes, the most promising first, and prunes by the covering radii."""
    if not len(queries.ids) or not len(data.ids):
        return
    stack = [(0, 0)]
    while stack:
        q, d = stack.pop()
        rq, rd = queries.radius[q], data.radius[d]
        rows = slice(queries.start[q], queries.end[q])
        bound = queries.centre[q] @ data.centre[d] + rq * data.length[d] + rd * queries.length[q] + rq * rd
        if bound + SLACK * (1 + abs(bound)) < best.worst()[rows].min():
            continue
        below_q, below_d = queries.children[q], data.children[d]
        if not below_q and not below_d:
            part = slice(data.start[d], data.end[d])
            scores = queries.points[rows] @ data.points[part].T
            scores[queries.ids[rows, None] == data.ids[None, part]] = -np.inf
            best.add(rows, scores, data.ids[part])
            continue
        pairs = [(a, b) for a in (below_q or [q]) for b in (below_d or [d])]
        reach = [queries.centre[a] @ data.centre[b] for a, b in pairs]
        stack.extend(pairs[i] for i in np.argsort(reach))


def _number(most: float) -> str:
    """The shortest type that holds the numbers."""
    return "<i1" if most < 2**7 else "<i2" if most < 2**15 else "<i4"


def _tree_blocks(rows: DataFrame, name: str, count: Column, number: str) -> DataFrame:
    """Rows (name, centre, part, ids, points): one for each block of at most some rows of a pivot."""
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), count).cast("int"))

    def block(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table.column("vec_id")), kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        ids = np.asarray(table.column("vec_id")).astype("<i8")
        points = np.asarray(table.column("vector").combine_chunks().flatten()).astype(number)
        where = [[table.column("centre")[0].as_py()], [table.column("part")[0].as_py()]]
        return pa.Table.from_arrays([pa.array(where[0], pa.int32()), pa.array(where[1], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([points.tobytes()], pa.binary())], ["centre", "part", f"{name}_ids", f"{name}_points"])

    return dealt.groupBy("centre", "part").applyInArrow(block, f"centre int, part int, {name}_ids binary, {name}_points binary")


def _read(ids: pa.Scalar, points: pa.Scalar, number: str, leaf: int) -> Tree:
    ids = np.frombuffer(ids.as_buffer(), "<i8")
    return Tree(ids, np.frombuffer(points.as_buffer(), number).reshape(len(ids), -1).astype(np.float64), leaf)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    """The rows of batches; a block is not copied before it is read."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, pivots: int = 32, sample: int = 1024, block: int = 4096, group: int = 512, leaf: tuple[int, int] = (64, 256)) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of every query.

    ``vectors`` has vec_id and vector (whole numbers, each below 2**31, scores below 2**53). Pivots are
    taken from the ``sample`` vectors with the smallest hashes; every vector is in a block and every
    block is searched or ruled out by its bound. Rows with a null id or a null number take no part, a
    repeated row counts once, a shorter vector ends in zeros. Rows of the query's own id are not its
    candidates. Larger numbers or scores raise ValueError.
    """
    spark = vectors.sparkSession
    good = vectors.where("vec_id IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)").select(F.col("vec_id").cast("long").alias("vec_id"), "vector", F.coalesce(is_query, F.lit(False)).alias("is_query"))
    good = good.dropDuplicates(["vec_id", "vector"])
    size = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    width, most, longest, asks = good.agg(F.max(F.size("vector")), F.max(size), F.max(norm), F.max(F.when(F.col("is_query"), norm))).first()
    if (most or 0) >= 2**31 or (longest or 0) * (asks or 0) >= 2**53:
        raise ValueError(f"vectors are too large to score exactly: a number of {most:.0f}, scores up to {(longest or 0) * (asks or 0):.3g}")
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    drawn = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").collect()
    wide = lambda values: np.array([[*v, *[0] * (width - len(v))] for v in values], float).reshape(-1, width)

    def matrix(vectors: pa.ListArray) -> np.ndarray:
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        out = np.zeros((len(vectors), width))
        out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        return out

    centres = _pivots(wide([r[0] for r in drawn]), pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch.column("vector"))
            gap = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None]
            mine = gap.argmin(1)
            far = np.sqrt(((points - centres[mine]) ** 2).sum(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, points.size + 1, width), pa.int32()), pa.array(points.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("is_query"), flat, pa.array(mine, pa.int32()), pa.array(far)], ["vec_id", "is_query", "vector", "centre", "gap"])

    placed = cut_lineage(good.mapInArrow(assign, "vec_id long, is_query boolean, vector array<int>, centre int, gap double"))
    known = placed.groupBy("centre").agg(F.count("*").alias("n"), F.max("gap").alias("far"), F.sum(F.col("is_query").cast("int")).alias("q")).collect()  # a row for each pivot
    parts = {r["centre"]: -(-r["n"] // block) for r in known}
    groups = {r["centre"]: max(1, -(-r["q"] // group)) for r in known}
    far = {r["centre"]: r["far"] for r in known}

    def count_of(counts: dict[int, int]) -> Column:
        return F.element_at(F.array(*(F.lit(counts.get(c, 1)) for c in range(len(centres)))), F.col("centre") + 1)

    number = _number(most)
    data = cut_lineage(_tree_blocks(placed, "data", count_of(parts), number))
    asked = _tree_blocks(placed.where("is_query"), "query", count_of(groups), number).withColumnRenamed("part", "group")
    near = asked.withColumn("part", F.pmod("group", count_of(parts)).cast("int")).join(by_merge(data), ["centre", "part"], "left")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            queries = _read(row["query_ids"], row["query_points"], number, leaf[0])
            best = Best(len(queries.ids), k)
            if row["data_ids"].is_valid:
                search(queries, _read(row["data_ids"], row["data_points"], number, leaf[1]), best)
            floor = np.empty(len(queries.ids))
            floor[queries.order] = best.worst()
            yield pa.RecordBatch.from_pylist(
                [{**{c: row[c].as_py() for c in ("centre", "part", "group", "query_ids", "query_points")}, "floor": floor.tobytes(), "hits": _hits(queries, best)}], schema=FIRST
            )

    found = cut_lineage(near.mapInArrow(first, "centre int, part int, group int, query_ids binary, query_points binary, floor binary, hits array<struct<query_id: long, vec_id: long, score: long>>"))
    # blocks in the order of pivots, so that those of a shelf lie near each other; a small table has a block on each shelf
    before = {c: sum(n for other, n in parts.items() if other < c) for c in parts}
    per = max(1, min(sum(parts.values()) // 32, SHELF_BYTES // (block * width * 8)))
    deals = -(-sum(groups.values()) // DEAL)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The query block once for each shelf with a data block that its worst kth score does not rule out."""
        for row in _rows(batches):
            queries = _read(row["query_ids"], row["query_points"], number, leaf[0])
            floor = row["floor"].as_py()
            least, shelves, own = np.frombuffer(floor, np.float64).min(), set(), before[row["centre"].as_py()] + row["part"].as_py()
            for c, blocks in parts.items():
                bound = queries.centre[0] @ centres[c] + queries.radius[0] * (np.sqrt((centres[c] ** 2).sum()) + far[c]) + far[c] * queries.length[0]
                if bound + SLACK * (1 + abs(bound)) >= least:
                    shelves.update(at // per for at in range(before[c], before[c] + blocks) if at != own)
            deal = zlib.crc32(row["query_ids"].as_buffer()) % deals
            for shelf in sorted(shelves):
                visit = {"shelf": shelf, "deal": deal, "asks": True, "at": own, "ids": row["query_ids"].as_py(), "points": row["query_points"].as_py(), "floor": floor}
                yield pa.RecordBatch.from_pylist([visit], schema=VISITS)

    visits = found.select("centre", "part", "query_ids", "query_points", "floor").mapInArrow(others, VISIT)
    at = (count_of(before) + F.col("part")).cast("int")
    laid = data.select(
        F.floor(at / per).cast("int").alias("shelf"), F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"), F.lit(False).alias("asks"), at.alias("at"),
        F.col("data_ids").alias("ids"), F.col("data_points").alias("points"), F.lit(None).cast("binary").alias("floor"),
    )
    met = spread(laid.unionByName(visits), "shelf", "deal").sortWithinPartitions("shelf", "deal", "asks")

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, trees = None, []
        for row in _rows(batches):
            here = row["shelf"].as_py(), row["deal"].as_py()
            if here != place:
                place, trees = here, []
            if not row["asks"].as_py():
                trees.append((row["at"].as_py(), _read(row["ids"], row["points"], number, leaf[1])))
                continue
            queries = _read(row["ids"], row["points"], number, leaf[0])
            best = Best(len(queries.ids), k, np.frombuffer(row["floor"].as_py(), np.float64)[queries.order])
            for own, tree in sorted(trees, key=lambda t: -(queries.centre[0] @ t[1].centre[0])):
                if own != row["at"].as_py():
                    search(queries, tree, best)
            yield pa.RecordBatch.from_pylist(_hits(queries, best), schema=HITS)

    rest = met.mapInArrow(second, HIT)
    every = found.select(F.inline("hits")).unionByName(rest)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
FIRST = pa.schema([("centre", pa.int32()), ("part", pa.int32()), ("group", pa.int32()), ("query_ids", pa.binary()), ("query_points", pa.binary()), ("floor", pa.binary()), ("hits", pa.list_(pa.struct(HITS)))])
VISIT = "shelf int, deal int, asks boolean, at int, ids binary, points binary, floor binary"
VISITS = pa.schema([("shelf", pa.int32()), ("deal", pa.int32()), ("asks", pa.bool_()), ("at", pa.int32()), ("ids", pa.binary()), ("points", pa.binary()), ("floor", pa.binary())])


def _hits(queries: Tree, best: Best) -> list[dict]:
    row, column = np.nonzero(np.isfinite(best.score) & (best.score >= best.floor[:, None]))
    return [{"query_id": q, "vec_id": v, "score": int(s)} for q, v, s in zip(queries.ids[row].tolist(), best.id[row, column].tolist(), best.score[row, column].tolist(), strict=True)]
