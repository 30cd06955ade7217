"""SimHash fingerprints, and all pairs within a few bits by the generalised pigeonhole principle.

Fingerprints are cut into partitions of bits that go together. Two fingerprints at most ``tau`` bits
apart differ by at most t_i bits in some partition i, for any thresholds t_i >= -1 that add up to
``tau`` less the number of partitions plus 1. Number of partitions and thresholds are chosen by
dynamic programming on estimated numbers of probes and candidates.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.llm.arrays import LOWER, SpanHash, mix, owner, per_piece, spans, text_bytes
from gevel.llm.components import components
from gevel.session import cut_lineage

WIDTH = 64
#: signature rows that a task compares at a time, and rows of one signature above which it is split into blocks
AT_ONCE, SPLIT = 50_000, 2048
#: share of pairs of just the wanted similarity that may have no part of their prints in common
LOST = 5e-5
#: links that a task holds before it puts stars in place of those of a crowd
LINKS = 1 << 20
#: more rows linked in one group are a crowd, whose rows are compared in blocks of whole shingle sets instead of pair by pair
SMALL = 8
#: rows and bytes of sets of a block, and how members are counted in it
BLOCK, BLOCK_BYTES, FEW, SLICE = 1024, 16 << 20, 24, 4096
#: the first prints go with each signature and tell unlike pairs
SKETCH = ("sketch_1", "sketch_2")
#: as many bits, in rows of 2^9 words of 64, say ahead of the shuffle whose texts are asked for
ASKED_BITS = 25
#: what the set of a node is asked for: first or second of a pair, member of a crowd
FIRST, SECOND, MEMBER = 1, 2, 4
_CODE = np.arange(256)
WORD = ~((_CODE == 32) | ((_CODE >= 9) & (_CODE <= 13)))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, repeats included, and the bounds of the rows.

    A text of fewer words is one shingle; one without words has none.
    """
    low = LOWER[data]
    starts, ends, first = spans(WORD[low], offsets)
    keep = WORD[low]
    inner = np.ones(len(starts), bool)
    inner[first[1:][first[1:] > first[:-1]] - 1] = False
    low[ends[inner]] = 32
    keep[ends[inner]] = True
    place = np.cumsum(keep)
    begin, end = place[starts] - 1, place[ends - 1] if len(ends) else ends
    count = np.diff(first)
    shingles = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    at = np.repeat(first[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
    upto = np.minimum(at + words, np.repeat(first[1:], shingles)) - 1
    text, digest = low[keep].tobytes(), xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], seed) for a, b in zip(begin[at].tolist(), end[upto].tolist(), strict=True)]
    return np.array(hashes, np.uint64), bounds


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fingerprint of each row: the bits set in over half of its hashes.

    Eight bits of a hash at a time are added up in the eight bytes of a word, over at most 255 hashes.
    """
    out = np.zeros(len(bounds) - 1, np.int64)
    some = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(some):
        size = np.diff(bounds)[some]
        runs = -(-size // 255)
        first = np.cumsum(runs) - runs
        starts = np.repeat(bounds[some] - 255 * first, runs) + 255 * np.arange(runs.sum())
        ones = np.empty((len(starts), 8, 8), np.int64)
        for b in range(8):
            bytes_ = np.add.reduceat((hashes >> np.uint64(b)) & np.uint64(0x0101010101010101), starts)
            ones[:, :, b] = bytes_.astype("<u8").view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(ones.reshape(-1, WIDTH), first, axis=0)
        out[some] = np.packbits((2 * ones > size[:, None]).astype(np.uint8), axis=1, bitorder="little").view("<i8").ravel()
    return out


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and 64-bit fingerprint of every row; null texts and texts without words have fingerprint 0.

    Whole texts are read; a null doc_id stays null; repeated rows are rows of their own; an empty table gives none.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(piece.column("text"))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(majority(*shingle_hashes(data, offsets, words, seed)))], ["doc_id", "fingerprint"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(per_piece(work), "doc_id long, fingerprint long")


@dataclass
class Plan:
    parts: list[list[int]]
    thresholds: list[int]


def partitions(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Bits grouped so that those that go together share a partition."""
    n = bits.shape[1]
    centred = bits - bits.mean(0)
    spread = np.sqrt((centred**2).sum(0)) + 1e-9
    likeness = np.abs(centred.T @ centred) / np.outer(spread, spread)
    left, out = list(range(n)), []
    for k in range(parts):
        size = n // parts + (k < n % parts)
        group = [left.pop(0)]
        while len(group) < size:
            best = max(left, key=lambda b: (likeness[b, group].sum(), -b))
            left.remove(best)
            group.append(best)
        out.append(sorted(group))
    return out


def plan(sample: np.ndarray, count: int, tau: int, probe_cost: float = 60.0) -> Plan:
    """The cheapest partitions and thresholds for ``count`` fingerprints, judged by a sample of them.

    A probe row costs as much as ``probe_cost`` comparisons. The share of candidates is the larger of
    that among pairs of the sample and that of independent bits.
    """
    bits = ((sample[:, None] >> np.arange(WIDTH)) & 1).astype(float) if len(sample) else np.zeros((2, WIDTH))
    one = np.clip(bits.mean(0), 0.02, 0.98)
    agree = one**2 + (1 - one) ** 2
    best: tuple[float, Plan] | None = None
    pairs = np.random.default_rng(3).integers(0, len(bits), (2, 200_000))
    apart = bits[pairs[0]] != bits[pairs[1]]
    apart = apart[pairs[0] != pairs[1]]
    for m in range(1, tau + 2):
        groups, budget = partitions(bits, m), tau - m + 1
        cost = np.zeros((m, budget + 1))
        for i, group in enumerate(groups):
            spread = np.array([1.0])
            for b in group:
                spread = np.convolve(spread, [agree[b], 1 - agree[b]])
            seen = np.bincount(apart[:, group].sum(1), minlength=len(group) + 1) / max(1, len(apart))
            for t in range(budget + 1):
                share = max(spread[: t + 1].sum(), seen[: t + 1].sum() if len(apart) else 0)
                rows = sum(comb(len(group), d) for d in range(t + 1))
                cost[i, t] = count * rows * probe_cost + count * float(count) / 2 * share
        # thresholds: cheapest way to spend the budget on the partitions up to i
        spent = {0: (0.0, [])}
        for i in range(m):
            after: dict[int, tuple[float, list[int]]] = {}
            for used, (c, ts) in spent.items():
                for t in range(budget - used + 1):
                    found = (c + cost[i, t], [*ts, t])
                    if used + t not in after or found[0] < after[used + t][0]:
                        after[used + t] = found
            spent = after
        total, thresholds = spent[budget]
        if best is None or total < best[0]:
            best = (total, Plan(groups, thresholds))
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << WIDTH) if mask >> (WIDTH - 1) else mask


def _masks(group: list[int], radius: int) -> list[int]:
    """Every way to flip at most ``radius`` of the bits, as signed 64-bit masks."""
    out = []
    for d in range(radius + 1):
        for flips in combinations(group, d):
            out.append(_signed(sum(1 << b for b in flips)))
    return out


def signatures(prints: DataFrame, chosen: Plan) -> DataFrame:
    """A row for each partition and each value within its threshold."""
    def signature(i: int, flip: int):
        kept = F.col("fingerprint").bitwiseAND(F.lit(_signed(sum(1 << b for b in chosen.parts[i]))).cast("long"))
        return F.struct(F.lit(i).alias("part"), kept.bitwiseXOR(F.lit(flip).cast("long")).alias("value"))

    rows = [signature(i, flip) for i, radius in enumerate(chosen.thresholds) for flip in _masks(chosen.parts[i], radius)]
    return prints.select(*prints.columns, F.inline(F.array(*rows)))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the edges, its smallest node in the middle."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[: len(a)], place[len(a) :]
    label = np.arange(len(ids))
    while not np.array_equal(label[u], label[v]):
        least = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], least)
        np.minimum.at(label, label[v], least)
        while not np.array_equal(label[label], label):
            label = label[label]
    leaf = np.flatnonzero(label != np.arange(len(ids)))
    return ids[leaf], ids[label[leaf]]


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)).astype(np.int64)


def _compare(group: np.ndarray, side: np.ndarray, node: np.ndarray, value: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among rows of equal, neighbouring groups; in a split group only between its sides."""
    a, b, lag = [], [], 1
    at = np.flatnonzero(group[:-1] == group[1:])
    while len(at):
        here = at[(_apart(value[at], value[at + lag]) <= tau) & ((side[at] != side[at + lag]) | (side[at] == 2))]
        a.append(node[here])
        b.append(node[here + lag])
        lag += 1
        at = at[at + lag < len(group)]
        at = at[group[at] == group[at + lag]]
    return (np.concatenate(a), np.concatenate(b)) if a else (node[:0], node[:0])


def _met(rows: DataFrame, block: int, find) -> DataFrame:
    """Distinct links (a, b) that ``find`` sees among signature rows (part, value, node and more) of one value.

    A value that more than ``block`` rows share is split into blocks, and each two of them meet in a task
    of their own. ``find`` has arrays of the group, the side (2 if the group is whole), the node and the
    other columns, sorted by group, and gives arrays of links.
    """
    more = [c for c in rows.columns if c not in ("part", "value", "node")]
    crowded = rows.groupBy("part", "value").count().where(F.col("count") > block)
    # written first: where few values are crowded, Spark sees a small table and need not shuffle the signatures for it
    crowded = cut_lineage(crowded.select("part", "value", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    rows = rows.join(crowded, ["part", "value"], "left")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = F.transform(other, lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"), F.when(own == j, 2).when(own < j, 0).otherwise(1).alias("side")))
    alone = F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(2).alias("side")))
    rows = rows.select("part", "value", "node", *more, F.inline(F.when(F.col("blocks").isNull(), alone).otherwise(met)))
    return _found(rows.select(F.xxhash64("part", "value", "i", "j").alias("group"), "side", "node", *more), find)


def _found(keyed: DataFrame, find) -> DataFrame:
    """Distinct links (a, b) that ``find`` sees in the groups of ``keyed`` (group, side, node and more), whole groups at a time."""
    keyed = keyed.repartition("group").sortWithinPartitions("group")

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append([np.asarray(c) for c in batch.columns])
            size += batch.num_rows
            if size >= AT_ONCE:
                now = [np.concatenate(x) for x in zip(*held, strict=True)]
                cut = int(np.searchsorted(now[0], now[0][-1]))  # the last group may go on
                yield from found([x[:cut] for x in now])
                held = [[x[cut:] for x in now]]
                size = size - cut
        if size:
            yield from found([np.concatenate(x) for x in zip(*held, strict=True)])

    def found(part):
        if len(part[0]):
            a, b = find(*part)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return keyed.mapInArrow(run, "a long, b long").distinct()


def links(prints: DataFrame, tau: int = 4, block: int = 256, sample: int = 4000, least: int = 250_000) -> DataFrame:
    """Links between nodes whose fingerprints are at most ``tau`` bits apart, enough to connect the same components.

    ``prints`` has node and fingerprint, one row for each node. The plan is fitted to the ``sample``
    fingerprints with the smallest hashes, and made for ``least`` of them or more, so that small tables
    are worked on like large ones. A task gives one star for each component it finds, not all pairs.
    """
    count = prints.count()
    drawn = prints.select("fingerprint").distinct().orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(sample).collect()
    chosen = plan(np.array([r[0] for r in drawn], np.int64), max(count, least), tau)
    return _met(signatures(prints, chosen), block, lambda group, side, node, value: forest(*_compare(group, side, node, value, tau)))


def near_groups(prints: DataFrame, tau: int = 4) -> DataFrame:
    """Every row of ``prints`` (doc_id, fingerprint) with component_id, the smallest doc_id it is linked to by any path.

    Rows of one fingerprint are one node, so a pile of copies makes no pairs. Fingerprint 0 of texts
    without words is linked like any other. A row without doc_id links the others as any row does, but names
    no component: the id is that of the smallest doc_id that is not null, and null only if all are.
    """
    nodes = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    found = components(links(nodes.select(F.col("fingerprint").alias("node"), "fingerprint"), tau))
    of = nodes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    names = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.select("fingerprint", "component").join(names, "component").select("fingerprint", "component_id")
    return prints.join(of, "fingerprint").select("doc_id", "fingerprint", "component_id")


def gap(similarity: float) -> float:
    """Share of bits in which the prints of two sets differ: the angle between sets of one size at this Jaccard similarity."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def unlike(similarity: float, prints: int = len(SKETCH)) -> int:
    """Bits of so many prints that may differ at this Jaccard similarity, four deviations above the mean.

    Sets of four and five shingles differ in a quarter more bits than large ones, as ties give no bit.
    """
    n, share = WIDTH * prints, 1.25 * gap(similarity)
    return int(np.ceil(n * share + 4 * np.sqrt(n * share * (1 - share))))


def prints_for(count: int, similarity: float) -> tuple[int, Plan]:
    """How many prints ``count`` texts need, and the parts of each.

    Prints at most as many bits apart as there are parts, less one, share a part for certain. Pairs of this similarity
    are further apart in most prints; enough prints are taken that only ``LOST`` of such pairs share no part of any.
    A part has so many bits that about 256 unlike rows, or fewer, share its value.
    """
    parts = next((m for m in (5, 4, 3) if count <= 256 << (WIDTH // m)), 2)
    chosen = Plan([list(range(WIDTH * k // parts, WIDTH * (k + 1) // parts)) for k in range(parts)], [0] * parts)
    missed = np.prod([1 - (1 - gap(similarity)) ** len(p) for p in chosen.parts])
    return int(np.ceil(np.log(LOST) / np.log(missed))), chosen


def _differ(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many bits of the sketches differ."""
    return sum(_apart(p, q) for p, q in zip(x, y, strict=True))


def _hung_together(a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stars (leaf, middle) of the links, and for each of ``count`` rows the middle and whether more than ``SMALL`` hang together."""
    leaf, top = forest(a, b)
    label = np.arange(count)
    label[leaf] = top
    return leaf, top, label, np.bincount(label, minlength=count)[label] > SMALL


def _plausible(limit: int):
    """Links to look at among rows of equal, neighbouring groups, for ``_met``.

    A pair has the smaller node first. Where more than ``SMALL`` rows of a group hang together, each is instead
    linked to the smallest of them, which stands second.
    """

    def find(group, side, node, *sketch):
        i, j, lag, held = [], [], 1, 0
        at = np.flatnonzero(group[:-1] == group[1:])
        while len(at):
            here = at[(side[at] != side[at + lag]) | (side[at] == 2)]
            here = here[_differ([s[here] for s in sketch], [s[here + lag] for s in sketch]) <= limit]
            i.append(here)
            j.append(here + lag)
            held += len(here)
            if held > LINKS:
                a, b = np.concatenate(i), np.concatenate(j)
                leaf, top, _, crowded = _hung_together(a, b, len(node))
                few, star = ~crowded[a], crowded[leaf]
                i, j = [a[few], leaf[star]], [b[few], top[star]]
                held = sum(map(len, i))
            lag += 1
            at = at[at + lag < len(group)]
            at = at[group[at] == group[at + lag]]
        if not i:
            return node[:0], node[:0]
        i, j = np.concatenate(i), np.concatenate(j)
        label, crowded = _hung_together(i, j, len(node))[2:]
        hub = node.copy()
        np.minimum.at(hub, label, node)
        member = np.flatnonzero(crowded & (node > hub[label]))
        i, j = node[i[~crowded[i]]], node[j[~crowded[i]]]
        return np.concatenate([np.minimum(i, j), node[member]]), np.concatenate([np.maximum(i, j), hub[label[member]]])

    return find


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two of the sets share, as a matrix.

    Members of few sets are counted pair by pair; those of many, a slice at a time, by a product of matrices.
    """
    n = len(sets)
    row = np.repeat(np.arange(n), [len(x) for x in sets])
    member = np.unique(np.concatenate(sets), return_inverse=True)[1] if n else row
    order = np.lexsort((row, member))
    row, member = row[order], member[order]
    times = np.bincount(member) if len(member) else np.zeros(0, np.int64)
    out = np.zeros((n, n), np.float32)
    many = times > FEW
    column = np.cumsum(many) - 1
    for start in range(0, int(many.sum()), SLICE):
        here = many[member] & (column[member] >= start) & (column[member] < start + SLICE)
        table = np.zeros((n, SLICE), np.float32)
        table[row[here], column[member[here]] - start] = 1
        out += table @ table.T
    few = ~many[member]
    row, member, lag = row[few], member[few], 1
    at = np.flatnonzero(member[:-1] == member[1:])
    while len(at):
        pairs = np.bincount(row[at] * n + row[at + lag], minlength=n * n).reshape(n, n).astype(np.float32)
        out += pairs + pairs.T
        lag += 1
        at = at[at + lag < len(member)]
        at = at[member[at] == member[at + lag]]
    return out


def _shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each row in order, and the bounds of the rows.

    A text of fewer words is one shingle; one without words has none.
    """
    data, offsets = text_bytes(column)
    low = LOWER[data]
    starts, ends, first = spans(WORD[low], offsets)
    hashes, row = SpanHash(low)(starts, ends), owner(first)
    grams = np.zeros(len(hashes), np.uint64)
    left = np.minimum(words, np.repeat(first[1:], np.diff(first)) - np.arange(len(hashes)))  # words up to the end of the row
    for j in range(words):
        at = np.minimum(np.arange(len(hashes)) + j, max(len(hashes) - 1, 0))
        grams = np.where(j < left, grams * np.uint64(0x9E3779B97F4A7C15) + hashes[at], grams)
    full = (left == words) | (np.arange(len(hashes)) == first[:-1][row])  # whole shingles; a short text is one
    grams, row = mix(grams[full]), row[full]
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return grams[new], np.searchsorted(row[new], np.arange(len(first)))


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of ``docs`` for each group of near copies, with all its columns: the smallest doc_id, then text hash.

    Texts are near copies when the sets of their shingles of ``words`` words have a Jaccard similarity of
    ``similarity`` or more, or by a chain of such pairs. Pairs are looked for by SimHash: several prints of the
    distinct shingles, whose parts are signatures; rows that share one and have prints near enough are compared by
    the sets themselves. Many such rows of one signature, and those they share rows with, are a crowd, in which all
    rows are compared. Rows of equal doc_id and text count once; null, empty and blank texts are copies of each
    other; a null doc_id comes first.
    """
    n_prints, chosen = prints_for(docs.count(), similarity)
    mine = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mine.alias("hash"), F.col("text").cast("string").alias("text"))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        grams, bounds = _shingle_sets(piece.column("text"), words)
        whole = [np.concatenate([[0], np.cumsum(mix(grams + np.uint64(k)), dtype=np.uint64)]).astype(np.uint64) for k in (1, 2)]
        digest = [(w[bounds[1:]] - w[bounds[:-1]]).view(np.int64) for w in whole]
        prints = np.stack([majority(mix(grams + np.uint64(k)), bounds) for k in range(3, n_prints + 3)], axis=1)
        wordy = np.where(bounds[1:] > bounds[:-1], n_prints, 0)  # texts without words are one node, without prints
        values = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(wordy)]).astype(np.int32)), pa.array(prints[wordy > 0].ravel()))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("hash"), *map(pa.array, digest), values], ["doc_id", "hash", "one", "two", "prints"])

    prints = kept.mapInArrow(per_piece(work), "doc_id long, hash long, one long, two long, prints array<long>")
    nodes = prints.groupBy("one", "two").agg(F.min(F.struct("doc_id", "hash")).alias("first"), F.first("prints").alias("prints"))
    nodes = cut_lineage(nodes.withColumn("node", F.xxhash64("first.doc_id", "first.hash")))
    sketch = [F.get("prints", F.lit(k)).alias(c) for k, c in enumerate(SKETCH)]
    rows = signatures(nodes.select("node", *sketch, F.posexplode("prints").alias("print", "fingerprint")), chosen)
    rows = rows.select((F.col("print") * len(chosen.parts) + F.col("part")).alias("part"), "value", "node", *SKETCH)
    seen = cut_lineage(_met(rows, SPLIT, _plausible(unlike(similarity))))
    hubs = seen.where("a > b").select(F.col("a").alias("node"), F.col("b").alias("hub"))
    crowd = cut_lineage(_crowds(hubs.union(hubs.select("hub", "hub").distinct())))
    # pairs within a crowd are compared there
    pairs = seen.where("a < b")
    inside = pairs.join(crowd.withColumnRenamed("node", "a"), "a").join(crowd.withColumnRenamed("node", "b"), ["b", "crowd"])
    pairs = pairs.join(inside, ["a", "b"], "left_anti")
    for c in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(c), F.col("prints").alias(f"of_{c}")), c)
    apart = F.aggregate(F.zip_with("of_a", "of_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    pairs = cut_lineage(pairs.where(apart <= unlike(similarity, n_prints)).select("a", "b"))
    asked = [pairs.select(F.col("a").alias("node"), F.lit(FIRST).alias("use")), pairs.select("b", F.lit(SECOND)), crowd.select("node", F.lit(MEMBER))]
    held = _held_sets(kept, asked[0].union(asked[1]).union(asked[2]).groupBy("node").agg(F.bit_or("use").alias("uses")), words)
    links = _alike(held, pairs, similarity).union(_alike_in_crowds(held, crowd, similarity))
    found = components(links)
    firsts = nodes.select("node", "first").join(found, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("first").alias("first"))
    stays = cut_lineage(firsts.select(F.xxhash64("first.doc_id", "first.hash").alias("__gevel_node")))
    # one key for both steps, so that whole rows go through one shuffle
    named = docs.withColumn("__gevel_node", F.xxhash64(F.col("doc_id").cast("long"), mine))
    return named.join(stays, "__gevel_node", "left_semi").dropDuplicates(["__gevel_node"]).select(*docs.columns)


def _crowds(members: DataFrame) -> DataFrame:
    """node and crowd, each pair once, from node and hub: the rows of one hub keep a crowd in common.

    Hubs that share rows mostly get one name, the least of their rows' least; where they do not, a row is in several crowds.
    """
    named = members.join(members.groupBy("node").agg(F.min("hub").alias("least")), "node")
    names = named.groupBy("hub").agg(F.min("least").alias("crowd"))
    return members.join(names, "hub").select("node", "crowd").distinct()


def _maybe_in(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows whose node is asked for, and few others: one bit for each value of a node's last bits tells, ahead of any shuffle.

    The bits take 4 MB however many nodes are asked for; the join that follows is exact.
    """
    place = F.col("node").bitwiseAND(F.lit((1 << ASKED_BITS) - 1))
    word, row = F.shiftright(place, 6), F.shiftright(place, 15)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("node").bitwiseAND(F.lit(63)).cast("int"))
    every = rows.sparkSession.range(1 << (ASKED_BITS - 6)).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = every.union(asked.select(word, bit)).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # whole rows of words: a list is looked into where it lies, one row of a join for each word would take far more memory
    words = words.groupBy(F.shiftright("word", 9).alias("__gevel_row")).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    words = words.select("__gevel_row", F.transform("words", lambda w: w["bits"]).alias("__gevel_words"))
    here = F.get("__gevel_words", word.bitwiseAND(F.lit(511)).cast("int")).bitwiseAND(bit) != 0
    return rows.withColumn("__gevel_row", row).join(F.broadcast(words), "__gevel_row").where(here).select(*rows.columns)


def _held_sets(kept: DataFrame, asked: DataFrame, words: int) -> DataFrame:
    """node, uses, size and grams, the sorted hashes of its shingles and their bytes, of the asked nodes (node, uses); written once."""

    def sets(piece: pa.RecordBatch) -> pa.RecordBatch:
        grams, bounds = _shingle_sets(piece.column("text"), words)
        blobs = [grams[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        size = pa.array(8 * np.diff(bounds), pa.int64())
        return pa.RecordBatch.from_arrays([piece.column("node"), piece.column("uses"), size, pa.array(blobs, pa.binary())], ["node", "uses", "size", "grams"])

    asked = cut_lineage(asked)
    texts = _maybe_in(kept.select(F.xxhash64("doc_id", "hash").alias("node"), "text"), asked)
    texts = texts.join(asked, "node").dropDuplicates(["node"])
    return cut_lineage(texts.mapInArrow(per_piece(sets), "node long, uses int, size long, grams binary"))


def _held_for(held: DataFrame, use: int) -> DataFrame:
    return held.where(F.col("uses").bitwiseAND(F.lit(use)) != 0)


def _alike(held: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sets of shingles are alike."""
    first = _held_for(held, FIRST).select(F.col("node").alias("a"), F.col("grams").alias("of_a"))
    second = _held_for(held, SECOND).select(F.col("node").alias("b"), F.col("grams").alias("of_b"))
    both = pairs.join(second, "b").join(first, "a")

    def check(batches):
        for batch in batches:
            x, y = batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist()
            keep = np.zeros(len(x), bool)
            for i, (p, q) in enumerate(zip(x, y, strict=True)):
                m, n = len(p) // 8, len(q) // 8
                if min(m, n) >= similarity * max(m, n):
                    union = np.sort(np.concatenate([np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)]))
                    shared = int((union[1:] == union[:-1]).sum())
                    keep[i] = shared >= similarity * (m + n - shared) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(check, "a long, b long")


def _alike_in_crowds(held: DataFrame, crowd: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that connect all alike nodes of each crowd (node, crowd).

    Every two nodes of a crowd are compared by their whole sets. A crowd is dealt into blocks bounded in rows and
    bytes, and each two blocks meet in a task of their own, which gives a star for each component it finds.
    """
    held = _held_for(held, MEMBER)
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_BYTES)).cast("int")
    # from the sizes alone: the sets go through the shuffle once
    sizes = cut_lineage(crowd.join(held.select("node", "size"), "node").groupBy("crowd").agg(blocks.alias("blocks")))
    rows = crowd.join(held, "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = F.transform(other, lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"), F.when(own == j, 2).when(own < j, 0).otherwise(1).alias("side")))
    rows = rows.join(sizes, "crowd").select("crowd", "node", "grams", F.inline(met))

    def find(table: pa.Table) -> pa.Table:
        node, side = table.column("node").to_numpy(), table.column("side").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        shared, size = shared_counts(sets), np.array([len(x) for x in sets], np.float64)
        alike = shared >= similarity * (size[:, None] + size[None] - shared) - 1e-9
        alike &= (side[:, None] != side[None]) | (side[:, None] == 2)
        a, b = np.nonzero(np.triu(alike, 1))
        leaf, top = forest(node[a], node[b])
        return pa.table({"a": leaf, "b": top})

    return rows.groupBy("crowd", "i", "j").applyInArrow(find, "a long, b long")
