"""Best-fit packing of documents into sequences, with conflicts between documents.

Documents are dealt into blocks by hash, and each block is packed by itself, largest first. Bins are
ordered by what is left in them; each carries a bitmap of its sources and one of its duplicate
clusters. From the tightest bin that is large enough the search goes on to the next larger remainder
until a bin without conflict is found, or opens a new one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Bins:
    """Open bins by remainder. Bit r of ``open`` is set while some bin has r left."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.open = 0
        self.by_rest: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.sources: list[list[int]] = []  # bitmaps of each bin: bit set in plane j where a source has over j documents
        self.clusters: list[int] = []

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and place in it for a piece; ``source`` and ``cluster`` are single bits or 0."""
        full, rest = self.per_source - 1, size - 1
        while True:
            later = self.open >> (rest + 1)
            if not later:
                number, rest = len(self.clusters), self.capacity
                self.sources.append([0] * self.per_source)
                self.clusters.append(0)
                break
            rest += (later & -later).bit_length()
            here = self.by_rest[rest]
            number = next((b for b in here if not (self.sources[b][full] & source or self.clusters[b] & cluster)), -1)
            if number >= 0:
                here.remove(number)
                if not here:
                    self.open ^= 1 << rest
                break
        planes = self.sources[number]
        for j in range(self.per_source):
            if not planes[j] & source:
                planes[j] |= source
                break
        self.clusters[number] |= cluster
        left = rest - size
        if left:
            if not self.by_rest[left]:
                self.open |= 1 << left
            self.by_rest[left].append(number)
        return number, self.capacity - rest


def pack_block(table: pa.Table, capacity: int, per_source: int) -> pa.Table:
    """Packs one block of rows (block, doc_id, source, cluster, size)."""
    ids, size = table.column("doc_id").to_pylist(), np.asarray(table.column("size"))
    sources, clusters = np.asarray(table.column("source_key")), np.asarray(table.column("cluster"))
    block = table.column("block")[0].as_py()
    source_bit = {k: 1 << i for i, k in enumerate(np.unique(sources).tolist())}
    keys, often = np.unique(clusters, return_counts=True)
    cluster_bit = {k: 1 << i for i, k in enumerate(keys[often > 1].tolist())}
    pieces = []
    for row, n in enumerate(size.tolist()):
        for part, start in enumerate(range(0, n, capacity)):
            pieces.append((min(capacity, n - start), row, part, start))
    pieces.sort(key=lambda p: (-p[0], ids[p[1]] is None, ids[p[1]] or 0, clusters[p[1]], p[2]))
    bins, out = Bins(capacity, per_source), []
    for n, row, part, start in pieces:
        number, place = bins.put(n, source_bit[sources[row]], cluster_bit.get(clusters[row], 0))
        out.append((ids[row], part, start, n, (block << 32) | number, place))
    columns = list(zip(*out, strict=True))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "size", "bin", "place"])


def pack(docs: DataFrame, capacity: int = 8192, per_source: int = 2, block: int = 4096) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text, source), each with its bin and its place in it.

    Sizes are UTF-8 bytes and one for the end mark; a text over ``capacity`` is cut into full pieces and
    a rest, so nothing is left out. A bin has at most ``per_source`` pieces of a source and one of a
    duplicate cluster (texts equal but for case and outer blanks). A null text is an empty one, a null
    source a source of its own. Blocks have ``block`` rows on average whatever the data, and repeated rows
    are dealt by their number, so each is packed in bounded memory; only the last bins of a block stay open. Other columns are dropped.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cluster = F.xxhash64(F.lower(F.trim(text)))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("\x00"))).alias("source_key"), cluster.alias("cluster"), (F.octet_length(text) + 1).cast("long").alias("size")
    )
    blocks = max(1, -(-docs.count() // block))
    rows = rows.groupBy(*rows.columns).count().select(*rows.columns, F.explode(F.sequence(F.lit(1), F.col("count"))).alias("repeat"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "source_key", "cluster", "size", "repeat"), F.lit(blocks)).cast("long")).drop("repeat")
    return rows.groupBy("block").applyInArrow(lambda t: pack_block(t, capacity, per_source), "doc_id long, piece int, start long, size long, bin long, place long")
