"""Benchmark decontamination by winnowing.

The smallest of each ``window`` consecutive hashes of k words is a fingerprint; two texts that share
``window + k - 1`` words in a row then share a fingerprint inside that run. Documents and benchmark
items are joined on their fingerprints and each hit is extended to the shared windows around it, word
by word. An item shorter than a full window is one window of its own length, whose fingerprint is the
hash of all its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gevel.llm.arrays import LOWER, SpanHash, mix, owner, per_piece, spans, text_bytes
from gevel.session import cut_lineage

SPAN, GRAM = 10, 5
FILTER_BITS = 22
_CODE = np.arange(256)
#: digits, letters in lower case and every byte outside ASCII
WORD = ((_CODE >= 48) & (_CODE <= 57)) | ((_CODE >= 97) & (_CODE <= 122)) | (_CODE >= 128)

SEEDS = "seeds array<struct<span: int, print: long, at: long, lead: int, words: array<string>>>"


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that begin at each word, where so many are left in the array."""
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n]
    return mix(out)


def selected(words: np.ndarray, first: np.ndarray, k: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the fingerprints for shared runs of ``span`` words; ties go to the first."""
    window = span - k + 1
    grams = gram_hashes(words, k)
    row = owner(first)
    whole = np.flatnonzero(row[: len(row) - span + 1] == row[span - 1 :]) if len(row) >= span else np.zeros(0, int)
    if not len(whole):
        return whole, np.zeros(0, np.uint64)
    best = whole.copy()
    for j in range(1, window):
        best = np.where(grams[whole + j] < grams[best], whole + j, best)
    at = np.unique(best)
    return at, grams[at]


def _seeds(data: np.ndarray, offsets: np.ndarray, classes: list[int], only: np.ndarray | None, exact: bool) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each row, and its fingerprints with the words around them.

    ``only`` is a bitmap of wanted fingerprints. With ``exact``, a row takes the class of its own
    length alone (items); otherwise every class (documents).
    """
    low = LOWER[data]
    starts, ends, first = spans(WORD[low], offsets)
    count = np.diff(first)
    hashes = SpanHash(low)(starts, ends)
    row = owner(first)
    found = []
    for span in classes:
        k = GRAM if span == SPAN else span
        at, prints = selected(hashes, first, k, span)
        prints = mix(prints + np.uint64(span))
        if exact:
            keep = np.minimum(count[row[at]], SPAN) == span
        else:
            index = prints >> np.uint64(64 - FILTER_BITS)
            keep = (only[index >> np.uint64(3)] >> (index & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        at, prints = at[keep], prints[keep]
        reach = span - k
        a, b = np.maximum(at - reach, first[row[at]]), np.minimum(at + k + reach, first[row[at] + 1])
        found.append((at, np.full(len(at), span), prints, a, b))
    at, span, prints, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    at, span, prints, a, b = at[order], span[order], prints[order], a[order], b[order]
    size = b - a
    inner = np.concatenate([[0], np.cumsum(size)])
    which = np.repeat(a - inner[:-1], size) + np.arange(inner[-1])
    text, used = low.tobytes(), np.unique(which)
    word = {i: text[s:e].decode("utf-8", "replace") for i, s, e in zip(used.tolist(), starts[used].tolist(), ends[used].tolist(), strict=True)}
    context = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array([word[i] for i in which.tolist()], pa.string()))
    rows = row[at]
    local = at - first[rows]
    seed = pa.StructArray.from_arrays(
        [pa.array(span, pa.int32()), pa.array(prints.view(np.int64)), pa.array(local, pa.int64()), pa.array(at - a, pa.int32()), context],
        ["span", "print", "at", "lead", "words"],
    )
    return count, pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(len(offsets))), pa.int32()), seed)


def _with_seeds(rows: DataFrame, key: str, classes: list[int], only: np.ndarray | None, exact: bool) -> DataFrame:
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(piece.column("text"))
        count, seeds = _seeds(data, offsets, classes, only, exact)
        return pa.RecordBatch.from_arrays([piece.column(key), pa.array(count, pa.int64()), seeds], [key, "n_words", "seeds"])

    return rows.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text")).mapInArrow(per_piece(work), f"{key} long, n_words long, {SEEDS}")


def _flat(rows: DataFrame, key: str, side: str) -> DataFrame:
    seeds = rows.select(key, F.inline("seeds"))
    return seeds.select(key, "span", "print", F.col("at").alias(f"{side}_at"), F.col("lead").alias(f"{side}_lead"), F.col("words").alias(f"{side}_words"))


def shared_windows(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (row, doc_id, n_words) and the windows they share with items (row, item_id, start, span).

    ``docs`` has doc_id and text, ``items`` item_id and text; a row of docs is a document of its own,
    also when its doc_id is repeated. Items with a null id or without words are left out.
    """
    known = items.where("item_id IS NOT NULL")
    prints = cut_lineage(_with_seeds(known, "item_id", list(range(1, SPAN + 1)), None, True))
    flat = _flat(prints.distinct(), "item_id", "item")
    classes = sorted(r[0] for r in flat.select("span").distinct().collect())
    # one bit for each value of the first FILTER_BITS bits: as large for any benchmark
    wanted = flat.select(F.shiftrightunsigned("print", 64 - FILTER_BITS).alias("bit")).distinct().toArrow().column("bit").to_numpy()
    only = np.packbits(np.isin(np.arange(1 << FILTER_BITS), wanted), bitorder="little")
    numbered = docs.select("doc_id", "text")
    scanned = cut_lineage(_with_seeds(numbered, "doc_id", classes or [SPAN], only, False).withColumn("row", F.monotonically_increasing_id()))
    hits = _flat(scanned, "row", "doc").join(flat, ["span", "print"])
    gram = F.when(F.col("span") == SPAN, GRAM).otherwise(F.col("span"))
    windows = F.transform(
        F.sequence(F.lit(0), F.col("span") - gram),
        lambda before: F.when(
            (before <= F.col("doc_lead"))
            & (before <= F.col("item_lead"))
            & (F.size("doc_words") - F.col("doc_lead") + before >= F.col("span"))
            & (F.slice("doc_words", F.greatest(F.col("doc_lead") - before, F.lit(0)) + 1, F.col("span")) == F.slice("item_words", F.greatest(F.col("item_lead") - before, F.lit(0)) + 1, F.col("span"))),
            F.col("doc_at") - before,
        ),
    )
    shared = hits.select("row", "item_id", "span", F.explode(F.array_compact(windows)).alias("start")).distinct()
    return scanned.select("row", "doc_id", "n_words"), cut_lineage(shared)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """For every row of ``docs``: number of words, of words in shared windows, and the items found.

    A null text has no words. The words of a window that occurs several times, or in several items,
    count once. ``item_ids`` is sorted as strings. Empty tables give no rows and no hits.
    """
    rows, shared = shared_windows(docs, items)
    ends = shared.select("row", "start", (F.col("start") + F.col("span")).alias("stop")).distinct()
    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.col("start"))))
    covered = ends.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = shared.select("row", F.col("item_id").cast("string").alias("item_id")).distinct().groupBy("row")
    named = named.agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    out = rows.join(covered, "row", "left").join(named, "row", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that share no window with an item; rows of one doc_id go together."""
    rows, shared = shared_windows(docs, items)
    dirty = rows.join(shared.select("row").distinct(), "row", "left_semi").select(F.col("doc_id").alias("__gevel_dirty")).distinct()
    # written first: where few ids are dirty, Spark sees a small table and need not shuffle the texts for it
    dirty = cut_lineage(dirty)
    return docs.join(dirty, F.col("doc_id").cast("long").eqNullSafe(F.col("__gevel_dirty")), "left_anti")
