"""Toxic spans by a linear-chain conditional random field over words.

Words are labelled from the documents' labels: a word, or a common beginning of words, that is far
more frequent in toxic documents than in others is offensive where it occurs in a toxic document.
The field is fitted to these labelled words on a bounded sample; its forward-backward marginals give
the offending spans and the score of each document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.llm import crf
from gevel.llm.arrays import LOWER, SpanHash, greatest, owner, per_piece, spans, text_bytes

BITS = 18
#: letters, digits, apostrophe and every byte of a letter outside ASCII
WORD = np.array([chr(b).isalnum() or b >= 128 or b == 39 for b in range(256)])


@dataclass
class Tagger:
    weights: np.ndarray
    pair: np.ndarray
    bias: float


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashed features of each word, one column each: the word, its beginnings, its end, its length."""
    span = SpanHash(data)
    whole = span(starts, ends)
    columns = [whole]
    for n in range(4, 10):
        columns.append(span(starts, np.minimum(starts + n, ends)) + np.uint64(n))
    columns.append(span(np.maximum(ends - 4, starts), ends) + np.uint64(11))
    columns.append(np.minimum(ends - starts, 24).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    shift = np.uint64(64 - BITS)
    return np.stack([(c * np.uint64(0xFF51AFD7ED558CCD)) >> shift for c in columns], 1).astype(np.int32)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low = LOWER[data]
    starts, ends, first = spans(WORD[low], offsets)
    return low, starts, ends, first


def word_labels(keys: np.ndarray, first: np.ndarray, toxic: np.ndarray, ratio: float = 20.0, evidence: float = 18.0) -> np.ndarray:
    """Which words are offensive: some key of theirs is ``ratio`` times as frequent in toxic texts as in others.

    A key counts once for each different word before it, so that what many copies of one toxic text
    share does not become offensive. ``evidence`` is the least log likelihood ratio against equal
    frequencies, so that rare keys which a few toxic texts have by chance do not count.
    """
    row = owner(first)
    of = toxic[row]
    before = np.full(len(row), -1, np.int64)
    before[1:] = np.where(row[1:] == row[:-1], keys[:-1, 0], -1)
    bad = np.zeros(len(row), bool)
    for column in range(keys.shape[1]):
        pair = keys[:, column].astype(np.int64) << 32 | (before & 0xFFFFFFFF)
        inside = np.bincount(np.unique(pair[of]) >> 32, minlength=1 << BITS)
        outside = np.bincount(np.unique(pair[~of]) >> 32, minlength=1 << BITS)
        share = min(max(inside.sum() / max(1, inside.sum() + outside.sum()), 1e-6), 1 - 1e-6)
        odds = inside / (outside + 0.5) * (1 - share) / share
        both = np.maximum(inside + outside, 1)
        gain = inside * np.log(np.maximum(inside / both, 1e-9) / share) + outside * np.log(np.maximum(outside / both, 1e-9) / (1 - share))
        bad |= ((odds > ratio) & (gain > evidence))[keys[:, column]]
    return bad & of


def fit(texts: list[str], toxic: list[int], rounds: int = 25, rate: float = 0.5, decay: float = 1e-6) -> Tagger:
    """Fits weights and transitions to labelled words by gradient ascent on the likelihood of the chains."""
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    low, starts, ends, first = words(data, offsets)
    keys = features(low, starts, ends)
    target = word_labels(keys[:, :7], first, np.array(toxic, bool)).astype(float)
    weights, pair, bias = np.zeros(1 << BITS), np.zeros((2, 2)), 0.0
    grown, grown_pair, grown_bias = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6), 1e-6
    row = owner(first)
    same = np.flatnonzero(row[1:] == row[:-1])
    seen_pairs = np.bincount((target[same] * 2 + target[same + 1]).astype(int), minlength=4).reshape(2, 2) if len(target) else np.zeros((2, 2))
    columns = [np.ascontiguousarray(keys[:, j]) for j in range(keys.shape[1])]
    del keys
    n = max(1, len(target))
    for _ in range(rounds if len(target) else 0):
        m = crf.messages(sum(weights[c] for c in columns) + bias, first, pair)
        gap = target - m.marginals()
        slope = sum(np.bincount(c, gap, 1 << BITS) for c in columns) - decay * n * weights
        pair_slope = seen_pairs - m.pair_totals(pair, first)
        grown += slope**2
        grown_pair += pair_slope**2
        grown_bias += gap.sum() ** 2
        weights += rate * slope / np.sqrt(grown)
        pair += rate * pair_slope / np.sqrt(grown_pair)
        bias += rate * gap.sum() / np.sqrt(grown_bias)
    return Tagger(weights.astype(np.float32), pair, float(bias))


def tag(model: Tagger, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Marginal of each word, with its start and end in ``data`` and the bounds of the rows."""
    low, starts, ends, first = words(data, offsets)
    odds = model.weights[features(low, starts, ends)].sum(1) + model.bias
    return crf.messages(odds, first, model.pair).marginals(), starts, ends, first


def score(docs: DataFrame, model: Tagger, threshold: float = 0.7, inside: float = 0.5) -> DataFrame:
    """Score of each document, and the spans of its offending words.

    ``docs`` has doc_id and text; other columns are dropped. The score is the largest marginal of a
    word: one offending span makes a document toxic, whatever its length. ``spans`` holds byte
    positions in the UTF-8 text, neighbouring tagged words joined. A null text, an empty one and one
    without words score 0. Equal rows give equal results.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(piece.column("text"))
        p, starts, ends, first = tag(model, data, offsets)
        best = np.clip(greatest(p, first), 0, 1)
        hit = np.flatnonzero(p >= inside)
        row = owner(first)
        opens = np.ones(len(hit), bool)
        opens[1:] = (np.diff(hit) > 1) | (row[hit[1:]] != row[hit[:-1]])
        closes = np.roll(opens, -1) if len(hit) else opens
        a, b, of = starts[hit[opens]], ends[hit[closes]], row[hit[opens]]
        bounds = np.searchsorted(of, np.arange(len(first))).astype(np.int32)
        pair = pa.StructArray.from_arrays([pa.array(a - offsets[of]), pa.array(b - offsets[of])], ["start", "end"])
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(best), pa.array((best >= threshold).astype(np.int32)), pa.ListArray.from_arrays(pa.array(bounds), pair)],
            ["doc_id", "score", "predicted", "spans"],
        )

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(per_piece(work), "doc_id long, score double, predicted int, spans array<struct<start: long, end: long>>")
