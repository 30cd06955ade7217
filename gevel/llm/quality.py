"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. Its features, and those of the lines beside it, are counts of bytes and words
put into classes; a line takes its document's label to learn from. A document's quality is the mean of
the forward-backward marginals of its lines, weighted by their lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.llm import crf
from gevel.llm.arrays import LOWER, SpanHash, owner, per_piece, spans, text_bytes, totals

CLASSES = 16
_CODE = np.arange(256)
NEWLINE, SPACE = _CODE == 10, (_CODE == 32) | ((_CODE >= 9) & (_CODE <= 13))
UPPER, DIGIT = (_CODE >= 65) & (_CODE <= 90), (_CODE >= 48) & (_CODE <= 57)
LETTER = UPPER | ((_CODE >= 97) & (_CODE <= 122)) | (_CODE >= 128)
PAUSE = np.isin(_CODE, list(b".,;:'\"-?()"))
SIGN = ~(LETTER | DIGIT | SPACE | PAUSE | (_CODE < 32))


@dataclass
class Model:
    edges: np.ndarray
    weights: np.ndarray
    pair: np.ndarray
    bias: float


def _counts(flag: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    run = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=run[1:])
    return run[ends] - run[starts]


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line, and the first line of each row; every text has at least one line."""
    cut = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], cut + 1])
    ends = np.concatenate([cut, offsets[1:]])
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, cut, side="right") - 1])
    begin = np.lexsort((starts, row))
    finish = np.lexsort((ends, np.concatenate([row[len(offsets) - 1 :], np.arange(len(offsets) - 1)])))
    first = np.searchsorted(row[begin], np.arange(len(offsets)))
    return starts[begin], ends[finish], first


def measures(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of each line (a column each), its length in bytes, and the first line of each row."""
    starts, ends, first = lines(data, offsets)
    length = ends - starts
    size = np.maximum(length, 1)
    blank = SPACE[data]
    w0, w1, _ = spans(~blank, np.union1d(offsets, starts))
    at = np.searchsorted(w0, np.append(starts, len(data)))
    at[-1] = len(w0)
    n = np.diff(at)
    words = np.maximum(n, 1)
    key = SpanHash(LOWER[data])(w0, w1)
    near = np.zeros(len(w0), bool)
    line = owner(at)
    row = owner(first)[line]
    for lag in (1, 2):
        near[lag:] |= (key[lag:] == key[:-lag]) & (row[lag:] == row[:-lag])
    order = np.lexsort((key, line))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=len(n))
    last = data[np.maximum(w1 - 1, 0)] if len(w1) else np.zeros(0, np.uint8)
    loud = SIGN[last] if len(w1) else np.zeros(0, bool)
    stacked = [
        np.log2(size),
        np.log2(words),
        _counts(UPPER[data], starts, ends) / size,
        _counts(DIGIT[data], starts, ends) / size,
        _counts(SIGN[data], starts, ends) / size,
        _counts(PAUSE[data], starts, ends) / size,
        _counts(LETTER[data], starts, ends) / size,
        distinct / words,
        totals(near.astype(np.int64), at) / words,
        totals(loud.astype(np.int64), at) / words,
        totals((w1 - w0).astype(np.int64), at) / words,
        totals((w1 - w0 == 1).astype(np.int64), at) / words,
    ]
    return np.stack(stacked, 1).astype(float), length, first


def _classes(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[j], values[:, j]) for j in range(values.shape[1])], 1)


def features(values: np.ndarray, first: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Indices into the weights: the classes of the line, of the line before and of the line after."""
    own = _classes(values, edges)
    count = values.shape[1]
    outside = CLASSES  # class of a neighbour that is not there
    before, after = np.full_like(own, outside), np.full_like(own, outside)
    before[1:], after[:-1] = own[:-1], own[1:]
    heads, tails = first[:-1], first[1:] - 1
    before[heads], after[tails] = outside, outside
    column = np.arange(count) * (CLASSES + 1)
    block = count * (CLASSES + 1)
    return np.concatenate([own + column, before + column + block, after + column + 2 * block], 1)


def fit(texts: list[str], good: list[int], rounds: int = 60, rate: float = 0.3) -> Model:
    """Fits classes, weights and transitions; without labelled texts every line is good with one half."""
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    values, _, first = measures(data, offsets)
    width = values.shape[1]
    edges = np.stack([np.quantile(values[:, j], np.arange(1, CLASSES) / CLASSES) if len(values) else np.zeros(CLASSES - 1) for j in range(width)])
    weights = np.zeros(3 * width * (CLASSES + 1))
    model = Model(edges, weights, np.zeros((2, 2)), 0.0)
    if not len(values):
        return model
    keys = features(values, first, edges)
    target = np.array(good, float)[owner(first)]
    share = (1 / np.diff(first))[owner(first)]  # each document weighs the same
    row = owner(first)
    same = np.flatnonzero(row[1:] == row[:-1])
    pairs = np.bincount((target[same] * 2 + target[same + 1]).astype(int), minlength=4).reshape(2, 2) / max(1, len(same))
    grown, grown_pair, grown_bias = np.full(len(weights), 1e-6), np.full((2, 2), 1e-6), 1e-6
    for _ in range(rounds):
        m = crf.messages(weights[keys].sum(1) + model.bias, first, model.pair)
        gap = (target - m.marginals()) * share
        slope = np.bincount(keys.ravel(), np.repeat(gap, keys.shape[1]), len(weights)) - 1e-3 * weights
        pair_slope = pairs - m.pair_totals(model.pair, first) / max(1, len(same)) - 0.05 * model.pair
        grown += slope**2
        grown_pair += pair_slope**2
        grown_bias += gap.sum() ** 2
        weights += rate * slope / np.sqrt(grown)
        model.pair = model.pair + 0.3 * rate * pair_slope / np.sqrt(grown_pair)
        model.bias += rate * gap.sum() / np.sqrt(grown_bias)
    return model


def rate(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Quality of each row, and for its lines the marginal of good, the length and the bounds of the rows."""
    values, length, first = measures(data, offsets)
    odds = model.weights[features(values, first, model.edges)].sum(1) + model.bias
    p = crf.messages(odds, first, model.pair).marginals()
    weight = length + (1e-9 if len(length) else 0.0)  # a text of empty lines: their plain mean
    total = totals(weight.astype(float), first)
    return totals(p * weight, first) / np.where(total > 0, total, 1), p, length, first


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Quality of each document, with its number of lines and of lines that are rather bad.

    ``docs`` has doc_id and text; other columns are dropped. Null and empty texts are one empty line
    and score as the model rates that. Equal rows give equal results.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(piece.column("text"))
        quality, p, _, first = rate(model, data, offsets)
        quality = np.clip(quality, 0, 1)
        bad = totals((p < 0.5).astype(np.int64), first)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(quality), pa.array((quality >= threshold).astype(np.int32)), pa.array(np.diff(first).astype(np.int64)), pa.array(bad.astype(np.int64))],
            ["doc_id", "score", "predicted", "n_lines", "n_bad_lines"],
        )

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(per_piece(work), "doc_id long, score double, predicted int, n_lines long, n_bad_lines long")


def keep(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose quality reaches the threshold."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        return piece.filter(pa.array(rate(model, *text_bytes(piece.column("text")))[0] >= threshold))

    return docs.mapInArrow(per_piece(work), docs.schema)
