"""Language of a text by error-correcting output codes.

Every language has a codeword of bits. A linear classifier over byte trigrams predicts each bit; the
language whose codeword has the least total logistic loss is chosen, and a text whose two best
languages lie close together is flagged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.llm.arrays import PIECE, per_piece, text_bytes

BITS = 15
UNKNOWN = "und"
#: ASCII letters in lower case and the bytes of all letters outside ASCII; the rest is a gap
LETTERS = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def codewords(count: int) -> np.ndarray:
    """A row of bits (1 or -1) for each of ``count`` languages, far apart from each other.

    Up to six languages have every way to divide them; more have the one of 64 random codes, drawn
    with a fixed seed, whose closest rows differ most.
    """
    if count <= 1:
        return np.ones((count, 1))
    if count <= 6:
        ways = np.arange(1, 1 << (count - 1))
        return np.stack([np.ones(len(ways)), *(1.0 - 2 * (ways >> j & 1) for j in range(count - 1))])
    draws = np.random.default_rng(7).choice([-1.0, 1.0], (64, count, 10 * int(np.ceil(np.log2(count)))))
    likeness = np.einsum("kib,kjb->kij", draws, draws) - 2 * draws.shape[2] * np.eye(count)
    return draws[int(np.argmin(likeness.max((1, 2))))]


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed trigram that begins at each byte; one past the table where it would leave the text or holds gaps only."""
    low = LETTERS[data].astype(np.uint32)
    out = np.full(len(low), 1 << BITS, np.uint32)
    if len(low) > 2:
        joined = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
        out[:-2] = np.where(joined == 0x202020, 1 << BITS, (joined * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
        for back in (1, 2):
            at = offsets[1:] - back
            out[at[at >= offsets[:-1]]] = 1 << BITS
    return out


def fit(texts: list[str], languages: list[str], rounds: int = 80, rate: float = 0.5) -> Model:
    """Fits one logistic classifier for each bit of the code."""
    names = sorted(set(languages))
    code = codewords(len(names))
    bits = code.shape[1]
    weights, bias = np.zeros(((1 << BITS) + 1, bits)), np.zeros(bits)
    if not names:
        return Model(names, code, weights, bias)
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    seen, count = np.unique(row << 20 | trigrams(data, offsets), return_counts=True)
    row, column = seen >> 20, seen & 0xFFFFF
    real = column < 1 << BITS
    row, column, count = row[real], column[real], count[real]
    value = count / np.bincount(row, count, len(texts))[row]
    target = code[[names.index(x) for x in languages]]
    grown, grown_bias = np.full_like(weights, 1e-8), np.full(bits, 1e-8)
    for _ in range(rounds):
        for b in range(bits):
            margin = np.bincount(row, value * weights[column, b], len(texts)) + bias[b]
            gap = target[:, b] / (1 + np.exp(target[:, b] * margin)) / len(texts)
            slope = np.bincount(column, value * gap[row], len(weights)) - 1e-7 * weights[:, b]
            grown[:, b] += slope**2
            grown_bias[b] += gap.sum() ** 2
            weights[:, b] += rate * slope / np.sqrt(grown[:, b])
            bias[b] += 0.1 * rate * gap.sum() / np.sqrt(grown_bias[b])
    weights[-1] = 0
    return Model(names, code, weights.astype(np.float32), bias)


def margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Margin of every bit for every row: the mean weight of its trigrams."""
    grams = trigrams(data, offsets)
    sums, counts = np.zeros((len(offsets) - 1, len(model.bias))), np.zeros(len(offsets) - 1)
    for lo in range(0, len(grams), PIECE):
        part = grams[lo : lo + PIECE]
        bounds = np.clip(offsets, lo, lo + len(part)) - lo
        some = np.flatnonzero(bounds[1:] > bounds[:-1])
        sums[some] += np.add.reduceat(model.weights[part], bounds[some], axis=0, dtype=np.float64)
        counts[some] += np.add.reduceat((part < 1 << BITS).astype(np.int64), bounds[some])
    return sums / np.maximum(counts, 1)[:, None] + model.bias


def decode(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Losses of each language, least first, and the languages in that order."""
    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None]).sum(2)
    order = np.argsort(loss, axis=1, kind="stable")
    return np.take_along_axis(loss, order, 1), order


def predict(docs: DataFrame, model: Model, close: float = 0.2) -> DataFrame:
    """Language, confidence and an ambiguity flag of each document.

    ``docs`` has doc_id and text; other columns are dropped. A null text, one without a letter, and
    every text where the model knows no language get ``und`` with score 0, not ambiguous. Ties go to
    the language first in the alphabet. Equal rows give equal results.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(piece.column("text"))
        lettered = np.array(piece.column("lettered").to_numpy(zero_copy_only=False), bool)
        if not model.languages:
            lettered[:] = False
            name, score, near = np.zeros(len(lettered), int), np.zeros(len(lettered)), lettered.copy()
        else:
            loss, order = decode(model, margins(model, data, offsets))
            name = order[:, 0]
            score = 1 / np.exp(loss[:, :1] - loss).sum(1)
            near = (loss[:, 1] - loss[:, 0] < close) if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        names = np.array([*model.languages, UNKNOWN], object)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(names[np.where(lettered, name, len(names) - 1)], pa.string()), pa.array(np.where(lettered, np.clip(score, 0, 1), 0.0)), pa.array(lettered & near)],
            ["doc_id", "lang_pred", "score", "ambiguous"],
        )

    text = F.col("text").cast("string")
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return kept.mapInArrow(per_piece(work), "doc_id long, lang_pred string, score double, ambiguous boolean")
