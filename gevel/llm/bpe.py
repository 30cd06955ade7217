"""Byte-level BPE by the ranks of a public vocabulary: a perfect hash for whole words, a heap of merges for the others."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import cached_property
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.llm.arrays import SpanHash, mix, owner, per_piece, text_bytes

#: words that a worker process remembers besides the vocabulary; it starts anew when they are reached
REMEMBERED = 1 << 19
_SHIFT = 24
_PLACE = (1 << 40) - 1
# Letters and numbers of later Unicode versions than the one by which the tokenizer library splits texts.
LATER = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 \ua7f1 \uab6c-\uab6d "
    "\U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb "
    "\U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ea0-\U00016eb8 "
    "\U00016ebb-\U00016ed3 \U00016ff2-\U00016ff6 \U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 "
    "\U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 \U0001d6a6 "
    "\U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de "
    "\U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff "
    "\U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f"
)
_LATER = re.compile(f"[{LATER.replace(' ', '')}]")
#: a character of no class, which stands for those
_UNASSIGNED = "\u0378"
#: what a worker process keeps of each tokenizer between tasks: merges and remembered words
_kept: dict[bytes, dict] = {}


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The spans of ``data``, one behind the other."""
    ends = np.cumsum(sizes)
    return data[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class PerfectHash:
    """Minimal perfect hash: a number below n, each used once, for each of n different 64-bit keys.

    At each level every key that is left has a slot of its own or meets another key there; those that met go
    on to the next level. The number of a key is the count of taken slots before its own.
    """

    def __init__(self, keys: np.ndarray) -> None:
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two entries of the vocabulary have one hash")
        self.levels: list[tuple[np.ndarray, int]] = []
        before, left = 0, keys
        while len(left):
            slot = self._slot(left, len(self.levels), size := max(2 * len(left), 4))
            taken = np.bincount(slot, minlength=size) == 1
            self.levels.append((np.where(taken, before + np.cumsum(taken) - 1, -1), size))
            before += int(taken.sum())
            left = left[~taken[slot]]
        self.size = before

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; a key that is none of the n gets any number, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (number, size) in enumerate(self.levels):
            out[left] = number[self._slot(keys[left], level, size)]
            left = left[out[left] < 0]
        return out


class Tokenizer:
    """Ranks, the pattern that splits texts into words, and both tiers of the look-up."""

    def __init__(self, entries: dict[bytes, int], pattern: str) -> None:
        if len(entries) > 1 << _SHIFT:
            raise ValueError("vocabulary too large")
        self.pattern = pattern
        order = sorted(entries, key=entries.__getitem__)
        self.ids = np.array([entries[t] for t in order], np.int64)
        if len(np.unique(self.ids)) != len(order) or any(bytes([b]) not in entries for b in range(256)):
            raise ValueError("ranks must be different and cover every byte")
        self.data = np.frombuffer(b"".join(order), np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in order])])
        keys = SpanHash(self.data)(self.bounds[:-1], self.bounds[1:])
        self.hash = PerfectHash(keys)
        self.entry = np.zeros(len(order), np.int64)
        self.entry[self.hash(keys)] = np.arange(len(order))

    @staticmethod
    def load(path: str, pattern: str) -> Tokenizer:
        with open(path, "rb") as f:
            lines = [line.split() for line in f if line.strip()]
        return Tokenizer({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_pattern", "pairs", "single", "places", "_shared")}

    @cached_property
    def _pattern(self):
        return regex.compile(self.pattern)

    def split(self, text: str) -> list[str]:
        """The words of a text, which the merges do not leave."""
        if text.isascii() or not _LATER.search(text):
            return self._pattern.findall(text)
        return [text[m.start() : m.end()] for m in self._pattern.finditer(_LATER.sub(_UNASSIGNED, text))]

    @cached_property
    def _shared(self) -> dict:
        name = hashlib.sha256(self.data.tobytes() + self.bounds.tobytes() + self.ids.tobytes() + self.pattern.encode()).digest()
        return _kept.setdefault(name, {"known": {}})

    @cached_property
    def places(self) -> np.ndarray:
        """Entry of each id, -1 for ids that are none."""
        out = np.full(int(self.ids.max()) + 1, -1, np.int64)
        out[self.ids] = np.arange(len(self.ids))
        return out

    @cached_property
    def pairs(self) -> dict[int, int]:
        """Id of the entry that two entries make together; the two ids are the key."""
        if "pairs" in self._shared:
            return self._shared["pairs"]
        data, bounds = self.data.tobytes(), self.bounds.tolist()
        of = {data[a:b]: i for a, b, i in zip(bounds, bounds[1:], self.ids.tolist(), strict=False)}
        out = {}
        for token, i in of.items():
            for k in range(1, len(token)):
                left, right = of.get(token[:k]), of.get(token[k:])
                if left is not None and right is not None:
                    out[left << _SHIFT | right] = i
        self._shared["pairs"] = out
        return out

    @cached_property
    def single(self) -> list[int]:
        size = np.diff(self.bounds)
        out = np.zeros(256, np.int64)
        out[self.data[self.bounds[:-1][size == 1]]] = self.ids[size == 1]
        return out.tolist()

    def whole(self, words: list[bytes]) -> np.ndarray:
        """Id of each word that is an entry itself, else -1."""
        data = np.frombuffer(b"".join(words), np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(size) - size
        number = self.hash(SpanHash(data)(starts, starts + size))
        entry = self.entry[np.maximum(number, 0)]
        same = np.flatnonzero((number >= 0) & (np.diff(self.bounds)[entry] == size))
        mine, its = _gather(data, starts[same], size[same]), _gather(self.data, self.bounds[entry[same]], size[same])
        wrong = np.unique(np.repeat(np.arange(len(same)), size[same])[mine != its])
        out = np.full(len(words), -1, np.int64)
        same = np.delete(same, wrong)
        out[same] = self.ids[entry[same]]
        return out

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: of all neighbours the pair of least rank is joined, the first one on a tie, as long as there is one."""
        get, n = self.pairs.get, len(word)
        single = self.single
        ids = [single[b] for b in word]
        heap = [r << 40 | i for i, r in enumerate([get(a << _SHIFT | b) for a, b in zip(ids, ids[1:], strict=False)]) if r is not None]
        heapq.heapify(heap)
        ids.append(-1)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            top = pop(heap)
            rank, i = top >> 40, top & _PLACE
            j = after[i]
            if ids[i] < 0 or ids[j] < 0 or get(ids[i] << _SHIFT | ids[j]) != rank:
                continue  # one of the two has been joined to another since
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            before[k] = i
            if k < n and (r := get(rank << _SHIFT | ids[k])) is not None:
                push(heap, r << 40 | i)
            h = before[i]
            if h >= 0 and (r := get(ids[h] << _SHIFT | rank)) is not None:
                push(heap, r << 40 | h)
        return [x for x in ids if x >= 0]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as 32-bit little-endian numbers; null is empty."""
        words = [self.split(t) if t else [] for t in texts]
        known = self._shared["known"]
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*words).difference(known))
        if new:
            raw = [w.encode() for w in new]
            for word, data, i in zip(new, raw, self.whole(raw).tolist(), strict=True):
                ids = (i,) if i >= 0 else self.merge(data)
                known[word] = pack(f"<{len(ids)}I", *ids)
        return [b"".join(map(known.__getitem__, each)) for each in words]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and how many each has."""
        if len(ids) and (int(ids.max()) >= len(self.places) or (self.places[ids] < 0).any()):
            raise ValueError("an id is not in the vocabulary")
        entry = self.places[ids]
        size = np.diff(self.bounds)[entry]
        return _gather(self.data, self.bounds[entry], size), size


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype("<i8").tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def encode(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id, n_tokens and ids (32-bit little-endian numbers, one after the other) of every row.

    Whole texts are read; null and empty texts have no ids; repeated rows and null doc_ids are rows like any
    other; an empty table gives no rows. A text and its ids are held by one task, and no rows are shuffled.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        ids = tokenizer.encode(piece.column("text").to_pylist())
        count = pa.array([len(x) // 4 for x in ids], pa.int64())
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), count, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(per_piece(work), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """The rows of ``encoded`` (doc_id, n_tokens, ids) with the bytes that their ids stand for; an id that is none is an error."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(piece.column("text"))
        if (offsets % 4).any():
            raise ValueError("ids must have 32 bits each")
        out, size = tokenizer.decode(np.frombuffer(data.tobytes(), "<u4").astype(np.int64))
        row = owner(offsets // 4)
        total = np.bincount(row, weights=size, minlength=piece.num_rows).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), piece.column("n_tokens"), piece.column("text"), _binary(out, np.concatenate([[0], np.cumsum(total)]))], ["doc_id", "n_tokens", "ids", "decoded"]
        )

    kept = encoded.select("doc_id", "n_tokens", F.col("ids").alias("text"))
    return kept.mapInArrow(per_piece(work), "doc_id long, n_tokens long, ids binary, decoded binary")
