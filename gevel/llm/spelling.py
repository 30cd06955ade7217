"""Spelling variants: words one edit apart, by search schemes over FM-indexes of the vocabulary read both ways.

With one edit between two words, one half of the first stands in the second unchanged. A search matches
that half exactly and goes on over the other half with at most one edit. Each step turns the interval of
suffix ranks that begin with the part matched so far into that of the part with one more character. Right
halves are matched in an index of the words as they are, left halves in one of the words reversed.

Words that share their first, or last, characters share an index, so the work grows with the vocabulary and
not with its square; the words of a crowded beginning are split by length and whole half, then into blocks.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gevel.functions.rows import settle
from gevel.llm.merkle import LOWER, UPPER
from gevel.session import cut_lineage

RUN = "[A-Za-zÀ-ÿ]+"
#: words that an index is meant to hold, and patterns searched at a time
WORDS, AT_ONCE = 10_000, 5_000


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the part they are compared on."""
    n, span = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - span, 0)] = rank[span:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n - 1:
            return order
        span *= 2


class Index:
    """FM-index of sorted, different words, each between two delimiters, which come before all characters."""

    def __init__(self, words: list[str]) -> None:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.alphabet = np.unique(codes)
        text = np.zeros(len(codes) + len(words) + 1, np.int64)
        text[np.arange(len(codes)) + np.repeat(np.arange(len(words)), size) + 1] = np.searchsorted(self.alphabet, codes) + 1
        self.n, self.count = len(text), len(words)
        self.before = text[suffix_ranks(text) - 1]  # the character before each suffix, in suffix order
        self.keys = np.sort(self.before * self.n + np.arange(self.n))

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of the characters; one that no word has gets a number no suffix begins with."""
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 1, len(self.alphabet) + 1)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with the symbol and then with what the given intervals stand for."""
        base = symbol * self.n
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def choices(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval and symbol for every character that stands before a suffix of the interval."""
        sigma = len(self.alphabet) + 1
        wide = high - low >= sigma
        few = np.flatnonzero(~wide)
        size = (high - low)[few]
        ends = np.cumsum(size)
        at = np.repeat(low[few] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        pairs = np.unique(np.repeat(few, size) * sigma + self.before[at])
        many = np.repeat(np.flatnonzero(wide), sigma - 1)
        state = np.concatenate([pairs // sigma, many])
        symbol = np.concatenate([pairs % sigma, np.tile(np.arange(1, sigma), int(wide.sum()))])
        return state[symbol > 0], symbol[symbol > 0]

    def one_edit(self, patterns: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (pattern, word) one edit apart whose last ``exact`` characters of the pattern are the word's."""
        size = np.fromiter(map(len, patterns), np.int64, len(patterns))
        flat = self.symbols(np.frombuffer("".join(patterns).encode("utf-32-le"), "<u4"))
        start = np.cumsum(size) - size
        which, left = np.arange(len(patterns)), size.copy()
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.count + 1)
        pick = lambda keep, *arrays: tuple(a[keep] for a in arrays)

        def forward(which, low, high, left):
            low, high = self.step(flat[start[which] + left - 1], low, high)
            return pick(high > low, which, low, high, left - 1)

        # the half without edits
        done: list[tuple] = []
        while len(which):
            ready = size[which] - left >= exact[which]
            done.append(pick(ready, which, low, high, left))
            which, low, high, left = forward(*pick(~ready, which, low, high, left))
        which, low, high, left = (np.concatenate(c) for c in zip(*done, strict=True)) if done else (which, low, high, left)
        edited = tuple(a[:0] for a in (which, low, high, left))
        found: list[tuple] = []
        while len(which) or len(edited[0]):
            # words with the edit behind them end at a delimiter, or go on unchanged
            ends = edited[3] == 0
            w, lo, hi, _ = pick(ends, *edited)
            lo, hi = self.step(np.zeros(len(w), np.int64), lo, hi)
            found.append(pick(hi > lo, w, lo - 1))
            edited = forward(*pick(~ends, *edited))
            # an edit here: another character, one more, or one less
            more = left > 0
            following = np.where(more, flat[np.minimum(start[which] + np.maximum(left - 1, 0), len(flat) - 1)], 0)
            state, symbol = self.choices(low, high)
            other = symbol != following[state]
            state, symbol = state[other], symbol[other]
            lo, hi = self.step(symbol, low[state], high[state])
            longer = (which[state], lo, hi, left[state])
            changed = pick(more[state], which[state], lo, hi, left[state] - 1)
            # of a run of one character its last is left out, which stands for all of the run
            last = more & ((left < 2) | (flat[np.maximum(start[which] + left - 2, 0)] != following))
            shorter = pick(last, which, low, high, left - 1)
            edited = tuple(np.concatenate(c) for c in zip(edited, longer, changed, shorter, strict=True))
            which, low, high, left = forward(*pick(more, which, low, high, left))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (which, low)


def search(words: list[str], patterns: list[str], left_half: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (pattern, word), as places in the lists, one edit apart with the named half of the pattern unchanged."""
    turned = (lambda w: w[::-1]) if left_half else (lambda w: w)
    order = sorted(range(len(words)), key=lambda i: turned(words[i]))
    index = Index([turned(words[i]) for i in order])
    out = []
    for at in range(0, len(patterns), AT_ONCE):
        part = [turned(p) for p in patterns[at : at + AT_ONCE]]
        size = np.fromiter(map(len, part), np.int64, len(part))
        a, b = index.one_edit(part, size // 2 if left_half else size - size // 2)
        out.append((a + at, np.array(order, np.int64)[b]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _half(word: Column, length: Column, left: bool) -> Column:
    """The half of a pattern of ``length`` characters that is matched exactly, as it stands in ``word``."""
    short = F.floor(length / 2).cast("int")
    return F.substring(word, F.lit(1), short) if left else F.right(word, length - short)


def _routes(vocabulary: DataFrame, least: int, words: int) -> DataFrame:
    """bucket, left (which half), word, n, is_text, is_pattern: words that can match exactly share a bucket."""
    total, stem = vocabulary.count(), least // 2
    sides = F.array(
        F.struct(F.lit(True).alias("left"), F.substring("word", 1, stem).alias("stem")), F.struct(F.lit(False).alias("left"), F.right(F.col("word"), F.lit(stem)).alias("stem"))
    )
    rows = vocabulary.select("word", "n", F.inline(sides))
    crowded = cut_lineage(rows.groupBy("left", "stem").count().where(F.col("count") > words).select("left", "stem", F.col("count").alias("crowd")))
    rows = rows.join(crowded, ["left", "stem"], "left")
    plain = rows.where("crowd IS NULL").select(
        F.concat_ws("/", F.lit("p"), "left", F.pmod(F.xxhash64("stem"), F.lit(max(1, ceil(total / words)))).cast("string")).alias("bucket"),
        "left", "word", "n", F.lit(True).alias("is_text"), F.lit(True).alias("is_pattern"),
    )
    crowd = crowded.agg(F.sum("crowd")).first()[0]
    if not crowd:
        return plain
    dense = rows.where("crowd IS NOT NULL").withColumn("own", F.length("word"))
    half = F.when(F.col("left"), _half(F.col("word"), F.col("length"), True)).otherwise(_half(F.col("word"), F.col("length"), False))
    near = F.filter(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1), lambda v: v >= least)
    texts = dense.select("left", "word", "n", F.explode(near).alias("length")).withColumn("half", half)
    patterns = dense.select("left", "word", "n", F.col("own").alias("length")).withColumn("half", half)
    key = ["left", "length", "half"]
    split = texts.groupBy(*key).count().where(F.col("count") > words).select(*key, F.ceil(F.col("count") / words).cast("int").alias("blocks"))
    split = cut_lineage(split)
    buckets = F.lit(max(1, ceil(3 * crowd / words)))
    place = F.concat_ws("/", F.lit("c"), "left", F.pmod(F.xxhash64(*key, "block"), buckets).cast("string"))
    texts = texts.join(split, key, "left").withColumn("block", F.pmod(F.xxhash64("word"), F.coalesce("blocks", F.lit(1))).cast("int"))
    patterns = patterns.join(split, key, "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    yes, no = F.lit(True), F.lit(False)
    return plain.unionByName(texts.select(place.alias("bucket"), "left", "word", "n", yes.alias("is_text"), no.alias("is_pattern"))).unionByName(
        patterns.select(place.alias("bucket"), "left", "word", "n", no.alias("is_text"), yes.alias("is_pattern"))
    )


def near_words(vocabulary: DataFrame, least: int = 7, words: int = WORDS) -> DataFrame:
    """word, near and near_n: ordered pairs of words of ``vocabulary`` (word, n; each once) exactly one edit apart; pairs may be repeated.

    An edit is one inserted, deleted or replaced code point. All words must have ``least`` code points or more.
    """

    def find(table: pa.Table) -> pa.Table:
        word, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        is_text, is_pattern = table.column("is_text").to_pylist(), table.column("is_pattern").to_pylist()
        texts = {w: i for i, w in enumerate(word) if is_text[i]}
        patterns = sorted({w for i, w in enumerate(word) if is_pattern[i]})
        names = list(texts)
        none = np.zeros(0, np.int64)
        a, b = search(names, patterns, table.column("left")[0].as_py()) if names and patterns else (none, none)
        pairs = np.unique(np.stack([a, b]), axis=1)
        near = pa.array(names, pa.string()).take(pa.array(pairs[1]))
        counts = n[np.fromiter(texts.values(), np.int64, len(texts))][pairs[1]] if names else none
        return pa.table({"word": pa.array(patterns, pa.string()).take(pa.array(pairs[0])), "near": near, "near_n": pa.array(counts, pa.int64())})

    return _routes(vocabulary, least, words).groupBy("bucket").applyInArrow(find, "word string, near string, near_n long")


def words_of(docs: DataFrame, least: int = 7, misspell: int = 31) -> DataFrame:
    """word and n, its occurrences, of the runs of letters in all texts, A-Z in lower case, of ``least`` code points or more.

    Where ``misspell`` divides the crc32 of doc_id and run, the run lacks one code point. Null texts have no
    words; a null doc_id counts as the empty text.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc"), F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("_run"))
    runs = runs.where(F.length("_run") >= least).select("_doc", F.translate("_run", UPPER, LOWER).alias("_run"))
    hashed = settle(runs, "_run", F.crc32(F.concat("_doc", F.lit(":"), "_run").cast("binary")).alias("_h"), F.length("_run").alias("_n"))
    at = (F.col("_h") % F.col("_n")).cast("int")
    lacking = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.col("_n")))
    word = F.when(F.col("_h") % misspell == 0, lacking).otherwise(F.col("_run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


def variants(vocabulary: DataFrame, least: int = 7, ratio: int = 10, words: int = WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of ``vocabulary`` (word, n; each word once).

    The form of a word is its most frequent near word, the first in code-point order on a tie, if that is
    ``ratio`` times as frequent or more; the root is the last word that forms lead to, or the word itself. An
    empty vocabulary gives no rows.
    """
    vocabulary = cut_lineage(vocabulary)
    pairs = near_words(vocabulary, least, words).groupBy("word", "near").agg(F.first("near_n").alias("near_n"))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("of"), "near")).alias("best"))
    rows = vocabulary.join(best, "word", "left")
    taken = -F.col("best.of") >= ratio * F.col("n")
    rows = cut_lineage(
        rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.of")).alias("form_n"))
    )
    # each form is more frequent by the ratio, which bounds the length of a chain; each round doubles what is followed
    ups = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(64 / log2(ratio)))):
        further = ups.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ups = cut_lineage(ups.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")))
    return rows.join(ups, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def sql(least: int = 7, misspell: int = 31, ratio: int = 10) -> str:
    """The same rows by DuckDB over the table ``documents``."""
    table = [reduce(lambda c, _: c >> 1 ^ (0xEDB88320 if c & 1 else 0), range(4), i) for i in range(16)]
    text = "hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run))"
    nibble = "strpos('0123456789ABCDEF', {}[{}]) - 1"
    digits = f"flatten(list_transform(range(length({text}) // 2), lambda i: [{nibble.format(text, '2 * i + 2')}, {nibble.format(text, '2 * i + 1')}]))".replace(text, "t")
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda c, d: xor(c >> 4, ({table})[(xor(c, d) & 15) + 1])), 4294967295)"
    return f"""
        WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '{RUN}')), '{UPPER}', '{LOWER}') AS run FROM documents),
        occ AS (SELECT doc_id, run, {text} AS t, count(*) AS c FROM runs WHERE length(run) >= {least} GROUP BY doc_id, run),
        hashed AS (SELECT run, c, {crc} AS h FROM occ),
        spelt AS (SELECT CASE WHEN h % {misspell} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
        v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spelt WHERE length(word) >= {least} GROUP BY word HAVING sum(c) >= 2),
        cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
        near AS (
          SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
        ranked AS (SELECT word, near, n, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS r, count(*) OVER (PARTITION BY word) AS n_near FROM near),
        f AS (SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= {ratio} * v.n THEN r.near END AS form, CASE WHEN r.n >= {ratio} * v.n THEN r.n END AS form_n
          FROM v LEFT JOIN ranked r ON v.word = r.word AND r.r = 1),
        chain AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM chain c JOIN f ON c.at = f.word WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
        FROM f JOIN chain c ON f.word = c.word JOIN f AS top ON c.at = top.word WHERE top.form IS NULL"""
