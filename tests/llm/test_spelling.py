"""Spelling variants against all pairs of words, and the index against plain string search."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gevel.llm import queries, spelling
from tests.llm import messy


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(count):
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= 10 * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def words_of(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def test_suffix_order():
    for text in ([0, 1, 1, 1, 0], [0] * 50, list(np.random.default_rng(1).integers(0, 3, 200)), [0]):
        text = np.array(text, np.int64)
        assert spelling.suffix_ranks(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("letters, sizes", [("ab", (7, 10)), ("abé", (7, 9)), ("a", (7, 40)), ("abcdefgh", (7, 8))])
def test_search_schemes_find_all_pairs(letters, sizes):
    rng = random.Random(2)
    for _ in range(5):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(150)})
        patterns = words[::2] + ["zzzzzzz"]
        for left in (True, False):
            a, b = spelling.search(words, patterns, left)
            got = {(patterns[i], words[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
            assert all(one_edit(p, w) for p, w in got)
            half = (lambda p, w: p[: len(p) // 2] == w[: len(p) // 2]) if left else (lambda p, w: p[len(p) // 2 :] == w[len(p) // 2 - len(p) :])
            assert got == {(p, w) for p in patterns for w in words if one_edit(p, w) and half(p, w)}


@pytest.mark.parametrize("words", [15, 10_000])
def test_variants_with_and_without_crowds(spark, words):
    rng = random.Random(4)
    base = ["con" + "".join(rng.choice("abc") for _ in range(rng.randint(4, 6))) for _ in range(60)] + ["".join(rng.choice("abcde") for _ in range(7)) + "ing" for _ in range(20)]
    count = {w: rng.choice([2, 20, 200, 2000]) for w in base}
    for w in base:  # misspelt
        k = rng.randrange(len(w))
        if len(w) > 7:
            count.setdefault(w[:k] + w[k + 1 :], 2)
    got = spelling.variants(spark.createDataFrame(list(count.items()), "word string, n long"), words=words)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(count)


def test_chain_of_forms(spark):
    count = {"lettersxyz": 2, "lettersxy": 20, "lettersx": 200, "letters": 2000, "letterz": 200}
    got = spelling.variants(spark.createDataFrame(list(count.items()), "word string, n long"))
    assert {r["word"]: r["root"] for r in got.collect()} == dict.fromkeys(count, "letters")


def test_query_on_odd_rows(spark, tmp_path):
    extra = [(9000 + i, "Household HOUSEHOLD househould housewarming ÀÉéàöß×÷ÿ " * (1 + i % 3)) for i in range(40)] + [(7, "x" * 3000 + " " + "x" * 3000)]
    rows = [(r[0], r[1]) for r in messy.rows()] + extra
    messy.frame(spark).select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_spelling(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(words_of(rows))


def test_empty_tables(spark):
    assert spelling.variants(spelling.words_of(messy.empty(spark))).collect() == []
