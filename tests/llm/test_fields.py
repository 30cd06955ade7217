"""Conditional random fields, language codes, and what they learn on the test tables."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gevel.llm import crf, labelled, langid, quality, queries, toxicity
from gevel.llm.arrays import text_bytes
from tests.llm import messy

BIG = "/root/testdata/sf0.1"


@pytest.mark.parametrize("lengths", [[3, 0, 1, 130, 65, 64], [7], [0, 0], [200, 2]])
def test_messages_against_recursion(lengths):
    rng = np.random.default_rng(1)
    first = np.concatenate([[0], np.cumsum(lengths)])
    odds, pair = rng.normal(size=first[-1]) * 3, rng.normal(size=(2, 2))
    got = crf.messages(odds, first, pair)
    p = got.marginals()
    for a, b in itertools.pairwise(first):
        e = np.stack([np.zeros(b - a), odds[a:b]], 1)
        f, w = e.copy(), np.zeros_like(e)
        for t in range(1, b - a):
            f[t] += np.logaddexp(f[t - 1, 0] + pair[0], f[t - 1, 1] + pair[1])
        for t in range(b - a - 2, -1, -1):
            w[t] = np.logaddexp(pair[:, 0] + e[t + 1, 0] + w[t + 1, 0], pair[:, 1] + e[t + 1, 1] + w[t + 1, 1])
        both = f + w
        np.testing.assert_allclose(p[a:b], 1 / (1 + np.exp(both[:, 0] - both[:, 1])))


def test_pair_totals_against_all_paths():
    odds, pair, first = np.array([0.3, -1.0, 2.0, 0.1]), np.array([[0.2, -0.4], [0.7, 0.1]]), np.array([0, 4])
    want, total = np.zeros((2, 2)), 0.0
    for path in itertools.product((0, 1), repeat=4):
        weight = np.exp(sum(o for o, y in zip(odds, path) if y) + sum(pair[x, y] for x, y in itertools.pairwise(path)))
        total += weight
        for x, y in itertools.pairwise(path):
            want[x, y] += weight
    np.testing.assert_allclose(crf.messages(odds, first, pair).pair_totals(pair, first), want / total)


def truth(spark, label):
    rows = spark.read.parquet(f"{BIG}/labels.parquet").collect()
    return {r["doc_id"]: r[label] for r in rows}


def test_toxic_held_out(spark):
    want = truth(spark, "toxic")
    got = [r for r in queries.op1_toxicity(spark, BIG).collect()]
    assert len(got) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in want]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["predicted"] == want[r["doc_id"]] for r in held) / len(held) > 0.97


def test_quality_held_out(spark):
    want = truth(spark, "quality")
    held = [r for r in queries.op10_quality(spark, BIG).collect() if r["held_out"] and r["doc_id"] in want]
    assert sum(r["predicted"] == want[r["doc_id"]] for r in held) / len(held) > 0.97


def test_language_held_out(spark):
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op7_language(spark, BIG).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in held) / len(held) > 0.97


def test_spans_are_the_offending_words():
    rng = np.random.default_rng(2)
    vocabulary = np.array([a + b for a in ("river", "house", "stone", "green", "walk", "tree") for b in ("", "s", "ing", "ly", "er")])
    clean = [list(rng.choice(vocabulary, 12)) for _ in range(240)]
    bad = [[*c[: n % 11], f"vile{'abc'[n % 3]}", *c[n % 11 :]] for n, c in enumerate(clean)]
    model = toxicity.fit([" ".join(t) for t in clean + bad], [0] * len(clean) + [1] * len(bad))
    data, offsets = text_bytes(pa.array(["walks greenly vileb river", "trees walking", ""]))
    p, starts, ends, first = toxicity.tag(model, data, offsets)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert {w for w, x in zip(words, p) if x > 0.5} == {b"vileb"}


def test_lines_of_every_text():
    texts = ["a\nb", "", "x\n", "\n\n", None, "one"]
    data, offsets = text_bytes(pa.array(texts))
    starts, ends, first = quality.lines(data, offsets)
    got = [[data[a:b].tobytes().decode() for a, b in zip(starts[i:j], ends[i:j])] for i, j in itertools.pairwise(first)]
    assert got == [(t or "").split("\n") for t in texts]


@pytest.mark.parametrize("count", [0, 1, 2, 4, 6, 9, 40])
def test_codewords_differ(count):
    code = langid.codewords(count)
    assert len(code) == count
    assert all((a != b).sum() >= max(1, code.shape[1] // 4) for a, b in itertools.combinations(code, 2))


def test_odd_rows(spark):
    docs = messy.frame(spark)
    n = docs.count()
    for model in (toxicity.fit([], []), toxicity.fit(["good day", "bad day"], [0, 1])):
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == n and all(0 <= r["score"] <= 1 for r in rows)
    for model in (quality.fit([], []), quality.fit(["good day", "bad !! day"], [1, 0])):
        assert len(quality.score(docs, model).collect()) == n
        assert quality.keep(docs, model).columns == docs.columns
    for model in (langid.fit([], []), langid.fit(["le chat"], ["fr"]), langid.fit(["le chat", "the cat", "die Katze"], ["fr", "en", "de"])):
        rows = langid.predict(docs, model).collect()
        assert len(rows) == n
        assert {r["lang_pred"] for r in rows if r["doc_id"] in (400, 401, 402, 405)} == {"und"}
    none = messy.empty(spark)
    assert toxicity.score(none, toxicity.fit([], [])).count() == quality.score(none, quality.fit([], [])).count() == langid.predict(none, langid.fit([], [])).count() == 0
    assert labelled.sample(docs, docs.selectExpr("doc_id", "lang AS label"), 2, 1000) == labelled.sample(docs, docs.selectExpr("doc_id", "lang AS label"), 2, 1000)
    assert labelled.sample(none, none.selectExpr("doc_id", "lang AS label"), 2, 1000) == []


def test_measures_of_a_text_do_not_depend_on_the_one_before():
    for text in ("word", "word other", "other word\nword"):
        alone = quality.measures(*text_bytes(pa.array([text])))[0]
        after = quality.measures(*text_bytes(pa.array(["some other word", text, text])))[0]
        assert np.array_equal(after[1:], np.concatenate([alone, alone]))
