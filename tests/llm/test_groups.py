"""Sharding, packing, quotations and top-k search: laws, brute force, SQL."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gevel.llm import covertree, packing, queries, quotes, sharding
from gevel.llm.ranking import number
from tests.llm import messy


def test_numbers_have_no_gaps(spark):
    rng = random.Random(1)
    rows = [(g, rng.randint(0, 9), i) for i, g in enumerate(rng.choices(["a", "b", "hot"], [1, 1, 8], k=900))]
    got = number(spark.createDataFrame(rows, "g string, x int, i int").repartition(7), "g", "x", "i").collect()
    for g in "a", "b", "hot":
        mine = sorted((r["number"], r["x"], r["i"]) for r in got if r["g"] == g)
        assert [n for n, _, _ in mine] == list(range(len(mine))) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def laws_of_rows(got, texts, shards):
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by_shard) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)


@pytest.mark.parametrize("shards", [1, 16])
def test_shards_of_odd_rows(spark, shards):
    got = sharding.shard(messy.frame(spark), shards).collect()
    laws_of_rows(got, [r[:2] for r in messy.rows()], shards)
    assert sharding.shard(messy.empty(spark), shards).count() == 0


def test_shards_query_keeps_copies_together(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op2_sharding(spark, sf).collect()
    laws_of_rows(got, list(docs.items()), 16)
    groups = defaultdict(set)
    for r in got:
        groups[docs[r["doc_id"]]].add(r["shard"])
    assert all(len(g) == 1 for g in groups.values())


def test_a_hot_group_takes_few_shards(spark):
    rows = [(i, "same") for i in range(300)] + [(1000 + i, f"text {i // 2}") for i in range(700)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    laws_of_rows(got, rows, 10)
    pairs = defaultdict(set)
    for r in got:
        pairs[dict(rows)[r["doc_id"]]].add(r["shard"])
    assert sum(len(v) > 1 for k, v in pairs.items() if k != "same") < 35  # of 350 pairs


def test_grants_stay_within_quota():
    wanted = {(0, 1, 3): 10, (0, 1, 1): 10, (1, 0, 2): 5, (2, 1, 0): 4}
    out = {g[:3]: g[3] for g in sharding.granted(wanted, np.array([0, 6, 0]))}
    moved = {k: n * out[k] for k, n in wanted.items()}
    assert moved[1, 0, 2] == 5 and sum(v for k, v in moved.items() if k[1] == 1) <= 5 + 6 + 1e-9
    assert moved[0, 1, 3] == pytest.approx(5 + 15 * 6 / 19) and (0, 1, 1) not in {k for k, v in moved.items() if v > 1e-9}


def test_bins_of_odd_rows(spark):
    rows = messy.rows()
    got = packing.pack(messy.frame(spark), capacity=500, per_source=2, block=30).collect()
    want, have = Counter(), Counter()
    for r in rows:
        n = len((r[1] or "").encode()) + 1
        want.update((r[0], p, p * 500, min(500, n - p * 500)) for p in range(-(-n // 500)))
    have.update((r["doc_id"], r["piece"], r["start"], r["size"]) for r in got)
    assert have == want
    bins = defaultdict(list)
    for r in got:
        bins[r["bin"]].append((r["place"], r["size"]))
    for pieces in bins.values():
        at = 0
        for place, size in sorted(pieces):
            assert place == at
            at += size
        assert at <= 500
    assert packing.pack(messy.empty(spark)).count() == 0


def test_conflicts_and_fit(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("abcdefgh") * rng.randint(1, 90), f"s{rng.randint(0, 5)}") for i in range(800)]
    texts = {i: (t, s) for i, t, s in rows}
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), capacity=100, per_source=1, block=400).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r["bin"]].append(r["doc_id"])
    for ids in bins.values():
        assert len({texts[i][0] for i in ids}) == len(ids) == len({texts[i][1] for i in ids})
    assert sum(len(t) + 1 for _, t, _ in rows) / 100 / len(bins) > 0.85


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10, 1)
    assert [bins.put(6, 1, 0), bins.put(7, 2, 0), bins.put(9, 4, 0)] == [(0, 0), (1, 0), (2, 0)]
    assert bins.put(3, 2, 0) == (0, 6)  # bin 1 is tighter but has the source
    assert bins.put(2, 8, 1) == (1, 7) and bins.put(1, 16, 0) == (2, 9)


def test_top_k_query(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.sql(queries.SQL["op6_top_k"]).fetchall()
    got = queries.op6_top_k(spark, sf).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("size, k, block", [(400, 20, 40), (15, 20, 4096), (300, 1, 50)])
def test_top_k_with_ties_and_odd_rows(spark, size, k, block):
    rng = np.random.default_rng(size)
    rows = [(i, [int(x) for x in rng.integers(-3, 4, 6)] if i % 4 else [1, 2, 0, 0, 0, 1]) for i in range(size)]
    odd = [(None, [1] * 6), (9001, None), (9002, [1, None, 1, 1, 1, 1]), (9003, [5]), (7, rows[7][1]), (9004, [])]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows + odd], "vec_id long, vector array<long>, score double, rank int")
    got = covertree.top_k(df, F.col("vec_id") % 20 == 0, k=k, block=block, group=8, leaf=(4, 8), pivots=5, sample=50).collect()
    wide = {i: np.array([*v, *[0] * (6 - len(v))]) for i, v in [*rows, (9003, [5]), (9004, [])]}
    want = []
    for q in (i for i in wide if i % 20 == 0):
        best = sorted(((-int(wide[q] @ v), i) for i, v in wide.items() if i != q))[:k]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)


@pytest.mark.parametrize("most", [100, 127, 128, 40000])
def test_top_k_of_many_shelves(spark, monkeypatch, most):
    """blocks of queries meet several shelves of blocks in several tasks, and none goes through the driver."""
    monkeypatch.setattr(covertree, "DEAL", 2)
    rng = np.random.default_rng(most)
    points = rng.integers(-most, most + 1, (420, 5))
    df = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in enumerate(points)], "vec_id long, vector array<long>")
    got = covertree.top_k(df, F.col("vec_id") % 5 == 0, k=7, block=4, group=4, leaf=(2, 2), pivots=6, sample=50)
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = []
    for q in range(0, 420, 5):
        best = sorted((-int(points[q] @ v), i) for i, v in enumerate(points) if i != q)[:7]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == sorted(want)


def test_top_k_of_nothing(spark):
    assert covertree.top_k(spark.createDataFrame([], "vec_id long, vector array<long>"), F.lit(True)).count() == 0


def talks():
    rng, rows = random.Random(1), []
    words = "alpha beta gamma delta hi thanks yes no ok when where".split()

    def lines(n):
        return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 4))) for _ in range(n)]

    for conv in range(60):
        own = []
        for turn in range(rng.randint(1, 9)):
            out = []
            for _ in range(rng.randint(0, 2)):
                if own and rng.random() < 0.7:
                    marks = rng.choice(["> ", ">", " >"]) * rng.randint(1, 3)
                    out += ["Bob wrote:"] * (rng.random() < 0.5) + [marks + x.upper() for x in rng.choice(own)]
                    if rng.random() < 0.4:
                        out += [marks + "> " + x for x in rng.choice(own)]
                out += lines(rng.randint(0, 2))
            out += lines(rng.randint(0, 3))
            own.append([x for x in out if not x.lstrip().startswith(">")])
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), "\n".join(out) if rng.random() < 0.97 else None))
    return [*rows, rows[3], rows[3], (5, 0, "user", "dup turn"), (None, 1, "user", "> x"), (4, None, "user", "y"), (None, 1, "user", "> x")]


def test_reply_order_against_sql(spark, tmp_path):
    df = spark.createDataFrame([(*r, 1, "x") for r in talks()], "conv_id long, turn long, role string, text string, seq int, parent string").repartition(4)
    df.write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    want = con.sql(quotes.SQL)
    got = quotes.reply_order(df).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
    assert any(r["depth"] and r["depth"] > 1 for r in got) and any(r["n_linked"] for r in got)
    assert quotes.reply_order(df.limit(0)).count() == 0


def test_one_reply(spark):
    rows = [(1, 0, "user", "How are you?\nAll well?"), (1, 1, "assistant", "fine"), (1, 2, "user", "On Monday A wrote:\n> how are  YOU?\n> All well?\nyes\n>> fine")]
    got = {r["turn"]: r for r in quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    last = got[2]
    assert (last["reply"], last["parent"], last["thread"], last["depth"], last["n_quotes"], last["n_linked"], last["place"]) == ("yes", 0, 0, 1, 2, 2, 1)
    assert got[1]["place"] == 2


def test_repeated_rows_are_dealt_over_the_blocks(spark):
    rows = [(5, "same", "s")] * 400 + [(None, "other", f"s{i % 2}") for i in range(400)] + [(i, f"text {i}", "s") for i in range(10, 410)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=100).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    for doc in (5, None):
        assert max(Counter(r["bin"] >> 32 for r in got if r["doc_id"] == doc).values()) < 100


@pytest.mark.parametrize("big", [2**31, -(2**31), 2**30])
def test_vectors_too_large_for_exact_scores(spark, big):
    rows = [(i, [i, 1]) for i in range(40)] + [(100, [big, 1])]
    with pytest.raises(ValueError, match="too large"):
        covertree.top_k(spark.createDataFrame(rows, "vec_id long, vector array<long>"), F.col("vec_id") % 20 == 0)
