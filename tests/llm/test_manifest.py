"""Merkle proofs against a plain recursive tree."""

import hashlib
import zlib

import duckdb
import pytest

from gevel.llm import merkle, queries
from tests.llm import messy


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(nodes):
    """Root, and for each node its siblings before and after at every level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
            ways[k].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
        nodes = [sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [place // 8 for place in at]
    return nodes[0], ways


def expected(rows):
    """rows: doc_id, text, lang, source, n_chars."""
    by_lang = {}
    for doc_id, text, lang, source, n_chars in rows:
        by_lang.setdefault(lang, []).append((doc_id, text, source, n_chars))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        docs = by_lang[lang]
        docs.sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(d[0], d[2], lang, d[3], d[1])))
        leaves = [leaf(d[0], d[2], lang, d[3], d[1]) for d in docs]
        trees[lang] = docs, leaves, *climb(leaves)
    root, tops = climb([trees[lang][2] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        docs, leaves, subroot, ways = trees[lang]
        for (doc_id, text, source, n_chars), mine, way in zip(docs, leaves, ways, strict=True):
            way = way + tops[k]
            now = mine
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                now = leaf(doc_id, source, lang, n_chars, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in way:
                now = sha(left, now, right)
            out.append((doc_id, mine, subroot, root, sha(*[x + y for x, y in way]), now, now == root))
    return sorted(out, key=repr)


def query(spark, rows, folder):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = queries.op11_merkle(spark, str(folder))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_odd_rows(spark, tmp_path):
    rows = [r[:5] for r in messy.rows()]
    rows = [(r[0], r[1], r[2], r[3], len(r[1] or "")) for r in rows]
    assert query(spark, rows, tmp_path) == expected(rows)


@pytest.mark.parametrize("sizes", [[1], [2], [8], [9], [1, 1], [64, 1, 65], [600, 3] + [1] * 12])
def test_tree_shapes(spark, tmp_path, sizes):
    rows = [(i, f"Text {i}", None if k == 0 else f"l{k}", "s", i % 7) for k, n in enumerate(sizes) for i in range(1000 * k, 1000 * k + n)]
    assert query(spark, rows, tmp_path) == expected(rows)


def test_sql_gives_the_same(spark, tmp_path):
    rows = [(i, f"Text {i}" if i % 5 else None, ["en", "é", "", None][i % 4 if i % 3 else 0], None if i % 7 else "", i) for i in range(300)]
    got = query(spark, rows, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.sql(merkle.sql()).fetchall(), key=repr) == got


def test_empty_table_and_clashing_columns(spark):
    assert merkle.manifest(messy.empty(spark)).collect() == []
    got = merkle.manifest(messy.frame(spark).withColumn("tree", merkle.F.lit(1)).withColumn("steps", merkle.F.lit(2)))
    assert got.count() == len(messy.rows()) and all(r["verified"] for r in got.collect())
