"""Merkle manifest of a table: a tree for each shard, a tree over the shards, and a proof for every row.

Proofs are made by pointer jumping. A node knows the siblings on its way to an ancestor; a self-join puts
the ancestor's own way behind it, which doubles the distance, until every way ends at the root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gevel.functions.rows import settle
from gevel.llm.ranking import number
from gevel.session import cut_lineage

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = "array<struct<left:string,right:string,digest:string>>"


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def field(value: Column) -> Column:
    """A value so that no two rows run together: its length in bytes, a colon and itself; null is a dash."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _none() -> Column:
    return F.array().cast(_STEPS)


def _key() -> Column:
    return F.concat_ws("/", "level", "index", "tree")


@dataclass
class _Grown:
    pointers: list[DataFrame]
    tops: DataFrame
    levels: int


def _grow(nodes: DataFrame, most: int) -> _Grown:
    """Whole trees over ``nodes`` (tree, index, n, level, digest, key), ``n`` nodes in each tree and at most ``most``.

    Gives the pointers of every node to its parent (node, ancestor, steps), the last node of each tree and
    the number of levels of the highest tree.
    """
    pointers, tops, levels = [], [], 0
    while True:
        tops.append(nodes.where("n = 1").select("tree", "digest", "key"))
        if most <= 1:
            break
        levels, most = levels + 1, -(-most // FAN)
        members = F.sort_array(F.collect_list(F.struct("index", "digest", "key")))
        runs = nodes.where("n > 1").groupBy("tree", F.expr(f"index div {FAN}").alias("run")).agg(members.alias("members"), F.first("n").alias("n"), F.first("level").alias("level"))
        above = runs.select(
            "tree", F.col("run").alias("index"), F.ceil(F.col("n") / FAN).cast("long").alias("n"), (F.col("level") + 1).alias("level"),
            digest(F.array_join("members.digest", "")).alias("digest"), "members",
        )
        above = cut_lineage(above.withColumn("key", _key()))
        pointers.append(
            above.select(F.col("key").alias("ancestor"), F.col("digest").alias("up"), "members", F.posexplode("members").alias("at", "member")).select(
                F.col("member.key").alias("node"), "ancestor", F.array(_step("members.digest", F.col("at"), F.col("up"))).alias("steps")
            )
        )
        nodes = above.drop("members")
    every = tops[0]
    for more in tops[1:]:
        every = every.unionByName(more)
    return _Grown(pointers, every, levels)


def _step(digests: str, at: Column, up: Column) -> Column:
    """The other digests of a run, before and after the place, and the digest of the run."""
    return F.struct(
        F.array_join(F.slice(digests, F.lit(1), at), "").alias("left"), F.array_join(F.slice(digests, at + 2, F.lit(FAN)), "").alias("right"), up.alias("digest")
    )


def jump(pointers: DataFrame, levels: int) -> DataFrame:
    """Pointers to the root from pointers to parents, in as many self-joins as ``levels`` can be halved."""
    distance = 1
    while distance < levels:
        further = pointers.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_next"), F.col("steps").alias("_more"))
        pointers = cut_lineage(
            pointers.join(further, "ancestor", "left").select(
                "node", F.coalesce("_next", "ancestor").alias("ancestor"), F.concat("steps", F.coalesce("_more", _none())).alias("steps")
            )
        )
        distance *= 2
    return pointers


def proofs(leaves: DataFrame) -> DataFrame:
    """doc_id, leaf, tampered, subroot, root and steps of every row of ``leaves`` (doc_id, shard, leaf, tampered).

    Leaves of a shard stand in order of doc_id, null first, then of leaf; shards in order of their name, null
    first. ``steps`` are the siblings before and after the node at each level up to the root. Runs of eight
    share the way of their parent, so only the inner nodes take part in the jumps. No group is larger
    than a run; a shard of any size is numbered by ranges.
    """
    tree = F.when(F.col("shard").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("shard").cast("string")))
    rows = cut_lineage(leaves.select("doc_id", tree.alias("tree"), "leaf", "tampered", F.monotonically_increasing_id().alias("row")))
    placed = number(rows, "tree", "doc_id", "leaf", "row", name="index")
    sizes = cut_lineage(placed.groupBy("tree").agg((F.max("index") + 1).alias("n")))
    trees, most = sizes.agg(F.count("*"), F.max("n")).first()
    members = F.sort_array(F.collect_list(F.struct("index", "leaf", "doc_id", "tampered")))
    runs = placed.groupBy("tree", F.expr(f"index div {FAN}").alias("index")).agg(members.alias("members")).join(sizes, "tree")
    alone = F.col("n") == 1
    runs = runs.select(
        "tree", "index", "members", alone.alias("alone"), F.when(alone, 0).otherwise(1).alias("level"), F.ceil(F.col("n") / FAN).cast("long").alias("n"),
        F.length(F.conv((F.col("n") - 1).cast("string"), 10, FAN)).alias("depth"),
        F.when(alone, F.col("members")[0]["leaf"]).otherwise(digest(F.array_join("members.leaf", ""))).alias("digest"),
    )
    runs = cut_lineage(runs.withColumn("key", _key()))
    shards = _grow(runs.select("tree", "index", "n", "level", "digest", "key"), -(-(most or 0) // FAN))
    tops = number(cut_lineage(shards.tops.withColumn("forest", F.lit(""))), "forest", "tree", name="index")
    over = tops.select(F.lit("").alias("tree"), "index", F.lit(trees).cast("long").alias("n"), F.lit(0).alias("level"), "digest", "key")
    forest = _grow(over, trees)
    ways = None
    for part in shards.pointers + forest.pointers:
        ways = part if ways is None else ways.unionByName(part)
    if ways is not None:
        ways = jump(cut_lineage(ways), shards.levels + forest.levels)
        runs = runs.join(ways.select(F.col("node").alias("key"), "steps"), "key", "left")
    else:
        runs = runs.withColumn("steps", _none())
    each = settle(runs.select("digest", "members", "steps", "alone", "depth", F.posexplode("members").alias("at", "member")))
    own = F.when(F.col("alone"), _none()).otherwise(F.array(_step("members.leaf", F.col("at"), F.col("digest"))))
    each = settle(
        each, F.col("member.doc_id").alias("doc_id"), F.col("member.leaf").alias("leaf"), F.col("member.tampered").alias("tampered"), "alone", "depth",
        F.concat(own, F.coalesce("steps", _none())).alias("steps"),
    )
    subroot = F.when(F.col("alone"), F.col("leaf")).otherwise(F.get("steps", F.col("depth") - 1)["digest"])
    root = F.coalesce(F.get("steps", F.size("steps") - 1)["digest"], F.col("leaf"))
    return each.select("doc_id", "leaf", "tampered", subroot.alias("subroot"), root.alias("root"), "steps")


def fold(leaf: Column, steps: str = "steps") -> Column:
    """The root that a leaf and the siblings of its way give."""
    return F.aggregate(steps, leaf, lambda now, s: digest(s.left, now, s.right))


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """Leaf, roots and checked proof of every document; rows where ``changed`` holds are checked with their text in lower case.

    A null in any column has a mark of its own, so null and empty differ; repeated rows are leaves of their own;
    a null doc_id stands before all others of its lang and is checked unchanged; an empty table gives no rows.
    """
    kept = docs.select(*[F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS])
    head = F.concat(*[field(F.col(c)) for c in FIELDS[:-1]])
    other = F.coalesce(changed, F.lit(False)) if changed is not None else F.lit(False)
    leaves = kept.select(
        "doc_id", F.col("lang").alias("shard"), digest(head, field(F.col("text"))).alias("leaf"),
        F.when(other, digest(head, field(F.translate("text", UPPER, LOWER)))).alias("tampered"),
    )
    found = proofs(leaves)
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s.left, s.right)), "")
    found = settle(found, "doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), fold(F.coalesce("tampered", "leaf")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql(levels: int = 8, above: int = 4) -> str:
    """The same rows by DuckDB, level by level, for at most 8**levels documents of a lang and 8**above langs."""
    enc = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    head = " || ".join(enc.format(c) for c in FIELDS[:-1])
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    bits = "flatten(list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: list_transform(range(8), lambda b: (ascii(CAST(doc_id AS VARCHAR)[i + 1]) >> b) & 1)))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"
    ctes = [
        f"d AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, sha256({head} || {enc.format('text')}) AS leaf, sha256({head} || {enc.format(low)}) AS low, {crc} % 3 = 0 AS hit FROM documents)",
        "l0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n, '' AS proof, CASE WHEN hit THEN low ELSE leaf END AS folded FROM d)",
        "n0 AS (SELECT tree, i, n, leaf AS h FROM l0)",
    ]

    def climb(k: int) -> None:
        ctes.append(f"r{k} AS (SELECT tree, i // 8 AS i, list(h ORDER BY i) AS hs, any_value(n) AS n FROM n{k} GROUP BY tree, i // 8)")
        ctes.append(f"n{k + 1} AS (SELECT tree, i, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM r{k})")
        left, right = "coalesce(array_to_string(hs[:l.i % 8], ''), '')", "coalesce(array_to_string(hs[l.i % 8 + 2:], ''), '')"
        more = ", subroot" if k > levels else ""
        ctes.append(
            f"l{k + 1} AS (SELECT l.doc_id, l.leaf{more}, l.tree, l.i // 8 AS i, CASE WHEN r.n > 1 THEN l.proof || {left} || {right} ELSE l.proof END AS proof, "
            f"CASE WHEN r.n > 1 THEN sha256({left} || l.folded || {right}) ELSE l.folded END AS folded FROM l{k} l JOIN r{k} r ON l.tree = r.tree AND l.i // 8 = r.i)"
        )

    for k in range(levels):
        climb(k)
    t = levels
    ctes.append(f"n{t + 1} AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h, tree AS lang FROM n{t})")
    ctes.append(f"l{t + 1} AS (SELECT l.doc_id, l.leaf, n.h AS subroot, '' AS tree, n.i, l.proof, l.folded FROM l{t} l JOIN n{t + 1} n ON l.tree = n.lang)")
    for k in range(t + 1, t + 1 + above):
        climb(k)
    last = t + 1 + above
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT l.doc_id, l.leaf, l.subroot, n.h AS root, sha256(l.proof) AS proof_sha256, l.folded AS folded_root, l.folded = n.h AS verified FROM l{last} l, n{last} n"
    )
