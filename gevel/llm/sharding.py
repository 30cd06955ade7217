"""Shards of equal size that keep linked documents together, by balanced label propagation.

Documents with one hub (here: one text) are linked with each other. Members of a hub in a shard are
alike, so a round works on counts: each hub wants to gather where most of its members are, and moves
between two shards are granted up to the room of the target plus what the target sends back, those
that save most links first. At the end documents without links fill up the shards exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gevel.llm.ranking import number
from gevel.session import cut_lineage


def _uniform(*columns: Column | str) -> Column:
    """A number from 0 to 1 that depends on the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def granted(wanted: dict[tuple[int, int, int], int], room: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Share of the wanted moves (from, to, class of gain) that may be made.

    From one shard to another goes as much as comes back, and the rest as far as there is room; classes
    of higher gain come first.
    """
    shards = len(room)
    total = np.zeros((shards, shards), np.int64)
    for (a, b, _), n in wanted.items():
        total[a, b] += n
    back = np.minimum(total, total.T)
    rest = total - back
    left = np.maximum(room, 0)
    sums = rest.sum(0)
    extra = np.where(sums > 0, rest * np.minimum(1.0, left / np.maximum(sums, 1)), 0)
    quota = back + extra
    out = []
    for (a, b, gain), n in sorted(wanted.items(), key=lambda x: -x[0][2]):
        share = min(1.0, max(0.0, quota[a, b] / n))
        quota[a, b] -= share * n
        out.append((a, b, gain, float(share)))
    return out


def propagate(members: DataFrame, shards: int, quota: int, rounds: int = 8) -> DataFrame:
    """Rows (hub, shard, members) after the rounds, from such rows; ``quota`` is the room of a shard for linked documents."""
    spark, state = members.sparkSession, cut_lineage(members)
    for turn in range(rounds):
        inside = Window.partitionBy("hub")  # at most one row for each shard
        best = F.max(F.struct(F.col("members").alias("n"), F.xxhash64("hub", "shard").alias("tie"), F.col("shard").alias("to"))).over(inside)
        offers = state.withColumn("best", best).select("hub", "shard", "members", F.col("best.to").alias("to"), F.floor(F.log2(F.col("best.n") - F.col("members") + 1)).cast("int").alias("gain"))
        sizes = np.zeros(shards, np.int64)
        for r in state.groupBy("shard").agg(F.sum("members").alias("n")).collect():
            sizes[r["shard"]] = r["n"]
        wanted = {(r["shard"], r["to"], r["gain"]): r["n"] for r in offers.where("shard <> to").groupBy("shard", "to", "gain").agg(F.sum("members").alias("n")).collect()}
        grants = [g for g in granted(wanted, quota - sizes) if g[3] > 0]
        if not grants:
            break
        table = spark.createDataFrame(grants, "shard int, to int, gain int, share double")  # at most shards squared times 64 rows
        drawn = F.floor(F.col("members") * F.coalesce("share", F.lit(0.0)) + _uniform("hub", "shard", F.lit(turn)))
        moved = F.when(F.col("share").isNull(), 0).otherwise(F.least("members", drawn)).cast("long")
        offers = offers.join(F.broadcast(table), ["shard", "to", "gain"], "left").withColumn("moved", moved)
        after = F.array(F.struct(F.col("shard").alias("shard"), (F.col("members") - F.col("moved")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("moved").alias("n")))
        state = cut_lineage(offers.select("hub", F.inline(after)).groupBy("hub", "shard").agg(F.sum("n").alias("members")).where("members > 0"))
    return state


def shard(docs: DataFrame, shards: int = 16, rounds: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, hub, shard and slot of every row of ``docs`` (doc_id, text).

    Row counts of shards are at most one apart, and slots of a shard run from 0 without gaps. Null and
    empty texts are one hub. A hub that no shard can hold is spread over several. Rows may repeat; an
    empty table gives no rows. Other columns are dropped.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text, F.octet_length(text)).alias("hub")
    )
    rows = cut_lineage(rows.withColumn("home", F.pmod(F.xxhash64("doc_id", "hub"), F.lit(shards)).cast("int")))
    total = rows.count()
    low, longer = divmod(total, shards)
    hubs = rows.groupBy("hub", "home").agg(F.count("*").alias("members"))
    sizes = hubs.groupBy("hub").agg(F.sum("members").alias("of")).where("of > 1")
    linked = hubs.join(sizes, "hub").select("hub", F.col("home").alias("shard"), "members")
    # some room beyond the even size lets hubs pass each other; the end evens it out
    placed = propagate(linked, shards, int(1.1 * (low + 1)), rounds)
    per_hub = placed.groupBy("hub").agg(F.sort_array(F.collect_list(F.struct("shard", "members"))).alias("kept"), F.sum("members").alias("of"))
    # a row of a spread hub draws its shard with the hub's shares
    draw = _uniform("doc_id", F.lit("draw")) * F.col("of")
    step = F.aggregate(
        "kept",
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("shard")),
        lambda acc, x: F.struct((acc["sum"] + x["members"]).alias("sum"), F.when((acc["shard"] < 0) & (draw < acc["sum"] + x["members"]), x["shard"]).otherwise(acc["shard"]).alias("shard")),
    )
    drawn = F.when(F.col("kept").isNull(), F.col("home")).when(F.size("kept") == 1, F.col("kept")[0]["shard"]).otherwise(F.greatest(step["shard"], F.lit(0)))
    # whole hubs first, the largest before; then hubs that are spread anyway; rows without links last.
    # The last ones are handed on where a shard is too full.
    rank = F.when(F.col("kept").isNull(), 1).when(F.size("kept") > 1, 0).otherwise(-F.col("of"))
    wished = rows.join(per_hub, "hub", "left").select("doc_id", "size", "text_crc32", "hub", drawn.alias("wish"), rank.alias("rank"))
    ranked = cut_lineage(number(wished, "wish", "rank", "hub", "doc_id", name="place"))
    count = np.zeros(shards, np.int64)
    for r in ranked.groupBy("wish").count().collect():
        count[r["wish"]] = r["count"]
    target = np.full(shards, low)
    target[np.argsort(-count, kind="stable")[:longer]] += 1
    over, under = np.maximum(count - target, 0), np.maximum(target - count, 0)
    sent, taken = np.cumsum(over) - over, np.cumsum(under) - under

    def of(values: np.ndarray, index: Column) -> Column:
        return F.element_at(F.array(*(F.lit(int(v)) for v in values)), index + 1).cast("long")

    spare = of(sent, F.col("wish")) + F.col("place") - of(target, F.col("wish"))
    moves = F.col("place") >= of(target, F.col("wish"))
    to = F.lit(-1)
    for s in range(shards):
        if under[s]:
            to = F.when((spare >= int(taken[s])) & (spare < int(taken[s] + under[s])), s).otherwise(to)
    final = ranked.withColumn("shard", F.when(moves, to).otherwise(F.col("wish")).cast("int"))
    slot = F.when(moves, of(np.minimum(count, target), F.col("shard")) + spare - of(taken, F.col("shard"))).otherwise(F.col("place"))
    return final.select("doc_id", "size", "text_crc32", "hub", "shard", slot.cast("long").alias("slot"))
