"""Conversations in reply order, with quotations linked to what they quote and taken out.

Only DataFrame operations: lines are split and levelled by expressions, passages are runs of lines of
one level, and normalised passages meet the messages of their conversation by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gevel.llm.ranking import number
from gevel.session import cut_lineage

PREFIX = r"^\s*>[>\s]*"
MESSAGE = ["conv_id", "seq"]


def norm(text: Column) -> Column:
    """Lower case, blanks joined, none outside."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def quoted_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, seq, at, level, body, run) of each line; lines that announce a quotation are left out.

    The level is the number of ``>`` in front. Lines of one level in a row have one ``run``.
    """
    lines = messages.select(*MESSAGE, F.posexplode(F.split("text", "\n")).alias("at", "line"))
    prefix = F.regexp_extract("line", PREFIX, 0)
    lines = lines.select(*MESSAGE, "at", F.length(F.regexp_replace(prefix, "[^>]", "")).alias("level"), F.expr(f"substring(line, length(regexp_extract(line, r'{PREFIX}', 0)) + 1)").alias("body"))
    inside = Window.partitionBy(*MESSAGE).orderBy("at")
    announces = F.col("body").rlike(r"(?i)wrote:\s*$") & (F.lead("level").over(inside) == F.col("level") + 1)
    lines = lines.withColumn("announces", F.coalesce(announces, F.lit(False))).where("NOT announces").drop("announces")
    changes = F.coalesce((F.col("level") != F.lag("level").over(inside)).cast("int"), F.lit(1))
    return lines.withColumn("changes", changes).withColumn("run", F.sum("changes").over(inside)).drop("changes")


def _joined(glue: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), glue)


def _roots(links: DataFrame, rounds: int = 64) -> DataFrame:
    """(conv_id, seq, thread, depth) for (conv_id, seq, parent): the first ancestor, by doubling steps."""
    now = cut_lineage(links.select(*MESSAGE, F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")))
    for _ in range(rounds):
        above = now.select("conv_id", F.col("seq").alias("thread"), F.col("thread").alias("upper"), F.col("depth").alias("more"))
        step = now.join(above, ["conv_id", "thread"], "left")
        if not step.where("upper IS NOT NULL").limit(1).count():
            return now
        now = cut_lineage(step.select(*MESSAGE, F.coalesce("upper", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
    raise RuntimeError("threads were not settled")


def reply_order(conversations: DataFrame) -> DataFrame:
    """One row for each message of ``conversations`` (conv_id, turn, role, text), in the order of replies.

    ``seq`` numbers a conversation by turn (then role, text); ``place`` puts every thread behind its first
    message and is gapless too. ``reply`` is the text without quoted lines. A message answers the one
    from which its outermost quotations come: a quoted passage, or a line of it, belongs to the first
    earlier message with the same own text; most matched characters win, then the later message. Equal
    rows are one message; a null text has no lines and stays null. Messages with a null conv_id or turn
    stand alone, with null numbers. Other columns are dropped.
    """
    kinds = {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    every = conversations.select(*(F.col(c).cast(k).alias(c) for c, k in kinds.items())).distinct()
    known = number(every.where("conv_id IS NOT NULL AND turn IS NOT NULL"), "conv_id", "turn", "role", "text", name="seq")
    quoting = known.where(F.col("text").rlike(r"(?m)" + PREFIX))
    lines = quoted_lines(known.join(quoting.select("conv_id").distinct(), "conv_id", "left_semi"))
    lines = cut_lineage(lines.withColumn("norm", norm(F.col("body"))))
    own, quoted = lines.where("level = 0"), lines.where("level > 0")
    passages = quoted.groupBy(*MESSAGE, "level", "run").agg(_joined(" ").alias("body"), F.count("*").alias("n"))
    texts = own.groupBy(*MESSAGE).agg(_joined("\n").alias("body"), F.count("*").alias("n"))
    wholes = passages.where("n > 1").select(*MESSAGE, "level", "run", norm(F.col("body")).alias("norm"))
    units = quoted.select(*MESSAGE, "level", "run", "norm").union(wholes).where("norm <> ''")
    units = units.select(*MESSAGE, "level", "run", F.length("norm").cast("long").alias("size"), F.sha2("norm", 256).alias("key"))
    sources = own.select(*MESSAGE, "norm").union(texts.where("n > 1").select(*MESSAGE, norm(F.col("body")).alias("norm")))
    # the first holder of a text, so that a phrase in very many messages makes no pairs
    sources = sources.where("norm <> ''").groupBy("conv_id", F.sha2("norm", 256).alias("key")).agg(F.min("seq").alias("source"))
    found = cut_lineage(units.join(sources, ["conv_id", "key"]).where("source < seq"))
    votes = found.where("level = 1").groupBy(*MESSAGE, "source").agg(F.sum("size").alias("size"))
    parents = cut_lineage(votes.groupBy(*MESSAGE).agg(F.max(F.struct("size", "source")).alias("best")).select(*MESSAGE, F.col("best.source").alias("parent")))
    linked = found.select(*MESSAGE, "level", "run").distinct().groupBy(*MESSAGE).agg(F.count("*").alias("n_linked"))
    counts = passages.groupBy(*MESSAGE).agg(F.count("*").alias("n_quotes"), F.max("level").cast("long").alias("quote_depth"))
    # the messages that quote are a part of all: they are joined among themselves first
    changed = counts.join(texts.select(*MESSAGE, "body"), MESSAGE, "left").join(linked, MESSAGE, "left").join(parents, MESSAGE, "left").join(_roots(parents), MESSAGE, "left")
    out = known.join(changed, MESSAGE, "left").select(
        *MESSAGE, "turn", "role", F.when(F.col("n_quotes").isNull(), F.col("text")).otherwise(F.coalesce("body", F.lit(""))).alias("reply"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_quotes", "quote_depth", "n_linked")), "parent", F.coalesce("thread", "seq").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
    out = number(out, "conv_id", "thread", "seq", name="place")
    alone = every.where("conv_id IS NULL OR turn IS NULL").withColumnRenamed("text", "reply")
    return out.unionByName(alone, allowMissingColumns=True)


SQL = r"""
WITH RECURSIVE every AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
known AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) - 1 AS seq FROM every),
split AS (SELECT conv_id, seq, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM known),
levels AS (
    SELECT conv_id, seq, pos, length(regexp_replace(regexp_extract(line, '^\s*>[>\s]*'), '[^>]', '', 'g')) AS level,
        substr(line, length(regexp_extract(line, '^\s*>[>\s]*')) + 1) AS body FROM split),
announced AS (
    SELECT *, coalesce(regexp_matches(body, '(?i)wrote:\s*$') AND lead(level) OVER (PARTITION BY conv_id, seq ORDER BY pos) = level + 1, false) AS drop_it FROM levels),
changes AS (
    SELECT conv_id, seq, pos, level, body, coalesce(CAST(level <> lag(level) OVER (PARTITION BY conv_id, seq ORDER BY pos) AS INT), 1) AS c
    FROM announced WHERE NOT drop_it),
lines AS (
    SELECT *, sum(c) OVER (PARTITION BY conv_id, seq ORDER BY pos) AS run, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) AS norm FROM changes),
passages AS (
    SELECT conv_id, seq, level, run, trim(regexp_replace(lower(string_agg(body, ' ' ORDER BY pos)), '\s+', ' ', 'g')) AS norm
    FROM lines WHERE level > 0 GROUP BY ALL),
texts AS (
    SELECT conv_id, seq, string_agg(body, chr(10) ORDER BY pos) AS body FROM lines WHERE level = 0 GROUP BY ALL),
units AS (
    SELECT conv_id, seq, level, run, norm FROM lines WHERE level > 0 AND norm <> ''
    UNION ALL SELECT p.conv_id, p.seq, p.level, p.run, p.norm FROM passages p
    WHERE norm <> '' AND (SELECT count(*) FROM lines l WHERE l.conv_id = p.conv_id AND l.seq = p.seq AND l.run = p.run) > 1),
sources AS (
    SELECT conv_id, norm, min(seq) AS source FROM (
        SELECT conv_id, seq, norm FROM lines WHERE level = 0
        UNION ALL SELECT conv_id, seq, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) FROM texts)
    WHERE norm <> '' GROUP BY ALL),
found AS (SELECT u.*, s.source FROM units u JOIN sources s ON u.conv_id = s.conv_id AND u.norm = s.norm AND s.source < u.seq),
parents AS (
    SELECT conv_id, seq, source AS parent FROM (
        SELECT conv_id, seq, source, row_number() OVER (PARTITION BY conv_id, seq ORDER BY sum(length(norm)) DESC, source DESC) AS r
        FROM found WHERE level = 1 GROUP BY conv_id, seq, source) WHERE r = 1),
above AS (
    SELECT conv_id, seq, parent AS thread, 1 AS depth FROM parents
    UNION ALL SELECT a.conv_id, a.seq, p.parent, a.depth + 1 FROM above a JOIN parents p ON a.conv_id = p.conv_id AND a.thread = p.seq),
roots AS (SELECT conv_id, seq, min(thread) AS thread, max(depth) AS depth FROM above GROUP BY ALL),
linked AS (SELECT conv_id, seq, count(DISTINCT (level, run)) AS n_linked FROM found GROUP BY ALL),
counts AS (SELECT conv_id, seq, count(*) AS n_quotes, max(level) AS quote_depth FROM passages GROUP BY ALL),
result AS (
    SELECT k.conv_id, k.seq, k.turn, k.role, CASE WHEN c.n_quotes IS NULL THEN k.text ELSE coalesce(t.body, '') END AS reply,
        CAST(coalesce(c.n_quotes, 0) AS BIGINT) AS n_quotes, CAST(coalesce(c.quote_depth, 0) AS BIGINT) AS quote_depth, CAST(coalesce(l.n_linked, 0) AS BIGINT) AS n_linked,
        p.parent, coalesce(r.thread, k.seq) AS thread, CAST(coalesce(r.depth, 0) AS BIGINT) AS depth
    FROM known k LEFT JOIN counts c USING (conv_id, seq) LEFT JOIN texts t USING (conv_id, seq) LEFT JOIN linked l USING (conv_id, seq)
    LEFT JOIN parents p USING (conv_id, seq) LEFT JOIN roots r USING (conv_id, seq))
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY thread, seq) - 1 AS place FROM result
UNION ALL SELECT DISTINCT conv_id, NULL, turn, role, text, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM conversations WHERE conv_id IS NULL OR turn IS NULL
"""
