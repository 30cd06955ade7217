"""Bounded samples of labelled texts for fitting a model on the driver, and the split into learning and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(modulus: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, per_class: int, longest: int) -> list[tuple[str, int]]:
    """At most ``per_class`` texts of each class, with the class.

    ``docs`` has doc_id and text, ``labels`` doc_id and label. The ids with the smallest hashes are
    taken, so the sample is the same in every run; texts above ``longest`` characters are not used
    to learn from, and of the texts of a repeated id the first in order is. Nulls and ids with several
    labels are left out.
    """
    one = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    one = one.where(F.col("label") == F.col("_most")).select("doc_id", "label")
    fit = docs.where(F.col("text").isNotNull() & (F.length("text") <= longest)).select("doc_id", F.length("text").alias("_n"))
    known = one.join(fit, "doc_id").select("doc_id", "label", F.xxhash64(F.col("doc_id")).alias("_order"))
    classes = [r[0] for r in known.select("label").distinct().limit(1000).collect()]
    picked = None
    for label in sorted(classes):
        part = known.where(F.col("label") == label).orderBy("_order", "doc_id").limit(per_class).select("doc_id", "label")
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return []
    # one text for each id, so that a repeated id does not widen the sample
    texts = docs.where(F.length("text") <= longest).select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label")).orderBy("doc_id").collect()
    return [(r["text"], r["label"]) for r in rows]
