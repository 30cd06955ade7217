"""One query per operator over the whole tables, with the columns its contract names, and the SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gevel.llm import bpe, covertree, labelled, langid, merkle, packing, quality, quotes, sharding, simhash, spelling, suffix, toxicity, winnow
from gevel.session import cut_lineage


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def with_held_out(scored: DataFrame, modulus: int, rest: int, *columns: str | Column) -> DataFrame:
    return scored.select("doc_id", (labelled.remainder(modulus) == rest).alias("held_out"), *columns)


def quality_model(spark: SparkSession, sf: str) -> quality.Model:
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").where(labelled.remainder(3) != 1)
    rows = labelled.sample(docs, labels.select("doc_id", F.col("quality").alias("label")), per_class=1000, longest=8000)
    return quality.fit([t for t, _ in rows], [y for _, y in rows])


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of every document, with the tagged spans; labels are learnt from two thirds of the labelled rows."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").where(labelled.remainder(3) != 1)
    rows = labelled.sample(docs, labels.select("doc_id", F.col("toxic").alias("label")), per_class=2000, longest=6000)
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    return with_held_out(toxicity.score(docs, model), 3, 1, "score", "predicted", "spans")


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Sixteen shards with row counts at most one apart; equal texts are kept together."""
    out = sharding.shard(table(spark, sf, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Bin and place of every piece of every document, in sequences of 8192 bytes."""
    return packing.pack(table(spark, sf, "documents"))


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item, and the items."""
    out = winnow.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op5_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Every message without its quotations, linked to the one it answers, in reply order."""
    return quotes.reply_order(table(spark, sf, "conversations"))


def op6_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best inner products of every 20th vector with all others, on components in steps of 1/64."""
    rows = table(spark, sf, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64))
    vectors = rows.where(F.col("embedding").isNotNull() & finite).select("vec_id", steps.alias("vector"))
    return covertree.top_k(vectors, F.col("vec_id") % 20 == 0)


def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document; learnt from the languages of three quarters of the rows."""
    docs = table(spark, sf, "documents")
    labels = docs.where(labelled.remainder(4) != 2).select("doc_id", F.col("lang").alias("label"))
    rows = labelled.sample(docs, labels, per_class=300, longest=6000)
    model = langid.fit([t for t, _ in rows], [y for _, y in rows])
    return with_held_out(langid.predict(docs, model), 4, 2, "lang_pred", "score", "ambiguous")


def op8_suffix(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of every document that are left when 50-byte strings of earlier documents are cut out."""
    return suffix.dedup(table(spark, sf, "documents")).drop("kept")


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint of every document over 4-word shingles, and its component of links at 4 or fewer bits."""
    prints = cut_lineage(simhash.fingerprints(table(spark, sf, "documents"), words=4))
    out = simhash.near_groups(prints, tau=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document; learnt from the labels of two thirds of the labelled rows."""
    return with_held_out(quality.score(table(spark, sf, "documents"), quality_model(spark, sf)), 3, 1, "score", "predicted", "n_lines", "n_bad_lines")


def op11_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf, roots and proof of every document; every third is checked with its text in lower case."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return merkle.manifest(table(spark, sf, "documents"), changed=crc % 3 == 0)


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the documents with its more frequent spelling, one edit away, and the last one of such a chain."""
    words = spelling.words_of(table(spark, sf, "documents"), least=7, misspell=31)
    return spelling.variants(words.where("n >= 2"), least=7, ratio=10)


def op13_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as ids of a byte-level vocabulary, and the text that the ids give back."""
    tokenizer = bpe.Tokenizer.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    out = bpe.decode(bpe.encode(table(spark, sf, "documents"), tokenizer), tokenizer)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_decontaminate": op4_decontaminate,
    "op5_quotes": op5_quotes,
    "op6_top_k": op6_top_k,
    "op7_language": op7_language,
    "op8_suffix": op8_suffix,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_spelling": op12_spelling,
    "op13_bpe": op13_bpe,
}

SQL: dict[str, str] = {
    "op11_merkle": merkle.sql(),
    "op12_spelling": spelling.sql(),
    "op5_quotes": quotes.SQL,
    "op6_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id
        ), ranked AS (
            SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20""",
}
