"""One query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, chat, exact, extract, licences, neardup, negatives, packing, quality, topk, toxicity, variants, veclinks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    """The public vocabulary that the queries use; the operators take any path."""
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = f"{chat.END}{chat.START}assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    read = chat.read_conversations(chat.format_turns(turns.unionByName(extra), vocabulary()), vocabulary())
    return read.drop("n_tokens", "loss_tokens")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, vocabulary()), vocabulary())
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def not_held_out(mod: int, held: int) -> Column:
    """Whether a labelled row may be learnt from, by its ``doc_id``."""
    return remainder(mod) != held


def remainder(mod: int) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels, not_held_out(4, 2))
    return quality.score_quality(docs, model).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return toxicity.score_toxicity(docs, labels, not_held_out(5, 0)).select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "neighbours",
        "cosines",
    )


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = neardup.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs, licences.fit_licences(docs), with_text=True)


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return veclinks.vector_links(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 50; some labels are shifted by one."""
    vectors = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", shifted), F.col("vec_id") % 50 == 0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.corpus_words(table(spark, sf_dir, "documents"), slip=97)
    return variants.spelling_variants(words)


QUERIES = {
    "op1_chat": op1_chat,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_top_k": op4_top_k,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_html": op9_html,
    "op10_licences": op10_licences,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling": op13_spelling,
}
