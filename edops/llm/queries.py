"""Registered queries of the training-data operators and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edops.llm import ann_tree, bloom_lm, hard_negatives, html_extract, langid, minhash, mixing, nn_descent, packing
from edops.llm import quality, sharding, substrings, variants
from edops.llm.common import TEXTS, arrow_rows, read
from edops.llm.oracles import ORACLES as ORACLES
from edops.session import stage

SHARDS = 8


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    dimensions = {
        "size": F.log2(F.octet_length("text") + 1),
        "lang": F.col("lang"),
        "source": F.col("source"),
        "doc_id": F.col("doc_id"),
    }
    placed = sharding.kd_shards(docs, dimensions, shards=SHARDS)
    return placed.select(
        F.col("key").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_dom_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


def tokenizer_path() -> str:
    """Place of the public tokenizer file that packing uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())
    return packed.drop("body").withColumnRenamed("key", "doc_id")


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    with arrow_rows(spark, TEXTS):
        judged = stage(quality.repetition(read(spark, sf_dir, "documents")), "quality")
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_min_max_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = minhash.near_duplicates(read(spark, sf_dir, "documents"), size=3, similarity=(85, 100))
    kept = F.col("key").eqNullSafe(F.col("component"))
    return near.select(
        F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept")
    )


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = nn_descent.near_duplicates(read(spark, sf_dir, "embeddings"))
    kept = F.col("key").eqNullSafe(F.col("component"))
    return near.select(
        F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept.alias("kept")
    )


def held_out(buckets: int, bucket: int) -> Column:
    """Whether crc32 of the document number, as text, falls into the bucket."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(buckets)) == bucket


def op8_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = bloom_lm.score(read(spark, sf_dir, "documents"), ~held_out(10, 0))
    scored = scored.withColumnRenamed("key", "doc_id").withColumn("held_out", held_out(10, 0))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(read(spark, sf_dir, "documents"), ~held_out(4, 2))
    found = found.withColumnRenamed("key", "doc_id").withColumn("held_out", held_out(4, 2))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeats = substrings.remove_repeats(read(spark, sf_dir, "documents"))
    return repeats.select(F.col("key").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, key = read(spark, sf_dir, "embeddings"), F.col("vec_id")
    label = F.when(key % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, key % 100 == 0, label=label)


def op12_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = ann_tree.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_kd_shards": op2_kd_shards,
    "op3_dom_trees": op3_dom_trees,
    "op4_linear_grouping": op4_linear_grouping,
    "op5_repetition": op5_repetition,
    "op6_min_max_hash": op6_min_max_hash,
    "op7_nn_descent": op7_nn_descent,
    "op8_bloom_lm": op8_bloom_lm,
    "op9_language_mixture": op9_language_mixture,
    "op10_repeats": op10_repeats,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_kmeans_tree": op12_kmeans_tree,
    "op13_variants": op13_variants,
}
