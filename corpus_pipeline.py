"""The corpus pipeline: five stages over ``documents``, each by one operator of ``edops.llm``.

Every stage works on all that its predecessor kept. The first four return the columns of
documents; the last one returns the pieces of the packed sequences. Extra columns pass
through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edops.llm import minhash, mixing, packing, quality, substrings
from edops.llm.common import ARROW_ROWS, TEXTS, arrow_rows, read, whole_row
from edops.llm.queries import tokenizer_path
from edops.session import stage


def _unit(key: str | Column, body: str | Column) -> Column:
    """One number for a document: its key and a hash of its text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.xxhash64(F.coalesce(key.cast("long"), F.lit(-1)), body).alias("_unit")


def _with_unit(docs: DataFrame) -> DataFrame:
    """(row, _unit): the row as a struct, so that no column name can clash."""
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(whole_row(docs.columns).alias("row"), _unit("doc_id", body))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rule or the repetition limits reject.

    Null and empty texts are rejected as too short; equal rows share a verdict and all stay
    or go; there are no ties.
    """
    # The result is not stored here, as its caller stores it, so the setting has to stay.
    spark.conf.set(ARROW_ROWS, str(TEXTS))
    return quality.repetition(docs, keep=tuple(docs.columns)).filter("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the smallest key.

    Rows that agree in key and text are one document. Texts without a word stay. Any key is
    smaller than a null one; of equal keys in a group the smaller hash of the text stays.
    """
    near = minhash.near_duplicates(docs)
    order = F.struct(F.col("key").isNull(), "key", "body")
    heads = near.filter("n_shingles > 0").groupBy("root").agg(F.min(order).alias("head")).select("head.key", "head.body")
    empty = near.filter("n_shingles = 0").select("key", "body")
    chosen = stage(heads.union(empty).select(_unit("key", F.col("body"))).distinct(), "pipeline-heads")
    # Both the join and the removal of repeated rows use the exchange by ``_unit``.
    kept = _with_unit(docs).join(chosen, "_unit", "left_semi")
    return kept.dropDuplicates(["_unit"]).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out word sequences that occur earlier; documents stay, with what is left of them."""
    cuts = substrings.remove_repeats(docs).filter("cut is not null")
    cuts = stage(cuts.select(_unit("key", F.col("body")), F.col("cut").alias("_cut")).dropDuplicates(["_unit"]), "pipeline-cuts")
    joined = _with_unit(docs).join(cuts, "_unit", "left")
    new = {
        "text": F.coalesce("_cut", "row.text"),
        "n_chars": F.when(F.col("_cut").isNull(), F.col("row.n_chars")).otherwise(F.length("_cut").cast("long")),
    }
    return joined.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents so that the sources meet their target weights; some are repeated.

    A null source is a source of its own, the last one; null and empty texts weigh nothing;
    equal rows are interchangeable, and no tie is left as the draws depend on the row alone.
    """
    return mixing.take(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences: one row per piece, with its sequence and place.

    Null and empty texts are the end token alone; equal rows are packed as often as they
    occur; ties in length go by key and text.
    """
    return packing.pack(docs, tokenizer_path()).drop("body").withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Signatures, draws and packing have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    with arrow_rows(spark, TEXTS):  # puts back what the quality stage sets
        for name, function in STAGES:
            docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
