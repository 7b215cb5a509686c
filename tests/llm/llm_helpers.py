"""Documents for the tests of the training-data operators."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use inside.
CLASHING = ["key", "body", "row", "id", "size", "kept", "_unit", "_size", "_k", "unit", "n", "n_words", "_cut", "copies", "a.b", "row.x", "q`r"]


def words_of(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def make(spark, rows, clashing: bool = False):
    """Documents from (doc_id, text[, lang[, source]]) rows."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
    return df


def prose(seed: int, n: int) -> str:
    """Made-up words; equal seeds give equal texts."""
    import random

    draw = random.Random(seed)
    return " ".join("".join(draw.choice(["ba", "ne", "ti", "or", "ul", "sk"]) for _ in range(draw.randint(1, 4))) for _ in range(n))
