"""Near-duplicate documents by min-max hashing over word shingles.

Signature: every permutation of the shingle hashes keeps its smallest and its largest
value, so ``n`` values cost ``n / 2`` hash evaluations. Bands of the signature propose
candidates; with 40 bands of 6 values a pair at similarity 0.85 is missed with a chance of
6e-9.

Candidates are not expanded into pairs. Texts with equal shingle sets are one class. Each
band bucket links its members to the smallest one, and the connected components of these
unconfirmed links are the neighbourhoods in which all links must lie. The full shingle sets
of a neighbourhood are compared exactly in blocks of at most ``BLOCK`` classes (a larger
neighbourhood is several blocks, each pair of blocks one row group), and each block pair
returns only a spanning forest of its confirmed links, which is all that the components of
the final graph need.

Defined cases: null and empty texts have no shingles, link with nothing and stay; a text
with fewer words than a shingle is one shingle of all its words; rows with equal keys are
one document with the same component; a null key is linked like any other and its
component is the smallest non-null key it reaches (null if none); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from edops.llm.common import TEXTS, arrow_rows, components
from edops.llm.words import Words, mix, rolling, slices, split_words, starts_of
from edops.session import stage

BANDS, ROWS = 40, 6
BLOCK = 256  # classes in a block
SHINGLES = 2048  # mean shingles per class above which blocks hold fewer classes


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, ordered by both."""
    hashes = rolling(words.hash, size)
    starts = np.flatnonzero(starts_of(words, size))
    text, value = words.text[starts], hashes[starts] if len(starts) else np.zeros(0, np.uint64)
    firsts, counts = words.firsts, words.counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):  # all words of a short text, hashed in order and marked by their number
        whole = np.zeros(len(short), np.uint64)
        for n in range(1, size):
            of = np.flatnonzero(counts[short] == n)
            if len(of):
                whole[of] = rolling(words.hash, n)[firsts[short[of]]]
        text, value = np.concatenate([text, short]), np.concatenate([value, whole])
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def min_max_signature(value: np.ndarray, first: np.ndarray, n: int, seed: int = 6) -> np.ndarray:
    """(sets, n) signature: minimum and maximum under each of n / 2 permutations.

    ``first`` is where each non-empty set starts in ``value``.
    """
    draws = np.random.default_rng(seed).integers(0, 1 << 63, (n // 2, 2), dtype=np.uint64)
    out = np.empty((len(first), n), np.uint64)
    for i, (a, b) in enumerate(draws):
        # A bijection of 64-bit numbers: odd factor, shift, odd factor.
        v = (value ^ b) * (a | np.uint64(1))
        v ^= v >> np.uint64(32)
        v *= np.uint64(0x9E3779B97F4A7C15)
        out[:, 2 * i] = np.minimum.reduceat(v, first)
        out[:, 2 * i + 1] = np.maximum.reduceat(v, first)
    return out


def _sign(size: int, bands: int, rows: int):
    """Per text: number of shingles, two hashes of the set, and one key per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, value = shingle_sets(split_words(part["text"], lower=True), size)
                n = np.bincount(text, minlength=len(part))
                full = np.flatnonzero(n)
                first = np.searchsorted(text, full)
                sets = np.zeros((2, len(part)), np.uint64)
                keys = np.zeros((len(full), bands), np.uint64)
                if len(full):
                    sets[0, full] = np.add.reduceat(mix(value), first)
                    sets[1, full] = np.add.reduceat(mix(value ^ np.uint64(0x5555555555555555)), first)
                    signature = min_max_signature(value, first, bands * rows).reshape(len(full), bands, rows)
                    for r in range(rows):
                        keys = mix(keys * np.uint64(31) + signature[:, :, r])
                    keys = mix(keys + np.arange(bands, dtype=np.uint64))
                bounds = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        part["body"],
                        pa.array(n.astype(np.int64)),
                        pa.array(sets[0].view(np.int64)),
                        pa.array(sets[1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.ravel().view(np.int64))),
                    ],
                    ["key", "body", "n", "set1", "set2", "bands"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, value = shingle_sets(split_words(part["text"], lower=True), size)
                bounds = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part["id"], part["area"], lists], ["id", "area", "shingles"])

    return run


def _compare(numerator: int, denominator: int):
    """Exact links inside each row's list of sets, as a spanning forest.

    A link has ``denominator * intersection >= numerator * union``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            members = batch["members"]
            for i in range(len(batch)):
                row = members.slice(i, 1).flatten()
                sets = row.field("shingles")
                pairs = _forest(
                    sets.flatten().to_numpy(zero_copy_only=False), sets.value_lengths().to_numpy(zero_copy_only=False),
                    numerator, denominator,
                )
                ids = row.field("id").to_numpy(zero_copy_only=False)
                left.append(ids[pairs[:, 0]])
                right.append(ids[pairs[:, 1]])
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(left), pa.int64()), pa.array(np.concatenate(right), pa.int64())], ["a", "b"]
                )

    return run


def _forest(value: np.ndarray, sizes: np.ndarray, numerator: int, denominator: int, columns: int = 8192) -> np.ndarray:
    """Spanning forest of the links between sets given one after the other."""
    m = len(sizes)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column) >= 2  # a shingle of one set adds nothing to any intersection
    place = np.cumsum(often) - 1
    keep = often[column]
    column, owner = place[column[keep]], owner[keep]
    common = np.zeros((m, m), np.float32)
    for at in range(0, int(often.sum()), columns):
        a, b = np.searchsorted(column, [at, at + columns])
        grid = np.zeros((m, columns), np.float32)
        grid[owner[a:b], column[a:b] - at] = 1
        common += grid @ grid.T
    common = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    linked = np.triu(denominator * common >= numerator * union, 1)
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i in range(m):
        for j in np.flatnonzero(linked[i]):
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((i, int(j)))
    return np.array(out, np.int64).reshape(-1, 2)


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    similarity: tuple[int, int] = (80, 100),
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """(key, body, n_shingles, component, root): one row per input row; ``body`` is a hash of the text.

    Two documents are linked when their shingle sets have ``similarity`` (numerator and
    denominator) or more; ``component`` is the smallest key that links reach. ``root`` tells
    components apart whose documents have no key or share one; it is null without shingles.
    """
    spark = docs.sparkSession
    text_ = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).cast("long").alias("key"), text_.alias("text"), F.xxhash64(text_).alias("body"))
    with arrow_rows(spark, TEXTS):
        signed = texts.mapInArrow(
            _sign(size, bands, rows), "key long, body long, n long, set1 long, set2 long, bands array<long>"
        )
        # ``id`` stands for a shingle set in all links.
        ident = F.when(F.col("n") > 0, F.xxhash64("set1", "set2", "n"))
        signed = stage(signed.select("key", "body", "n", "bands", ident.alias("id")), "minhash-signatures")
    full = signed.filter("id is not null")
    classes = full.groupBy("id").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("members"))
    classes = stage(classes, "minhash-classes")
    # One document speaks for its class.
    least = classes.select(F.col("id").alias("_id"), "least")
    heads = full.join(least, (F.col("id") == F.col("_id")) & F.col("key").eqNullSafe(F.col("least")))
    banded = heads.select("id", F.explode("bands").alias("band"))
    buckets = banded.groupBy(F.col("band").alias("_band")).agg(F.min("id").alias("head"), F.max("id").alias("_last"))
    buckets = buckets.filter("head < _last").select("_band", "head")
    near = banded.join(buckets, F.col("band") == F.col("_band")).filter("id <> head").select("id", "head")
    areas = stage(components(near, "id", "head"), "minhash-areas")
    chosen = heads.select("id", "key", "body").join(areas.withColumnRenamed("id", "_area_id"), F.col("id") == F.col("_area_id"))
    chosen = chosen.dropDuplicates(["id"]).select(
        "id", F.col("component").alias("area"), F.xxhash64(F.coalesce("key", F.lit(-1)), "body").alias("_unit")
    )
    unit = texts.withColumn("unit", F.xxhash64(F.coalesce("key", F.lit(-1)), "body"))
    with arrow_rows(spark, TEXTS):
        sets = unit.join(chosen, F.col("unit") == F.col("_unit")).select("id", "area", "text")
        sets = stage(sets.mapInArrow(_sets(size), "id long, area long, shingles array<long>"), "minhash-sets")
    if not sets.groupBy("id").count().filter("count > 1").isEmpty():  # whole rows repeat
        sets = sets.dropDuplicates(["id"])
    with arrow_rows(spark, 4):
        linked = components(_links(sets, similarity, block), "a", "b")
    roots = classes.join(linked.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").select(
        "id", "least", F.coalesce("component", "id").alias("root")
    )
    roots = stage(roots, "minhash-roots")
    smallest = roots.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component"))
    named = roots.join(smallest, F.col("root") == F.col("_root")).select(F.col("id").alias("_id"), "component", "root")
    out = signed.join(named, F.col("id") == F.col("_id"), "left")
    component = F.when(F.col("id").isNull(), F.col("key")).otherwise(F.col("component"))
    return out.select("key", "body", F.col("n").alias("n_shingles"), component.alias("component"), "root")


def _links(sets: DataFrame, similarity: tuple[int, int], block: int) -> DataFrame:
    """Confirmed links inside each neighbourhood, by pairs of blocks."""
    blocks = F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(block)), F.ceil(F.sum(F.size("shingles")) / F.lit(block * SHINGLES))
    )
    areas = sets.groupBy(F.col("area").alias("_area")).agg(blocks.alias("blocks"))
    dealt = sets.join(areas, F.col("area") == F.col("_area"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # A block meets itself and every other block once; the row goes to all its meetings.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = dealt.select("id", "area", "shingles", "mine", other.alias("other"))
    meeting = dealt.groupBy("area", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).agg(
        F.collect_list(F.struct("id", "shingles")).alias("members")
    )
    return meeting.filter(F.size("members") > 1).select("members").mapInArrow(
        _compare(*similarity), "a long, b long"
    )
