"""Removal of word sequences that also occur earlier, by seed and extend.

A word goes when a window of ``length`` consecutive words covers it whose sequence also
starts earlier (in a document with a smaller key, or earlier in the same document).

Seeds: winnowing picks in every window the ``seed``-word sequence of the smallest hash (the
last one on ties), so two equal windows always share a seed, and only about one word in
seven starts one. A join on the seeds leaves those that occur in two different texts; a
longer seed costs more of them but opens fewer texts that share it by chance.
Extension: a match is grown from a shared seed to both sides by two independent hashes of
each full window around it (128 bits), for all partners of a window at once: the smallest
document per window is a partial aggregate, so a passage that a third of all documents
share is neither expanded into pairs nor gathered in one task. Overlapping windows join
into maximal repeats.

Texts are read twice: once for the seeds, once joined to the documents that share any. The
windows of these are hashed twice, for the smallest document and for the join back to it,
as stored windows would take more disk than the texts they come from.
Exact copies of a whole text are settled by a hash of the text and not extended.

Defined cases: null and empty texts have no words and keep nothing; texts shorter than a
window lose nothing; rows that agree in key and text are one document and get the same
result; rows that share a key but not the text follow each other by a hash of the text; a
null key comes before every other; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from edops.llm.common import TEXTS, arrow_rows
from edops.llm.words import Words, rolling, second_hash, slices, split_words, starts_of
from edops.session import stage

LENGTH, SEED = 20, 8


def _seeds(words: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the place of each window's seed, and the hashes of all seeds."""
    hashes = rolling(words.hash, seed)
    starts = np.flatnonzero(starts_of(words, length))
    if not len(starts):
        return starts, starts, hashes
    span = length - seed + 1
    # Place of the smallest hash in every run of ``span`` seeds, the last on ties, by doubling.
    place, size = np.arange(len(hashes)), 1
    while size * 2 <= span:
        place = _lower(hashes, place[:-size], place[size:])
        size *= 2
    if size < span:
        place = _lower(hashes, place[: len(place) - (span - size)], place[span - size :])
    return starts, place[starts], hashes


def _lower(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.where(hashes[right] <= hashes[left], right, left)


def _lists(values: np.ndarray, text: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """Values grouped by their (ascending) text number."""
    bounds = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values).cast(kind))


def _plain(words: Words) -> list[bytes]:
    return [words.data[a:b].tobytes() for a, b in zip(words.bounds[:-1], words.bounds[1:])]


def _scan(length: int, seed: int):
    """Per text: number of words, hash of its words, its seeds, and its own repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part["text"])
                starts, place, hashes = _seeds(words, length, seed)
                value, owner = _distinct(hashes[np.unique(place)], words.text[np.unique(place)])
                windows = rolling(words.hash, length)[starts] if len(starts) else np.zeros(0, np.uint64)
                again = _again(words, starts, windows, length)
                sha = [hashlib.sha256(b" ".join(raw.split())).hexdigest() for raw in _plain(words)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        part["body"],
                        part["body2"],
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(sha, pa.string()),
                        _lists(value.view(np.int64), owner, len(part), pa.int64()),
                        _lists(starts[again] - words.firsts[words.text[starts[again]]], words.text[starts[again]], len(part), pa.int32()),
                    ],
                    ["key", "body", "body2", "n_words", "sha", "seeds", "own"],
                )

    return run


def _distinct(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (value, text) pairs in order of text."""
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], text[new]


def _again(words: Words, starts: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """Which windows repeat an earlier one of the same text, by both hashes."""
    if not len(windows):
        return np.zeros(0, np.int64)
    text = words.text[starts]
    order = np.lexsort((windows, text))  # stable: equal windows stay in word order
    same = (windows[order][1:] == windows[order][:-1]) & (text[order][1:] == text[order][:-1])
    equal = np.zeros(len(order), bool)
    equal[1:] = same
    equal[:-1] |= same
    rows = np.sort(order[equal])
    if not len(rows):
        return rows
    text, windows, other = text[rows], windows[rows], _other_windows(words, starts[rows], length)
    order = np.lexsort((other, windows, text))
    same = np.ones(len(order) - 1, bool)
    for values in (text, windows, other):
        same &= values[order][1:] == values[order][:-1]
    return np.sort(rows[order[1:][same]])


def _other_windows(words: Words, starts: np.ndarray, length: int) -> np.ndarray:
    """Second hash of the windows at ``starts``; only the words inside them are hashed."""
    edge = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    inside = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
    hashes = np.zeros(len(words.hash), np.uint64)
    hashes[inside] = second_hash(words.data, words.start[inside], words.end[inside])
    return rolling(hashes, length)[starts] if len(starts) else hashes[:0]


def _windows(length: int, seed: int):
    """Hashes and start of every first-in-its-text window whose seed is shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part["text"])
                starts, place, hashes = _seeds(words, length, seed)
                if not len(starts):
                    continue
                shared = part["seeds"]
                flat = shared.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                owner = np.repeat(np.arange(len(part)), shared.value_lengths().fill_null(0).to_numpy())
                text = words.text[starts]
                hit = _pairs_in(hashes[place], text, flat, owner)
                windows = rolling(words.hash, length)[starts]
                hit[_again(words, starts, windows, length)] = False
                starts, text, windows = starts[hit], text[hit], windows[hit]
                other = _other_windows(words, starts, length)
                take = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"].take(take),
                        part["body"].take(take),
                        pa.array((starts - words.firsts[text]).astype(np.int32)),
                        pa.array(windows.view(np.int64)),
                        pa.array(other.view(np.int64)),
                    ],
                    ["key", "body", "start", "window", "window2"],
                )

    return run


def _pairs_in(value: np.ndarray, group: np.ndarray, known: np.ndarray, known_group: np.ndarray) -> np.ndarray:
    """Which (value, group) pairs are among the known ones."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return np.isin(value + group.astype(np.uint64) * step, known + known_group.astype(np.uint64) * step)


def _cut(length: int):
    """Text without the covered words, their number, and the hash of the kept words.

    A kept word keeps the white space after it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part["text"])
                firsts = words.firsts
                gone = np.zeros(len(words.hash) + 1, np.int64)
                for name in ("starts", "own"):
                    lists = part[name]
                    at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    at = at + np.repeat(firsts[:-1], lists.value_lengths().fill_null(0).to_numpy())
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + length, -1)
                kept = np.cumsum(gone)[:-1] == 0
                texts, shas, removed = [], [], []
                for i, raw in enumerate(_plain(words)):
                    a, b = firsts[i], firsts[i + 1]
                    keep = kept[a:b]
                    pieces = list(compress(raw.split(), keep))
                    until = np.append(words.start[a + 1 : b], words.bounds[i + 1])
                    texts.append(
                        b"".join(words.data[s:e].tobytes() for s, e in _runs(words.start[a:b], until, keep)).decode()
                    )
                    shas.append(hashlib.sha256(b" ".join(pieces)).hexdigest())
                    removed.append(int(b - a) - len(pieces))
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["body"], pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())],
                    ["key", "body", "removed", "sha", "cut"],
                )

    return run


def _runs(start: np.ndarray, until: np.ndarray, keep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of runs of kept words."""
    edge = np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8))
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        yield int(start[a]), int(until[b - 1])


def _same_document(left: str, right: str) -> Column:
    return F.col(f"{left}.key").eqNullSafe(F.col(f"{right}.key")) & (F.col(f"{left}.body") == F.col(f"{right}.body"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED
) -> DataFrame:
    """One row per document: key, body (hash of its text), n_words, n_removed, kept_sha256, cut.

    ``cut`` is the text without the removed words, null where nothing is removed.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("key"), body.alias("text"),
        F.xxhash64(body).alias("body"), F.xxhash64(F.lit(1), body).alias("body2"),
    )
    spark = docs.sparkSession
    scan = rows.mapInArrow(
        _scan(length, seed),
        "key long, body long, body2 long, n_words long, sha string, seeds array<long>, own array<int>",
    )
    with arrow_rows(spark, TEXTS):
        scanned = stage(scan, "repeat-scan")
    # Whole copies: all but those with the smallest key lose every word.
    copies = scanned.filter(F.col("n_words") >= length).groupBy("body", "body2").agg(
        F.min(F.struct("key")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    copies = copies.filter("n > 1").select(F.col("body").alias("_b"), F.col("body2").alias("_b2"), "first.key")
    later = scanned.join(copies.withColumnRenamed("key", "_first"), (F.col("body") == F.col("_b")) & (F.col("body2") == F.col("_b2")))
    later = later.filter(F.col("key") > F.coalesce(F.col("_first"), F.col("key") - 1)).select("key", "body").distinct()
    later = stage(later, "repeat-copies")

    seeds = scanned.select("key", "body", F.explode("seeds").alias("seed"))
    shared = seeds.groupBy(F.col("seed").alias("_seed")).agg(F.min("body").alias("lo"), F.max("body").alias("hi"))
    shared = shared.filter("lo <> hi").select("_seed")
    touched = seeds.join(shared, F.col("seed") == F.col("_seed")).select("key", "body", "seed")
    touched = touched.alias("t").join(later.alias("l"), _same_document("t", "l"), "left_anti")
    touched = touched.groupBy("key", "body").agg(F.collect_set("seed").alias("seeds"))
    own = scanned.filter(F.size("own") > 0).dropDuplicates(["key", "body"]).select("key", "body", "own")
    own = own.alias("o").join(later.alias("l"), _same_document("o", "l"), "left_anti")
    none = F.array().cast("array<long>")
    touched = touched.alias("t").join(own.alias("o"), _same_document("t", "o"), "full_outer").select(
        F.coalesce("t.key", "o.key").alias("key"),
        F.coalesce("t.body", "o.body").alias("body"),
        F.coalesce("t.seeds", none).alias("seeds"),
        F.coalesce("o.own", none.cast("array<int>")).alias("own"),
    )
    open_ = stage(
        rows.alias("d").join(touched.alias("t"), _same_document("d", "t")).select("d.key", "d.body", "d.text", "t.seeds", "t.own"),
        "repeat-texts",
    )
    windows = open_.filter(F.size("seeds") > 0).select("key", "body", "text", "seeds").mapInArrow(
        _windows(length, seed), "key long, body long, start int, window long, window2 long"
    )
    # Where keys are distinct they order the texts alone, in half the bytes.
    texts_of = scanned.groupBy("key").agg(F.min("body").alias("lo"), F.max("body").alias("hi"))
    alone = texts_of.filter("lo <> hi").isEmpty()
    # A null key is the smallest, in structs as well.
    lowest = F.coalesce(F.col("key"), F.lit(-(1 << 63))) if alone else F.struct("key", "body")
    first = windows.groupBy(F.col("window").alias("_window"), F.col("window2").alias("_window2")).agg(
        F.min(lowest).alias("lo"), F.max(lowest).alias("hi")
    )
    first = first.filter("lo < hi").select("_window", "_window2", "lo")
    same = (F.col("window") == F.col("_window")) & (F.col("window2") == F.col("_window2"))
    starts = windows.join(first, same & (lowest > F.col("lo")))
    starts = starts.groupBy("key", "body").agg(F.collect_set("start").alias("starts"))
    marked = open_.alias("d").join(starts.alias("s"), _same_document("d", "s"), "left").select(
        "d.key", "d.body", "d.text", F.coalesce("s.starts", none.cast("array<int>")).alias("starts"), "d.own"
    )
    marked = marked.filter((F.size("starts") > 0) | (F.size("own") > 0))
    with arrow_rows(spark, TEXTS):
        cut = marked.mapInArrow(_cut(length), "key long, body long, removed long, sha string, cut string")
        cut = stage(cut, "repeat-cut")
    cut = cut.unionByName(
        later.select("key", "body", F.lit(None).cast("long").alias("removed"), F.lit(None).cast("string").alias("sha"), F.lit("").alias("cut"))
    ).dropDuplicates(["key", "body"])
    nothing = hashlib.sha256(b"").hexdigest()
    return scanned.alias("a").join(cut.alias("c"), _same_document("a", "c"), "left").select(
        "a.key",
        "a.body",
        "a.n_words",
        F.when(F.col("c.body").isNull(), 0).otherwise(F.coalesce("c.removed", "a.n_words")).cast("long").alias("n_removed"),
        F.when(F.col("c.body").isNull(), F.col("a.sha")).otherwise(F.coalesce("c.sha", F.lit(nothing))).alias("kept_sha256"),
        "c.cut",
    )
