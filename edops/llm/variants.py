"""Spelling variants by Bloom-guided neighbourhoods.

Words with at least ``least`` occurrences are the vocabulary. Two are near if one inserted,
deleted or replaced code point turns one into the other. For every word tasks generate the
hashes of its shorter neighbours (one code point out) and of its equally long ones that come
later in code-point order; so each unordered pair is met once. The hashes probe Bloom
filters, one set of blocks per word length, that were broadcast before. Only positives become
strings and are shuffled to an exact join with the vocabulary, which removes the false ones;
a Bloom filter misses no word, so the result is exact.

A filter block has eight lanes of 64 bits, and a word sets one bit in each, at about
``BITS`` bits a word. Filters are cut into parts by the hash of the word and broadcast in
rounds of whole parts of at most ``FILTER_BYTES``; the number of rounds grows with the
vocabulary, no broadcast does. An edit's hash follows from the word's hash without building
the edit, and a long word's edits are made a few positions at a time.

A word's form is its near word of largest count (ties: the smallest in code-point order) if
that is at least ``ratio`` times its own. Counts rise by that factor along a chain of forms,
so chains are short; roots are found by doubling the links.

Defined cases: null and empty texts have no words; a null document number counts as empty
text before the colon; very long texts are read in one piece and counted by their distinct
runs, very long words as any others; equal rows count each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edops.llm.common import TEXTS, arrow_rows
from edops.llm.words import mix, slices, text_bytes
from edops.session import stage

FEWEST, LEAST, RATIO = 6, 5, 5
NOISE = 199  # one run in so many loses a code point
BITS, LANES = 24, 8
FILTER_BYTES = 64 << 20
PROBES = 1 << 18  # edit hashes made at once
BLOCK_BYTES = 8 * LANES
#: Code points that a word may hold after A-Z became a-z.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])
_BASE = 0x9E3779B97F4A7C15
_VALUE = np.random.default_rng(13).integers(1, 1 << 63, 0x100, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32

COUNTED = "word string, n long"
HASHED = "word string, n long, length int, hash long"


def find_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, byte start, byte end and code points of every maximal run of letters."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    lead = np.zeros(len(data), bool)  # 0xC3 starts exactly the code points U+00C0 to U+00FF
    lead[:-1] = data[:-1] == 0xC3
    inside = lead.copy()
    inside[1:] |= lead[:-1]
    inside |= (data >= ord("a")) & (data <= ord("z")) | (data >= ord("A")) & (data <= ord("Z"))
    new = np.ones(len(data), bool)
    new[1:] = ~inside[:-1]
    new[bounds[(bounds > 0) & (bounds < len(data))]] = True
    start = np.flatnonzero(inside & new)
    last = np.ones(len(data), bool)
    last[:-1] = new[1:] | ~inside[1:]
    end = np.flatnonzero(inside & last) + 1
    leads = np.concatenate([[0], np.cumsum(lead)])
    return np.searchsorted(bounds, start, "right") - 1, start, end, end - start - (leads[end] - leads[start])


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges as strings."""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length)])
    taken = data[np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(taken))


def _count(batches: Iterator[pa.RecordBatch], fewest: int, noise: int) -> Iterator[pa.RecordBatch]:
    """Words of ``fewest`` code points and more with their number in each slice of texts."""
    for batch in batches:
        for part in slices(batch, "text"):
            data, bounds = text_bytes(part.column("text"))
            data = _FOLD[data]
            text, start, end, length = find_runs(data, bounds)
            long = length >= fewest
            text, start, end, length = text[long], start[long], end[long], length[long]
            heads = [zlib.crc32(f"{k}:".encode()) for k in part.column("key").to_pylist()]
            raw = data.tobytes()
            crc = np.fromiter(
                (zlib.crc32(raw[s:e], heads[t]) for t, s, e in zip(text.tolist(), start.tolist(), end.tolist())),
                np.int64,
                len(start),
            )
            cut = crc % noise == 0
            words = pc.value_counts(_gather(data, start[~cut], end[~cut]))
            names, numbers = words.field(0).to_pylist(), words.field(1).to_pylist()
            for s, e, c, n in zip(start[cut], end[cut], crc[cut], length[cut]):
                if n > fewest:
                    run, at = raw[s:e].decode(), int(c % n)
                    names.append(run[:at] + run[at + 1 :])
                    numbers.append(1)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int64())], ["word", "n"])


def _powers(n: int) -> np.ndarray:
    steps = np.full(n + 1, _BASE, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def word_hash(word: str) -> int:
    """Polynomial over a random number for each code point, before mixing."""
    values = _VALUE[np.frombuffer(word.encode("utf-32-le"), np.uint32)]
    return int((values * _powers(len(values))[:-1]).sum(dtype=np.uint64))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        hashes = mix(np.array([word_hash(w) for w in words], np.uint64)).astype(np.int64)
        lengths = pa.array([len(w) for w in words], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), lengths, pa.array(hashes)], ["word", "n", "length", "hash"]
        )


def vocabulary(docs: DataFrame, key: str = "doc_id", fewest: int = FEWEST, least: int = LEAST, noise: int = NOISE) -> DataFrame:
    """(word, n, length, hash) of every word with at least ``least`` occurrences, stored.

    Runs lose a code point as the contract of the data says (``noise``); ``key`` names the
    document in that draw.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), "text")
    with arrow_rows(spark, TEXTS):
        counted = texts.mapInArrow(lambda batches: _count(batches, fewest, noise), COUNTED)
        common = counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        return stage(common.mapInArrow(_hashed, HASHED), "vocabulary")


# ---- filters --------------------------------------------------------------------------


def _part(h: np.ndarray, parts: int | np.ndarray) -> np.ndarray:
    return (h >> np.uint64(56)).astype(np.int64) * parts >> 8


class Filters:
    """Blocked Bloom filters of one round: (part, first block, blocks) of each length's parts."""

    def __init__(self, runs: dict[int, list[tuple[int, int, int]]], parts: dict[int, int], lanes: np.ndarray):
        self.runs, self.parts, self.lanes = runs, parts, lanes

    def hit(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Indices of the hashes whose word of that length may be in this round."""
        found = []
        for number, first, blocks in self.runs.get(length, []):
            at = np.arange(len(hashes))
            if self.parts[length] > 1:
                at = np.flatnonzero(_part(hashes, self.parts[length]) == number)
            base = (first + _block(hashes[at], blocks)) * LANES
            bits = _bits(hashes[at])
            for lane in range(LANES):
                kept = np.flatnonzero(self.lanes[base + lane] >> (bits >> np.uint64(6 * lane) & np.uint64(63)) & np.uint64(1))
                at, base, bits = at[kept], base[kept], bits[kept]
            found.append(at)
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _block(h: np.ndarray, blocks: int | np.ndarray) -> np.ndarray:
    """Block by 24 bits that the part does not use."""
    return (h >> np.uint64(32) & np.uint64(0xFFFFFF)).astype(np.int64) * blocks >> 24


def _bits(h: np.ndarray) -> np.ndarray:
    """Six bits a lane, which number one of its 64, from a fresh mix of the hash."""
    return mix(h ^ np.uint64(0xA5A5_5A5A_0F0F))


def _set_bits(batches: Iterator[pa.RecordBatch], sizes: dict[int, tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """(length, part, block, lane0..) of every word; ``sizes``: parts and blocks a part by length."""
    for batch in batches:
        lengths = np.asarray(batch.column("length"), np.int64)
        h = np.asarray(batch.column("hash"), np.int64).view(np.uint64)
        parts = np.array([sizes[n][0] for n in lengths.tolist()], np.int64)
        blocks = np.array([sizes[n][1] for n in lengths.tolist()], np.int64)
        part, block = _part(h, parts), _block(h, blocks)
        bits = _bits(h)
        lanes = [(np.uint64(1) << (bits >> np.uint64(6 * k) & np.uint64(63))).view(np.int64) for k in range(LANES)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (lengths, part, block, *lanes)],
            ["length", "part", "block", *[f"lane{i}" for i in range(LANES)]],
        )


def _sizes(counts: dict[int, int], limit: int) -> dict[int, tuple[int, int]]:
    """Parts and blocks a part for each length, so that no part exceeds the limit.

    A part is a power of two of 256 cells of the hash; beyond that, blocks stop growing with
    the words, and more false positives go to the exact join.
    """
    most = max(1, limit // BLOCK_BYTES)
    sizes = {}
    for length, words in counts.items():
        blocks, parts = -(-words * BITS // (64 * LANES)), 1
        while parts < 256 and -(-blocks // parts) > most:
            parts *= 2
        sizes[length] = (parts, min(most, 1 << 24, -(-blocks // parts)))
    return sizes


def _rounds(sizes: dict[int, tuple[int, int]], limit: int) -> list[list[tuple[int, int]]]:
    """(length, part) dealt into rounds of at most ``limit`` bytes."""
    rounds, room = [], 0
    for length in sorted(sizes):
        parts, blocks = sizes[length]
        for part in range(parts):
            if blocks * BLOCK_BYTES > room:
                rounds.append([])
                room = limit
            rounds[-1].append((length, part))
            room -= blocks * BLOCK_BYTES
    return rounds


def _load(spark: SparkSession, bits: DataFrame, chosen: list[tuple[int, int]], sizes: dict[int, tuple[int, int]]) -> Broadcast:
    """The filters of a round, at most ``FILTER_BYTES`` in all, on every worker."""
    runs, first, at = {}, {}, 0
    for length, part in chosen:
        blocks = sizes[length][1]
        runs.setdefault(length, []).append((part, at, blocks))
        first[length, part] = at
        at += blocks
    lanes = np.zeros((at, LANES), np.uint64)
    wanted = F.lit(False)
    for length, own in runs.items():
        wanted |= (F.col("length") == length) & F.col("part").between(own[0][0], own[-1][0])
    got = bits.filter(wanted).toArrow()
    starts = [first[key] for key in zip(got["length"].to_pylist(), got["part"].to_pylist())]
    rows = np.array(starts, np.int64) + got["block"].to_numpy()
    for lane in range(LANES):
        lanes[rows, lane] = got[f"lane{lane}"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(Filters(runs, {n: sizes[n][0] for n in runs}, lanes.reshape(-1)))


# ---- neighbours -----------------------------------------------------------------------


def _edits(points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Shorter and later neighbours of words of one length, given as rows of code points.

    Yields (length, row, position, replacement or -1, hash).
    """
    values, power = _VALUE[points], _powers(points.shape[1])
    terms = values * power[:-1]
    total = terms.sum(axis=1, dtype=np.uint64)
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    shorter = before + (total[:, None] - before - terms) * np.uint64(pow(_BASE, -1, 1 << 64))
    # Of equal neighbouring letters only the first is taken out.
    fresh = np.ones(points.shape, bool)
    fresh[:, 1:] = points[:, 1:] != points[:, :-1]
    row, where = np.nonzero(fresh)
    yield points.shape[1] - 1, row, where, np.full(len(row), -1), mix(shorter[row, where])
    step = max(1, PROBES // (len(ALPHABET) * len(points)))
    for at in range(0, points.shape[1], step):
        row, where, which = np.nonzero(ALPHABET > points[:, at : at + step, None])
        where += at
        new = ALPHABET[which]
        yield points.shape[1], row, where, new, mix(total[row] + (_VALUE[new] - values[row, where]) * power[where])


def _candidates(batches: Iterator[pa.RecordBatch], filters: Broadcast) -> Iterator[pa.RecordBatch]:
    """(word, n, other): edits that the filters hold, as strings."""
    held = filters.value
    for batch in batches:
        words, numbers = batch.column("word").to_pylist(), batch.column("n").to_numpy()
        length = np.array([len(w) for w in words])
        for size in np.unique(length):
            same = np.flatnonzero(length == size)
            group = max(1, PROBES // (len(ALPHABET) * int(size)))
            for at in range(0, len(same), group):
                own = same[at : at + group]
                joined = "".join([words[i] for i in own])
                points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64).reshape(len(own), -1)
                for long, row, where, new, hashes in _edits(points):
                    hits = held.hit(long, hashes)
                    found = own[row[hits]]
                    if not len(found):
                        continue
                    others = [
                        words[i][:p] + (chr(c) if c >= 0 else "") + words[i][p + 1 :]
                        for i, p, c in zip(found.tolist(), where[hits].tolist(), new[hits].tolist())
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([words[i] for i in found], pa.string()), pa.array(numbers[found]), pa.array(others, pa.string())],
                        ["word", "n", "other"],
                    )


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, other, other_n) once for each unordered pair of near words; ``words`` is stored."""
    spark = words.sparkSession
    counts = {r["length"]: r["count"] for r in words.groupBy("length").count().collect()}
    sizes = _sizes(counts, filter_bytes)
    bits = words.select("length", "hash").mapInArrow(
        lambda batches: _set_bits(batches, sizes), ", ".join(f"{c} long" for c in ["length", "part", "block", *_lanes()])
    )
    bits = bits.groupBy("length", "part", "block").agg(*[F.bit_or(c).alias(c) for c in _lanes()])
    rounds = _rounds(sizes, filter_bytes)
    bits = stage(bits, "filters")
    found = None
    for chosen in rounds:
        filters = _load(spark, bits, chosen, sizes)
        lengths = sorted({n for n, _ in chosen} | {n + 1 for n, _ in chosen})
        probed = words.filter(F.col("length").isin(lengths)).select("word", "n")
        # Words of one file may be few and long ones costly: spread them before the edits.
        probed = probed.repartition(_tasks(spark), "word")
        made = probed.mapInArrow(lambda batches, f=filters: _candidates(batches, f), "word string, n long, other string")
        made = stage(made, "candidates")
        found = made if found is None else found.unionByName(made)
    if found is None:
        found = words.selectExpr("word", "n", "word AS other").limit(0)
    exact = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return stage(found.join(exact, "other").select("word", "n", "other", "other_n"), "near")


def _lanes() -> list[str]:
    return [f"lane{i}" for i in range(LANES)]


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- forms and roots ------------------------------------------------------------------


def _best(n: str, word: str) -> Column:
    return F.min(F.struct((-F.col(n)).alias("minus"), F.col(word).alias("word")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) links without cycles, by doubling: each round halves the way."""
    links = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = links.join(onward, "root", "left")
        moved = moved.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("_moved"))
        moved = stage(moved, "roots")
        links = moved.select("word", "root")
        if moved.filter("_moved").limit(1).count() == 0:
            return links


def group_variants(
    docs: DataFrame,
    key: str = "doc_id",
    fewest: int = FEWEST,
    least: int = LEAST,
    ratio: int = RATIO,
    noise: int = NOISE,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary."""
    words = vocabulary(docs, key, fewest, least, noise)
    pairs = near_pairs(words, filter_bytes)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), _best("other_n", "other").alias("top"))
    taken = -F.col("top.minus") >= ratio * F.col("n")
    best = stage(
        best.select("word", "n_near", F.when(taken, F.col("top.word")).alias("form"), F.when(taken, -F.col("top.minus")).alias("form_n")),
        "forms",
    )
    ends = roots(best.filter("form is not null"))
    full = words.select("word", "n").join(best, "word", "left").join(ends, "word", "left")
    return full.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form",
        "form_n",
        F.coalesce("root", "word").alias("root"),
    )
