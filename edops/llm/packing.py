"""Packing documents into sequences by linear grouping (Fernandez de la Vega and Lueker).

Texts are tokenised where they are; a document longer than a sequence is cut into whole
sequences and a rest. What is packed is the histogram of the piece lengths, which has at
most as many rows as a sequence has tokens, whatever the input, so the plan is made at once:

1. lengths above ``LARGE`` of a sequence are ordered and dealt into ``GROUPS`` groups of equal
   cardinality, and rounded up to the longest of their group;
2. all configurations of the few rounded sizes that fit a sequence are listed, and a
   linear program finds how often to use each; whole parts are taken, the rest first-fit;
3. the actual lengths replace the rounded ones in their groups;
4. the small lengths follow in falling order, each into the fullest sequence that takes it.

The plan says which ranks of each length go where; the pieces are numbered within their
length in distributed runs and joined to the plan, so no piece passes the driver.

Defined cases: null text is empty and an empty text is the end token alone; repeated rows
are packed as often as they occur; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import sys
import types
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from edops.llm.common import TEXTS, arrow_rows, number_rows
from edops.session import stage

CAPACITY = 4096
END_ID = 1
LARGE = 0.25
GROUPS = 16
CACHED = 600_000  # words whose ids a worker remembers (about 120 MB)
PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<mark>[!-/:-@\[-`{-~]*)$"  # letters, then ASCII marks
JOINED = 500  # words that the tokenizer gets as one text


class Encoder:
    """Token ids of whole texts, chunk by chunk between ASCII white space.

    The tokenizer drops white space and never joins across it, so the ids of a text are those
    of its chunks one after the other. A chunk of letters and ASCII marks is encoded as both
    parts; most parts occur often and are encoded once. Words of letters go to the tokenizer
    many at once, between blanks, and are told apart by their last token, which is one that
    ends a word. The memory lasts as long as the worker.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        kept = sys.modules.setdefault("edops_token_memory", types.ModuleType("edops_token_memory"))
        if getattr(kept, "path", None) != path:
            kept.path, kept.tokenizer, kept.ids = path, Tokenizer.from_file(path), {}
            vocabulary = kept.tokenizer.get_vocab()
            suffix = getattr(kept.tokenizer.model, "end_of_word_suffix", None)
            kept.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            if suffix:
                kept.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.tokenizer, self.ids, self.ends = kept.tokenizer, kept.ids, kept.ends

    def _encode(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of words of lower-case letters, each of which the tokenizer takes as one."""
        lines = [" ".join(words[at : at + JOINED]) for at in range(0, len(words), JOINED)]
        found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        out = []
        for at, line in zip(range(0, len(words), JOINED), found):
            ids = np.array(line.ids, "<u4")
            raw, to = ids.tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            part = words[at : at + JOINED]
            if len(to) == len(part) and to[-1] == len(raw):
                out += [raw[a:b] for a, b in zip([0, *to], to)]
            else:  # a tokenizer that marks no ends, or several
                out += self._encode(part)
        return out

    def _ids(self, parts: pa.DictionaryArray, encode: Callable[[list[str]], list[bytes]]) -> pa.Array:
        """The ids of each distinct part, from memory or ``encode``."""
        # No part holds a line break; one string to cut is far cheaper than one call for each.
        empty, ends = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
        lines = pc.binary_join_element_wise(parts.dictionary, empty, ends)
        _, offsets, raw = lines.buffers()
        size = int(np.frombuffer(offsets, np.int64)[len(lines)])
        strings = bytes(raw or b"")[:size].decode().split("\n")[: len(lines)]
        new = list(set(strings).difference(self.ids))
        self.ids.update(zip(new, encode(new)))
        return pa.array(list(map(self.ids.__getitem__, strings)), pa.large_binary())

    def __call__(self, texts: pa.Array) -> list[memoryview]:
        """The ids of every text as little-endian 32-bit numbers."""
        if len(self.ids) > CACHED:
            self.ids.clear()
        self.ids[""] = b""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        bounds = split.offsets.to_numpy()
        chunks = split.flatten().dictionary_encode()
        # Each chunk is a word and a mark, or no word and itself.
        plain = pc.extract_regex(chunks.dictionary, PLAIN)
        words = pc.utf8_lower(pc.struct_field(plain, "word")).fill_null("").dictionary_encode()
        marks = pc.if_else(plain.is_valid(), pc.struct_field(plain, "mark"), chunks.dictionary).dictionary_encode()
        known = pa.concat_arrays([self._ids(words, self._words), self._ids(marks, self._encode)])
        take = np.empty((len(chunks), 2), np.int64)
        at = chunks.indices.to_numpy()
        take[:, 0] = words.indices.to_numpy()[at]
        take[:, 1] = len(words.dictionary) + marks.indices.to_numpy()[at]
        ids = known.take(pa.array(take.ravel()))
        _, offsets, raw = ids.buffers()
        to = np.frombuffer(offsets, np.int64)[2 * (bounds - bounds[0])].tolist()
        raw = memoryview(raw or b"")
        return [raw[a:b] for a, b in zip(to, to[1:])]


def _pieces(path: str, capacity: int, with_ids: bool):
    width = 4 * capacity
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        for batch in batches:
            row, piece, length, crc, ids = [], [], [], [], []
            for i, raw in enumerate(encode(batch["text"])):
                raw = bytes(raw) + end
                for n, at in enumerate(range(0, len(raw), width)):
                    part = raw[at : at + width]
                    row.append(i)
                    piece.append(n)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    ids.append(part if with_ids else None)
            take = pa.array(row, pa.int64())
            pieces = pa.array(piece, pa.int64())
            columns = [
                batch["key"].take(take),
                batch["body"].take(take),
                pieces.cast(pa.int32()),
                pa.array(np.array(piece, np.int64) * capacity),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["key", "body", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


class Bins:
    """Sequences of equal content as runs: (how many, [(length, times), ...], free tokens)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.frees: list[int] = []
        self.runs: dict[int, list] = defaultdict(list)
        self.full: list = []

    def add(self, n: int, content: list, free: int) -> None:
        if n <= 0:
            return
        if free == 0:
            self.full.append((n, content))
            return
        if not self.runs[free]:
            insort(self.frees, free)
        self.runs[free].append((n, content))

    def place(self, length: int, n: int) -> None:
        """Best fit: the fullest sequences that take the length, then new ones."""
        while n:
            at = bisect_left(self.frees, length)
            if at == len(self.frees):
                free, (bins, content) = self.capacity, (n, [])
            else:
                free = self.frees[at]
                bins, content = self.runs[free].pop()
                if not self.runs[free]:
                    self.frees.pop(at)
            each = free // length
            whole = min(bins, n // each)
            self.add(whole, [*content, (length, each)], free - each * length)
            n -= whole * each
            if whole < bins and n < each:  # the last of the items, in one more sequence
                if n:
                    self.add(1, [*content, (length, n)], free - n * length)
                if content:
                    self.add(bins - whole - (1 if n else 0), content, free)
                n = 0

    def all(self) -> list:
        return self.full + [run for free in self.frees for run in self.runs[free]]


def linear_grouping(histogram: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths in falling order, cut into groups of equal cardinality: [(length, n), ...] each."""
    total = sum(histogram.values())
    out, taken = [[] for _ in range(groups)], 0
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            group = min(groups - 1, taken * groups // total)
            room = -(-(group + 1) * total // groups) - taken
            part = min(n, room)
            out[group].append((length, part))
            taken, n = taken + part, n - part
    return [g for g in out if g]


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(group numbers of one sequence, how many sequences), ...] that hold the demand.

    The linear program over all maximal configurations is solved by the simplex method; the
    whole parts are used and what is left of the demand goes first-fit, largest first.
    """
    k = len(sizes)
    most = capacity // min(sizes)
    columns = []
    for n in range(1, most + 1):
        columns += [c for c in combinations_with_replacement(range(k), n) if sum(sizes[i] for i in c) <= capacity]
    a = np.zeros((k, len(columns)))
    for j, c in enumerate(columns):
        for i in c:
            a[i, j] += 1
    index = {c: j for j, c in enumerate(columns)}
    basis = [index[(i,) * (capacity // sizes[i])] for i in range(k)]
    need = np.array(demand, float)
    for _ in range(50 * k * k):
        b = a[:, basis]
        amount = np.linalg.solve(b, need)
        price = np.linalg.solve(b.T, np.ones(k)) @ a
        enter = int(price.argmax())
        if price[enter] <= 1 + 1e-9:
            break
        step = np.linalg.solve(b, a[:, enter])
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        basis[int(ratio.argmin())] = enter
    amount = np.linalg.solve(a[:, basis], need)
    left, used = list(demand), Counter()
    for j, x in zip(basis, amount):
        times = int(x + 1e-9)
        times = min([times, *(left[i] // n for i, n in Counter(columns[j]).items())])
        if times > 0:
            used[columns[j]] += times
            for i in columns[j]:
                left[i] -= times
    while any(left):  # a few sequences per group at most
        free, content = capacity, []
        for i in range(k):
            while left[i] and sizes[i] <= free:
                content.append(i)
                left[i] -= 1
                free -= sizes[i]
        times = 1 + min(left[i] // n for i, n in Counter(content).items())
        for i, n in Counter(content).items():
            left[i] -= n * (times - 1)
        used[tuple(content)] += times
    return list(used.items())


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> list:
    """Runs of sequences (how many, [(length, times), ...]) that hold every length of the histogram."""
    bins = Bins(capacity)
    big = {length: n for length, n in histogram.items() if capacity * large < length < capacity}
    if capacity in histogram:
        bins.add(histogram[capacity], [(capacity, 1)], 0)
    if big:
        grouped = linear_grouping(big, min(groups, sum(big.values())))
        sizes = [g[0][0] for g in grouped]
        rests = [[list(x) for x in g] for g in grouped]  # what is left of each group, longest first
        for config, times in configurations(sizes, [sum(n for _, n in g) for g in grouped], capacity):
            while times:  # as many sequences at once as have the same actual lengths
                need = Counter(config)
                n = min(times, *(max(1, rests[i][0][1] // k) for i, k in need.items()))
                content = Counter()
                for i, k in need.items():
                    take = n * k
                    while take:
                        length, there = rests[i][0]
                        part = min(take, there)
                        content[length] += part if n == 1 else part // n
                        rests[i][0][1] -= part
                        if not rests[i][0][1]:
                            rests[i].pop(0)
                        take -= part
                held = sorted(content.items(), reverse=True)
                bins.add(n, held, capacity - sum(length * k for length, k in held))
                times -= n
    for length in sorted((x for x in histogram if x <= capacity * large), reverse=True):
        bins.place(length, histogram[length])
    return bins.all()


def slots(runs: list) -> list[tuple]:
    """(length, first rank, last rank, items per sequence, first sequence, offset) of every run and length."""
    out, ranks, sequence = [], Counter(), 0
    for n, content in runs:
        offset = 0
        for length, times in content:
            out.append((length, ranks[length], ranks[length] + n * times - 1, times, sequence, offset))
            ranks[length] += n * times
            offset += length * times
        sequence += n
    return out


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """One row per piece: key, body, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor has. ``with_ids`` adds
    the token ids of the piece as little-endian 32-bit numbers.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(body).alias("body"), body.alias("text"))
    kind = texts.schema["key"].dataType.simpleString()
    schema = f"key {kind}, body long, piece int, start long, length long, ids_crc32 long"
    with arrow_rows(spark, TEXTS):
        cut = texts.mapInArrow(_pieces(tokenizer, capacity, with_ids), schema + (", ids binary" if with_ids else ""))
        pieces = stage(cut, "pack-pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    schema = "length long, first long, last long, times long, sequence long, place long"
    places = spark.createDataFrame(slots(plan(histogram, capacity)), schema)
    # At most a few rows per possible length: bounded by the capacity, not by the input.
    places = places.groupBy(F.col("length").alias("_length")).agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "times", "sequence", "place"))).alias("slots")
    )
    numbered = number_rows(pieces, ["length"], ["key", "body", "piece"], "_rank")
    joined = numbered.join(F.broadcast(places), F.col("length") == F.col("_length"))
    mine = F.filter("slots", lambda s: (s["first"] <= F.col("_rank")) & (F.col("_rank") <= s["last"]))[0]
    nth = F.col("_rank") - F.col("_slot.first")
    times = F.col("_slot.times")
    return joined.withColumn("_slot", mine).select(
        *pieces.columns,
        (F.col("_slot.sequence") + F.floor(nth / times)).cast("long").alias("sequence_id"),
        (F.col("_slot.place") + F.pmod(nth, times) * F.col("length")).cast("long").alias("offset"),
    )
