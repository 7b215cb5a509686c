"""Language-model scores from a log-frequency Bloom filter (Talbot and Osborne, 2007).

Training counts words and word pairs (an end token closes every text, a start context opens
it). A count ``c`` is held as ``1 + floor(log2 c)`` entries of a Bloom filter, so a probe
asks for entry 1, 2, ... of an n-gram until one is missing and reads the quantised count
from that. The probability of a token interpolates the pair with the smoothed exact word
frequency; its weight comes from the quantised count of the context.

Size. N-grams are dealt into a square grid of cells by the hash of their context and of
their word, finer for more text; words lie in cells of their own, ``1 << FINER`` of them to
a row or column. A cell has one filter, sized for its own entries. There are two ways to
score, with the same cells, filters and scores:

* Up to ``MODEL_BYTES`` of training text, the model is stored and broadcast in square blocks,
  cut by their real sizes until each is at most ``MODEL_BYTES`` or a single cell, and one pass
  over the texts scores the tokens of each. Such a model has a few blocks at most.
* Beyond it, the texts are read once and stored as numbered words in chunks of about ``FLUSH``
  tokens. The distinct n-grams of every chunk go to the task of their cell, with the times
  that training texts hold them. There they are summed, the filter is built and probed, and
  only its answers go back to the chunk, where the texts are scored. Nothing is
  broadcast, and the number of passes does not grow with the text.

The middle of a level stands for its counts, so the chances of all tokens after one context
add up to one on average over contexts only.

Defined cases: a null text is empty and holds the end token alone; rows that agree in key and
text get equal scores, whatever the key; a row without a verdict of ``learn`` teaches nothing;
without training texts all
counts are 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from edops.llm.common import TEXTS, arrow_rows
from edops.llm.words import STEP, Words, mix, slices, split_words
from edops.session import stage

MODEL_BYTES = 64 << 20
BYTES_PER_CELL = 1 << 19
BITS_PER_ENTRY, PROBES = 10, 6
WEIGHT = 30.0  # count of a context at which its pairs and the word frequency weigh alike
FLUSH = 1 << 21
END, START = (int(x) for x in mix(np.array([1, 2], np.uint64)))
_WORD, _PAIR = 0, 1
FINER = 4  # word cells are this many bits finer than a row or column of the grid
GROUPED = 16  # at most so many bits number the cells of a group


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, context, text) of a batch: the words of every text, then its end."""
    n = words.n_texts
    token = np.empty(len(words.hash) + n, np.uint64)
    ends = words.firsts[1:] + np.arange(n)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[is_end], token[~is_end] = np.uint64(END), words.hash
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[:1] = np.uint64(START)
    context[1:][is_end[:-1]] = np.uint64(START)
    text = np.cumsum(is_end) - is_end
    return token, context, text


def pair(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(context * STEP + token)


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _count(bits: int):
    """Counts of words and pairs, summed over about ``FLUSH`` tokens at a time."""

    def emit(tokens_: list, pairs: list) -> pa.RecordBatch:
        columns = [[], [], [], []]
        for kind, parts in ((_WORD, tokens_), (_PAIR, pairs)):
            value, cell = (np.concatenate(x) for x in zip(*parts))
            value, first, count = np.unique(value, return_index=True, return_counts=True)
            for column, array in zip(columns, (np.full(len(value), kind, np.int32), cell[first], value.view(np.int64), count)):
                column.append(array)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["kind", "cell", "ngram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words_, pairs = 0, [], []
        for batch in batches:
            for part in slices(batch, "text"):
                token, context, _ = tokens(split_words(part["text"], lower=True))
                starts = int((context == np.uint64(START)).sum())
                words_.append((token, _cells(token, bits + FINER)))
                opened = np.full(starts, START, np.uint64)
                words_.append((opened, _cells(opened, bits + FINER)))
                pairs.append((pair(context, token), (_cells(context, bits) << bits) | _cells(token, bits)))
                held += len(token)
                if held >= FLUSH:
                    yield emit(words_, pairs)
                    held, words_, pairs = 0, [], []
        if words_:
            yield emit(words_, pairs)

    return run


def filter_bits(ngram: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The log-frequency Bloom filter of some n-grams, as a byte array of eight bits each."""
    level = 1 + np.floor(np.log2(count)).astype(np.int64)
    size = max(64, -(-int(level.sum()) * BITS_PER_ENTRY // 64) * 64)
    bits = np.zeros(size, bool)
    for at in range(1, int(level.max(initial=0)) + 1):
        for place in _places(ngram[level >= at], at, np.uint64(size)):
            bits[place] = True
    return np.packbits(bits, bitorder="little")


def _salt(level: int) -> np.uint64:
    return np.uint64(level * int(STEP) & (1 << 64) - 1)


def _places(ngram: np.ndarray, level: int, size: np.ndarray) -> Iterator[np.ndarray]:
    entry = mix(ngram + _salt(level))
    step = mix(entry) | np.uint64(1)
    for _ in range(PROBES):
        yield (entry % size).astype(np.int64)
        entry = entry + step


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(kind, cell, n-grams, counts) of each cell; the rows come sorted by cell."""
    now, held = None, []
    for batch in batches:
        kind, cell, ngram, n = (batch[i].to_numpy(zero_copy_only=False) for i in range(4))
        edge = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])))[: len(cell)]
        for a, b in zip(edge, np.append(edge[1:], len(cell))):
            key = int(kind[a]), int(cell[a])
            if held and key != now:
                yield *now, *(np.concatenate(x) for x in zip(*held))
                held = []
            now = key
            held.append((ngram[a:b].view(np.uint64), n[a:b]))
    if held:
        yield *now, *(np.concatenate(x) for x in zip(*held))


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per cell: its filter and, for words, the exact counts."""
    for kind, cell, ngram, n in _runs(batches):
        order = np.argsort(ngram)
        ngram, n = ngram[order], n[order]
        at = np.flatnonzero(np.append(True, ngram[1:] != ngram[:-1]))
        ngram, n = ngram[at], np.add.reduceat(n, at)
        exact = kind == _WORD
        real = ngram != np.uint64(START)
        bits = filter_bits(ngram, n).tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([kind], pa.int32()),
                pa.array([cell], pa.int64()),
                pa.array([int(real.sum())], pa.int64()),
                pa.array([int(n[real].sum())], pa.int64()),
                pa.array([len(bits)], pa.int64()),
                pa.array([bits], pa.binary()),
                pa.array([ngram[real].tobytes() if exact else None], pa.binary()),
                pa.array([n[real].astype(np.int64).tobytes() if exact else None], pa.binary()),
            ],
            ["kind", "cell", "entries", "total", "size", "bits", "ngrams", "counts"],
        )


class Filters:
    """The filters of some cells, end to end; cells that no n-gram reached are empty."""

    def __init__(self, bits: np.ndarray, size: np.ndarray, start: np.ndarray):
        self.bits, self.size, self.start = bits, size, start

    @staticmethod
    def arrays(rows: list, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All bits, and the number of bits and the first bit of every cell."""
        size, start = np.zeros(cells, np.uint64), np.zeros(cells, np.int64)
        parts, at = [], 0
        for row in rows:
            bits = np.frombuffer(row["bits"], np.uint8)
            size[row["cell"]], start[row["cell"]] = len(bits) * 8, at * 8
            at += len(bits)
            parts.append(bits)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint8), size, start

    def level(self, ngram: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Highest entry of each n-gram that the filter holds, from repeated probes."""
        out = np.zeros(len(ngram), np.int64)
        left = np.flatnonzero(self.size[cell] > 0)
        level = 0
        while len(left):
            level += 1
            alive = left
            size, start = self.size[cell[alive]], self.start[cell[alive]]
            entry = mix(ngram[alive] + _salt(level))
            step = mix(entry) | np.uint64(1)
            for _ in range(PROBES):
                place = (entry % size).astype(np.int64) + start
                hit = (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                alive, size, start, entry, step = alive[hit], size[hit], start[hit], entry[hit] + step[hit], step[hit]
            out[alive] = level
            left = alive
        return out


def dequantise(level: np.ndarray) -> np.ndarray:
    """Middle of the counts that share a level; 0 for level 0."""
    return np.where(level > 0, (2.0 ** (level - 1) + 2.0**level - 1) / 2, 0.0)


def interpolate(both: np.ndarray, seen: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Probability of tokens from the levels of pair and context and the word frequency."""
    both = dequantise(both)
    return (both + WEIGHT * base) / (np.maximum(dequantise(seen), both) + WEIGHT)


class Block:
    """A block of the grid: exact word counts, context filters, pair filters.

    Built in the tasks from plain arrays, which is what is broadcast.
    """

    def __init__(self, sent: dict):
        self.rows, self.columns, self.bits = sent["rows"], sent["columns"], sent["bits"]
        self.total, self.distinct = sent["total"], sent["distinct"]
        self.words, self.counts = sent["words"], sent["counts"]
        self.contexts, self.pairs = Filters(*sent["contexts"]), Filters(*sent["pairs"])

    def score(self, words: Words) -> dict[str, np.ndarray]:
        """Sums of this block's tokens for every text."""
        token, context, text = tokens(words)
        row, column = _cells(context, self.bits), _cells(token, self.bits)
        mine = np.flatnonzero(
            (row >= self.rows.start) & (row < self.rows.stop) & (column >= self.columns.start) & (column < self.columns.stop)
        )
        token, context, text, row, column = token[mine], context[mine], text[mine], row[mine], column[mine]
        kinds, back = np.unique(token, return_inverse=True)
        place = np.minimum(np.searchsorted(self.words, kinds), max(len(self.words) - 1, 0))
        count = np.zeros(len(kinds))
        if len(self.words):
            count = np.where(self.words[place] == kinds, self.counts[place], 0).astype(np.float64)
        count = count[back]
        base = (count + 0.1) / (self.total + 0.1 * (self.distinct + 1))
        inside = (row - self.rows.start) * len(self.columns) + column - self.columns.start
        both = self.pairs.level(pair(context, token), inside)
        opened, back = np.unique(context, return_inverse=True)
        cell = _cells(opened, self.bits + FINER) - (self.rows.start << FINER)
        chance = interpolate(both, self.contexts.level(opened, cell)[back], base)
        n = words.n_texts
        return {
            "tokens": np.bincount(text, minlength=n),
            "known": np.bincount(text[count > 0], minlength=n),
            "base": np.bincount(text, np.log10(base), n),
            "score": np.bincount(text, np.log10(chance), n),
        }


def _score(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Block(block.value)
        for batch in batches:
            for part in slices(batch, "text"):
                sums = model.score(split_words(part["text"], lower=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        part["body"],
                        pa.array(sums["tokens"].astype(np.int64)),
                        pa.array(sums["known"].astype(np.int64)),
                        pa.array(sums["base"].astype(np.float64)),
                        pa.array(sums["score"].astype(np.float64)),
                    ],
                    ["key", "body", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def _grid(size: int, bytes_per_cell: int) -> int:
    """Bits of the grid for so many bytes of training text."""
    return max(0, (max(1, -(-size // bytes_per_cell)) - 1).bit_length() + 1) // 2


def train(texts: DataFrame, bytes_per_cell: int = BYTES_PER_CELL) -> tuple[DataFrame, int]:
    """The stored model (one row per cell) of the column ``text``, and the bits of its grid."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _grid(size, bytes_per_cell)
    counted = texts.mapInArrow(_count(bits), "kind int, cell long, ngram long, n long")
    # About two million rows (32 MB) in a task.
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // (16 << 20)))
    # One number for kind and cell: such rows are sorted by their bits, without comparisons.
    dealt = counted.repartition(parts, "kind", "cell").sortWithinPartitions(F.col("cell") * 2 + F.col("kind"))
    schema = "kind int, cell long, entries long, total long, size long, bits binary, ngrams binary, counts binary"
    return stage(dealt.mapInArrow(_build, schema), "lm-model"), bits


def _parts(model: DataFrame, bits: int, model_bytes: int) -> list[tuple[range, range]]:
    """Rows and columns of the blocks: halved along one side in turn until each fits.

    Only sums of sizes by block come to the driver, one row per block and level.
    """
    fits, left, height, width = [], {(0, 0)}, 1 << bits, 1 << bits
    pairs = model.filter(F.col("kind") == _PAIR)
    words = model.filter(F.col("kind") == _WORD)
    line = F.shiftright("cell", FINER)

    def sums(rows: DataFrame, size: Column, **by: Column) -> dict:
        numbers = [F.floor(value).cast("long").alias(name) for name, value in by.items()]
        return {tuple(r[name] for name in by): r["n"] for r in rows.groupBy(*numbers).agg(F.sum(size).alias("n")).collect()}

    while left:
        column = F.col("cell").bitwiseAND((1 << bits) - 1)
        of_pairs = sums(pairs, F.col("size"), r=F.shiftright("cell", bits) / height, c=column / width)
        of_contexts = sums(words, F.col("size"), r=line / height)
        of_counts = sums(words, F.col("entries") * 16, c=line / width)
        places = 16 * (height * width + (height << FINER))  # size and start of every cell
        small = {
            (r, c)
            for r, c in left
            if height * width == 1
            or places + of_pairs.get((r, c), 0) + of_contexts.get((r,), 0) + of_counts.get((c,), 0) <= model_bytes
        }
        fits += [(range(r * height, (r + 1) * height), range(c * width, (c + 1) * width)) for r, c in sorted(small)]
        left -= small
        if width >= height:
            left, width = {(r, 2 * c + i) for r, c in left for i in (0, 1)}, width // 2
        else:
            left, height = {(2 * r + i, c) for r, c in left for i in (0, 1)}, height // 2
    return fits


def _blocks(model: DataFrame, bits: int, model_bytes: int) -> Iterator[dict]:
    """The grid in blocks, each read from the stored model when its turn comes."""
    sums = model.filter(F.col("kind") == _WORD).agg(F.sum("total").alias("total"), F.sum("entries").alias("distinct")).first()
    kind, cell = F.col("kind"), F.col("cell")
    # Cells of the pair grid are numbered row by row.
    row, column = F.shiftright("cell", bits), F.col("cell").bitwiseAND((1 << bits) - 1)

    def within(value: Column, first: int, n: int) -> Column:
        return value.between(first, first + n - 1)

    for rows, columns in _parts(model, bits, model_bytes):
        r, c, height, width = rows.start, columns.start, len(rows), len(columns)
        words = model.filter((kind == _WORD) & within(cell, c << FINER, width << FINER)).select("ngrams", "counts")
        contexts = model.filter((kind == _WORD) & within(cell, r << FINER, height << FINER))
        # The rows of a block lie together in the numbering of the grid.
        inside = within(cell, r << bits, height << bits) & within(column, c, width)
        pairs = model.filter((kind == _PAIR) & inside)
        ngrams, counts = _exact(words.collect())
        yield {
            "rows": rows,
            "columns": columns,
            "bits": bits,
            "total": sums["total"] or 0,
            "distinct": sums["distinct"] or 0,
            "words": ngrams,
            "counts": counts,
            "contexts": Filters.arrays(contexts.select((cell - (r << FINER)).alias("cell"), "bits").collect(), height << FINER),
            "pairs": Filters.arrays(pairs.select(((row - r) * width + column - c).alias("cell"), "bits").collect(), height * width),
        }


def _exact(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Words in order of their hash, and their counts."""
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = np.concatenate([np.frombuffer(r["ngrams"], np.uint64) for r in rows])
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
    order = np.argsort(words)
    return words[order], counts[order]


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _chunks(flush: int):
    """One row per chunk: its rows, the distinct words, commonest first, and the numbered tokens."""

    def emit(chunk: int, rows: list, tokens_: list, lengths: list) -> pa.RecordBatch:
        words_, back, count = np.unique(np.concatenate(tokens_), return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        columns = [pa.concat_arrays([part[c] for part in rows]) for c in ("key", "body", "learn")]
        columns.append(pa.array(np.concatenate(lengths).astype(np.int64)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk], pa.int64()),
                *[pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns],
                pa.array([_pack(rank[back])], pa.binary()),
                pa.array([words_[order].tobytes()], pa.binary()),
            ],
            ["chunk", "keys", "bodies", "learns", "lengths", "tokens", "words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        held, rows, tokens_, lengths = 0, [], [], []
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part["text"], lower=True)
                token, _, _ = tokens(words)
                rows.append(part.select(["key", "body", "learn"]))
                tokens_.append(token)
                lengths.append(words.counts + 1)
                held += len(token)
                if held >= flush:
                    yield emit(chunk, rows, tokens_, lengths)
                    held, rows, tokens_, lengths, chunk = 0, [], [], [], chunk + 1
        if rows:
            yield emit(chunk, rows, tokens_, lengths)

    return run


class Chunk:
    """The words and pairs of a chunk, each kind in the order in which its cells are asked."""

    def __init__(self, row: dict, bits: int):
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.token = _unpack(row["tokens"], int(self.lengths.sum()))
        #: The start context is the last of the words.
        self.words = np.append(np.frombuffer(row["words"], np.uint64), np.uint64(START))
        context = np.empty_like(self.token)
        context[1:] = self.token[:-1]
        context[np.cumsum(self.lengths) - self.lengths] = len(self.words) - 1
        #: A pair of numbered words as one number.
        self.code = context * len(self.words) + self.token
        self.bits = bits

    def halves(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the context and of the token of each pair."""
        return np.divmod(code, len(self.words))

    def cells(self, kind: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the n-grams by cell, their cells); ``code`` are the distinct pairs."""
        if kind == _WORD:
            cell, width = _cells(self.words, self.bits + FINER), self.bits + FINER
        else:
            context, token = self.halves(code)
            row = _cells(self.words, self.bits)
            cell, width = (row[context] << self.bits) | row[token], 2 * self.bits
        cell = _spread(cell, width)
        order = np.argsort(cell.astype(np.uint16) if width <= 16 else cell, kind="stable")
        return order, cell[order]


def _spread(cell: np.ndarray, width: int) -> np.ndarray:
    """Other numbers for the cells, so that neighbours, with one common context, part."""
    return (cell * 0x9E3779B1) & ((1 << width) - 1)


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The values between each two bounds as one binary each."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _values(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``_blobs`` put together: the values of all rows, and their bounds."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data.copy().view(kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


def _ask(bits: int, inside: dict[int, int]):
    """The distinct n-grams of each chunk by group of cells, with the times they are learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, bits)
                learns = np.asarray(row["learns"], bool)
                learned = np.repeat(learns, chunk.lengths)
                code, first = _distinct(chunk.code)
                times = np.diff(np.append(first, len(chunk.code)))
                left = np.searchsorted(code, chunk.code[~learned])
                times -= np.bincount(left, minlength=len(code))
                context, token = chunk.halves(code)
                words = np.bincount(chunk.token[learned], minlength=len(chunk.words))
                words[-1] = int(learns.sum())
                asked = {_WORD: (chunk.words, words), _PAIR: (pair(chunk.words[context], chunk.words[token]), times)}
                for kind, (ngram, n) in asked.items():
                    order, cell = chunk.cells(kind, code)
                    group = cell >> inside[kind]
                    bounds = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
                    part = (cell & ((1 << inside[kind]) - 1)).astype(np.uint16)
                    rows = len(bounds) - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(rows, row["chunk"])),
                            pa.array(np.full(rows, kind, np.int32)),
                            pa.array(group[bounds[:-1]]),
                            _blobs(ngram[order], bounds),
                            _blobs(n[order].astype(np.uint32), bounds),
                            _blobs(part, bounds),
                        ],
                        ["chunk", "kind", "group", "ngrams", "times", "cells"],
                    )

    return run


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and where each begins in the sorted values."""
    values = np.sort(values)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], first


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the filters of a group of cells, and the exact counts, say to every chunk's n-grams."""
    now, held = None, []
    for batch in batches:
        kind, group = (batch[i].to_numpy(zero_copy_only=False) for i in (1, 2))
        edge = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (kind[1:] != kind[:-1])))[: len(group)]
        for a, b in zip(edge, np.append(edge[1:], len(group))):
            key = int(kind[a]), int(group[a])
            if held and key != now:
                yield _of_group(*now, held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield _of_group(*now, held)


def _of_group(kind: int, group: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    asked = [_values(p["ngrams"], np.uint64) for p in parts]
    sizes = np.concatenate([np.diff(bounds) for _, bounds in asked])
    ngram = np.concatenate([values for values, _ in asked])
    n = np.concatenate([_values(p["times"], np.uint32)[0] for p in parts]).astype(np.int64)
    cell = np.concatenate([_values(p["cells"], np.uint16)[0] for p in parts])
    order = np.argsort(ngram)
    ngram = ngram[order]
    first = np.append(True, ngram[1:] != ngram[:-1])
    at = np.flatnonzero(first)
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(first) - 1
    ngram, n, cell = ngram[at], np.add.reduceat(n[order], at), cell[order][at].astype(np.int64)
    learned = np.flatnonzero(n)
    learned = learned[np.argsort(cell[learned], kind="stable")]
    rows = []
    for run in np.split(learned, np.flatnonzero(np.diff(cell[learned])) + 1):
        if len(run):
            rows.append({"cell": cell[run[0]], "bits": filter_bits(ngram[run], n[run])})
    level = Filters(*Filters.arrays(rows, int(cell.max()) + 1)).level(ngram, cell).astype(np.uint8)
    bounds = np.append(0, np.cumsum(sizes))
    exact = kind == _WORD
    real = ngram != np.uint64(START)
    first_row = np.arange(len(sizes)) == 0
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([p["chunk"] for p in parts]),
            pa.array(np.full(len(sizes), kind, np.int32)),
            pa.array(np.full(len(sizes), group)),
            _blobs(level[back], bounds),
            _blobs(n[back], bounds) if exact else pa.nulls(len(sizes), pa.binary()),
            pa.array(first_row * (int(n[real].sum()) if exact else 0)),
            pa.array(first_row * (int((n[real] > 0).sum()) if exact else 0)),
        ],
        ["chunk", "kind", "group", "levels", "counts", "total", "distinct"],
    )


def _tell(bits: int, total: int, distinct: int):
    """Scores of a chunk's texts from the answers to its n-grams."""

    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = chunks.select(["lengths", "tokens", "words"]).to_pylist()
        chunk = Chunk(row, bits)
        answers = answers.sort_by([("kind", "ascending"), ("group", "ascending")])
        code, back = np.unique(chunk.code, return_inverse=True)
        known = {}
        for kind in (_WORD, _PAIR):
            mine = answers.filter(pc.equal(answers["kind"], kind))
            order, _ = chunk.cells(kind, code)
            for name, dtype in (("levels", np.uint8), ("counts", np.int64))[: 2 if kind == _WORD else 1]:
                values = np.empty(len(order), np.int64)
                values[order] = np.frombuffer(b"".join(mine[name].to_pylist()), dtype)
                known[kind, name] = values
        count = known[_WORD, "counts"]
        base = (count + 0.1) / (total + 0.1 * (distinct + 1))
        context, token = chunk.halves(code)
        chance = interpolate(known[_PAIR, "levels"], known[_WORD, "levels"][context], base[token])
        n = len(chunk.lengths)
        text = np.repeat(np.arange(n), chunk.lengths)
        return pa.Table.from_arrays(
            [
                chunks["keys"].combine_chunks().flatten(),
                chunks["bodies"].combine_chunks().flatten(),
                pa.array(chunk.lengths),
                pa.array(np.bincount(text[count[chunk.token] > 0], minlength=n).astype(np.int64)),
                pa.array(np.bincount(text, np.log10(base)[chunk.token], n)),
                pa.array(np.bincount(text, np.log10(chance)[back], n)),
            ],
            names=["key", "body", "n_tokens", "n_known", "base_score", "score"],
        )

    return run


def _exchanged(texts: DataFrame, size: int, schema: str) -> tuple[DataFrame, int]:
    """Scores of all texts, and the training tokens, without a broadcast (see above)."""
    spark, kind = texts.sparkSession, texts.schema["key"].dataType.simpleString()
    bits = _grid(size, *train.__defaults__)  # the grid of ``train``
    rows = f"chunk long, keys array<{kind}>, bodies array<long>, learns array<boolean>, lengths array<long>"
    with arrow_rows(spark, TEXTS):
        cut = texts.select("key", "body", "learn", "text").mapInArrow(_chunks(FLUSH), f"{rows}, tokens binary, words binary")
        chunks = stage(cut, "lm-chunks")
    # About two million n-grams (32 MB) in a task, in some four groups of cells.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (16 << 20)))
    groups = (4 * parts - 1).bit_length()
    inside = {k: min(GROUPED, max(0, width - groups)) for k, width in ((_WORD, bits + FINER), (_PAIR, 2 * bits))}
    asks = "chunk long, kind int, group long, ngrams binary, times binary, cells binary"
    answer = "chunk long, kind int, group long, levels binary, counts binary, total long, distinct long"
    with arrow_rows(spark, TEXTS):
        asked = chunks.select("chunk", "learns", "lengths", "tokens", "words").mapInArrow(_ask(bits, inside), asks)
        dealt = asked.repartition(parts, "kind", "group").sortWithinPartitions("kind", "group")
        answers = stage(dealt.mapInArrow(_answer, answer), "lm-answers")
    sums = answers.agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).first()
    total, distinct = sums["total"] or 0, sums["distinct"] or 0
    told = (
        chunks.drop("learns")
        .groupBy("chunk")
        .cogroup(answers.select("chunk", "kind", "group", "levels", "counts").groupBy("chunk"))
        .applyInArrow(_tell(bits, total, distinct), schema)
    )
    return stage(told, "lm-scores"), total


def score(
    docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", model_bytes: int = MODEL_BYTES
) -> DataFrame:
    """One row per input row: key, n_tokens, n_known, train_tokens, base_score, score.

    ``learn`` says which rows the model learns from; all rows are scored. More than
    ``model_bytes`` of training text are scored by exchange instead of broadcasts.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    learn = F.coalesce(learn, F.lit(False))
    texts = docs.select(F.col(key).alias("key"), body.alias("text"), F.xxhash64(body).alias("body"), learn.alias("learn"))
    kind = texts.schema["key"].dataType.simpleString()
    schema = f"key {kind}, body long, n_tokens long, n_known long, base_score double, score double"
    size = texts.filter("learn").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > model_bytes:
        out, total = _exchanged(texts, size, schema)
        return _scores(out, total)
    with arrow_rows(spark, TEXTS):
        model, bits = train(texts.filter("learn").select("text"))
    passes, total = [], 0
    for block in _blocks(model, bits, model_bytes):
        total = block["total"]
        sent = spark.sparkContext.broadcast(block)
        block.clear()  # one block at a time on the driver
        with arrow_rows(spark, TEXTS):
            rows = texts.select("key", "body", "text").mapInArrow(_score(sent), schema)
            passes.append(stage(rows, "lm-scores"))
        sent.destroy()
        del sent, rows
    out = passes[0]
    if len(passes) > 1:  # equal rows have equal sums, so their number divides out
        for more in passes[1:]:
            out = out.union(more)
        sums = out.groupBy("key", "body").agg(
            *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")],
            (F.count(F.lit(1)) / len(passes)).cast("long").alias("_rows"),
        )
        out = sums.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows")))).select(
            "key",
            *[(F.col(c) / F.col("_rows")).cast("long").alias(c) for c in ("n_tokens", "n_known")],
            *[(F.col(c) / F.col("_rows")).alias(c) for c in ("base_score", "score")],
        )
    return _scores(out, total)


def _scores(rows: DataFrame, total: int) -> DataFrame:
    return rows.select(
        "key", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
