"""Words and rolling hashes of whole text batches, in numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 that equals
``[^\\x20\\x09-\\x0D]+`` over code points. All functions work on a whole Arrow batch at
once, so the cost per text is a few array passes and no Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_FILL = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 20
PLACES = 64  # letters of a word with random values of their own
_VALUES = np.random.default_rng(21).integers(0, (1 << 64) - 1, (PLACES, 256), dtype=np.uint64, endpoint=True)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes (the published splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a batch: text number, byte range in ``data`` and hash of each."""

    data: np.ndarray  # bytes of all texts of the batch
    bounds: np.ndarray  # byte bounds of each text, one more than texts
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    @property
    def firsts(self) -> np.ndarray:
        """Index of each text's first word, and the number of words at the end."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and bounds of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes; a longer text stands alone."""
    if not len(batch):
        return
    _, bounds = text_bytes(batch.column(column))
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """Words of every text; ``lower`` maps A-Z to a-z first."""
    data, bounds = text_bytes(column)
    if lower:
        data = _LOWER[data]
    word = ~_SPACE[data]
    # A word never crosses the bound of two texts.
    left = np.empty(len(data), bool)
    if len(data):
        left[0], left[1:] = True, ~word[:-1]
        inner = bounds[(bounds > 0) & (bounds < len(data))]
        left[inner] = True
    start = np.flatnonzero(word & left)
    right = np.empty(len(data), bool)
    if len(data):
        right[-1], right[:-1] = True, left[1:] | ~word[1:]
    end = np.flatnonzero(word & right) + 1
    text = np.searchsorted(bounds, start, "right") - 1
    return Words(data, bounds, text, start, end, hash_ranges(data, start, end))


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each byte range: random byte values times powers of an odd step."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    longest = int(length.max())
    power = np.cumprod(np.full(longest, STEP, np.uint64))
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    inside = np.arange(int(length.sum())) - np.repeat(first, length)
    terms = _FILL[data[np.repeat(start, length) + inside]] * power[inside]
    return mix(np.add.reduceat(terms, first) + length.astype(np.uint64))


def second_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Tabulation hash of each byte range, independent of ``hash_ranges``.

    Every place of a word has random values of its own, so that no pattern of letters makes
    two words agree; beyond ``PLACES`` letters the values are mixed from letter and place.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    inside = np.arange(int(length.sum())) - np.repeat(first, length)
    letter = data[np.repeat(start, length) + inside].astype(np.int64)
    terms = _VALUES.ravel()[np.minimum(inside, PLACES - 1) * 256 + letter]
    far = np.flatnonzero(inside >= PLACES)
    if len(far):
        terms[far] = mix(terms[far] + inside[far].astype(np.uint64) * STEP)
    return mix(np.add.reduceat(terms, first) ^ length.astype(np.uint64))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive hashes (as many as there are starts), by doubling.

    The first ``len - n + 1`` entries are right; callers keep starts inside one text.
    """
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total, done, block, size = None, 0, hashes, 1
    base = int(STEP)
    while True:
        if n & size:
            if total is None:
                total = block
            else:  # append the block after the part that is done
                step = np.uint64(pow(base, size, 1 << 64))
                total = total[: len(block) - done] * step + block[done:]
            done += size
        if size * 2 > n:
            break
        step = np.uint64(pow(base, size, 1 << 64))
        block = block[: len(block) - size] * step + block[size:]
        size *= 2
    return mix(total[: len(hashes) - n + 1] + np.uint64(n))


def starts_of(words: Words, n: int) -> np.ndarray:
    """Which words start an ``n``-word window inside their own text (mask over words)."""
    keep = np.zeros(len(words.text), bool)
    if len(keep) >= n:
        keep[: len(keep) - n + 1] = words.text[: len(keep) - n + 1] == words.text[n - 1 :]
    return keep
