"""Quality rules by repetition coverage.

For every whole text: rolling hashes of word n-grams of several lengths, in numpy over a
batch of texts at once, and the share of the text's characters that lie inside n-grams and
lines that repeat an earlier one. The limits are the published ones of the Gopher rules
(Rae et al., 2021), without the one on the number of repeated lines: it counts lines and
not characters, and rejects clean texts of three lines for one short line that recurs.

Defined cases: null is an empty text; a text without words has zero in every measure and
fails the base rule; lines without a word are no lines; every input row gives one row, so
equal rows give equal rows; an empty table gives an empty result; extra columns are
kept inside ``row`` if asked for, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from edops.llm.common import whole_row
from edops.llm.words import STEP, Words, hash_ranges, mix, slices, split_words

# Published limits on the share of characters.
TOP_NGRAM_SHARE = {2: 0.20, 3: 0.18, 4: 0.16}
REPEATED_NGRAM_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
REPEATED_LINE_CHAR_SHARE = 0.20

FEWEST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 50, 3, 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LONG = ("word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_SHARES = (
    *(f"top_{n}" for n in TOP_NGRAM_SHARE),
    *(f"repeated_{n}" for n in REPEATED_NGRAM_SHARE),
    "line_char_share",
)


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _key(value: np.ndarray, text: np.ndarray) -> np.ndarray:
    """One 64-bit key per (text, value); equal keys of different texts are not to be expected."""
    return value + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def _repeated(value: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which values occur at least twice in their text."""
    key = _key(value, text)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def _groups(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (text, value, place), whether each sorted entry opens a group, and group sizes."""
    key = _key(value, text)
    order = np.argsort(key, kind="stable")
    first = np.ones(len(order), bool)
    first[1:] = key[order][1:] != key[order][:-1]
    return order, first, np.diff(np.append(np.flatnonzero(first), len(order)))


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words covered by the ``n``-word windows at ``starts``."""
    edge = np.bincount(starts, minlength=words + 1) - np.bincount(starts + n, minlength=words + n + 1)[: words + 1]
    return np.cumsum(edge)[:words] > 0


def measure(words: Words) -> dict[str, np.ndarray]:
    """All measures of a batch of texts, one array entry per text."""
    n_texts, n_words = words.n_texts, len(words.hash)
    data, bounds = words.data, words.bounds
    point = (data & 0xC0) != 0x80  # first byte of a code point
    points = np.concatenate([[0], np.cumsum(point)])
    size = points[words.end] - points[words.start]
    total = np.concatenate([[0], np.cumsum(size)])
    chars = np.bincount(words.text, size, n_texts).astype(np.int64)
    out = {"n_words": words.counts.astype(np.int64), "word_chars": chars, "n_symbols": _sums(_SYMBOL[data], bounds)}
    share = np.maximum(chars, 1)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.bincount(words.text[mask], size[mask], n_texts) / share

    # A window repeats only if the window one word shorter does, so few are left to grow.
    open_, value = np.arange(n_words), words.hash
    for n in range(2, max(REPEATED_NGRAM_SHARE) + 1):
        inside = open_ + n <= n_words
        inside[inside] = words.text[open_[inside]] == words.text[open_[inside] + n - 1]
        open_, value = open_[inside], value[inside]
        value = mix(value * STEP + words.hash[open_ + n - 1])
        twice = _repeated(value, words.text[open_])
        open_, value = open_[twice], value[twice]
        order, first, sizes = _groups(value, words.text[open_])
        if n == REPEAT_WINDOW:
            out["n_repeat_words"] = np.bincount(words.text[_covered(open_, n, n_words)], minlength=n_texts)
        if n in TOP_NGRAM_SHARE:  # characters of the repeated n-gram that has the most of them
            head = open_[order[first]]
            most = np.zeros(n_texts)
            np.maximum.at(most, words.text[head], sizes * (total[head + n] - total[head]))
            out[f"top_{n}"] = np.minimum(most / share, 1.0)
        if n in REPEATED_NGRAM_SHARE:
            out[f"repeated_{n}"] = per_text(_covered(open_[order[~first]], n, n_words))
    return out | _lines(words, points, share)


def _lines(words: Words, points: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
    data, bounds, n_texts = words.data, words.bounds, words.n_texts
    breaks = np.flatnonzero(data == 0x0A)
    owner = np.concatenate([np.arange(n_texts), np.searchsorted(bounds, breaks, "right") - 1])
    order = np.lexsort((np.concatenate([bounds[:-1], breaks + 1]), owner))
    start, text = np.concatenate([bounds[:-1], breaks + 1])[order], owner[order]
    # A line ends at its line break or at the end of its text.
    end = np.append(start[1:] - 1, len(data))
    last = np.append(text[1:] != text[:-1], True)
    end[last] = bounds[1:][text[last]]
    held = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, text = start[held], end[held], text[held]
    order, first, _ = _groups(hash_ranges(data, start, end), text)
    again = order[~first]
    n_lines = np.bincount(text, minlength=n_texts)
    repeated = np.bincount(text[again], minlength=n_texts)
    # Characters of words in the repeated lines.
    size = points[words.end] - points[words.start]
    total = np.concatenate([[0], np.cumsum(size)])
    inside = total[np.searchsorted(words.start, end[again])] - total[np.searchsorted(words.start, start[again])]
    return {
        "n_lines": n_lines,
        "n_dup_lines": repeated,
        "line_char_share": np.bincount(text[again], inside, n_texts) / share,
    }


def _measure_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = measure(split_words(part["text"]))
            columns = [part["row"]]
            columns += [pa.array(found[c].astype(np.int64)) for c in ("n_words", *_LONG)]
            columns += [pa.array(found[c].astype(np.float64)) for c in _SHARES]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", *_LONG, *_SHARES])


def repetition(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measures and verdict of every row: ``row`` (a struct of the ``keep`` columns), all
    measures, base_failed and kept. One pass over the texts without a shuffle.
    """
    rows = docs.select(whole_row(keep).alias("row"), F.col(text).alias("text"))
    fields = [T.StructField("row", rows.schema["row"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("n_words", *_LONG)]
    fields += [T.StructField(c, T.DoubleType()) for c in _SHARES]
    measured = rows.mapInArrow(_measure_all, T.StructType(fields))
    base = (F.col("n_words") < FEWEST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    )
    repeats = F.col("line_char_share") > REPEATED_LINE_CHAR_SHARE
    for n, limit in TOP_NGRAM_SHARE.items():
        repeats |= F.col(f"top_{n}") > limit
    for n, limit in REPEATED_NGRAM_SHARE.items():
        repeats |= F.col(f"repeated_{n}") > limit
    return measured.withColumn("base_failed", base).withColumn("kept", ~(base | repeats))
