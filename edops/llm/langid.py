"""Language identification as a mixture of languages per document.

A model holds, for every learned language, the smoothed probabilities of letter trigrams.
Each word of a document is taken to come from one language; expectation-maximisation
estimates the shares of the languages from the trigram likelihoods of all its words. The
language set is chosen by penalised likelihood: sets of one, two, ... languages (the
largest shares first) are fitted, at least three and on as long as the Bayesian information
criterion improves, and the best set wins. The prediction is the language with the largest share, and the score is that share.

Everything runs over whole texts, batch by batch in numpy; the model is one row of counts
per language, counted over all training texts, and nothing else leaves the tasks.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every
text if nothing was learned; letters are A to Z and every code point from U+0080 on, so signs
beyond ASCII count as letters of a word; very long texts are taken whole; rows without a language or text teach nothing; ties go to the
language that sorts first; equal texts get equal results; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from edops.llm.common import TEXTS, arrow_rows
from edops.llm.words import slices, text_bytes
from edops.session import stage

BUCKET_BITS = 15
SMOOTHING = 0.2
STEPS = 12  # rounds of expectation-maximisation
TRIED = 3  # language sets of so many are always fitted; larger ones while they are better
UNKNOWN = "und"
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[ord("A") : ord("Z") + 1] = True
_LETTER[0x80:] = True


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, first of each word, text of each word) of the letter trigrams of lower-cased texts.

    A word is a run of letters; every byte of it has one trigram, with a blank beyond its ends.
    """
    data, bounds = text_bytes(pc.utf8_lower(column))
    letter = _LETTER[data]
    shown = np.where(letter, data, 0x20).astype(np.int64)
    opens = np.zeros(len(data) + 1, bool)  # a text starts here
    opens[bounds] = True
    before = np.concatenate([[0x20], shown[:-1]]) if len(data) else shown
    before[opens[:-1]] = 0x20
    after = np.concatenate([shown[1:], [0x20]]) if len(data) else shown
    after[opens[1:]] = 0x20
    at = np.flatnonzero(letter)
    code = ((before[at] << 16) | (shown[at] << 8) | after[at]).astype(np.uint64)
    bucket = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    starts = (before[at] == 0x20) | opens[:-1][at]
    first = np.flatnonzero(starts)
    text = np.searchsorted(bounds, at[first], "right") - 1
    return bucket, first, text


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language, summed over the whole partition."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch["lang"].to_pylist()
        for lang in set(langs):
            rows = batch.filter(pc.equal(batch["lang"], lang))
            total = counts.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
            for part in slices(rows, "text"):
                bucket, _, _ = trigrams(part["text"])
                total += np.bincount(bucket, minlength=1 << BUCKET_BITS)
    for lang, total in counts.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])], ["lang", "bucket", "n"]
        )


def train(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and the (language, bucket) log probabilities, from columns text and lang.

    The result is as large as the number of languages times 2^15, whatever the input.
    """
    with arrow_rows(rows.sparkSession, TEXTS):
        counted = rows.filter("text is not null and lang is not null").select("text", "lang").mapInArrow(
            _count, "lang string, bucket int, n long"
        )
        sums = stage(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "lang-counts")
    langs = sorted(r["lang"] for r in sums.select("lang").distinct().collect())
    table = np.zeros((len(langs), 1 << BUCKET_BITS))
    for i, lang in enumerate(langs):
        own = sums.filter(F.col("lang") == lang).select("bucket", "n").toArrow()
        table[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    total = table.sum(axis=1, keepdims=True)
    return langs, np.log((table + SMOOTHING) / (total + SMOOTHING * (1 << BUCKET_BITS)))


def mixture(likelihood: np.ndarray, text: np.ndarray, n_texts: int, allowed: np.ndarray, steps: int = STEPS):
    """Shares of the allowed languages per text, and the log likelihood of its words.

    ``likelihood`` is (words, languages), scaled to a largest value of 1 per word; ``text`` is
    ascending. Returns (shares, log likelihood without the scale).
    """
    words = np.bincount(text, minlength=n_texts)
    full = np.flatnonzero(words)
    first = np.searchsorted(text, full)
    shares = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    for _ in range(steps):
        part = likelihood * shares[text]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        shares[full] = np.add.reduceat(part, first, axis=0) / words[full, None]
    mass = np.log(np.maximum((likelihood * shares[text]).sum(axis=1), 1e-300))
    return shares, np.bincount(text, mass, n_texts)


def detect(column: pa.Array, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language number, share) of every text; -1 without a word."""
    bucket, first, text = trigrams(column)
    n_texts, n_langs = len(column), len(logs)
    if not len(first) or not n_langs:
        return np.full(n_texts, -1), np.zeros(n_texts)
    sums = np.stack([np.add.reduceat(row[bucket], first) for row in logs], axis=1)
    likelihood = np.exp(sums - sums.max(axis=1, keepdims=True))
    words = np.bincount(text, minlength=n_texts)
    shares, _ = mixture(likelihood, text, n_texts, np.ones((n_texts, n_langs)))
    rank = np.argsort(np.argsort(-shares, axis=1, kind="stable"), axis=1, kind="stable")
    best = np.full(n_texts, -np.inf)
    chosen = np.zeros((n_texts, n_langs))
    open_, own = np.arange(n_texts), text
    for k in range(1, n_langs + 1):
        allowed = (rank[open_] < k).astype(float)
        fitted, mass = mixture(likelihood, own, len(open_), allowed, STEPS if k > 1 else 1)
        # Each language beyond the first adds one free share.
        value = mass - 0.5 * (k - 1) * np.log(np.maximum(words[open_], 2))
        better = value > best[open_] + 1e-9
        best[open_[better]], chosen[open_[better]] = value[better], fitted[better]
        if k >= TRIED:  # go on with the texts that got better
            inside = better[own]
            own, likelihood = (np.cumsum(better) - 1)[own[inside]], likelihood[inside]
            open_ = open_[better]
        if not len(open_):
            break
    lang = np.where(words > 0, chosen.argmax(axis=1), -1)
    return lang, np.where(words > 0, chosen.max(axis=1), 0.0)


def _predict(langs: list[str], logs: np.ndarray):
    names = np.array([*langs, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lang, share = detect(part["text"], logs)
                known = part["letters"].to_numpy(zero_copy_only=False).astype(bool) & (lang >= 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        pa.array(names[np.where(known, lang, -1)], pa.string()),
                        pa.array(np.where(known, np.clip(share, 0, 1), 0.0)),
                    ],
                    ["key", "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: key, lang_pred, score. ``learn`` says which rows teach the model."""
    spark = docs.sparkSession
    langs, logs = train(docs.filter(learn).select(F.col(text).alias("text"), F.col(lang).alias("lang")))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"), body.rlike(r"\p{L}").alias("letters"))
    kind = rows.schema["key"].dataType.simpleString()
    with arrow_rows(spark, TEXTS):
        found = rows.mapInArrow(_predict(langs, logs.astype(np.float32)), f"key {kind}, lang_pred string, score double")
        return stage(found, "lang-predictions")
