"""The numpy kernels against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from edops.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t \x1c\x0bZ.", max_size=40)), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    found = W.split_words(pa.array(texts, pa.string()))
    got = [[] for _ in texts]
    for t, a, b in zip(found.text, found.start, found.end):
        got[t].append(bytes(found.data[a:b]).decode())
    assert got == [WORD.findall(t or "") for t in texts]
    flat = [w for t in got for w in t]
    # Equal words have equal hashes and no two words share one.
    assert len(set(flat)) == len(set(found.hash.tolist())) == len(set(zip(flat, found.hash.tolist())))


def test_slices_hold_every_row_once():
    batch = pa.record_batch([pa.array(["x" * n for n in (5, 0, 40, 3, 3, 90, 1)])], ["text"])
    parts = list(W.slices(batch, "text", 10))
    assert [v for p in parts for v in p["text"].to_pylist()] == batch["text"].to_pylist()
    assert list(W.slices(batch.slice(0, 0), "text")) == []


def test_rolling_hash_depends_on_the_window_alone():
    hashes = W.mix(np.arange(50, dtype=np.uint64))
    for n in (1, 2, 3, 5, 6, 7, 10, 20):
        rolled = W.rolling(hashes, n)
        assert len(rolled) == 51 - n == len(set(rolled.tolist()))
        moved = W.rolling(np.concatenate([hashes[7 : 7 + n], hashes[:2]]), n)
        assert moved[0] == rolled[7]
    assert len(W.rolling(hashes[:3], 4)) == 0


def swapped_pair(letters: str, n: int = 1024) -> tuple[str, str]:
    """A word and the one with its two letters swapped, which a polynomial modulo 2^64 confuses."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


def test_the_second_hash_tells_words_apart_that_the_first_does_not():
    found = W.split_words(pa.array([" ".join(swapped_pair("ab"))]))
    assert found.hash[0] == found.hash[1]
    other = W.second_hash(found.data, found.start, found.end)
    assert other[0] != other[1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=90), min_size=1, max_size=12))
def test_the_second_hash_depends_on_the_word_alone(texts):
    found = W.split_words(pa.array([" ".join(texts)]))
    other = W.second_hash(found.data, found.start, found.end)
    assert len(set(zip(texts, other.tolist()))) == len(set(texts)) == len(set(other.tolist()))
