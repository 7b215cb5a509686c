"""Near duplicates and repeated word sequences against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest

from edops.llm import minhash, substrings
from llm_helpers import make, prose, words_of
from test_words import swapped_pair


def shingles(text, n):
    words = [w.translate({i: i + 32 for i in range(65, 91)}) for w in words_of(text)]
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute_components(rows, n, numerator, denominator):
    """Smallest key that links reach, per row number."""
    sets = [shingles(r[1], n) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and denominator * common >= numerator * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(w if draw.random() > share else f"new{draw.random()}" for w in text.split(" "))


def near_of(df, **how):
    rows = minhash.near_duplicates(df, **how).collect()
    return collections.Counter((r["key"], r["n_shingles"], r["component"]) for r in rows)


@pytest.mark.parametrize("n,similarity", [(3, (85, 100)), (5, (80, 100))])
def test_near_duplicates_on_odd_rows(odd_docs, odd_rows, n, similarity):
    want = collections.Counter(brute_components(odd_rows, n, *similarity))
    assert near_of(odd_docs, size=n, similarity=similarity) == want


def test_groups_larger_than_a_block(spark):
    """Chains of edits and a hot group of copies, cut into blocks of four."""
    base = [prose(100 + i, 120) for i in range(4)]
    rows = [(7 * i % 101, edited(base[i % 4], 0.001 * (i % 50), i)) for i in range(80)]
    rows += [(200 + i, base[0]) for i in range(150)]
    want = collections.Counter(brute_components(rows, 3, 85, 100))
    assert near_of(make(spark, rows), size=3, similarity=(85, 100), block=4) == want


def test_no_documents_have_no_duplicates(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert substrings.remove_repeats(no_docs).count() == 0


def brute_repeats(rows, length=20):
    """Removed words by the definition; rows of one key must be equal."""
    seen, out = set(), {}
    for key, text in sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = words_of(text)
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        kept = [w for w, g in zip(words, gone) if not g]
        out[key] = (len(words), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept)
    return out


def check_repeats(df, rows):
    want, got = brute_repeats(rows), substrings.remove_repeats(df).collect()
    assert collections.Counter(r["key"] for r in got) == collections.Counter(r[0] for r in rows)
    for r in got:
        n, gone, sha, kept = want[r["key"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, sha)
        assert (r["cut"] is None) == (gone == 0)
        if gone:
            assert words_of(r["cut"]) == kept


def test_repeats_on_odd_rows(odd_docs, odd_rows):
    check_repeats(odd_docs, odd_rows)


def test_passages_in_many_places(spark):
    """Shared passages that overlap, repeat inside a text and stand at both ends."""
    draw = random.Random(5)
    passages = [prose(300 + i, 18 + 4 * i) for i in range(8)]
    rows = []
    for i in range(120):
        parts = [prose(1000 + i * 7 + j, draw.randint(0, 30)) for j in range(3)]
        parts += draw.choices(passages, k=draw.randint(0, 3))
        draw.shuffle(parts)
        rows.append((draw.randint(0, 10**12), " \n".join(parts)))
    rows += [(5_000 + i, "same words again and " * 30) for i in range(10)]
    check_repeats(make(spark, rows), rows)


def test_windows_that_only_one_hash_takes_for_equal(spark):
    """Two long words of one hash: windows around them are equal to it, across and inside texts."""
    one, other = swapped_pair("ab")
    left, right = prose(41, 25), prose(42, 25)
    rows = [(1, f"{left} {one} {right}"), (2, f"{prose(43, 30)} {left} {other} {right}")]
    left, right = prose(44, 12), prose(45, 12)
    rows += [(3, f"{left} {one} {right} {prose(46, 9)} {left} {other} {right}"), (4, f"{left} {one} {right}")]
    check_repeats(make(spark, rows), rows)


@pytest.mark.parametrize("seed", [1, 5, 20])
def test_any_seed_length_finds_the_same(spark, seed):
    passages = [prose(500 + i, 22) for i in range(4)]
    rows = [(i, f"{prose(600 + i, 15)} {passages[i % 4]} {prose(700 + i, 9)} {passages[i * i % 4]}") for i in range(24)]
    want = {k: v[1:3] for k, v in brute_repeats(rows).items()}
    got = substrings.remove_repeats(make(spark, rows), seed=seed).collect()
    assert {r["key"]: (r["n_removed"], r["kept_sha256"]) for r in got} == want


def test_cut_keeps_the_white_space_of_kept_words(spark):
    copy = prose(9, 25)
    rows = [(1, copy), (2, f"first\tline\n\n{copy} last  line\n")]
    cuts = {r["key"]: r["cut"] for r in substrings.remove_repeats(make(spark, rows)).collect()}
    assert cuts == {1: None, 2: "first\tline\n\nlast  line\n"}
