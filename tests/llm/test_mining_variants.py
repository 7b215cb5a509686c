"""Hard negatives, nearest neighbours and spelling variants against brute force."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from edops.llm import ann_tree, hard_negatives as H, variants as V
from llm_helpers import make, prose

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, extra=False, kind="float"):
    df = spark.createDataFrame([(k, None if v is None else list(v), c) for k, v, c in rows], f"vec_id long, embedding array<{kind}>, label long")
    if extra:
        df = df.selectExpr("*", "1 as row", "2 as id", "'x' as dim", "0 as rank", "'y' as `a.b`", "'z' as `q``r`")
    return df


def sound(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def some_rows(seed, n, dim=24, copies=20):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dim))
    rows = [(i, np.float32(centres[i % 6] + draw.normal(size=dim)).tolist(), int(draw.integers(4))) for i in range(n)]
    rows += [(n + i, rows[3][1], i % 4) for i in range(copies)] + [rows[0], rows[0], rows[5]]
    rows += [(None, [0.6 * x for x in rows[0][1]], c) for c in range(4)]
    rows += [(None, rows[1][1], 1), (None, rows[2][1], 2), (7000, None, 1), (7001, [], 1), (7002, [], 2), (7100, [], 3)]
    rows += [(7200, [0.0] * dim, 1), (7300, [NAN] + [1.0] * (dim - 1), 1), (7400, [None] * dim, 1), (7500, [INF] * dim, 1)]
    rows += [(7600, rows[4][1], None), (7700, [1.0, 2.0], 1), (7701, [2.0, 1.0], 2), (7702, [3.0, 1.0], 1)]
    return rows


def brute_negatives(rows, scale=256):
    rows = [(k, [int(np.floor(np.float64(x) * scale)) for x in v], c) for k, v, c in rows if sound(v) and c is not None]
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = collections.Counter()
    for at, (k, v, c) in enumerate(rows):
        if k is None or k % 100:
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), j, d) for i, (j, w, d) in enumerate(rows) if i != at and len(v) == len(w)]
        own = sorted([(s, j) for s, j, d in scored if d == c], key=order)[:5]
        for score, j in own:
            inside = sorted([(s, o) for s, o, d in scored if d != c and 30 * score <= 100 * s <= 90 * score], key=order)[:10]
            out.update((k, j, r, o, score, s) for r, (s, o) in enumerate(inside, 1))
    return out


def mined(df):
    return collections.Counter(tuple(r) for r in H.mine(df, F.col("vec_id") % 100 == 0).collect())


@pytest.mark.parametrize("extra", [False, True])
def test_negatives_of_odd_rows_in_many_blocks(spark, monkeypatch, extra):
    monkeypatch.setattr(H, "ANCHORS", 3)
    monkeypatch.setattr(H, "ROWS", 90)
    rows = some_rows(1, 600)
    want = brute_negatives(rows)
    assert sum(want.values()) > 200 and any(r[3] is None for r in want)
    assert mined(vectors(spark, rows, extra)) == want


def test_negatives_of_huge_and_zero_components(spark):
    draw = random.Random(2)
    rows = [(100 * i, [draw.choice([1e15, 3e16, -2e15, 1.0]) for _ in range(5)], i % 2) for i in range(30)]
    rows += [(9000 + 100 * i, [0.0] * 5, i % 2) for i in range(6)]
    want = {r for r in brute_negatives(rows) if abs(r[4]) < 1 << 62 and abs(r[5]) < 1 << 62}
    got = mined(vectors(spark, rows, kind="double"))
    assert want <= set(got) and any(r[4] == 0 for r in got)
    assert mined(vectors(spark, [])) == mined(vectors(spark, rows[:1], kind="double")) == collections.Counter()


def test_intervals_hold_the_product():
    draw = np.random.default_rng(3)
    for dim in (1, 24, 64, 100, 300):
        x = np.floor(256 * draw.normal(size=(200, dim)) * draw.exponential(size=(200, 1)))
        codes, along, left = H.encode(x)
        length = np.sqrt((x * x).sum(axis=1))
        assert (np.diff(left, axis=1) <= 1e-9).all() and left[:, -1].mean() < 0.2 * length.mean()
        block = H.Rows.__new__(H.Rows)
        block.codes, block.along, block.left, block.length = codes, along, left, length
        for q in x[:20]:
            exact, seen = x @ q, []

            def keep(low, high):
                assert (low <= exact).all() and (exact <= high).all()
                seen.append((high - low).mean())
                return np.ones(len(low), bool)

            block.survivors(H.Anchor(q), np.arange(len(x)), keep)
            assert len(seen) == H.LEVELS and seen[-1] <= seen[0]


# ---- nearest neighbours ---------------------------------------------------------------


def brute_nearest(rows, k=20, every=20):
    rows = [(i, v) for i, v, _ in rows if sound(v) and any(v)]
    out = {}
    for at, (i, v) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = [(sum(np.float64(p) * np.float64(q) for p, q in zip(v, w)), j) for n, (j, w) in enumerate(rows) if n != at and len(v) == len(w)]
        best = sorted(scored, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]
        out.setdefault(i, []).append([(n, j, float(s)) for n, (s, j) in enumerate(best, 1)])
    return out


def neighbours(df):
    found, recall = ann_tree.nearest(df, F.col("vec_id") % 20 == 0)
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r["query_id"]].append((r["rank"], r["id"], r["score"]))
    return got, recall


@pytest.mark.parametrize("extra", [False, True])
def test_one_leaf_finds_all_neighbours_of_odd_rows(spark, extra):
    rows = some_rows(4, 300)
    got, recall = neighbours(vectors(spark, rows, extra))
    want = brute_nearest(rows)
    assert {k: sorted(x for part in v for x in part) for k, v in want.items() if any(v)} == {k: sorted(v) for k, v in got.items()}
    assert recall == {2: 1.0, 24: 1.0}


def test_visits_widen_to_the_recall_and_whole_trees_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "LEAF_ROWS", 40)
    monkeypatch.setattr(ann_tree, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann_tree, "BLOCK_QUERIES", 4)
    rows = some_rows(5, 2400, copies=400)
    want = {k: v for k, v in brute_nearest(rows).items() if any(v)}
    got, recall = neighbours(vectors(spark, rows))
    assert 0.95 <= recall[24] < 1
    hits = sum(len({x[1:] for x in got[k]} & {x[1:] for x in w}) for k, (w, *_) in want.items())
    assert hits >= 0.9 * sum(len(w) for w, *_ in want.values())
    for k, v in got.items():
        assert sorted(r for r, _, _ in v)[-1] <= 20 and len(v) == sum(len(w) for w in want[k])
    found, recall = ann_tree.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, recall=1.0)
    assert recall[24] == 1.0
    audited = {tuple(r)[:4] for r in found.select("query_id", "rank", "id", "score").collect()}
    assert {(k, *x) for k, parts in want.items() for x in parts[0]} == audited


def test_tree_places_every_vector_and_orders_every_leaf():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(3000, 8))
    tree = ann_tree.fit(x[:800], float(np.sqrt((x * x).sum(axis=1).max())), 3000 * 20)
    leaf = tree.place(x)
    assert 50 <= tree.leaves <= 800 and leaf.min() >= 0 and len(np.unique(leaf)) > 0.9 * tree.leaves
    for order in tree.order(x[:5], tree.leaves):
        assert sorted(order) == list(range(tree.leaves))
    same = ann_tree.fit(np.ones((100, 4)), 2.0, 10**6)
    assert same.leaves == 1


def test_no_vectors_and_only_queries(spark):
    assert neighbours(vectors(spark, [])) == ({}, {})
    assert neighbours(vectors(spark, [(20, [1.0], 1)]))[0] == {}
    assert dict(neighbours(vectors(spark, [(20, [1.0], 1), (1, [-2.0], 1)]))[0]) == {20: [(1, 1, -2.0)]}


# ---- spelling variants ----------------------------------------------------------------


def letters(c):
    return "a" <= c.lower() <= "z" and c.isascii() or "À" <= c <= "ÿ"


def brute_words(rows, noise=199, fewest=6, least=5):
    counts = collections.Counter()
    for k, text, *_ in rows:
        for run in "".join(c if letters(c) else " " for c in text or "").split(" "):
            if run:
                run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
                if h % noise == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= fewest and n >= least}


def one_off(a, b):
    if len(a) == len(b):
        return sum(p != q for p, q in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words, ratio=5):
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and one_off(v, w)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}
    out = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, words[w], len(near[w]), form.get(w), words.get(form.get(w)), root))
    return out


def grouped(df, **options):
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    return {tuple(r) for r in V.group_variants(df, **options).select(columns).collect()}


def misspelt(seed, n_docs):
    """Texts of few words and of their misspellings, rarer the further off."""
    draw = random.Random(seed)
    alphabet = "abcdezàéÿ×É"
    stems = ["".join(draw.choice(alphabet) for _ in range(draw.randint(5, 9))) for _ in range(12)]

    def spoil(w):
        at, c = draw.randrange(len(w)), draw.choice(alphabet)
        return draw.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]])

    pool = []
    for stem in stems:
        once = [spoil(stem) for _ in range(6)]
        pool += [stem] * 150 + [w for w in once for _ in range(20)] + [spoil(w) for w in once for _ in range(6)]
    marks = [" ", ",", "1", "\n", "’", "Ā", "-", "中"]
    return [(i, "".join(draw.choice(pool).title() + draw.choice(marks) for _ in range(60)), "en", "a") for i in range(n_docs)]


@pytest.mark.parametrize("clashing", [False, True])
@pytest.mark.parametrize("filter_bytes", [V.FILTER_BYTES, 128])
def test_variants_of_odd_texts(spark, clashing, filter_bytes):
    rows = misspelt(1, 400) + [(None, "nullid " * 9, None, None), (None, None, None, None), (5, "", "en", "a"), (5, "repeat " * 3, "en", "a"), (5, "repeat " * 3, "en", "a")]
    words = brute_words(rows)
    want = brute_variants(words)
    assert sum(r[3] is not None for r in want) > 30 and any(r[3] != r[5] and r[3] for r in want)
    assert grouped(make(spark, rows, clashing), filter_bytes=filter_bytes) == want


def test_long_texts_and_words(spark, monkeypatch):
    """A text above the slice size, and a word longer than the edits made at once."""
    monkeypatch.setattr(V, "PROBES", 900)
    draw = random.Random(3)
    long_word = "".join(draw.choice("abcé") for _ in range(400))
    changed = long_word[:200] + "z" + long_word[201:]
    text = " ".join([prose(9, 250_000), *[long_word] * 30, *[changed] * 5, *[long_word[:-1]] * 6])
    assert len(text) > 1 << 20
    rows = [(1, text, "en", "a"), (2, "abcdef " * 4, "en", "a")]
    words = {w: n for w, n in brute_words(rows, noise=10**9).items()}
    got = grouped(make(spark, rows), noise=10**9)
    assert {(r[0], r[1]) for r in got} == set(words.items())
    by_word = {r[0]: r for r in got}
    assert by_word[changed][2:] == (1, long_word, 30, long_word) and by_word[long_word[:-1]][3] == long_word
    assert by_word[long_word][2] == 2


def test_no_words(spark, no_docs):
    assert grouped(no_docs) == set() and grouped(make(spark, [(1, None), (2, "ab cd " * 9)])) == set()


def test_filters_miss_no_word():
    draw = random.Random(4)
    words = sorted({"".join(draw.choice("abcdef") for _ in range(draw.randint(6, 8))) for _ in range(3000)})
    h = V.mix(np.array([V.word_hash(w) for w in words], np.uint64))
    length = np.array([len(w) for w in words])
    for limit in (1 << 20, 1 << 10):
        sizes = V._sizes(dict(collections.Counter(length.tolist())), limit)
        rounds = V._rounds(sizes, limit)
        assert all(sum(sizes[n][1] * V.BLOCK_BYTES for n, _ in r) <= limit for r in rounds)
        assert sorted(x for r in rounds for x in r) == sorted((n, p) for n, (parts, _) in sizes.items() for p in range(parts))
