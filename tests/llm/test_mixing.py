from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

from llm_helpers import make, prose, words_of
from edops.llm import mixing


def water_fill(sizes: dict, weights=(5, 2, 1), most=3):
    """Shares by weight; what exceeds a bound is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, open_ = float(sum(sizes.values())), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_sizes_targets_and_bounds(odd_docs, odd_rows):
    rows = mixing.mix(odd_docs).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert len(rows) == len(odd_rows)
    sizes = collections.Counter()
    for r in odd_rows:
        sizes[r[3]] += len(words_of(r[1]))
    target = water_fill(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and 0 <= r.copies <= 3
        assert r.target == pytest.approx(target[r.source])
        if r.target == 3 * r.source_size:
            assert r.copies == 3
    assert collections.Counter((r.doc_id, r.size) for r in rows) == collections.Counter(
        (r[0], len(words_of(r[1]))) for r in odd_rows
    )


def test_taken_words_come_near_and_reruns_agree(spark):
    rows = [(i, prose(i, 5 + i % 60), "en", ["a", "b", "c", None][(i % 10) // 3]) for i in range(3000)]
    docs = make(spark, rows)
    first, second = (
        sorted(mixing.mix(d).select("row.doc_id", "copies").collect()) for d in (docs, docs.repartition(7))
    )
    assert first == second
    copies = dict(first)
    taken, size = collections.Counter(), collections.Counter()
    for i, text, _, source in rows:
        taken[source] += len(text.split()) * copies[i]
        size[source] += len(text.split())
    for source, want in water_fill(size).items():
        assert abs(taken[source] - want) <= 33  # half of the longest document
        ratio = want / size[source]
        assert {copies[r[0]] for r in rows if r[3] == source} <= {int(ratio), int(ratio) + 1}


def test_rounding_keeps_each_share(spark):
    """Over many seeds a unit of share 0.3 is taken in about 30 % of them."""
    units = spark.range(40).select(F.lit("g").alias("g"), "id", (1 + F.col("id") % 5).cast("long").alias("size"), F.lit(0.3).alias("share"))
    up = collections.Counter()
    for seed in range(12):
        rows = mixing.round_shares(units, "g", seed, fan_in=8).collect()
        assert sorted(r["id"] for r in rows) == list(range(40)) and {r["share"] for r in rows} <= {0.0, 1.0}
        assert abs(sum(r["share"] * r["size"] for r in rows) - 0.3 * 120) <= 2.5
        up.update(r["id"] for r in rows if r["share"] == 1)
    assert 0.2 < sum(up.values()) / (12 * 40) < 0.4 and max(up.values()) < 12


def test_take_repeats_rows(spark, odd_docs):
    mixed = mixing.mix(odd_docs)
    taken = mixing.take(mixed)
    assert taken.columns == odd_docs.columns
    assert taken.count() == mixed.agg(F.sum("copies")).first()[0]


def test_rows_without_a_key_round_apart(spark):
    """One key, source and size for nearly all rows: different texts, and one row many times."""
    rows = [(None, prose(i, 20), "en", "a") for i in range(300)] + [(None, prose(999, 20), "en", "a")] * 301
    rows += [(i, prose(2000 + i, 20), "en", "b") for i in range(500)]
    want = water_fill({"a": 601 * 20, "b": 500 * 20})
    got = mixing.mix(make(spark, rows)).select("row.source", "row.text", "size", "copies").collect()
    assert len(got) == len(rows)
    for source in "ab":
        assert abs(sum(r["size"] * r["copies"] for r in got if r.source == source) - want[source]) <= 10  # half a document
    share = want["a"] / (601 * 20) % 1
    repeated = [r["copies"] for r in got if r.text == prose(999, 20)]
    assert 0.05 < share < 0.95 and abs(sum(c - min(repeated) for c in repeated) - share * 301) <= 1


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.take(mixing.mix(no_docs)).columns == no_docs.columns
