"""Exact order statistics against sorted lists."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from edops.operators import order_stats as O

RANKS = {"low": O.LOWER_MIDDLE, "high": O.UPPER_MIDDLE, "p90": O.nearest_rank(0.9), "least": lambda n: F.lit(0), "most": lambda n: n - 1}


def brute(values):
    values = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    n = len(values)
    if not n:
        return (0, None, None, None, None, None)
    last = n - 1
    return (n, values[last // 2], values[-(-last // 2)], values[round(last * 0.9)], values[0], values[-1])


@pytest.mark.parametrize("few", [3, 300, 10**6])
def test_ranks_of_skewed_groups(spark, few):
    draw = random.Random(1)
    data = {
        ("hot", 1): [draw.lognormvariate(0, 9) * draw.choice([-1, 1]) for _ in range(4000)],
        ("hot", None): [draw.choice([1.0, 2.0, 2.0, 3.5]) for _ in range(900)],
        (None, 2): [7.25] * 700 + [None] * 5,
        ("one", 3): [-0.5],
        ("two", 3): [4.0, 1.0],
        ("none", 4): [None, None],
        ("wide", 5): [1e300, -1e300, 5e-324, 0.0, math.inf, -math.inf] * 50 + [float(i) for i in range(300)],
    }
    rows = [(*key, v) for key, values in data.items() for v in values]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "name string, `no.` int, x double").withColumnRenamed("no.", "number")
    got = O.order_statistics(df, ["name", "number"], "x", RANKS, few).collect()
    assert {(r["name"], r["number"]): tuple(r)[2:] for r in got} == {key: brute(v) for key, v in data.items()}


def test_no_groups_and_no_rows(spark):
    values = [((i * 7919) % 5003) / 7 for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert tuple(O.order_statistics(df, [], "x", RANKS, 100).first()) == brute(values)
    assert O.order_statistics(df.limit(0).withColumn("g", F.lit(1)), ["g"], "x", RANKS).count() == 0


def test_every_round_leaves_a_small_share(spark):
    """A million distinct values: two rounds, and the rank stays enclosed."""
    rows = spark.range(1_000_000).select(F.lit(1).alias("_g0"), ((F.col("id") * 999_983) % 1_000_003 / F.lit(3.0)).alias("_v"))
    search = spark.createDataFrame([(1, 0, 899_999, 1_000_000, None, None)], "_g0 int, rank int, k long, left long, lo double, hi double")
    first = O._narrow(rows, search, ["_g0"]).first()
    assert first["left"] < 10_000 and first["lo"] < first["hi"]
    exact = sorted((i * 999_983) % 1_000_003 / 3.0 for i in range(1_000_000))[899_999]
    assert first["lo"] <= exact <= first["hi"]
    assert O.order_statistics(rows, ["_g0"], "_v", {"p90": O.nearest_rank(0.9)}, 1000).first()["p90"] == exact
