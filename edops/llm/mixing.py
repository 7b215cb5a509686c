"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source size`` times, which is
rarely a whole number. The whole part is fixed; the fractions are rounded together:
two documents meet, mass moves from one to the other (weighted by their sizes, in a
random direction that keeps both expectations) until one fraction is 0 or 1, and the
other goes on to the next meeting. So the words taken from a source differ from its
target by at most half a document, and every other document keeps its own probability.

Meetings run in a reduction tree. Documents are dealt by hash into runs of about
``FAN_IN``; each run is folded by itself and leaves one undecided document, and the
undecided ones of all runs form the next level. A source that holds most rows is just
more runs. Everything is DataFrame expressions.

Defined cases: a null source is a source of its own, ordered last; a null or empty text
has size 0, adds nothing to any target and rounds by its own draw; of ``n`` rows that
agree in every column ``n`` times the share are taken once more, rounded as one document
is; rows that differ in any column round apart; an empty table gives an empty result; extra
columns are kept inside ``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from edops.llm.common import WORD, named, number_rows, unit_draw, whole_row
from edops.session import stage

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3.0
FAN_IN = 64
_UNIT = "struct<size:bigint,id:bigint,share:double>"


def word_count(text: str = "text") -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_REPEATS
) -> DataFrame:
    """(source, source_size, target): shares of the total by weight, none above ``most`` sizes.

    Input is one row per document with ``source`` and ``size``. Sources are ordered by code
    point, null last, and take the weights in turn. The result has one row per source. A
    target that meets its bound stops there and the excess is shared again by weight; the
    sources that stop are those with the smallest bound per weight, so one ordered pass
    over the sources finds the final level.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    # Up to source k in the order of bound per weight all stop; the level of the others follows.
    order = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(earlier), F.lit(0.0))
    ) / F.sum("weight").over(later)
    leveled = sources.withColumn("level", level)
    free = F.col("level") * F.col("weight") <= F.col("bound")
    # The first source that the level does not lift above its bound sets it for all after it.
    final = F.min(F.when(free, F.struct(F.col("bound") / F.col("weight"), F.col("level")))).over(everything)["level"]
    target = F.least(F.col("bound"), F.coalesce(final * F.col("weight"), F.col("bound")))
    return leveled.select("source", "source_size", target.alias("target"))


def _meet(state: Column, unit: Column, seed: int) -> Column:
    """One meeting of the undecided unit of ``state`` with ``unit``."""
    a, b = state["rest"], unit
    pa, pb, sa, sb = a["share"], b["share"], a["size"].cast("double"), b["size"].cast("double")
    up = F.least(1 - pa, pb * sb / sa)  # a gains, b pays
    down = F.least(pa, (1 - pb) * sb / sa)  # a pays, b gains
    lifted = unit_draw(F.lit(seed), a["id"], b["id"]) * (up + down) < down
    move = F.when(lifted, up).otherwise(-down)
    # The side that hits its bound gets the exact bound, so no rounding error survives.
    a_ends = F.when(lifted, 1 - pa <= pb * sb / sa).otherwise(pa <= (1 - pb) * sb / sa)
    to_a = F.when(a_ends, F.when(lifted, 1.0).otherwise(0.0)).otherwise(pa + move)
    to_b = F.when(a_ends, pb - move * sa / sb).otherwise(F.when(lifted, 0.0).otherwise(1.0))
    to_b = F.greatest(F.lit(0.0), F.least(F.lit(1.0), to_b))
    to_a = F.greatest(F.lit(0.0), F.least(F.lit(1.0), to_a))
    ended = F.when(a_ends, F.struct(a["size"], a["id"], to_a.alias("share"))).otherwise(
        F.struct(b["size"], b["id"], to_b.alias("share"))
    )
    rest = F.when(a_ends, F.struct(b["size"], b["id"], to_b.alias("share"))).otherwise(
        F.struct(a["size"], a["id"], to_a.alias("share"))
    )
    return F.struct(
        F.concat(state["done"], F.array(ended.cast(_UNIT))).alias("done"), rest.cast(_UNIT).alias("rest")
    )


def round_shares(units: DataFrame, group: str, seed: int = 0, fan_in: int = FAN_IN) -> DataFrame:
    """Round the fractions ``share`` of units (``group``, id, size > 0) to 0 or 1.

    The size-weighted sum of each group moves by at most half a unit: the one unit that
    no meeting decides goes to its nearer side. Returns (``group``, id, size,
    share). Each level is one stored table a ``fan_in``-th of the one before.
    """
    decided, rest, level = [], units.select(group, "id", "size", "share"), 0
    while True:
        runs = rest.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(fan_in)).alias("_runs"))
        runs = stage(runs.withColumnRenamed(group, "_group"), "mix-runs")
        most = runs.agg(F.max("_runs")).first()[0]
        if most is None:
            break
        run = F.pmod(F.xxhash64(F.lit(seed + level), F.col("id")), F.col("_runs"))
        unit = F.struct("size", "id", "share").cast(_UNIT)
        dealt = rest.join(runs, F.col(group).eqNullSafe(F.col("_group"))).withColumn("_run", run)
        lists = dealt.groupBy(group, "_run").agg(F.sort_array(F.collect_list(unit), asc=False).alias("units"))
        folded = lists.select(
            group,
            F.aggregate(
                F.slice("units", F.lit(2), F.size("units")),
                F.struct(F.array().cast(f"array<{_UNIT}>").alias("done"), F.col("units")[0].alias("rest")),
                lambda state, unit: _meet(state, unit, seed),
            ).alias("fold"),
        )
        table = stage(folded.select(group, "fold.done", "fold.rest"), "mix-level")
        decided.append(table.select(group, F.explode("done").alias("u")))
        rest = table.select(group, "rest.id", "rest.size", "rest.share")
        if most <= 1:
            break
        level += 1
    last = rest.withColumn("share", (F.col("share") >= 0.5).cast("double"))
    out = last.select(group, "id", "size", "share")
    for table in decided:
        out = out.union(table.select(group, "u.id", "u.size", "u.share"))
    return out


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST_REPEATS,
    seed: int = 0,
) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), size, source_size, target and copies.

    ``copies`` (0 to ``most``) says how often the mix takes a document; equal input gives
    equal output. The texts are read once for the sizes and hashes; everything after works on
    a small stored table. Rows of a repeated row that are not all taken equally often are
    numbered in runs, however many they are.
    """
    others = [named(c) for c in docs.columns if c not in (key, text, source)]
    rest = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}) if others else F.lit("")
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull(), rest)
    sized = docs.select(
        whole_row(docs.columns).alias("row"), F.col(key).alias("_key"), F.col(source).alias("_from"), word_count(text).alias("_size"), body.alias("_body")
    )
    name = F.coalesce(F.col("_key").cast("string"), F.lit("null"))
    sized = sized.withColumn("_unit", F.xxhash64(name, F.col("_from"), F.col("_size"), F.col("_body")))
    small = sized.select(F.col("_unit").alias("id"), F.col("_body").alias("body"), F.col("_from").alias("source"), F.col("_size").alias("size"))
    small = small.groupBy("id", "body", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    small = stage(small, "mix-sizes")
    targets = stage(
        source_targets(small.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, most),
        "mix-targets",
    ).withColumnRenamed("source", "_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    small = small.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn("ratio", ratio)
    small = small.withColumn("whole", F.floor("ratio").cast("long"))
    # Of the extra copies of a unit's rows the whole ones are sure; the rest of one row is rounded.
    extra = (F.col("ratio") - F.col("whole")) * F.col("rows")
    small = small.withColumn("sure", F.floor(extra).cast("long")).withColumn("share", extra - F.floor(extra))
    open_units = small.filter("size > 0 and share > 0").select("source", "id", "size", "share")
    rounded = round_shares(open_units, "source", seed).select(
        F.col("source").alias("_from"), F.col("id").alias("_id"), F.col("size").alias("_mass"), F.col("share").alias("_up")
    )
    alone = (unit_draw(F.lit(seed), F.col("id"), 2) < F.col("share")).cast("double")
    up = F.coalesce(F.col("_up"), F.when(F.col("size") == 0, alone), F.lit(0.0)).cast("long")
    same = (F.col("id") == F.col("_id")) & (F.col("size") == F.col("_mass")) & F.col("source").eqNullSafe(F.col("_from"))
    plan = small.join(rounded, same, "left").select(
        F.col("id").alias("_k"), F.col("body").alias("_b"), "source_size", "target", "whole", "rows", (F.col("sure") + up).alias("more")
    )
    plan = stage(plan, "mix-plan")
    planned = sized.join(plan, (F.col("_unit") == F.col("_k")) & (F.col("_body") == F.col("_b")))
    planned = planned.select("row", F.col("_size").alias("size"), "source_size", "target", "whole", "rows", "more", "_k", "_b")
    out = ["row", "size", "source_size", "target"]
    alike = planned.select(*out, (F.col("whole") + (F.col("more") > 0).cast("long")).alias("copies"), "rows", "more")
    if plan.filter("0 < more and more < rows").isEmpty():
        return alike.select(*out, "copies")
    # Equal rows are interchangeable, so any stored number deals them.
    mixed = stage(planned.filter("0 < more and more < rows").withColumn("_nth", F.monotonically_increasing_id()), "mix-repeats")
    mixed = number_rows(mixed, ["_k", "_b"], ["_nth"], "_at")
    mixed = mixed.select(*out, (F.col("whole") + (F.col("_at") < F.col("more")).cast("long")).alias("copies"))
    return alike.filter("more = 0 or more = rows").select(*out, "copies").union(mixed)


def take(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as its ``copies`` say."""
    taken = mixed.filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).select("row.*")
