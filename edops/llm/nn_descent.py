"""Near-duplicate embeddings by NN-descent (Dong, Moses and Li, 2011).

A graph holds for every vector a list of its nearest ones so far. It starts from random
hyperplane buckets, and each round joins the neighbours of every vector, forward and
backward, with each other: a neighbour of a neighbour is likely a neighbour. Lists that
hold nothing but links are saturated and double. Rounds go on until few entries change, at
most ``ROUNDS``. Then tables drawn anew, more of them the more rows there are, look for links
between components; what they find is added, and while it stands for more than one link in
200, further tables follow.

Links of the graph at or above the threshold give components. Lists stop growing at
``LONGEST``, so two nodes whose lists are full of links may be linked without a list that
says so. Such nodes are gathered in balls around one of their neighbours. Balls of different
components whose centres and radii leave room for a link are compared member by member, and
components that touch there are joined. Inside each component all vectors are then compared
in double precision in blocks of ``BLOCK``, so the number of links is exact however dense a
group is. Large buckets, neighbourhoods, balls and components are dealt into several blocks;
no task holds one whole.

Defined cases: vectors that are null or empty, hold a null or a non-finite component or are
all zero link with nothing and stay; equal vectors are one node and count one another;
vectors of different length are never compared; a null id is kept, and a component without
any other id has none; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from edops.llm.common import arrow_rows, components
from edops.session import stage

THRESHOLD = 0.95
LIST, LONGEST = 8, 64
TABLES, BUCKET = 6, 64
MEETING = 0.9  # least chance of a pair at the threshold to share a bucket of some table
HOOD = 96
BLOCK = 512
SLACK = 1e-6  # radians by which rounding may move an angle
RECALL, ROUNDS, STILL = 0.995, 8, 0.01
_EDGE = "id long, nbr long, sim double"
_MEMBER = ("id", "vec", "floor", "k")


def _unit(lists: pa.Array) -> np.ndarray:
    """Rows of a list column of one length as unit vectors in double precision."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = values.reshape(len(lists), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _tables(n: int, threshold: float) -> tuple[int, int]:
    """Number of tables and of planes in each: more planes for more rows, and as many more tables."""
    bits = max(0, (max(1, n // BUCKET)).bit_length())
    chance = (1 - math.acos(threshold) / math.pi) ** bits
    return max(TABLES, math.ceil(math.log(1 - MEETING) / math.log1p(-chance))), bits


def _codes(tables: int, bits: int, salt: int):
    """One bucket per table: the signs of ``bits`` random projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["vec"].value_lengths().to_numpy(zero_copy_only=False)
            codes = np.zeros((len(batch), tables), np.int64)
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                planes = np.random.default_rng([int(dim), salt]).standard_normal((int(dim), tables * max(bits, 1)))
                side = (_unit(batch["vec"].take(pa.array(rows))) @ planes > 0).reshape(len(rows), tables, -1)
                codes[rows] = (side * (1 << np.arange(side.shape[2]))).sum(axis=2) if bits else 0
            bounds = np.arange(len(batch) + 1, dtype=np.int32) * tables
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([batch["id"], lists], ["id", "codes"])

    return run


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nearest members of each member inside each row's block, above the member's floor."""
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], []]
        members = batch["members"]
        for i in range(len(batch)):
            row = members.slice(i, 1).flatten()
            ids = row.field("id").to_numpy(zero_copy_only=False)
            floor = row.field("floor").to_numpy(zero_copy_only=False)
            wide = row.field("k").to_numpy(zero_copy_only=False)
            unit = _unit(row.field("vec"))
            sims = unit @ unit.T
            sims[ids[:, None] == ids[None, :]] = -2
            k = min(int(wide.max()), len(ids) - 1)
            top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            near = np.take_along_axis(sims, top, axis=1)
            use = near > floor[:, None]
            at = np.nonzero(use)
            out[0].append(ids[at[0]])
            out[1].append(ids[top[use]])
            out[2].append(near[use])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["id", "nbr", "sim"])


def _bucketed(nodes: DataFrame, tables: int, bits: int, salt: int) -> DataFrame:
    """Nodes with (tab, code) of each of their buckets."""
    codes = nodes.select("id", "vec").mapInArrow(_codes(tables, bits, salt), "id long, codes array<long>")
    buckets = codes.select(F.col("id").alias("_i"), F.posexplode("codes").alias("tab", "code"))
    return nodes.join(buckets, F.col("id") == F.col("_i"))


def _blocks(members: DataFrame, keys: list[str], size: int, columns: Sequence[str] = _MEMBER, salt: int = 0) -> DataFrame:
    """Rows (id, vec, ...) of each key gathered in blocks of about ``size`` by a salted hash of the id."""
    sizes = members.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("_blocks")
    )
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    dealt = members.join(sizes, same).withColumn("_block", F.pmod(F.xxhash64(F.lit(salt), "id", *keys), F.col("_blocks")))
    lists = dealt.groupBy(*keys, "_block").agg(F.collect_list(F.struct(*columns)).alias("members"))
    return lists.filter(F.size("members") > 1).select("members")


def _keep_best(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The best entries of each list: as many as the node's list is long."""
    best = edges.groupBy("id", "nbr").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "nbr"))
    ranked = best.withColumn("_rank", rank).filter(F.col("_rank") <= LONGEST)
    wide = nodes.select(F.col("id").alias("_id"), "k")
    return ranked.join(wide, F.col("id") == F.col("_id")).filter("_rank <= k").select("id", "nbr", "sim")


def _floors(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Nodes with the list length of the next round and the similarity a new entry must exceed."""
    lists = graph.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"), F.min("sim").alias("_worst"))
    joined = nodes.select("id", "dim", "vec", "k").join(lists, F.col("id") == F.col("_id"), "left")
    full = F.col("_n") >= F.col("k")
    wider = F.when(full & (F.col("_worst") >= threshold), F.least(F.col("k") * 2, F.lit(LONGEST))).otherwise(F.col("k"))
    floor = F.when(full & (wider == F.col("k")), F.col("_worst")).otherwise(F.lit(-1.5))
    return joined.select("id", "dim", "vec", wider.cast("int").alias("k"), floor.alias("floor"))


def neighbour_graph(nodes: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """The stored lists (id, nbr, sim) of nodes (id, dim, vec), and the nodes with the length ``k`` of their list."""
    spark = nodes.sparkSession
    tables, bits = _tables(nodes.count(), threshold)
    plain = nodes.withColumns({"k": F.lit(LIST), "floor": F.lit(-1.5)})
    members = _bucketed(plain, tables, bits, 0)
    with arrow_rows(spark, 64):
        near = _blocks(members, ["dim", "tab", "code"], 2 * BUCKET).mapInArrow(_nearest, _EDGE)
        graph = stage(_keep_best(near, plain), "nn-graph")
    for turn in range(ROUNDS):
        plain = stage(_floors(graph, plain, threshold), "nn-nodes")
        both = graph.select(F.col("id").alias("hub"), F.col("nbr").alias("_m")).union(graph.select("nbr", "id"))
        # The hub itself belongs to its neighbourhood.
        both = both.union(plain.select(F.col("id").alias("hub"), F.col("id").alias("_m"))).distinct()
        members = plain.join(both, F.col("id") == F.col("_m"))
        with arrow_rows(spark, 64):
            found = stage(_blocks(members, ["hub"], HOOD, salt=turn).mapInArrow(_nearest, _EDGE), "nn-found")
            better = stage(_keep_best(graph.union(found), plain), "nn-graph")
        old = graph.select(F.col("id").alias("_a"), F.col("nbr").alias("_b"))
        fresh = better.join(old, (F.col("id") == F.col("_a")) & (F.col("nbr") == F.col("_b")), "left_anti")
        changed = fresh.filter(F.col("sim") >= threshold).count()
        links = better.filter(F.col("sim") >= threshold).count()
        graph = better
        if changed <= STILL * max(links, 1):
            break
    return graph, plain


def _near_balls(threshold: float):
    """Pairs of balls of different components, inside each row's pair of blocks, that may hold a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], []]
            for i in range(len(batch)):
                row = batch["members"].slice(i, 1).flatten()
                ball, area, mine, radius = (
                    row.field(c).to_numpy(zero_copy_only=False) for c in ("ball", "component", "mine", "radius")
                )
                unit = _unit(row.field("vec"))
                angle = np.arccos(np.clip(unit @ unit.T, -1, 1))
                near = angle <= np.arccos(threshold) + radius[:, None] + radius[None, :] + SLACK
                near &= area[:, None] != area[None, :]
                near = near & (mine[:, None] < mine[None, :]) if mine.min() < mine.max() else np.triu(near, 1)
                a, b = np.nonzero(near)
                out[0].append(ball[a])
                out[1].append(ball[b])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["a", "b"])

    return run


def _best_link(threshold: float):
    """The closest two members across each row's two balls, if they are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for i in range(len(batch)):
                row = batch["members"].slice(i, 1).flatten()
                area = row.field("component").to_numpy(zero_copy_only=False)
                left = row.field("left").to_numpy(zero_copy_only=False)
                unit = _unit(row.field("vec"))
                sims = unit[left] @ unit[~left].T
                if sims.max() >= threshold:
                    pairs.append((area[left][0], area[~left][0]))
            found = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return run


def _touching(links: DataFrame, nodes: DataFrame, placed: DataFrame, threshold: float) -> DataFrame | None:
    """Pairs (a, b) of components that a link between two full lists' nodes joins; None if there can be none.

    A node whose list has room holds all its links, so only links between two full lists
    can be missing. A full node goes to the ball of the neighbour that a hash puts first;
    the list says how far it is from that centre. ``nodes`` has the list length ``k``.
    """
    spark = links.sparkSession
    held = links.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    full = nodes.join(held, F.col("id") == F.col("_id")).filter("_n >= k").select("id")
    full = stage(full, "nn-full")
    inner = links.join(full.select(F.col("id").alias("_a")), F.col("id") == F.col("_a"))
    inner = inner.join(full.select(F.col("id").alias("_b")), F.col("nbr") == F.col("_b")).select("id", "nbr", "sim")
    inner = inner.union(full.select("id", "id", F.lit(1.0)))
    first = F.min(F.struct(F.xxhash64(F.lit(7), "nbr").alias("draw"), "nbr", "sim")).alias("first")
    led = inner.groupBy("id").agg(first).select("id", F.col("first.nbr").alias("centre"), "first.sim")
    led = stage(led, "nn-led")
    parts = led.groupBy(F.col("centre").alias("_c")).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("_parts"))
    ball = F.xxhash64("centre", F.pmod(F.xxhash64("id"), F.col("_parts"))).alias("ball")
    members = stage(led.join(parts, F.col("centre") == F.col("_c")).select("id", "centre", "sim", ball), "nn-balls")
    balls = members.groupBy("ball").agg(
        F.first("centre").alias("centre"), F.acos(F.least(F.min("sim"), F.lit(1.0))).alias("radius")
    )
    areas = placed.select(F.col("id").alias("_id"), "component")
    balls = balls.join(areas, F.col("centre") == F.col("_id")).drop("_id")
    balls = balls.join(nodes.select("id", "dim", "vec"), F.col("centre") == F.col("id"))
    balls = stage(balls.select("ball", "radius", "component", "dim", "vec"), "nn-centres")
    if balls.select("component").distinct().limit(2).count() < 2:
        return None
    sizes = balls.groupBy(F.col("dim").alias("_dim")).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks"))
    dealt = balls.join(sizes, F.col("dim") == F.col("_dim")).withColumn("mine", F.pmod(F.xxhash64("ball"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    meeting = dealt.withColumn("other", other).groupBy(
        "dim", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")
    )
    lists = meeting.agg(F.collect_list(F.struct("ball", "component", "mine", "radius", "vec")).alias("members"))
    # A meeting of two blocks with one of them empty has nothing across.
    lists = lists.filter((F.col("i") == F.col("j")) | (F.array_min("members.mine") < F.array_max("members.mine")))
    with arrow_rows(spark, 16):
        pairs = stage(lists.select("members").mapInArrow(_near_balls(threshold), "a long, b long"), "nn-pairs")
    vectors = nodes.select(F.col("id").alias("_v"), "vec")
    full_rows = members.join(vectors, F.col("id") == F.col("_v")).join(areas, F.col("centre") == F.col("_id"))
    full_rows = stage(full_rows.select("ball", "component", "vec"), "nn-members")
    sides = [
        pairs.join(full_rows, F.col(c) == F.col("ball")).select("a", "b", F.struct("component", F.lit(c == "a").alias("left"), "vec").alias("m"))
        for c in ("a", "b")
    ]
    meeting = sides[0].union(sides[1]).groupBy("a", "b").agg(F.collect_list("m").alias("members")).select("members")
    with arrow_rows(spark, 16):
        return stage(meeting.mapInArrow(_best_link(threshold), "a long, b long"), "nn-touching")


def _joined(placed: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, component) after the pairs (a, b) of components are joined.

    A node without a component is one by itself and has its id for a name.
    """
    merged = stage(components(pairs, "a", "b"), "nn-merged")
    alone = merged.select("id").join(placed.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left_anti")
    alone = alone.join(nodes.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left_semi")
    placed = placed.union(alone.select("id", F.col("id").alias("component")))
    merged = merged.select(F.col("id").alias("_from"), F.col("component").alias("_to"))
    moved = placed.join(merged, F.col("component") == F.col("_from"), "left")
    return stage(moved.select("id", F.coalesce("_to", "component").alias("component")), "nn-components")


def _across(threshold: float, tables: int, bits: int):
    """Links between different components inside each row's block, with the links each stands for.

    A pair shares a bucket of one table with the chance that no plane of it separates the
    two, and its block of a bucket with one in ``blocks``. One over its expected number of
    meetings makes the sum over all meetings an unbiased count of the missing links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            for i in range(len(batch)):
                row = batch["members"].slice(i, 1).flatten()
                area = row.field("component").to_numpy(zero_copy_only=False)
                unit = _unit(row.field("vec"))
                sims = unit @ unit.T
                a, b = np.nonzero(np.triu((sims >= threshold) & (area[:, None] != area[None, :]), 1))
                chance = (1 - np.arccos(np.clip(sims[a, b], -1, 1)) / np.pi) ** bits
                blocks = row.field("_blocks").to_numpy(zero_copy_only=False)[a]
                out[0].append(area[a])
                out[1].append(area[b])
                out[2].append(blocks / (tables * chance))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["a", "b", "weight"])

    return run


def _missed(nodes: DataFrame, placed: DataFrame, n: int, threshold: float, salt: int) -> DataFrame:
    """Links (a, b, weight) between different components that fresh tables find."""
    tables, bits = _tables(n, threshold)
    areas = placed.select(F.col("id").alias("_p"), "component")
    whole = nodes.select("id", "dim", "vec").join(areas, F.col("id") == F.col("_p"), "left")
    whole = whole.withColumn("component", F.coalesce("component", "id"))
    lists = _blocks(_bucketed(whole, tables, bits, salt), ["dim", "tab", "code"], 2 * BUCKET, ["component", "vec", "_blocks"], salt)
    lists = lists.filter(F.array_min("members.component") < F.array_max("members.component"))
    with arrow_rows(nodes.sparkSession, 64):
        return stage(lists.mapInArrow(_across(threshold, tables, bits), "a long, b long, weight double"), "nn-missed")


def _settled(nodes: DataFrame, links: DataFrame, found: DataFrame, threshold: float) -> tuple[DataFrame, list[float]]:
    """Components after fresh tables find too few missing links, and the recall each time.

    Links inside a component are counted exactly, so only links between components can be
    missing. Tables drawn independently of the graph estimate their number; the links they
    find join components, and below ``RECALL`` further tables follow. Every repetition joins
    at least two components, so this ends. The held links are those of the lists alone, so
    the recall is rather too low than too high.
    """
    n = nodes.count()
    held = links.select(F.least("id", "nbr").alias("a"), F.greatest("id", "nbr").alias("b")).distinct().count()
    recalls: list[float] = []
    while True:
        missed = _missed(nodes, found, n, threshold, len(recalls) + 1)
        seen, weight = missed.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
        recalls.append(held / (held + weight) if held + weight else 1.0)
        if seen:
            found = _joined(found, missed.select("a", "b"), nodes)
            held += seen
        if recalls[-1] >= RECALL:
            return found, recalls


def _count_links(threshold: float):
    """Links of every vector inside each row's pair of blocks; pairs of one block count both ways."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], []]
            for i in range(len(batch)):
                row = batch["members"].slice(i, 1).flatten()
                ids = row.field("id").to_numpy(zero_copy_only=False)
                copies = row.field("copies").to_numpy(zero_copy_only=False)
                mine = row.field("mine").to_numpy(zero_copy_only=False)
                unit = _unit(row.field("vec"))
                linked = (unit @ unit.T) >= threshold
                np.fill_diagonal(linked, False)
                if mine.min() < mine.max():  # two blocks: only pairs across
                    linked &= mine[:, None] != mine[None, :]
                out[0].append(ids)
                out[1].append(linked @ copies)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["id", "links"])

    return run


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per input row: key, n_links, component (the smallest key that links reach)."""
    spark = rows.sparkSession
    vec = F.col(vector).cast("array<double>")
    sound = (F.size(vec) > 0) & F.exists(vec, lambda x: x != 0)
    sound = sound & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ident = F.when(F.coalesce(sound, F.lit(False)), F.xxhash64(vec))
    named = stage(rows.select(F.col(key).alias("key"), ident.alias("id"), F.col(vector).alias("vec")), "nn-rows")
    whole = named.filter("id is not null")
    nodes = whole.groupBy("id").agg(
        F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("key").alias("least")
    )
    nodes = stage(nodes.withColumn("dim", F.size("vec")), "nn-classes")
    graph, listed = neighbour_graph(nodes.select("id", "dim", "vec"), threshold)
    links = graph.filter(F.col("sim") >= threshold)
    found = stage(components(links, "id", "nbr"), "nn-components")
    touching = _touching(links, listed, found, threshold)
    if touching is not None and not touching.isEmpty():
        found = _joined(found, touching, nodes)
    found, _ = _settled(nodes, links, found, threshold)
    # Count the links of each component in blocks.
    areas = found.groupBy(F.col("component").alias("_area")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks")
    )
    dealt = found.withColumnRenamed("id", "_id").join(areas, F.col("component") == F.col("_area"))
    dealt = nodes.join(dealt, F.col("id") == F.col("_id")).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    meeting = dealt.withColumn("other", other).groupBy(
        "component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")
    )
    lists = meeting.agg(F.collect_list(F.struct("id", "vec", "copies", "mine")).alias("members"))
    # A meeting of two blocks with one of them empty has nothing across.
    with arrow_rows(spark, 16):
        counted = lists.filter(
            (F.col("i") == F.col("j")) | (F.array_min("members.mine") < F.array_max("members.mine"))
        ).select("members")
        sums = stage(counted.mapInArrow(_count_links(threshold), "id long, links long"), "nn-links")
    sums = sums.groupBy(F.col("id").alias("_l")).agg(F.sum("links").alias("links"))
    known = nodes.select("id", "copies", "least").join(
        found.withColumnRenamed("id", "_f"), F.col("id") == F.col("_f"), "left"
    )
    known = known.join(sums, F.col("id") == F.col("_l"), "left").select(
        "id",
        "least",
        F.coalesce("component", "id").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    known = stage(known, "nn-known")
    smallest = known.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component"))
    known = known.join(smallest, F.col("root") == F.col("_root")).select(
        F.col("id").alias("_id"), "n_links", "component"
    )
    out = named.select("key", "id").join(known, F.col("id") == F.col("_id"), "left")
    component = F.when(F.col("id").isNull(), F.col("key")).otherwise(F.col("component"))
    return out.select("key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"))
