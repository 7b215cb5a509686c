"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (at most about ``SAMPLE_ROWS`` vectors and
``SAMPLE_VALUES`` numbers) by k-means in every node, until its leaves stand for about
``LEAF_ROWS`` vectors each; every vector is then put into the leaf that it reaches. To make
the largest inner product the nearest point, vectors get one more coordinate that lifts all
of them to the length of the longest, and queries get a zero there.

A query walks the tree with a priority queue: the nearest open node is taken next, and leaves
come out in the order of promise. How many of them a query visits is calibrated: exact
neighbours of at most about ``AUDITED`` queries are found against all rows, and visits are
widened until the leaves hold the share ``RECALL`` of these neighbours. Visited leaves are
compared in double precision, a few first; the later ones only return what reaches the best
of the earlier ones. Equal vectors are one entry that keeps its smallest ids, as
many as an answer can use, so copies cost nothing; large leaves, and the queries of much
visited ones, are cut into blocks. The tree and the audited queries are all that is broadcast.

Scores are summed in the order of the components, so equal vectors score alike anywhere.

Defined cases: vectors that are null or empty, all zero, or hold a null or a non-finite
component take no part; vectors of different length are never compared, each length has a
tree of its own; ties go to the smaller id, null ids last, and a null id asks nothing; rows
that repeat are rows of their own, and a query leaves out one row of its own id and vector;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from edops.llm.common import unit_draw
from edops.session import stage

NEAREST = 20
SAMPLE_ROWS, SAMPLE_VALUES = 65_536, 4 << 20
BRANCHES, LEAF_ROWS, LEAF_SAMPLE, PASSES = 16, 512, 8, 8
RECALL, AUDITED = 0.95, 512
WIDER = 1.25  # factor by which visits widen
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
FIRST_VISITS = 4  # then four times as many in all, and so on; each step has a higher floor
SEED = 12
SLACK = 1e-9  # of the product of both lengths: rounding of a matrix product
_FOUND = "query long, query_id long, leaf int, score double, id long"


# ---- the tree -------------------------------------------------------------------------


@dataclass
class Tree:
    """Centres of all nodes, the children of each, and the leaf number of the childless ones."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray
    longest: float

    @property
    def leaves(self) -> int:
        return int((self.leaf >= 0).sum())

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that makes them all equally long."""
        rest = np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(axis=1)))
        return np.concatenate([x, rest[:, None]], axis=1)

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector, by the nearest child from the root on."""
        x, at = self.lift(x), np.zeros(len(x), np.int64)
        open_ = np.arange(len(x))
        while len(open_):
            for node in np.unique(at[open_]):
                below = self.children[node]
                if len(below):
                    rows = open_[at[open_] == node]
                    at[rows] = below[_nearest(x[rows], self.centres[below])]
            open_ = open_[[len(self.children[n]) > 0 for n in at[open_]]]
        return self.leaf[at]

    def order(self, queries: np.ndarray, most: int) -> Iterator[list[int]]:
        """The first ``most`` leaves of each query, best bin first."""
        squares = (self.centres**2).sum(axis=1)
        for at in range(0, len(queries), 256):
            block = queries[at : at + 256]
            # Squared distance to each centre less the query's own square; its lift is zero.
            far = squares[None, :] - 2 * (block @ self.centres[:, :-1].T)
            for row in far:
                queue, visited = [(0.0, 0)], []
                while queue and len(visited) < most:
                    _, node = heapq.heappop(queue)
                    if self.leaf[node] >= 0:
                        visited.append(int(self.leaf[node]))
                    for child in self.children[node].tolist():
                        heapq.heappush(queue, (row[child], child))
                yield visited


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def _k_means(x: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """Cluster of each row; fewer than ``k`` clusters where rows are equal."""
    centres = np.unique(x[draw.choice(len(x), size=min(k, len(x)), replace=False)], axis=0)
    for _ in range(PASSES):
        own = _nearest(x, centres)
        used = np.unique(own)
        centres = np.stack([x[own == c].mean(axis=0) for c in used])
    return _nearest(x, centres)


def fit(sample: np.ndarray, longest: float, rows: int) -> Tree:
    """Tree over the sample with about one leaf for ``LEAF_ROWS`` of the ``rows``."""
    tree = Tree(np.zeros((0, 0)), [], np.zeros(0, np.int64), longest)
    x, draw = tree.lift(sample), np.random.default_rng(SEED)
    most = max(1, min(-(-rows // LEAF_ROWS), len(x) // LEAF_SAMPLE))
    centres, children, leaf, leaves = [x.mean(axis=0)], [np.zeros(0, np.int64)], [-1], 0
    todo = [(0, np.arange(len(x)), most)]
    while todo:
        node, own, wanted = todo.pop()
        cluster = _k_means(x[own], min(BRANCHES, wanted), draw) if wanted > 1 else np.zeros(len(own), int)
        parts = [own[cluster == c] for c in np.unique(cluster)]
        if len(parts) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        children[node] = np.arange(len(centres), len(centres) + len(parts))
        for part in parts:
            todo.append((len(centres), part, max(1, round(wanted * len(part) / len(own)))))
            centres.append(x[part].mean(axis=0))
            children.append(np.zeros(0, np.int64))
            leaf.append(-1)
    return Tree(np.stack(centres), children, np.array(leaf), longest)


# ---- tasks ----------------------------------------------------------------------------


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _put(tree: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.place(_matrix(batch.column("vec"))) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], ["leaf", *batch.schema.names])

    return run


def _visits(tree: Broadcast, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            orders = list(tree.value.order(_matrix(batch.column("vec")), most))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([pa.array(orders, pa.list_(pa.int32())), *batch.columns], ["visits", *names])

    return run


class Entries:
    """A block of distinct vectors with the ids that share each."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        self.x = _matrix(table["vec"])
        self.leaf = table["leaf"].to_numpy()
        lists = table["ids"].combine_chunks() if isinstance(table["ids"], pa.ChunkedArray) else table["ids"]
        self.count = lists.value_lengths().to_numpy()
        self.first = np.cumsum(self.count) - self.count
        ids = lists.flatten()
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.id = ids.fill_null(0).to_numpy()
        self.longest = float(np.sqrt((self.x**2).sum(axis=1).max(initial=0)))

    def nearest(self, queries: np.ndarray, query_id: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """The ``k`` nearest of each query that reach its floor: query's place, leaf, score, id, whether it is null."""
        parts = [self._nearest(queries[at : at + 128], query_id[at : at + 128], floor[at : at + 128], k, at) for at in range(0, len(queries), 128)]
        return tuple(np.concatenate(c) for c in zip(*parts))

    def _nearest(self, queries: np.ndarray, query_id: np.ndarray, floor: np.ndarray, k: int, offset: int) -> tuple[np.ndarray, ...]:
        square, n = (queries**2).sum(axis=1), len(self.x)
        reach = 2 * SLACK * np.sqrt(square) * self.longest
        products = queries @ self.x.T
        # One more than asked for, as the query's own row falls out.
        least = np.partition(products, n - k - 1, axis=1)[:, n - k - 1] if n > k else np.full(len(queries), -np.inf)
        query, row = np.nonzero(products >= (np.maximum(least, floor) - reach)[:, None])
        score = np.zeros(len(row))
        for q, x in zip(queries.T, self.x.T):
            score += q[query] * x[row]
        pair = np.repeat(np.arange(len(row)), self.count[row])
        at = np.arange(len(pair)) - np.repeat(np.cumsum(self.count[row]) - self.count[row], self.count[row]) + self.first[row[pair]]
        own = np.flatnonzero(np.abs(score - square[query]) <= reach[query])
        own = own[(queries[query[own]] == self.x[row[own]]).all(axis=1)]
        self_ = np.isin(pair, own) & ~self.no_id[at] & (self.id[at] == query_id[query[pair]])
        first = np.zeros(len(pair), bool)  # of the rows of the query's id and vector one falls out
        first[np.flatnonzero(self_)[np.unique(pair[self_], return_index=True)[1]]] = True
        pair, at = pair[~first], at[~first]
        order = np.lexsort((self.id[at], self.no_id[at], -score[pair], query[pair]))
        asked = query[pair[order]]
        order = order[np.arange(len(order)) - np.searchsorted(asked, asked, "left") < k]
        pair, at = pair[order], at[order]
        return query[pair] + offset, self.leaf[row[pair]], score[pair], self.id[at], self.no_id[at]


_NAMES = ["query", "query_id", "leaf", "score", "id"]


def _as_found(query: np.ndarray, query_id: np.ndarray, found: tuple[np.ndarray, ...]) -> list[pa.Array]:
    """Columns of ``_FOUND``."""
    asked, leaf, score, id_, no_id = found
    return [
        pa.array(query[asked]),
        pa.array(query_id[asked]),
        pa.array(leaf, pa.int32()),
        pa.array(score),
        pa.array(id_, mask=no_id),
    ]


def _kth(asked: np.ndarray, score: np.ndarray, queries: int, k: int) -> np.ndarray:
    """The k-th largest score of each query, minus infinity where there are fewer."""
    order = np.lexsort((-score, asked))
    first, last = np.searchsorted(asked[order], np.arange(queries)), np.searchsorted(asked[order], np.arange(queries), "right")
    kth = np.full(queries, -np.inf)
    full = last - first >= k
    kth[full] = score[order][first[full] + k - 1]
    return kth


def _audit(queries: Broadcast, k: int):
    """All rows against the audited queries; a task returns its best few for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, query, query_id = queries.value
        best, floor = None, np.full(len(query), -np.inf)
        for batch in batches:
            if len(batch):
                found = Entries(batch).nearest(vectors, query_id, floor, k)
                best = found if best is None else tuple(np.concatenate(c) for c in zip(best, found))
                floor = _kth(best[0], best[2], len(query), k)
                best = tuple(c[best[2] >= floor[best[0]]] for c in best)
        if best is not None:
            yield pa.RecordBatch.from_arrays(_as_found(query, query_id, best), _NAMES)

    return run


def _search(k: int):
    """The queries of a block against the rows of a block, all of one leaf."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(queries) or not len(rows):
            return pa.Table.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64())], _NAMES)
        query, query_id = queries["query"].to_numpy(), queries["query_id"].to_numpy()
        floor = queries["floor"].fill_null(-np.inf).to_numpy()
        found = Entries(rows).nearest(_matrix(queries["vec"]), query_id, floor, k)
        return pa.Table.from_arrays(_as_found(query, query_id, found), _NAMES)

    return run


# ---- the operator ---------------------------------------------------------------------


def _first(found: DataFrame, k: int) -> DataFrame:
    """Rank the rows found for each query and keep the first ``k``."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0)


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors, each with its ``k`` + 1 smallest ids; copies beyond cannot be answers."""
    rank = F.row_number().over(Window.partitionBy("vec").orderBy(F.col("id").asc_nulls_last()))
    few = rows.withColumn("_nth", rank).filter(F.col("_nth") <= k + 1)
    ordered = F.array_sort(F.collect_list(F.struct("_nth", "id")))
    entries = few.groupBy("vec").agg(ordered.getField("id").alias("ids"))
    return entries.select(F.monotonically_increasing_id().alias("entry"), "vec", "ids")


def _calibrated(tree: Tree, index: DataFrame, queries: DataFrame, k: int, recall: float) -> tuple[int, float]:
    """Leaves to visit and the recall that they reached on the audited queries."""
    spark = index.sparkSession
    share = F.lit(AUDITED / max(1, queries.count()))
    asked = queries.filter(unit_draw(SEED, F.col("query")) < share).toArrow()
    if not len(asked):
        return tree.leaves, 1.0
    vectors, query = _matrix(asked["vec"]), asked["query"].to_numpy()
    sent = spark.sparkContext.broadcast((vectors, query, asked["query_id"].to_numpy()))
    true = _first(index.mapInArrow(_audit(sent, k), _FOUND), k).select("query", "leaf").toArrow()
    turn = {q: {leaf: i for i, leaf in enumerate(order)} for q, order in zip(query.tolist(), tree.order(vectors, tree.leaves))}
    needed = np.array([turn[q][leaf] + 1 for q, leaf in zip(true["query"].to_pylist(), true["leaf"].to_pylist())])
    visits = 1
    while visits < tree.leaves and (needed <= visits).mean() < recall:
        visits = min(tree.leaves, max(visits + 1, int(visits * WIDER)))
    return visits, float((needed <= visits).mean()) if len(needed) else 1.0


def _of_one_length(rows: DataFrame, k: int, recall: float) -> tuple[DataFrame, float]:
    """Neighbours of the asking rows (query, query_id, leaf, score, id, rank), and the audited recall."""
    spark = rows.sparkSession
    entries = stage(_entries(rows, k), "entries")
    facts = entries.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))).first()
    n, dim, square = facts
    sampled = min(SAMPLE_ROWS, max(LEAF_SAMPLE, SAMPLE_VALUES // dim))
    sample = entries.filter(unit_draw(SEED, F.col("entry")) < F.lit(sampled / n)).select("vec").toArrow()
    sample = _matrix(sample["vec"]) if len(sample) else np.zeros((1, dim))
    tree = fit(sample, float(np.sqrt(square)), n)
    sent = spark.sparkContext.broadcast(tree)
    index = stage(entries.mapInArrow(_put(sent), "leaf int, entry long, vec array<double>, ids array<long>"), "index")

    queries = rows.filter("asks").select(F.col("row").alias("query"), F.col("id").alias("query_id"), "vec")
    visits, reached = _calibrated(tree, index, queries, k, recall)
    walks = queries.mapInArrow(_visits(sent, visits), "visits array<int>, query long, query_id long, vec array<double>")
    walks = stage(walks.select(F.posexplode("visits").alias("turn", "leaf"), "query", "query_id", "vec"), "walks")
    found, at, to = None, 0, FIRST_VISITS
    while at < visits:
        # The k-th best so far is the floor of the next visits, which only return what reaches it.
        part = walks.filter(F.col("turn").between(at, to - 1))
        if found is None:
            part = part.withColumn("floor", F.lit(None).cast("double"))
        else:
            floors = found.groupBy("query").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("_n"))
            part = part.join(floors.filter(F.col("_n") == k).select("query", "floor"), "query", "left")
        more = _meet(part, index, k)
        more = more if found is None else found.drop("rank").unionByName(more)
        found = stage(_first(more, k), "found")
        at, to = to, to * 4
    return found, reached


def _meet(walks: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """Every visiting query against the rows of its leaf, both sides cut into blocks."""
    # One row per leaf, so at most as many as the tree has: how often rows and queries are cut.
    sizes = index.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("_rows"))
    asked = walks.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("_queries"))
    cuts = F.broadcast(stage(sizes.join(asked, "leaf"), "cuts"))
    place = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = walks.join(cuts, "leaf").select(
        "leaf", "query", "query_id", "vec", "floor", place("query", "_queries").alias("_q"), every("_rows").alias("_r")
    )
    right = index.join(cuts, "leaf").select(
        "leaf", "vec", "ids", place("entry", "_rows").alias("_r"), every("_queries").alias("_q")
    )
    keys = ["leaf", "_q", "_r"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), _FOUND)


def nearest(
    vectors: DataFrame,
    asks: Column,
    key: str = "vec_id",
    vec: str = "embedding",
    k: int = NEAREST,
    recall: float = RECALL,
) -> tuple[DataFrame, dict[int, float]]:
    """(query_id, rank, id, score) of the ``k`` nearest other rows of each asking row.

    Also gives the recall that was reached on the audited queries, by vector length.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        F.col(vec).cast("array<double>").alias("vec"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
    ).filter(_usable(F.col("vec")))
    # The row numbers are fixed by storing them; they tell rows that repeat apart.
    rows = stage(rows.withColumn("dim", F.size("vec")), "vectors")
    lengths = [r["dim"] for r in rows.filter("asks").select("dim").distinct().orderBy("dim").collect()]
    out, reached = rows.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double"), {}
    for dim in lengths:
        found, reached[dim] = _of_one_length(rows.filter(F.col("dim") == dim), k, recall)
        out = out.unionByName(found.select("query_id", "rank", "id", "score"))
    return out, reached
