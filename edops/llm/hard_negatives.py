"""Hard negatives by rotated one-bit codes with stored code-vector alignment.

Scores are inner products of integer vectors, components ``floor(scale * x)``. Every vector is
rotated (sign flips and Hadamard transforms) and coded by the signs of its coordinates. The
alignment of vector and code is stored, so the code times the alignment is the vector's part
along its code, and what is left stands at right angles to it. What is left is rotated and
coded again, ``LEVELS`` times, each time a little over a third of its square.

The anchor is rotated alike and quantised to ``PLANES`` bit planes, so its product with a code
is a sum of popcounts. Estimate and error bound give an interval that holds the score for
certain: the rounding of the anchor is known, and by Cauchy and Schwarz the rest is at most
the length of what is left times the anchor's part at right angles to the code. Level by
level, candidates whose interval cannot meet the window, or cannot reach the best intervals
that surely do, fall out; the survivors are scored in integers. The result is exact.

Anchors are compared with all rows in blocks: a task holds at most about ``ANCHORS`` anchors
and ``ROWS`` rows, and returns the best few of each anchor. The first pass finds the positives
of each anchor, the second the negatives in the window of each positive.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take
no part; a null id is no anchor, keeps its label and comes last among ties; vectors of
different length are never compared, and the empty ones score 0 with each other; rows that
repeat are rows of their own; scaled components are held to 2**62 and scores to 64 bits;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from edops.session import stage

LEVELS, PLANES = 4, 8
ANCHORS, ROWS = 1024, 8192
SEED = 11
POSITIVES, NEGATIVES = 5, 10
LEAST_PERCENT, MOST_PERCENT = 30, 90
SLACK = 1e-9  # of the product of both lengths, for rounding in double precision
_CODED = "row long, id long, label long, dim int, length double, whole binary, codes binary, along binary, left binary"


# ---- codes ----------------------------------------------------------------------------


def _width(dim: int) -> int:
    """Coordinates of the rotated vectors: a power of two that fills whole 64-bit words."""
    return max(64, 1 << max(0, dim - 1).bit_length())


@lru_cache(maxsize=64)
def _flips(width: int, level: int) -> np.ndarray:
    return np.random.default_rng([SEED, width, level]).choice([-1.0, 1.0], size=(3, width))


def rotate(x: np.ndarray, level: int) -> np.ndarray:
    """Rows turned by three rounds of sign flips and Hadamard transforms; lengths stay."""
    rows, width = x.shape
    for flips in _flips(width, level):
        x, half = x * flips, 1
        while half < width:
            pairs = x.reshape(rows, width // (2 * half), 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, width)
            half *= 2
        x = x / np.sqrt(width)
    return x


def _padded(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), _width(x.shape[1])))
    out[:, : x.shape[1]] = x
    return out


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments and lengths of what is left (rows, levels)."""
    rest = _padded(x)
    rows, width = rest.shape
    codes = np.zeros((rows, LEVELS, width // 64), np.uint64)
    along, left = np.zeros((rows, LEVELS)), np.zeros((rows, LEVELS))
    for level in range(LEVELS):
        turned = rotate(rest, level)
        up = turned >= 0
        codes[:, level] = np.packbits(up, axis=1).view(np.uint64)
        along[:, level] = np.abs(turned).mean(axis=1)
        rest = turned - along[:, level, None] * np.where(up, 1.0, -1.0)
        left[:, level] = np.sqrt((rest * rest).sum(axis=1))
    return codes, along, left


class Anchor:
    """A query's bit planes for each level."""

    def __init__(self, x: np.ndarray):
        turned = _padded(x[None, :])
        self.square = float((turned * turned).sum())
        self.levels = []
        for level in range(LEVELS):
            turned = rotate(turned, level)
            q = turned[0]
            low = float(q.min())
            step = (float(q.max()) - low) / ((1 << PLANES) - 1)
            units = np.rint((q - low) / step).astype(np.int64) if step > 0 else np.zeros(len(q), np.int64)
            planes = (units[None, :] >> np.arange(PLANES)[:, None] & 1).astype(bool)
            words = np.packbits(planes, axis=1).view(np.uint64)
            error = float(np.abs(q - (low + step * units)).sum())
            self.levels.append((words, low, step, int(units.sum()), error))

    def product(self, codes: np.ndarray, level: int) -> tuple[np.ndarray, float]:
        """Product of the quantised query with each code of signs, and its largest error."""
        words, low, step, total, error = self.levels[level]
        ups = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        hits = np.zeros(len(codes), np.int64)
        for k in range(PLANES):
            hits += np.bitwise_count(codes & words[k]).sum(axis=1, dtype=np.int64) << k
        return low * (2 * ups - 64 * codes.shape[1]) + step * (2 * hits - total), error


class Rows:
    """A block of coded rows."""

    def __init__(self, table: pa.Table):
        n, dim = len(table), table["dim"][0].as_py()
        words = _width(dim) // 64
        self.row = table["row"].to_numpy()
        self.no_id = table["id"].is_null().to_numpy()
        self.id = table["id"].fill_null(0).to_numpy()
        self.label = table["label"].to_numpy()
        self.length = table["length"].to_numpy()
        self.whole = _packed(table["whole"], np.int64).reshape(n, dim)
        if "codes" in table.column_names:
            self.codes = _packed(table["codes"], np.uint64).reshape(n, LEVELS, words)
            self.along = _packed(table["along"], np.float64).reshape(n, LEVELS)
            self.left = _packed(table["left"], np.float64).reshape(n, LEVELS)

    def survivors(self, anchor: Anchor, rows: np.ndarray, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Rows that ``keep`` leaves when it sees the intervals of each level."""
        guess, off = np.zeros(len(rows)), np.zeros(len(rows))
        for level in range(LEVELS):
            if not len(rows):
                break
            along = self.along[rows, level]
            product, error = anchor.product(self.codes[rows, level], level)
            guess, off = guess + along * product, off + along * error
            # The anchor's part along the code does not meet what is left of the row.
            within = np.maximum(0, np.abs(product) - error) ** 2 / (64 * self.codes.shape[2])
            aside = np.sqrt(np.maximum(0, anchor.square - within))
            room = off + self.left[rows, level] * aside + SLACK * self.length[rows] * np.sqrt(anchor.square) + SLACK
            kept = keep(guess - room, guess + room)
            rows, guess, off = rows[kept], guess[kept], off[kept]
        return rows

    def scores(self, x: np.ndarray, length: float, rows: np.ndarray) -> np.ndarray:
        """Integer products; in double precision while every partial sum is exact there."""
        bound = length * float(self.length[rows].max(initial=0))
        if bound < 2.0**52:
            return (self.whole[rows].astype(np.float64) @ x.astype(np.float64)).astype(np.int64)
        if bound < 2.0**62:
            return self.whole[rows] @ x
        exact = self.whole[rows].astype(object) @ x.astype(object)
        most = (1 << 63) - 1
        return np.array([max(-most, min(most, s)) for s in exact], np.int64)

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the ``k`` best: larger scores first, then smaller ids, null ids last."""
        return np.lexsort((self.id[rows], self.no_id[rows], -scores))[:k]


def _packed(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _top(values: np.ndarray, k: int) -> float:
    """The k-th largest value."""
    return -np.inf if len(values) < k else float(np.partition(values, len(values) - k)[len(values) - k])


def _window(scores: np.ndarray, positive: int, least: int, most: int) -> np.ndarray:
    """Whether each score lies in the positive's window, in exact arithmetic."""
    if positive < 0 or not len(scores):
        return np.zeros(len(scores), bool)
    if max(abs(int(scores.max())), abs(int(scores.min())), positive) >= 1 << 55:
        scores = scores.astype(object)
    return ((least * positive <= 100 * scores) & (100 * scores <= most * positive)).astype(bool)


# ---- blocks ---------------------------------------------------------------------------


def _positives(count: int):
    """Best rows of an anchor's own label, itself left out."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if len(anchors) and len(rows):
            asked, block = Rows(anchors), Rows(rows)
            of_label = {int(v): np.flatnonzero(block.label == v) for v in np.unique(block.label)}
            for i in range(len(asked.row)):
                same = of_label.get(int(asked.label[i]), np.zeros(0, np.int64))
                same = same[block.row[same] != asked.row[i]]
                x = asked.whole[i]
                left = block.survivors(Anchor(x.astype(np.float64)), same, lambda low, high: high >= _top(low, count))
                scores = block.scores(x, float(asked.length[i]), left)
                best = block.best(left, scores, count)
                for at in best:
                    r = left[at]
                    for column, v in zip(out, (asked.row[i], block.row[r], None if block.no_id[r] else block.id[r], scores[at])):
                        column.append(None if v is None else int(v))
        return _table(out, ["anchor", "row", "id", "score"])

    return run


def _negatives(count: int, least: int, most: int):
    """Best rows of other labels in the window of each of the anchor's positives."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if len(anchors) and len(rows):
            asked, block = Rows(anchors), Rows(rows)
            for i, positives in enumerate(anchors["positives"].to_pylist()):
                x = asked.whole[i]
                distinct = sorted({p for p in positives if p >= 0})

                def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    kept = np.zeros(len(low), bool)
                    for p in distinct:
                        floor, roof = least / 100 * p, most / 100 * p
                        slack = SLACK * (1 + abs(p))
                        sure = low[(low >= floor + slack) & (high <= roof - slack)]
                        kept |= (high >= max(floor - slack, _top(sure, count))) & (low <= roof + slack)
                    return kept

                other = np.flatnonzero(block.label != asked.label[i])
                left = block.survivors(Anchor(x.astype(np.float64)), other, keep)
                scores = block.scores(x, float(asked.length[i]), left)
                for p in distinct:
                    inside = np.flatnonzero(_window(scores, p, least, most))
                    for at in inside[block.best(left[inside], scores[inside], count)]:
                        r = left[at]
                        for column, v in zip(out, (asked.row[i], p, None if block.no_id[r] else block.id[r], scores[at])):
                            column.append(None if v is None else int(v))
        return _table(out, ["anchor", "positive", "id", "score"])

    return run


def _table(columns: list[list], names: list[str]) -> pa.Table:
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


# ---- the operator ---------------------------------------------------------------------


def _coded(scale: float):
    def run(batches):
        for batch in batches:
            lists = batch.column("vec")
            dims = lists.value_lengths().to_numpy()
            ends = np.concatenate([[0], np.cumsum(dims)])
            values = lists.flatten().to_numpy(zero_copy_only=False)
            whole, codes, along, left = ([b""] * len(batch) for _ in range(4))
            length = np.zeros(len(batch))
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = values[ends[rows][:, None] + np.arange(dim)]
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(scale * x), -(2.0**62), 2.0**62)
                c, a, r = encode(x)
                length[rows] = np.sqrt((x * x).sum(axis=1))
                x = x.astype(np.int64)
                for i, at in enumerate(rows):
                    whole[at], codes[at], along[at], left[at] = x[i].tobytes(), c[i].tobytes(), a[i].tobytes(), r[i].tobytes()
            packed = [pa.array(v, pa.binary()) for v in (whole, codes, along, left)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(length), *packed],
                ["row", "id", "label", "dim", "length", "whole", "codes", "along", "left"],
            )

    return run


def sound_vectors(vec: Column) -> Column:
    """Whether a list is there and holds finite numbers only."""
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def _in_blocks(anchors: DataFrame, rows: DataFrame, of_anchors: int, of_rows: int, work, schema: str) -> DataFrame:
    """All anchors against all rows of their length: one group for each pair of blocks."""
    keys = ["dim", "_a", "_r"]
    place = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("_a", place(of_anchors)).withColumn("_r", every(of_rows))
    right = rows.withColumn("_r", place(of_rows)).withColumn("_a", every(of_anchors))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str | Column = "label",
    vec: str = "embedding",
    scale: float = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = (LEAST_PERCENT, MOST_PERCENT),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` chooses the anchors among the rows; ``window`` gives the least and the most
    percent of the positive's score that a negative may have.
    """
    least, most = window
    label = F.col(label) if isinstance(label, str) else label
    asked = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.col(vec).cast("array<double>").alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).filter(F.col("label").isNotNull() & sound_vectors(F.col("vec")))
    # The row numbers are fixed by storing them; they tell rows that repeat apart.
    asked = stage(asked, "vectors")
    rows = stage(asked.select("row", "id", "label", "vec").mapInArrow(_coded(scale), _CODED), "codes")
    anchors = rows.join(asked.filter("asks").select("row"), "row", "left_semi").select("row", "id", "label", "dim", "length", "whole")
    anchors = stage(anchors, "anchors")
    of_anchors, of_rows = -(-max(1, anchors.count()) // ANCHORS), -(-max(1, rows.count()) // ROWS)

    near = _in_blocks(anchors, rows, of_anchors, of_rows, _positives(positives), "anchor long, row long, id long, score long")
    order = [F.desc("score"), F.col("id").asc_nulls_last()]
    nth = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    near = stage(near.withColumn("nth", nth).filter(F.col("nth") <= positives), "positives")

    lists = near.groupBy("anchor").agg(F.collect_set("score").alias("positives"))
    asking = anchors.join(lists, F.col("row") == F.col("anchor")).select(*anchors.columns, "positives")
    work = _negatives(negatives, least, most)
    far = _in_blocks(asking, rows, of_anchors, of_rows, work, "anchor long, positive long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order))
    far = far.withColumn("rank", rank).filter(F.col("rank") <= negatives)

    found = near.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return far.join(found, ["anchor", "positive"]).join(named, "anchor").select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("positive").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
