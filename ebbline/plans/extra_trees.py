"""Extremely randomised trees, grown level by level: random thresholds, one aggregation of class counts a level."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.plans.trees import TREE_FIELDS, Trees, listed_trees, of_listed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ENTRIES_AT_ONCE = 131_072  # (row, tree) pairs, or as many as there are open nodes; they stay in the processor's cache
IN_TASK_ENTRIES = 32_000_000  # (row, tree) pairs that a task holds at most, eight bytes each
_DRAWS = 5  # a node whose drawn features are all constant draws again, so many times at most


class _Growing:
    """Node lists of trees that are still growing; all on the driver, as large as the model."""

    def __init__(self, trees: int):
        self.root = list(range(trees))
        self.left, self.right = [-1] * trees, [-1] * trees
        self.feature, self.threshold = [0] * trees, [0.0] * trees
        self.rows, self.positive, self.depth = [0.0] * trees, [0.0] * trees, [0] * trees

    def child(self, depth: int, rows: float, weight0: float, weight1: float) -> int:
        for column, value in (
            (self.left, -1), (self.right, -1), (self.feature, 0), (self.threshold, 0.0), (self.rows, rows),
            (self.positive, weight1 / (weight0 + weight1) if weight0 + weight1 > 0 else 0.0), (self.depth, depth),
        ):
            column.append(value)
        return len(self.left) - 1

    def frozen(self) -> Trees:
        return Trees(
            np.array(self.root), np.array(self.left), np.array(self.right), np.array(self.feature),
            np.array(self.threshold, dtype=float), np.array(self.rows, dtype=float),
            np.array(self.positive, dtype=float), np.array(self.depth),
        )


def _matrices(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        if not batch.num_rows:
            continue
        matrix = batch.column("at").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        yield matrix, batch.column("label").to_numpy(), batch.column("weight").to_numpy()


def _entries(trees: Trees, slot_of: np.ndarray, matrix: np.ndarray):
    """(row, slot) for every row and tree in which the row stands at an open node; `slot_of` numbers these."""
    open_nodes = int(slot_of.max(initial=-1)) + 1
    size = max(1, max(_ENTRIES_AT_ONCE, open_nodes) // max(1, len(trees.root)))
    for begin in range(0, len(matrix), size):
        slots = slot_of[trees.leaves(matrix[begin:begin + size])]
        row, tree = np.nonzero(slots >= 0)
        yield row + begin, slots[row, tree]


def _widen(low: np.ndarray, high: np.ndarray, matrix: np.ndarray, row: np.ndarray, slot: np.ndarray, drawn: np.ndarray) -> None:
    numbers, begin = matrix.ravel(), row * matrix.shape[1]
    for j in range(drawn.shape[1]):
        values = numbers.take(begin + drawn[:, j].take(slot))
        np.minimum.at(low[:, j], slot, values)
        np.maximum.at(high[:, j], slot, values)


def _add(sums: np.ndarray, matrix: np.ndarray, label, weight, row: np.ndarray, slot: np.ndarray, drawn, threshold) -> None:
    numbers, begin = matrix.ravel(), row * matrix.shape[1]
    slots, draws = drawn.shape
    of_class, heavy = 2 * slot + label[row], weight[row]
    for j in range(draws + 1):
        at = slice(None)
        if j < draws:
            at = np.flatnonzero(numbers.take(begin + drawn[:, j].take(slot)) <= threshold[:, j].take(slot))
        sums[0, j] += np.bincount(slot[at], minlength=slots)
        sums[1:, j] += np.bincount(of_class[at], heavy[at], 2 * slots).reshape(slots, 2).T


def _ranges(shared):
    """Least and greatest value of each drawn feature (slot, draw) among the rows of a task."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, slot_of, drawn = shared.value
        drawn = np.asfortranarray(drawn)
        trees = Trees(*arrays)
        low, high = np.full(drawn.shape, np.inf), np.full(drawn.shape, -np.inf)
        for matrix, _, _ in _matrices(batches):
            for row, slot in _entries(trees, slot_of, matrix):
                _widen(low, high, matrix, row, slot, drawn)
        at = np.flatnonzero(low.ravel() <= high.ravel())
        yield pa.RecordBatch.from_pydict({"place": at, "low": low.ravel()[at], "high": high.ravel()[at]})

    return find


def _counts(shared):
    """Rows and class weights left of each threshold (slot, draw), and of the whole slot (draw -1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, slot_of, drawn, threshold = shared.value
        drawn, threshold = np.asfortranarray(drawn), np.asfortranarray(threshold)
        trees = Trees(*arrays)
        slots, draws = drawn.shape
        sums = np.zeros((3, draws + 1, slots))
        for matrix, label, weight in _matrices(batches):
            for row, slot in _entries(trees, slot_of, matrix):
                _add(sums, matrix, label, weight, row, slot, drawn, threshold)
        flat = sums.reshape(3, -1)
        at = np.flatnonzero(flat[0] > 0)
        yield pa.RecordBatch.from_pydict({"place": at, "n": flat[0][at], "w0": flat[1][at], "w1": flat[2][at]})

    return count


class _Passes:
    """The two passes of a level as Spark jobs over all rows."""

    def __init__(self, listed: DataFrame):
        self.listed = listed

    def _pass(self, task, held: tuple, schema: str, *sums):
        shared = self.listed.sparkSession.sparkContext.broadcast(held)
        try:
            return self.listed.mapInArrow(task(shared), schema).groupBy("place").agg(*sums).toPandas()
        finally:
            shared.unpersist()

    def ranges(self, frozen: Trees, slot_of, drawn):
        return self._pass(
            _ranges, (frozen.arrays(), slot_of, drawn), "place long, low double, high double",
            F.min("low").alias("low"), F.max("high").alias("high"),
        )

    def counts(self, frozen: Trees, slot_of, drawn, threshold):
        return self._pass(
            _counts, (frozen.arrays(), slot_of, drawn, threshold), "place long, n double, w0 double, w1 double",
            *[F.sum(c).alias(c) for c in ("n", "w0", "w1")],
        )


class _HeldRows:
    """The two passes of a level over rows that this task holds; each row moves one node down a level."""

    def __init__(self, matrix: np.ndarray, label: np.ndarray, weight: np.ndarray, trees: int):
        self.matrix, self.label, self.weight = np.ascontiguousarray(matrix), label, weight
        self.row = np.tile(np.arange(len(matrix), dtype=np.int32), trees)
        self.node = np.repeat(np.arange(trees, dtype=np.int32), len(matrix))

    def _pieces(self) -> Iterator[slice]:
        return (slice(begin, begin + _ENTRIES_AT_ONCE) for begin in range(0, len(self.row), _ENTRIES_AT_ONCE))

    def ranges(self, frozen: Trees, slot_of, drawn) -> dict[str, np.ndarray]:
        drawn, numbers = np.asfortranarray(drawn), self.matrix.ravel()
        for piece in self._pieces():
            row, node = self.row[piece].astype(np.int64), self.node[piece]
            left, right = frozen.left.take(node), frozen.right.take(node)
            lower = numbers.take(row * self.matrix.shape[1] + frozen.feature.take(node)) <= frozen.threshold.take(node)
            self.node[piece] = np.where(left < 0, node, np.where(lower, left, right))
        still = slot_of.take(self.node) >= 0
        if not still.all():
            self.row, self.node = self.row[still], self.node[still]
        low, high = np.full(drawn.shape, np.inf), np.full(drawn.shape, -np.inf)
        for piece in self._pieces():
            _widen(low, high, self.matrix, self.row[piece].astype(np.int64), slot_of.take(self.node[piece]), drawn)
        at = np.flatnonzero(low.ravel() <= high.ravel())
        return {"place": at, "low": low.ravel()[at], "high": high.ravel()[at]}

    def counts(self, frozen: Trees, slot_of, drawn, threshold) -> dict[str, np.ndarray]:
        drawn, threshold = np.asfortranarray(drawn), np.asfortranarray(threshold)
        sums = np.zeros((3, drawn.shape[1] + 1, len(drawn)))
        for piece in self._pieces():
            row, slot = self.row[piece].astype(np.int64), slot_of.take(self.node[piece])
            _add(sums, self.matrix, self.label, self.weight, row, slot, drawn, threshold)
        flat = sums.reshape(3, -1)
        at = np.flatnonzero(flat[0] > 0)
        return {"place": at, "n": flat[0][at], "w0": flat[1][at], "w1": flat[2][at]}


def _gini(w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
    """Weight times Gini impurity."""
    total = w0 + w1
    return np.where(total > 0, 2 * w0 * w1 / np.where(total > 0, total, 1.0), 0.0)


@dataclass(frozen=True)
class ExtraTreesGrower:
    """Settings of the growth; `fit` takes rows with `features`, `label` and `class_weight`.

    Each node draws the square root of the number of features, and for each of them one threshold, evenly between
    the least and the greatest value that its rows have there; the best of these splits is taken. No resampling of
    rows. A level costs two passes over the rows, whatever the number of trees: one for the ranges, one for the
    counts. What comes to the driver is as large as the open nodes, a part of the model.
    """

    trees: int
    max_depth: int | None = None
    least_rows: int = 2  # of a node that is split
    weighted: bool = False
    seed: int = 42

    def _listed(self, rows: DataFrame) -> DataFrame:
        weight = F.col("class_weight") if self.weighted else F.lit(1.0)
        return rows.select(
            vector_to_array("features").alias("at"), F.col("label").cast("int").alias("label"),
            weight.cast("double").alias("weight"),
        )

    def fit(self, rows: DataFrame) -> Trees:
        listed = self._listed(rows).persist()
        try:
            first = listed.head()
            return self._grown(len(first["at"]) if first else 0, _Passes(listed))
        finally:
            listed.unpersist()

    def fit_in_task(self, rows: DataFrame) -> Trees:
        """The same trees, grown by one task that holds the rows and, for every row and tree, the node it stands at."""
        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [[np.array(x) for x in part] for part in _matrices(batches)]
            if held:
                matrix, label, weight = (np.concatenate(x) for x in zip(*held))
                yield from listed_trees([self._grown(matrix.shape[1], _HeldRows(matrix, label, weight, self.trees))])

        return of_listed(self._listed(rows).coalesce(1).mapInArrow(fit, TREE_FIELDS).toArrow())

    def _grown(self, width: int, passes: _Passes | _HeldRows) -> Trees:
        draw = np.random.default_rng(self.seed)
        grown = _Growing(self.trees)
        open_nodes, tries, known_root = list(range(self.trees)), {}, False
        while open_nodes and width:
            frozen = grown.frozen()
            slot_of = np.full(len(frozen.left), -1)
            slot_of[open_nodes] = np.arange(len(open_nodes))
            k = max(1, math.isqrt(width))
            drawn = np.argsort(draw.random((len(open_nodes), width)), axis=1)[:, :k]
            found = passes.ranges(frozen, slot_of, drawn)
            low, high = np.zeros(drawn.size), np.zeros(drawn.size)
            low[found["place"]], high[found["place"]] = found["low"], found["high"]
            low, high = low.reshape(drawn.shape), high.reshape(drawn.shape)
            threshold = low + draw.random(drawn.shape) * (high - low)
            varied = high > low
            threshold = np.where(threshold >= high, low, threshold)  # both sides get a row
            found = passes.counts(frozen, slot_of, drawn, threshold)
            sums = np.zeros((3, (k + 1) * len(open_nodes)))
            for i, column in enumerate(("n", "w0", "w1")):
                sums[i, found["place"]] = found[column]
            sums = sums.reshape(3, k + 1, len(open_nodes))
            if not known_root:
                known_root = True
                for slot, node in enumerate(open_nodes):
                    n, w0, w1 = sums[:, k, slot]
                    grown.rows[node] = n
                    grown.positive[node] = w1 / (w0 + w1) if w0 + w1 > 0 else 0.0
            open_nodes = self._split(grown, open_nodes, tries, drawn, threshold, varied, sums)
        return grown.frozen()

    def _split(self, grown, open_nodes, tries, drawn, threshold, varied, sums) -> list[int]:
        """Split the open nodes at their best draws; the nodes that are open then."""
        k = drawn.shape[1]
        n, w0, w1 = sums[:, k]
        left_n, left0, left1 = sums[:, :k]
        after = _gini(left0, left1) + _gini(w0 - left0, w1 - left1)
        usable = varied.T & (left_n > 0) & (left_n < n)
        best = np.argmin(np.where(usable, after, np.inf), axis=0)
        following = []
        for slot, node in enumerate(open_nodes):
            depth = grown.depth[node]
            if n[slot] < self.least_rows or min(w0[slot], w1[slot]) <= 0 or depth == self.max_depth:
                continue
            j = best[slot]
            if not usable[j, slot]:
                tries[node] = tries.get(node, 0) + 1
                if tries[node] < _DRAWS:
                    following.append(node)
                continue
            grown.feature[node], grown.threshold[node] = int(drawn[slot, j]), float(threshold[slot, j])
            ln, l0, l1 = left_n[j, slot], left0[j, slot], left1[j, slot]
            for side, values in (("left", (ln, l0, l1)), ("right", (n[slot] - ln, w0[slot] - l0, w1[slot] - l1))):
                child = grown.child(depth + 1, *values)
                getattr(grown, side)[node] = child
                if min(values[1:]) > 1e-12 and values[0] >= self.least_rows:
                    following.append(child)
        return following
