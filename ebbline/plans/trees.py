"""Fitted binary decision trees as flat node arrays: cut to a grid point, scored, saved."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Workers get these functions with the task and need not have the package installed, so what only the driver needs of
# it is imported where it is used.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_DESCENTS_AT_ONCE = 262_144  # (row, tree) pairs that a task follows together; they stay in the processor's cache


@dataclass(frozen=True)
class Trees:
    """Trees one after the other; a node's children follow it, `left` is -1 at a leaf.

    `positive` is the share of class 1 among the node's training weight, `rows` its number of training rows. The
    probability of a row is the mean of `positive` over its leaves, one in each tree.
    """

    root: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray  # values up to it go left
    rows: np.ndarray
    positive: np.ndarray
    depth: np.ndarray

    FIELDS = ("left", "right", "feature", "threshold", "rows", "positive", "depth")

    def arrays(self) -> tuple[np.ndarray, ...]:
        """What travels to tasks; `Trees(*arrays)` is the same again."""
        return (self.root, *[getattr(self, f) for f in self.FIELDS])

    @classmethod
    def of_model(cls, spark: SparkSession, model: Model) -> Trees:
        """The trees of a fitted Spark classifier, read from its saved form (Spark itself holds them on the driver).

        Of a boosted model, `positive` is a node's weighted margin instead of a share.
        """
        from ebbline.workspace import new_path

        path, boosted = new_path(spark, "trees"), isinstance(model, GBTClassificationModel)
        PipelineModel([model]).write().save(path)
        table = spark.read.parquet(f"{path}/stages/*/data")
        if "nodeData" in table.columns:
            table = table.select("treeID", "nodeData.*")
        else:
            table = table.withColumn("treeID", F.lit(0))
        stats = [F.col("impurityStats")[i].cast("double").alias(f"class{i}") for i in range(2)]
        found = table.select(
            "treeID", "id", "leftChild", "rightChild", F.col("rawCount"), *([] if boosted else stats),
            F.col("split.featureIndex").alias("feature"),
            F.coalesce(F.get("split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("cut"), "prediction",
        ).orderBy("treeID", "id").toArrow()  # plain columns, no object a node
        column = {c: found.column(c).to_numpy() for c in found.column_names}
        tree = column["treeID"]
        root = np.flatnonzero(np.diff(tree, prepend=-1))
        offset = np.repeat(root, np.diff(np.append(root, len(tree))))
        inner = column["leftChild"] >= 0
        left = np.where(inner, column["leftChild"] + offset, -1)
        right = np.where(inner, column["rightChild"] + offset, -1)
        if boosted:
            positive = column["prediction"] * np.array(model.treeWeights)[tree]
        else:
            total = column["class0"] + column["class1"]
            positive = column["class1"] / np.where(total > 0, total, 1.0)
        depth, level = np.zeros(len(tree), dtype=np.int64), root
        while len(level):
            level = level[inner[level]]
            depth[left[level]] = depth[right[level]] = depth[level] + 1
            level = np.concatenate([left[level], right[level]])
        return cls(
            root, left, right, np.where(inner, column["feature"], 0), column["cut"].astype(float),
            column["rawCount"], positive, depth,
        )

    def stops(self, max_depth: int | None = None, least_rows: int = 0, merged: bool = True) -> np.ndarray:
        """For every node the leaf that takes its rows if no node beyond `max_depth`, or with fewer than `least_rows`
        rows, is split; with `merged`, siblings that predict the same are one leaf, as Spark's classifiers have it.

        Growth does not look at what comes below a node, so the tree cut in this way is the one that these limits
        would have grown.
        """
        inner = (self.left >= 0) & (self.rows >= least_rows)
        if max_depth is not None:
            inner &= self.depth < max_depth
        called = self.positive > 0.5
        for level in range(int(self.depth.max(initial=0)) if merged else -1, -1, -1):
            at = np.flatnonzero(inner & (self.depth == level))
            left, right = self.left[at], self.right[at]
            inner[at[~inner[left] & ~inner[right] & (called[left] == called[right])]] = False
        stop = np.arange(len(self.left))
        for level in range(int(self.depth.max(initial=0))):
            at = np.flatnonzero((self.left >= 0) & (self.depth == level))
            closed = at[~inner[at] | (stop[at] != at)]
            stop[self.left[closed]] = stop[closed]
            stop[self.right[closed]] = stop[closed]
        return stop

    def cut(
        self, max_depth: int | None = None, least_rows: int = 0, trees: int | None = None, merged: bool = True
    ) -> Trees:
        """The first `trees` trees, cut as `stops` says."""
        stop = self.stops(max_depth, least_rows, merged)
        end = self.root[trees] if trees is not None and trees < len(self.root) else len(self.left)
        kept = np.flatnonzero((stop == np.arange(len(stop))) & (np.arange(len(stop)) < end))
        number = np.full(len(stop), -1)
        number[kept] = np.arange(len(kept))
        children = [np.where(self.left[kept] >= 0, number[c[kept]], -1) for c in (self.left, self.right)]
        rest = [getattr(self, f)[kept] for f in ("feature", "threshold", "rows", "positive", "depth")]
        return Trees(number[self.root[self.root < end]], *children, *rest)

    @cached_property
    def _following(self) -> np.ndarray:
        """The right and the left child of every node, one after the other; a leaf follows itself."""
        node = np.arange(len(self.left))
        return np.stack([np.where(self.left >= 0, c, node) for c in (self.right, self.left)], axis=1).ravel()

    def leaves(self, matrix: np.ndarray) -> np.ndarray:
        """rows x trees: the leaf that each row reaches in each tree."""
        at = np.broadcast_to(self.root, (len(matrix), len(self.root))).copy()
        values, inner = np.ascontiguousarray(matrix).ravel(), self.left >= 0
        begin = (np.arange(len(matrix)) * matrix.shape[1])[:, None]
        while inner.take(at).any():
            left = values.take(begin + self.feature.take(at)) <= self.threshold.take(at)
            at = self._following.take(2 * at + left)
        return at

    def _pieces(self, matrix: np.ndarray) -> Iterator[np.ndarray]:
        size = max(1, _DESCENTS_AT_ONCE // max(1, len(self.root)))
        for begin in range(0, len(matrix), size):
            yield self.leaves(matrix[begin:begin + size])

    def probability(self, matrix: np.ndarray) -> np.ndarray:
        parts = [self.positive[leaf].mean(axis=1) for leaf in self._pieces(matrix)]
        return np.concatenate(parts) if parts else np.empty(0)

    def probabilities(self, matrix: np.ndarray, points: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """rows x points, for points (number of trees, positive share by node): one descent answers all."""
        out = [
            np.stack([share[leaf[:, :trees]].mean(axis=1) for trees, share in points], axis=1)
            for leaf in self._pieces(matrix)
        ]
        return np.concatenate(out) if out else np.empty((0, len(points)))

    def column(self, features: str = "features") -> Column:
        """The probability as a column over a feature vector; stateless, so it also works in a stream."""
        held, kind = self.arrays(), type(self)

        @F.pandas_udf("double")
        def score(vectors: pd.Series) -> pd.Series:
            return pd.Series(kind(*held).probability(np.array(vectors.to_list(), dtype=float)), index=vectors.index)

        return score(vector_to_array(features))

    def save(self, spark: SparkSession, path: str) -> None:
        starts = np.isin(np.arange(len(self.left)), self.root)
        table = pa.table({"node": np.arange(len(self.left)), "starts": starts} | {f: getattr(self, f) for f in self.FIELDS})
        spark.createDataFrame(table).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Trees:
        held = spark.read.parquet(path).orderBy("node").toPandas()
        return cls(np.flatnonzero(held["starts"].to_numpy()), *[held[f].to_numpy() for f in cls.FIELDS])


class BoostedTrees(Trees):
    """Trees of a boosted model: `positive` is a node's weighted margin, and margins add up."""

    def probability(self, matrix: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-2.0 * len(self.root) * super().probability(matrix)))


_WHOLE = ("left", "right", "feature", "depth")
TREE_FIELDS = ", ".join(["first int", *[f"`{f}` {'long' if f in _WHOLE else 'double'}" for f in Trees.FIELDS]])


def joined_trees(groups: list[Trees]) -> Trees:
    """All trees of some groups, in their order."""
    begin = np.cumsum([0, *[len(g.left) for g in groups]])[: len(groups)]
    moved = [[np.where(c >= 0, c + b, -1) for g, b in zip(groups, begin) for c in [getattr(g, side)]] for side in ("left", "right")]
    rest = [[getattr(g, f) for g in groups] for f in Trees.FIELDS[2:]]
    return Trees(np.concatenate([g.root + b for g, b in zip(groups, begin)]), *map(np.concatenate, moved + rest))


def listed_trees(groups: Iterable[Trees]) -> Iterator[pa.RecordBatch]:
    """Trees as rows that a task returns, one group after the other; `first` says where a tree begins."""
    begin = 0
    for trees in groups:
        starts = np.zeros(len(trees.left), dtype=np.int32)
        starts[trees.root] = 1
        held = {f: getattr(trees, f).astype(np.int64 if f in _WHOLE else float) for f in Trees.FIELDS}
        for side in ("left", "right"):
            held[side] = np.where(held[side] >= 0, held[side] + begin, -1)
        begin += len(starts)
        yield pa.RecordBatch.from_pydict({"first": starts} | held)


def of_listed(found: pa.Table, cls: type[Trees] = Trees) -> Trees:
    """The trees of one task in the order in which they were returned."""
    return cls(np.flatnonzero(found.column("first").to_numpy()), *[found.column(f).to_numpy().copy() for f in Trees.FIELDS])


@dataclass(frozen=True)
class Cut:
    """What a grid point leaves of a growth: so many trees, cut at a depth and at nodes of few rows."""

    name: str
    trees: int = 1
    max_depth: int | None = None
    least_rows: int = 0


def cut_probabilities(rows: DataFrame, trees: Trees, cuts: list[Cut], kind: str = "merged") -> DataFrame:
    """(model, key, label, probability) of `rows` for many cuts of one growth, from one descent.

    `kind`: "merged" as in `Trees.stops`, "plain" without, "boosted" if the trees hold margins that add up.
    """
    shares: dict[tuple, np.ndarray] = {}
    for c in cuts:
        if (c.max_depth, c.least_rows) not in shares:
            shares[c.max_depth, c.least_rows] = trees.positive[trees.stops(c.max_depth, c.least_rows, kind == "merged")]
    asked = [(c.trees, shares[c.max_depth, c.least_rows]) for c in cuts]
    shared = rows.sparkSession.sparkContext.broadcast((trees.arrays(), asked))
    margins = np.array([2.0 * c.trees for c in cuts]) if kind == "boosted" else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, points = shared.value
        grown = Trees(*arrays)
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = batch.column("at").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            found = grown.probabilities(matrix, points)
            if margins is not None:
                found = 1 / (1 + np.exp(-margins * found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array(list(found), pa.list_(pa.float64()))],
                ["key", "label", "found"],
            )

    kinds = dict(rows.dtypes)
    listed = rows.select("key", F.col("label").cast("int").alias("label"), vector_to_array("features").alias("at"))
    scored = listed.mapInArrow(score, f"key {kinds['key']}, label int, found array<double>")
    names = F.array(*[F.lit(c.name) for c in cuts])
    return scored.select("key", "label", F.posexplode("found").alias("nth", "probability")).select(
        F.get(names, F.col("nth")).alias("model"), "key", "label", "probability"
    )
