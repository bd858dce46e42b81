"""The classifiers and their grids, as estimators over the columns `features`, `label`, `class_weight`."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import reduce
from threading import BoundedSemaphore
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.fixed_values import (
    BOOST_GRID, EXTRA_TREES_GRID, FOREST_GRID, LOGISTIC_C, LOGISTIC_L1_RATIO, NEIGHBOUR_GRID,
    SAMPLED_BOOST_GRID, SEED, TREE_GRID,
)
from ebbline.operators.evaluate import soft_vote
from ebbline.operators.knn import KnnIndex, vote
from ebbline.plans import growth
from ebbline.plans.extra_trees import IN_TASK_ENTRIES, ExtraTreesGrower
from ebbline.plans.trees import Cut, Trees, cut_probabilities
from ebbline.workspace import stage

SCORED = ["model", "key", "label", "probability", "prediction"]
CANDIDATES = ["model", "key", "label", "probability"]
TOLERANCE = 1e-4  # of the logistic solver; each further iteration is a pass over all rows
TREE_MEMORY_MB = 1024  # for split statistics: more nodes per pass, so fewer passes
ROUND_TASK_ROWS = 100_000  # rows of a boosted fit's partition, at least: its many small jobs cost more than their work
ROUNDS_KEPT = 25  # boosting rounds between two checkpoints; each is jobs and files of its own
_UNLIMITED_DEPTH = 30  # Spark's deepest tree
_LARGE_DEPTH = 12  # from here a tree may have nearly as many nodes as rows
_large_growths = BoundedSemaphore(2)  # Spark grows a tree on the driver, and has it there several times over


def scored(model: Any, rows: DataFrame, name: str) -> DataFrame:
    """(model, key, label, probability, prediction) of a fitted model over prepared rows."""
    if isinstance(model, Model):
        out = model.transform(rows).select(
            "key", "label",
            vector_to_array("probability")[1].alias("probability"),
            F.col("prediction").cast("int").alias("prediction"),
        )
    elif isinstance(model, Trees):
        out = rows.select("key", "label", model.column().alias("probability")).withColumn(
            "prediction", (F.col("probability") > 0.5).cast("int")
        )
    else:
        out = model.scores(rows)
    return out.select(F.lit(name).alias("model"), "key", F.col("label").cast("int").alias("label"), "probability", "prediction")


def _product(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def logistic(point: dict, rows: int) -> Estimator:
    """C is the inverse penalty on the summed loss; Spark penalises the mean loss."""
    return LogisticRegression(
        maxIter=1000, tol=TOLERANCE, regParam=1.0 / (point["C"] * rows), standardization=False,
        elasticNetParam={"l1": 1.0, "l2": 0.0}.get(point["penalty"], point.get("l1_ratio", 0.0)),
    )


def _tree_settings(point: dict) -> dict:
    settings = {"seed": SEED, "maxDepth": point["max_depth"] or _UNLIMITED_DEPTH, "maxMemoryInMB": TREE_MEMORY_MB}
    if "min_samples_leaf" in point:
        settings["minInstancesPerNode"] = point["min_samples_leaf"]
    if point.get("class_weight") == "balanced":
        settings["weightCol"] = "class_weight"
    return settings


def tree(point: dict, rows: int) -> Estimator:
    return DecisionTreeClassifier(**_tree_settings(point))


def forest(point: dict, rows: int) -> Estimator:
    return RandomForestClassifier(numTrees=point["n_estimators"], **_tree_settings(point))


def boosted(point: dict, rows: int) -> Estimator:
    columns = point.get("colsample_bytree", 1.0)
    return GBTClassifier(
        maxIter=point["n_estimators"], stepSize=point["learning_rate"], maxDepth=point["max_depth"],
        subsamplingRate=point["subsample"], seed=SEED, maxMemoryInMB=TREE_MEMORY_MB, checkpointInterval=ROUNDS_KEPT,
        featureSubsetStrategy="all" if columns == 1.0 else str(columns),
    )


def positive_share(near: DataFrame, weights: str) -> DataFrame:
    """(key, probability): the share of the neighbours' votes for class 1."""
    positive = F.coalesce(F.sum(F.when(F.col("class") == 1, F.col("share"))), F.lit(0.0))
    return vote(near, "key", "label", weights).groupBy("key").agg(positive.alias("probability"))


@dataclass(frozen=True)
class NearestNeighbours:
    """k-nearest-neighbour classifier; `fit` indexes the training rows."""

    point: dict

    def fit(self, rows: DataFrame) -> NearestNeighboursModel:
        listed = rows.select("key", "label", vector_to_array("features").alias("at"))
        index = KnnIndex.fit(listed, "key", "at", ["label"], self.point["metric"])
        return NearestNeighboursModel(index, self.point)


@dataclass(frozen=True)
class NearestNeighboursModel:
    index: KnnIndex
    point: dict

    def scores(self, rows: DataFrame) -> DataFrame:
        listed = rows.select("key", vector_to_array("features").alias("at"))
        near = self.index.neighbours(listed, "key", "at", self.point["n_neighbors"])
        shares = positive_share(near, self.point["weights"])
        return rows.select("key", "label").join(shares, "key").withColumn(
            "prediction", (F.col("probability") > 0.5).cast("int")
        )


@dataclass(frozen=True)
class SoftVoteModel:
    """The mean probability of its members."""

    members: dict[str, Any]

    def scores(self, rows: DataFrame) -> DataFrame:
        every = reduce(DataFrame.unionByName, [scored(m, rows, name) for name, m in self.members.items()])
        return soft_vote(every, list(self.members), "key").drop("model")


# --- How the points of a grid are fitted: those that one growth or one look-up answers are fitted together ---


class Alone:
    """Every point is a fit of its own."""

    sequential = False

    def __init__(self, build: Callable[[dict, int], Any]):
        self.build = build

    def groups(self, points: list[dict]) -> list[list[dict]]:
        return [[point] for point in points]

    def same_fit(self, points: list[dict]) -> tuple | None:
        """What decides the fit of a group, if another model may ask for the same one."""
        return None

    def candidates(self, points: list[dict], train: DataFrame, rows: int, held_out: DataFrame) -> DataFrame:
        """(model, key, label, probability) of `held_out` for every point, named by `str(point)`."""
        parts = [scored(self.fit(p, train, rows), held_out, str(p)) for p in points]
        return reduce(DataFrame.unionByName, parts).select(*CANDIDATES)

    def fit(self, point: dict, train: DataFrame, rows: int) -> Any:
        return self.build(point, rows).fit(train)

    def fit_chosen(self, point: dict, train: DataFrame, rows: int) -> Any:
        """The fit of the point that a search has chosen, on all training rows."""
        return self.fit(point, train, rows)


def _grouped(points: list[dict], free: tuple[str, ...]) -> list[list[dict]]:
    """Points that agree in all but the `free` parameters."""
    groups: dict[str, list[dict]] = {}
    for point in points:
        groups.setdefault(str({k: v for k, v in point.items() if k not in free}), []).append(point)
    return list(groups.values())


class SharedNeighbours(Alone):
    """One look-up of the most neighbours asked for answers all points of a metric."""

    def __init__(self):
        super().__init__(lambda point, rows: NearestNeighbours(point))

    def groups(self, points):
        return _grouped(points, ("n_neighbors", "weights"))

    def candidates(self, points, train, rows, held_out):
        most = max(p["n_neighbors"] for p in points)
        index = self.fit(points[0] | {"n_neighbors": most}, train, rows).index
        listed = held_out.select("key", vector_to_array("features").alias("at"))
        near = stage(index.neighbours(listed, "key", "at", most).select("key", "rank", "distance", "label"), "candidate-neighbours")
        labels = held_out.select("key", F.col("label").cast("int").alias("label"))
        shares = near.groupBy("key").agg(F.array(*[_positive(p["n_neighbors"], p["weights"]) for p in points]).alias("shares"))
        names = F.array(*[F.lit(str(p)) for p in points])
        return labels.join(shares, "key").select("key", "label", F.posexplode("shares").alias("nth", "probability")).select(
            F.get(names, F.col("nth")).alias("model"), "key", "label", "probability"
        )


def _positive(k: int, weights: str) -> Column:
    """`positive_share` of the `k` nearest as one aggregate, so all points share a pass over the neighbours."""
    inside = F.col("rank") <= k

    def share(weight: Column) -> Column:
        counted = F.when(inside, weight)
        return F.coalesce(F.sum(F.when(F.col("label") == 1, counted)) / F.sum(counted), F.lit(0.0))

    if weights != "distance":
        return share(F.lit(1.0))
    same = F.col("distance") == 0
    return F.when(F.max(F.when(inside, same)), share(same.cast("double"))).otherwise(share(F.try_divide(F.lit(1.0), F.col("distance"))))


def _limits(estimator: Estimator) -> tuple[int, int, str | None]:
    """Greatest depth, least rows of a leaf, and the column of weights."""
    least = estimator.getMinInstancesPerNode()
    if least < 1:
        raise ValueError(f"a leaf of at least {least} rows")
    return estimator.getMaxDepth(), least, estimator.getWeightCol() if estimator.isDefined("weightCol") else None


class SharedTrees(Alone):
    """One growth with the most trees and the greatest depth asked for; each point is a cut of it.

    Depth and the least number of rows of a split only say where growth ends, so cutting gives what growing with the
    limits would have given; fewer trees are the first ones. A forest grown alone draws other samples and features
    than the first trees of a larger one, so there the two agree in distribution.
    """

    def __init__(self, build, cut: tuple[str, ...] = ("n_estimators", "max_depth", "min_samples_split")):
        super().__init__(build)
        self.cut = cut

    def groups(self, points):
        return _grouped(points, self.cut)

    def candidates(self, points, train, rows, held_out):
        depths = [p["max_depth"] for p in points]
        widest = points[0] | {"max_depth": None if None in depths else max(depths), "min_samples_split": 2}
        if "n_estimators" in self.cut and "n_estimators" in widest:
            widest["n_estimators"] = max(p["n_estimators"] for p in points)
        cuts = [Cut(str(p), p.get("n_estimators", 1), p["max_depth"], p["min_samples_split"]) for p in points]
        return self.scored_cuts(widest, train, rows, held_out, cuts)

    def scored_cuts(self, widest: dict, train: DataFrame, rows: int, held_out: DataFrame, cuts: list[Cut]) -> DataFrame:
        grown, kind = self.grow(widest, train, rows)
        return cut_probabilities(held_out, grown, cuts, kind)

    def grow(self, point: dict, train: DataFrame, rows: int) -> tuple[Trees, str]:
        estimator = self.build(point, rows)
        if isinstance(estimator, DecisionTreeClassifier) and rows <= growth.IN_TASK_ROWS:
            return growth.tree_in_task(train, *_limits(estimator)), "merged"
        with _large_growths if (point["max_depth"] or _UNLIMITED_DEPTH) >= _LARGE_DEPTH else nullcontext():
            return Trees.of_model(train.sparkSession, estimator.fit(train)), "merged"

    def fit(self, point, train, rows):
        """Spark's own model where its parameters say all and it is not large; else its trees, cut."""
        if (point["max_depth"] or _UNLIMITED_DEPTH) >= _LARGE_DEPTH:
            return self.grow(point, train, rows)[0].cut(least_rows=point["min_samples_split"])
        model = self.build(point, rows).fit(train)
        if point["min_samples_split"] <= 2 * point.get("min_samples_leaf", 1):
            return model  # no node that is smaller can be split anyway
        return Trees.of_model(train.sparkSession, model).cut(least_rows=point["min_samples_split"])


class SharedForest(SharedTrees):
    """Tasks grow and score parts of the forests that are only searched; a chosen one of small trees is Spark's own."""

    def grow(self, point, train, rows):
        if rows > growth.IN_TASK_ROWS:
            return super().grow(point, train, rows)
        return growth.forest_in_task(train, rows, point["n_estimators"], *_limits(self.build(point, rows)), SEED), "merged"

    def scored_cuts(self, widest, train, rows, held_out, cuts):
        if rows > growth.IN_TASK_ROWS:
            return super().scored_cuts(widest, train, rows, held_out, cuts)
        return growth.forest_candidates(train, rows, held_out, cuts, *_limits(self.build(widest, rows)), SEED)


class SharedExtraTrees(SharedTrees):
    def __init__(self):
        super().__init__(None)

    def grow(self, point, train, rows):
        settings = ExtraTreesGrower(
            point["n_estimators"], point["max_depth"], point["min_samples_split"], point["class_weight"] == "balanced", SEED
        )
        small = 0 < rows * point["n_estimators"] <= IN_TASK_ENTRIES
        return settings.fit_in_task(train) if small else settings.fit(train), "plain"

    def fit(self, point, train, rows):
        return self.grow(point, train, rows)[0]


class SharedBoosting(Alone):
    """Boosting with more rounds begins with the rounds of the shorter one, whatever comes later."""

    sequential = True  # its rounds wait for each other, so a fit takes long however many cores are free

    def groups(self, points):
        return _grouped(points, ("n_estimators",))

    def same_fit(self, points):
        """Without a share of the columns all are used, as with a share of 1."""
        return self.build, *[tuple(sorted(({"colsample_bytree": 1.0} | point).items())) for point in points]

    def candidates(self, points, train, rows, held_out):
        rounds = [p["n_estimators"] for p in points]
        if len(points) == 1:
            return super().candidates(points, train, rows, held_out)
        longest = self.fit(points[0] | {"n_estimators": max(rounds)}, train, rows)
        margins = longest if isinstance(longest, Trees) else Trees.of_model(train.sparkSession, longest)
        return cut_probabilities(held_out, margins, [Cut(str(p), p["n_estimators"]) for p in points], "boosted")

    def fit(self, point, train, rows):
        estimator = self.build(point, rows)
        if isinstance(estimator, GBTClassifier) and rows <= growth.IN_TASK_ROWS:
            return growth.boosted_in_task(
                train, estimator.getMaxIter(), estimator.getStepSize(), estimator.getMaxDepth(), estimator.getSubsamplingRate(),
                estimator.getFeatureSubsetStrategy(), estimator.getSeed(), estimator.getMinInstancesPerNode(),
            )
        return estimator.fit(train.coalesce(max(1, rows // ROUND_TASK_ROWS)))

    def fit_chosen(self, point, train, rows):
        """Of few rows Spark's own: Java's exponential may differ in its last digit, which decides between equal splits."""
        return super().fit(point, train.coalesce(1), rows) if rows <= growth.EXACT_ROWS else self.fit(point, train, rows)


@dataclass(frozen=True)
class ModelSpec:
    """A classifier: how its grid points are fitted, its full grid and the short default grid (some of its points)."""

    name: str
    family: Alone
    full: list[dict]
    short: list[dict] = field(default_factory=list)

    def grid(self, size: str) -> list[dict]:
        return self.full if size == "full" else self.short


LOGISTIC_GRID = (
    _product({"C": LOGISTIC_C, "penalty": ["l1"]})
    + _product({"C": LOGISTIC_C, "penalty": ["l2"]})
    + _product({"C": LOGISTIC_C, "penalty": ["elasticnet"], "l1_ratio": LOGISTIC_L1_RATIO})
)

SPECS = [
    ModelSpec("Logistic Regression", Alone(logistic), LOGISTIC_GRID, [{"C": 0.1, "penalty": "l1"}, {"C": 1, "penalty": "l2"}]),
    ModelSpec(
        "K-Nearest Neighbors", SharedNeighbours(), _product(NEIGHBOUR_GRID),
        [{"n_neighbors": 10, "weights": "uniform", "metric": "euclidean"}],
    ),
    ModelSpec(
        "Decision Tree", SharedTrees(tree), _product(TREE_GRID),
        [{"max_depth": 5, "min_samples_split": 2, "min_samples_leaf": 4, "class_weight": None}],
    ),
    ModelSpec(
        "Random Forest", SharedForest(forest), _product(FOREST_GRID),
        [{"n_estimators": 100, "max_depth": 5, "min_samples_split": 2, "min_samples_leaf": 4, "class_weight": "balanced"}],
    ),
    ModelSpec(
        "XGBoost", SharedBoosting(boosted), _product(SAMPLED_BOOST_GRID),
        [{"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.8}],
    ),
    ModelSpec(
        "Gradient Boosting", SharedBoosting(boosted), _product(BOOST_GRID),
        [{"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0}],
    ),
    ModelSpec(
        "Extra Trees", SharedExtraTrees(), _product(EXTRA_TREES_GRID),
        [{"n_estimators": 100, "max_depth": 5, "min_samples_split": 2, "class_weight": None}],
    ),
    # Joins only when the sampled boosting above could be trained; library defaults, no grid search.
    ModelSpec(
        "LightGBM", SharedBoosting(boosted),
        [{"n_estimators": 100, "learning_rate": 0.1, "max_depth": 5, "subsample": 1.0}],
        [{"n_estimators": 100, "learning_rate": 0.1, "max_depth": 5, "subsample": 1.0}],
    ),
]
BY_NAME = {spec.name: spec for spec in SPECS}
