"""From the churn table to trained, compared and chosen models."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.fixed_values import CV_FOLDS, KEY, SEED, TARGET
from ebbline.functions.expressions import named
from ebbline.operators.evaluate import VOTE, best_model, classification_metrics, ranking_metrics, soft_vote
from ebbline.operators.scale import RobustScale
from ebbline.operators.select import (
    anova_f, counts_by_label, feature_votes, mutual_information, top_features,
)
from ebbline.operators.split import stratified_folds, train_test, with_class_weight
from ebbline.plans.features import FeaturePipeline
from ebbline.plans.models import (
    BY_NAME, SPECS, TOLERANCE, TREE_MEMORY_MB, ModelSpec, SoftVoteModel, scored,
)
from ebbline.workspace import stage

TASK_ROWS = 20_000  # prepared rows of a partition, at least
FULL_TASK_ROWS = 500_000  # and at most, unless the cores are as many as the partitions
SEQUENTIAL_FITS = 16  # boosted fits at a time: each waits for its own rounds and leaves most cores idle
CV_SCHEMA = "model string, grid_point string, folds int, mean_roc_auc double, error string"


def vectors(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """Assemble the feature vector; a missing value becomes 0, after scaling that is the median."""
    values = [F.coalesce(named(f).cast("double"), F.lit(0.0)) for f in features]
    return df.withColumn(out, array_to_vector(F.array(*values)))


def tree_importance(df: DataFrame, features: list[str], label: str, trees: int = 100) -> DataFrame:
    """Impurity importance of each feature in a random forest."""
    forest = RandomForestClassifier(numTrees=trees, seed=SEED, labelCol=label, maxMemoryInMB=TREE_MEMORY_MB)
    model = forest.fit(vectors(df, features))
    rows = [(f, float(s)) for f, s in zip(features, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def l1_coefficients(df: DataFrame, features: list[str], label: str, c: float = 1.0) -> DataFrame:
    """Coefficients of an L1-penalised logistic regression and which features they keep."""
    rows = df.count()
    model = LogisticRegression(
        labelCol=label, maxIter=1000, tol=TOLERANCE, elasticNetParam=1.0, regParam=1.0 / (c * rows),
        standardization=False,
    ).fit(vectors(df, features))
    found = [(f, float(b), abs(float(b)) >= 1e-5) for f, b in zip(features, model.coefficients.toArray())]
    return df.sparkSession.createDataFrame(found, "feature string, coefficient double, selected boolean")


def vote_features(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Votes of the four selection methods; `df` should be a staged table."""
    counts = stage(counts_by_label(df, features, label), "label-counts")
    fits = (tree_importance, l1_coefficients)
    with ThreadPool(len(fits)) as pool:  # both are many small jobs
        importance, coefficients = pool.map(lambda fit: fit(df, features, label), fits, chunksize=1)
    return feature_votes({
        "univariate": top_features(anova_f(counts)),
        "mutual_info": top_features(mutual_information(counts)),
        "tree_based": top_features(importance),
        "l1_regularization": coefficients.where("selected"),
    })


@dataclass(frozen=True, eq=False)
class TrainingSet:
    """Prepared rows (key, label, split, fold, class_weight, features vector) and what was fitted on them."""

    rows: DataFrame
    features: list[str]
    pipeline: FeaturePipeline
    scale: RobustScale

    @property
    def train(self) -> DataFrame:
        return self.rows.where("split = 'train'")

    @property
    def test(self) -> DataFrame:
        return self.rows.where("split = 'test'")


def fit_partitions(rows: int, cores: int) -> int:
    """Partitions of the rows that the fits pass over: one a core, fewer for few rows, more for very many.

    Each pass sends a result and its metrics a task to the driver, and there are hundreds of passes.
    """
    return max(1, min(rows // TASK_ROWS, cores), rows // FULL_TASK_ROWS)


def prepare_training(churn: DataFrame, select: bool = True) -> TrainingSet:
    """Prepare, select by vote, split 80/20 in each class, scale on the training part, assign folds.

    `churn` is read several times and should be a staged table.
    """
    pipeline = FeaturePipeline.fit(churn)
    # The fits pass over these tables hundreds of times, and each pass starts a task a partition.
    parts = fit_partitions(churn.count(), churn.sparkSession.sparkContext.defaultParallelism)
    table = stage(pipeline.transform(churn).where(F.col(TARGET).isNotNull()).repartition(parts), "features")
    features = pipeline.features
    if select:
        chosen = vote_features(table, features, TARGET).where("selected")
        names = {r["feature"] for r in chosen.collect()}  # feature names only
        features = [f for f in features if f in names]
    halves = train_test(table.select(KEY, TARGET, *[named(f) for f in features]), KEY, TARGET)
    halves = stage(halves, "split")
    scale = RobustScale.fit(halves.where("split = 'train'"), features)
    ready = vectors(scale.transform(halves), features).select(
        F.col(KEY).alias("key"), F.col(TARGET).cast("double").alias("label"), "split", "features"
    )
    weighted = with_class_weight(ready.where("split = 'train'"), "label")
    train = stratified_folds(weighted, "key", "label")
    test = ready.where("split = 'test'").withColumns({"class_weight": F.lit(1.0), "fold": F.lit(None).cast("int")})
    return TrainingSet(stage(train.unionByName(test).repartition(parts), "training-set"), features, pipeline, scale)


def cross_validate_all(
    specs: list[ModelSpec], train: DataFrame, grid: str = "short", folds: int = CV_FOLDS, parallelism: int = 8
) -> dict[str, tuple[list[tuple], dict | None]]:
    """Per model, mean ROC-AUC over the folds per grid point, and the best point.

    Points that one growth or look-up answers are fitted once a fold (`ModelSpec.family`); the fits of all models
    share two pools: those of many rounds have one of their own, so that none of them begins late and the others use
    the cores beside them. A fit that two models ask for is made once (`ModelSpec.family.same_fit`). What the held-out
    rows score is written fit by fold, and one pass per model ranks it. A failing point is a row with its error.
    """
    spark = train.sparkSession
    sizes = {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()}
    total = sum(sizes.values())

    def one(askers: list[tuple[ModelSpec, list[dict], int]]) -> DataFrame | str:
        spec, points, fold = askers[0]
        try:
            fitted, held_out = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
            found = spec.family.candidates(points, fitted, total - sizes.get(fold, 0), held_out)
            return stage(found.withColumn("model", F.concat(F.lit(f"{fold}:"), "model")), "candidates")
        except Exception as problem:  # recorded in the result
            return f"{type(problem).__name__}: {problem}"[:500]

    wanted = [(spec, points, fold) for spec in specs for points in spec.family.groups(spec.grid(grid)) for fold in range(folds)]
    sharing: dict[tuple, list[tuple[ModelSpec, list[dict], int]]] = {}  # who asks for a fit
    for nth, (spec, points, fold) in enumerate(wanted):
        sharing.setdefault((spec.family.same_fit(points) or nth, fold), []).append((spec, points, fold))
    tasks = sorted(sharing.values(), key=lambda askers: not askers[0][0].family.sequential)
    first = sum(askers[0][0].family.sequential for askers in tasks)
    with ThreadPool(max(1, min(first, SEQUENTIAL_FITS))) as long, ThreadPool(parallelism) as pool:
        begun = long.map_async(one, tasks[:first], chunksize=1)
        others = pool.map(one, tasks[first:], chunksize=1)
        outcomes = begun.get() + others

    def ranked(spec: ModelSpec) -> dict[str, float | None]:
        tables = [
            outcome for askers, outcome in zip(tasks, outcomes) if askers[0][0] is spec and not isinstance(outcome, str)
        ]
        if not tables:
            return {}
        scores = reduce(DataFrame.unionByName, tables).withColumn("prediction", F.lit(0))
        return {r["model"]: r["roc_auc"] for r in ranking_metrics(scores).collect()}  # one per point and fold

    with ThreadPool(parallelism) as pool:
        areas_of = dict(zip([spec.name for spec in specs], pool.map(ranked, specs, chunksize=1)))
    areas: dict[tuple[str, int, str], float | None] = {}
    errors: dict[tuple[str, str], str] = {}
    for askers, outcome in zip(tasks, outcomes):
        owner, made, fold = askers[0]
        for spec, points, _ in askers:  # their points are in the same order
            for point, same in zip(points, made):
                if isinstance(outcome, str):
                    errors[spec.name, str(point)] = outcome
                else:
                    areas[spec.name, fold, str(point)] = areas_of[owner.name].get(f"{fold}:{same}")
    found: dict[str, tuple[list[tuple], dict | None]] = {}
    for spec in specs:
        rows, best, best_score = [], None, 0.0
        for point in spec.grid(grid):
            name = str(point)
            per_fold = [areas.get((spec.name, fold, name)) for fold in range(folds)]
            problem = errors.get((spec.name, name))
            if problem is None and None in per_fold:
                problem = f"no ROC-AUC: fold {per_fold.index(None)} holds one class"
            mean = None if problem else sum(per_fold) / folds
            rows.append((spec.name, name, folds, mean, problem))
            if mean is not None and mean > best_score:
                best, best_score = point, mean
        found[spec.name] = rows, best
    return found


def cross_validate(
    spec: ModelSpec, train: DataFrame, grid: str = "short", folds: int = CV_FOLDS, parallelism: int = 8
) -> tuple[list[tuple], dict | None]:
    """`cross_validate_all` of one model."""
    return cross_validate_all([spec], train, grid, folds, parallelism)[spec.name]


def fit_on_all(spec: ModelSpec, point: dict, train: DataFrame) -> Any:
    return spec.family.fit_chosen(point, train, train.count())


@dataclass(frozen=True)
class Comparison:
    """Trained models, their cross-validation rows, test scores and metrics."""

    models: dict[str, Any]
    cv: DataFrame
    scores: DataFrame
    metrics: DataFrame

    @property
    def best(self) -> str:
        return best_model(self.metrics).head()["model"]


def train_models(data: TrainingSet, names: list[str] | None = None, grid: str = "short") -> Comparison:
    """Grid search, refit and test scores of every model, and the soft vote of the first three."""
    specs = [BY_NAME[n] for n in names] if names else SPECS
    searched = [spec for spec in specs if spec.name != "LightGBM"]
    # Long fits whose point needs no search run beside the searches; they are dropped if their model is not chosen.
    early = [spec for spec in specs if spec.family.sequential and len(spec.grid(grid)) == 1]
    with ThreadPool(max(1, len(specs))) as pool:
        begun = {
            spec.name: pool.apply_async(fit_on_all, (spec, spec.grid(grid)[0], data.train)) for spec in early
        }
        try:
            found = cross_validate_all(searched, data.train, grid)
            cv_rows = [row for spec in searched for row in found[spec.name][0]]
            chosen = {spec.name: found[spec.name][1] for spec in searched if found[spec.name][1] is not None}
            if "XGBoost" in chosen:
                chosen |= {spec.name: spec.grid(grid)[0] for spec in specs if spec.name == "LightGBM"}
            order = [spec for spec in specs if spec.name in chosen]
            for spec in order:
                if spec.name not in begun:
                    begun[spec.name] = pool.apply_async(fit_on_all, (spec, chosen[spec.name], data.train))
            fitted = [begun[spec.name].get() for spec in order]
        finally:
            for fit in begun.values():
                fit.wait()
    models = {spec.name: model for spec, model in zip(order, fitted)}
    if not models:
        raise ValueError(f"no model could be trained: {[row[-1] for row in cv_rows]}")
    scores = reduce(DataFrame.unionByName, [scored(m, data.test, name) for name, m in models.items()])
    scores = stage(scores, "scores")
    if len(models) >= 3:
        first = list(models)[:3]
        scores = scores.unionByName(soft_vote(scores, first, "key"))
        models[VOTE] = SoftVoteModel({name: models[name] for name in first})
    metrics = stage(classification_metrics(scores), "metrics")
    cv = data.rows.sparkSession.createDataFrame(cv_rows, CV_SCHEMA)
    return Comparison(models, cv, scores, metrics)
