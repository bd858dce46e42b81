import json
from threading import Barrier, Event
from types import SimpleNamespace

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ebbline.catalog import model_queries
from ebbline.fixed_values import BOOST_GRID, EXTRA_TREES_GRID, FOREST_GRID, KEY, NEIGHBOUR_GRID, SAMPLED_BOOST_GRID, TREE_GRID
from ebbline.operators.evaluate import ranking_metrics
from ebbline.operators.split import stratified_folds, train_test, with_class_weight
from ebbline.plans import analysis, deploy, models, registry, saved, scoring, training
from ebbline.plans.features import FeaturePipeline
from ebbline.schemas import REQUEST
from ebbline.sources.base_view import load_churn_table
from ebbline.sources.requests import to_requests
from ebbline.sources.tables import customers_from
from ebbline.streaming.score import request_stream, stream_scores, stream_scores_and_alerts
from ebbline.streaming.upsert import merged, stream_changes
from ebbline.workspace import new_path, stage

# A request with every field of the schema; the values are made up from the fields' places.
EXAMPLE = {
    f.name: {"int": i, "double": 10.5 * i}.get(f.dataType.simpleString(), str(20 * i) if f.name == "TotalCharges" else "Yes")
    for i, f in enumerate(REQUEST.fields)
} | {KEY: "example-1"}


def test_grids_have_the_expected_sizes():
    sizes = [len(models.LOGISTIC_GRID)] + [
        len(models._product(g))
        for g in (NEIGHBOUR_GRID, TREE_GRID, FOREST_GRID, SAMPLED_BOOST_GRID, BOOST_GRID, EXTRA_TREES_GRID)
    ]
    assert sizes == [20, 16, 72, 216, 72, 36, 24]


def test_short_points_lie_inside_the_full_grids():
    assert all(spec.short and all(point in spec.full for point in spec.short) for spec in models.SPECS)


def test_fits_that_need_no_search_run_beside_the_searches(monkeypatch):
    begun, fitted = Event(), []

    class Searched(Exception):
        pass

    def fit_on_all(spec, point, train):
        fitted.append((spec.name, point))
        if len(fitted) == 3:
            begun.set()

    def cross_validate_all(specs, train, grid="short"):
        raise Searched(begun.wait(20))

    monkeypatch.setattr(training, "fit_on_all", fit_on_all)
    monkeypatch.setattr(training, "cross_validate_all", cross_validate_all)
    with pytest.raises(Searched, match="True"):
        training.train_models(SimpleNamespace(train=None))
    long = ("XGBoost", "Gradient Boosting", "LightGBM")
    assert sorted(fitted, key=str) == sorted(((n, models.BY_NAME[n].short[0]) for n in long), key=str)


def test_all_fits_of_many_rounds_begin_at_once(spark):
    together = Barrier(10)

    class Rounds(models.Alone):
        sequential = True

        def candidates(self, points, train, rows, held_out):
            together.wait(60)
            return held_out.select(F.lit(str(points[0])).alias("model"), "key", "label", F.lit(0.5).alias("probability"))

    specs = [models.ModelSpec(name, Rounds(None), [{"n": 1}], [{"n": 1}]) for name in ("first", "second")]
    rows = spark.range(20).select(
        F.col("id").alias("key"), (F.col("id") % 2).cast("int").alias("label"), (F.floor(F.col("id") / 2) % 5).alias("fold")
    )
    found = training.cross_validate_all(specs, rows)
    for name in ("first", "second"):
        assert found[name] == ([(name, "{'n': 1}", 5, 0.5, None)], {"n": 1})


def test_registered_queries_train_every_model(monkeypatch):
    asked = []

    def train_models(data, names=None, grid="short"):
        asked.append(([s.name for s in models.SPECS] if names is None else names, grid))
        return SimpleNamespace(cv=None)

    def run_analysis(churn, root, at=None, models=None, grid="short", trained=None):
        assert trained  # the comparison of the other queries, not a training of its own
        return SimpleNamespace(reports=[])

    monkeypatch.setattr(training, "train_models", train_models)
    monkeypatch.setattr(analysis, "run_analysis", run_analysis)
    for name in ("_prepared", "prepared", "compared", "churn", "new_path"):
        monkeypatch.setattr(model_queries, name, lambda *_: None)
    monkeypatch.setattr(model_queries, "instant", lambda: None)
    model_queries._compared.__wrapped__("app", "sf")
    model_queries.cv_results_full_grids(None, "sf")
    with pytest.raises(TypeError):  # no reports to unite
        model_queries.run_analysis(None, "sf")
    every = [s.name for s in models.SPECS]
    assert asked == [(every, "short"), (every, "full")]


@pytest.fixture(scope="module")
def planted(spark):
    """Features x1, x2 and a category drive y; the rest is noise. `shuffled` has y in another order."""
    def unit(i):
        return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1_000_003)) / 1_000_003

    df = spark.range(1200).select("id", *[(unit(i) * 4 - 2).alias(f"x{i}") for i in range(1, 7)], unit(9).alias("u"),
                                  F.pmod(F.xxhash64("id", F.lit(8)), F.lit(3)).cast("double").alias("c"))
    p = 1 / (1 + F.exp(-(2 * F.col("x1") - 1.5 * F.col("x2") + 2 * (F.col("c") == 1).cast("int"))))
    rows = df.withColumn("label", (F.col("u") < p).cast("double"))
    rows = VectorAssembler(inputCols=[*[f"x{i}" for i in range(1, 7)], "c"], outputCol="features").transform(rows)
    out = {}
    for name, frame in {
        "planted": rows,
        "shuffled": rows.withColumn("label", (F.pmod(F.xxhash64("id", F.lit(77)), F.lit(2))).cast("double")),
    }.items():
        keyed = frame.select(F.col("id").alias("key"), "label", "features")
        halves = stage(train_test(keyed, "key", "label"), name)
        folded = stratified_folds(halves.where("split = 'train'"), "key", "label")
        out[name] = stage(
            with_class_weight(folded, "label").unionByName(halves.where("split = 'test'"), allowMissingColumns=True), name)
    return out


CHEAP = ("Logistic Regression", "Decision Tree", "Random Forest")


@pytest.mark.parametrize("name", [s.name for s in models.SPECS if s.name != "LightGBM"])
def test_models_find_a_planted_signal(planted, name):
    spec = models.BY_NAME[name]
    for table, low, high in [("planted", 0.8, 1.0), ("shuffled", 0.38, 0.62)][: 2 if name in CHEAP else 1]:
        rows = planted[table]
        model = training.fit_on_all(spec, spec.short[0], rows.where("split = 'train'"))
        scores = models.scored(model, rows.where("split = 'test'"), name)
        assert scores.columns == models.SCORED
        assert low <= ranking_metrics(scores).head()["roc_auc"] <= high


def test_a_failing_grid_point_is_a_row(planted):
    points = [
        {"max_depth": 3, "min_samples_split": 2, "min_samples_leaf": -1},
        {"max_depth": 3, "min_samples_split": 2, "min_samples_leaf": 1},
    ]
    spec = models.ModelSpec("Decision Tree", models.SharedTrees(models.tree), [], points)
    rows, best = training.cross_validate(spec, planted["planted"].where("split = 'train'"))
    assert rows[0][3] is None and rows[0][4] and rows[1][4] is None
    assert best == points[1]


def by_hand(spec, point, train, folds=2):
    """Mean ROC-AUC of a point that is fitted alone, fold by fold."""
    areas = []
    for fold in range(folds):
        fitted, held_out = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
        model = spec.family.fit(point, fitted, fitted.count())
        areas.append(ranking_metrics(models.scored(model, held_out, "x")).head()["roc_auc"])
    return sum(areas) / folds


@pytest.mark.parametrize("name, points", [
    ("Decision Tree", [
        {"max_depth": d, "min_samples_split": s, "min_samples_leaf": 2, "class_weight": "balanced"}
        for d, s in ((3, 2), (None, 10), (5, 25))]),
    ("K-Nearest Neighbors", [
        {"n_neighbors": k, "weights": w, "metric": "manhattan"} for k, w in ((3, "uniform"), (7, "distance"), (10, "uniform"))]),
    ("Gradient Boosting", [
        {"n_estimators": n, "learning_rate": 0.2, "max_depth": 3, "subsample": 0.8} for n in (3, 8, 12)]),
    ("Logistic Regression", [{"C": 1, "penalty": "l2"}, {"C": 0.1, "penalty": "l1"}]),
])
def test_points_fitted_together_equal_points_fitted_alone(planted, name, points):
    spec = models.ModelSpec(name, models.BY_NAME[name].family, points)
    train = planted["planted"].where("split = 'train'").withColumn("fold", F.col("fold") % 2)
    rows, best = training.cross_validate(spec, train, "full", folds=2)
    assert [r[1] for r in rows] == [str(p) for p in points] and best in points
    for row, point in zip(rows, points):
        assert row[3] == pytest.approx(by_hand(spec, point, train), abs=1e-9)


def test_shared_fits_of_the_full_grids():
    """How many fits a fold the grids need."""
    needed = {s.name: len(s.family.groups(s.full)) for s in models.SPECS}
    assert needed["Decision Tree"] == needed["Random Forest"] == 6 and needed["K-Nearest Neighbors"] == 2
    assert needed["Extra Trees"] == 2 and needed["XGBoost"] == 36 and needed["Gradient Boosting"] == 18
    assert all(sorted(map(str, sum(s.family.groups(s.full), []))) == sorted(map(str, s.full)) for s in models.SPECS)


def test_a_fit_that_two_models_ask_for_is_made_once(planted, monkeypatch):
    fitted, fit = [], models.SharedBoosting.fit

    def counted(self, point, train, rows):
        fitted.append(point)
        return fit(self, point, train, rows)

    monkeypatch.setattr(models.SharedBoosting, "fit", counted)
    plain = [{"n_estimators": n, "learning_rate": 0.2, "max_depth": 3, "subsample": 0.8} for n in (2, 4)]
    both = [p | {"colsample_bytree": c} for c in (0.5, 1.0) for p in plain]
    specs = [models.ModelSpec(n, models.SharedBoosting(models.boosted), p) for n, p in (("sampled", both), ("plain", plain))]
    train = planted["planted"].where("split = 'train'").withColumn("fold", F.col("fold") % 2)
    found = training.cross_validate_all(specs, train, "full", folds=2)
    assert len(fitted) == 4  # two a fold, not three
    assert [r[:3] for r in found["plain"][0]] == [("plain", str(p), 2) for p in plain]
    assert [r[3] for r in found["plain"][0]] == [r[3] for r in found["sampled"][0][2:]]
    alone = training.cross_validate(specs[1], train, "full", folds=2)
    assert found["plain"][1] == alone[1]
    assert [r[3] for r in found["plain"][0]] == pytest.approx([r[3] for r in alone[0]], abs=1e-9)


def test_a_shared_fit_that_fails_is_an_error_of_both_models(planted):
    def broken(point, rows):
        raise ValueError("no such model")

    point = {"n_estimators": 2, "learning_rate": 0.2, "max_depth": 3, "subsample": 1.0}
    specs = [models.ModelSpec(n, models.SharedBoosting(broken), [point], [point]) for n in ("first", "second")]
    found = training.cross_validate_all(specs, planted["planted"].where("split = 'train'"), folds=2)
    for name in ("first", "second"):
        assert found[name] == ([(name, str(point), 2, None, "ValueError: no such model")], None)


def test_boosted_fits_of_the_full_grids():
    groups = {s.name: [s.family.same_fit(g) for g in s.family.groups(s.full)] for s in models.SPECS}
    assert len(set(groups["XGBoost"] + groups["Gradient Boosting"])) == 42  # a fold; 54 are asked for
    assert set(groups["Decision Tree"] + groups["Extra Trees"]) == {None}


def test_boosted_fits_have_partitions_by_their_rows(spark):
    rows = spark.range(80, numPartitions=8)
    seen = []

    class Seen:
        def fit(self, train):
            seen.append(train.rdd.getNumPartitions())

    family = models.SharedBoosting(lambda point, rows: Seen())
    for count in (80, 3 * models.ROUND_TASK_ROWS, 100 * models.ROUND_TASK_ROWS):
        family.fit({}, rows, count)
    assert seen == [1, 3, 8]


@pytest.mark.parametrize("name", [*(s.name for s in models.SPECS), "vote"])
def test_every_model_scores_the_same_after_saving(spark, planted, name):
    train, test = (planted["planted"].where(f"split = '{part}'") for part in ("train", "test"))

    def small(spec):
        point = spec.short[0]
        cut = {"n_estimators": 4, "max_depth": 3, "min_samples_split": 20}
        return spec.family.fit(point | {k: v for k, v in cut.items() if k in point}, train, train.count())

    if name == "vote":
        members = ("Decision Tree", "K-Nearest Neighbors", "Extra Trees")
        model = models.SoftVoteModel({m: small(models.BY_NAME[m]) for m in members})
    else:
        model = small(models.BY_NAME[name])
    path = new_path(spark, "model")
    saved.save_model(spark, model, path)
    loaded = saved.load_model(spark, path)
    before, after = (sorted(map(tuple, models.scored(m, test, name).collect())) for m in (model, loaded))
    assert before == after and len(before) == test.count()
    if saved.is_stateless(model):
        alone = {r["key"]: r["p"] for r in saved.with_probability(loaded, test, "p").collect()}
        assert alone == pytest.approx({key: p for _, key, _, p, _ in before}, abs=1e-12)


@pytest.fixture(scope="module")
def churn(spark, sf_dir):
    return stage(load_churn_table(spark, sf_dir), "churn")


@pytest.fixture(scope="module")
def bundle(spark, churn):
    data = training.prepare_training(churn, select=False)
    spec = models.BY_NAME["Decision Tree"]
    model = training.fit_on_all(spec, spec.short[0], data.train)
    return registry.ModelBundle(spec.name, model, data.features, data.pipeline, data.scale)


@pytest.mark.parametrize("missing", ["neighbours", "zero"])
def test_one_record_is_prepared_as_in_a_batch(churn, missing):
    pipeline = FeaturePipeline.fit(churn)
    batch = {r[KEY]: r for r in pipeline.transform(churn, missing).collect()}
    assert len(batch) == churn.count()
    blank = churn.where("TotalCharges = ' '").orderBy(KEY).head()[KEY]
    for key in [blank, churn.orderBy(KEY).head()[KEY]]:
        alone = pipeline.transform(churn.where(F.col(KEY) == key), missing).collect()
        assert alone == [batch[key]]


def test_transform_has_a_fixed_width(spark, churn):
    pipeline = FeaturePipeline.fit(churn)
    odd = churn.limit(1).withColumns({"Contract": F.lit("Ten year"), "tenure": F.lit(80)}).drop("Churn")
    row = pipeline.transform(odd).head().asDict()
    assert list(row) == [KEY, *pipeline.features]
    assert sum(v for k, v in row.items() if k.startswith(("Contract_", "tenure_group_"))) == 0


def test_bundle_survives_saving(spark, churn, bundle):
    path = new_path(spark, "bundle")
    bundle.save(spark, path)
    loaded = registry.ModelBundle.load(spark, path)
    assert loaded.features == bundle.features and loaded.name == bundle.name
    same = [sorted(map(tuple, scoring.probabilities(churn, b).collect())) for b in (bundle, loaded)]
    assert same[0] == same[1]


def test_requests_good_and_bad(spark, bundle):
    anonymous = {k: v for k, v in EXAMPLE.items() if k != "customerID"}
    partial = {k: v for k, v in EXAMPLE.items() if k != "Contract"}
    texts = [json.dumps(EXAMPLE), json.dumps(EXAMPLE), json.dumps(anonymous), json.dumps(partial), "{oops"]
    values = spark.createDataFrame([(t,) for t in texts], "value string")
    for missing in ("neighbours", "zero"):
        found = scoring.score_requests(values, bundle, missing).collect()
        assert sorted(((r["customer_id"], r["status"], r["error"]) for r in found), key=str) == sorted([
            (EXAMPLE[KEY], "success", None), (EXAMPLE[KEY], "success", None), ("unknown", "success", None),
            (EXAMPLE[KEY], "error", "missing field Contract"), ("unknown", "error", "malformed JSON"),
        ], key=str)
        good = [r for r in found if r["status"] == "success"]
        assert len(good) == 3 and len({r["churn_probability"] for r in good}) == 1
        assert all(r["risk_level"] in ("Low", "Medium", "High") for r in good)
        assert all(r["churn_probability"] is None for r in found if r["status"] == "error")


def test_stream_equals_batch(spark, churn, bundle):
    path = new_path(spark, "requests")
    to_requests(churn).repartition(3).write.text(path)
    values = spark.read.text(path)

    def rows(df):
        return sorted(map(str, df.select("customer_id", "churn_probability", "risk_level", "status").collect()))

    out, raised = new_path(spark, "out"), new_path(spark, "alerts")
    stream_scores(request_stream(spark, path, 1), bundle, out, new_path(spark, "p")).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(scoring.score_requests(values, bundle, "zero"))
    full = new_path(spark, "out")
    query = stream_scores_and_alerts(request_stream(spark, path, 1), bundle, full, raised, new_path(spark, "p"))
    query.awaitTermination()
    batch = scoring.score_requests(values, bundle)
    assert rows(spark.read.parquet(full)) == rows(batch)
    assert rows(spark.read.parquet(raised)) == rows(batch.where("risk_level = 'High'"))


def test_replayed_upserts_change_nothing(spark, churn):
    path, log = new_path(spark, "in"), new_path(spark, "log")
    known = churn.select(KEY, "Contract", "gender")
    one = known.orderBy(KEY).head()[KEY]
    changes = spark.createDataFrame(
        [(one, "A", 1), (one, "B", 2), ("new", "C", 1), (None, "D", 1)], f"{KEY} string, Contract string, at int")
    changes.coalesce(1).write.json(path)
    for _ in range(2):  # a lost checkpoint replays everything
        records = spark.readStream.schema(changes.schema).json(path)
        stream_changes(records, "at", log, new_path(spark, "p")).awaitTermination()
    out = merged(known, spark.read.parquet(log), "at")
    assert out.count() == known.count() + 1
    assert out.where(F.col(KEY) == one).head()["Contract"] == "B"
    assert out.where(F.col(KEY) == "new").head()["Contract"] == "C"


def test_a_model_with_look_ups_scores_a_stream_by_batches(spark, churn):
    data = training.prepare_training(churn, select=False)
    spec = models.BY_NAME["K-Nearest Neighbors"]
    held = registry.ModelBundle(spec.name, training.fit_on_all(spec, spec.short[0], data.train), data.features, data.pipeline, data.scale)
    path, out = new_path(spark, "requests"), new_path(spark, "out")
    to_requests(churn.limit(20)).repartition(2).write.text(path)
    stream_scores(request_stream(spark, path, 1), held, out, new_path(spark, "p")).awaitTermination()
    found = spark.read.parquet(out).where("status = 'success'")
    assert found.count() == 20 and found.where("churn_probability IS NULL").count() == 0
    wanted = scoring.score_requests(spark.read.text(path), held, "zero")
    pair = ["customer_id", "churn_probability"]
    assert sorted(map(tuple, found.select(pair).collect())) == sorted(map(tuple, wanted.select(pair).collect()))
    with pytest.raises(ValueError, match="batch by batch"):
        scoring.score_requests(request_stream(spark, path), held, "zero")


def test_scoring_again_replaces_its_own_run_only(spark, churn, bundle):
    known = stage(customers_from(churn, F.lit("2024-01-01 00:00:00").cast("timestamp")), "known")
    path = new_path(spark, "predictions")

    def run(at):
        return scoring.batch_scoring(known, bundle, F.lit(at).cast("timestamp"), path)

    first, updated = run("2024-05-01 10:00:00")
    rows = sorted(map(tuple, first.collect()))
    run("2024-05-01 12:00:00")
    run("2024-05-02 09:00:00")
    again, updated_again = run("2024-05-01 10:00:00")
    assert sorted(map(tuple, again.collect())) == rows and len(rows) == known.count()
    assert scoring.read_predictions(spark, path).count() == 3 * len(rows)
    assert sorted(map(str, updated.collect())) == sorted(map(str, updated_again.collect()))
    newest = scoring.newest_predictions(spark, path)
    assert [str(r[0]) for r in newest.select("prediction_date").distinct().collect()] == ["2024-05-02 09:00:00"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(prediction_day" in plan


def test_retraining_moves_the_pointer_only_forward(spark, churn, bundle):
    root = new_path(spark, "deployments")
    data = training.prepare_training(churn, select=False)

    def with_model(model, name):
        return lambda _: (data, registry.ModelBundle(name, model, data.features, data.pipeline, data.scale))

    shallow, deep = (
        models.tree({"max_depth": d, "min_samples_leaf": 1}, 0).fit(data.rows) for d in (1, 12)  # seen rows: deeper is better
    )
    one = deploy.retrain(churn, root, with_model(shallow, "shallow")).head()
    assert (one["deploy"], one["deployed"], one["version"], one["champion"]) == (True, True, 1, None)
    two = deploy.retrain(churn, root, with_model(deep, "deep")).head()
    assert two["deployed"] and two["version"] == 2 and two["challenger_auc"] > two["champion_auc"]
    worse = deploy.retrain(churn, root, with_model(shallow, "shallow")).head()
    assert (worse["deploy"], worse["deployed"], worse["version"], worse["champion"]) == (False, False, 2, "deep")

    held = deploy.Deployments(spark, root)
    read = held.current()
    assert held.load().name == "deep"
    assert held.move(bundle, read) and not held.move(bundle, read)  # the second run had read what is gone
    assert held.current().version == 3

    def dies(_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        deploy.retrain(churn, root, dies)
    assert deploy.Deployments(spark, root).current() == held.current()


def test_request_schema_has_all_example_fields():
    assert sorted(EXAMPLE) == sorted(REQUEST.names)
