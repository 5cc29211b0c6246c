"""Training, scoring, importance and the parameter search."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskpanel.operators import tuning
from riskpanel.operators.metrics import evaluate
from riskpanel.operators.model import (feature_importance, fit_classifier, fit_inputs, load_model,
                                       save_model, score, spark_params)
from riskpanel.operators.tuning import (DEFAULT_SPACE, FULL_SPACE, Range, Study, best_trial,
                                        draw_params, grid_params)
from riskpanel.plans.modelling import model_panel
from riskpanel.sources.trials import read_trials

PARAMS = {"num_leaves": 8, "max_depth": 4, "learning_rate": 0.2, "n_estimators": 4}
SPACE = {"num_leaves": Range(2, 8, whole=True), "learning_rate": Range(0.05, 0.2),
         "n_estimators": Range(2, 3, whole=True)}


def learnable(n=600, seed=0):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = ((a + 0.3 * rng.normal(size=n) > 0.5)).astype(int)
    a[rng.random(n) < 0.1] = np.nan
    return pd.DataFrame({
        "Date": pd.date_range("2020-01-01", periods=n, freq="D"), "CompNo": "1",
        "Company_name": "firm", "a": a, "b": b, "flag": rng.random(n) < 0.5,
        "empty": np.full(n, np.nan), "Y": y})


@pytest.fixture(scope="module")
def panel(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "panel")
    df = spark.createDataFrame(learnable())
    (df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in ("a", "b", "empty")
                 else F.col(c) for c in df.columns]).repartition(4).write.parquet(path))
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def features(panel):
    return panel.select("a", "b", "flag", "empty", "Y")


@pytest.fixture(scope="module")
def model(features):
    return fit_classifier(features, PARAMS)


def test_scores_find_the_signal(model, features):
    scored = score(model, features)
    assert scored.columns == [*features.columns, "score", "prediction"]
    bounds = scored.agg(F.min("score"), F.max("score"), F.count("score")).first()
    assert 0 <= bounds[0] < bounds[1] <= 1 and bounds[2] == 600
    assert scored.where((F.col("score") > 0.5).cast("int") != F.col("prediction")).count() == 0
    assert evaluate(scored).first()["roc_auc"] > 0.9


def test_inputs_fill_and_flag(spark, features):
    inputs = fit_inputs(features, ["a", "b", "flag", "empty"])
    assert inputs.parents == ("a", "a", "b", "flag", "empty", "empty")
    median = features.agg(F.median("a")).first()[0]
    row = spark.createDataFrame([(None, 2.0, True, None)],
                                "a double, b double, flag boolean, empty double")
    assert list(inputs.transform(row).first()["__features"]) == pytest.approx(
        [median, 1.0, 2.0, 1.0, 0.0, 1.0])
    with pytest.raises(ValueError, match="not numeric"):
        fit_inputs(spark.createDataFrame([("x",)], "c string"), ["c"])


def test_importance_counts_splits(spark, model, features, folder):
    counts = feature_importance(model, path=f"{folder}/trees").collect()
    assert [r["feature"] for r in counts][0] == "a"
    assert {r["feature"] for r in counts} == {"a", "b", "flag", "empty"}
    amounts = [r["importance"] for r in counts]
    assert amounts == sorted(amounts, reverse=True) and amounts[-1] == 0
    upwards = feature_importance(model, path=f"{folder}/trees", ascending=True).collect()
    assert [r["importance"] for r in upwards] == amounts[::-1]
    nodes = sum(t.numNodes - (t.numNodes + 1) // 2 for t in model.trees.trees)
    assert sum(amounts) == nodes  # a binary tree of n nodes has (n - 1) / 2 splits
    gains = feature_importance(model, "gain").collect()
    assert sum(r["importance"] for r in gains) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        feature_importance(model, "cover")


def test_saved_model_scores_the_same(spark, model, features, folder):
    save_model(model, f"{folder}/model")
    again = load_model(spark, f"{folder}/model")
    assert again.inputs.features == model.inputs.features
    left = [r["score"] for r in score(model, features).collect()]
    assert left == [r["score"] for r in score(again, features).collect()]


def test_parameter_map():
    assert spark_params({"num_leaves": 9, "max_depth": 8, "learning_rate": 0.1,
                         "bagging_fraction": 0.7, "feature_fraction": 0.685,
                         "min_child_samples": 157, "min_split_gain": 0.04, "n_estimators": 148,
                         "lambda_l1": 8.0, "lambda_l2": 4.0, "bagging_freq": 4}) == {
        "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.7, "minInstancesPerNode": 157,
        "featureSubsetStrategy": "0.685000", "minInfoGain": 0.04, "maxIter": 148}
    assert spark_params({"max_depth": -1, "num_leaves": 64})["maxDepth"] == 6
    assert spark_params({"max_depth": 3, "num_leaves": 64})["maxDepth"] == 3
    assert spark_params({"num_leaves": 2})["maxDepth"] == 1
    assert spark_params({})["maxDepth"] == 5


def test_draws_depend_on_seed_and_trial_only():
    assert draw_params(DEFAULT_SPACE, 7, 42) == draw_params(DEFAULT_SPACE, 7, 42)
    assert draw_params(DEFAULT_SPACE, 7, 42) != draw_params(DEFAULT_SPACE, 8, 42)
    for trial in range(200):
        for name, value in draw_params(FULL_SPACE, trial).items():
            assert FULL_SPACE[name].low <= value <= FULL_SPACE[name].high
    assert isinstance(Range(1, 3, whole=True).draw(random.Random(0)), int)
    grid = {tuple(grid_params(SPACE, t, 2).values()) for t in range(8)}
    assert len(grid) == 8


def halves(panel):
    rows = panel.select("Date", "a", "b", "Y")
    return (rows.where("Date < '2021-01-01'").drop("Date"),
            rows.where("Date >= '2021-01-01'").drop("Date"))


def test_study_records_and_resumes(spark, panel, folder, monkeypatch):
    train, val = halves(panel)
    first = Study(train, val, space=SPACE, trials_path=folder).run(2, parallelism=2)
    stored = read_trials(spark, folder, "boosted-trees")
    assert sorted(r["trial_id"] for r in stored.collect()) == [0, 1]
    assert load_model(spark, stored.first()["model_path"]).inputs.features == ("a", "b")
    ratio = first.first()["params"]["scale_pos_weight"]
    counts = train.agg(F.count_if(F.col("Y") == 0), F.count_if(F.col("Y") == 1)).first()
    assert ratio == counts[0] / counts[1]

    fitted = []
    original = tuning.fit_trees
    monkeypatch.setattr(tuning, "fit_trees", lambda *a: fitted.append(1) or original(*a))
    more = Study(train, val, space=SPACE, trials_path=folder).run(3)
    assert len(fitted) == 1
    kept = {r["trial_id"]: r["metric"] for r in more.collect()}
    assert {t: kept[t] for t in (0, 1)} == {r["trial_id"]: r["metric"] for r in first.collect()}
    best = best_trial(more).first()
    assert best["metric"] == max(kept.values())
    # other rows are another study: nothing is taken over
    Study(train.limit(300), val, space=SPACE, trials_path=folder).run(1)
    assert len(fitted) == 2
    assert read_trials(spark, folder).select("study").distinct().count() == 2


def test_study_retries_and_gives_up(panel, monkeypatch):
    train, val = halves(panel)
    calls = []
    original = tuning.fit_trees

    def flaky(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return original(*args)

    monkeypatch.setattr(tuning, "fit_trees", flaky)
    trials = Study(train, val, space=SPACE).run(2, delay=0)
    assert trials.count() == 2 and len(calls) == 3  # the finished trial was kept

    def broken(*args):
        raise RuntimeError("always")

    monkeypatch.setattr(tuning, "fit_trees", broken)
    with pytest.raises(RuntimeError, match="after 3 attempts"):
        Study(train, val, space=SPACE).run(1, delay=0)


def test_model_panel(spark, panel, folder):
    stale = panel.withColumn("indicator", F.lit("train"))
    done = model_panel(stale, dt.date(2021, 1, 1), "2021-05-01", n_trials=2, space=SPACE,
                       output=folder)
    values = {(r["indicator"], r["metric"]): r["value"] for r in done.metrics.collect()}
    assert set(values) == {(s, m) for s in ("val", "test")
                           for m in ("accuracy", "f1", "pr_auc", "roc_auc")}
    assert values[("test", "roc_auc")] > 0.8
    assert {r["feature"] for r in done.importance.collect()} == {"a", "b", "flag", "empty"}
    test_rows = panel.where("Date >= '2021-05-01'").count()
    assert done.confusion.agg(F.sum("n")).first()[0] == test_rows
    assert load_model(spark, f"{folder}/model").inputs.features == ("a", "b", "flag", "empty")
    assert read_trials(spark, f"{folder}/study").count() == 2


def test_feature_names_may_hold_dots(spark, folder):
    df = spark.createDataFrame([(i % 2 == 0, float(i), i % 2) for i in range(40)],
                               "`code_10.05` boolean, `x.y` double, Y int")
    model = fit_classifier(df, {"num_leaves": 2, "n_estimators": 1, "min_child_samples": 1})
    save_model(model, folder)
    scored = score(load_model(spark, folder), df)
    assert scored.where("prediction <> Y").count() == 0
    used = {r["feature"]: r["importance"] for r in feature_importance(model).collect()}
    assert used == {"code_10.05": 1, "x.y": 0}


def test_another_space_or_other_rows_are_another_study(spark, folder):
    rows = spark.createDataFrame([(float(i), i % 2) for i in range(8)], "a double, Y int")

    def name(train=rows, **options):
        study = Study(train, rows, trials_path=folder, **options)
        return study._identity()

    narrow, wide = {"num_leaves": Range(2, 4, whole=True)}, {"num_leaves": Range(2, 9, whole=True)}
    twice = rows.unionByName(rows)
    shifted = rows.selectExpr("a + 1 as a", "Y")
    assert len({name(space=narrow), name(space=wide), name(twice, space=narrow),
                name(shifted.unionByName(shifted), space=narrow), name(space=narrow, seed=1)}) == 5
    assert name(space=narrow) == name(space=narrow)
