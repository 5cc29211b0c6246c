"""Sparse one-hot vectors: slots, rows, joins, and models on them."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskpanel.operators.encode import apply_one_hot, fit_one_hot
from riskpanel.operators.model import (feature_importance, fit_classifier, load_model, save_model,
                                       score)
from riskpanel.operators.sparse import apply_sparse, as_vectors, fit_categories
from riskpanel.plans.prepare import prepare_panel
from tests.test_prepare import small_flow  # noqa: F401  a fixture


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, ("b", "a", None, "10008.0")[i % 4], i % 3 if i % 5 else None) for i in range(60)]
    return spark.createDataFrame(data, "id int, c string, k int").repartition(3)


def vectors_of(encoded):
    return {r["id"]: (r["categories"]["size"], list(r["categories"]["indices"]),
                      list(r["categories"]["values"])) for r in encoded.collect()}


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_vectors_equal_columns(spark, rows, broadcast_bytes):
    fitted = fit_categories(rows, ["c", "k"])
    assert fitted.size == 6
    got = vectors_of(apply_sparse(rows, fitted, broadcast_bytes=broadcast_bytes))
    wide = apply_one_hot(apply_one_hot(rows, fit_one_hot(rows, "c")), fit_one_hot(rows, "k"))
    names = [r["name"] for r in fitted.names().orderBy("slot").collect()]
    assert names == wide.columns[1:]
    for r in wide.collect():
        slots = [i for i, n in enumerate(names) if r[n]]
        assert got[r["id"]] == (6, slots, [1.0] * len(slots))


def test_counts_unseen_and_clashes(spark, rows):
    fitted = fit_categories(rows, ["c"])
    assert {(r["code"], r["n"]) for r in fitted.table.collect()} == {
        ("a", 15), ("b", 15), ("10008", 15)}
    later = spark.createDataFrame([(1, "new"), (2, None)], "id int, c string")
    assert vectors_of(apply_sparse(later, fitted)) == {1: (3, [], []), 2: (3, [], [])}
    odd = spark.createDataFrame([(1, "a", 5, 6)], "id int, c string, slot0 int, `x.y` int")
    assert apply_sparse(odd, fitted).columns == ["id", "slot0", "x.y", "categories"]
    with pytest.raises(ValueError, match="already exist"):
        apply_sparse(odd, fitted, "SLOT0")
    with pytest.raises(ValueError):
        fit_categories(rows, ["absent"])
    with pytest.raises(ValueError):
        fit_categories(rows, [])


def test_empty_table(spark):
    none = spark.createDataFrame([], "id int, c string")
    fitted = fit_categories(none, ["c"])
    assert fitted.size == 0 and apply_sparse(none, fitted).count() == 0


def test_a_million_categories(spark):
    df = spark.range(1_000_000, numPartitions=4).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).alias("c"))
    fitted = fit_categories(df, ["c"])
    size = 666_666
    assert fitted.size == size
    found = apply_sparse(df, fitted, broadcast_bytes=0)
    assert len(found.columns) == 2
    row = found.agg(F.count("*").alias("n"), F.min(F.size("categories.indices")).alias("least"),
                    F.max(F.size("categories.indices")).alias("most"),
                    F.count_distinct(F.element_at("categories.indices", 1)).alias("slots"),
                    F.max(F.element_at("categories.indices", 1)).alias("last")).first()
    assert tuple(row) == (1_000_000, 1, 1, size, size - 1)


def test_wide_form_is_bounded(spark):
    df = spark.range(1_100).select(F.col("id").alias("c"))
    with pytest.raises(ValueError, match="more than 1000"):
        fit_one_hot(df, "c")


def test_vectors_round_trip(spark, rows, folder):
    encoded = apply_sparse(rows, fit_categories(rows, ["c", "k"]))
    back = as_vectors(encoded, f"{folder}/vectors")
    dense = {r["id"]: r["v"] for r in back.select(
        "id", vector_to_array("categories").alias("v")).collect()}
    for i, (size, slots, _) in vectors_of(encoded).items():
        assert np.flatnonzero(dense[i]).tolist() == slots and len(dense[i]) == size


@pytest.fixture(scope="module")
def labelled(spark):
    r = np.random.default_rng(3)
    data = []
    for i in range(300):
        c = "pqrs"[i % 4]
        x = float(r.normal()) if i % 7 else None
        data.append((i, x, c, int((c == "q") != (r.random() < 0.05))))
    return spark.createDataFrame(data, "id int, x double, c string, Y int")


PARAMS = {"num_leaves": 4, "n_estimators": 3, "min_child_samples": 1}


def test_model_on_vectors_equals_model_on_columns(spark, labelled, folder):
    wide = apply_one_hot(labelled, fit_one_hot(labelled, "c"))
    sparse = as_vectors(apply_sparse(labelled, fit_categories(labelled, ["c"])))
    models = [fit_classifier(df.drop("id"), PARAMS) for df in (wide, sparse)]
    scores = [{r["id"]: r["score"] for r in score(m, df).collect()}
              for m, df in zip(models, (wide, sparse))]
    assert scores[0] == pytest.approx(scores[1])
    columns, vector = ({r["feature"]: r["importance"] for r in feature_importance(m).collect()}
                       for m in models)
    assert vector["categories"] == sum(n for f, n in columns.items() if f.startswith("c_")) > 0
    assert vector["x"] == columns["x"]
    gains = [{r["feature"]: r["importance"] for r in feature_importance(m, "gain").collect()}
             for m in models]
    assert gains[1]["categories"] == pytest.approx(
        sum(n for f, n in gains[0].items() if f.startswith("c_")))
    save_model(models[1], f"{folder}/model")
    again = load_model(spark, f"{folder}/model")
    assert again.inputs.widths == models[1].inputs.widths
    assert {r["id"]: r["score"] for r in score(again, sparse).collect()} == scores[1]


def test_prepare_with_a_vector(small_flow):  # noqa: F811
    panel, prices = small_flow
    columns, _ = prepare_panel(panel, prices, symbol="OIL", cutoff="2000-02-04")
    vector, fitted = prepare_panel(panel, prices, symbol="OIL", cutoff="2000-02-04",
                                   encoding="vector")
    assert vector.columns == ["CompNo", "Company_name", "Date", "a", "b", "Y",
                              "INDUSTRY2_categories", "Close", "Return"]
    shared = ["Date", "a", "b", "Y", "Close", "Return"]
    assert (sorted(map(tuple, columns.select(*shared).collect()), key=repr)
            == sorted(map(tuple, vector.select(*shared).collect()), key=repr))
    by_slot = vector.select(F.explode("INDUSTRY2_categories.indices").alias("s")).groupBy("s").count()
    names = {r["slot"]: r["name"] for r in fitted.one_hot.names().collect()}
    assert {names[r["s"]]: r["count"] for r in by_slot.collect()} == {
        n: columns.agg(F.count_if(n)).first()[0] for n in names.values()}
    with pytest.raises(ValueError, match="encoding"):
        prepare_panel(panel, prices, symbol="OIL", encoding="rows")
