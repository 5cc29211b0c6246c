"""Metrics against their pairwise definitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskpanel.operators import metrics


def brute_average_precision(y, s):
    total, previous = 0.0, 0.0
    for cut in sorted(set(s), reverse=True):
        chosen = s >= cut
        recall = y[chosen].sum() / y.sum()
        total += (recall - previous) * y[chosen].mean()
        previous = recall
    return total


def brute_roc_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def brute_f1(y, p):
    scores = []
    for c in np.unique(np.concatenate([y, p])):
        hit = ((y == c) & (p == c)).sum()
        size = (y == c).sum() + (p == c).sum()
        scores.append((2 * hit / size if size else 0.0) * (y == c).sum())
    return sum(scores) / len(y)


def scored(seed, n=400, decimals=2):
    rng = np.random.default_rng(seed)
    s = np.round(rng.beta(0.5, 3, n), decimals)
    y = (rng.random(n) < 0.2 + 0.5 * s).astype(int)
    return pd.DataFrame({"Y": y, "score": s, "prediction": (s > 0.5).astype(int),
                         "g": rng.choice(["val", "test"], n, p=[0.3, 0.7])})


@pytest.mark.parametrize("seed,decimals", [(0, 1), (1, 2), (2, 9), (3, 2)])
@pytest.mark.parametrize("buckets", [None, 7])
def test_against_definitions(spark, seed, decimals, buckets):
    pdf = scored(seed, decimals=decimals)
    rows = {r["g"]: r for r in metrics.evaluate(spark.createDataFrame(pdf), by=("g",),
                                                buckets=buckets).collect()}
    assert set(rows) == {"val", "test"}
    for g, part in pdf.groupby("g"):
        y, s, p = (part[c].to_numpy() for c in ("Y", "score", "prediction"))
        assert rows[g]["accuracy"] == pytest.approx((y == p).mean())
        assert rows[g]["f1"] == pytest.approx(brute_f1(y, p))
        assert rows[g]["pr_auc"] == pytest.approx(brute_average_precision(y, s))
        assert rows[g]["roc_auc"] == pytest.approx(brute_roc_auc(y, s))


def test_sampled_boundaries_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame(scored(5, n=3_000, decimals=9))
    whole = metrics.evaluate(df, buckets=1).first()
    monkeypatch.setattr(metrics, "SAMPLE_ROWS", 100)
    monkeypatch.setattr(metrics, "ROWS_PER_BUCKET", 200)
    assert metrics.evaluate(df).first() == pytest.approx(whole)


def test_hot_score(spark):
    pdf = scored(6)
    pdf.loc[pdf.index % 3 != 0, "score"] = 0.25
    got = metrics.evaluate(spark.createDataFrame(pdf), buckets=5).first()
    y, s = pdf["Y"].to_numpy(), pdf["score"].to_numpy()
    assert got["pr_auc"] == pytest.approx(brute_average_precision(y, s))
    assert got["roc_auc"] == pytest.approx(brute_roc_auc(y, s))


def test_single_metrics_agree(spark):
    df = spark.createDataFrame(scored(7))
    together = metrics.evaluate(df).first()
    assert metrics.accuracy(df).first()[0] == pytest.approx(together["accuracy"])
    assert metrics.weighted_f1(df).first()[0] == pytest.approx(together["f1"])
    assert metrics.average_precision(df).first()[0] == pytest.approx(together["pr_auc"])
    assert metrics.roc_auc(df).first()[0] == pytest.approx(together["roc_auc"])
    long = {r["metric"]: r["value"] for r in metrics.evaluate_long(df).collect()}
    assert long == pytest.approx(together.asDict())


def test_one_class_and_null_group(spark):
    df = spark.createDataFrame([("a", 1, 0.9, 1), ("a", 1, 0.2, 0), (None, 0, 0.5, 0),
                                (None, 1, 0.7, 1)], "g string, Y int, score double, prediction int")
    rows = {r["g"]: r for r in metrics.evaluate(df, by=("g",), buckets=3).collect()}
    assert rows["a"]["roc_auc"] is None and rows["a"]["pr_auc"] == 1.0
    assert rows[None]["roc_auc"] == 1.0 and rows[None]["accuracy"] == 1.0
    negatives = metrics.evaluate(df.where("Y = 0")).first()
    assert negatives["pr_auc"] == 0.0 and negatives["roc_auc"] is None


def test_missing_scores_raise(spark):
    df = spark.createDataFrame([(1, None), (0, 0.5)], "Y int, score double")
    with pytest.raises(ValueError, match="label and a score"):
        metrics.roc_auc(df)


def test_multiclass_f1(spark):
    rng = np.random.default_rng(8)
    y, p = rng.integers(0, 4, 200), rng.integers(0, 5, 200)
    df = spark.createDataFrame(pd.DataFrame({"Y": y, "prediction": p}))
    assert metrics.weighted_f1(df).first()[0] == pytest.approx(brute_f1(y, p))


def test_confusion_matrix_is_zero_filled(spark):
    df = spark.createDataFrame([("v", 1, 1), ("v", 1, 1), ("v", 0, 1), ("t", 0, 0)],
                               "g string, Y int, prediction int")
    cells = {tuple(r)[:2]: r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 2}
    assert metrics.confusion_matrix(df, by=("g",)).where("g = 't'").agg(F.sum("n")).first()[0] == 1


def test_class_ratio(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (1,)], "Y int")
    assert tuple(metrics.class_ratio(df).first()) == (3, 2, 1.5)
    assert metrics.class_ratio(df.where("Y = 0")).first()["ratio"] is None


def test_grouped_scores_are_computed_once(spark, folder):
    spark.createDataFrame(scored(9)).write.parquet(f"{folder}/scored")
    result = metrics.evaluate(spark.read.parquet(f"{folder}/scored"), by=("g",), buckets=4)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    assert "SinglePartition" not in plan
