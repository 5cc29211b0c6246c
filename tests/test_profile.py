"""Profile sections and correlation on small tables against pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskpanel.operators import frequent, profile
from riskpanel.operators.correlation import correlation_matrix


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(4)
    n = 300
    x = rng.normal(size=n)
    return pd.DataFrame({
        "x": x, "twice": 2 * x + 1, "gap": np.where(rng.random(n) < 0.2, np.nan, x + rng.random(n)),
        "zero": np.where(rng.random(n) < 0.5, 0.0, -rng.random(n)), "same": np.full(n, 0.1),
        "c": rng.choice(["p", "q", "rr"], n, p=[0.95, 0.03, 0.02])})


@pytest.fixture(scope="module")
def df(spark, pdf):
    raw = spark.createDataFrame(pdf)
    return raw.withColumn("gap", F.when(~F.isnan("gap"), F.col("gap")))


NUMBERS = ["x", "twice", "gap", "zero", "same"]


def test_correlation_equals_pandas(df, pdf):
    expected = pdf[NUMBERS].corr()
    for r in correlation_matrix(df, NUMBERS).collect():
        wanted = expected.loc[r["col_x"], r["col_y"]]
        if "same" in (r["col_x"], r["col_y"]):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(wanted)
            assert abs(r["corr"]) <= 1.0
    assert correlation_matrix(df, NUMBERS).count() == 25


def test_correlation_rounds_half_to_even(spark):
    # the correlation of these is exactly 0.125 in theory; rounding is checked on a literal
    one = spark.range(1).select(F.bround(F.lit(0.125), 2).alias("r")).first()["r"]
    assert one == 0.12


def test_numeric_summary(df, pdf):
    rows = {r["column"]: r for r in profile.numeric_summary(df).collect()}
    for c in NUMBERS:
        s = pdf[c]
        assert rows[c]["n"] == s.count() and rows[c]["n_missing"] == s.isna().sum()
        assert rows[c]["n_distinct"] == s.nunique()
        assert rows[c]["n_zeros"] == (s == 0).sum() and rows[c]["n_negative"] == (s < 0).sum()
        assert rows[c]["mean"] == pytest.approx(s.mean())
        assert rows[c]["std"] == pytest.approx(s.std(), abs=1e-12)
    centred = pdf["x"] - pdf["x"].mean()
    skew = (centred ** 3).mean() / (centred ** 2).mean() ** 1.5
    kurtosis = (centred ** 4).mean() / (centred ** 2).mean() ** 2 - 3
    assert rows["x"]["skewness"] == pytest.approx(skew)
    assert rows["x"]["kurtosis"] == pytest.approx(kurtosis)
    near = {r["column"]: r for r in profile.numeric_summary(df, exact_distinct=False).collect()}
    assert near["x"]["n_distinct"] == pytest.approx(300, rel=0.15)


def test_quantiles(df, pdf):
    rows = {r["column"]: r for r in profile.quantiles(df, gather_rows=20).collect()}
    for c in NUMBERS:
        s = pdf[c].dropna()
        expected = [*s.quantile([0.05, 0.25, 0.5, 0.75, 0.95]), s.max() - s.min(),
                    s.quantile(0.75) - s.quantile(0.25), (s - s.median()).abs().median()]
        assert list(rows[c])[1:] == pytest.approx(expected)


def test_histogram_leaves_missing_values_out(df, pdf):
    rows = profile.histogram(df, NUMBERS, 7).collect()
    for c in ("x", "gap", "zero"):
        counts = [r["n"] for r in sorted(rows, key=lambda r: r["bin"]) if r["column"] == c]
        assert counts == list(np.histogram(pdf[c].dropna(), 7)[0])
    assert sum(r["n"] for r in rows if r["column"] == "same") == len(pdf)


def test_texts(df, pdf):
    top = profile.top_values(df, k=2).collect()
    counts = pdf["c"].value_counts()
    assert {(r["value"], r["n"]) for r in top} == set(counts.head(2).items())
    row = profile.text_summary(df).first()
    assert (row["mode"], row["mode_count"], row["n_distinct"]) == ("p", counts["p"], 3)
    assert (row["min_length"], row["max_length"]) == (1, 2)
    assert row["mean_length"] == pytest.approx(pdf["c"].str.len().mean())


def test_text_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert profile.text_summary(df).first()["mode"] == "a"
    assert [r["value"] for r in profile.top_values(df, k=1).collect()] == ["a"]


def test_top_values_limit_before_the_last_shuffle(df):
    counted = frequent.stacked_texts(df, ["c"]).groupBy("slot", "value").agg(
        F.count("*").alias("n"))
    text = frequent._first(counted, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")
    assert "SinglePartition" not in text


def test_dates_missing_overview(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0, "a"), (dt.date(2020, 1, 5), None, None),
                                (None, float("nan"), "b")], "d date, x double, c string")
    row = profile.date_summary(df).first()
    assert (row["n"], row["n_missing"], row["days"]) == (2, 1, 4)
    assert row["last"] == dt.datetime(2020, 1, 5)
    missing = {r["column"]: r["n_missing"] for r in profile.missing_counts(df).collect()}
    assert missing == {"d": 1, "x": 2, "c": 1}
    total = profile.overview(df).first()
    assert (total["n_rows"], total["n_columns"], total["missing_cells"]) == (3, 3, 4)
    assert total["missing_share"] == pytest.approx(4 / 9)
    flags = {(r["col_x"], r["col_y"]): r["corr"]
             for r in profile.missing_correlation(df).collect()}
    assert flags[("x", "c")] == pytest.approx(0.5) and flags[("d", "x")] == pytest.approx(0.5)


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")],
                               "k int, v string")
    assert {tuple(r) for r in profile.duplicate_rows(df).collect()} == {(1, "a", 3), (2, None, 2)}
    assert tuple(profile.duplicate_rows(df, k=1).first()) == (1, "a", 3)
    assert tuple(profile.duplicate_summary(df).first()) == (2, 3)
    assert tuple(profile.duplicate_summary(df, ["k", "v"]).first()) == (2, 3)


@pytest.mark.parametrize("small_rows", [1_000_000, 200, 20])
def test_extremes(df, pdf, small_rows):
    rows = profile.extremes(df, ["x", "zero", "same"], 3, small_rows).collect()
    assert [(r["value"], r["n"]) for r in rows if r["column"] == "same"] == [(0.1, 300)] * 2
    for c in ("x", "zero"):
        ordered = sorted(pdf[c].unique())
        small = [r["value"] for r in sorted(rows, key=lambda r: r["position"])
                 if (r["column"], r["side"]) == (c, "smallest")]
        large = [r["value"] for r in sorted(rows, key=lambda r: r["position"])
                 if (r["column"], r["side"]) == (c, "largest")]
        assert small == pytest.approx(ordered[:3]) and large == pytest.approx(ordered[:-4:-1])
    zeros = [r["n"] for r in rows if r["column"] == "zero" and r["value"] == 0]
    assert zeros == [int((pdf["zero"] == 0).sum())]


def test_alerts(df):
    found = {(r["column"], r["alert"]) for r in profile.alerts(df).collect()}
    assert found == {("gap", "missing"), ("same", "constant"), ("x", "unique"), ("gap", "unique"),
                     ("twice", "unique"), ("zero", "zeros"), ("x", "high_correlation"),
                     ("twice", "high_correlation"), ("gap", "high_correlation"),
                     ("c", "imbalance")}


def test_first_rows(df):
    assert profile.first_rows(df, 4).count() == 4
