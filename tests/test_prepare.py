"""Filtering, encoding, winsorizing, scaling and the preparation flow."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskpanel.operators.describe import date_range
from riskpanel.operators.encode import OneHot, apply_one_hot, fit_one_hot
from riskpanel.operators.rows import (after_cutoff, drop_columns, feature_columns, hard_class,
                                      keep_columns, numeric_only, split_frames, with_split)
from riskpanel.operators.scale import apply_min_max, fit_min_max
from riskpanel.operators.winsor import apply_winsor, fit_caps_and_bounds, fit_winsor
from riskpanel.plans.prepare import prepare_panel


@pytest.fixture(scope="module")
def ten_days(spark):
    rng = np.random.default_rng(11)
    return spark.createDataFrame(pd.DataFrame({
        "Date": pd.date_range("2020-01-01", "2020-01-10"),
        "A": rng.integers(0, 100, 10),
        "B": ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(10)],
        "Y": rng.integers(0, 2, 10)}))


def days(rows):
    return sorted(str(r["Date"])[:10] for r in rows)


def test_cutoff_is_strict_and_drops_missing_dates(spark, ten_days):
    kept = after_cutoff(ten_days, "2020-1-5").collect()
    assert days(kept) == [f"2020-01-{d:02d}" for d in range(6, 11)]
    dated = spark.sql("SELECT * FROM VALUES (DATE'2020-01-05'), (DATE'2020-01-06'), (NULL) t(Date)")
    assert after_cutoff(dated, "2020-1-5").count() == 1
    text = dated.select(F.col("Date").cast("string").alias("Date"))
    assert after_cutoff(text, "2020-1-5").count() == 1
    ntz = dated.select(F.col("Date").cast("timestamp_ntz").alias("Date"))
    assert after_cutoff(ntz, "2020-1-5").count() == 1


def test_bad_cutoff(ten_days):
    with pytest.raises(ValueError):
        after_cutoff(ten_days, "soon")


def test_one_hot_has_one_column_per_category(ten_days):
    categories = sorted({r["B"] for r in ten_days.collect()})
    encoded = apply_one_hot(ten_days, fit_one_hot(ten_days, "B"))
    assert encoded.columns == ["Date", "A", "Y"] + [f"B_{c}" for c in categories]
    flags = [[r[f"B_{c}"] for c in categories] for r in encoded.collect()]
    assert all(sum(row) == 1 for row in flags)


def test_one_hot_null_unseen_and_float_codes(spark):
    df = spark.createDataFrame([(1, "10008.0"), (2, None), (3, "a.b"), (4, "10.05")],
                               "id int, c string")
    fitted = fit_one_hot(df, "c")
    assert fitted.categories == ("10.05", "10008", "a.b")
    rows = {r["id"]: r for r in apply_one_hot(df, fitted).collect()}
    assert rows[1]["c_10008"] and not rows[1]["c_a.b"]
    assert not any(rows[2][n] for n in fitted.names())
    later = spark.createDataFrame([(9, "new")], "id int, c string")
    assert not any(apply_one_hot(later, fitted).first()[n] for n in fitted.names())


def test_one_hot_refuses_identifiers_and_collisions(spark, ten_days):
    with pytest.raises(ValueError, match="more than 3"):
        fit_one_hot(ten_days, "B", max_categories=3)
    with pytest.raises(ValueError, match="already exist"):
        apply_one_hot(spark.createDataFrame([("x", 1)], "c string, c_x int"), OneHot("c", ("x",)))


def winsorized(values, lower=0.05, upper=0.05):
    """The public algorithm on a sorted index: missing values sort last."""
    x = np.array([np.nan if v is None else v for v in values], dtype=float)
    order = np.argsort(x, kind="stable")
    n, low, high = len(x), int(lower * len(x)), int(upper * len(x))
    out = x.copy()
    if low:
        out[order[:low]] = x[order[low]]
    if high:
        out[order[n - high:]] = x[order[n - high - 1]]
    return [None if np.isnan(v) else v for v in out]


@pytest.mark.parametrize("seed", range(6))
def test_winsorize_equals_the_sorted_algorithm(spark, seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(15, 150))
    columns = {}
    for name, gap in (("none", 0.0), ("few", 0.03), ("many", 0.2), ("sparse", 0.97)):
        x = np.round(rng.normal(size=n), 1)
        columns[name] = [None if rng.random() < gap else float(v) for v in x]
    rows = [(i, *values) for i, values in enumerate(zip(*columns.values()))]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in columns))
    capped = apply_winsor(df, fit_winsor(df, list(columns), gather_rows=5)).orderBy("id").collect()
    for c, values in columns.items():
        expected = winsorized(values)
        if sum(v is not None for v in values) <= int(0.05 * n):
            expected = [None] * n  # the lower cap itself is missing
        assert [r[c] for r in capped] == expected, c


def hundred(spark, nulls):
    rows = [(float(i) if i <= 100 - nulls else None,) for i in range(1, 101)]
    return spark.createDataFrame(rows, "x double")


def test_winsorize_known_cases(spark):
    def result(nulls, **options):
        df = hundred(spark, nulls)
        return [r["x"] for r in apply_winsor(df, fit_winsor(df, **options)).collect()]

    clean = result(0)
    assert (min(clean), max(clean)) == (6.0, 95.0)
    few = result(3)
    assert None not in few and max(few) == 95.0 and few.count(95.0) == 6
    many = result(8)
    assert many.count(None) == 8 and max(v for v in many if v is not None) == 92.0
    assert result(96) == [None] * 100
    ignored = result(8, null_policy="ignore")
    assert ignored.count(None) == 8
    assert (min(v for v in ignored if v), max(v for v in ignored if v)) == (5.0, 88.0)
    with pytest.raises(ValueError):
        result(0, null_policy="drop")


def test_winsorize_leaves_small_tables_labels_and_types(spark):
    df = spark.createDataFrame([(i, i % 2, i * 10) for i in range(19)], "a int, Y int, b bigint")
    caps = fit_winsor(df)
    assert [c.column for c in caps] == ["a", "b"]
    capped = apply_winsor(df, caps)
    assert capped.schema == df.schema
    assert sorted(capped.collect()) == sorted(df.collect())


def test_nan_counts_as_missing(spark):
    rows = [(float(i),) for i in range(1, 98)] + [(float("nan"),)] * 3
    df = spark.createDataFrame(rows, "x double")
    capped = apply_winsor(df, fit_winsor(df))
    assert capped.where("isnan(x) OR x IS NULL").count() == 0


@pytest.mark.parametrize("nulls", [0, 3, 8, 96])
def test_bounds_follow_from_caps(spark, nulls):
    df = hundred(spark, nulls)
    caps, bounds = fit_caps_and_bounds(df, ["x"])
    assert bounds == fit_min_max(apply_winsor(df, caps), ["x"])


def test_scale(spark, ten_days):
    df = spark.createDataFrame([(2.0, 7.0), (None, 7.0), (4.0, 7.0), (10.0, None)],
                               "x double, k double")
    rows = apply_min_max(df, fit_min_max(df)).collect()
    assert [r["x"] for r in rows] == [0.0, None, 0.25, 1.0]
    assert [r["k"] for r in rows] == [0.0, 0.0, 0.0, None]
    values = [r["A"] for r in ten_days.collect()]
    scaled = apply_min_max(ten_days, fit_min_max(ten_days))
    expected = [(v - min(values)) / (max(values) - min(values)) for v in values]
    assert [r["A"] for r in scaled.collect()] == pytest.approx(expected)
    assert scaled.schema["Y"].dataType.typeName() == "long"


def test_scale_of_missing_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert [r["x"] for r in apply_min_max(df, fit_min_max(df)).collect()] == [None, None]


def test_date_range(ten_days):
    assert tuple(date_range(ten_days).first()) == ("2019-12-31", "2020-01-11")


def test_split(spark, ten_days):
    labelled = with_split(ten_days, "2020-01-04", "2020-01-07")
    train, val, test = split_frames(labelled)
    assert (train.count(), val.count(), test.count()) == (3, 3, 4)
    undated = spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS Date")
    assert with_split(undated, "2020-1-4", "2020-1-7").first()["indicator"] == "test"


def test_column_selection(spark):
    df = spark.createDataFrame([(1, "c", "n", "train", 0)],
                               "A int, Company_name string, CompNo string, indicator string, Y int")
    df = df.withColumn("Date", F.current_date())
    assert drop_columns(df).columns == ["A", "Y"]
    with pytest.raises(ValueError, match="not found"):
        drop_columns(df.drop("CompNo"))
    assert keep_columns(df, ["Y", "gone", "A"]).columns == ["Y", "A"]
    assert numeric_only(df).columns == ["A", "Y"]
    assert feature_columns(drop_columns(df)) == ["A"]
    probabilities = spark.createDataFrame([(0.5,), (0.51,)], "p double")
    assert [r[0] for r in probabilities.select(hard_class(F.col("p"))).collect()] == [0, 1]


@pytest.fixture(scope="module")
def small_flow(spark):
    first = dt.datetime(2000, 1, 31)
    rows = [(str(i % 5), f"firm {i % 5}", first + dt.timedelta(days=i),
             float(i) if i % 30 else None, 10.0 * (i % 7), ("10008.0", "10013.0", None)[i % 3],
             int(i % 4 == 0)) for i in range(60)]
    panel = spark.createDataFrame(
        rows, "CompNo string, Company_name string, Date timestamp_ntz, a double, b double, "
              "INDUSTRY2 string, Y int")
    prices = spark.createDataFrame(
        [("OIL", dt.date(2000, 1, 30) + dt.timedelta(days=i), 20.0 + i) for i in range(0, 60, 3)],
        "symbol string, Date date, Close double")
    return panel, prices


def test_prepare_flow(spark, small_flow, folder):
    panel, prices = small_flow
    prepared, fitted = prepare_panel(panel, prices, symbol="OIL", cutoff="2000-02-04",
                                     summary_path=f"{folder}/summary")
    assert prepared.columns == ["CompNo", "Company_name", "Date", "a", "b", "Y",
                                "INDUSTRY2_10008", "INDUSTRY2_10013", "Close", "Return"]
    rows = prepared.orderBy("Date").collect()
    assert len(rows) == 55
    assert all(0.0 <= r["a"] <= 1.0 for r in rows)  # the few missing values were filled
    assert (fitted.start, fitted.end) == ("2000-02-04", "2000-03-31")
    # the series is read from the first date on: its first close has no change yet
    assert [(r["Close"], r["Return"]) for r in rows[:3]] == [(26.0, None), (26.0, 0.0), (26.0, 0.0)]
    assert rows[3]["Return"] == pytest.approx(29.0 / 26.0 - 1)
    summary = spark.read.option("header", True).csv(f"{folder}/summary").collect()
    assert [r["statistic"] for r in summary] == ["count", "mean", "min", "25%", "50%", "75%",
                                                 "max", "std"]
    assert summary[0].asDict() == {"statistic": "count", "a": "55", "b": "55", "Date": "55"}


def test_prepare_fitted_on_train_only(small_flow):
    panel, prices = small_flow
    prepared, fitted = prepare_panel(panel, prices, symbol="OIL", cutoff="2000-02-04",
                                     fit_on="train", val_start="2000-03-01",
                                     test_start="2000-03-10")
    train_high = [b.high for b in fitted.bounds if b.column == "a"][0]
    assert train_high == 28.0  # 25 training rows: one capped at each end
    assert prepared.count() == 55
    with pytest.raises(ValueError):
        prepare_panel(panel, prices, fit_on="val")


def test_one_hot_names_differ_by_more_than_case(spark):
    df = spark.createDataFrame([("Tech",), ("tech",), ("TECH",), ("tech_2",)], "c string")
    fitted = fit_one_hot(df, "c")
    names = fitted.names()
    assert len({n.lower() for n in names}) == 4
    out = apply_one_hot(df, fitted)
    assert all(out.agg(F.count_if(n)).first()[0] == 1 for n in names)
