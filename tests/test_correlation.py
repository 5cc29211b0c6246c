"""Correlations of wide, gappy and awkward tables, and ranks, against numpy and pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskpanel.operators.correlation import correlation_matrix
from riskpanel.operators.gram import PairSums, Scale, _sum_rows
from riskpanel.operators.row_ranks import average_ranks, rank_correlation


def table(spark, values, names=None, parts=3):
    names = names or [f"c{i}" for i in range(values.shape[1])]
    rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in values]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts)


def found(df, columns=None):
    return {(r["col_x"], r["col_y"]): r["corr"] for r in correlation_matrix(df, columns).collect()}


def test_two_hundred_columns_with_gaps(spark):
    r = np.random.default_rng(1)
    values = r.normal(size=(400, 200)) @ r.normal(size=(200, 200)) + 50
    values[r.random(values.shape) < 0.15] = np.nan
    got = found(table(spark, values))
    wanted = np.array(pd.DataFrame(values).corr())
    assert len(got) == 200 * 200
    have = np.array([[got[f"c{i}", f"c{j}"] for j in range(200)] for i in range(200)])
    assert np.allclose(have, wanted, atol=1e-9)
    assert (have == have.T).all()


def test_rows_that_leave_the_tasks_do_not_follow_the_input(spark):
    sizes = []
    for rows in (300, 6000):
        df = table(spark, np.random.default_rng(2).normal(size=(rows, 5)), parts=4)
        scales = [Scale(0.0, 1.0)] * 5
        sizes.append(df.mapInArrow(_sum_rows(scales, 2), "i int, lot int, sums binary").count())
    assert sizes == [20, 20]


def test_constant_only_where_the_other_is_present(spark):
    a = [5.0, 5.0, 5.0, 1.0, 2.0, 9.0]
    b = [1.0, 2.0, 4.0, np.nan, np.nan, np.nan]
    c = [0.0, np.nan, np.nan, np.nan, np.nan, 3.0]
    got = found(table(spark, np.array([a, b, c]).T, ["a", "b", "c"]))
    assert got["a", "b"] is None and got["b", "a"] is None  # a is 5 wherever b is
    assert got["b", "c"] is None  # one row
    assert got["a", "c"] == pytest.approx(1.0)
    assert got["a", "a"] == got["b", "b"] == 1.0


def test_pairs_far_from_their_columns_mean(spark):
    # without the one row where b is missing, a varies by 1 around 10^9
    r = np.random.default_rng(3)
    b = r.normal(size=500)
    a = 1e9 + b + r.normal(size=500)
    values = np.vstack([np.column_stack([a, b]), [[-1e15, np.nan]]])
    got = found(table(spark, values, ["a", "b"]))
    assert got["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-6)


@pytest.mark.parametrize("factor", [1e200, 1e-200, -3.0, 1e305])
def test_any_scale(spark, factor):
    x = np.random.default_rng(4).normal(size=200)
    y = x + np.random.default_rng(5).normal(size=200)
    got = found(table(spark, np.column_stack([x * factor, y]), ["x", "y"]))
    assert got["x", "y"] == pytest.approx(math.copysign(np.corrcoef(x, y)[0, 1], factor), abs=1e-9)


def test_infinite_values_have_no_correlation_where_they_count(spark):
    values = np.array([[1, 2, 3, np.inf], [2, 1, 5, np.nan], [1, 5, 2, 7.0]]).T
    got = found(table(spark, values, ["a", "b", "c"]))
    assert got["a", "c"] is None and got["a", "a"] is None
    # the infinite row has no b
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 5])[0, 1])
    assert got["b", "c"] is not None


def test_empty_and_small_tables(spark):
    empty = spark.createDataFrame([], "a double, b int")
    assert set(found(empty).items()) == {((x, y), None) for x in "ab" for y in "ab"}
    assert found(spark.createDataFrame([("x",)], "t string")) == {}
    one = spark.createDataFrame([(1.0, 2)], "a double, b int")
    assert set(found(one).values()) == {None}
    alone = spark.createDataFrame([(1,), (2,), (None,)], "`odd.name x` int")
    assert found(alone) == {("odd.name x", "odd.name x"): 1.0}


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 4))
def test_sums_merge_like_one_table(seed, parts):
    r = np.random.default_rng(seed)
    values = r.normal(size=(40, 4)) * 10.0 ** r.integers(-3, 4)
    values[r.random(values.shape) < 0.3] = np.nan
    scales = [Scale(float(np.nanmean(values[:, i])) if (~np.isnan(values[:, i])).any() else 0.0, 2.0)
              for i in range(4)]
    whole, pieces = PairSums(scales), [PairSums(scales) for _ in range(parts)]
    whole.add(values)
    for i, piece in enumerate(pieces):
        piece.add(values[i::parts])
    assert np.allclose(sum(p.rows() for p in pieces), whole.rows())


@pytest.mark.parametrize("small_values", [0, 10 ** 6])
def test_average_ranks_equal_pandas(spark, small_values):
    r = np.random.default_rng(6)
    n = 400
    pdf = pd.DataFrame({
        "key": np.arange(n), "few": r.choice([0.0, -0.0, 1.0, 7.0], n, p=[.2, .2, .5, .1]),
        "many": r.normal(size=n), "gap": np.where(r.random(n) < .4, np.nan, r.integers(0, 9, n)),
        "big": r.choice([np.inf, -np.inf, 0, 1e300], n), "none": np.nan})
    names = ["few", "many", "gap", "big", "none"]
    df = spark.createDataFrame(pdf).repartition(5)
    got = average_ranks(df, names, small_values).orderBy("key").toPandas()
    assert list(got.columns) == ["key", *names]
    pd.testing.assert_frame_equal(got[names], pdf[names].rank().astype(float), check_dtype=False)


def test_rank_correlation(spark):
    r = np.random.default_rng(7)
    x = r.normal(size=300)
    pdf = pd.DataFrame({"x": x, "curve": np.exp(x), "y": np.round(x + r.normal(size=300))})
    got = {(r["col_x"], r["col_y"]): r["corr"]
           for r in rank_correlation(spark.createDataFrame(pdf)).collect()}
    wanted = pdf.corr(method="spearman")
    assert got["x", "curve"] == pytest.approx(1.0)
    assert got["x", "y"] == pytest.approx(wanted.loc["x", "y"])
    rounded = rank_correlation(spark.createDataFrame(pdf), ["x", "y"], digits=1).collect()
    assert {r["corr"] for r in rounded} == {1.0, round(wanted.loc["x", "y"], 1)}


def test_repeated_rows_and_no_columns(spark):
    df = spark.createDataFrame([(1.0, "a")] * 3 + [(2.0, "b")], "v double, t string")
    got = sorted(tuple(r) for r in average_ranks(df).collect())
    assert got == [(2.0, "a"), (2.0, "a"), (2.0, "a"), (4.0, "b")]
    text = df.select("t")
    assert average_ranks(text).count() == 4


def test_no_row_is_expanded_by_pairs(spark):
    df = spark.range(10).select(*[(F.col("id") * i).cast("double").alias(f"c{i}")
                                  for i in range(6)])
    plan = correlation_matrix(df)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
