"""Price series: calendar, carried closes, returns and the join to the panel."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskpanel.functions.dates import check_range
from riskpanel.operators import attach as attach_module
from riskpanel.operators.attach import attach
from riskpanel.operators.series import DuplicateKeys, daily_returns, fill_calendar
from riskpanel.plans.prepare import price_flow
from riskpanel.sources.prices import price_series, read_prices


def d(day):
    return dt.date(2020, 1, day)


PRICES = [("A", d(3), 10.0), ("A", d(5), 0.0), ("A", d(6), 5.0), ("B", d(1), 2.0),
          ("B", d(4), 3.0)]


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame(PRICES, "symbol string, Date date, Close double")


def by_day(df, symbol, column):
    rows = df.where(F.col("symbol") == symbol).orderBy("Date").collect()
    return [r[column] for r in rows]


def test_calendar_has_every_day(prices):
    filled = fill_calendar(prices, "2020-1-1", "2020-1-8")
    assert by_day(filled, "A", "Date") == [d(i) for i in range(1, 9)]
    assert by_day(filled, "A", "Close") == [None, None, 10.0, None, 0.0, 5.0, None, None]
    assert by_day(filled, "B", "Close") == [2.0, None, None, 3.0, None, None, None, None]


def test_returns_on_carried_closes(prices):
    done = daily_returns(fill_calendar(prices, "2020-1-1", "2020-1-8"))
    assert by_day(done, "A", "Close") == [None, None, 10.0, 10.0, 0.0, 5.0, 5.0, 5.0]
    # the change from a close of zero has no value
    assert by_day(done, "A", "Return") == [None, None, None, 0.0, -1.0, None, 0.0, 0.0]
    assert by_day(done, "B", "Return") == [None, 0.0, 0.0, 0.5, 0.0, 0.0, 0.0, 0.0]


def test_only_the_close_is_carried(prices):
    more = prices.withColumn("Volume", F.lit(7))
    done = daily_returns(fill_calendar(more, "2020-1-1", "2020-1-8"))
    assert by_day(done, "B", "Volume") == [7, None, None, 7, None, None, None, None]


@pytest.mark.parametrize("seed", range(3))
def test_against_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    every = pd.date_range("2020-01-01", "2020-03-31")
    kept = every[rng.random(len(every)) < 0.6]
    close = rng.random(len(kept)) + 1
    close[rng.random(len(kept)) < 0.1] = np.nan
    pdf = pd.DataFrame({"symbol": "S", "Date": kept, "Close": close})
    expected = pd.DataFrame({"Date": every}).merge(pdf, on="Date", how="left")
    expected["Close"] = expected["Close"].ffill()
    expected["Return"] = expected["Close"] / expected["Close"].shift(1) - 1
    df = spark.createDataFrame(pdf).withColumn("Close", F.when(~F.isnan("Close"), F.col("Close")))
    got = (daily_returns(fill_calendar(df, "2020-01-01", "2020-03-31"))
           .orderBy("Date").toPandas())
    assert len(got) == len(every)
    for c in ("Close", "Return"):
        np.testing.assert_allclose(got[c].astype(float), expected[c], equal_nan=True)


def test_duplicate_days_raise(spark, prices):
    with pytest.raises(DuplicateKeys):
        fill_calendar(prices.union(prices), "2020-1-1", "2020-1-8")


def test_one_shuffle_for_calendar_and_returns(prices):
    plan = daily_returns(fill_calendar(prices, "2020-1-1", "2020-1-8", check_unique=False))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text and "SinglePartition" not in text


def test_series_end_is_exclusive_and_empty_is_an_error(spark, prices, folder):
    series = price_series(prices, "A", "2020-1-3", "2020-1-6")
    assert sorted(r["Date"] for r in series.collect()) == [d(3), d(5)]
    with pytest.raises(ValueError, match="no prices"):
        price_series(prices, "missing", "2020-1-1", "2020-1-8")
    prices.write.partitionBy("symbol").parquet(f"{folder}/prices")
    stored = price_series(read_prices(spark, f"{folder}/prices"), "B", "2020-1-1", "2020-1-8")
    assert stored.count() == 2


def test_flow_keeps_three_columns(prices):
    flow = price_flow(prices, "B", "2020-1-1", "2020-1-6")
    assert flow.columns == ["Date", "Close", "Return"] and flow.count() == 6


def test_range_check():
    assert check_range("2000-1-1", "2000-01-05")[1] == dt.date(2000, 1, 5)
    for start, end in (("2020-02-01", "2020-01-01"), ("never", "2020-01-01")):
        with pytest.raises(ValueError):
            check_range(start, end)


@pytest.fixture(scope="module")
def skewed(spark):
    rows = [(i, dt.datetime(2020, 1, 1) if i % 3 == 0 else
             dt.datetime(2020, 1, 1) + dt.timedelta(days=i % 50)) for i in range(6_000)]
    rows += [(9_000, None), (9_001, dt.datetime(1999, 1, 1))]
    return spark.createDataFrame(rows, "id int, Date timestamp_ntz").repartition(5)


def test_join_keeps_rows_and_checks_keys(spark, skewed):
    aux = spark.createDataFrame([(d(i), float(i)) for i in range(1, 29)], "Date date, Close double")
    joined = attach(skewed, aux, ["Date"])
    assert joined.columns == ["id", "Date", "Close"]
    assert joined.count() == skewed.count()
    assert joined.where("id = 0").first()["Close"] == 1.0
    assert joined.where("id >= 9000 AND Close IS NULL").count() == 2
    with pytest.raises(DuplicateKeys):
        attach(skewed, aux.union(aux), ["Date"])
    with pytest.raises(ValueError, match="both sides"):
        attach(skewed, aux.withColumn("id", F.lit(1)), ["Date"])


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_lookup_is_salted_not_broadcast(spark, skewed, how):
    aux = spark.createDataFrame([(d(i), float(i)) for i in range(1, 29)], "Date date, Close double")
    small = attach(skewed, aux, ["Date"], how)
    large = attach(skewed, aux, ["Date"], how, broadcast_bytes=0)
    text = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in text
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_large_lookup_without_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(attach_module, "HOT_PARTS", 1)
    left = spark.range(100).select((F.col("id") % 50).alias("k"), "id")
    right = spark.range(50).select(F.col("id").alias("k"), F.lit(1.5).alias("v"))
    joined = attach(left, right, ["k"], broadcast_bytes=0)
    assert joined.where("v = 1.5").count() == 100
