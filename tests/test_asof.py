"""The last price at or before a moment, against the filled calendar and pandas."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskpanel.operators import asof
from riskpanel.operators.asof import attach_asof, carried
from riskpanel.operators.attach import attach
from riskpanel.operators.series import DuplicateKeys, daily_returns, fill_calendar

START = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(3)
    prices = [(s, START + dt.timedelta(days=d), r.choice([0.0, 1.5, 2.0, 8.0]))
              for s in ("A", "B") for d in range(5, 300) if r.random() < .2]
    rows = [(i, r.choice(["A", "A", "A", "B", "none", None]),
             START + dt.timedelta(days=r.randrange(310)) if i % 11 else None) for i in range(400)]
    return (spark.createDataFrame(rows, "id int, symbol string, Date date").repartition(3),
            spark.createDataFrame(prices, "symbol string, Date date, Close double"))


@pytest.mark.parametrize("segments,broadcast_bytes", [(1, 0), (4, 1 << 20), (50, 0)])
def test_equals_the_filled_calendar(spark, tables, monkeypatch, segments, broadcast_bytes):
    monkeypatch.setattr(asof, "SEGMENTS", segments)
    rows, prices = tables
    end = START + dt.timedelta(days=320)
    wanted = attach(rows, daily_returns(fill_calendar(prices, START, end)), ["symbol", "Date"])
    got = attach_asof(rows, prices, ["symbol"], broadcast_bytes=broadcast_bytes)
    assert got.columns == wanted.columns
    assert (sorted(map(tuple, got.collect()), key=repr)
            == sorted(map(tuple, wanted.collect()), key=repr))


def test_moments_within_a_day_equal_pandas(spark):
    r = random.Random(5)
    base = dt.datetime(2021, 3, 1)
    prices = pd.DataFrame({
        "Date": sorted({base + dt.timedelta(seconds=r.randrange(10 ** 6)) for _ in range(200)})})
    prices["Close"] = [r.random() + 1 for _ in range(len(prices))]
    rows = pd.DataFrame({"Date": sorted(
        [base + dt.timedelta(seconds=r.randrange(-100, 10 ** 6 + 100)) for _ in range(300)])})
    wanted = pd.merge_asof(rows, prices, on="Date")["Close"]
    schema = "Date timestamp_ntz, Close double"
    df = spark.createDataFrame([(d.to_pydatetime(),) for d in rows["Date"]], "Date timestamp_ntz")
    lookup = spark.createDataFrame(
        [(d.to_pydatetime(), c) for d, c in zip(prices["Date"], prices["Close"])], schema)
    got = attach_asof(df, lookup, []).orderBy("Date").toPandas()["Close"]
    assert [None if pd.isna(x) else x for x in got] == [None if pd.isna(x) else x for x in wanted]


def test_no_task_holds_a_whole_series(spark):
    rows = spark.range(4_000).select(F.lit("A").alias("k"), F.col("id").alias("_at"), F.when(
        F.col("id") % 7 == 0, F.col("id").cast("double")).alias("_value"))
    found = carried(rows, ["k"], 100)
    wrong = found.where((F.col("_last._value") != F.col("_at") - F.col("_at") % 7)
                        | (F.col("_last._at") != F.col("_at") - F.col("_at") % 7))
    assert wrong.isEmpty() and found.count() == 4_000
    plan = found._jdf.queryExecution().toString()
    assert "[k#" in plan and "_segment" in plan
    # the pass from segment to segment has a row for each of these only
    assert rows.select(F.floor(F.col("_at") / 100)).distinct().count() == 40


def test_checks_and_empty_tables(spark, tables):
    rows, prices = tables
    with pytest.raises(DuplicateKeys):
        attach_asof(rows, prices.unionByName(prices), ["symbol"])
    none = attach_asof(rows, prices.limit(0), ["symbol"])
    assert none.where("Close IS NOT NULL OR Return IS NOT NULL").isEmpty()
    assert none.count() == rows.count()
    assert attach_asof(rows.limit(0), prices, ["symbol"]).count() == 0
    later = attach_asof(rows, prices, ["symbol"], start=START + dt.timedelta(days=200))
    early = later.where(F.col("Date") < F.lit(START + dt.timedelta(days=200)))
    assert early.where("Close IS NOT NULL").isEmpty()
