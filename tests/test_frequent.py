"""Frequent values, duplicates and samples against plain counts."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskpanel.operators import frequent, profile


def plain_top(values, k):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k]


def table(spark, values, parts=3):
    return spark.createDataFrame([(v,) for v in values], "v string").repartition(parts)


def found(df, k, **options):
    rows = sorted(frequent.top_values(df, ["v"], k, **options).collect(),
                  key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
    return [(r["value"], r["n"]) for r in rows]


LONG = "the same long beginning of every text " * 8
CASES = {
    "a few values": [("b", "a", "c")[i % 3] for i in range(30)] + [None] * 5,
    "all different": [f"value number {i:04} and more than 24 bytes" for i in range(400)],
    "alike for long": [f"{LONG}{i % 150:04}" for i in range(300)],
    "some often": [f"text {i % 7 if i % 2 else i}" for i in range(500)],
    "empty texts": ["", "", "x", None, "é" * 30, "é" * 30, "🙂" * 20],
    "nothing": [None, None],
}


@pytest.mark.parametrize("few,most", [(1000, 1000), (1, 2)])
@pytest.mark.parametrize("name", CASES)
def test_top_values_equal_counts(spark, name, few, most):
    values = CASES[name]
    for k in (1, 4):
        assert found(table(spark, values), k, few=few, most=most) == plain_top(values, k)


def test_columns_that_need_different_ways(spark):
    rows = [("x" if i % 2 else f"{i}", f"{LONG}{i}", None) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = {(r["column"], r["position"]): (r["value"], r["n"])
           for r in frequent.top_values(df, ["a", "b", "c"], 3, most=3, few=1).collect()}
    for c, column in zip("abc", zip(*rows)):
        for i, pair in enumerate(plain_top(column, 3), 1):
            assert got.pop((c, i)) == pair
    assert got == {}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=60), min_size=1, max_size=4),
       st.integers(1, 8))
def test_summaries_undercount_by_no_more_than_they_say(parts, most):
    total, lost = Counter(), 0
    for part in parts:  # batches of one task, summaries of several
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(part), 7):
            batch = np.array(part[at:at + 7], np.int64)
            keys, counts = frequent.summed(np.concatenate([keys, batch]), np.concatenate(
                [counts, np.ones(len(batch), np.int64)]))
            keys, counts, taken = frequent.shortened(keys, counts, most)
            lost += taken
            assert len(keys) <= most
        total.update(dict(zip(keys.tolist(), counts.tolist())))
    true = Counter(v for part in parts for v in part)
    for v, n in true.items():
        assert total[v] <= n <= total[v] + lost


def test_frequent_values_need_no_keys(spark, monkeypatch):
    values = ["often"] * 300 + ["less"] * 200 + [f"{LONG}{i}" for i in range(300)]
    monkeypatch.setattr(frequent, "key_counts", None)
    assert found(table(spark, values), 2, most=20) == [("often", 300), ("less", 200)]


def test_long_texts_do_not_leave_their_task(spark):
    df = table(spark, [f"{LONG}{i}" for i in range(50)])
    plan = frequent.key_counts(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    # keys, starts and counts are combined by hash on both sides of the exchange
    assert plan.count("HashAggregate(keys=[slot") == 2 and "SortAggregate" not in plan
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "value" not in exchange
    widest = frequent.key_counts(df, ["v"]).agg(
        F.max(F.octet_length("key")), F.max(F.char_length("head"))).first()
    assert tuple(widest) == (25, frequent.HEAD)


def test_duplicates_compare_whole_rows(spark, monkeypatch):
    rows = [(i % 40, f"{LONG}{i % 40}", None if i % 3 else 1.0) for i in range(120)] + [
        (None, None, None)] * 3
    df = spark.createDataFrame(rows, "a int, b string, `c.d` double").repartition(4)
    wanted = {(*r, n) for r, n in Counter(rows).items() if n > 1}
    assert {tuple(r) for r in profile.duplicate_rows(df).collect()} == wanted
    # the same digest for all rows changes nothing
    monkeypatch.setattr(profile, "_row_digest", lambda df, columns: [
        F.lit(1).alias("__digest0"), F.lit(2).alias("__digest1")])
    assert {tuple(r) for r in profile.duplicate_rows(df).collect()} == wanted


def test_only_digests_are_counted_first(spark):
    df = spark.createDataFrame([("x" * 100, 1)], "a string, b int")
    keys = ["__digest0", "__digest1"]
    counted = df.select("a", "b", *profile._row_digest(df, ["a", "b"])).groupBy(*keys).count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__digest0" in plan and "HashAggregate(keys=[a" not in plan


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_samples_do_not_depend_on_the_partitioning(spark, parts):
    rows = [(i % 50 or None, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(parts)
    got = [tuple(r) for r in profile.sample_rows(df, k=3, seed=5).orderBy(
        "sample", "position").collect()]
    key = [((a is not None, a or 0, b), a, b) for a, b in rows]
    first = [("first", i, a, b) for i, (_, a, b) in enumerate(sorted(key)[:3], 1)]
    last = [("last", i, a, b) for i, (_, a, b) in enumerate(sorted(key)[::-1][:3], 1)]
    assert got[:6] == first + last
    assert len({r[2:] for r in got[6:]}) == 3 and {r[2:] for r in got[6:]} <= set(rows)
    if parts == 1:
        test_samples_do_not_depend_on_the_partitioning.random = got[6:]
    assert got[6:] == test_samples_do_not_depend_on_the_partitioning.random


def test_text_summary_with_known_counts(spark):
    df = spark.createDataFrame([("a", None), ("bb", "x" * 40), ("a", "x" * 40), (None, "y")],
                               "t string, u string")
    counts = frequent.key_counts(df, ["t", "u"])
    rows = {r["column"]: tuple(r)[1:] for r in profile.text_summary(df, ["t", "u"], counts).collect()}
    assert rows == {"t": (3, 2, "a", 2, 1, pytest.approx(4 / 3), 2),
                    "u": (3, 2, "x" * 40, 2, 1, 27.0, 40)}


def test_report_reads_its_source_a_known_number_of_times(spark):
    """Sections that build on each other share their passes: the count is the claim."""
    rows = 64
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame(
        [(float(i % 9), i, f"t{i % 5}") for i in range(rows)], "x double, y int, t string"
    ).mapInArrow(counting, "x double, y int, t string")
    tables = profile.profile_tables(source, k=3, bins=2)
    built = read.value // rows
    for name in ("missing", "numeric", "correlation", "text", "top_values", "alerts"):
        tables[name].collect()
    # nothing is left to be read for them
    assert read.value // rows == built
    assert built <= 32
    alone = read.value
    profile.alerts(source).collect()
    assert read.value - alone >= 4 * rows
