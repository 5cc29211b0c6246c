"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, queries()[name], oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - {"full_job"}))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert {(r["indicator"], r["metric"]) for r in rows} == {
        (s, m) for s in ("val", "test") for m in ("accuracy", "f1", "pr_auc", "roc_auc")}
    assert all(0 <= r["value"] <= 1 for r in rows)


@pytest.mark.parametrize("name", [
    "winsorize_many_nulls", "daily_return", "aux_join_by_symbol", "eval_by_split",
    "profile_topk", "profile_extremes", "minmax_scale"])
def test_no_window_gathers_all_rows(spark, name):
    # the flow's single price series is left out: its one window holds one row per day
    df = queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan


def test_only_needed_columns_are_read(spark):
    plan = queries()["cutoff_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "GreaterThan(o_orderdate,1996-01-01T00:00)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
