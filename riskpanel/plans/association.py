"""Registered queries over pairs of columns and over moments: correlations, as-of prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators.asof import attach_asof
from riskpanel.operators.correlation import correlation_matrix
from riskpanel.operators.row_ranks import average_ranks, rank_correlation
from riskpanel.plans import tables as T
from riskpanel.plans.catalog import ORACLES, PANEL_SQL, PROFILED, register, rounded

RANKED = [*PROFILED, "y"]


def rank_sql(column: str) -> str:
    return (f"CASE WHEN {column} IS NOT NULL THEN rank() OVER (ORDER BY {column} NULLS LAST) "
            f"+ (count(*) OVER (PARTITION BY {column}) - 1) / 2.0::DOUBLE END")


RANKS_SQL = "WITH" + PANEL_SQL + ", rank_t AS (SELECT o_orderkey, " + ", ".join(
    f"{rank_sql(c)} AS {c}" for c in RANKED) + " FROM panel_t)"


@register(RANKS_SQL + " SELECT * FROM rank_t", name="average_ranks")
def average_rank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return average_ranks(T.panel(spark, sf_dir).select("o_orderkey", *RANKED), RANKED)


@register(RANKS_SQL + " SELECT * FROM rank_t")
def average_ranks_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by shuffled joins, as with more distinct values than may be broadcast."""
    return average_ranks(T.panel(spark, sf_dir).select("o_orderkey", *RANKED), RANKED,
                         small_values=0)


@register(RANKS_SQL + " UNION ALL ".join(f"""
SELECT '{a}' AS col_x, '{b}' AS col_y, round(corr({a}, {b}), 6) AS corr FROM rank_t"""
                                         for a in RANKED for b in RANKED),
          name="rank_correlation")
def rank_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank_correlation(T.panel(spark, sf_dir), RANKED))


# Gaps of many patterns: column i of a wide table is missing where the key divided by
# GAPS[i % 3] leaves i.
WIDE, GAPS = 24, (29, 31, 37)


def _gap(i: int) -> int:
    return GAPS[i % len(GAPS)]


@register("WITH wide_t AS (SELECT " + ", ".join(
    f"CASE WHEN l_orderkey % {_gap(i)} <> {i} THEN l_extendedprice * {i + 1} "
    f"- l_quantity * l_partkey % {100 + i} END AS w{i}" for i in range(WIDE)) +
    " FROM lineitem) SELECT unnest([" + ", ".join(
        f"{{'col_x': 'w{i}', 'col_y': 'w{j}', 'corr': round(corr(w{i}, w{j}), 6)}}"
        for i in range(WIDE) for j in range(WIDE)) + "], recursive := true) FROM wide_t")
def correlation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of WIDE columns with their own gaps, over all order lines."""
    key, price = F.col("l_orderkey"), F.col("l_extendedprice")
    rows = T.table(spark, sf_dir, "lineitem").select(*[
        F.when(key % _gap(i) != i, price * (i + 1)
               - F.col("l_quantity") * F.col("l_partkey") % (100 + i)).alias(f"w{i}")
        for i in range(WIDE)])
    return rounded(correlation_matrix(rows))


# --- the last price at or before a date ---------------------------------------------------

@register(ORACLES["aux_join_by_symbol"])
def aux_asof_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the filled calendar gives, from the traded days alone."""
    rows = T.panel(spark, sf_dir).select("o_orderkey", "Date", F.col("nation").alias("symbol"))
    return attach_asof(rows, T.nation_prices(spark, sf_dir), ["symbol"])


@register(ORACLES["aux_join"])
def aux_asof_one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows on one symbol, in segments of time, joined by a salted shuffle."""
    rows = T.panel(spark, sf_dir).select("o_orderkey", "Date", F.lit(T.MARKET).alias("symbol"))
    return attach_asof(rows, T.market_prices(spark, sf_dir), ["symbol"],
                       broadcast_bytes=0).drop("symbol")
