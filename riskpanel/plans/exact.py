"""Registered queries over whole numbers and decimals that no double holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators import profile
from riskpanel.operators.scale import apply_min_max, fit_min_max
from riskpanel.operators.winsor import apply_winsor, fit_winsor
from riskpanel.plans import tables as T
from riskpanel.plans.catalog import PANEL_SQL, register, rounded, winsor_sql

BASE = 1 << 53
AMOUNT = "decimal(30,6)"
LARGE = "123456789012345678"  # before the point
EXACT_SQL = "WITH" + PANEL_SQL + f""",
exact_t AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 25 <> 0 THEN {BASE} + o_orderkey END AS whole,
         CASE WHEN o_orderkey % 19 <> 0 THEN (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END)
           * ({LARGE}::{AMOUNT} + o_orderkey * 0.000001::DECIMAL(7,6)) END::{AMOUNT} AS amount
  FROM panel_t)
"""


def exact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of 2^53 and of large decimals of both signs, with gaps."""
    key = F.col("o_orderkey")
    sign = F.when(key % 2 == 0, 1).otherwise(-1)
    size = F.lit(LARGE).cast(AMOUNT) + (key * F.lit("0.000001").cast("decimal(7,6)"))
    return T.panel(spark, sf_dir).select(
        "o_orderkey", F.when(key % 25 != 0, F.lit(BASE) + key).alias("whole"),
        F.when(key % 19 != 0, (sign * size).cast(AMOUNT)).alias("amount"))


def _capped(spark: SparkSession, sf_dir: str, column: str, **options) -> DataFrame:
    rows = exact_rows(spark, sf_dir).select("o_orderkey", column)
    return apply_winsor(rows, fit_winsor(rows, [column], **options))


@register(EXACT_SQL + "," + winsor_sql("exact_t", "whole", "w") + "SELECT * FROM w")
def winsorize_whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capped(spark, sf_dir, "whole")


@register(EXACT_SQL + "," + winsor_sql("exact_t", "whole", "w") + "SELECT * FROM w")
def winsorize_whole_by_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by rounds of pivots for each digit."""
    return _capped(spark, sf_dir, "whole", gather_rows=100)


@register(EXACT_SQL + "," + winsor_sql("exact_t", "amount", "w", True)
          + "SELECT o_orderkey, amount::VARCHAR AS amount FROM w")
def winsorize_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _capped(spark, sf_dir, "amount", null_policy="ignore")
    return rows.select("o_orderkey", F.col("amount").cast("string").alias("amount"))


@register(EXACT_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{side}' AS side, position::INTEGER AS position,
       "value"::VARCHAR AS "value", n FROM (
  SELECT {c} AS "value", count(*) AS n, row_number() OVER (ORDER BY {c} {order}) AS position
  FROM exact_t WHERE {c} IS NOT NULL GROUP BY {c}) WHERE position <= 5"""
          for c in ("whole", "amount") for side, order in (("smallest", "ASC"), ("largest", "DESC"))))
def extremes_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.extremes(exact_rows(spark, sf_dir), ["whole", "amount"], 5, small_rows=500,
                            as_text=True)


POINTS = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


@register(EXACT_SQL + f""", near_t AS (SELECT whole - {BASE} AS x FROM exact_t)
SELECT 'whole' AS "column", {", ".join(
    f'{BASE}::DOUBLE + quantile_cont(x, {q}) AS {p}' for p, q in POINTS.items())},
       (max(x) - min(x))::DOUBLE AS "range",
       round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) AS iqr, round(mad(x), 6) AS mad
FROM near_t
""")
def quantiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.quantiles(exact_rows(spark, sf_dir), ["whole"]))


@register(EXACT_SQL + """
SELECT o_orderkey, round((whole - (SELECT min(whole) FROM exact_t))::DOUBLE
         / (SELECT max(whole) - min(whole) FROM exact_t), 12) AS whole,
       round((amount - (SELECT min(amount) FROM exact_t))::DOUBLE
         / (SELECT max(amount) - min(amount) FROM exact_t)::DOUBLE, 12) AS amount
FROM exact_t
""")
def minmax_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_rows(spark, sf_dir)
    return rounded(apply_min_max(rows, fit_min_max(rows, ["whole", "amount"])), 12)
