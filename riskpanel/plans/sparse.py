"""Registered queries over sparse one-hot vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators.sparse import apply_sparse, as_vectors, fit_categories
from riskpanel.plans import tables as T
from riskpanel.plans.catalog import PANEL_SQL, register

ENCODED = ["cat", "firm", "code"]
ROWS_SQL = "WITH" + PANEL_SQL + """,
row_t AS (
  SELECT o_orderkey, cat, firm::VARCHAR AS firm,
         CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey // 2)::VARCHAR END AS code
  FROM panel_t),
code_t AS (
  SELECT row_number() OVER (ORDER BY f, c) - 1 AS slot, f, c, n FROM (
    SELECT 0 AS f, cat AS c, count(*) AS n FROM row_t GROUP BY 2
    UNION ALL SELECT 1, firm, count(*) FROM row_t GROUP BY 2
    UNION ALL SELECT 2, code, count(*) FROM row_t GROUP BY 2) WHERE c IS NOT NULL)
"""
VECTORS_SQL = ROWS_SQL + """
SELECT o_orderkey, (SELECT count(*) FROM code_t)::INTEGER AS size,
       concat_ws(',', a.slot, b.slot, c.slot) AS slots,
       (a.slot IS NOT NULL)::INTEGER::DOUBLE + (b.slot IS NOT NULL)::INTEGER
         + (c.slot IS NOT NULL)::INTEGER AS total
FROM row_t LEFT JOIN code_t a ON a.f = 0 AND a.c = row_t.cat
LEFT JOIN code_t b ON b.f = 1 AND b.c = firm LEFT JOIN code_t c ON c.f = 2 AND c.c = code
"""


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with a short, a long and a very long list of categories."""
    key = F.col("o_orderkey")
    return T.panel(spark, sf_dir).select(
        "o_orderkey", "cat", F.col("firm").cast("string").alias("firm"),
        F.when(key % 3 != 0, F.expr("o_orderkey div 2").cast("string")).alias("code"))


def _shown(encoded: DataFrame) -> DataFrame:
    v = F.col("categories")
    return encoded.select("o_orderkey", v["size"].alias("size"),
                          F.concat_ws(",", v["indices"].cast("array<string>")).alias("slots"),
                          F.aggregate(v["values"], F.lit(0.0), lambda a, x: a + x).alias("total"))


@register(VECTORS_SQL)
def one_hot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir)
    return _shown(apply_sparse(rows, fit_categories(rows, ENCODED)))


@register(VECTORS_SQL)
def one_hot_sparse_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by salted joins, as with more categories than may be broadcast."""
    rows = _rows(spark, sf_dir)
    return _shown(apply_sparse(rows, fit_categories(rows, ENCODED), broadcast_bytes=0))


@register(VECTORS_SQL)
def one_hot_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a round trip as Spark ML's vectors."""
    rows = _rows(spark, sf_dir)
    vectors = as_vectors(apply_sparse(rows, fit_categories(rows, ENCODED)))
    return _shown(vectors.select("o_orderkey", F.unwrap_udt("categories").alias("categories")))


@register(ROWS_SQL + """
SELECT slot::INTEGER AS slot, ['cat_', 'firm_', 'code_'][f + 1] || c AS name, n FROM code_t
""")
def one_hot_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = fit_categories(_rows(spark, sf_dir), ENCODED)
    return fitted.names().join(fitted.table.select("slot", "n"), "slot")
