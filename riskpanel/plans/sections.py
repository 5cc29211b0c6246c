"""Registered queries over profile sections of long texts, whole rows and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators import frequent, profile
from riskpanel.plans import tables as T
from riskpanel.plans.catalog import ORACLES, PANEL_SQL, register, rounded

TEXT_TOP_SQL = """
SELECT "column", md5("value") AS value_md5, n, position::INTEGER AS position FROM (
  SELECT 'text' AS "column", text AS "value", count(*) AS n,
         row_number() OVER (ORDER BY count(*) DESC, text) AS position
  FROM documents WHERE text IS NOT NULL GROUP BY text) WHERE position <= 25
"""


def _shown(top: DataFrame) -> DataFrame:
    return top.select("column", F.md5("value").alias("value_md5"), "n", "position")


@register(TEXT_TOP_SQL)
def top_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts that are nearly all different, so that ties decide."""
    return _shown(profile.top_values(T.table(spark, sf_dir, "documents"), ["text"], 25))


@register(TEXT_TOP_SQL)
def top_texts_by_longer_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with tied texts told apart by more and more of their text."""
    return _shown(frequent.top_values(T.table(spark, sf_dir, "documents"), ["text"], 25, most=25,
                                      few=1))


@register(ORACLES["profile_topk"])
def top_values_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries too small to settle anything, so that counted keys decide."""
    return frequent.top_values(T.table(spark, sf_dir, "events"), ["event_type", "props"], 10,
                               most=10).select("column", "value", "n", "position")


@register("""
SELECT lang, source, md5(text) AS text_md5, count(*) AS n FROM documents
GROUP BY lang, source, text HAVING count(*) > 1
""")
def duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows with long texts that occur more than once."""
    found = profile.duplicate_rows(T.table(spark, sf_dir, "documents"), ["lang", "source", "text"])
    return found.select("lang", "source", F.md5("text").alias("text_md5"), "n")


SAMPLES = {"first": "o_orderkey", "last": "o_orderkey DESC",
           "random": "md5('7,' || o_orderkey::VARCHAR), o_orderkey"}


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{name}' AS sample, position::INTEGER AS position, o_orderkey, x1, cat FROM (
  SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM panel_t) WHERE position <= 10"""
          for name, order in SAMPLES.items()))
def profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.panel(spark, sf_dir).select("o_orderkey", "x1", "cat")
    return profile.sample_rows(rows, ["o_orderkey"], 10, seed=7)


@register(ORACLES["profile_alerts"])
def profile_alerts_from_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of the whole report, which take their sections from it."""
    rows = T.panel(spark, sf_dir).select("Date", "x1", "x2", "x_many", "x_few", "score", "cat", "y")
    return rounded(profile.profile_tables(rows)["alerts"])
