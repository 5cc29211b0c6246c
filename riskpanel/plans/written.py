"""Registered queries over written results, and over the branches that only large tables take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators import metrics, profile
from riskpanel.operators.attach import attach
from riskpanel.operators.encode import apply_one_hot, fit_one_hot
from riskpanel.operators.rows import split_frames, with_split
from riskpanel.operators.schema import (ColumnRule, coerce, ingest_report, located_violations,
                                        violation_report)
from riskpanel.plans import tables as T
from riskpanel.plans.catalog import (ALL_PROFILED, ORACLES, PANEL_SQL, PROFILED, TEXT_RULES,
                                     _profiled, _winsorized, daily_return, register, rounded,
                                     text_panel)
from riskpanel.session import shared_folder
from riskpanel.sources.outputs import save_processed, save_profile
from riskpanel.sources.panel import read_panel_csv


@register("WITH" + PANEL_SQL + """
SELECT 'code_' || (10000 + nation) AS "column", count(*) AS n FROM panel_t GROUP BY 1
UNION ALL SELECT '(row)', count(*) FROM panel_t WHERE o_orderkey % 101 = 0
""")
def csv_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with codes that end in ``.0`` and some rows with a cell too many: rows per
    encoded category, and the reported rows."""
    key = F.col("o_orderkey")
    line = F.concat_ws(",", key.cast("string"),
                       F.concat((10000 + F.col("nation")).cast("string"), F.lit(".0")),
                       F.when(key % 101 == 0, "1,surplus").otherwise("1.0"))
    folder = f"{shared_folder(spark)}/csv"
    # a separator that no line has, so that lines are written as they stand
    (T.panel(spark, sf_dir).select(line.alias("key,code,Y"))
     .write.option("header", True).option("sep", "\x01").csv(folder))
    raw = read_panel_csv(spark, folder)
    rules = (ColumnRule("key", "bigint"), ColumnRule("Y", "int"))
    rows = coerce(raw, rules)
    encoded = apply_one_hot(rows, fit_one_hot(rows, "code"))
    names = [c for c in encoded.columns if c.startswith("code_")]
    counts = encoded.agg(*(F.count_if(c).alias(c) for c in names))
    reported = violation_report(raw, rules).where(F.col("column") == "(row)")
    return counts.unpivot([], names, "column", "n").unionByName(
        reported.select("column", F.col("n_failed").alias("n")))


@register(ORACLES["split_counts"])
def processed_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table written by split, each split read from its own folder."""
    folder = f"{shared_folder(spark)}/processed"
    save_processed(with_split(T.panel(spark, sf_dir), T.VAL_START, T.TEST_START), folder)
    parts = split_frames(spark.read.parquet(folder))
    out = None
    for part in parts:
        counted = part.groupBy(F.col("indicator").alias("split")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("positives"))
        out = counted if out is None else out.unionByName(counted)
    return out


@register(ORACLES["profile_missing"])
def saved_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/profile"
    save_profile({"missing": profile.missing_counts(_profiled(spark, sf_dir).select(*ALL_PROFILED))},
                 folder)
    return spark.read.parquet(f"{folder}/missing")


# --- what only large tables do ------------------------------------------------

@register(ORACLES["winsorize_few_nulls"])
def winsorize_by_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks by rounds of pivots, as on a table that no task can gather."""
    return _winsorized(spark, sf_dir, "x_few", gather_rows=100)


@register(ORACLES["eval_by_split"])
def eval_by_split_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_split(T.scored_panel(spark, sf_dir), T.VAL_START, T.TEST_START,
                        split_col="split")
    long = metrics.evaluate(scored, "y", "price_score", by=("split",), buckets=16)
    return rounded(long.unpivot(["split"], ["accuracy", "f1", "pr_auc", "roc_auc"], "metric",
                                "value"), 9)


@register(ORACLES["profile_extremes"])
def profile_extremes_by_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.extremes(_profiled(spark, sf_dir), PROFILED, 5, small_rows=500)


@register(ORACLES["aux_join_by_symbol"])
def aux_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.panel(spark, sf_dir).select("o_orderkey", "Date", F.col("nation").alias("symbol"))
    return attach(rows, daily_return(spark, sf_dir), ["symbol", "Date"], broadcast_bytes=0)


# --- the same answers with awkward values ---------------------------------------

@register("WITH" + PANEL_SQL + """, f AS (SELECT min(x1) AS lo, max(x1) AS hi FROM panel_t)
SELECT 'x' AS "column", b::INTEGER AS bin, round(lo + (hi - lo) * b / 10, 6) AS low,
       round(lo + (hi - lo) * (b + 1) / 10, 6) AS high, count(v) AS n
FROM f CROSS JOIN (SELECT unnest(generate_series(0, 9)) AS b)
LEFT JOIN (SELECT x1 AS v FROM panel_t)
  ON least(floor((v - lo) / (hi - lo) * 10), 9) = b GROUP BY b, lo, hi
UNION ALL SELECT 'x', 10, 'inf'::DOUBLE, 'inf'::DOUBLE, count(*) FROM panel_t
""")
def histogram_infinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row twice, once with an infinite value."""
    rows = T.panel(spark, sf_dir).select(F.col("x1").alias("x"))
    return rounded(profile.histogram(
        rows.unionByName(rows.select(F.lit(float("inf")).alias("x"))), ["x"], 10))


@register("WITH" + PANEL_SQL + """
SELECT o_orderkey, y AS "Y", date_trunc('day', "Date") AS "D1", date_trunc('day', "Date") AS "D2"
FROM panel_t
""")
def schema_loose_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers written as 1.0, dates as month/day/year and as eight digits."""
    rows = T.panel(spark, sf_dir).select(
        "o_orderkey", F.col("y").cast("double").cast("string").alias("Y"),
        F.date_format("Date", "M/d/yyyy").alias("D1"), F.date_format("Date", "yyyyMMdd").alias("D2"))
    return coerce(rows, (ColumnRule("Y", "int"), ColumnRule("D1", "timestamp_ntz"),
                         ColumnRule("D2", "timestamp_ntz")))


# --- validation while writing, and where broken rows are ------------------------------

@register(f"""SELECT "column", "check", n_failed FROM ({ORACLES["schema_report"]}) q
WHERE "column" <> 'StkIndx'""")
def schema_report_while_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report counted by the pass that writes the table."""
    rules = tuple(r for r in TEXT_RULES if r.name != "StkIndx")
    return ingest_report(text_panel(spark, sf_dir), f"{shared_folder(spark)}/table", rules)


@register("WITH" + PANEL_SQL + """, r_t AS (
  SELECT 'part' || (o_orderkey % 3) AS part, o_orderkey AS k FROM panel_t)
SELECT part, '(row)' AS "column", 'cells' AS "check", count(*) AS n_failed FROM r_t
WHERE k % 101 = 0 GROUP BY part
UNION ALL SELECT part, 'Y', 'in_domain', count(*) FROM r_t WHERE k % 53 = 0 GROUP BY part
UNION ALL SELECT part, 'Y', 'convertible', count(*) FROM r_t
WHERE k % 29 = 0 AND k % 53 <> 0 GROUP BY part
""")
def csv_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a cell too many or a bad label, by the file that they are in."""
    key = F.col("o_orderkey")
    label = F.when(key % 53 == 0, "7").when(key % 29 == 0, "many").otherwise("1")
    line = F.concat_ws(",", key.cast("string"), label, F.when(key % 101 == 0, "surplus"))
    folder = f"{shared_folder(spark)}/csv"
    rows = T.panel(spark, sf_dir)
    for i in range(3):
        (rows.where(key % 3 == i).select(line.alias("key,Y")).write.option("header", True)
         .option("sep", "\x01").csv(f"{folder}/part{i}"))
    raw = read_panel_csv(spark, f"{folder}/*", located=True)
    rules = (ColumnRule("key", "bigint"), ColumnRule("Y", "int", allowed=(0, 1)))
    found = located_violations(raw, rules).withColumn(
        "part", F.regexp_extract("file", r"/(part\d)/", 1))
    # a folder's files may be several
    return found.groupBy("part", "column", "check").agg(F.sum("n_failed").alias("n_failed"))
