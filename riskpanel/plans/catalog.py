"""The registered queries and the SQL each of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators import metrics, profile
from riskpanel.operators.attach import attach
from riskpanel.operators.correlation import correlation_matrix
from riskpanel.operators.describe import date_range, describe_dates, describe_numbers
from riskpanel.operators.encode import apply_one_hot, fit_one_hot
from riskpanel.operators.model import feature_importance, fit_classifier, score
from riskpanel.operators.rows import after_cutoff, drop_columns, keep_columns, with_split
from riskpanel.operators.scale import apply_min_max, fit_min_max
from riskpanel.operators.schema import ColumnRule, coerce, violation_report
from riskpanel.operators.series import daily_returns, fill_calendar
from riskpanel.operators.tuning import Range, Study, best_trial
from riskpanel.operators.winsor import apply_winsor, fit_winsor
from riskpanel.plans import tables as T
from riskpanel.plans.job import run_job
from riskpanel.plans.prepare import prepare_panel, price_flow

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}

FEATURES = ["x1", "x2", "x_many", "x_few"]
PROFILED = [*FEATURES, "score"]

PANEL_SQL = """
panel_t AS (
  SELECT o_orderkey, o_custkey AS firm, o_orderdate AS "Date", o_totalprice AS x1,
         c_acctbal AS x2,
         CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS x_many,
         CASE WHEN o_orderkey % 25 <> 0 THEN o_totalprice END AS x_few,
         CASE WHEN o_orderkey % 50 <> 0 THEN c_mktsegment END AS cat,
         (o_orderstatus = 'F')::INTEGER AS y,
         (o_orderkey * 7919 % 1000)::DOUBLE / 1000.0::DOUBLE AS score,
         c_nationkey AS nation
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""
SCORED_SQL = PANEL_SQL + """,
scored_t AS (
  SELECT *, (score > 0.5::DOUBLE)::INTEGER AS prediction,
         x1 / 1000000.0::DOUBLE AS price_score
  FROM panel_t)
"""
SPLIT_CASE = f"""CASE WHEN "Date" < TIMESTAMP '{T.VAL_START}' THEN 'train'
       WHEN "Date" < TIMESTAMP '{T.TEST_START}' THEN 'val' ELSE 'test' END"""


def register(oracle: str | None = None, name: str | None = None):
    """Register a query under its function's name, or the given one."""
    def add(build: Build) -> Build:
        key = name or build.__name__
        QUERIES[key] = build
        if oracle is not None:
            ORACLES[key] = oracle
        return build
    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, where the order of summing may differ."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# --- schema -----------------------------------------------------------------

TEXT_RULES = (
    ColumnRule("CompNo", "string", nullable=False),
    ColumnRule("STInt", "double", nullable=False),
    ColumnRule("StkIndx", "double"),
    ColumnRule("INDUSTRY2", "string"),
    ColumnRule("Date", "timestamp_ntz", nullable=False),
    ColumnRule("Y", "int", nullable=False, allowed=(0, 1)),
)
TEXT_SQL = "WITH" + PANEL_SQL + """,
text_t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 97 <> 0 THEN firm::VARCHAR END AS "CompNo",
         CASE WHEN o_orderkey % 31 = 0 THEN 'bad' ELSE x1::VARCHAR END AS "STInt",
         cat AS "INDUSTRY2",
         CASE WHEN o_orderkey % 41 = 0 THEN 'not a date'
              ELSE strftime("Date", '%Y-%m-%d') END AS "Date",
         CASE WHEN o_orderkey % 53 = 0 THEN '2' ELSE y::VARCHAR END AS "Y"
  FROM panel_t)
"""


def text_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a CSV reader gives it: text, with some broken cells."""
    key = F.col("o_orderkey")
    return T.panel(spark, sf_dir).select(
        "o_orderkey", F.when(key % 97 != 0, F.col("firm").cast("string")).alias("CompNo"),
        F.when(key % 31 == 0, "bad").otherwise(F.col("x1").cast("string")).alias("STInt"),
        F.col("cat").alias("INDUSTRY2"),
        F.when(key % 41 == 0, "not a date")
        .otherwise(F.date_format("Date", "yyyy-MM-dd")).alias("Date"),
        F.when(key % 53 == 0, "2").otherwise(F.col("y").cast("string")).alias("Y"))


@register(TEXT_SQL + """
SELECT u."column", u."check", u.n_failed::BIGINT AS n_failed FROM (
  SELECT 'StkIndx' AS "column", 'present' AS "check", 1 AS n_failed
  UNION ALL SELECT 'CompNo', 'present', 0 UNION ALL SELECT 'STInt', 'present', 0
  UNION ALL SELECT 'INDUSTRY2', 'present', 0 UNION ALL SELECT 'Date', 'present', 0
  UNION ALL SELECT 'Y', 'present', 0
  UNION ALL SELECT 'CompNo', 'convertible', 0 UNION ALL SELECT 'INDUSTRY2', 'convertible', 0
  UNION ALL SELECT 'STInt', 'convertible',
    count(*) FILTER ("STInt" IS NOT NULL AND try_cast("STInt" AS DOUBLE) IS NULL) FROM text_t
  UNION ALL SELECT 'Date', 'convertible',
    count(*) FILTER ("Date" IS NOT NULL AND try_cast("Date" AS TIMESTAMP) IS NULL) FROM text_t
  UNION ALL SELECT 'Y', 'convertible',
    count(*) FILTER ("Y" IS NOT NULL AND try_cast("Y" AS INTEGER) IS NULL) FROM text_t
  UNION ALL SELECT 'CompNo', 'not_null', count(*) FILTER ("CompNo" IS NULL) FROM text_t
  UNION ALL SELECT 'STInt', 'not_null',
    count(*) FILTER (try_cast("STInt" AS DOUBLE) IS NULL) FROM text_t
  UNION ALL SELECT 'Date', 'not_null',
    count(*) FILTER (try_cast("Date" AS TIMESTAMP) IS NULL) FROM text_t
  UNION ALL SELECT 'Y', 'not_null', count(*) FILTER (try_cast("Y" AS INTEGER) IS NULL) FROM text_t
  UNION ALL SELECT 'Y', 'in_domain',
    count(*) FILTER (try_cast("Y" AS INTEGER) NOT IN (0, 1)) FROM text_t) u
""")
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violation_report(text_panel(spark, sf_dir), TEXT_RULES)


@register(TEXT_SQL + """
SELECT o_orderkey, "CompNo", try_cast("STInt" AS DOUBLE) AS "STInt", "INDUSTRY2",
       try_cast("Date" AS TIMESTAMP) AS "Date", try_cast("Y" AS INTEGER) AS "Y"
FROM text_t
""")
def schema_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce(text_panel(spark, sf_dir), TEXT_RULES)


# --- rows and columns -------------------------------------------------------

@register("WITH" + PANEL_SQL + f"""
SELECT o_orderkey, "Date" FROM panel_t WHERE "Date" > TIMESTAMP '{T.CUTOFF}'
""")
def cutoff_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_columns(after_cutoff(T.panel(spark, sf_dir), T.CUTOFF), ["o_orderkey", "Date"])


@register("WITH" + PANEL_SQL + """
SELECT o_orderkey, x1, x2, x_many, x_few, y FROM panel_t
""")
def project_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = drop_columns(T.panel(spark, sf_dir), ("firm", "Date", "cat", "nation"))
    return keep_columns(features, ["o_orderkey", *FEATURES, "y", "not_there"])


@register("WITH" + PANEL_SQL + f"""
SELECT o_orderkey, {SPLIT_CASE} AS split FROM panel_t
""")
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = with_split(T.panel(spark, sf_dir), T.VAL_START, T.TEST_START, split_col="split")
    return labelled.select("o_orderkey", "split")


@register("WITH" + PANEL_SQL + f"""
SELECT {SPLIT_CASE} AS split, count(*) AS n, count(*) FILTER (y = 1) AS positives
FROM panel_t GROUP BY 1
""")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = with_split(T.panel(spark, sf_dir), T.VAL_START, T.TEST_START, split_col="split")
    return labelled.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                         F.count_if(F.col("y") == 1).alias("positives"))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FLAGS_SQL = ", ".join(f"""coalesce(cat = '{s}', false) AS "cat_{s}\"""" for s in SEGMENTS)


@register("WITH" + PANEL_SQL + f"SELECT o_orderkey, {FLAGS_SQL} FROM panel_t")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.panel(spark, sf_dir).select("o_orderkey", "cat")
    return apply_one_hot(rows, fit_one_hot(rows, "cat"))


# --- winsorizing and scaling ------------------------------------------------

def winsor_sql(source: str, column: str, name: str, ignore_nulls: bool = False,
               fit: str | None = None) -> str:
    """CTEs giving ``name``(o_orderkey, column) by ranks over the sorted column of ``fit``."""
    counted = "count(x)" if ignore_nulls else "count(*)"
    return f"""
{name}_r AS (
  SELECT {column} AS x, row_number() OVER (ORDER BY {column} NULLS LAST) - 1 AS r
  FROM {fit or source}),
{name}_n AS (
  SELECT n, m, floor(0.05::DOUBLE * n)::BIGINT AS u
  FROM (SELECT {counted} AS n, count(x) AS m FROM {name}_r)),
{name}_c AS (
  SELECT max(n) AS n, max(m) AS m, max(u) AS u, max(x) FILTER (r = u) AS lo,
         max(x) FILTER (r = n - u - 1) AS hi FROM {name}_r, {name}_n),
{name} AS (
  SELECT o_orderkey, CASE WHEN u = 0 THEN x WHEN m <= u THEN NULL WHEN x < lo THEN lo
              WHEN n - m <= u AND x > hi THEN hi
              WHEN n - m <= u AND n > m AND x IS NULL THEN hi ELSE x END AS {column}
  FROM (SELECT o_orderkey, {column} AS x FROM {source}), {name}_c)
"""


def _winsorized(spark: SparkSession, sf_dir: str, column: str, **options) -> DataFrame:
    rows = T.panel(spark, sf_dir).select("o_orderkey", column)
    return apply_winsor(rows, fit_winsor(rows, [column], **options))


@register("WITH" + PANEL_SQL + "," + winsor_sql("panel_t", "x_few", "w") + "SELECT * FROM w")
def winsorize_few_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _winsorized(spark, sf_dir, "x_few")


@register("WITH" + PANEL_SQL + "," + winsor_sql("panel_t", "x_many", "w") + "SELECT * FROM w")
def winsorize_many_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _winsorized(spark, sf_dir, "x_many")


@register("WITH" + PANEL_SQL + "," + winsor_sql("panel_t", "x_few", "w", True)
          + "SELECT * FROM w")
def winsorize_ignore_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _winsorized(spark, sf_dir, "x_few", null_policy="ignore")


def scale_sql(column: str, source: str) -> str:
    bounds = f"(SELECT min({column}) FROM {source})", f"(SELECT max({column}) FROM {source})"
    return f"""CASE WHEN {bounds[0]} = {bounds[1]} THEN {column} - {bounds[0]}
       ELSE ({column} - {bounds[0]}) / ({bounds[1]} - {bounds[0]}) END AS {column}"""


@register("WITH" + PANEL_SQL + """, flat_t AS (SELECT *, 7.0::DOUBLE AS flat FROM panel_t)
SELECT o_orderkey, """ + ", ".join(scale_sql(c, "flat_t") for c in [*FEATURES, "flat"])
          + " FROM flat_t")
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.panel(spark, sf_dir).select("o_orderkey", *FEATURES, F.lit(7.0).alias("flat"))
    return apply_min_max(rows, fit_min_max(rows, [*FEATURES, "flat"]))


# --- statistics -------------------------------------------------------------

@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, min({c}) AS "min",
       round(quantile_cont({c}, 0.25), 6) AS "25%", round(quantile_cont({c}, 0.5), 6) AS "50%",
       round(quantile_cont({c}, 0.75), 6) AS "75%", max({c}) AS "max",
       round(stddev_samp({c}), 6) AS std FROM panel_t""" for c in PROFILED), name="describe")
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe_numbers(T.panel(spark, sf_dir), PROFILED))


def _moment(share: str) -> str:
    return f"make_timestamp(floor(quantile_cont(us, {share}))::BIGINT)"


@register("WITH" + PANEL_SQL + f"""
SELECT name AS "column", count(us) AS "count", make_timestamp((sum(us) // count(us))::BIGINT) AS mean,
       make_timestamp(min(us)) AS "min", {_moment('0.25')} AS "25%", {_moment('0.5')} AS "50%",
       {_moment('0.75')} AS "75%", make_timestamp(max(us)) AS "max", NULL::DOUBLE AS std
FROM (SELECT 'Date' AS name, epoch_us("Date") AS us FROM panel_t) GROUP BY name
""", name="describe_dates")
def describe_panel_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_dates(T.panel(spark, sf_dir), ["Date"])


@register(f"""
SELECT name AS "column", count(us) AS "count", make_timestamp((sum(us) // count(us))::BIGINT) AS mean,
       make_timestamp(min(us)) AS "min", {_moment('0.25')} AS "25%", {_moment('0.5')} AS "50%",
       {_moment('0.75')} AS "75%", make_timestamp(max(us)) AS "max", NULL::DOUBLE AS std
FROM (SELECT 'ts' AS name, epoch_us(ts) AS us FROM events) GROUP BY name
""")
def describe_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_dates(T.table(spark, sf_dir, "events"), ["ts"])


@register("WITH" + PANEL_SQL + """
SELECT strftime(min("Date") - INTERVAL 1 DAY, '%Y-%m-%d') AS "start",
       strftime(max("Date") + INTERVAL 1 DAY, '%Y-%m-%d') AS "end" FROM panel_t
""", name="date_range")
def panel_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_range(T.panel(spark, sf_dir))


# --- price series -----------------------------------------------------------

NATION_PRICES_SQL = """
prices_t AS (
  SELECT c_nationkey AS symbol, o_orderdate::DATE AS d, max(o_totalprice) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
days_t AS (
  SELECT unnest(generate_series(min(o_orderdate) - INTERVAL 1 DAY,
                                max(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d
  FROM orders),
grid_t AS (SELECT symbol, d FROM (SELECT DISTINCT symbol FROM prices_t), days_t),
raw_t AS (SELECT g.symbol, g.d, p.c FROM grid_t g LEFT JOIN prices_t p USING (symbol, d)),
filled_t AS (
  SELECT symbol, d, last_value(c IGNORE NULLS) OVER
    (PARTITION BY symbol ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
  FROM raw_t),
return_t AS (
  SELECT symbol, d AS "Date", c AS "Close",
         c / nullif(lag(c) OVER (PARTITION BY symbol ORDER BY d), 0) - 1.0::DOUBLE AS "Return"
  FROM filled_t)
"""
MARKET_SQL = NATION_PRICES_SQL.replace(
    "c_nationkey AS symbol", "'ALL' AS symbol").replace(
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP", "FROM orders GROUP")


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = date_range(T.table(spark, sf_dir, "orders"), "o_orderdate").first()
    return fill_calendar(T.nation_prices(spark, sf_dir), span["start"], span["end"],
                         check_unique=False)


@register("WITH" + NATION_PRICES_SQL + """SELECT symbol, d AS "Date", c AS "Close" FROM raw_t""")
def calendar_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calendar(spark, sf_dir)


@register("WITH" + NATION_PRICES_SQL + "SELECT * FROM return_t")
def daily_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_returns(_calendar(spark, sf_dir))


@register("WITH" + MARKET_SQL + """SELECT "Date", "Close", "Return" FROM return_t""")
def price_series_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = date_range(T.table(spark, sf_dir, "orders"), "o_orderdate").first()
    return price_flow(T.market_prices(spark, sf_dir), T.MARKET, span["start"], span["end"])


@register("WITH" + PANEL_SQL + "," + MARKET_SQL + """
SELECT o_orderkey, p."Date", "Close", "Return"
FROM panel_t p LEFT JOIN return_t a ON p."Date" = a."Date"::TIMESTAMP
""")
def aux_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.panel(spark, sf_dir).select("o_orderkey", "Date")
    return attach(rows, price_series_flow(spark, sf_dir), ["Date"])


@register("WITH" + PANEL_SQL + "," + NATION_PRICES_SQL + """
SELECT o_orderkey, p."Date", p.nation AS symbol, "Close", "Return"
FROM panel_t p LEFT JOIN return_t a ON p."Date" = a."Date"::TIMESTAMP AND p.nation = a.symbol
""")
def aux_join_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.panel(spark, sf_dir).select("o_orderkey", "Date", F.col("nation").alias("symbol"))
    return attach(rows, daily_return(spark, sf_dir), ["symbol", "Date"])


def prepare_sql(fit_where: str) -> str:
    """The whole preparation, with caps and bounds fitted on the rows of a condition."""
    calendar = MARKET_SQL.replace(
        "FROM orders),", f"FROM orders WHERE o_orderdate > TIMESTAMP '{T.CUTOFF}'),")
    return "WITH" + PANEL_SQL + "," + calendar + f""",
recent_t AS (SELECT * FROM panel_t WHERE "Date" > TIMESTAMP '{T.CUTOFF}'),
fit_t AS (SELECT * FROM recent_t WHERE {fit_where}),
{",".join(winsor_sql("recent_t", c, f"w_{c}", fit="fit_t") for c in FEATURES)},
capped_t AS (
  SELECT r.o_orderkey, r."Date", r.cat, r.y, {", ".join(f"w_{c}.{c}" for c in FEATURES)}
  FROM recent_t r {" ".join(f"JOIN w_{c} USING (o_orderkey)" for c in FEATURES)}),
bound_t AS (SELECT * FROM capped_t WHERE {fit_where})
SELECT k.o_orderkey::VARCHAR AS "CompNo", k."Date", k.y AS "Y",
       {", ".join(scale_sql(c, "bound_t") for c in FEATURES)},
       {FLAGS_SQL.replace('"cat_', '"INDUSTRY2_')}, a."Close", a."Return"
FROM capped_t k LEFT JOIN return_t a ON k."Date" = a."Date"::TIMESTAMP
"""


def _prepared(spark: SparkSession, sf_dir: str, fit_on: str) -> DataFrame:
    prepared, _ = prepare_panel(T.flow_panel(spark, sf_dir), T.market_prices(spark, sf_dir),
                                "INDUSTRY2", T.CUTOFF, T.MARKET, fit_on=fit_on,
                                val_start=T.VAL_START, test_start=T.TEST_START)
    return prepared.drop("Company_name")


@register(prepare_sql("TRUE"))
def prepare_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir, "all")


@register(prepare_sql(f"""\"Date\" < TIMESTAMP '{T.VAL_START}'"""))
def prepare_flow_fit_on_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir, "train")


# --- metrics ----------------------------------------------------------------

@register("""
SELECT count(*) FILTER (quality = 0) AS negatives, count(*) FILTER (quality = 1) AS positives,
       (count(*) FILTER (quality = 0))::DOUBLE / nullif(count(*) FILTER (quality = 1), 0) AS ratio
FROM labels
""")
def class_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_ratio(T.table(spark, sf_dir, "labels"), "quality")


@register("WITH" + SCORED_SQL + """
SELECT round(avg((y = prediction)::INTEGER), 9) AS accuracy FROM scored_t
""")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.accuracy(T.scored_panel(spark, sf_dir), "y"), 9)


F1_SQL = """
(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0) * (tp + fn)
 + 2.0::DOUBLE * tn / nullif(2 * tn + fp + fn, 0) * (tn + fp)) / (tp + fp + fn + tn)
"""
CELLS_SQL = """count(*) FILTER (y = 1 AND prediction = 1) AS tp,
         count(*) FILTER (y = 0 AND prediction = 1) AS fp,
         count(*) FILTER (y = 1 AND prediction = 0) AS fn,
         count(*) FILTER (y = 0 AND prediction = 0) AS tn"""


@register("WITH" + SCORED_SQL + f"""
SELECT round({F1_SQL}, 9) AS f1 FROM (SELECT {CELLS_SQL} FROM scored_t)
""")
def weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.weighted_f1(T.scored_panel(spark, sf_dir), "y"), 9)


def ranked_sql(score_col: str, group: str = "'all'") -> str:
    """CTE metrics_t(g, pr_auc, roc_auc) by running sums over the sorted scores."""
    return f"""
score_t AS (
  SELECT {group} AS g, {score_col} AS s, count(*) AS n, sum(y)::BIGINT AS pos
  FROM scored_t GROUP BY 1, 2),
cum_t AS (
  SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cpos,
         sum(n) OVER (PARTITION BY g) AS alln, sum(pos) OVER (PARTITION BY g) AS allpos
  FROM score_t
  WINDOW w AS (PARTITION BY g ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
metrics_t AS (
  SELECT g, sum(pos::DOUBLE / allpos * cpos / cn) AS pr_auc,
         sum(pos * ((alln - allpos) - (cn - cpos) + (n - pos) / 2.0::DOUBLE))
           / (max(allpos)::DOUBLE * max(alln - allpos)) AS roc_auc
  FROM cum_t GROUP BY g)
"""


@register("WITH" + SCORED_SQL + "," + ranked_sql("score")
          + "SELECT round(pr_auc, 9) AS pr_auc FROM metrics_t")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.average_precision(T.scored_panel(spark, sf_dir), "y"), 9)


@register("WITH" + SCORED_SQL + "," + ranked_sql("price_score")
          + "SELECT round(pr_auc, 9) AS pr_auc FROM metrics_t")
def average_precision_few_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.average_precision(T.scored_panel(spark, sf_dir), "y",
                                             "price_score"), 9)


@register("WITH" + SCORED_SQL + "," + ranked_sql("score")
          + "SELECT round(roc_auc, 9) AS roc_auc FROM metrics_t")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_auc(T.scored_panel(spark, sf_dir), "y"), 9)


@register("WITH" + SCORED_SQL + "," + ranked_sql("price_score")
          + "SELECT round(roc_auc, 9) AS roc_auc FROM metrics_t")
def roc_auc_few_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_auc(T.scored_panel(spark, sf_dir), "y", "price_score"), 9)


@register("WITH" + SCORED_SQL + "," + ranked_sql("price_score", SPLIT_CASE) + f""",
cells_t AS (SELECT {SPLIT_CASE} AS g, {CELLS_SQL} FROM scored_t GROUP BY 1),
wide_t AS (
  SELECT g, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, {F1_SQL} AS f1, pr_auc, roc_auc
  FROM cells_t JOIN metrics_t USING (g))
SELECT g AS split, metric, round("value", 9) AS "value"
FROM (UNPIVOT wide_t ON accuracy, f1, pr_auc, roc_auc INTO NAME metric VALUE "value")
""")
def eval_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_split(T.scored_panel(spark, sf_dir), T.VAL_START, T.TEST_START,
                        split_col="split")
    return rounded(metrics.evaluate_long(scored, "y", "price_score", by=("split",)), 9)


@register("WITH" + SCORED_SQL + """
SELECT t::INTEGER AS truth, p::INTEGER AS predicted, count(y) AS n
FROM (SELECT unnest([0, 0, 1, 1]) AS t, unnest([0, 1, 0, 1]) AS p)
LEFT JOIN scored_t ON y = t AND prediction = p GROUP BY 1, 2
""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(T.scored_panel(spark, sf_dir), "y")


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{a}' AS col_x, '{b}' AS col_y, round(corr({a}, {b}), 6) AS corr FROM panel_t"""
          for a in [*PROFILED, "y"] for b in [*PROFILED, "y"]), name="correlation_matrix")
def correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlation_matrix(T.panel(spark, sf_dir), [*PROFILED, "y"]))


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{a}' AS col_x, '{b}' AS col_y, round_even(corr({a}, {b}), 2) AS corr FROM panel_t"""
          for a in [*PROFILED, "y"] for b in [*PROFILED, "y"]))
def correlation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation_matrix(T.panel(spark, sf_dir), [*PROFILED, "y"], digits=2)


# --- trials and models ------------------------------------------------------

THRESHOLDS = tuple(i / 20 for i in range(1, 20))


@register("WITH" + SCORED_SQL + """,
trial_t AS (
  SELECT i::INTEGER AS trial_id, i / 20.0::DOUBLE AS threshold,
         avg((y = (score > i / 20.0::DOUBLE)::INTEGER)::INTEGER) AS metric
  FROM scored_t, (SELECT unnest(generate_series(1, 19)) AS i) GROUP BY 1, 2)
SELECT trial_id, threshold, round(metric, 9) AS metric FROM trial_t
ORDER BY trial_t.metric DESC, trial_id LIMIT 1
""", name="best_trial")
def best_threshold_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials are decision thresholds of the scored panel, measured by accuracy."""
    scored = T.scored_panel(spark, sf_dir)
    totals = scored.agg(*[
        F.avg((F.col("y") == (F.col("score") > t).cast("int")).cast("double")).alias(f"m{i}")
        for i, t in enumerate(THRESHOLDS)])
    trials = totals.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("trial_id"),
                 F.create_map(F.lit("threshold"), F.lit(t)).alias("params"),
                 F.col(f"m{i}").alias("metric")) for i, t in enumerate(THRESHOLDS)])))
    best = best_trial(trials)
    return rounded(best.select("trial_id", F.col("params")["threshold"].alias("threshold"),
                               "metric"), 9)


MODEL_PARAMS = {"num_leaves": 9, "max_depth": 8, "learning_rate": 0.1, "n_estimators": 8,
                "min_child_samples": 10, "bagging_fraction": 0.7, "feature_fraction": 0.7,
                "min_split_gain": 0.0}


def _document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.labelled_documents(spark, sf_dir)
    for column in ("lang", "source"):
        rows = apply_one_hot(rows, fit_one_hot(rows, column))
    return rows


@register()
def train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _document_features(spark, sf_dir)
    model = fit_classifier(rows.drop("doc_id"), MODEL_PARAMS, "quality")
    return score(model, rows).select("doc_id", "quality", "score", "prediction")


@register()
def feature_importance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _document_features(spark, sf_dir)
    model = fit_classifier(rows.drop("doc_id"), MODEL_PARAMS, "quality")
    return feature_importance(model).limit(5)


SMALL_SPACE = {"num_leaves": Range(2, 16, whole=True), "feature_fraction": Range(0.4, 0.8),
               "bagging_fraction": Range(0.4, 0.8), "learning_rate": Range(0.01, 0.2),
               "min_child_samples": Range(10, 200, whole=True),
               "n_estimators": Range(3, 8, whole=True)}


@register()
def tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_split(T.panel(spark, sf_dir), T.VAL_START, T.TEST_START, split_col="split")
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    study = Study(train, val, "y", FEATURES, SMALL_SPACE)
    return study.run(n_trials=4, parallelism=4).select("trial_id", "params", "metric")


FLOW_RULES = (
    ColumnRule("CompNo", "string", nullable=False),
    ColumnRule("Company_name", "string", nullable=False),
    ColumnRule("Date", "timestamp_ntz", nullable=False),
    *[ColumnRule(c, "double") for c in FEATURES],
    ColumnRule("INDUSTRY2", "string"),
    ColumnRule("Y", "int", nullable=False, allowed=(0, 1)),
)


@register()
def full_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation to evaluation: rows (indicator, metric, value)."""
    done = run_job(spark, T.flow_panel(spark, sf_dir), T.market_prices(spark, sf_dir), FLOW_RULES,
                   cutoff=T.CUTOFF, val_start=T.VAL_START, test_start=T.TEST_START,
                   symbol=T.MARKET, n_trials=2, space=SMALL_SPACE, parallelism=2)
    return done.metrics


# --- profile ----------------------------------------------------------------

def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.panel(spark, sf_dir).select("Date", *PROFILED, "cat", "y")


ALL_PROFILED = ["Date", *PROFILED, "cat", "y"]


@register("WITH" + PANEL_SQL + f"""
SELECT n_rows, 8 AS n_columns, 6 AS n_numeric, 1 AS n_text, 1 AS n_dates, missing_cells,
       missing_cells::DOUBLE / (n_rows * 8) AS missing_share
FROM (SELECT count(*) AS n_rows,
             ({" + ".join(f'count(*) FILTER ("{c}" IS NULL)' for c in ALL_PROFILED)})::BIGINT
               AS missing_cells FROM panel_t)
""")
def profile_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overview(_profiled(spark, sf_dir))


def _population(sample_skew: str, n: str) -> str:
    return f"{sample_skew} * ({n} - 2) / sqrt({n}::DOUBLE * ({n} - 1))"


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_missing,
       count(DISTINCT {c}) AS n_distinct, count(*) FILTER ({c} = 0) AS n_zeros,
       count(*) FILTER ({c} < 0) AS n_negative, min({c}) AS "min", max({c}) AS "max",
       round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(var_samp({c}) / 1000000, 4) AS variance_millions,
       round(stddev_samp({c}) / nullif(avg({c}), 0), 4) AS cv,
       round(sum({c}) / 1000000, 4) AS sum_millions,
       round({_population(f"skewness({c})", f"count({c})")}, 4) AS skewness,
       round(kurtosis_pop({c}), 4) AS kurtosis FROM panel_t""" for c in PROFILED))
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.numeric_summary(_profiled(spark, sf_dir), PROFILED)
    million = F.lit(1_000_000)
    return rounded(summary.withColumn("variance_millions", F.col("variance") / million)
                   .withColumn("sum_millions", F.col("sum") / million)
                   .drop("variance", "sum"), 4)


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", round(quantile_cont({c}, 0.05), 6) AS p05,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(quantile_cont({c}, 0.95), 6) AS p95,
       round(max({c}) - min({c}), 6) AS "range",
       round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr,
       round(mad({c}), 6) AS mad FROM panel_t""" for c in PROFILED))
def profile_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.quantiles(_profiled(spark, sf_dir), PROFILED))


EVENT_TEXTS = ("event_type", "props")


@register(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", "value", n, position::INTEGER AS position FROM (
  SELECT {c} AS "value", count(*) AS n,
         row_number() OVER (ORDER BY count(*) DESC, {c}) AS position
  FROM events WHERE {c} IS NOT NULL GROUP BY 1) WHERE position <= 10""" for c in EVENT_TEXTS))
def profile_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_values(T.table(spark, sf_dir, "events"), list(EVENT_TEXTS), 10)


DOCUMENT_TEXTS = ("text", "lang", "source")


@register(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", sum(n)::BIGINT AS n, count(*) AS n_distinct,
       first("value" ORDER BY n DESC, "value") AS "mode", max(n) AS mode_count,
       min(length("value"))::INTEGER AS min_length,
       round(sum(length("value") * n)::DOUBLE / sum(n), 6) AS mean_length,
       max(length("value"))::INTEGER AS max_length
FROM (SELECT {c} AS "value", count(*) AS n FROM documents WHERE {c} IS NOT NULL GROUP BY 1)"""
                         for c in DOCUMENT_TEXTS))
def profile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.text_summary(T.table(spark, sf_dir, "documents"),
                                        list(DOCUMENT_TEXTS)))


@register("WITH" + PANEL_SQL + """
SELECT 'Date' AS "column", count("Date") AS n, count(*) - count("Date") AS n_missing,
       min("Date") AS "first", max("Date") AS "last",
       date_diff('day', min("Date")::DATE, max("Date")::DATE)::INTEGER AS days FROM panel_t
""")
def profile_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.date_summary(_profiled(spark, sf_dir))


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", b::INTEGER AS bin, round(lo + (hi - lo) * b / 10, 6) AS low,
       round(lo + (hi - lo) * (b + 1) / 10, 6) AS high, count(v) AS n
FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM panel_t)
CROSS JOIN (SELECT unnest(generate_series(0, 9)) AS b)
LEFT JOIN (SELECT {c} AS v FROM panel_t WHERE {c} IS NOT NULL)
  ON least(floor((v - lo) / (hi - lo) * 10), 9) = b GROUP BY b, lo, hi""" for c in PROFILED))
def profile_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.histogram(_profiled(spark, sf_dir), PROFILED, 10))


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) - count("{c}") AS n_missing,
       (count(*) - count("{c}"))::DOUBLE / nullif(count(*), 0) AS missing_share FROM panel_t"""
          for c in ALL_PROFILED))
def profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_counts(_profiled(spark, sf_dir))


GAPPED = ["x1", "x_many", "x_few", "cat"]


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{a}' AS col_x, '{b}' AS col_y,
       CASE WHEN var_pop(({a} IS NULL)::INTEGER) > 0 AND var_pop(({b} IS NULL)::INTEGER) > 0
            THEN round(corr(({a} IS NULL)::INTEGER, ({b} IS NULL)::INTEGER), 6) END AS corr
FROM panel_t""" for a in GAPPED for b in GAPPED))
def profile_missing_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.missing_correlation(_profiled(spark, sf_dir), GAPPED))


LINE_KEYS = ["l_orderkey", "l_linenumber"]


@register("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_rows(T.table(spark, sf_dir, "lineitem"), LINE_KEYS)


@register("""
SELECT count(*) AS n_repeated, coalesce(sum(n - 1), 0)::BIGINT AS n_surplus
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
""")
def profile_duplicate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_summary(T.table(spark, sf_dir, "lineitem"), LINE_KEYS)


@register("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 10
""")
def profile_top_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_rows(T.table(spark, sf_dir, "lineitem"), LINE_KEYS, k=10)


@register("WITH" + PANEL_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{side}' AS side, position::INTEGER AS position, "value", n FROM (
  SELECT {c} AS "value", count(*) AS n, row_number() OVER (ORDER BY {c} {order}) AS position
  FROM panel_t WHERE {c} IS NOT NULL GROUP BY {c}) WHERE position <= 5"""
          for c in PROFILED for side, order in (("smallest", "ASC"), ("largest", "DESC"))))
def profile_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.extremes(_profiled(spark, sf_dir), PROFILED, 5)


NUMERIC_ALERTS = [*PROFILED, "y"]
ALERTS_SQL = "WITH" + PANEL_SQL + ", alert_t AS (" + " UNION ALL ".join(
    [f"""SELECT '{c}' AS "column", 'missing' AS alert,
         (count(*) - count("{c}"))::DOUBLE / count(*) AS "value" FROM panel_t
         HAVING (count(*) - count("{c}"))::DOUBLE / count(*) > 0.05::DOUBLE"""
     for c in ALL_PROFILED]
    + [f"""SELECT '{c}', 'constant', count(DISTINCT {c})::DOUBLE FROM panel_t
           HAVING count(DISTINCT {c}) = 1""" for c in [*NUMERIC_ALERTS, "cat"]]
    + [f"""SELECT '{c}', 'unique', count(DISTINCT {c})::DOUBLE FROM panel_t
           HAVING count(DISTINCT {c}) = count({c}) AND count({c}) > 1"""
       for c in [*NUMERIC_ALERTS, "cat"]]
    + [f"""SELECT '{c}', 'zeros', (count(*) FILTER ({c} = 0))::DOUBLE / count(*) FROM panel_t
           HAVING (count(*) FILTER ({c} = 0))::DOUBLE / count(*) > 0.1::DOUBLE"""
       for c in NUMERIC_ALERTS]
    + [f"""SELECT '{c}', 'skewed', {_population(f"skewness({c})", f"count({c})")} FROM panel_t
           HAVING abs({_population(f"skewness({c})", f"count({c})")}) > 20"""
       for c in NUMERIC_ALERTS]
    + [f"""SELECT '{a}', 'high_correlation', max(abs(r)) FROM (
           {" UNION ALL ".join(f"SELECT corr({a}, {b}) AS r FROM panel_t"
                               for b in NUMERIC_ALERTS if b != a)})
           WHERE abs(r) > 0.9::DOUBLE HAVING count(*) > 0""" for a in NUMERIC_ALERTS]
    + ["""SELECT 'cat', 'imbalance', max(n)::DOUBLE / sum(n) FROM (
          SELECT count(*) AS n FROM panel_t WHERE cat IS NOT NULL GROUP BY cat)
          HAVING count(*) > 1 AND max(n)::DOUBLE / sum(n) > 0.9::DOUBLE"""]) + """)
SELECT "column", alert, round("value", 6) AS "value" FROM alert_t
"""


@register(ALERTS_SQL)
def profile_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.alerts(_profiled(spark, sf_dir)))
