"""Registered model queries with several features, trees and differing trials, and their SQL.

On boolean features a tree is a function of the features' combinations, of which there
are a few. So SQL can grow the same trees: a combination with p positives of weight r
and q negatives has the sum r p - q of its labels; later trees take the slopes of the
logistic loss, 4 / (1 + exp(2 F)) for a positive and -4 / (1 + exp(-2 F)) for a negative
with the score F so far. A tree of one level splits on the feature with the largest sum
of squared sums over weights; one of as many levels as features gives every combination
its own mean. The first tree counts fully, later ones by the learning rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators.model import feature_importance, fit_classifier, score
from riskpanel.operators.rows import with_split
from riskpanel.operators.schema import ColumnRule
from riskpanel.operators.tuning import Range, Study, best_trial, draw_params
from riskpanel.plans import tables as T
from riskpanel.plans.catalog import (CELLS_SQL, F1_SQL, PANEL_SQL, SPLIT_CASE, ranked_sql, register,
                                     rounded)
from riskpanel.plans.job import run_job
from riskpanel.session import shared_folder

# Two features that say something about the label, and one that does not.
HINT, GUESS = "((y = 1) = (o_orderkey % 10 < 7))", "((y = 1) = (o_orderkey % 7 < 4))"
FLAGS = {"hint": HINT, "guess": GUESS, "building": "coalesce(cat = 'BUILDING', false)"}
FLAG_SQL = "WITH" + PANEL_SQL + f""",
flag_t AS (
  SELECT o_orderkey, y, {", ".join(f"{x} AS {name}" for name, x in FLAGS.items())},
         {SPLIT_CASE} AS split FROM panel_t),
train_t AS (SELECT * FROM flag_t WHERE split = 'train'),
rate_t AS (SELECT count(*) FILTER (y = 0)::DOUBLE / count(*) FILTER (y = 1) AS r FROM train_t)
"""


def boosted_sql(name: str, features: list[str], levels: int, trees: int, rate: float) -> str:
    """CTEs: ``name``_1 ... ``name``_<trees>, the combinations with their score f after each
    tree, and ``name``_best_<tree>, the feature that a tree of one level splits on."""
    keys = ", ".join(features)
    parts = [f"""{name}_0 AS (
  SELECT {keys}, count(*) FILTER (y = 1) * any_value(r) AS p,
         count(*) FILTER (y = 0)::DOUBLE AS q, 0.0::DOUBLE AS f
  FROM train_t, rate_t GROUP BY {keys})"""]
    for k in range(1, trees + 1):
        slope = ("p - q" if k == 1 else
                 "p * 4 / (1 + exp(2 * f)) - q * 4 / (1 + exp(-2 * f))")
        weight = 1.0 if k == 1 else rate
        parts.append(f"{name}_s{k} AS (SELECT *, {slope} AS s, p + q AS w FROM {name}_{k - 1})")
        if levels == len(features):
            step = "s / w"
        else:
            gains = " UNION ALL ".join(
                f"SELECT '{x}' AS feature, sum(s * s / w) AS gain FROM (SELECT sum(s) AS s, "
                f"sum(w) AS w FROM {name}_s{k} GROUP BY {x})" for x in features)
            parts.append(f"{name}_best_{k} AS (SELECT arg_max(feature, gain) AS feature "
                         f"FROM ({gains}))")
            step = "CASE feature " + " ".join(
                f"WHEN '{x}' THEN sum(s) OVER (PARTITION BY {x}) / sum(w) OVER (PARTITION BY {x})"
                for x in features) + " END"
        source = f"{name}_s{k}" + ("" if levels == len(features) else f", {name}_best_{k}")
        parts.append(f"{name}_{k} AS (SELECT {keys}, p, q, f + {weight!r}::DOUBLE * ({step}) AS f "
                     f"FROM {source})")
    return ",\n".join(parts)


def scored_sql(name: str, features: list[str], trees: int) -> str:
    return f"""scored_t AS (
  SELECT flag_t.*, 1 / (1 + exp(-2 * f)) AS score, (f > 0)::INTEGER AS prediction
  FROM flag_t JOIN {name}_{trees} USING ({", ".join(features)}))"""


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.panel(spark, sf_dir).select(
        "o_orderkey", "Date", "y", *(F.expr(x).alias(name) for name, x in FLAGS.items()))
    return with_split(rows, T.VAL_START, T.TEST_START, split_col="split")


def _fitted(spark: SparkSession, sf_dir: str, features: list[str], params: dict):
    rows = flagged(spark, sf_dir)
    train = rows.where("split = 'train'").select(*features, "y")
    return rows, fit_classifier(train, params, "y", features)


TWO, ALL = ["hint", "guess"], list(FLAGS)
DEEP = {"num_leaves": 4, "n_estimators": 5, "learning_rate": 0.3}
FLAT = {"num_leaves": 2, "n_estimators": 6, "learning_rate": 0.4}


@register(FLAG_SQL + "," + boosted_sql("m", TWO, 2, 5, 0.3) + "," + scored_sql("m", TWO, 5) + """
SELECT o_orderkey, round(score, 9) AS score, prediction FROM scored_t
""")
def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five trees of two levels on two features."""
    rows, model = _fitted(spark, sf_dir, TWO, DEEP)
    return rounded(score(model, rows).select("o_orderkey", "score", "prediction"), 9)


@register(FLAG_SQL + "," + boosted_sql("m", ALL, 1, 6, 0.4) + "," + scored_sql("m", ALL, 6) + """
SELECT o_orderkey, round(score, 9) AS score, prediction FROM scored_t
""")
def boosted_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six trees of one level that choose among three features."""
    rows, model = _fitted(spark, sf_dir, ALL, FLAT)
    return rounded(score(model, rows).select("o_orderkey", "score", "prediction"), 9)


def _importance_sql(order: str) -> str:
    splits = " UNION ALL ".join(f"SELECT feature FROM m_best_{k}" for k in range(1, 7))
    names = ", ".join(f"'{x}'" for x in ALL)
    return FLAG_SQL + "," + boosted_sql("m", ALL, 1, 6, 0.4) + f""",
used_t AS (
  SELECT name AS feature, count(s.feature) AS importance
  FROM (SELECT unnest([{names}]) AS name) LEFT JOIN ({splits}) s ON s.feature = name GROUP BY name)
SELECT row_number() OVER (ORDER BY importance {order}, feature)::INTEGER AS position,
       feature, importance FROM used_t
"""


def _in_order(spark: SparkSession, ordered: DataFrame) -> DataFrame:
    """The rows, one for each feature, with the position that they come in."""
    rows = [(i, r["feature"], int(r["importance"])) for i, r in enumerate(ordered.collect(), 1)]
    return spark.createDataFrame(rows, "position int, feature string, importance bigint")


@register(_importance_sql("DESC"))
def boosted_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _fitted(spark, sf_dir, ALL, FLAT)
    return _in_order(spark, feature_importance(model))


@register(_importance_sql("ASC"))
def boosted_importance_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _fitted(spark, sf_dir, ALL, FLAT)
    return _in_order(spark, feature_importance(model, ascending=True))


# --- search ------------------------------------------------------------------------

SPACE = {"num_leaves": Range(2, 4, whole=True), "n_estimators": Range(1, 4, whole=True),
         "learning_rate": Range(0.1, 0.6)}
TRIALS = 5


def trials_sql(space: dict[str, Range], n_trials: int, features: list[str]) -> str:
    """CTE trials_t (trial_id, metric, num_leaves, n_estimators, learning_rate, ratio): the drawn
    parameters of each trial and its average precision on the validation rows."""
    ctes, rows = [], []
    for t in range(n_trials):
        params = draw_params(space, t)
        levels = 1 if params["num_leaves"] == 2 else 2
        trees = params["n_estimators"]
        ctes.append(boosted_sql(f"t{t}", features, levels, trees, params["learning_rate"]))
        ctes.append(f"""t{t}_rank AS (
  SELECT f, count(*) AS n, sum(y) AS pos FROM flag_t JOIN t{t}_{trees}
  USING ({", ".join(features)}) WHERE split = 'val' GROUP BY f),
t{t}_cum AS (
  SELECT *, sum(n) OVER (ORDER BY f DESC) AS cn, sum(pos) OVER (ORDER BY f DESC) AS cpos,
         sum(pos) OVER () AS allpos FROM t{t}_rank)""")
        rows.append(f"""SELECT {t} AS trial_id, sum(pos::DOUBLE / allpos * cpos / cn) AS metric,
       {params["num_leaves"]}::DOUBLE AS num_leaves, {trees}::DOUBLE AS n_estimators,
       {params["learning_rate"]!r}::DOUBLE AS learning_rate, (SELECT r FROM rate_t) AS ratio
FROM t{t}_cum""")
    return ",\n".join(ctes) + ",\ntrials_t AS (" + " UNION ALL ".join(rows) + ")"


TRIALS_SQL = FLAG_SQL + "," + trials_sql(SPACE, TRIALS, TWO) + """
SELECT trial_id::INTEGER AS trial_id, round(metric, 9) AS metric, num_leaves, n_estimators,
       round(learning_rate, 9) AS learning_rate, round(ratio, 9) AS ratio FROM trials_t
"""


def _study(spark: SparkSession, sf_dir: str, **options) -> Study:
    rows = flagged(spark, sf_dir)
    train, val = (rows.where(f"split = '{s}'").select(*TWO, "y") for s in ("train", "val"))
    return Study(train, val, "y", TWO, SPACE, **options)


def _told(trials: DataFrame) -> DataFrame:
    p = F.col("params")
    return rounded(trials.select(
        "trial_id", "metric", p["num_leaves"].alias("num_leaves"),
        p["n_estimators"].alias("n_estimators"), p["learning_rate"].alias("learning_rate"),
        p["scale_pos_weight"].alias("ratio")), 9)


@register(TRIALS_SQL)
def boosted_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials that differ in levels, trees and learning rate, some of them run again after
    others were recorded."""
    study = _study(spark, sf_dir, trials_path=f"{shared_folder(spark)}/study")
    study.run(n_trials=2)
    return _told(study.run(n_trials=TRIALS, parallelism=3))


@register(TRIALS_SQL + "ORDER BY trials_t.metric DESC, trial_id LIMIT 1")
def boosted_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(best_trial(_study(spark, sf_dir).run(n_trials=TRIALS, parallelism=3)))


# --- the whole job -----------------------------------------------------------------

JOB_RULES = (
    ColumnRule("CompNo", "string", nullable=False),
    ColumnRule("Company_name", "string", nullable=False),
    ColumnRule("Date", "timestamp_ntz", nullable=False),
    ColumnRule("INDUSTRY2", "string"),
    ColumnRule("Y", "int", nullable=False, allowed=(0, 1)),
)
JOB_FLAGS = ["a", "b"]
JOB_TRIALS = 3
JOB_BEST_SQL = "(SELECT trial_id FROM trials_t ORDER BY metric DESC, trial_id LIMIT 1)"
JOB_SQL = "WITH" + PANEL_SQL + f""",
flag_t AS (
  SELECT o_orderkey, y, {HINT} AS a, NOT {HINT} AND {GUESS} AS b, "Date", {SPLIT_CASE} AS split
  FROM panel_t WHERE "Date" > TIMESTAMP '{T.CUTOFF}'),
train_t AS (SELECT * FROM flag_t WHERE split = 'train'),
rate_t AS (SELECT count(*) FILTER (y = 0)::DOUBLE / count(*) FILTER (y = 1) AS r FROM train_t),
""" + trials_sql(SPACE, JOB_TRIALS, JOB_FLAGS) + """,
scored_t AS (""" + " UNION ALL ".join(f"""
  SELECT flag_t.*, 1 / (1 + exp(-2 * f)) AS score, (f > 0)::INTEGER AS prediction
  FROM flag_t JOIN t{t}_{draw_params(SPACE, t)["n_estimators"]} USING (a, b)
  WHERE {JOB_BEST_SQL} = {t}""" for t in range(JOB_TRIALS)) + "),"


@register(JOB_SQL + ranked_sql("score", "split") + f""",
cells_t AS (SELECT split AS g, {CELLS_SQL} FROM scored_t GROUP BY 1),
wide_t AS (
  SELECT g, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, {F1_SQL} AS f1, pr_auc, roc_auc
  FROM cells_t JOIN metrics_t USING (g) WHERE g <> 'train')
SELECT 'metrics' AS section, g AS a, metric AS b, round("value", 9) AS "value"
FROM (UNPIVOT wide_t ON accuracy, f1, pr_auc, roc_auc INTO NAME metric VALUE "value")
UNION ALL SELECT 'trials', trial_id::VARCHAR, '', round(metric, 9) FROM trials_t
UNION ALL SELECT 'best', {JOB_BEST_SQL}::VARCHAR, '', round(max(metric), 9) FROM trials_t
UNION ALL SELECT 'confusion', t::VARCHAR, p::VARCHAR, count(y)::DOUBLE
FROM (SELECT unnest([0, 0, 1, 1]) AS t, unnest([0, 1, 0, 1]) AS p)
LEFT JOIN (SELECT * FROM scored_t WHERE split = 'test') ON y = t AND prediction = p GROUP BY t, p
UNION ALL SELECT 'summary', 'count', 'Date', count(*)::DOUBLE FROM flag_t
UNION ALL SELECT 'summary', 'rows', '', 8.0
UNION ALL SELECT 'processed', split, '', count(*)::DOUBLE FROM flag_t GROUP BY split
""")
def whole_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From text to metrics with a real search, and what was written on the way: industries as
    categories, a price that never moves, all outputs read back."""
    panel = T.panel(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("CompNo"),
        F.concat(F.lit("firm "), F.col("firm").cast("string")).alias("Company_name"),
        F.date_format("Date", "yyyy-MM-dd").alias("Date"),
        F.expr(f"CASE WHEN {HINT} THEN '1.0' WHEN {GUESS} THEN '2.0' END").alias("INDUSTRY2"), F.col("y").cast("string").alias("Y"))
    days = T.table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last"))
    prices = days.select(F.lit(T.MARKET).alias("symbol"), F.explode(F.sequence(
        F.date_sub("first", 2), F.date_add("last", 2))).alias("Date"), F.lit(50.0).alias("Close"))
    folder = shared_folder(spark)
    done = run_job(spark, panel, prices, JOB_RULES, cutoff=T.CUTOFF, val_start=T.VAL_START,
                   test_start=T.TEST_START, symbol=T.MARKET, n_trials=JOB_TRIALS, space=SPACE,
                   parallelism=3, output=folder)
    none = F.lit("")
    summary = spark.read.option("header", True).csv(f"{folder}/summary_statistics")
    parts = [
        done.metrics.select(F.lit("metrics").alias("section"), F.col("indicator").alias("a"),
                            F.col("metric").alias("b"), "value"),
        done.trials.select(F.lit("trials"), F.col("trial_id").cast("string"), none, "metric"),
        done.best.select(F.lit("best"), F.col("trial_id").cast("string"), none, "metric"),
        done.confusion.select(F.lit("confusion"), F.col("truth").cast("string"),
                              F.col("predicted").cast("string"), F.col("n").cast("double")),
        summary.where("statistic = 'count'").select(
            F.lit("summary"), "statistic", F.lit("Date"), F.col("Date").cast("double")),
        summary.agg(F.count("*").cast("double")).select(F.lit("summary"), F.lit("rows"), none, "*"),
        spark.read.parquet(f"{folder}/processed").groupBy("indicator").agg(
            F.count("*").cast("double").alias("n")).select(
            F.lit("processed"), "indicator", none, "n"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return rounded(out, 9)
