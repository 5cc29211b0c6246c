"""Registered model queries with a closed form: one tree with one split on a boolean.

With r negatives per positive as the weight of positives, a leaf of p positives and
q negatives has the mean m = (r p - q) / (r p + q) and the score
1 / (1 + exp(-2 m)). So fit, score, importance, search, evaluation and saved
results all have SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators.model import (feature_importance, fit_classifier, fit_inputs, load_model,
                                       save_model, score)
from riskpanel.operators.rows import with_split
from riskpanel.operators.tuning import Range, Study, best_trial
from riskpanel.plans import tables as T
from riskpanel.plans.catalog import (CELLS_SQL, F1_SQL, PANEL_SQL, SPLIT_CASE, ranked_sql, register,
                                     rounded)
from riskpanel.plans.modelling import model_panel
from riskpanel.session import shared_folder
from riskpanel.sources.outputs import load_best_params, save_best_params

ONE_SPLIT = {"num_leaves": 2, "n_estimators": 1, "min_child_samples": 1}
ONE_SPLIT_SPACE = {name: Range(n, n, whole=True) for name, n in ONE_SPLIT.items()}

def one_split_sql(fit: str, source: str) -> str:
    """CTE scored_t: ``source`` (y, flag) with the scores of a model fitted on ``fit``."""
    return f"""
rate_t AS (SELECT count(*) FILTER (y = 0)::DOUBLE / count(*) FILTER (y = 1) AS r FROM {fit}),
leaf_t AS (
  SELECT flag, (r * p - q) / (r * p + q) AS m FROM (
    SELECT flag, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q
    FROM {fit} GROUP BY flag), rate_t),
scored_t AS (
  SELECT s.*, 1 / (1 + exp(-2 * m)) AS score,
         (1 / (1 + exp(-2 * m)) > 0.5::DOUBLE)::INTEGER AS prediction
  FROM {source} s JOIN leaf_t USING (flag))
"""


DOCUMENT_SQL = """WITH d AS (
  SELECT l.doc_id, quality AS y, coalesce(lang = 'en', false) AS flag
  FROM labels l JOIN documents USING (doc_id)),
""" + one_split_sql("d", "d")

FLOW_SQL = "WITH" + PANEL_SQL + f""",
flag_t AS (
  SELECT o_orderkey, y, coalesce(cat = 'BUILDING', false) AS flag, {SPLIT_CASE} AS split
  FROM panel_t),
train_t AS (SELECT * FROM flag_t WHERE split = 'train'),
""" + one_split_sql("train_t", "flag_t") + "," + ranked_sql("score", "split")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.labelled_documents(spark, sf_dir).select(
        "doc_id", "quality", F.coalesce(F.col("lang") == "en", F.lit(False)).alias("en"))


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with one boolean feature and the identifying columns."""
    return T.panel(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("CompNo"),
        F.col("firm").cast("string").alias("Company_name"), "Date",
        F.coalesce(F.col("cat") == "BUILDING", F.lit(False)).alias("building"),
        F.col("y").alias("Y"))


@register(DOCUMENT_SQL + "SELECT doc_id, y AS quality, round(score, 9) AS score, prediction "
                         "FROM scored_t")
def one_split_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir)
    model = fit_classifier(rows.drop("doc_id"), ONE_SPLIT, "quality")
    return rounded(score(model, rows).select("doc_id", "quality", "score", "prediction"), 9)


@register(DOCUMENT_SQL + "SELECT doc_id, y AS quality, round(score, 9) AS score, prediction "
                         "FROM scored_t")
def one_split_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of a model that was written and read back."""
    rows = _documents(spark, sf_dir)
    folder = f"{shared_folder(spark)}/model"
    save_model(fit_classifier(rows.drop("doc_id"), ONE_SPLIT, "quality"), folder)
    scored = score(load_model(spark, folder), rows)
    return rounded(scored.select("doc_id", "quality", "score", "prediction"), 9)


@register("SELECT 'en' AS feature, 1::BIGINT AS importance")
def one_split_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).drop("doc_id")
    return feature_importance(fit_classifier(rows, ONE_SPLIT, "quality"))


@register("WITH" + PANEL_SQL + """
SELECT o_orderkey, x1 AS s0, coalesce(x_many, (SELECT quantile_cont(x_many, 0.5) FROM panel_t)) AS s1,
       (x_many IS NULL)::INTEGER::DOUBLE AS s2,
       coalesce(cat = 'BUILDING', false)::INTEGER::DOUBLE AS s3
FROM panel_t
""")
def model_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the trees read: medians for missing numbers, their flags, booleans as 0 or 1."""
    from pyspark.ml.functions import vector_to_array

    rows = T.panel(spark, sf_dir).select(
        "o_orderkey", "x1", "x_many",
        F.coalesce(F.col("cat") == "BUILDING", F.lit(False)).alias("building"))
    inputs = fit_inputs(rows, ["x1", "x_many", "building"])
    made = inputs.transform(rows).select(
        "o_orderkey", vector_to_array("__features").alias("s"))
    return made.select("o_orderkey", *(F.col("s")[i].alias(f"s{i}") for i in range(4)))


def _study(spark: SparkSession, sf_dir: str, **options) -> Study:
    rows = with_split(_panel(spark, sf_dir), T.VAL_START, T.TEST_START)
    train, val = (rows.where(f"indicator = '{s}'").select("building", "Y") for s in ("train", "val"))
    return Study(train, val, "Y", ["building"], ONE_SPLIT_SPACE, **options)


@register(FLOW_SQL + """
SELECT t::INTEGER AS trial_id, round(pr_auc, 9) AS metric
FROM metrics_t, (SELECT unnest([0, 1, 2]) AS t) WHERE g = 'val'
""")
def tune_one_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three trials, recorded in a trials table at the same time and read back from it."""
    study = _study(spark, sf_dir, trials_path=f"{shared_folder(spark)}/study")
    study.run(n_trials=3, parallelism=3)
    again = study.run(n_trials=3)  # nothing is missing: the recorded trials come back
    return rounded(again.select("trial_id", "metric"), 9)


@register(FLOW_SQL + """
SELECT 2.0::DOUBLE AS num_leaves, 1.0::DOUBLE AS n_estimators, 1.0::DOUBLE AS min_child_samples,
       round(r, 9) AS scale_pos_weight, round(pr_auc, 9) AS metric
FROM metrics_t, rate_t WHERE g = 'val'
""")
def best_params_one_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best trial's parameters, written and read back."""
    best = best_trial(_study(spark, sf_dir).run(n_trials=2))
    folder = f"{shared_folder(spark)}/best"
    save_best_params(best, folder)
    params = load_best_params(spark, folder)
    names = ("num_leaves", "n_estimators", "min_child_samples", "scale_pos_weight")
    return rounded(best.select(*(F.lit(params[n]).alias(n) for n in names), "metric"), 9)


@register(FLOW_SQL + f""",
cells_t AS (SELECT split AS g, {CELLS_SQL} FROM scored_t GROUP BY 1),
wide_t AS (
  SELECT g, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, {F1_SQL} AS f1, pr_auc, roc_auc
  FROM cells_t JOIN metrics_t USING (g) WHERE g <> 'train')
SELECT 'metrics' AS section, g AS a, metric AS b, round("value", 9) AS "value"
FROM (UNPIVOT wide_t ON accuracy, f1, pr_auc, roc_auc INTO NAME metric VALUE "value")
UNION ALL SELECT 'confusion', t::VARCHAR, p::VARCHAR, count(y)::DOUBLE
FROM (SELECT unnest([0, 0, 1, 1]) AS t, unnest([0, 1, 0, 1]) AS p)
LEFT JOIN (SELECT * FROM scored_t WHERE split = 'test') ON y = t AND prediction = p GROUP BY t, p
UNION ALL SELECT 'importance', 'building', '', 1.0::DOUBLE
""")
def flow_one_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model flow from split to confusion matrix, with all results written."""
    done = model_panel(_panel(spark, sf_dir), T.VAL_START, T.TEST_START, n_trials=2,
                       space=ONE_SPLIT_SPACE, parallelism=2, output=shared_folder(spark))
    rows = done.metrics.select(F.lit("metrics").alias("section"), F.col("indicator").alias("a"),
                               F.col("metric").alias("b"), "value")
    cells = done.confusion.select(F.lit("confusion"), F.col("truth").cast("string"),
                                  F.col("predicted").cast("string"), F.col("n").cast("double"))
    used = done.importance.select(F.lit("importance"), "feature", F.lit(""),
                                  F.col("importance").cast("double"))
    return rounded(rows.union(cells).union(used), 9)
