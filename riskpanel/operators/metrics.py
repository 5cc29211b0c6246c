"""Exact evaluation of scored tables.

Tables carry a 0/1 label, a score and a hard prediction, and may be grouped by
columns with few values, such as the split.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import TEMPORAL_TYPES, ref, require
from riskpanel.functions.numbers import ratio, ratio_or_zero
from riskpanel.operators.ranks import shares_sql

ROWS_PER_BUCKET = 250_000
SAMPLE_ROWS = 4_000_000
SAMPLED_PER_BUCKET = 100


def class_ratio(df: DataFrame, label_col: str = "Y") -> DataFrame:
    """One row (negatives, positives, ratio): the positive class weight."""
    label = ref(label_col)
    counts = df.agg(F.count_if(label == 0).alias("negatives"),
                    F.count_if(label == 1).alias("positives"))
    return counts.select("*", ratio(F.col("negatives"), F.col("positives")).alias("ratio"))


def confusion_matrix(df: DataFrame, label_col: str = "Y", prediction_col: str = "prediction",
                     classes: tuple = (0, 1), by: tuple[str, ...] = ()) -> DataFrame:
    """Rows (truth, predicted, n) over the whole class grid, zero where empty.

    Counted as one aggregate per cell, so every cell exists in every group.
    """
    truth, predicted = ref(label_col), ref(prediction_col)
    grid = [(t, p) for t in classes for p in classes]
    counts = df.groupBy(*[ref(b) for b in by]).agg(
        *[F.count_if((truth == t) & (predicted == p)).alias(f"n{i}")
          for i, (t, p) in enumerate(grid)])
    cells = [F.struct(F.lit(t).alias("truth"), F.lit(p).alias("predicted"),
                      F.col(f"n{i}").alias("n")) for i, (t, p) in enumerate(grid)]
    return counts.select(*[ref(b) for b in by], F.inline(F.array(*cells)))


def accuracy(df: DataFrame, label_col: str = "Y", prediction_col: str = "prediction",
             by: tuple[str, ...] = ()) -> DataFrame:
    correct = (ref(label_col) == ref(prediction_col)).cast("double")
    return df.groupBy(*[ref(b) for b in by]).agg(F.avg(correct).alias("accuracy"))


def weighted_f1(df: DataFrame, label_col: str = "Y", prediction_col: str = "prediction",
                by: tuple[str, ...] = ()) -> DataFrame:
    """F1 of every class found among labels and predictions, weighted by label count."""
    keys = [ref(b) for b in by]
    cells = df.groupBy(*keys, ref(label_col).alias("_t"), ref(prediction_col).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    same = F.when(F.col("_t") == F.col("_p"), F.col("_n")).otherwise(0)
    roles = F.array(
        F.struct(F.col("_t").cast("double").alias("c"), F.col("_n").alias("support"),
                 F.lit(0).cast("long").alias("claimed"), same.cast("long").alias("hit")),
        F.struct(F.col("_p").cast("double").alias("c"), F.lit(0).cast("long").alias("support"),
                 F.col("_n").alias("claimed"), F.lit(0).cast("long").alias("hit")))
    per_class = cells.select(*keys, F.inline(roles)).groupBy(*keys, "c").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"),
        F.sum("hit").alias("hit"))
    f1 = ratio_or_zero(2 * F.col("hit"), F.col("support") + F.col("claimed"))
    return per_class.groupBy(*keys).agg(
        ratio(F.sum(f1 * F.col("support")), F.sum("support")).alias("f1"))


def average_precision(df: DataFrame, label_col: str = "Y", score_col: str = "score",
                      by: tuple[str, ...] = (), buckets: int | None = None) -> DataFrame:
    """Sum over distinct scores, highest first, of the recall gained times the precision."""
    return _ranked(df, label_col, score_col, None, by, buckets).select(
        *[ref(b) for b in by], "pr_auc")


def roc_auc(df: DataFrame, label_col: str = "Y", score_col: str = "score",
            by: tuple[str, ...] = (), buckets: int | None = None) -> DataFrame:
    """Share of positive-negative pairs ordered rightly, ties counting one half;
    NULL when a class is absent."""
    return _ranked(df, label_col, score_col, None, by, buckets).select(
        *[ref(b) for b in by], "roc_auc")


def evaluate(df: DataFrame, label_col: str = "Y", score_col: str = "score",
             prediction_col: str = "prediction", by: tuple[str, ...] = (),
             buckets: int | None = None) -> DataFrame:
    """Accuracy, weighted F1, average precision and ROC AUC from one grouped score table."""
    return _ranked(df, label_col, score_col, prediction_col, by, buckets).select(
        *[ref(b) for b in by], "accuracy", "f1", "pr_auc", "roc_auc")


def evaluate_long(df: DataFrame, label_col: str = "Y", score_col: str = "score",
                  prediction_col: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    """The same as rows (group columns, metric, value)."""
    wide = evaluate(df, label_col, score_col, prediction_col, by)
    return wide.unpivot([ref(b) for b in by], ["accuracy", "f1", "pr_auc", "roc_auc"],
                        "metric", "value")


def _score_bounds(df: DataFrame, buckets: int | None) -> list[float]:
    """Boundaries that cut all scores into parts of about equal size.

    They come from a sample and only balance the tasks; any boundaries give the
    same metrics. Rows that fit one task need none.
    """
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count("_score").alias("scored"),
                 F.count("_y").alias("labelled")).first()
    total = row["n"]
    if min(row["scored"], row["labelled"]) < total:
        raise ValueError("every row needs a label and a score")
    wanted = buckets or -(-total // ROWS_PER_BUCKET)
    if wanted <= 1 or total == 0:
        return []
    rate = min(max(SAMPLE_ROWS, SAMPLED_PER_BUCKET * wanted) / total, 1.0)
    sampled = df.where(F.rand(7) < rate) if rate < 1.0 else df
    grid = sampled.agg(F.expr(
        f"percentile_approx(_score, {shares_sql(wanted)}, {max(10 * wanted, 10_000)})")).first()[0]
    return sorted(set((grid or [])[1:-1]))


def _ranked(df: DataFrame, label_col: str, score_col: str, prediction_col: str | None,
            by: tuple[str, ...], buckets: int | None) -> DataFrame:
    """One row per group with all metrics.

    Equal scores collapse to one row first, so a frequent score is no burden.
    Score buckets with fixed boundaries spread the ordered pass over tasks; a
    bucket starts from the totals of its group's buckets above it. The join to those totals keeps the partitioning
    and order of the ordered pass, whatever the number of groups.
    """
    require(df, [label_col, score_col, *by])
    # a group value that may be NULL becomes a non-null pair, so a plain equi-join
    # matches it and infers no filter that would set the two branches apart
    keys = [k for i in range(len(by)) for k in (f"_k{i}", f"_null{i}")] or ["_k"]
    key_columns = [k for i, b in enumerate(by) for k in (
        F.coalesce(ref(b), _stand_in(df.schema[b].dataType)).alias(f"_k{i}"),
        ref(b).isNull().alias(f"_null{i}"))] or [F.lit(0).alias("_k")]
    hit = ref(prediction_col).cast("int") if prediction_col else F.lit(0)
    base = df.select(*key_columns, ref(label_col).cast("int").alias("_y"),
                     ref(score_col).cast("double").alias("_score"), hit.alias("_hat"))
    bounds = _score_bounds(base, buckets)
    bucket = F.lit(0)
    if bounds:
        cutter = Bucketizer(splits=[float("-inf"), *bounds, float("inf")],
                            inputCol="_score", outputCol="_part")
        base = cutter.transform(base)
        bucket = F.coalesce(F.col("_part").cast("int"), F.lit(-1))
    positive, claimed = F.col("_y") == 1, F.col("_hat") == 1
    slot = [*keys, "_bucket"]
    scores = base.groupBy(*keys, bucket.alias("_bucket"), "_score").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("pos"),
        F.count_if(claimed).alias("claimed"), F.count_if(positive & claimed).alias("hits"))

    inner = (Window.partitionBy(*slot).orderBy(F.desc("_score"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = ("n", "pos", "claimed", "hits")
    whole = Window.partitionBy(*keys)
    running = scores.select("*", F.sum("n").over(inner).alias("upto_n"),
                            F.sum("pos").over(inner).alias("upto_pos"))
    if bounds:
        # Both branches read every count of ``scores``, so they plan the same exchange
        # and Spark computes the grouped table once.
        above = whole.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
        offsets = scores.groupBy(*slot).agg(*[F.sum(c).alias(f"b_{c}") for c in counts]).select(
            *slot, F.coalesce(F.sum("b_n").over(above), F.lit(0)).alias("n_above"),
            F.coalesce(F.sum("b_pos").over(above), F.lit(0)).alias("pos_above"),
            *[F.sum(f"b_{c}").over(whole).alias(f"all_{c}") for c in counts])
        running = (running.join(offsets, slot)
                   .withColumn("upto_n", F.col("upto_n") + F.col("n_above"))
                   .withColumn("upto_pos", F.col("upto_pos") + F.col("pos_above")))
    else:
        running = running.select("*", *[F.sum(c).over(whole).alias(f"all_{c}") for c in counts])
    gained = F.col("pos").cast("double") * F.col("upto_pos") / F.col("upto_n")
    neg = F.col("n") - F.col("pos")
    negatives_below = (F.col("all_n") - F.col("all_pos")) - (F.col("upto_n") - F.col("upto_pos"))
    ordered = F.col("pos").cast("double") * (negatives_below + neg / 2.0)
    totals = running.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum("claimed").alias("claimed"),
        F.sum("hits").alias("hits"), F.sum(gained).alias("gained"),
        F.sum(ordered).alias("ordered"),
        *[F.max(f"all_{c}").alias(f"all_{c}") for c in ("n", "pos", "claimed", "hits")])
    groups = [F.when(~F.col(f"_null{i}"), F.col(f"_k{i}")).alias(b) for i, b in enumerate(by)]
    return totals.select(*groups, *_metrics())


def _stand_in(data_type: T.DataType) -> Column:
    """A value of the type, put where a group value is NULL."""
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, TEMPORAL_TYPES):
        return F.lit("1970-01-01").cast(data_type)
    return F.lit(0).cast(data_type)


def _metrics() -> list[Column]:
    n, pos, claimed, hits = (F.col(c) for c in ("n", "pos", "claimed", "hits"))
    all_n, all_pos, all_claimed, all_hits = (
        F.col(f"all_{c}") for c in ("n", "pos", "claimed", "hits"))
    right = 2 * all_hits + all_n - all_claimed - all_pos
    neg, rejected = n - pos, n - claimed
    f1_pos = ratio_or_zero(2 * hits, pos + claimed)
    f1_neg = ratio_or_zero(2 * (rejected - pos + hits), neg + rejected)
    return [ratio(right, all_n).alias("accuracy"),
            ratio(f1_pos * pos + f1_neg * neg, n).alias("f1"),
            F.coalesce(ratio(F.col("gained"), pos), F.lit(0.0)).alias("pr_auc"),
            ratio(F.col("ordered"), pos.cast("double") * neg).alias("roc_auc")]
