"""Pearson and rank correlation of every pair of numeric columns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.functions.columns import clean_number, numeric_columns
from riskpanel.functions.numbers import round_half_even
from riskpanel.operators.gram import Scale, exact_pairs, pair_correlations
from riskpanel.operators.ranks import ColumnCount, count_columns
from riskpanel.session import kept, workers_find_package


def correlation_matrix(df: DataFrame, columns: list[str] | None = None,
                       digits: int | None = None) -> DataFrame:
    """Rows (col_x, col_y, corr) for the full square.

    Each pair uses the rows where both are present; a column that is constant
    there has no correlation, not even with itself, and neither has a pair with an
    infinite value. One pass takes counts, means and bounds, one the sums of all pairs;
    a third one is for pairs that the shared shift does not suit.
    """
    columns = numeric_columns(df) if columns is None else columns
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "col_x string, col_y string, corr double")
    workers_find_package(spark)
    finite = F.when(F.abs("value") < math.inf, F.col("value"))
    counts = count_columns(df, columns, [F.avg(finite).alias("mean"), F.min(finite).alias("least"),
                                         F.max(finite).alias("most")])
    scales = [_scale(counts[c]) for c in columns]
    numbers = df.select(*[clean_number(df, c).alias(f"x{i}") for i, c in enumerate(columns)])
    lots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = kept(pair_correlations(numbers, scales, lots))
    doubtful = [tuple(r) for r in pairs.where("doubtful AND i < j").select(
        "i", "j", "mean_x", "mean_y").collect()]
    varies = F.array(*[F.lit(_varies(counts[c])) for c in columns])
    corr = F.when(F.col("i") < F.col("j"), F.col("corr")).otherwise(
        F.when(varies[F.col("i")], F.lit(1.0)))
    size = len(columns)
    grid = spark.range(size * size).select(
        F.expr(f"cast(id div {size} as int)").alias("i"), F.expr(f"cast(id % {size} as int)").alias("j"))
    # one row for a pair of columns on either side
    half = grid.where("i <= j").join(F.broadcast(pairs), ["i", "j"], "left").select(
        "i", "j", corr.alias("corr"))
    if doubtful:
        again = F.broadcast(exact_pairs(numbers, doubtful, scales).withColumnRenamed("corr", "c"))
        half = half.join(again, ["i", "j"], "left").select(
            "i", "j", F.coalesce("corr", "c").alias("corr"))

    # rounding may overshoot by the last bit; least() alone would skip NULL
    corr = F.when(F.col("corr").isNotNull(),
                  F.greatest(F.least(F.col("corr"), F.lit(1.0)), F.lit(-1.0)))
    corr = corr if digits is None else round_half_even(corr, digits)
    names = F.array(*[F.lit(c) for c in columns])
    both = F.array_distinct(F.array(F.struct(F.col("i").alias("x"), F.col("j").alias("y")),
                                    F.struct(F.col("j").alias("x"), F.col("i").alias("y"))))
    return half.select(F.inline(both), corr.alias("corr")).select(
        names[F.col("x")].alias("col_x"), names[F.col("y")].alias("col_y"), "corr")


def _scale(count: ColumnCount) -> Scale:
    low, high, mean = (count.extra.get(k) for k in ("least", "most", "mean"))
    if low is None:
        return Scale(0.0, 1.0)
    shift = mean if math.isfinite(mean) else low / 2 + high / 2
    width = max(high - shift, shift - low)
    return Scale(shift, width if 0 < width < math.inf else 1.0)


def _varies(count: ColumnCount) -> bool:
    """Whether a column has two values, all of them finite; a merged spread of equal values
    may not be zero."""
    return (count.low is not None and count.low < count.high
            and math.isfinite(count.low) and math.isfinite(count.high))
