"""Average ranks of every row's values, many columns at once, without a global sort.

Equal values collapse with a map-side combine first. The distinct values are cut into ranges;
a range's first rank follows from the sizes of the ranges before it, so every range
is numbered on its own. The ranks go back to the rows by a join on the value; values that
many rows hold are few and are broadcast, so that no task gets all of their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.functions.columns import clean_number, numeric_columns, ref
from riskpanel.operators.correlation import correlation_matrix
from riskpanel.session import kept

#: Distinct values that may be broadcast with their ranks.
SMALL_VALUES = 1_000_000


def distinct_ranks(counted: DataFrame, parts: int) -> DataFrame:
    """``counted`` (slot, value, n) with the average ``rank`` of each slot's values: the
    middle of the places that its rows take, counted from 1."""
    ranges = kept(counted.repartitionByRange(parts, "slot", "value")
                  .withColumn("range", F.spark_partition_id()))
    # a row for each range and slot in it
    sizes = ranges.groupBy("slot", "range").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("slot").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("slot", "range", F.coalesce(F.sum("rows").over(before), F.lit(0))
                          .alias("start"))
    within = Window.partitionBy("slot", "range").orderBy("value").rowsBetween(
        Window.unboundedPreceding, -1)
    below = F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return ranges.join(F.broadcast(starts), ["slot", "range"]).select(
        "slot", "value", "n", (below + (F.col("n") + 1) / 2).alias("rank"))


def average_ranks(df: DataFrame, columns: list[str] | None = None,
                  small_values: int = SMALL_VALUES) -> DataFrame:
    """The table with each column replaced by its values' average ranks (double).

    Ranks count the present values of the column from 1, equal values share the
    mean of their places, and a missing value has no rank.
    """
    columns = numeric_columns(df) if columns is None else columns
    if not columns:
        return df
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c not in columns]
    # the row's number is written with the row, so it is the same whenever it is read
    table = kept(df.select(
        F.monotonically_increasing_id().alias("row"),
        *[ref(c).alias(f"r{i}") for i, c in enumerate(rest)],
        # adding zero turns minus zero into zero
        *[(clean_number(df, c) + F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(columns)]))
    cells = table.select("row", F.stack(F.lit(len(columns)), *[
        x for i in range(len(columns)) for x in (F.lit(i), F.col(f"x{i}"))]).alias("slot", "value")
    ).where("value IS NOT NULL")
    ranks = kept(distinct_ranks(cells.groupBy("slot", "value").agg(F.count("*").alias("n")), parts))
    held, rows = ranks.agg(F.count("*"), F.sum("n")).first()
    if held <= small_values:
        ranked = cells.join(F.broadcast(ranks.drop("n")), ["slot", "value"])
    else:
        # at most four values for each shuffle partition have that many rows
        often = rows // (4 * parts)
        hot = F.broadcast(ranks.where(F.col("n") > often).drop("n"))
        rare = ranks.where(F.col("n") <= often).drop("n")
        ranked = cells.join(hot, ["slot", "value"]).unionByName(
            cells.join(hot, ["slot", "value"], "left_anti").join(rare, ["slot", "value"]))
    found = ranked.groupBy("row").agg(*[
        F.max(F.when(F.col("slot") == i, F.col("rank"))).alias(f"x{i}")
        for i in range(len(columns))])
    joined = table.select("row", *[f"r{i}" for i in range(len(rest))]).join(found, "row", "left")
    place = {c: F.col(f"r{i}") for i, c in enumerate(rest)} | {
        c: F.col(f"x{i}") for i, c in enumerate(columns)}
    return joined.select(*[place[c].alias(c) for c in df.columns])


def rank_correlation(df: DataFrame, columns: list[str] | None = None,
                     digits: int | None = None) -> DataFrame:
    """Rows (col_x, col_y, corr): the correlation of the columns' average ranks.

    Ranks are those among all present values of a column; each pair uses the rows
    where both are present.
    """
    columns = numeric_columns(df) if columns is None else columns
    ranks = average_ranks(df.select(*[ref(c) for c in columns]), columns)
    return correlation_matrix(ranks, columns, digits)
