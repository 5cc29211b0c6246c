"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_summary(summary: DataFrame, path: str) -> None:
    """The summary statistics as one CSV file with a header; a few rows at most."""
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_processed(processed: DataFrame, path: str, split_col: str | None = "indicator") -> None:
    """The prepared table as Parquet, one folder per split, so that reading a split
    touches only its own files."""
    writer = processed.write.mode("overwrite")
    if split_col is not None:
        writer = writer.partitionBy(split_col)
    writer.parquet(path)


def save_best_params(best: DataFrame, path: str) -> None:
    """The best trial's parameters as one JSON object."""
    names = sorted(best.first()["params"])
    best.select(*[F.col("params")[n].alias(n) for n in names]).coalesce(1).write.mode(
        "overwrite").json(path)


def load_best_params(spark: SparkSession, path: str) -> dict[str, float]:
    return spark.read.json(path).first().asDict()


def save_profile(tables: dict[str, DataFrame], path: str) -> None:
    """Every section of a profile report as its own Parquet folder."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
