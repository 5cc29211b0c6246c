"""Reading the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import ref
from riskpanel.operators.schema import BLOCK, CORRUPT, FILE, PANEL_RULES, ColumnRule, ingest

# Texts that mean a missing value in a CSV cell.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                 "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                 "nan", "null")


def read_panel_csv(spark: SparkSession, path: str, located: bool = False) -> DataFrame:
    """All columns as text, by the header's names, with missing texts as NULL.

    Types come from the declared schema afterwards; nothing is inferred from the
    data. All files of a folder have to have the same header, which is checked
    file by file. A row with more or fewer cells than the header keeps its text
    in ``CORRUPT``, which the validation reports.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    raw = (reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
           .option("enforceSchema", False).option("columnPruning", False).csv(path))
    return raw.select(*[F.when(~ref(c).isin(*MISSING_TEXTS), ref(c)).alias(c) for c in names],
                      CORRUPT, *([F.col("_metadata.file_path").alias(FILE),
                                  F.col("_metadata.file_block_start").alias(BLOCK)]
                                 if located else []))


def ingest_panel(spark: SparkSession, csv_path: str, table_path: str,
                 rules: tuple[ColumnRule, ...] = PANEL_RULES) -> DataFrame:
    """Validate a CSV panel and keep it as Parquet, where date filters and column
    lists reach the scan. The CSV is read once."""
    return ingest(read_panel_csv(spark, csv_path), table_path, rules)


def read_panel(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.parquet(table_path)
