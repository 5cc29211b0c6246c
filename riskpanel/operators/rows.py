"""Row filters, date splits and column selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import numeric_columns, ref, require
from riskpanel.functions.dates import moment_literal

# Identifying columns that are not features.
NON_FEATURES = ("Company_name", "Date", "CompNo", "indicator")
SPLITS = ("train", "val", "test")


def _moments(df: DataFrame, date_col: str) -> tuple[Column, T.DataType]:
    """The date column and its type; a text column is read as dates."""
    data_type = df.schema[date_col].dataType
    if isinstance(data_type, T.StringType):
        return ref(date_col).cast("timestamp_ntz"), T.TimestampNTZType()
    return ref(date_col), data_type


def after_cutoff(df: DataFrame, cutoff, date_col: str = "Date") -> DataFrame:
    """Rows dated strictly after the cutoff; rows without a date drop out."""
    require(df, [date_col])
    day, data_type = _moments(df, date_col)
    return df.where(day > moment_literal(cutoff, data_type))


def split_label(df: DataFrame, val_start, test_start, date_col: str = "Date") -> Column:
    """``train`` before val_start, ``val`` before test_start, else ``test``;
    a row without a date is labelled ``test``."""
    day, data_type = _moments(df, date_col)
    first_val, first_test = (moment_literal(v, data_type) for v in (val_start, test_start))
    return (F.when(day < first_val, "train")
            .when((day >= first_val) & (day < first_test), "val")
            .otherwise("test"))


def with_split(df: DataFrame, val_start, test_start, date_col: str = "Date",
               split_col: str = "indicator") -> DataFrame:
    """The table with its split column; an existing one is replaced."""
    return df.withColumn(split_col, split_label(df, val_start, test_start, date_col))


def split_frames(df: DataFrame, split_col: str = "indicator") -> tuple[DataFrame, ...]:
    """Train, val and test frames; on a table written by split each reads its own folder."""
    return tuple(df.where(ref(split_col) == name) for name in SPLITS)


def drop_columns(df: DataFrame, columns=NON_FEATURES) -> DataFrame:
    """Drop named columns; an unknown name is an error."""
    require(df, columns)
    return df.drop(*columns)


def keep_columns(df: DataFrame, columns) -> DataFrame:
    """Keep the named columns in the given order, ignoring names the table lacks."""
    return df.select(*[ref(c) for c in columns if c in df.columns])


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*[ref(c) for c in numeric_columns(df)])


def feature_columns(df: DataFrame, label_col: str = "Y") -> list[str]:
    """Everything but the target, in table order."""
    require(df, [label_col])
    return [c for c in df.columns if c != label_col]


def hard_class(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability > F.lit(threshold), 1).otherwise(0)
