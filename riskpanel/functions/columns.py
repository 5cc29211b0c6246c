"""Column references and schema-driven column lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """A column by its literal name; dots and spaces are not parsed."""
    return F.col(quoted(name))


def require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Number-typed columns in table order; booleans are not numbers."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def temporal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TEMPORAL_TYPES)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def nan_to_null(column: Column, data_type: T.DataType) -> Column:
    """NaN is a missing value here; Spark's aggregates would count it."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    return column


def clean_number(df: DataFrame, name: str) -> Column:
    """A numeric column as double with NaN read as NULL."""
    data_type = df.schema[name].dataType
    return nan_to_null(ref(name), data_type).cast("double")


def is_exact_type(data_type: T.DataType) -> bool:
    """Whether a column may hold numbers that no double holds."""
    return isinstance(data_type, (T.LongType, T.DecimalType))


def native_number(df: DataFrame, name: str) -> Column:
    """A numeric column in a type that tells all its values apart; NaN is read as NULL."""
    data_type = df.schema[name].dataType
    return ref(name) if is_exact_type(data_type) else clean_number(df, name)
