"""Min-max scaling with stored bounds for every column."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.functions.columns import (clean_number, is_exact_type, native_number,
                                         numeric_columns, ref)


@dataclass(frozen=True)
class Bounds:
    column: str
    low: float | int | Decimal | None
    high: float | int | Decimal | None


def fit_min_max(df: DataFrame, columns: list[str] | None = None,
                label_col: str = "Y") -> list[Bounds]:
    """Minimum and maximum of each numeric column except the label, in one pass."""
    columns = numeric_columns(df, exclude=[label_col]) if columns is None else columns
    if not columns:
        return []
    numbers = [native_number(df, c) for c in columns]
    row = df.agg(*[F.min(x).alias(f"lo{i}") for i, x in enumerate(numbers)],
                 *[F.max(x).alias(f"hi{i}") for i, x in enumerate(numbers)]).first()
    return [Bounds(c, row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)]


def _scaled(df: DataFrame, bounds: Bounds) -> Column:
    number = clean_number(df, bounds.column)
    if bounds.low is None:
        return F.lit(None).cast("double")
    above = number - F.lit(float(bounds.low))
    if is_exact_type(df.schema[bounds.column].dataType) and not isinstance(bounds.low, float):
        # the difference is whole or a decimal, and may be wider than the column
        low = F.lit(Decimal(bounds.low)).cast(_wide(df, bounds.column))
        above = (ref(bounds.column).cast(_wide(df, bounds.column)) - low).cast("double")
    width = float(bounds.high - bounds.low)
    if width == 0:
        return F.when(number.isNotNull(), F.lit(0.0))
    return above / F.lit(width)


def _wide(df: DataFrame, name: str) -> str:
    scale = getattr(df.schema[name].dataType, "scale", 0)
    return f"decimal(38,{scale})"


def apply_min_max(df: DataFrame, fitted: list[Bounds]) -> DataFrame:
    """Map each column's fitted range to [0, 1]; NULL stays NULL and a constant
    column becomes 0. Values outside the fitted range are not clipped."""
    by_name = {b.column: b for b in fitted}
    return df.select(*[_scaled(df, by_name[c]).alias(c) if c in by_name else ref(c)
                       for c in df.columns])
