"""Summary statistics of numeric and date columns."""

from __future__ import annotations

import math
from datetime import datetime, timedelta
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import native_number, numeric_columns, ref, temporal_columns
from riskpanel.functions.dates import day_span, wall_micros
from riskpanel.operators.ranks import GATHER_ROWS, ColumnCount, count_columns, values_at_ranks

# The reported statistics in their order.
STATISTICS = ("count", "mean", "min", "25%", "50%", "75%", "max", "std")
QUARTILES = (0.25, 0.5, 0.75)


def date_range(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """One row (start, end): the day before the first date and the day after the last."""
    return df.agg(*day_span(ref(date_col)))


def exact_quantiles(df: DataFrame, columns: list[str], shares, gather_rows: int = GATHER_ROWS,
                    extra=None) -> tuple[dict[str, list], dict[str, ColumnCount]]:
    """Linearly interpolated quantiles: {column: [value per share]}, and the column counts
    with the results of any extra aggregates."""
    counts = count_columns(df, columns, extra)
    ranks = {c: [r for share in shares for r in _neighbours(counts[c].present, share)]
             for c in columns}
    values = values_at_ranks(df, counts, ranks, gather_rows)
    return {c: [_interpolate(values[c], counts[c].present, share) for share in shares]
            for c in columns}, counts


def _neighbours(present: int, share: float) -> tuple[int, ...]:
    if present == 0:
        return ()
    position = share * (present - 1)
    return math.floor(position), math.ceil(position)


def _interpolate(values: dict, present: int, share: float):
    """Between whole numbers or decimals the point is a fraction, so no digit is lost."""
    if present == 0:
        return None
    position = share * (present - 1)
    low, high = values[math.floor(position)], values[math.ceil(position)]
    part = position - math.floor(position)
    if isinstance(low, float):
        return low + (high - low) * part
    return Fraction(low) + (Fraction(high) - Fraction(low)) * Fraction(part)


def _statistics(df: DataFrame, numbers: list[str], dates: list[str],
                gather_rows: int) -> list[tuple]:
    """Rows (column, *STATISTICS) of numeric and date columns from shared passes.

    Dates are whole microseconds in these rows; their mean and quantiles are
    exact and rounded down.
    """
    columns = [native_number(df, c) for c in numbers] + [wall_micros(ref(c)) for c in dates]
    names = [f"v{i}" for i in range(len(columns))]
    values = df.select(*[x.alias(v) for x, v in zip(columns, names)])
    value, is_date = F.col("value"), F.col("slot") >= len(numbers)
    micros = F.sum(F.when(is_date, value.cast("decimal(20,0)")))
    quantiles, counts = exact_quantiles(values, names, QUARTILES, gather_rows, [
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.floor(micros / F.count(value)).cast("long").alias("middle")])
    rows = []
    for i, (c, v) in enumerate(zip(numbers + dates, names)):
        count, quartiles = counts[v], quantiles[v]
        mean, low, high, std = (count.extra.get("mean"), count.low, count.high,
                                count.extra.get("std"))
        if i >= len(numbers):
            mean, std = count.extra.get("middle"), None
            quartiles = [None if q is None else math.floor(q) for q in quartiles]
            low, high = (None if x is None else int(x) for x in (low, high))
        else:
            quartiles = [None if q is None else float(q) for q in quartiles]
            low, high = (None if x is None else float(x) for x in (low, high))
        rows.append((c, count.present, mean, low, *quartiles, high, std))
    return rows


def _statistics_schema(value_type: str) -> str:
    fields = ["column string", "`count` bigint"]
    fields += [f"`{s}` {value_type}" for s in STATISTICS[1:-1]]
    return ", ".join(fields + ["`std` double"])


def _moment(micros: int | None) -> datetime | None:
    return None if micros is None else datetime(1970, 1, 1) + timedelta(microseconds=micros)


def describe_numbers(df: DataFrame, columns: list[str] | None = None,
                     gather_rows: int = GATHER_ROWS) -> DataFrame:
    """One row per numeric column with the statistics of :data:`STATISTICS`."""
    columns = numeric_columns(df) if columns is None else columns
    rows = _statistics(df, columns, [], gather_rows)
    return df.sparkSession.createDataFrame(rows, _statistics_schema("double"))


def describe_dates(df: DataFrame, columns: list[str] | None = None,
                   gather_rows: int = GATHER_ROWS) -> DataFrame:
    """The same statistics of date columns, as timestamps; a date has no std."""
    columns = temporal_columns(df) if columns is None else columns
    rows = [(c, n, *map(_moment, moments), std)
            for c, n, *moments, std in _statistics(df, [], columns, gather_rows)]
    return df.sparkSession.createDataFrame(rows, _statistics_schema("timestamp_ntz"))


def describe(df: DataFrame, gather_rows: int = GATHER_ROWS) -> DataFrame:
    """The summary layout: one text row per statistic, one column per table column,
    numeric columns first and date columns after them."""
    numbers, dates = numeric_columns(df), temporal_columns(df)
    found = {c: dict(zip(STATISTICS, values))
             for c, *values in _statistics(df, numbers, dates, gather_rows)}
    for c in dates:
        moments = {s: _moment(found[c][s]) for s in STATISTICS[1:-1]}
        found[c].update(moments)
    rows = [(s, *[None if found[c][s] is None else str(found[c][s]) for c in numbers + dates])
            for s in STATISTICS]
    schema = T.StructType([T.StructField(c, T.StringType())
                           for c in ["statistic", *numbers, *dates]])
    return df.sparkSession.createDataFrame(rows, schema)
