"""Winsorizing at exact ranks, with stored caps."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.functions.columns import native_number, numeric_columns, ref
from riskpanel.operators.ranks import GATHER_ROWS, count_columns, values_at_ranks
from riskpanel.operators.scale import Bounds


@dataclass(frozen=True)
class Cap:
    """Caps of one column. ``fill`` replaces NULL; ``blank`` makes every value NULL.

    Caps that no double holds are whole numbers or decimals.
    """

    column: str
    low: float | int | Decimal | None = None
    high: float | int | Decimal | None = None
    fill: float | int | Decimal | None = None
    blank: bool = False


def fit_winsor(df: DataFrame, columns: list[str] | None = None, label_col: str = "Y",
               limits: tuple[float, float] = (0.05, 0.05), null_policy: str = "upper_cap",
               gather_rows: int = GATHER_ROWS) -> list[Cap]:
    """Caps for each numeric column except the label.

    ``upper_cap`` ranks NULLs as the largest values, counted among the rows: up
    to the upper limit they become the upper cap; beyond it they fill the whole
    upper tail, so no value is capped from above and NULL stays NULL. When even
    the lower cap's rank falls among them, the column becomes NULL throughout.
    ``ignore`` ranks the non-null values alone and leaves NULL as it is.
    """
    columns = numeric_columns(df, exclude=[label_col]) if columns is None else columns
    return fit_caps_and_bounds(df, columns, limits, null_policy, gather_rows)[0]


def fit_caps_and_bounds(df: DataFrame, columns: list[str],
                        limits: tuple[float, float] = (0.05, 0.05),
                        null_policy: str = "upper_cap",
                        gather_rows: int = GATHER_ROWS) -> tuple[list[Cap], list[Bounds]]:
    """Caps, and the min-max bounds of the capped values.

    The capped minimum and maximum follow from the caps and the raw ones, so
    scaling after winsorizing needs no pass of its own.
    """
    if null_policy not in ("upper_cap", "ignore"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    counts = count_columns(df, columns)
    tails: dict[str, tuple[int, int, int]] = {}
    ranks: dict[str, list[int]] = {}
    for c in columns:
        ranked = counts[c].rows if null_policy == "upper_cap" else counts[c].present
        lower, upper = int(limits[0] * ranked), int(limits[1] * ranked)
        tails[c] = (lower, upper, ranked)
        ranks[c] = [lower] * (lower > 0) + [ranked - upper - 1] * (upper > 0)
    values = values_at_ranks(df, counts, ranks, gather_rows)
    caps = [_cap(c, counts[c].present, *tails[c], values[c]) for c in columns]
    bounds = [_capped_bounds(cap, counts[cap.column].low, counts[cap.column].high)
              for cap in caps]
    return caps, bounds


def _capped_bounds(cap: Cap, low, high) -> Bounds:
    if cap.blank:
        return Bounds(cap.column, None, None)
    return Bounds(cap.column, low if cap.low is None else cap.low,
                  high if cap.high is None else cap.high)


def _cap(column: str, present: int, lower: int, upper: int, ranked: int,
         values: dict[int, float | None]) -> Cap:
    if lower > 0 and present <= lower:
        return Cap(column, blank=True)
    low = values[lower] if lower > 0 else None
    nulls = ranked - present
    if upper == 0 or nulls > upper:
        return Cap(column, low=low)
    high = values[ranked - upper - 1]
    return Cap(column, low=low, high=high, fill=high if nulls > 0 else None)


def _capped(df: DataFrame, cap: Cap) -> Column:
    data_type = df.schema[cap.column].dataType
    if cap.blank:
        return F.lit(None).cast(data_type)
    number = native_number(df, cap.column)
    branches: list[tuple[Column, Column]] = []
    if cap.low is not None:
        branches.append((number < F.lit(cap.low), F.lit(cap.low).cast(data_type)))
    if cap.high is not None:
        branches.append((number > F.lit(cap.high), F.lit(cap.high).cast(data_type)))
    if cap.fill is not None:
        branches.append((number.isNull(), F.lit(cap.fill).cast(data_type)))
    if not branches:
        return ref(cap.column)
    chain = F.when(*branches[0])
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(ref(cap.column))


def apply_winsor(df: DataFrame, caps: list[Cap]) -> DataFrame:
    """All caps in one projection; other columns pass through in place."""
    by_name = {c.column: c for c in caps}
    return df.select(*[_capped(df, by_name[c]).alias(c) if c in by_name else ref(c)
                       for c in df.columns])
