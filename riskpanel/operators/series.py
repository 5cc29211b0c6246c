"""Daily price series: calendar gap-filling and returns, by symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.functions.columns import ref, require
from riskpanel.functions.dates import check_range
from riskpanel.functions.numbers import relative_change


class DuplicateKeys(ValueError):
    """A table that must hold one row per key holds several."""


def _one_row_per_day(prices: DataFrame, keys: list[str]) -> None:
    worst = prices.groupBy(*[ref(k) for k in keys]).count().agg(F.max("count")).first()[0]
    if (worst or 0) > 1:
        raise DuplicateKeys(f"a key of {keys} has {worst} rows")


def fill_calendar(prices: DataFrame, start, end, symbol_col: str = "symbol",
                  date_col: str = "Date", check_unique: bool = True) -> DataFrame:
    """One row per symbol and calendar day from start to end, both included; price
    columns are NULL on days without a trade.

    Each traded day is expanded up to the symbol's next one, so the calendar
    costs one shuffle by symbol and no join. With one row per symbol and day,
    which is checked, a symbol's window is bounded by the calendar.
    """
    require(prices, [symbol_col, date_col])
    first, last = check_range(start, end)
    values = [c for c in prices.columns if c not in (symbol_col, date_col)]
    daily = prices.select(ref(symbol_col).alias(symbol_col),
                          ref(date_col).cast("date").alias(date_col), *[ref(c) for c in values])
    if check_unique:
        _one_row_per_day(daily, [symbol_col, date_col])
    inside = daily.where(ref(date_col).between(F.lit(first), F.lit(last)))
    by_symbol = Window.partitionBy(ref(symbol_col)).orderBy(ref(date_col))
    following = F.coalesce(F.lead(ref(date_col)).over(by_symbol),
                           F.date_add(F.lit(last), 1))
    leading = F.lag(ref(date_col)).over(by_symbol).isNull() & (ref(date_col) > F.lit(first))
    marked = inside.select("*", following.alias("_next"), leading.alias("_leading"))
    to_next = F.sequence(ref(date_col), F.date_sub(F.col("_next"), 1))
    before = F.sequence(F.lit(first), F.date_sub(ref(date_col), 1))
    days = F.when(F.col("_leading"), F.concat(before, to_next)).otherwise(to_next)
    expanded = marked.withColumn("_day", F.explode(days))
    traded = F.col("_day") == ref(date_col)
    return expanded.select(ref(symbol_col), F.col("_day").alias(date_col),
                           *[F.when(traded, ref(c)).alias(c) for c in values])


def daily_returns(filled: DataFrame, symbol_col: str = "symbol", date_col: str = "Date",
                  close_col: str = "Close", return_col: str = "Return") -> DataFrame:
    """Carry the last close forward and add its relative change from the day before.

    Only the close is carried; days before a symbol's first close stay NULL, and
    so does a change from a close of zero.
    """
    require(filled, [symbol_col, date_col, close_col])
    by_symbol = Window.partitionBy(ref(symbol_col)).orderBy(ref(date_col))
    so_far = by_symbol.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = filled.withColumn(close_col, F.last(ref(close_col), ignorenulls=True).over(so_far))
    previous = F.lag(ref(close_col)).over(by_symbol)
    return carried.withColumn(return_col, relative_change(ref(close_col), previous))
