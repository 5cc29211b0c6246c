"""Reading daily price series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskpanel.functions.columns import ref, require
from riskpanel.functions.dates import check_range, moment_literal


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """A price table with symbol, Date and Close, best partitioned by symbol."""
    return spark.read.parquet(path)


def price_series(prices: DataFrame, symbol: str, start, end, symbol_col: str = "symbol",
                 date_col: str = "Date") -> DataFrame:
    """One symbol's rows from start up to, but not including, end; none is an error."""
    require(prices, [symbol_col, date_col])
    first, last = check_range(start, end)
    data_type = prices.schema[date_col].dataType
    day = ref(date_col)
    found = prices.where((ref(symbol_col) == symbol)
                         & (day >= moment_literal(first, data_type))
                         & (day < moment_literal(last, data_type)))
    if found.isEmpty():
        raise ValueError(f"no prices for {symbol!r} from {first} to {last}")
    return found
