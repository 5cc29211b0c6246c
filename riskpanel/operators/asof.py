"""The last value at or before a moment, by key, without a calendar.

Moments are cut into segments of equal length. Within a segment of a key one ordered pass
carries the last value on; a segment starts with the last value of the segments before
it, which one small row for each segment passes on. So a key with any number of rows is
as many tasks as it has segments, and a gap of any length costs nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.functions.columns import ref, require
from riskpanel.functions.dates import wall_micros
from riskpanel.functions.numbers import relative_change
from riskpanel.operators.attach import BROADCAST_BYTES, attach
from riskpanel.operators.series import DuplicateKeys
from riskpanel.session import kept

DAY = 86_400_000_000  # microseconds
#: Segments of the whole time range for each shuffle partition.
SEGMENTS = 4


def carried(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``rows`` (keys, _at, _value, where _value is NULL for moments that only ask) with

    ``_last``: the last (at, value) at or before the moment, and ``_before``: the last value
    strictly before it. ``width`` is the length of a segment in the unit of _at.
    """
    cut = kept(rows.withColumn("_segment", F.floor(F.col("_at") / width)))
    slot = [*[ref(k) for k in keys], F.col("_segment")]
    found = F.when(F.col("_value").isNotNull(), F.struct("_at", "_value"))
    # a value comes before the moments that ask for it
    upto = Window.partitionBy(*slot).orderBy("_at", F.col("_value").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*slot).orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    inside = cut.select("*", F.last(found, ignorenulls=True).over(upto).alias("_own"),
                        F.last("_value", ignorenulls=True).over(earlier).alias("_own_before"))
    # one row for each segment that has a value
    ends = cut.where("_value IS NOT NULL").groupBy(*slot).agg(
        F.max(F.struct("_at", "_value")).alias("_end"))
    segments = cut.select(*slot).distinct().join(ends, [*keys, "_segment"], "left")
    past = Window.partitionBy(*[ref(k) for k in keys]).orderBy("_segment").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = segments.select(*slot, F.last("_end", ignorenulls=True).over(past).alias("_start"))
    joined = inside.join(starts, [*keys, "_segment"], "left")
    return joined.select(
        *[ref(k) for k in keys], "_at", "_value", F.coalesce("_own", "_start").alias("_last"),
        F.coalesce("_own_before", "_start._value").alias("_before"))


def _moment(df: DataFrame, name: str) -> Column:
    return wall_micros(ref(name))


def attach_asof(df: DataFrame, prices: DataFrame, keys: list[str], date_col: str = "Date",
                close_col: str = "Close", return_col: str = "Return", start=None,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the last close at or before each row's moment and the change to it.

    The change is that from the day before: a close of the row's own day against the last
    one before, and zero on a day without a close. It is NULL before the first close,
    on its day, and after a close of zero. Closes before ``start`` do not count. One
    close for each key and moment is checked. Rows with a NULL key or moment get none.
    """
    require(df, [*keys, date_col])
    require(prices, [*keys, date_col, close_col])
    closes = prices.where(ref(close_col).isNotNull() & ref(date_col).isNotNull())
    if start is not None:
        closes = closes.where(ref(date_col) >= F.lit(start))
    closes = closes.select(*[ref(k) for k in keys], _moment(prices, date_col).alias("_at"),
                           ref(close_col).cast("double").alias("_value"))
    worst = closes.groupBy(*[ref(k) for k in keys], "_at").count().agg(F.max("count")).first()[0]
    if (worst or 0) > 1:
        raise DuplicateKeys(f"a key of {[*keys, date_col]} has {worst} rows")
    # each moment is asked for once, however many rows have it
    asked = df.where(ref(date_col).isNotNull()).select(
        *[ref(k) for k in keys], _moment(df, date_col).alias("_at")).distinct()
    rows = closes.unionByName(asked.withColumn("_value", F.lit(None).cast("double")))
    low, high = rows.agg(F.min("_at"), F.max("_at")).first()
    parts = SEGMENTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max((0 if low is None else high - low) // parts, 1)
    found = carried(rows, keys, width).where("_value IS NULL")
    same_day = F.floor(F.col("_last._at") / DAY) == F.floor(F.col("_at") / DAY)
    close = F.col("_last._value")
    lookup = kept(found.select(
        *[ref(k) for k in keys], F.col("_at").alias("_moment"), close.alias(close_col),
        relative_change(close, F.when(same_day, F.col("_before")).otherwise(close))
        .alias(return_col)))
    joined = attach(df.withColumn("_moment", _moment(df, date_col)), lookup, [*keys, "_moment"],
                    check_unique=False, broadcast_bytes=broadcast_bytes)
    return joined.drop("_moment")
