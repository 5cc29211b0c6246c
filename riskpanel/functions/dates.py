"""Calendar days and wall-clock arithmetic."""

from __future__ import annotations

from datetime import date, datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def parse_day(value: str | date | datetime) -> date:
    """One calendar day from a text such as ``2000-1-1`` (padding is optional)."""
    try:
        return pd.Timestamp(value).date()
    except (ValueError, TypeError) as exc:
        raise ValueError(f"not a date: {value!r}") from exc


def check_range(start, end) -> tuple[date, date]:
    """Both ends as days; the start may not lie after the end."""
    first, last = parse_day(start), parse_day(end)
    if first > last:
        raise ValueError(f"start {first} is after end {last}")
    return first, last


def moment_literal(value, data_type: T.DataType) -> Column:
    """A literal of the column's own type: with no cast on the column itself the
    comparison still reaches the file scan."""
    try:
        moment = pd.Timestamp(value).to_pydatetime()
    except (ValueError, TypeError) as exc:
        raise ValueError(f"not a date: {value!r}") from exc
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz").cast(data_type)


def wall_micros(column: Column) -> Column:
    """Microseconds since 1970-01-01 by the clock on the wall, for any temporal type."""
    day = F.unix_date(column.cast("date")).cast("long") * F.lit(MICROS_PER_DAY)
    clock = column.cast("timestamp_ntz")
    seconds = F.hour(clock) * 3600 + F.minute(clock) * 60
    micros = (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("long")
    return day + seconds.cast("long") * 1_000_000 + micros


def day_span(column: Column, days_before: int = 1, days_after: int = 1) -> list[Column]:
    """Aggregates: first day minus and last day plus the margins, as ``yyyy-MM-dd``."""
    first = F.date_sub(F.min(column).cast("date"), days_before)
    last = F.date_add(F.max(column).cast("date"), days_after)
    return [F.date_format(first, "yyyy-MM-dd").alias("start"),
            F.date_format(last, "yyyy-MM-dd").alias("end")]
