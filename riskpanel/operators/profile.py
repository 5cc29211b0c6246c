"""Table profile: the sections of a data report as DataFrames.

Sections of the same shape cover all columns together: numeric columns share one
aggregate, and sections on text values share one table of counted keys.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import (clean_number, is_exact_type, nan_to_null, native_number,
                                         numeric_columns, ref, require, temporal_columns,
                                         text_columns)
from riskpanel.functions.numbers import ratio
from riskpanel.operators import frequent
from riskpanel.operators.attach import attach
from riskpanel.operators.correlation import correlation_matrix
from riskpanel.operators.describe import exact_quantiles
from riskpanel.operators.ranks import GATHER_ROWS, long_numbers
from riskpanel.operators.row_ranks import rank_correlation
from riskpanel.session import kept

# Quantiles of the numeric section.
PROFILE_SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)
SMALL_ROWS = 1_000_000
EXACT_IN_DOUBLE = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)
MOST_DIGITS = 38
CUT_SHARES = (0.001, 0.05, None)


def _value(df: DataFrame, name: str) -> Column:
    return nan_to_null(ref(name), df.schema[name].dataType)


def _text(df: DataFrame, name: str) -> Column:
    value = _value(df, name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)
    return value.cast("string")


def _stacked(totals: DataFrame, structs: list[Column]) -> DataFrame:
    return totals.select(F.inline(F.array(*structs)))


def overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns by type, missing cells and their share."""
    columns = df.columns
    missing = sum((F.count_if(_value(df, c).isNull()) for c in columns), F.lit(0))
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), missing.alias("missing_cells"))
    counts = {"n_columns": len(columns), "n_numeric": len(numeric_columns(df)),
              "n_text": len(text_columns(df)), "n_dates": len(temporal_columns(df))}
    cells = F.col("n_rows") * F.lit(len(columns))
    return totals.select("n_rows", *[F.lit(v).alias(k) for k, v in counts.items()],
                         "missing_cells",
                         ratio(F.col("missing_cells"), cells).alias("missing_share"))


def distinct_counts(df: DataFrame, columns: list[str] | None = None,
                    exact: bool = True) -> DataFrame:
    """Rows (column, n_distinct): one sketch per column, or one exact shuffle for all."""
    columns = df.columns if columns is None else columns
    if exact:
        as_double = all(isinstance(df.schema[c].dataType, EXACT_IN_DOUBLE) for c in columns)
        values = number_counts(df, columns) if as_double else value_counts(df, columns)
        counted = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
        every = _stacked(df.sparkSession.range(1), [
            F.struct(F.lit(c).alias("column")) for c in columns])
        return every.join(F.broadcast(counted), "column", "left").select(
            "column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
    totals = df.agg(*[F.approx_count_distinct(_value(df, c)).alias(f"d{i}")
                      for i, c in enumerate(columns)])
    return _stacked(totals, [F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n_distinct"))
                             for i, c in enumerate(columns)])


def numeric_summary(df: DataFrame, columns: list[str] | None = None,
                    exact_distinct: bool = True) -> DataFrame:
    """One row per numeric column. Skewness and excess kurtosis are the population forms."""
    columns = numeric_columns(df) if columns is None else columns
    value = F.col("value")
    distinct = [] if exact_distinct else [F.approx_count_distinct(value).alias("n_distinct")]
    totals = long_numbers(df, columns).groupBy("slot").agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("n"),
        F.count_if(value == 0).alias("n_zeros"), F.count_if(value < 0).alias("n_negative"),
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"), F.var_samp(value).alias("variance"),
        F.sum(value).alias("sum"), _plain(F.skewness(value)).alias("skewness"),
        _plain(F.kurtosis(value)).alias("kurtosis"), *distinct)
    named = F.array(*[F.lit(c) for c in columns])[F.col("slot")]
    summary = totals.select(
        named.alias("column"), "n", (F.col("rows") - F.col("n")).alias("n_missing"), "n_zeros",
        "n_negative", "min", "max", "mean", "std", "variance",
        ratio(F.col("std"), F.col("mean")).alias("cv"), "sum", "skewness", "kurtosis",
        *(["n_distinct"] if distinct else []))
    if not exact_distinct:
        return summary
    return summary.join(F.broadcast(distinct_counts(df, columns)), "column")


def _plain(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def quantiles(df: DataFrame, columns: list[str] | None = None,
              gather_rows: int = GATHER_ROWS) -> DataFrame:
    """Exact 5/25/50/75/95 percent points, range, interquartile range and the median
    absolute deviation, one row per numeric column."""
    columns = numeric_columns(df) if columns is None else columns
    points, counts = exact_quantiles(df, columns, PROFILE_SHARES, gather_rows)
    away = df.select(*[_distance(df, c, points[c][2]).alias(f"x{i}")
                       for i, c in enumerate(columns)])
    names = [f"x{i}" for i in range(len(columns))]
    deviations, _ = exact_quantiles(away, names, (0.5,), gather_rows)
    rows = []
    for i, c in enumerate(columns):
        q, low, high = points[c], counts[c].low, counts[c].high
        spread = (None, None) if low is None else (high - low, q[3] - q[1])
        row = (*q, *spread, deviations[names[i]][0])
        rows.append((c, *(None if x is None else float(x) for x in row)))
    return df.sparkSession.createDataFrame(
        rows, "column string, p05 double, p25 double, p50 double, p75 double, p95 double, "
              "`range` double, iqr double, mad double")


def _distance(df: DataFrame, name: str, middle) -> Column:
    """How far the values are from a point; exact if the point is a fraction."""
    if middle is None:
        return F.lit(None).cast("double")
    if isinstance(middle, float):
        return F.abs(clean_number(df, name) - F.lit(middle))
    kind = df.schema[name].dataType
    if getattr(kind, "precision", 0) == MOST_DIGITS:
        return F.abs(clean_number(df, name) - F.lit(float(middle)))
    # a median lies on a value or half-way between two
    wide = T.DecimalType(MOST_DIGITS, getattr(kind, "scale", 0) + 1)
    with localcontext() as context:
        context.prec = 2 * MOST_DIGITS
        point = Decimal(middle.numerator) / Decimal(middle.denominator)
    return F.abs(ref(name).cast(wide) - F.lit(point).cast(wide)).cast(wide)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, value, n) over the non-null values of all columns, as text."""
    return _counted(df.select(*[_text(df, c).alias(c) for c in columns]), columns)


def number_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, value, n) over the non-null values of numeric columns, as doubles."""
    # adding zero turns minus zero into zero
    numbers = df.select(*[(clean_number(df, c) + F.lit(0.0)).alias(c) for c in columns])
    return _counted(numbers, columns)


def _counted(values: DataFrame, columns: list[str]) -> DataFrame:
    stacked = values.unpivot([], [ref(c) for c in columns], "column", "value")
    return (stacked.where("value IS NOT NULL").groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def _check_k(k: int) -> None:
    if k < 1:
        raise ValueError("k must be at least 1")


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 10,
               counts: DataFrame | None = None) -> DataFrame:
    """The k most frequent values of each text column, ties by value; see
    :mod:`riskpanel.operators.frequent`. ``counts`` are the columns' key counts, if known."""
    columns = text_columns(df) if columns is None else columns
    return frequent.top_values(df, columns, k, counts=counts).select(
        "column", "value", "n", "position")


def text_summary(df: DataFrame, columns: list[str] | None = None,
                 counts: DataFrame | None = None) -> DataFrame:
    """One row per text column with values: counts, distinct values, mode, and text lengths.

    Long texts are told apart by a 128-bit digest and their length.
    """
    columns = text_columns(df) if columns is None else columns
    counts = kept(frequent.key_counts(df, columns)) if counts is None else counts
    length = F.char_length("value")
    # as many rows as columns
    totals = frequent.stacked_texts(df, columns).groupBy("slot").agg(
        F.count("*").alias("n"), F.min(length).alias("min_length"),
        ratio(F.sum(length), F.count("*")).alias("mean_length"),
        F.max(length).alias("max_length"))
    distinct = counts.groupBy("slot").agg(F.count("*").alias("n_distinct"))
    modes = top_values(df, columns, 1, counts).select(
        "column", F.col("value").alias("mode"), F.col("n").alias("mode_count"))
    named = F.array(*[F.lit(c) for c in columns])[F.col("slot")]
    return (totals.join(F.broadcast(distinct), "slot").withColumn("column", named)
            .join(F.broadcast(modes), "column")
            .select("column", "n", "n_distinct", "mode", "mode_count", "min_length",
                    "mean_length", "max_length"))


def date_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per date column: count, missing, first, last and the days between."""
    columns = temporal_columns(df) if columns is None else columns
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggregates += [F.count(ref(c)).alias(f"n{i}"),
                       F.min(ref(c)).cast("timestamp_ntz").alias(f"first{i}"),
                       F.max(ref(c)).cast("timestamp_ntz").alias(f"last{i}")]
    return _stacked(df.agg(*aggregates), [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"),
                 (F.col("rows") - F.col(f"n{i}")).alias("n_missing"),
                 F.col(f"first{i}").alias("first"), F.col(f"last{i}").alias("last"),
                 F.date_diff(F.col(f"last{i}").cast("date"), F.col(f"first{i}").cast("date"))
                 .alias("days"))
        for i, c in enumerate(columns)])


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 10) -> DataFrame:
    """Rows (column, bin, low, high, n): equal-width bins, the last one closed.

    Infinite values have bins of their own, -1 and ``bins``, if there are any.
    """
    columns = numeric_columns(df) if columns is None else columns
    numbers = df.select(*[clean_number(df, c).alias(f"x{i}") for i, c in enumerate(columns)])
    finite = {i: F.when(F.abs(f"x{i}") < math.inf, F.col(f"x{i}")) for i in range(len(columns))}
    row = numbers.agg(*[F.min(x).alias(f"lo{i}") for i, x in finite.items()],
                      *[F.max(x).alias(f"hi{i}") for i, x in finite.items()],
                      *[F.count_if(F.col(f"x{i}") == end).alias(f"{name}{i}") for i in finite
                        for name, end in (("below", -math.inf), ("above", math.inf))]).first()
    slots, edges, infinite = [], [], []
    for i, c in enumerate(columns):
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        infinite += [(c, b, end, end, row[f"{name}{i}"]) for name, b, end in
                     (("below", -1, -math.inf), ("above", bins, math.inf)) if row[f"{name}{i}"]]
        if low is None:
            continue
        if high == low:
            slot = F.when(finite[i].isNotNull(), 0)
        else:
            share = (finite[i] - F.lit(low)) / F.lit(high - low)
            # least() would skip a NULL and put the missing values in the last bin
            slot = F.when(share.isNotNull(), F.least(F.floor(share * bins), F.lit(bins - 1)))
        slots.append(slot.cast("int").alias(c))
        edges += [(c, b, low + (high - low) * b / bins, low + (high - low) * (b + 1) / bins)
                  for b in range(bins)]
    spark = df.sparkSession
    shape = "column string, bin int, low double, high double"
    grid = spark.createDataFrame(edges, shape)
    ends = spark.createDataFrame(infinite, f"{shape}, n bigint")
    if not slots:
        return ends
    counted = (numbers.select(*slots)
               .unpivot([], [ref(e) for e in dict.fromkeys(e[0] for e in edges)], "column", "bin")
               .where("bin IS NOT NULL").groupBy("column", "bin")
               .agg(F.count(F.lit(1)).alias("n")))
    # both sides hold at most columns x bins rows
    return grid.join(F.broadcast(counted), ["column", "bin"], "left").select(
        "column", "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")).unionByName(ends)


def missing_counts(df: DataFrame) -> DataFrame:
    """Rows (column, n_missing, missing_share) in one pass."""
    totals = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(_value(df, c).isNull()).alias(f"m{i}")
                      for i, c in enumerate(df.columns)])
    return _stacked(totals, [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"),
                 ratio(F.col(f"m{i}"), F.col("rows")).alias("missing_share"))
        for i, c in enumerate(df.columns)])


def missing_correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Correlation of the columns' missing flags; never-missing columns have none."""
    columns = df.columns if columns is None else columns
    flags = df.select(*[_value(df, c).isNull().cast("double").alias(c) for c in columns])
    return correlation_matrix(flags, columns)


def _row_digest(df: DataFrame, columns: list[str]) -> list[Column]:
    """128 bits of a row; rows that differ may share them, equal rows always do."""
    return [F.xxhash64(F.lit(i), *[ref(c) for c in columns]).alias(f"__digest{i}")
            for i in range(2)]


def duplicate_rows(df: DataFrame, columns: list[str] | None = None,
                   k: int | None = None) -> DataFrame:
    """Rows that occur more than once with their count ``n``; the k most frequent if given.

    Digests are counted first. Only rows with a digest that occurs twice are compared as
    a whole.
    """
    columns = df.columns if columns is None else columns
    rows = df.select(*[ref(c) for c in columns], *_row_digest(df, columns))
    keys = ["__digest0", "__digest1"]
    twice = kept(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
                 .select(*keys))
    suspected = attach(rows, twice, keys, how="inner", check_unique=False)
    repeated = (suspected.groupBy(*[ref(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1"))
    if k is None:
        return repeated
    return repeated.orderBy(F.desc("n"), *[ref(c) for c in columns]).limit(k)


def duplicate_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: distinct repeated rows, and rows beyond the first of their kind."""
    return duplicate_rows(df, columns).agg(
        F.count(F.lit(1)).alias("n_repeated"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_surplus"))


def extremes(df: DataFrame, columns: list[str] | None = None, k: int = 5,
             small_rows: int = SMALL_ROWS, as_text: bool = False) -> DataFrame:
    """Rows (column, side, position, value, n): the k smallest and largest distinct
    values of each numeric column, at most 2 k rows per column.

    Values are told apart in their column's own type, and reported as doubles or, with
    ``as_text``, with every digit. On a table of more than ``small_rows`` rows only
    values beyond a sampled cut are grouped. A side that finds k distinct values there
    has found the right ones; any other is done again with a wider cut, at last with none.
    """
    _check_k(k)
    columns = numeric_columns(df) if columns is None else columns
    by_type: dict[str, list[str]] = {}
    for c in columns:
        kind = df.schema[c].dataType
        own = kind.simpleString() if is_exact_type(kind) else "double"
        by_type.setdefault(own, []).append(c)
    kept = []
    for kind, some in by_type.items():
        # adding zero turns minus zero into zero
        numbers = df.select(*[(native_number(df, c) + F.lit(0)).cast(kind).alias(c)
                              for c in some])
        kept += _extremes_of(numbers, some, k, small_rows)
    show = _digits_of if as_text else float
    return df.sparkSession.createDataFrame(
        [(*r[:3], show(r[3]), r[4]) for r in kept], "column string, side string, position int, "
        f"value {'string' if as_text else 'double'}, n bigint")


def _digits_of(value) -> str:
    return format(value, "f") if isinstance(value, Decimal) else str(value)


def _extremes_of(numbers: DataFrame, columns: list[str], k: int, small_rows: int) -> list[tuple]:
    """The extremes of columns of one type."""
    total = numbers.count()
    pending = {(c, side) for c in columns for side in ("smallest", "largest")}
    kept = []
    for share in CUT_SHARES if total > small_rows else CUT_SHARES[-1:]:
        open_columns = [c for c in columns if {(c, "smallest"), (c, "largest")} & pending]
        cuts = _cuts(numbers, open_columns, share, min(small_rows / max(total, 1), 1.0))
        found: dict[tuple[str, str], list] = {}
        for r in _beyond(numbers, cuts, k).collect():
            found.setdefault((r["column"], r["side"]), []).append(tuple(r))
        for side in sorted(pending):
            if share is None or len(found.get(side, ())) == k:
                kept += found.get(side, [])
                pending.discard(side)
        if not pending:
            break
    return kept


def _cuts(numbers: DataFrame, columns: list[str], share: float | None,
          rate: float) -> dict[str, tuple]:
    """Per column a low and a high cut near the given share of a sample from each end, or
    None for no cut."""
    if share is None:
        return {c: (None, None) for c in columns}
    drawn = numbers.where(F.rand() < rate)
    row = drawn.agg(*[F.percentile_approx(ref(c), [share, 1 - share], 10_000).alias(f"q{i}")
                      for i, c in enumerate(columns)]).first()
    return {c: tuple(row[f"q{i}"] or (None, None)) for i, c in enumerate(columns)}


def _beyond(numbers: DataFrame, cuts: dict[str, tuple], k: int) -> DataFrame:
    """The k outermost distinct values beyond the cuts, by column and side. Each task
    keeps only its own k per column and side before the last shuffle."""
    value = F.col("value")
    kind = numbers.schema[next(iter(cuts))].dataType
    low, high = (F.coalesce(F.create_map(*[
        x for c, ends in cuts.items() for x in (F.lit(c), F.lit(ends[i]).cast(kind))])
        [F.col("column")], value) for i in (0, 1))
    counted = (numbers.unpivot([], [ref(c) for c in cuts], "column", "value")
               .where(value.isNotNull() & ((value <= low) | (value >= high)))
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))

    def side(name: str, beyond: Column, order: Column) -> DataFrame:
        position = F.row_number().over(Window.partitionBy("column").orderBy(order))
        return (counted.where(beyond).withColumn("position", position)
                .where(F.col("position") <= k)
                .select("column", F.lit(name).alias("side"), "position", "value", "n"))

    return side("smallest", value <= low, F.asc("value")).unionByName(
        side("largest", value >= high, F.desc("value")))


def first_rows(df: DataFrame, k: int = 10) -> DataFrame:
    """Some rows, as the table's files give them."""
    return df.limit(k)


def sample_rows(df: DataFrame, order: list[str] | None = None, k: int = 10,
                seed: int = 0) -> DataFrame:
    """The first, the last and k random rows: ``sample`` and ``position`` before the columns.

    Rows are in the order of the columns ``order``, all if None, NULL first. The random
    ones have the smallest digests of seed and these columns, so they are the same
    however the table is split. Each task keeps its own k rows.
    """
    _check_k(k)
    order = df.columns if order is None else order
    require(df, order)
    keys = [ref(c) for c in order]
    told = F.md5(F.concat_ws(",", F.lit(str(seed)), *[
        F.coalesce(x.cast("string"), F.lit("\\N")) for x in keys]))
    ordered = {"first": [x.asc_nulls_first() for x in keys],
               "last": [x.desc_nulls_last() for x in keys],
               "random": [told.asc(), *[x.asc_nulls_first() for x in keys]]}
    out = None
    for name, by in ordered.items():
        some = df.orderBy(*by).limit(k)
        # k rows of one task, already in order
        found = some.select(F.lit(name).alias("sample"), F.row_number().over(
            Window.orderBy(*by)).alias("position"), *[ref(c) for c in df.columns])
        out = found if out is None else out.unionByName(found)
    return out


@dataclass(frozen=True)
class AlertLimits:
    """Thresholds of the alert rules."""

    missing_share: float = 0.05
    zero_share: float = 0.10
    skewness: float = 20.0
    correlation: float = 0.9
    imbalance_share: float = 0.9


def alerts(df: DataFrame, limits: AlertLimits = AlertLimits(),
           exact_distinct: bool = True, sections: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows (column, alert, value) for every rule that fires. ``sections`` are tables of
    :func:`profile_tables` that are known already."""
    numbers, texts = numeric_columns(df), text_columns(df)
    known = sections or {}
    missing = known["missing"] if "missing" in known else missing_counts(df)
    found = [missing.where(F.col("missing_share") > limits.missing_share).select(
        "column", F.lit("missing").alias("alert"), F.col("missing_share").alias("value"))]
    if numbers:
        summary = (known["numeric"] if "numeric" in known
                   else numeric_summary(df, numbers, exact_distinct))
        found.append(_numeric_alerts(summary, limits))
        pairs = known["correlation"] if "correlation" in known else correlation_matrix(df, numbers)
        found.append(pairs.where((F.col("col_x") != F.col("col_y"))
                                 & (F.abs("corr") > limits.correlation))
                     .groupBy(F.col("col_x").alias("column"))
                     .agg(F.max(F.abs("corr")).alias("value"))
                     .select("column", F.lit("high_correlation").alias("alert"), "value"))
    if texts:
        found.append(_text_alerts(known["text"] if "text" in known else text_summary(df, texts),
                                  limits))
    result = found[0]
    for extra in found[1:]:
        result = result.unionByName(extra)
    return result


def _rules(summary: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    fired = F.array_compact(F.array(*[
        F.when(condition, F.struct(F.lit(name).alias("alert"),
                                   value.cast("double").alias("value")))
        for name, condition, value in rules]))
    return summary.select("column", F.inline(fired))


def _numeric_alerts(summary: DataFrame, limits: AlertLimits) -> DataFrame:
    zero_share = ratio(F.col("n_zeros"), F.col("n") + F.col("n_missing"))
    return _rules(summary, [
        ("constant", F.col("n_distinct") == 1, F.col("n_distinct")),
        ("unique", (F.col("n_distinct") == F.col("n")) & (F.col("n") > 1), F.col("n_distinct")),
        ("zeros", zero_share > limits.zero_share, zero_share),
        ("skewed", F.abs("skewness") > limits.skewness, F.col("skewness"))])


def _text_alerts(summary: DataFrame, limits: AlertLimits) -> DataFrame:
    top_share = ratio(F.col("mode_count"), F.col("n"))
    return _rules(summary, [
        ("constant", F.col("n_distinct") == 1, F.col("n_distinct")),
        ("unique", (F.col("n_distinct") == F.col("n")) & (F.col("n") > 1), F.col("n_distinct")),
        ("imbalance", (F.col("n_distinct") > 1) & (top_share > limits.imbalance_share),
         top_share)])


def profile_tables(df: DataFrame, k: int = 10, bins: int = 10) -> dict[str, DataFrame]:
    """Every section of the report by name.

    What several sections need is computed once and kept: the counts of text keys for
    distinct values, modes and top values; the summaries, missing counts and
    correlations for their own sections and the alerts.
    """
    numbers, texts, dates = numeric_columns(df), text_columns(df), temporal_columns(df)
    tables = {"overview": overview(df), "missing": kept(missing_counts(df)),
              "missing_correlation": missing_correlation(df),
              "duplicates": duplicate_rows(df, k=k), "sample": sample_rows(df, k=k)}
    if numbers:
        tables.update(numeric=kept(numeric_summary(df, numbers)), quantiles=quantiles(df, numbers),
                      histogram=histogram(df, numbers, bins),
                      extremes=extremes(df, numbers, k, as_text=True),
                      correlation=kept(correlation_matrix(df, numbers)),
                      rank_correlation=rank_correlation(df, numbers))
    if texts:
        counts = kept(frequent.key_counts(df, texts))
        tables.update(text=kept(text_summary(df, texts, counts)),
                      top_values=top_values(df, texts, k, counts))
    if dates:
        tables["dates"] = date_summary(df, dates)
    tables["alerts"] = alerts(df, sections=tables)
    return tables
