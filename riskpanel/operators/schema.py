"""Declared schema: coercion, and a report of every violated rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskpanel.functions.columns import quoted, ref


#: Holds the text of a row whose number of cells is not the header's.
CORRUPT = "__corrupt"
#: Numbers of the checks that an ingested row breaks.
#: Where a located row is from: its file and the start of its block there.
FILE, BLOCK = "__file", "__block"
DATE_TEXTS = ((r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"), (r"^[0-9]{8}$", "yyyyMMdd"))


@dataclass(frozen=True)
class ColumnRule:
    """One declared column: its Spark type, whether it may be NULL, and its domain."""

    name: str
    dtype: str
    nullable: bool = True
    allowed: tuple = ()


# The declared panel columns, their types and their nullability.
PANEL_RULES = (
    ColumnRule("CompNo", "string", nullable=False),
    ColumnRule("StkIndx", "double"),
    ColumnRule("STInt", "double", nullable=False),
    ColumnRule("dtdlevel", "double"),
    ColumnRule("dtdtrend", "double"),
    ColumnRule("liqnonfinlevel", "double"),
    ColumnRule("liqnonfintrend", "double"),
    ColumnRule("ni2talevel", "double"),
    ColumnRule("ni2tatrend", "double"),
    ColumnRule("sizelevel", "double"),
    ColumnRule("sizetrend", "double"),
    ColumnRule("m2b", "double"),
    ColumnRule("sigma", "double"),
    ColumnRule("DTDmedianNonFin", "double"),
    ColumnRule("Company_name", "string", nullable=False),
    ColumnRule("INDUSTRY2", "string"),
    ColumnRule("Date", "timestamp_ntz", nullable=False),
    ColumnRule("Y", "int", nullable=False, allowed=(0, 1)),
)


class SchemaViolation(ValueError):
    """The table breaks its declared schema; ``failures`` lists (column, check, rows)."""

    def __init__(self, failures: list[tuple[str, str, int]]):
        self.failures = failures
        super().__init__("; ".join(f"{c}: {k} failed on {n} rows" for c, k, n in failures))


def missing_columns(df: DataFrame, rules: tuple[ColumnRule, ...]) -> list[str]:
    return [r.name for r in rules if r.name not in df.columns]


def _coerced(rule: ColumnRule) -> Column:
    """The value in its declared type. A whole number may be written as ``1.0``; a date
    as month/day/year or as eight digits."""
    value = F.expr(f"try_cast({quoted(rule.name)} AS {rule.dtype})")
    if rule.dtype in ("int", "bigint"):
        number = F.expr(f"try_cast({quoted(rule.name)} AS double)")
        whole = F.when(number == F.floor(number), number)
        return F.coalesce(value, whole.try_cast(rule.dtype))
    if rule.dtype in ("date", "timestamp", "timestamp_ntz"):
        text = ref(rule.name).cast("string")
        other = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern)))
                 .cast(rule.dtype) for shape, pattern in DATE_TEXTS]
        return F.coalesce(*other, value)
    return value


def _clean(rule: ColumnRule) -> Column:
    value = _coerced(rule)
    if rule.dtype in ("double", "float"):
        return F.when(~F.isnan(value), value)
    return value


def coerce(df: DataFrame, rules: tuple[ColumnRule, ...] = PANEL_RULES) -> DataFrame:
    """Cast declared columns in one projection; other columns pass through in place.

    A value that does not convert becomes NULL, and so does NaN.
    """
    by_name = {r.name: r for r in rules}
    return df.select(*[_clean(by_name[c]).alias(c) if c in by_name else ref(c)
                       for c in df.columns if c != CORRUPT])


def _checks(df: DataFrame, rules: tuple[ColumnRule, ...]) -> list[tuple[str, str, Column]]:
    """(column, check, rows that break it) of every rule; a missing column has one check."""
    absent = set(missing_columns(df, rules))
    checks: list[tuple[str, str, Column]] = []
    if CORRUPT in df.columns:
        checks.append(("(row)", "cells", ref(CORRUPT).isNotNull()))
    for rule in rules:
        if rule.name in absent:
            continue
        raw, value = ref(rule.name), _clean(rule)
        checks.append((rule.name, "convertible", raw.isNotNull() & _coerced(rule).isNull()))
        if not rule.nullable:
            checks.append((rule.name, "not_null", value.isNull()))
        if rule.allowed:
            checks.append((rule.name, "in_domain",
                           value.isNotNull() & ~value.isin(*rule.allowed)))
    return checks


def violation_report(df: DataFrame, rules: tuple[ColumnRule, ...] = PANEL_RULES) -> DataFrame:
    """Rows (column, check, n_failed) for every rule, counted in one pass.

    Takes the table before coercion. A missing column fails its ``present``
    check once; its other checks are left out.
    """
    absent = set(missing_columns(df, rules))
    counters = [(r.name, "present", F.lit(int(r.name in absent)).cast("long")) for r in rules]
    counters += [(column, check, F.count_if(broken))
                 for column, check, broken in _checks(df, rules)]
    totals = df.agg(*[c.alias(f"k{i}") for i, (_, _, c) in enumerate(counters)])
    rows = F.array(*[
        F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"),
                 F.col(f"k{i}").cast("long").alias("n_failed"))
        for i, (column, check, _) in enumerate(counters)])
    return totals.select(F.inline(rows))


def validate(df: DataFrame, rules: tuple[ColumnRule, ...] = PANEL_RULES) -> DataFrame:
    """The coerced table, or :class:`SchemaViolation` naming every broken rule."""
    report = violation_report(df, rules).where("n_failed > 0").collect()
    if report:
        raise SchemaViolation([(r["column"], r["check"], r["n_failed"]) for r in report])
    return coerce(df, rules)


def ingest(df: DataFrame, path: str, rules: tuple[ColumnRule, ...] = PANEL_RULES) -> DataFrame:
    """The coerced table written as Parquet and read back, or :class:`SchemaViolation`.

    ``df`` is read once: the rows that break a check are counted while they are written.
    """
    report = ingest_report(df, path, rules).where("n_failed > 0").collect()
    if report:
        raise SchemaViolation([(r["column"], r["check"], r["n_failed"]) for r in report])
    return df.sparkSession.read.parquet(path)


def ingest_report(df: DataFrame, path: str,
                  rules: tuple[ColumnRule, ...] = PANEL_RULES) -> DataFrame:
    """Writes the coerced table as Parquet; the rows of :func:`violation_report`, observed
    on the way. A table that lacks columns is not written."""
    spark = df.sparkSession
    absent = set(missing_columns(df, rules))
    rows = [(r.name, "present", int(r.name in absent)) for r in rules]
    checks = _checks(df, rules)
    if not absent:
        # flags in front of the observation, so that it counts plain columns
        by_name = {r.name: r for r in rules}
        columns = [c for c in df.columns if c != CORRUPT]
        flags = [bad.alias(f"__broken{i}") for i, (_, _, bad) in enumerate(checks)]
        seen = Observation()
        clean = df.select(*[_clean(by_name[c]).alias(c) if c in by_name else ref(c)
                            for c in columns], *flags)
        counted = [F.count_if(F.col(f"__broken{i}")).alias(f"k{i}") for i in range(len(checks))]
        observed = clean.observe(seen, F.count(F.lit(1)).alias("rows"), *counted)
        observed.select(*[ref(c) for c in columns]).write.mode("overwrite").parquet(path)
        rows += [(column, check, seen.get[f"k{i}"] or 0)
                 for i, (column, check, _) in enumerate(checks)]
    return spark.createDataFrame(rows, "column string, check string, n_failed bigint")


def located_violations(df: DataFrame, rules: tuple[ColumnRule, ...] = PANEL_RULES) -> DataFrame:
    """Rows (file, block, column, check, n_failed): where the rows that break a check are.

    ``df`` is read from files and has the columns ``FILE`` and ``BLOCK``.
    One scan with a map-side combine; a file that breaks nothing has no row.
    """
    checks = _checks(df, rules)
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"))
                      for c, k, _ in checks])
    broken = F.filter(F.array(*[F.when(bad, F.lit(i)) for i, (_, _, bad) in enumerate(checks)]),
                      lambda i: i.isNotNull())
    counted = df.select(ref(FILE).alias("file"), ref(BLOCK).alias("block"),
                        F.explode(broken).alias("i")).groupBy("file", "block", "i").agg(
        F.count("*").alias("n_failed"))
    return counted.select("file", "block", names[F.col("i")]["column"].alias("column"),
                          names[F.col("i")]["check"].alias("check"), "n_failed")
