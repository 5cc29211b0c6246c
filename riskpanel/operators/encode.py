"""One-hot encoding with stored categories, a column for each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.functions.columns import ref, require

#: Categories that may become columns of their own.
WIDE = 1_000


@dataclass(frozen=True)
class OneHot:
    """The sorted categories of one column; a category gets column ``<column>_<category>``."""

    column: str
    categories: tuple[str, ...]

    def names(self) -> list[str]:
        """One per category; Spark ignores case, so a name that differs only in case from
        an earlier one gets a number."""
        seen: dict[str, int] = {}
        out = []
        for c in self.categories:
            name = f"{self.column}_{c}"
            n = seen[name.lower()] = seen.get(name.lower(), 0) + 1
            while n > 1 and f"{name}_{n}".lower() in seen:
                n += 1
            out.append(name if n == 1 else f"{name}_{n}")
            seen.setdefault(out[-1].lower(), 1)
        return out


def distinct_codes(df: DataFrame, column: str) -> DataFrame:
    return df.select(code_of(column).alias("code")).where("code IS NOT NULL").distinct()


def code_of(column: str) -> Column:
    """The category as text; a code that was once read as a float loses its ``.0``."""
    return F.regexp_replace(ref(column).cast("string"), r"\.0$", "")


def fit_one_hot(df: DataFrame, column: str, max_categories: int = WIDE) -> OneHot:
    """The distinct categories; every one becomes a column. More than ``max_categories``
    are an error: :mod:`riskpanel.operators.sparse` encodes any number of them."""
    require(df, [column])
    found = distinct_codes(df, column).limit(max_categories + 1).collect()
    if len(found) > max_categories:
        raise ValueError(f"{column} has more than {max_categories} categories")
    return OneHot(column, tuple(sorted(r["code"] for r in found)))


def apply_one_hot(df: DataFrame, fitted: OneHot) -> DataFrame:
    """Replace the column by one boolean per category, appended after the others;
    NULL and unseen categories are false everywhere."""
    rest = [c for c in df.columns if c != fitted.column]
    taken = {c.lower() for c in rest}
    clash = {c for c in fitted.names() if c.lower() in taken}
    if clash:
        raise ValueError(f"columns already exist: {sorted(clash)}")
    flags = [F.coalesce(code_of(fitted.column) == F.lit(category), F.lit(False)).alias(name)
             for category, name in zip(fitted.categories, fitted.names())]
    return df.select(*[ref(c) for c in rest], *flags)
