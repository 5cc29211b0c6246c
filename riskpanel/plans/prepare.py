"""From the raw panel to the prepared one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskpanel.functions.columns import numeric_columns, ref
from riskpanel.operators.attach import attach
from riskpanel.operators.describe import date_range, describe
from riskpanel.operators.encode import WIDE, OneHot, apply_one_hot, distinct_codes, fit_one_hot
from riskpanel.operators.rows import after_cutoff, keep_columns, split_label
from riskpanel.operators.scale import Bounds, apply_min_max
from riskpanel.operators.series import daily_returns, fill_calendar
from riskpanel.operators.sparse import Categories, apply_sparse, fit_categories
from riskpanel.operators.winsor import Cap, apply_winsor, fit_caps_and_bounds
from riskpanel.sources.outputs import save_summary
from riskpanel.sources.prices import price_series

# The default dates of the flow and the price symbol it joins.
CUTOFF = "2000-1-1"
VAL_START = "2016-1-1"
TEST_START = "2021-1-1"
SYMBOL = "BZ=F"
AUXILIARY = ("Date", "Close", "Return")


@dataclass(frozen=True)
class Preparation:
    """Everything fitted on the panel; transforms new rows the same way."""

    one_hot: OneHot | Categories
    caps: list[Cap]
    bounds: list[Bounds]
    start: str
    end: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Encode, cap and scale; without shuffles unless a long list of categories is joined."""
        return apply_min_max(apply_winsor(encoded(df, self.one_hot), self.caps), self.bounds)


def fit_encoding(df: DataFrame, category_col: str, encoding: str = "auto") -> OneHot | Categories:
    """A column for each category, or one sparse vector: ``auto`` takes the vector for more
    than :data:`WIDE` categories."""
    if encoding not in ("auto", "columns", "vector"):
        raise ValueError(f"unknown encoding {encoding!r}")
    if encoding == "auto":
        many = distinct_codes(df, category_col).limit(WIDE + 1).count() > WIDE
        encoding = "vector" if many else "columns"
    if encoding == "columns":
        return fit_one_hot(df, category_col)
    return fit_categories(df, [category_col])


def encoded(df: DataFrame, fitted: OneHot | Categories) -> DataFrame:
    """The table with its categories as columns, or as a vector ``<column>_categories``."""
    if isinstance(fitted, OneHot):
        return apply_one_hot(df, fitted)
    return apply_sparse(df, fitted, f"{fitted.columns[0]}_categories")


def price_flow(prices: DataFrame, symbol: str, start, end, symbol_col: str = "symbol") -> DataFrame:
    """One symbol's calendar from start to end with carried closes and returns."""
    series = price_series(prices, symbol, start, end, symbol_col)
    filled = daily_returns(fill_calendar(series, start, end, symbol_col), symbol_col)
    return keep_columns(filled, AUXILIARY)


def fit_preparation(df: DataFrame, category_col: str, label_col: str = "Y",
                    date_col: str = "Date", fit_on: DataFrame | None = None,
                    null_policy: str = "upper_cap", summary_path: str | None = None,
                    encoding: str = "auto") -> Preparation:
    """Fit categories, caps and bounds on the filtered panel, or on ``fit_on``.

    The bounds are those of the capped values, which the summary describes.
    """
    basis = df if fit_on is None else fit_on
    one_hot = fit_encoding(df, category_col, encoding)
    # categories are neither capped nor scaled
    plain = basis.drop(ref(category_col))
    caps, bounds = fit_caps_and_bounds(plain, numeric_columns(plain, exclude=[label_col]),
                                       null_policy=null_policy)
    span = date_range(df, date_col).first()
    if summary_path is not None:
        capped = apply_winsor(plain, caps)
        shown = [c for c in capped.columns if c != label_col]
        save_summary(describe(capped.select(*[ref(c) for c in shown])), summary_path)
    return Preparation(one_hot, caps, bounds, span["start"], span["end"])


def prepare_panel(panel: DataFrame, prices: DataFrame, category_col: str = "INDUSTRY2",
                  cutoff=CUTOFF, symbol: str = SYMBOL, label_col: str = "Y",
                  date_col: str = "Date", fit_on: str = "all", val_start=VAL_START,
                  test_start=TEST_START, null_policy: str = "upper_cap",
                  summary_path: str | None = None,
                  encoding: str = "auto") -> tuple[DataFrame, Preparation]:
    """Filter, encode, cap, scale and join the price series.

    ``fit_on="all"`` fits on every row after the cutoff; ``"train"`` fits caps
    and bounds on the training split alone. ``encoding`` is that of
    :func:`fit_encoding`. The joined price columns come last and are neither capped nor
    scaled.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"unknown fit_on {fit_on!r}")
    recent = after_cutoff(panel, cutoff, date_col)
    basis = None
    if fit_on == "train":
        basis = recent.where(split_label(recent, val_start, test_start, date_col) == "train")
    fitted = fit_preparation(recent, category_col, label_col, date_col, basis, null_policy,
                             summary_path, encoding)
    auxiliary = price_flow(prices, symbol, fitted.start, fitted.end)
    # the flow above checked that the series holds one row per day
    prepared = attach(fitted.transform(recent), auxiliary, [date_col], check_unique=False)
    return prepared, fitted
