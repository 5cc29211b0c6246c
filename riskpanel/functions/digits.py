"""Whole numbers and decimals as short digits that a double holds, in an order that is theirs.

A value is the sum of its digits times powers of a base, all with the value's own sign.
Cutting towards zero keeps the order, so comparing digits from the first on is
comparing values.
"""

from __future__ import annotations

from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import ref

#: Whole numbers up to this one are doubles.
EXACT = 1 << 53
#: Decimals with at most so many digits are told apart by their doubles.
SAFE_PRECISION = 15
#: Decimals with more places are ranked by their doubles.
MOST_PLACES = 17
BITS = 26
DIGITS = 13


def may_be_beyond(kind: T.DataType, largest: float) -> bool:
    """Whether the doubles of a column, the largest given, may not tell its values apart."""
    if isinstance(kind, T.LongType):
        return largest >= EXACT
    return (isinstance(kind, T.DecimalType) and kind.precision > SAFE_PRECISION
            and kind.scale <= MOST_PLACES)


def beyond_double(kind: T.DataType, low, high) -> bool:
    if isinstance(kind, T.LongType):
        return max(abs(low), abs(high)) > EXACT
    return max(abs(low), abs(high)).scaleb(kind.scale) >= 10 ** SAFE_PRECISION


def _whole(kind: T.DecimalType) -> int:
    """Digits of 10^DIGITS that the whole part of a decimal takes."""
    return max(-(-(kind.precision - kind.scale) // DIGITS), 1)


def _split(value: Column, parts: int) -> list[Column]:
    """A whole decimal as digits to the base 10^DIGITS, the first one first."""
    base = F.lit(Decimal(10 ** DIGITS))
    out = []
    for _ in range(parts - 1):
        last = value % base
        out.append(last.cast("double"))
        # nothing is left over, so the quotient is whole
        value = ((value - last) / base).cast("decimal(38,0)")
    return [value.cast("double"), *reversed(out)]


def digits(df: DataFrame, name: str) -> list[Column]:
    """The digits of a whole-number or decimal column as doubles."""
    kind, value = df.schema[name].dataType, ref(name)
    if isinstance(kind, T.LongType):
        base = F.lit(1 << BITS).cast("long")
        last = value % base
        return [((value - last) / base).cast("double"), last.cast("double")]
    one = F.lit(Decimal(1))
    places = value % one
    out = _split((value - places).cast("decimal(38,0)"), _whole(kind))
    if kind.scale:
        scaled = places.cast(T.DecimalType(kind.scale + 1, kind.scale)) * F.lit(
            Decimal(10 ** kind.scale))
        out += _split(scaled.cast("decimal(38,0)"), -(-kind.scale // DIGITS))
    return out


def from_digits(kind: T.DataType, found: tuple[float, ...]) -> int | Decimal:
    """The value that the digits are of."""
    if isinstance(kind, T.LongType):
        return (int(found[0]) << BITS) + int(found[1])
    cut = _whole(kind)
    value, places = 0, 0
    for d in found[:cut]:
        value = value * 10 ** DIGITS + int(d)
    for d in found[cut:]:
        places = places * 10 ** DIGITS + int(d)
    with localcontext() as context:
        context.prec = 60
        return Decimal(value * 10 ** kind.scale + places).scaleb(-kind.scale)
