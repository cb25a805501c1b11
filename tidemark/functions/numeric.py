"""Numeric expressions (M1, M2, M7). Divisors are guarded: ANSI mode raises on x/0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Text that is a number (a cast alone also takes '1.5d' and '0x1p3').
NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf(inity)?|nan)\s*$"


def to_double(col: Column | str, source: T.DataType | None = None) -> Column:
    """M1: lenient text/number -> double; what is no number -> null.
    ``source`` is the column's type where it is known (numbers need no look at
    their text)."""
    c = _c(col)
    number = c.try_cast(T.DoubleType())
    if source is not None and not isinstance(source, T.StringType):
        return number
    return F.when(c.cast(T.StringType()).rlike(NUMBER), number)


def nan_to_null(col: Column | str) -> Column:
    """M7: NaN -> null (vendor frames carry NaN for missing values)."""
    return F.nanvl(_c(col), F.lit(None).cast(T.DoubleType()))


def scale(number: Column | str, factor: float) -> Column:
    """M2: unit scaling of a double."""
    return _c(number) * F.lit(float(factor))


def midpoint(a: Column | str, b: Column | str) -> Column:
    """M2: (a + b) / 2 of doubles."""
    return (_c(a) + _c(b)) / F.lit(2.0)


def spread(ask: Column | str, bid: Column | str) -> Column:
    """M2: ask - bid of doubles."""
    return _c(ask) - _c(bid)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """M2: num / den when den is neither null nor zero, else null."""
    d = _c(den)
    return F.when(d.isNotNull() & (d != F.lit(0.0)), _c(num) / d)
