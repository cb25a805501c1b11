"""Date parsing and formatting expressions."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lit_date(value: _dt.date | str) -> Column:
    """A typed DATE literal (accepts a ``date`` or ISO text)."""
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast(T.DateType())


def lit_timestamp_ntz(value: _dt.datetime | str) -> Column:
    """A typed TIMESTAMP_NTZ literal (zone-free wall-clock time)."""
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.to_timestamp_ntz(F.lit(value))


def parse_date_text(text: Column) -> Column:
    """D1 over text: 8 characters -> ``yyyyMMdd``; containing '-' -> ``yyyy-M-d``;
    otherwise ``yyyy/M/d``. Text that does not parse fully gives null.

    The branch is chosen by the text's shape before parsing, so an
    eight-character dashed value such as ``2026-1-2`` takes the compact branch
    and yields null.
    """
    return (
        F.when(text.isNull(), F.lit(None).cast(T.DateType()))
        .when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))
        .when(text.contains("-"), F.try_to_date(text, "yyyy-M-d"))
        .otherwise(F.try_to_date(text, "yyyy/M/d"))
    )


def once(value: Column, of) -> Column:
    """``of(value)`` with ``value`` evaluated once a row, wherever Spark moves it:
    a filter below a projection has the projection's expression at every use."""
    return F.get(F.transform(F.array(value), of), 0)


def lenient_date(col: Column | str, source_type: T.DataType | None = None) -> Column:
    """A calendar date from a date, an instant, an integer or text.

    ``source_type`` is the input column's type (schema metadata); when it is
    unknown the value is treated as text.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(source_type, T.DateType):
        return c
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)):
        return to_calendar_date(c)
    if isinstance(source_type, T.NullType):
        return F.lit(None).cast(T.DateType())
    return parse_date_text(c.cast(T.StringType()))


def lenient_timestamp(col: Column | str, source_type: T.DataType | None = None) -> Column:
    """Zone-free timestamp; unparsable -> null."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(source_type, T.TimestampNTZType):
        return c
    if isinstance(source_type, T.NullType):
        return F.lit(None).cast(T.TimestampNTZType())
    return c.try_cast(T.TimestampNTZType())


def to_calendar_date(col: Column | str) -> Column:
    """Instant -> calendar date (lenient)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(T.DateType())


def date_to_text(col: Column | str, dashed: bool = False) -> Column:
    """D3: date -> ``yyyyMMdd`` (or ``yyyy-MM-dd``) text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd" if dashed else "yyyyMMdd")


def date_to_int(col: Column | str) -> Column:
    """D3: date -> integer ``yyyymmdd``."""
    return date_to_text(col).cast(T.IntegerType())


def month_key(col: Column | str) -> Column:
    """Storage partition key of a date: integer ``yyyymm``."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 100 + F.month(c)).cast(T.IntegerType())


# The shapes a date parameter may have.
PARAM_DATE = re.compile(r"(?P<y>\d{4})(?:(?P<sep>[-/])(?P<m>\d{1,2})(?P=sep)(?P<d>\d{1,2})|(?P<md>\d{4}))")


def parse_param_date(value) -> _dt.date:
    """A job parameter as a calendar date: dates and instants as they are,
    whole numbers and text by ``PARAM_DATE`` or the word ``today``. Another
    type is a TypeError, any other text a ValueError."""
    if isinstance(value, _dt.date):  # an instant is a date as well
        return _dt.date(value.year, value.month, value.day)
    if isinstance(value, bool) or not isinstance(value, (int, str)):
        raise TypeError(f"a date parameter can't be a {type(value).__name__}")
    text = str(value).strip()
    if text.casefold() == "today":
        return _dt.date.today()
    found = PARAM_DATE.fullmatch(text)
    if found:
        month, day = (found["md"][:2], found["md"][2:]) if found["md"] else (found["m"], found["d"])
        try:
            return _dt.date(int(found["y"]), int(month), int(day))
        except ValueError:
            pass  # a shape like a date, but no such day
    raise ValueError(f"not a date parameter: {value!r}")
