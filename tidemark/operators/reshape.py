"""Wide -> long price history.

Spark columns are flat, so a two-level header is written ``<a><sep><b>``
(``|`` by default): ticker-first (``NVDA|Close``) or field-first
(``Close|NVDA``); a single-level frame holds one ticker. The header layout is
read from the schema on the driver; the rows are reshaped with one
``inline`` of an array of per-ticker structs — a narrow, shuffle-free
projection, one output row per (input row, ticker).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import header_key
from tidemark.schema import HISTORY_COLUMNS, LANDING

HISTORY_SCHEMA = LANDING["history"]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def header_fields(columns: list[str], tickers: list[str], sep: str) -> tuple[str | None, dict[str, dict[str, str]]]:
    """The date column, and for each asked ticker its columns by field.

    A header with ``sep`` is a (ticker, field) pair in either order: the side
    that names an asked ticker is the ticker. Without any such header the
    whole frame belongs to the first asked ticker."""
    flat = [c for c in columns if sep not in c]
    date = next((c for c in flat if header_key(c) in ("date", "datetime")), None)
    found: dict[str, dict[str, str]] = {}
    if len(flat) == len(columns):
        rest = {header_key(c): c for c in flat if c != date}
        return date, {tickers[0]: rest} if tickers and rest else {}
    asked = set(tickers)
    for column in columns:
        one, _, two = column.partition(sep)
        for ticker, field in ((one, two), (two, one)):
            if two and ticker in asked:
                found.setdefault(ticker, {})[header_key(field)] = column
                break
    return date, {t: found[t] for t in dict.fromkeys(tickers) if t in found}


def wide_to_long(
    spark: SparkSession, wide: DataFrame, tickers, sep: str = "|"
) -> DataFrame:
    """Flatten a wide history into ``HISTORY_COLUMNS`` rows.

    Absent tickers are skipped; missing fields are null; the date column may
    be called Date or Datetime; no ticker present -> empty frame with schema.
    """
    tickers = [tickers] if isinstance(tickers, str) else list(tickers)
    date_col, per_ticker = header_fields(wide.columns, tickers, sep)
    if not per_ticker:
        return spark.createDataFrame([], HISTORY_SCHEMA)

    date_expr = (
        _q(date_col).try_cast(T.TimestampNTZType()) if date_col
        else F.lit(None).cast(T.TimestampNTZType())
    )
    structs = []
    for t, fields in per_ticker.items():
        values = [F.lit(t).alias("ticker"), date_expr.alias("date")]
        for name in HISTORY_COLUMNS[2:]:
            v = _q(fields[name]).try_cast(T.DoubleType()) if name in fields else F.lit(None)
            values.append(v.cast(T.DoubleType()).alias(name))
        structs.append(F.struct(*values))
    return wide.select(F.inline(F.array(*structs)))
