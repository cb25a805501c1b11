"""Landing scans (S1-S6): vendor files read with their field contract.

The vendor HTTP calls are not built; a landed file (or directory) with the
vendor's field list stands in for each call. Every scan reads with an
explicit schema (no inference), keeps the asked fields (``select``) and turns
call parameters into ``where`` predicates, so Catalyst pushes them into the
parquet reader. Vendor dates are text, mostly ``yyyymmdd`` but also dashed or
slashed; a window filters on the parsed date, and beside it on the text itself
in a form that prunes row groups.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import lenient_date, lit_date, lit_timestamp_ntz, parse_param_date
from tidemark.functions.numeric import nan_to_null
from tidemark.operators.store import ARRIVAL
from tidemark.operators.transforms import pct_to_fraction
from tidemark.schema import LANDING

# Feeds whose percent change becomes a fraction at scan.
FRACTION_FEEDS = {"fund_daily", "index_daily", "index_global"}
# The index job's three feeds (``api`` parameter).
INDEX_FEEDS = {"index_daily", "index_global", "fut_index_daily"}

MOST_YEARS = 40  # of a text filter with a term for each year; longer windows have one range


def read_landing(
    spark: SparkSession, path: str, dataset: str, fmt: str = "parquet", arrival: bool = False
) -> DataFrame:
    """Read landed files of ``dataset`` with its contract schema. ``arrival``
    (parquet) adds ``_arrival``, the order in which rows landed: by file time,
    file name and place in the file. Raw stores keep the last by it."""
    try:
        schema = LANDING[dataset]
    except KeyError:
        raise KeyError(f"Unknown landing dataset: {dataset}") from None
    rows = spark.read.schema(schema).format(fmt).load(path)
    if arrival:
        place = ("file_modification_time", "file_name", "row_index")
        rows = rows.withColumn(ARRIVAL, F.struct(*[F.col(f"_metadata.{c}") for c in place]))
    return nan_as_null(rows)


def nan_as_null(df: DataFrame) -> DataFrame:
    """M7: NaN -> null in every double column (vendor frames mark missing
    values with NaN). A projection, so filters still reach the scan."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    if not doubles:
        return df
    return df.select(*[
        nan_to_null(F.col(f"`{c}`")).alias(c) if c in doubles else F.col(f"`{c}`")
        for c in df.columns
    ])


def select_fields(df: DataFrame, fields=None) -> DataFrame:
    """Field choice: a comma-separated text or a list; None keeps all."""
    if not fields:
        return df
    if isinstance(fields, str):
        fields = [f.strip() for f in fields.split(",") if f.strip()]
    return df.select(*[F.col(f"`{f}`") for f in fields])


def where_equal(df: DataFrame, **params) -> DataFrame:
    """Call parameters as equality predicates; a None parameter is not a filter
    (a vendor call without that argument). A list value means ``isin``."""
    conds = []
    for name, value in params.items():
        if value is None:
            continue
        if isinstance(value, (list, tuple, set)):
            conds.append(F.col(name).isin(list(value)))
        else:
            conds.append(F.col(name) == F.lit(value))
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def _date_bound(df: DataFrame, col: str, value) -> Column:
    """A bound comparable with a date or instant column."""
    d = parse_param_date(value)
    if isinstance(df.schema[col].dataType, (T.TimestampNTZType, T.TimestampType)):
        return lit_timestamp_ntz(_dt.datetime.combine(d, _dt.time()))
    return lit_date(d)


def text_window(col: str, lo: _dt.date, hi: _dt.date) -> Column:
    """A filter on a text date column that the parquet reader can use: it keeps
    every accepted shape (``yyyymmdd``, ``yyyy-M-d``, ``yyyy/M/d``) of the days
    lo..hi, and of other days only dashed or slashed ones of the same years.
    The exact filter on the parsed date goes with it."""
    c = F.col(col)
    if hi.year - lo.year >= MOST_YEARS:  # all shapes of these years
        return (c >= F.lit(f"{lo.year:04d}-")) & (c < F.lit(f"{hi.year:04d}A"))
    keep = c.between(F.lit(f"{lo:%Y%m%d}"), F.lit(f"{hi:%Y%m%d}"))
    for year in range(lo.year, hi.year + 1):  # '-' and '/' sort before '0'
        keep = keep | ((c >= F.lit(f"{year:04d}-")) & (c < F.lit(f"{year:04d}0")))
    return keep


def where_days(df: DataFrame, col: str, lo: _dt.date | None, hi: _dt.date | None) -> DataFrame:
    """Rows whose ``col`` (date, instant or text in any accepted shape) is a
    day from ``lo`` to ``hi``, both included; None is no bound."""
    if lo is None and hi is None:
        return df
    if isinstance(df.schema[col].dataType, T.StringType):
        day, bound = lenient_date(F.col(col)), lit_date
        if lo is not None and hi is not None:
            df = df.where(text_window(col, lo, hi))
    else:
        day, bound = F.col(col), lambda d: _date_bound(df, col, d)
        if hi is not None and not isinstance(df.schema[col].dataType, T.DateType):  # all of the last day
            return where_days(df, col, lo, None).where(day < bound(hi + _dt.timedelta(days=1)))
    if lo is not None:
        df = df.where(day >= bound(lo))
    return df if hi is None else df.where(day <= bound(hi))


def where_window(df: DataFrame, col: str, start=None, end=None, trade_date=None) -> DataFrame:
    """Daily window: ``trade_date`` (one day) or ``start``..``end`` with both
    ends included (S2)."""
    if trade_date is not None:
        start = end = trade_date
    return where_days(df, col, None if start is None else parse_param_date(start),
                      None if end is None else parse_param_date(end))


def pct_to_fraction_at_scan(df: DataFrame, feed: str) -> DataFrame:
    """Percent -> fraction for the fund, index and global-index feeds only."""
    return pct_to_fraction(df) if feed in FRACTION_FEEDS else df


# ---------------------------------------------------------------- S1 ----------

def instrument_list(
    spark: SparkSession, path: str, dataset: str, fields=None, **params
) -> DataFrame:
    """stock_basic / etf_basic / index_basic / fut_basic with equality
    parameters (e.g. ``list_status='L'``, ``exchange=[...]``, ``market=...``)."""
    df = where_equal(read_landing(spark, path, dataset), **params)
    return select_fields(df, fields)


# ---------------------------------------------------------------- S2 / S3 -----

def daily_feed(
    spark: SparkSession,
    path: str,
    feed: str,
    ts_code=None,
    start=None,
    end=None,
    trade_date=None,
    exchange=None,
    fields=None,
) -> DataFrame:
    """A daily bar feed (daily, fund_daily, index_daily, index_global,
    fut_index_daily, fut_daily, fx_daily) over an inclusive window, with S6
    applied for the feeds that report a fraction."""
    return daily_frame(read_landing(spark, path, feed), feed, ts_code, start, end, trade_date,
                       exchange, fields)


def daily_frame(df: DataFrame, feed: str, ts_code=None, start=None, end=None,
                trade_date=None, exchange=None, fields=None) -> DataFrame:
    """S2 over an already-landed frame: parameters, window, S6, field choice."""
    df = where_equal(df, ts_code=ts_code, exchange=exchange if "exchange" in df.columns else None)
    df = where_window(df, "trade_date", start, end, trade_date)
    return select_fields(pct_to_fraction_at_scan(df, feed), fields)


def index_feed(spark: SparkSession, path: str, api: str, **kwargs) -> DataFrame:
    """S2 for the index job: ``api`` picks one of three feeds; unknown -> error."""
    if api not in INDEX_FEEDS:
        raise ValueError(f"Unsupported index api: {api!r}; expected one of {sorted(INDEX_FEEDS)}")
    return daily_feed(spark, path, api, **kwargs)


def special_treatment(
    spark: SparkSession, path: str, start=None, end=None, fields=None
) -> DataFrame:
    """S3: the daily special-treatment list over an inclusive window."""
    df = where_window(read_landing(spark, path, "stock_st"), "trade_date", start, end)
    return select_fields(df, fields)


# ---------------------------------------------------------------- S4 / S5 -----

def price_history(
    spark: SparkSession, path: str, tickers=None, start=None, end=None
) -> DataFrame:
    """Long-form price history. A ``date``-typed end is inclusive; a text
    end is exclusive (the vendor call's own convention)."""
    return history_window(read_landing(spark, path, "history"), tickers, start, end)


def history_window(df: DataFrame, tickers=None, start=None, end=None) -> DataFrame:
    """S4 over a landed frame: ticker list, start inclusive, end inclusive for
    a ``date`` value and exclusive for text (Q8)."""
    if tickers:
        df = df.where(F.col("ticker").isin([tickers] if isinstance(tickers, str) else list(tickers)))
    if start is not None:
        df = df.where(F.col("date") >= _date_bound(df, "date", start))
    if end is not None:
        d = parse_param_date(end)
        if not isinstance(end, str):
            d = d + _dt.timedelta(days=1)
        df = df.where(F.col("date") < _date_bound(df, "date", d))
    return df


def quote_search(spark: SparkSession, path: str, tickers=None, max_results=None) -> DataFrame:
    """Landed search candidates ``(ticker, rank, symbol, quoteType,
    exchange, shortname, shortname_1)``; ``max_results`` keeps the best ranks,
    the vendor call's own result cap (a feature of the call, not a sample)."""
    return search_results(read_landing(spark, path, "quotes"), tickers, max_results)


def search_results(df: DataFrame, tickers=None, max_results=None) -> DataFrame:
    """S5 over a landed frame."""
    if tickers:
        df = df.where(F.col("ticker").isin([tickers] if isinstance(tickers, str) else list(tickers)))
    if max_results is not None:
        df = df.where(F.col("rank") <= F.lit(int(max_results)))
    return df
