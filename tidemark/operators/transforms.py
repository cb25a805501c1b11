"""Dataset transforms: the fourteen vendor -> canonical mappings (P1-P14),
the percent -> fraction scan rule (S6) and previous close / change (N1, N2).

Every mapping keeps the landing columns, overrides or adds the mapped ones
(vendor columns with a canonical name pass through) and then conforms to the
target table, which drops the rest and types everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import to_calendar_date
from tidemark.functions.numeric import midpoint, safe_ratio, scale, spread, to_double
from tidemark.functions.text import regex_group
from tidemark.operators.conform import conform
from tidemark.operators.universe import valid_only
from tidemark import schema as S

TUSHARE = "tushare"
FRACTION_MARK = "tidemark.pct_chg_is_fraction"
YFINANCE = "yfinance"

# FX reference patterns (exchange = text after the last dot,
# currency = letters 4-6 of a six-letter pair).
FX_EXCHANGE_PATTERN = r"\.([^.]+)$"
FX_CURRENCY_PATTERN = r"^[A-Z]{3}([A-Z]{3})"
FX_QUOTES = [
    "bid_open", "bid_high", "bid_low", "bid_close",
    "ask_open", "ask_high", "ask_low", "ask_close",
]


def _now(updated_at: Column | None) -> Column:
    # One value per query: localtimestamp() is folded once by the optimizer.
    return updated_at if updated_at is not None else F.localtimestamp()


def _ids(df: DataFrame, source_id: str = TUSHARE, code: str = "ts_code") -> dict:
    return {
        "instrument_id": F.col(code),
        "source_code": F.col(code),
        "source_id": F.lit(source_id),
    }


def _col_or_null(df: DataFrame, name: str, dtype=T.DoubleType()) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def _number(df: DataFrame, name: str) -> Column:
    """A vendor number as a lenient double; null when the landed file lacks it."""
    return to_double(F.col(name), df.schema[name].dataType) if name in df.columns else _col_or_null(df, name)


def _v(df: DataFrame, name: str) -> Column:
    """A vendor text column, or a typed null when the landed file lacks it."""
    return _col_or_null(df, name, T.StringType())


def to_table(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Conform a mapped frame the way loaders do: absent registered columns
    become nulls first (C2), then C1 types and orders them."""
    return conform(df, spec, fill_missing=True)


# ---------------------------------------------------------------- S6 ----------

def pct_to_fraction(df: DataFrame, col: str = "pct_chg") -> DataFrame:
    """Percent -> fraction, once: the converted column carries a mark in
    its schema, so a frame that went through it already is left alone."""
    if col not in df.columns or df.schema[col].metadata.get(FRACTION_MARK):
        return df
    fraction = to_double(F.col(col), df.schema[col].dataType) / F.lit(100.0)
    return df.withColumn(col, fraction.alias(col, metadata={FRACTION_MARK: True}))


# ---------------------------------------------------------------- lists -------

def stock_list(raw: DataFrame) -> DataFrame:
    """stock_basic -> reference_instrument."""
    m = _ids(raw) | {
        "asset_class": F.lit("equity"),
        "instrument_type": F.lit("stock"),
        "full_name": _v(raw, "fullname"),
        "currency": _v(raw, "curr_type"),
        "is_hs": F.coalesce(_v(raw, "is_hs"), F.lit("N")) != F.lit("N"),
    }
    return to_table(raw.withColumns(m), S.REFERENCE_INSTRUMENT)


def etf_list(raw: DataFrame) -> DataFrame:
    """etf_basic -> reference_instrument."""
    m = _ids(raw) | {
        "asset_class": F.lit("fund"),
        "instrument_type": F.lit("etf"),
        "symbol": F.col("ts_code"),
        "name": _v(raw, "cname"),
        "full_name": _v(raw, "cname"),
        "currency": F.lit("CNY"),
        "is_hs": F.lit(False),
    }
    return to_table(raw.withColumns(m), S.REFERENCE_INSTRUMENT)


def index_list(raw: DataFrame) -> DataFrame:
    """index_basic -> reference_instrument (exchange = market)."""
    m = _ids(raw) | {
        "asset_class": F.lit("index"),
        "instrument_type": F.lit("index"),
        "symbol": F.col("ts_code"),
        "full_name": _v(raw, "fullname"),
        "exchange": _v(raw, "market"),
        "currency": F.lit("CNY"),
        "list_status": F.lit("L"),
        "is_hs": F.lit(False),
    }
    return to_table(raw.withColumns(m), S.REFERENCE_INSTRUMENT)


def future_list_instrument(raw: DataFrame) -> DataFrame:
    """fut_basic -> reference_instrument (list_status stays null)."""
    m = _ids(raw) | {
        "asset_class": F.lit("future"),
        "instrument_type": F.lit("future"),
        "full_name": _v(raw, "name"),
        "currency": F.lit("CNY"),
        "is_hs": F.lit(False),
    }
    return to_table(raw.withColumns(m), S.REFERENCE_INSTRUMENT)


def future_list_contract(raw: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """fut_basic -> reference_future."""
    m = _ids(raw) | {"updated_at": _now(updated_at)}
    return to_table(raw.withColumns(m), S.REFERENCE_FUTURE)


def stock_st(raw: DataFrame) -> DataFrame:
    """stock_st -> reference_instrument_st."""
    return to_table(raw.withColumns(_ids(raw)), S.REFERENCE_INSTRUMENT_ST)


# ---------------------------------------------------------------- bars --------

def daily_bars(raw: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Vendor daily bars -> market_bars_daily.

    volume = vol as double; amount (thousands) x 1000; pct_chg as landed
    (percent for stock and futures-index feeds, a fraction where S6 applied).
    A feed without vol or amount yields nulls there.
    """
    m = _ids(raw) | {
        "volume": _number(raw, "vol"),
        "amount": scale(_number(raw, "amount"), 1000.0),
        "updated_at": _now(updated_at),
    }
    return to_table(raw.withColumns(m), S.MARKET_BARS_DAILY)


def future_bars(raw: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """P10: fut_daily -> market_bars_derivative_daily (no scaling, vol kept)."""
    m = _ids(raw) | {"updated_at": _now(updated_at)}
    return to_table(raw.withColumns(m), S.MARKET_BARS_DERIVATIVE_DAILY)


# ---------------------------------------------------------------- FX ----------

def fx_reference(raw: DataFrame, exchange: str | None = None) -> DataFrame:
    """One reference_instrument row per distinct FX pair."""
    code = F.col("ts_code")
    pairs = raw.select("ts_code").distinct()
    m = {
        "instrument_id": code,
        "symbol": code,
        "name": code,
        "full_name": code,
        "market": F.lit("FX"),
        "exchange": F.coalesce(regex_group(code, FX_EXCHANGE_PATTERN), F.lit(exchange or "FX")),
        "currency": regex_group(code, FX_CURRENCY_PATTERN),
        "list_status": F.lit("L"),
        "is_hs": F.lit(False),
        "source_code": code,
        "source_id": F.lit(TUSHARE),
        "asset_class": F.lit("fx"),
        "instrument_type": F.lit("currency_pair"),
    }
    return to_table(pairs.withColumns(m), S.REFERENCE_INSTRUMENT)


def fx_daily(raw: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Two-sided quotes -> market_fx_daily with mid = (bid + ask) / 2 for
    open/high/low/close and spread_close = ask_close - bid_close. A quote
    column the feed lacks is null."""
    q = {c: _number(raw, c) for c in FX_QUOTES}
    m = _ids(raw) | q | {
        "mid_open": midpoint(q["bid_open"], q["ask_open"]),
        "mid_high": midpoint(q["bid_high"], q["ask_high"]),
        "mid_low": midpoint(q["bid_low"], q["ask_low"]),
        "mid_close": midpoint(q["bid_close"], q["ask_close"]),
        "spread_close": spread(q["ask_close"], q["bid_close"]),
        "updated_at": _now(updated_at),
    }
    return to_table(raw.withColumns(m), S.MARKET_FX_DAILY)


# ---------------------------------------------------------------- Yahoo -------

def yahoo_instrument(info: DataFrame, currency: str | None = None) -> DataFrame:
    """Valid ticker-info rows -> reference_instrument."""
    m = {
        "currency": F.lit(currency or "USD"),
        "list_status": F.lit("L"),
        "is_hs": F.lit(False),
    }
    return to_table(valid_only(info).withColumns(m), S.REFERENCE_INSTRUMENT)


def previous_close(df: DataFrame, id_col: str, order_col: str,
                   close_col: str = "close", day_col: str | None = None) -> DataFrame:
    """N1 + N2: pre_close = previous row's close within the instrument by date;
    change = close - pre_close; pct_chg = change / pre_close (a fraction),
    null when pre_close is null or zero.

    A per-instrument window would put a whole instrument's history into one
    task. The lag is instead taken inside (instrument, calendar year)
    segments, so a hot instrument is spread over its years. The first row of
    a segment takes the last close of the instrument's previous non-empty
    segment, from an aggregate with one row per (instrument, year).

    The rows are dealt out by segment once: lag and aggregate ask for the same
    columns of the same exchange, so Spark runs ``df`` once and reuses it. The
    join's keys come out of the aggregate's rows: were they its groups, their
    null check would be pushed into ``df`` on that side only, and make it
    another one. ``day_col`` has the rows' days, if they are dealt by them.
    """
    seg = "_segment"
    year = F.year(day_col or order_col)
    dealt = df.repartition(id_col, year).withColumn(seg, year)
    last = F.max_by(F.struct(*dealt.columns), F.col(order_col))
    ends = dealt.groupBy(id_col, seg).agg(
        last[id_col].alias("_id"), last[seg].alias("_seg"), last[close_col].alias("_last_close"),
    ).select(F.col("_id").alias(id_col), F.col("_seg").alias(seg), "_last_close")
    before = ends.select(
        id_col, seg,
        F.lag("_last_close").over(Window.partitionBy(id_col).orderBy(seg)).alias("_prev_close"),
    )
    w = Window.partitionBy(id_col, seg).orderBy(order_col)
    lagged = dealt.withColumns({"_lag": F.lag(close_col).over(w), "_rn": F.row_number().over(w)})
    pre = F.when(F.col("_rn") == 1, F.col("_prev_close")).otherwise(F.col("_lag"))
    out = lagged.join(before, [id_col, seg], "left").withColumn("pre_close", pre).drop(
        seg, "_lag", "_rn", "_prev_close")
    change = F.col(close_col) - F.col("pre_close")
    return out.withColumns({"change": change, "pct_chg": safe_ratio(change, "pre_close")})


def yahoo_bars(raw: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Long-form history -> market_bars_daily (lag computed on the rows
    given, i.e. after the new-key filter)."""
    bars = ["ticker", "date", *(c for c in ("open", "high", "low", "close", "volume") if c in raw.columns)]
    dated = raw.select(*bars).withColumn("trade_date", to_calendar_date("date"))
    with_prev = previous_close(dated, "ticker", "date", day_col="trade_date")
    m = {
        "instrument_id": F.col("ticker"),
        "source_code": F.col("ticker"),
        "source_id": F.lit(YFINANCE),
        "volume": _number(raw, "volume"),
        "amount": F.lit(None).cast(T.DoubleType()),
        "updated_at": _now(updated_at),
    }
    return to_table(with_prev.withColumns(m), S.MARKET_BARS_DAILY)
