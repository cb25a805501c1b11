"""Registered queries: each runs library operators over the adapter views of
one scale-factor directory and has a DuckDB twin (None when the operator is
not SQL-expressible)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.dates import date_to_int, date_to_text, lenient_date, once
from tidemark.operators import conform as C
from tidemark.operators import coverage as G
from tidemark.operators import newkeys as J
from tidemark.operators import reshape as R
from tidemark.operators import store as ST
from tidemark.operators import tickers as O
from tidemark.operators import transforms as P
from tidemark.operators import universe as U
from tidemark.plans import jobs
from tidemark.plans.oracle import (
    LOADED_AT, head_tail_sql, parse_date_sql, stored_state_sql, upsert_sql, with_views)
from tidemark.sources import fixtures as fx
from tidemark.sources import landing as L

# Fixed parameters of the registered queries.
GAP_START, GAP_END = "1990-01-01", "2005-12-31"
CLIP_LIST, CLIP_DELIST = "1993-01-01", "1994-06-30"
PLAN_START, PLAN_END = "1990-01-01", "2005-12-31"
LIVE_START, LIVE_END = "1996-01-01", "1999-12-31"
MERGE_STORED_TYPES = ["view", "click"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _c(cols):
    return ", ".join(cols)


# ============================================================ flagship ======

@register("yf_new_bars", with_views(f"""
    SELECT ticker AS instrument_id, CAST(date AS DATE) AS trade_date, open, high, low, close,
           pre_close, close - pre_close AS change,
           CASE WHEN pre_close IS NOT NULL AND pre_close <> 0
                THEN (close - pre_close) / pre_close END AS pct_chg,
           CAST(volume AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS amount,
           ticker AS source_code, 'yfinance' AS source_id, {LOADED_AT} AS updated_at
    FROM (SELECT h.*, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS pre_close
          FROM history h
          WHERE NOT EXISTS (SELECT 1 FROM stored_half s
                            WHERE s.source_id = 'yfinance' AND s.instrument_id = h.ticker
                              AND s.trade_date = CAST(h.date AS DATE))) n""",
    "history", "stored_half"))
def yf_new_bars(spark, d):
    """J2 -> J1 -> N1/N2 -> P14 -> C1: new Yahoo bars, previous close after the filter."""
    new = J.new_rows(fx.history(spark, d), fx.stored_half(spark, d), "ticker", "date", "yfinance", by_year=True)
    return P.yahoo_bars(new, updated_at=fx.loaded_at())


_HIST = ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume", "dividends",
         "stock_splits"]


@register("new_keys_only", with_views(f"""
    SELECT {', '.join(_HIST)} FROM history h
    WHERE NOT EXISTS (SELECT 1 FROM stored_half s
                      WHERE s.source_id = 'yfinance' AND s.instrument_id = h.ticker
                        AND s.trade_date = CAST(h.date AS DATE))""", "history", "stored_half"))
def new_keys_only(spark, d):
    """J2 + J1 + F9: landed history rows whose (ticker, day) is not stored
    for the source yet (null keys would stay)."""
    return J.new_rows(fx.history(spark, d), fx.stored_half(spark, d), "ticker", "date", "yfinance")


# ============================================================ store =========

_UPD = ["user_id", "trade_date", "event_id", "ts", "event_type", "value", "props"]


@register("keep_latest", with_views(f"""
    SELECT {_c(_UPD)} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, trade_date ORDER BY event_id DESC) AS rn
        FROM updates) r WHERE rn = 1""", "updates"))
def keep_latest(spark, d):
    """Last row per (user_id, day) by event_id."""
    return ST.keep_latest(fx.updates(spark, d), ["user_id", "trade_date"], "event_id")


@register("raw_merge", with_views(f"""
    , stored AS (SELECT {_c(_UPD)} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, trade_date ORDER BY event_id DESC) AS rn
        FROM updates WHERE coalesce(event_type, '') IN ('view', 'click')) r WHERE rn = 1)
    , inc AS (SELECT {_c(_UPD)} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, trade_date ORDER BY event_id DESC) AS rn
        FROM updates WHERE coalesce(event_type, '') NOT IN ('view', 'click')) r WHERE rn = 1)
    SELECT * FROM stored s WHERE NOT EXISTS (
        SELECT 1 FROM inc i WHERE i.user_id IS NOT DISTINCT FROM s.user_id
                              AND i.trade_date IS NOT DISTINCT FROM s.trade_date)
    UNION ALL SELECT * FROM inc""", "updates"))
def raw_merge(spark, d):
    """Incoming rows over a keep-latest store (incoming wins whole)."""
    u = fx.updates(spark, d)
    is_stored = F.coalesce(F.col("event_type"), F.lit("")).isin(MERGE_STORED_TYPES)
    stored = ST.keep_latest(u.where(is_stored), ["user_id", "trade_date"], "event_id")
    return ST.merge_keep_latest(stored, u.where(~is_stored), ["user_id", "trade_date"], "event_id")


_BARS = S.MARKET_BARS_DAILY.columns


def _incoming_bars(spark, d):
    b = fx.bars_keyed(spark, d)  # replaces the state's rows of half of the months, adds the rest
    null = F.lit(None).cast("double")
    return b.select(
        "instrument_id", "trade_date", "open", "high", "low", "close", null.alias("pre_close"),
        null.alias("change"), null.alias("pct_chg"), "volume", "amount",
        F.col("instrument_id").alias("source_code"), F.lit("tushare").alias("source_id"),
        fx.loaded_at().alias("updated_at"),
    )


@register("upsert_bars", with_views(f"""
    , inc AS (SELECT instrument_id, trade_date, open, high, low, close,
                     CAST(NULL AS DOUBLE) AS pre_close, CAST(NULL AS DOUBLE) AS change,
                     CAST(NULL AS DOUBLE) AS pct_chg, volume, amount, instrument_id AS source_code,
                     'tushare' AS source_id, {LOADED_AT} AS updated_at
              FROM bars_keyed)
    SELECT {_c(_BARS)} FROM stored_renamed s WHERE NOT EXISTS (
        SELECT 1 FROM inc i WHERE i.instrument_id = s.instrument_id AND i.trade_date = s.trade_date)
    UNION ALL SELECT {_c(_BARS)} FROM inc""", "bars_keyed", "stored_renamed"))
def upsert_bars(spark, d):
    """Stored rows not in incoming plus all incoming rows."""
    return ST.upsert(fx.stored_renamed(spark, d), _incoming_bars(spark, d), S.MARKET_BARS_DAILY)


_LATER = ("amount", "volume")  # columns that the files of odd months were written before


@register("aligned_read", with_views(f"""
    SELECT {', '.join(f"CASE WHEN month(trade_date) % 2 = 0 THEN {c} END AS {c}" if c in _LATER else c for c in _BARS)}
    FROM stored_bars""", "stored_bars"))
def aligned_read(spark, d):
    """Files written before and after columns were added, read together."""
    stored, odd = fx.stored_bars(spark, d), F.pmod(F.month("trade_date"), F.lit(2)) == 1
    files = [stored.where(odd).drop(*_LATER), stored.where(~odd)]
    return reduce(DataFrame.unionByName, [ST.align_to_spec(f, S.MARKET_BARS_DAILY) for f in files])


@register("relaxed_union", """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice,
           CAST(NULL AS VARCHAR) AS extra
    FROM orders WHERE coalesce(o_orderstatus, '') = 'F'
    UNION ALL
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(NULL AS DOUBLE) AS o_totalprice,
           CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END AS extra
    FROM orders WHERE coalesce(o_orderstatus, '') <> 'F'""")
def relaxed_union(spark, d):
    """Union by name; bigint + text -> text; absent columns -> null."""
    return ST.relaxed_union(fx.union_left(spark, d), fx.union_right(spark, d))


# ============================================================ coverage ======

@register("gaps_whole", with_views(f"""
    , b AS (SELECT min(trade_date) AS first_date, max(trade_date) AS last_date
            FROM stored_bars WHERE source_id = 'tushare')
    {head_tail_sql('b', '', GAP_START, GAP_END)}""", "stored_bars"))
def gaps_whole(spark, d):
    """G1 (+A1, A2): head/tail gaps of the tushare rows of the bar table."""
    return G.missing_ranges(spark, fx.stored_bars(spark, d), GAP_START, GAP_END,
                            filters={"source_id": "tushare"})


@register("gaps_raw", with_views(f"""
    , b AS (SELECT min({parse_date_sql('trade_date')}) AS first_date, max({parse_date_sql('trade_date')}) AS last_date
            FROM daily_landing)
    {head_tail_sql('b', '', GAP_START, GAP_END)}""", "daily_landing"))
def gaps_raw(spark, d):
    """G1 over a raw store: its dates are text, in every accepted shape."""
    return G.missing_ranges(spark, fx.daily_landing(spark, d), GAP_START, GAP_END)


@register("gaps_whole_clipped", with_views(f"""
    , b AS (SELECT min(trade_date) AS first_date, max(trade_date) AS last_date FROM stored_bars)
    , w AS (SELECT greatest(DATE '{GAP_START}', DATE '{CLIP_LIST}') AS ask_start,
                   least(DATE '{GAP_END}', DATE '{CLIP_DELIST}') AS ask_end)
    , c AS (SELECT * FROM b, w WHERE ask_start <= ask_end)
    SELECT ask_start AS range_start, ask_end AS range_end FROM c WHERE first_date IS NULL
    UNION ALL SELECT ask_start, CAST(first_date - INTERVAL 1 DAY AS DATE) FROM c WHERE ask_start < first_date
    UNION ALL SELECT CAST(last_date + INTERVAL 1 DAY AS DATE), ask_end FROM c WHERE ask_end > last_date""", "stored_bars"))
def gaps_whole_clipped(spark, d):
    """G1 with list/delist clipping; the clipped window lies wholly before the
    stored dates, so the head range runs past the asked end (kept on purpose)."""
    return G.missing_ranges(spark, fx.stored_bars(spark, d), GAP_START, GAP_END,
                            list_date=CLIP_LIST, delist_date=CLIP_DELIST)


_PLAN_SQL = f"""
    , cov AS (SELECT instrument_id, min(trade_date) AS first_date, max(trade_date) AS last_date
              FROM {{state}} WHERE source_id = 'tushare' GROUP BY instrument_id)
    , j AS (SELECT u.instrument_id, cov.first_date, cov.last_date
            FROM (SELECT DISTINCT instrument_id FROM universe) u
            LEFT JOIN cov ON u.instrument_id = cov.instrument_id)
    , plan AS ({head_tail_sql('j', 'instrument_id', PLAN_START, PLAN_END)})"""


def _with_plan(universe_sql: str, body: str, *views: str, state: str = "stored_half") -> str:
    return with_views(f", universe AS ({universe_sql}){_PLAN_SQL.replace('{state}', state)}\n{body}", state, *views)


@register("gaps_by_instrument", _with_plan(
    "SELECT instrument_id FROM instruments", "SELECT * FROM plan", "instruments", state="stored_bars"))
def gaps_by_instrument(spark, d):
    """G2 + J4 + A3: per-instrument head/tail gaps; no state -> whole window."""
    return G.missing_ranges_by_instrument(
        fx.instruments(spark, d), fx.stored_bars(spark, d), PLAN_START, PLAN_END, "tushare")


@register("day_spine", with_views(f"""
    , b AS (SELECT min(trade_date) AS first_date, max(trade_date) AS last_date
            FROM stored_bars WHERE source_id = 'tushare')
    , r AS ({head_tail_sql('b', '', GAP_START, GAP_END)})
    SELECT CAST(unnest(generate_series(range_start, range_end, INTERVAL 1 DAY)) AS DATE) AS trade_date
    FROM r WHERE range_start <= range_end""", "stored_bars"))
def day_spine(spark, d):
    """One row per calendar day of the whole-table gaps."""
    return G.day_spine(gaps_whole(spark, d))


_LANDING_DAILY = ["ts_code", "trade_date", "open", "high", "low", "close", "pre_close",
                  "change", "pct_chg", "vol", "amount"]


@register("fetch_selection", _with_plan(
    "SELECT instrument_id FROM instruments", f"""
    SELECT {_c(_LANDING_DAILY)} FROM daily_landing l WHERE EXISTS (
        SELECT 1 FROM plan p WHERE p.instrument_id = l.ts_code
          AND {parse_date_sql('l.trade_date')} BETWEEN p.range_start AND p.range_end)""",
    "instruments", "daily_landing"))
def fetch_selection(spark, d):
    """Landing rows inside each instrument's missing ranges (range join)."""
    plan = G.missing_ranges_by_instrument(
        fx.instruments(spark, d), fx.stored_half(spark, d), PLAN_START, PLAN_END, "tushare")
    return jobs.select_missing(fx.daily_landing(spark, d), plan)


# ============================================================ universes =====

_ETF_SQL = f"""
    SELECT instrument_id FROM instruments
    WHERE (asset_class, instrument_type, source_id, list_status) = ('fund', 'etf', 'tushare', 'L')
      AND coalesce(list_date, DATE '{LIVE_END}') <= DATE '{LIVE_END}'
      AND right(instrument_id, 3) IN ('.SZ', '.SH')"""


@register("universe_etf", with_views(_ETF_SQL, "instruments"))
def universe_etf(spark, d):
    """F2 + O2."""
    return U.etf_universe(fx.instruments(spark, d), LIVE_END)


_INDEX_SQL = f"""
    SELECT instrument_id FROM instruments
    WHERE (asset_class, instrument_type, source_id, list_status) = ('index', 'index', 'tushare', 'L')
      AND DATE '{LIVE_END}' BETWEEN list_date AND coalesce(exp_date - 1, DATE '{LIVE_END}')
      AND (right(instrument_id, 3) IN ('.SH', '.SZ') OR regexp_matches(instrument_id, '{U.INDEX_CSI_PATTERN}'))
      AND NOT regexp_matches(instrument_id, '{U.INDEX_ID_EXCLUDE}')
      AND NOT regexp_matches(concat_ws(chr(10), name, full_name), '{U.INDEX_NAME_EXCLUDE}')"""


@register("universe_index", with_views(_INDEX_SQL, "instruments"))
def universe_index(spark, d):
    """F3 + O2."""
    return U.index_universe(fx.instruments(spark, d), LIVE_END)


_FUTURE_SQL = f"""
    SELECT instrument_id FROM futures_reference
    WHERE source_id = 'tushare' AND list_date <= DATE '{LIVE_END}'
      AND coalesce(last_ddate, delist_date, DATE '{LIVE_START}') >= DATE '{LIVE_START}'"""


@register("universe_future", with_views(_FUTURE_SQL, "futures_reference"))
def universe_future(spark, d):
    """F4 + O2."""
    return U.future_universe(fx.futures_reference(spark, d), LIVE_START, LIVE_END)


@register("universe_yahoo", with_views("""
    SELECT instrument_id FROM instruments
    WHERE (source_id, list_status) = ('yfinance', 'L')""", "instruments"))
def universe_yahoo(spark, d):
    """F5 + O2."""
    return U.yahoo_universe(fx.instruments(spark, d))


EXPLICIT = {"ts_code": "000001.SZ", "ts_codes": ["000006.CSI", "000003.NH"], "index_codes": ["000008.SH", "000002.CSI"]}


@register("explicit_codes", with_views("""
    SELECT instrument_id, name, list_date FROM instruments
    WHERE instrument_id IN ('000008.SH', '000002.CSI')""", "instruments"))
def explicit_codes(spark, d):
    """explicit codes go before the universe, index_codes before ts_codes
    before ts_code; here they pick rows of the instrument master."""
    universe = U.index_universe(fx.instruments(spark, d), LIVE_END)
    ids = U.resolve_universe(spark, EXPLICIT, universe, what="index")
    return fx.instruments(spark, d).join(ids, "instrument_id", "left_semi").select("instrument_id", "name", "list_date")


# ============================================================ composed ======

def _increment(spark, d, ids, landing, mapper, fraction: bool):
    plan = G.missing_ranges_by_instrument(ids, fx.stored_half(spark, d), PLAN_START, PLAN_END, "tushare")
    sel = jobs.select_missing(landing, plan)
    if fraction:
        sel = P.pct_to_fraction(sel)
    return mapper(sel, updated_at=fx.loaded_at())


def _daily_map_sql(pct: str) -> str:
    return f"""ts_code AS instrument_id, {parse_date_sql('trade_date')} AS trade_date,
           open, high, low, close, pre_close, change, {pct} AS pct_chg,
           CAST(vol AS DOUBLE) AS volume, CAST(amount AS DOUBLE) * 1000.0 AS amount,
           ts_code AS source_code, 'tushare' AS source_id, {LOADED_AT} AS updated_at"""


_FUT_MAP_SQL = f"""ts_code AS instrument_id, {parse_date_sql('trade_date')} AS trade_date,
           pre_close, pre_settle, open, high, low, close, settle, change1, change2, vol, amount,
           oi, oi_chg, delv_settle, ts_code AS source_code, 'tushare' AS source_id,
           {LOADED_AT} AS updated_at"""


def _increment_sql(universe_sql: str, landing: str, select: str, *views: str) -> str:
    return _with_plan(universe_sql, f"""
    SELECT {select} FROM {landing} l WHERE EXISTS (
        SELECT 1 FROM plan p WHERE p.instrument_id = l.ts_code
          AND {parse_date_sql('l.trade_date')} BETWEEN p.range_start AND p.range_end)""",
        landing, *views)


@register("etf_bars_increment", _increment_sql(
    _ETF_SQL, "daily_landing", _daily_map_sql("pct_chg / 100.0"), "instruments"))
def etf_bars_increment(spark, d):
    """Job plan of market_bars_etf_daily: F2 -> G2 -> J5 -> S6 -> P5 -> C1."""
    ids = U.etf_universe(fx.instruments(spark, d), LIVE_END)
    return _increment(spark, d, ids, fx.daily_landing(spark, d), P.daily_bars, True)


@register("index_bars_increment", _increment_sql(
    _INDEX_SQL, "daily_landing", _daily_map_sql("pct_chg / 100.0"), "instruments"))
def index_bars_increment(spark, d):
    """Job plan of market_bars_index_daily (index_daily feed): F3 -> G2 -> J5 -> S6 -> P7."""
    ids = U.index_universe(fx.instruments(spark, d), LIVE_END)
    return _increment(spark, d, ids, fx.daily_landing(spark, d), P.daily_bars, True)


@register("future_bars_increment", _increment_sql(
    _FUTURE_SQL, "fut_daily_landing", _FUT_MAP_SQL, "futures_reference"))
def future_bars_increment(spark, d):
    """Job plan of market_bars_future_daily: F4 -> G2 -> J5 -> P10 -> C1."""
    ids = U.future_universe(fx.futures_reference(spark, d), LIVE_START, LIVE_END)
    return _increment(spark, d, ids, fx.fut_daily_landing(spark, d), P.future_bars, False)


# ============================================================ mappings ======

@register("stock_daily", with_views(
    f"SELECT {_daily_map_sql('pct_chg')} FROM daily_landing", "daily_landing"))
def stock_daily(spark, d):
    """Stock daily bars (pct_chg stays percent, amount x 1000)."""
    return P.daily_bars(fx.daily_landing(spark, d), updated_at=fx.loaded_at())


@register("fund_daily", with_views(
    f"SELECT {_daily_map_sql('pct_chg / 100.0')} FROM daily_landing", "daily_landing"))
def fund_daily(spark, d):
    """S6 + P5: fund daily bars with pct_chg as a fraction."""
    return P.daily_bars(P.pct_to_fraction(fx.daily_landing(spark, d)), updated_at=fx.loaded_at())


@register("future_daily", with_views(
    f"SELECT {_FUT_MAP_SQL} FROM fut_daily_landing", "fut_daily_landing"))
def future_daily(spark, d):
    """P10: futures daily bars, no scaling."""
    return P.future_bars(fx.fut_daily_landing(spark, d), updated_at=fx.loaded_at())


_NULL_S, _NULL_D = "CAST(NULL AS VARCHAR)", "CAST(NULL AS DATE)"


@register("stock_list", with_views(f"""
    SELECT ts_code AS instrument_id, symbol, name, fullname AS full_name, enname, market, exchange,
           curr_type AS currency, list_status, {parse_date_sql('list_date')} AS list_date,
           {parse_date_sql('delist_date')} AS delist_date, coalesce(is_hs, 'N') <> 'N' AS is_hs,
           ts_code AS source_code, 'tushare' AS source_id, 'equity' AS asset_class,
           'stock' AS instrument_type, {_NULL_S} AS index_code, {_NULL_D} AS exp_date
    FROM stock_basic_landing""", "stock_basic_landing"))
def stock_list(spark, d):
    """P1."""
    return P.stock_list(fx.stock_basic_landing(spark, d))


@register("etf_list", with_views(f"""
    SELECT ts_code AS instrument_id, ts_code AS symbol, cname AS name, cname AS full_name,
           {_NULL_S} AS enname, {_NULL_S} AS market, exchange, 'CNY' AS currency, list_status,
           {parse_date_sql('list_date')} AS list_date, {_NULL_D} AS delist_date, false AS is_hs,
           ts_code AS source_code, 'tushare' AS source_id, 'fund' AS asset_class,
           'etf' AS instrument_type, index_code, {_NULL_D} AS exp_date
    FROM etf_basic_landing""", "etf_basic_landing"))
def etf_list(spark, d):
    """P4."""
    return P.etf_list(fx.etf_basic_landing(spark, d))


@register("index_list", with_views(f"""
    SELECT ts_code AS instrument_id, ts_code AS symbol, name, fullname AS full_name,
           {_NULL_S} AS enname, market, market AS exchange, 'CNY' AS currency, 'L' AS list_status,
           {parse_date_sql('list_date')} AS list_date, {_NULL_D} AS delist_date, false AS is_hs,
           ts_code AS source_code, 'tushare' AS source_id, 'index' AS asset_class,
           'index' AS instrument_type, {_NULL_S} AS index_code,
           {parse_date_sql('exp_date')} AS exp_date
    FROM index_basic_landing WHERE market IN ('SSE', 'SZSE', 'CSI')""", "index_basic_landing"))
def index_list(spark, d):
    """F8 + P6: the index list scanned over the default markets."""
    landing = U.in_values(fx.index_basic_landing(spark, d), "market", U.DEFAULT_INDEX_MARKETS)
    return P.index_list(landing)


_FUT_EXCH = "('CFFEX', 'DCE', 'CZCE', 'SHFE', 'INE', 'GFEX')"


@register("future_list_instrument", with_views(f"""
    SELECT ts_code AS instrument_id, symbol, name, name AS full_name, {_NULL_S} AS enname,
           {_NULL_S} AS market, exchange, 'CNY' AS currency, {_NULL_S} AS list_status,
           {parse_date_sql('list_date')} AS list_date, {parse_date_sql('delist_date')} AS delist_date,
           false AS is_hs, ts_code AS source_code, 'tushare' AS source_id, 'future' AS asset_class,
           'future' AS instrument_type, {_NULL_S} AS index_code, {_NULL_D} AS exp_date
    FROM fut_basic_landing WHERE exchange IN {_FUT_EXCH}""", "fut_basic_landing"))
def future_list_instrument(spark, d):
    """F8 + P8: futures contracts into the instrument master."""
    landing = U.in_values(fx.fut_basic_landing(spark, d), "exchange", U.DEFAULT_FUTURE_EXCHANGES)
    return P.future_list_instrument(landing)


@register("future_list_contract", with_views(f"""
    SELECT ts_code AS instrument_id, symbol, exchange, name, fut_code, multiplier, trade_unit,
           per_unit, quote_unit, quote_unit_desc, d_mode_desc,
           {parse_date_sql('list_date')} AS list_date, {parse_date_sql('delist_date')} AS delist_date,
           d_month, {parse_date_sql('last_ddate')} AS last_ddate, ts_code AS source_code,
           'tushare' AS source_id, {LOADED_AT} AS updated_at
    FROM fut_basic_landing WHERE exchange IN {_FUT_EXCH}""", "fut_basic_landing"))
def future_list_contract(spark, d):
    """F8 + P9: futures contracts into reference_future."""
    landing = U.in_values(fx.fut_basic_landing(spark, d), "exchange", U.DEFAULT_FUTURE_EXCHANGES)
    return P.future_list_contract(landing, updated_at=fx.loaded_at())


@register("stock_st", with_views(f"""
    SELECT ts_code AS instrument_id, name, {parse_date_sql('trade_date')} AS trade_date, type,
           type_name, ts_code AS source_code, 'tushare' AS source_id
    FROM stock_st_landing""", "stock_st_landing"))
def stock_st(spark, d):
    """P2."""
    return P.stock_st(fx.stock_st_landing(spark, d))


@register("key_violations", with_views(f"""
    SELECT ts_code AS instrument_id, {parse_date_sql('trade_date')} AS trade_date, type,
           count(*) AS n_rows
    FROM stock_st_landing GROUP BY 1, 2, 3 HAVING count(*) > 1""", "stock_st_landing"))
def key_violations(spark, d):
    """Primary-key collisions of a mapped batch (would fail the upsert)."""
    return C.key_violations(P.stock_st(fx.stock_st_landing(spark, d)),
                            S.REFERENCE_INSTRUMENT_ST.primary_key)


# ============================================================ FX ============

@register("fx_reference", with_views(f"""
    SELECT ts_code AS instrument_id, ts_code AS symbol, ts_code AS name, ts_code AS full_name,
           {_NULL_S} AS enname, 'FX' AS market,
           coalesce(nullif(regexp_extract(ts_code, '\\.([^.]+)$', 1), ''), 'FX') AS exchange,
           nullif(regexp_extract(ts_code, '^[A-Z]{{3}}([A-Z]{{3}})', 1), '') AS currency,
           'L' AS list_status, {_NULL_D} AS list_date, {_NULL_D} AS delist_date, false AS is_hs,
           ts_code AS source_code, 'tushare' AS source_id, 'fx' AS asset_class,
           'currency_pair' AS instrument_type, {_NULL_S} AS index_code, {_NULL_D} AS exp_date
    FROM (SELECT DISTINCT ts_code FROM fx_landing) p""", "fx_landing"))
def fx_reference(spark, d):
    """P11 (+M5): one instrument row per FX pair."""
    return P.fx_reference(fx.fx_landing(spark, d))


@register("fx_daily", with_views(f"""
    SELECT ts_code AS instrument_id, {parse_date_sql('trade_date')} AS trade_date,
           bid_open, bid_high, bid_low, bid_close, ask_open, ask_high, ask_low, ask_close,
           (bid_open + ask_open) / 2.0 AS mid_open, (bid_high + ask_high) / 2.0 AS mid_high,
           (bid_low + ask_low) / 2.0 AS mid_low, (bid_close + ask_close) / 2.0 AS mid_close,
           ask_close - bid_close AS spread_close, ts_code AS source_code,
           'tushare' AS source_id, {LOADED_AT} AS updated_at
    FROM fx_landing""", "fx_landing"))
def fx_daily(spark, d):
    """P12 (+M1, M2): FX mid and spread."""
    return P.fx_daily(fx.fx_landing(spark, d), updated_at=fx.loaded_at())


# ============================================================ scalar ========

@register("date_parse", with_views(f"""
    SELECT o_orderkey, raw_date, {parse_date_sql('raw_date')} AS trade_date,
           CAST(strftime({parse_date_sql('raw_date')}, '%Y%m%d') AS INTEGER) AS date_int,
           strftime({parse_date_sql('raw_date')}, '%Y-%m-%d') AS date_dashed
    FROM date_text""", "date_text"))
def date_parse(spark, d):
    """D1 + D3: multi-format text dates, then back to int and dashed text."""
    t = fx.date_text(spark, d)
    parsed = t.select("o_orderkey", "raw_date", lenient_date("raw_date").alias("trade_date"))
    return parsed.select("*", date_to_int("trade_date").alias("date_int"),
                         date_to_text("trade_date", dashed=True).alias("date_dashed"))


# ============================================================ tickers =======

_MATCH_SQL = """
    , ranked AS (SELECT *, row_number() OVER (
            PARTITION BY ticker
            ORDER BY CASE WHEN upper(symbol) = upper(ticker) THEN 0 ELSE 1 END, rank) AS rn
        FROM quote_candidates)
    , best AS (SELECT * FROM ranked WHERE rn = 1)
    , matches AS (
        SELECT r.ticker,
               coalesce(b.symbol IS NOT NULL AND upper(b.symbol) = upper(r.ticker), false) AS found,
               b.symbol AS matched_symbol, b.quoteType AS quote_type, b.exchange,
               coalesce(b.shortname, b.shortname_1) AS short_name,
               CASE WHEN b.ticker IS NULL THEN 'No quote found' END AS reason
        FROM requested_tickers r LEFT JOIN best b ON r.ticker = b.ticker)"""

_QTYPE = "upper(coalesce(quote_type, ''))"
_INFO_SQL = _MATCH_SQL + f"""
    , info AS (
        SELECT ticker, found AND iid IS NOT NULL AS valid, iid AS instrument_id, iid AS symbol,
               coalesce(short_name, iid) AS name, coalesce(short_name, iid) AS full_name,
               exchange, exchange AS market, quote_type,
               CASE {_QTYPE} WHEN 'EQUITY' THEN 'equity' WHEN 'ETF' THEN 'fund'
                    WHEN 'MUTUALFUND' THEN 'fund' WHEN 'INDEX' THEN 'index'
                    WHEN 'FUTURE' THEN 'future' WHEN 'CURRENCY' THEN 'currency'
                    WHEN 'CRYPTOCURRENCY' THEN 'crypto' ELSE 'unknown' END AS asset_class,
               CASE {_QTYPE} WHEN 'EQUITY' THEN 'stock' WHEN 'ETF' THEN 'etf'
                    WHEN 'MUTUALFUND' THEN 'mutual_fund' WHEN 'INDEX' THEN 'index'
                    WHEN 'FUTURE' THEN 'future' WHEN 'CURRENCY' THEN 'currency'
                    WHEN 'CRYPTOCURRENCY' THEN 'crypto' ELSE 'unknown' END AS instrument_type,
               ticker AS source_code, 'yfinance' AS source_id, reason
        FROM (SELECT *, CASE WHEN found AND matched_symbol IS NOT NULL THEN matched_symbol END AS iid
              FROM matches) m)"""


@register("ticker_match", with_views(_MATCH_SQL + "\nSELECT * FROM matches",
                                     "quote_candidates", "requested_tickers"))
def ticker_match(spark, d):
    """O3: best search candidate per requested ticker."""
    return O.best_match(fx.requested_tickers(spark, d), fx.quote_candidates(spark, d))


@register("ticker_info", with_views(_INFO_SQL + "\nSELECT * FROM info",
                                    "quote_candidates", "requested_tickers"))
def ticker_info(spark, d):
    """O4 + M6: ticker-info rows with asset class and instrument type."""
    return O.ticker_info(ticker_match(spark, d))


@register("yf_instrument", with_views(_INFO_SQL + f"""
    SELECT instrument_id, symbol, name, full_name, {_NULL_S} AS enname, market, exchange,
           'USD' AS currency, 'L' AS list_status, {_NULL_D} AS list_date, {_NULL_D} AS delist_date,
           false AS is_hs, source_code, source_id, asset_class, instrument_type,
           {_NULL_S} AS index_code, {_NULL_D} AS exp_date
    FROM info WHERE valid""", "quote_candidates", "requested_tickers"))
def yf_instrument(spark, d):
    """F7 + P13: valid tickers into the instrument master."""
    return P.yahoo_instrument(ticker_info(spark, d))


# ============================================================ reshape =======

@register("reshape_history", """
    SELECT t.ticker, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS date,
           min(CASE WHEN l_returnflag = t.ticker THEN l_extendedprice END) AS open,
           CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low,
           max(CASE WHEN l_returnflag = t.ticker THEN l_extendedprice END) AS close,
           CAST(NULL AS DOUBLE) AS adj_close,
           sum(CASE WHEN l_returnflag = t.ticker THEN l_quantity END) AS volume,
           CAST(NULL AS DOUBLE) AS dividends, CAST(NULL AS DOUBLE) AS stock_splits
    FROM lineitem, (VALUES ('A'), ('N'), ('R')) t(ticker)
    GROUP BY t.ticker, CAST(l_shipdate AS DATE)""")
def reshape_history(spark, d):
    """Wide (ticker-first headers) -> long history; absent ticker X skipped."""
    return R.wide_to_long(spark, fx.wide_bars(spark, d), fx.WIDE_TICKERS + ["X"])


# ============================================================ aggregates ====

@register("batch_stats", with_views("""
    SELECT min(CAST(date AS DATE)) AS start_date, max(CAST(date AS DATE)) AS end_date,
           count(DISTINCT ticker) AS n_instruments, count(*) AS n_rows
    FROM history""", "history"))
def batch_stats(spark, d):
    """A4 + A6: window, distinct instruments and row count of a landed batch."""
    h = fx.history(spark, d).select(F.col("ticker").alias("instrument_id"),
                                    F.col("date").cast("date").alias("trade_date"))
    return G.batch_bounds(h, with_count=True)


@register("distinct_ids", with_views(
    "SELECT DISTINCT instrument_id FROM stored_bars", "stored_bars"))
def distinct_ids(spark, d):
    """A5: instruments present in the store."""
    return G.distinct_ids(fx.stored_bars(spark, d))


@register("filtered_scan", with_views(
    "SELECT * FROM stored_bars WHERE source_id = 'yfinance' AND close = 0.0", "stored_bars"))
def filtered_scan(spark, d):
    """S8 + F1: equality filters over a stored table."""
    return G.equality_filter(fx.stored_bars(spark, d), {"source_id": "yfinance", "close": 0.0})


@register("existing_keys", with_views("""
    SELECT instrument_id, trade_date FROM stored_renamed
    WHERE source_id = 'yfinance' AND instrument_id IN (SELECT ticker FROM history)
      AND trade_date BETWEEN (SELECT min(CAST(date AS DATE)) FROM history)
                         AND (SELECT max(CAST(date AS DATE)) FROM history)""",
    "stored_renamed", "history"))
def existing_keys(spark, d):
    """Stored keys of the source for the incoming instruments and window."""
    landed = fx.history(spark, d)
    ids = landed.select(F.col("ticker").alias("instrument_id")).dropna().distinct()
    return J.existing_keys(fx.stored_renamed(spark, d), J.key_window(landed), "yfinance", ids)


# ============================================================ coverage ======

@register("table_coverage", with_views("""
    SELECT min(trade_date) AS first_date, max(trade_date) AS last_date
    FROM stored_bars WHERE source_id = 'tushare'""", "stored_bars"))
def table_coverage(spark, d):
    """A1 + A2 + F1: first and last stored date under equality filters."""
    return G.date_bounds(fx.stored_bars(spark, d), filters={"source_id": "tushare"})


@register("coverage_by_instrument", with_views("""
    SELECT instrument_id, min(trade_date) AS first_date, max(trade_date) AS last_date
    FROM stored_bars WHERE source_id = 'tushare' GROUP BY instrument_id""", "stored_bars"))
def coverage_by_instrument(spark, d):
    """A3: first and last stored date per instrument of a source."""
    return G.instrument_bounds(fx.stored_bars(spark, d), "tushare")


@register("coverage_summary", with_views("""
    SELECT instrument_id, source_id, min(trade_date) AS first_date, max(trade_date) AS last_date
    FROM stored_bars GROUP BY instrument_id, source_id""", "stored_bars"))
def coverage_summary(spark, d):
    """Coverage summary of a bar table (A3 per instrument and source)."""
    return G.coverage_summary(fx.stored_bars(spark, d))


# ============================================================ conform =======

@register("conform_lenient_cast", with_views(f"""
    SELECT instrument_id, {parse_date_sql('trade_date')} AS trade_date,
           CASE WHEN NOT regexp_matches(open, '[dDfF]$') THEN TRY_CAST(open AS DOUBLE) END AS open, CAST(NULL AS DOUBLE) AS high,
           CAST(NULL AS DOUBLE) AS low, TRY_CAST(close AS DOUBLE) AS close,
           CAST(NULL AS DOUBLE) AS pre_close, CAST(NULL AS DOUBLE) AS change,
           CAST(NULL AS DOUBLE) AS pct_chg, TRY_CAST(volume AS DOUBLE) AS volume,
           CAST(NULL AS DOUBLE) AS amount, {_NULL_S} AS source_code, {_NULL_S} AS source_id,
           TRY_CAST(updated_at AS TIMESTAMP) AS updated_at
    FROM text_bars""", "text_bars"))
def conform_lenient_cast(spark, d):
    """C1 + C2 + C3 + M1 + D1 + D2: a text batch conformed to market_bars_daily
    (absent columns -> typed nulls, bad values -> null, extra column dropped)."""
    return C.conform(fx.text_bars(spark, d), S.MARKET_BARS_DAILY, fill_missing=True)


@register("nan_to_null", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount END AS discount,
           CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END AS tax, l_returnflag
    FROM lineitem""")
def nan_to_null(spark, d):
    """M7: NaN -> null over every double column of a landed frame."""
    return L.nan_as_null(fx.nan_lines(spark, d))


# ============================================================ landing =======

@register("landing_window", with_views("""
    SELECT ts_code, trade_date, close, pct_chg / 100.0 AS pct_chg FROM daily_landing
    WHERE CAST(replace(replace(trade_date, '-', ''), '/', '') AS INTEGER) BETWEEN 19950301 AND 19950630""", "daily_landing"))
def landing_window(spark, d):
    """S2 + S6: inclusive text-date window, percent -> fraction for the
    index feed, field choice."""
    return L.daily_frame(fx.daily_landing(spark, d), "index_daily", start="1995-03-01",
                         end=_dt.date(1995, 6, 30), fields="ts_code,trade_date,close,pct_chg")


@register("history_window", with_views("""
    SELECT * FROM history
    WHERE date >= TIMESTAMP '1995-03-01' AND date < TIMESTAMP '1995-06-30'""", "history"))
def history_window(spark, d):
    """S4 + Q8: history window with a text end, which is exclusive."""
    return L.history_window(fx.history(spark, d), start="1995-03-01", end="1995-06-30")


@register("instrument_scan", with_views("""
    SELECT ts_code, name, market, list_date FROM index_basic_landing
    WHERE market IN ('SSE', 'CSI') AND publisher = 'Brand#11'""", "index_basic_landing"))
def instrument_scan(spark, d):
    """An instrument-list scan: equality parameters, field choice."""
    found = L.where_equal(fx.index_basic_landing(spark, d), market=["SSE", "CSI"], publisher="Brand#11", category=None)
    return L.select_fields(found, "ts_code, name, market, list_date")


@register("special_treatment_scan", with_views(f"""
    SELECT ts_code, trade_date, type FROM stock_st_landing
    WHERE {parse_date_sql('trade_date')} BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""", "stock_st_landing"))
def special_treatment_scan(spark, d):
    """S3: the special-treatment list over an inclusive window."""
    found = L.where_window(fx.stock_st_landing(spark, d), "trade_date", "2024-01-05", "2024-01-20")
    return L.select_fields(found, ["ts_code", "trade_date", "type"])


@register("quote_scan", with_views("""
    SELECT * FROM quote_candidates WHERE ticker IN ('building', 'machinery')""", "quote_candidates"))
def quote_scan(spark, d):
    """Search candidates of some tickers."""
    return L.search_results(fx.quote_candidates(spark, d), ["building", "machinery"])


# ============================================================ jobs ==========
# The plans of the load jobs over a stored view: what Loader selects and maps,
# upserted (S10) instead of written.

def _job(name: str, spec: S.TableSpec, mapped_sql: str, stored_sql: str | None = None, dealt_by=tuple):
    """Registers ``mapped`` (Spark) upserted over a stored state; without
    ``stored_sql`` the state is made from the mapped rows themselves.
    ``dealt_by`` gives the columns by which ``mapped`` is dealt out already."""
    stored_sql = stored_sql or stored_state_sql(mapped_sql)

    def deco(fn):
        def run(spark, d):
            mapped, stored = fn(spark, d)
            return ST.upsert_once(fx.stored_state(mapped) if stored is None else stored, mapped, spec, dealt_by())
        run.__doc__ = fn.__doc__
        return register(name, upsert_sql(stored_sql, mapped_sql, spec.columns, spec.primary_key))(run)
    return deco


@_job("job_stock_list", S.REFERENCE_INSTRUMENT, SQL["stock_list"])
def _job_stock_list(spark, d):
    """stock_list: S1 -> P1 -> C1 -> S10."""
    return stock_list(spark, d), None


@_job("job_etf_list", S.REFERENCE_INSTRUMENT, SQL["etf_list"])
def _job_etf_list(spark, d):
    """etf_list: S1 -> P4 -> C1 -> S10."""
    return etf_list(spark, d), None


@_job("job_index_list", S.REFERENCE_INSTRUMENT, SQL["index_list"])
def _job_index_list(spark, d):
    """index_list: S1 -> F8 -> P6 -> C1 -> S10."""
    return index_list(spark, d), None


@_job("job_future_list_instrument", S.REFERENCE_INSTRUMENT, SQL["future_list_instrument"])
def _job_future_list_instrument(spark, d):
    """future_list, first table: F8 -> P8 -> C1 -> S10."""
    return future_list_instrument(spark, d), None


@_job("job_future_list_contract", S.REFERENCE_FUTURE, SQL["future_list_contract"])
def _job_future_list_contract(spark, d):
    """future_list, second table: F8 -> P9 -> C1 -> S10."""
    return future_list_contract(spark, d), None


@_job("job_stock_st", S.REFERENCE_INSTRUMENT_ST, with_views(f"""
    , latest AS (SELECT * FROM special_landed
                 QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date ORDER BY _arrival DESC) = 1)
    SELECT ts_code AS instrument_id, name, {parse_date_sql('trade_date')} AS trade_date, type,
           type_name, ts_code AS source_code, 'tushare' AS source_id
    FROM latest
    WHERE {parse_date_sql('trade_date')} BETWEEN DATE '1990-01-01' AND DATE '2030-12-31'""", "special_landed"))
def _job_stock_st(spark, d):
    """stock_st: the whole window -> S7's one row per key -> P2 -> C1 -> S10."""
    landed = L.where_window(fx.special_landed(spark, d), "trade_date", "1990-01-01", "2030-12-31")
    return P.stock_st(ST.merge_keep_latest(None, landed, ["ts_code", "trade_date"])), None


@_job("job_stock_daily", S.MARKET_BARS_DAILY, with_views(f"""
    , b AS (SELECT min(trade_date) AS first_date, max(trade_date) AS last_date FROM stored_middle)
    SELECT {_daily_map_sql('pct_chg')} FROM daily_landing, b
    WHERE {parse_date_sql('trade_date')} BETWEEN DATE '{GAP_START}' AND first_date - 1
       OR {parse_date_sql('trade_date')} BETWEEN last_date + 1 AND DATE '{GAP_END}'""",
    "daily_landing", "stored_middle"), with_views("SELECT * FROM stored_middle", "stored_middle"))
def _job_stock_daily(spark, d):
    """stock_daily: G1 on the whole table -> landed rows inside the gaps -> P3 -> C1 -> S10."""
    stored, landing = fx.stored_middle(spark, d), fx.daily_landing(spark, d)
    gaps = G.missing_ranges(spark, stored, GAP_START, GAP_END)
    day = once(F.col("trade_date"), lambda text: lenient_date(text, landing.schema["trade_date"].dataType))
    landed = landing.where(G.in_range_rows(day, gaps))
    return P.daily_bars(landed, updated_at=fx.loaded_at()), stored


_HALF = with_views("SELECT * FROM stored_half", "stored_half")


@_job("job_etf_daily", S.MARKET_BARS_DAILY, SQL["etf_bars_increment"], _HALF)
def _job_etf_daily(spark, d):
    """market_bars_etf_daily: F2 -> G2 -> J5 -> S6 -> P5 -> C1 -> S10."""
    return etf_bars_increment(spark, d), fx.stored_half(spark, d)


@_job("job_index_daily", S.MARKET_BARS_DAILY, SQL["index_bars_increment"], _HALF)
def _job_index_daily(spark, d):
    """market_bars_index_daily: F3 -> G2 -> J5 -> S6 -> P7 -> C1 -> S10."""
    return index_bars_increment(spark, d), fx.stored_half(spark, d)


@_job("job_future_daily", S.MARKET_BARS_DERIVATIVE_DAILY, SQL["future_bars_increment"])
def _job_future_daily(spark, d):
    """market_bars_future_daily: F4 -> G2 -> J5 -> P10 -> C1 -> S10."""
    return future_bars_increment(spark, d), None


@_job("job_fx_reference", S.REFERENCE_INSTRUMENT, SQL["fx_reference"])
def _job_fx_reference(spark, d):
    """market_fx_daily, first table: P11 -> C1 -> S10."""
    return fx_reference(spark, d), None


@_job("job_fx_daily", S.MARKET_FX_DAILY, SQL["fx_daily"])
def _job_fx_daily(spark, d):
    """market_fx_daily, second table: P12 -> C1 -> S10."""
    return fx_daily(spark, d), None


@_job("job_yf_instrument", S.REFERENCE_INSTRUMENT, SQL["yf_instrument"])
def _job_yf_instrument(spark, d):
    """yf_instrument: O3 -> O4 -> F7 -> P13 -> C1 -> S10."""
    return yf_instrument(spark, d), None


@_job("job_yf_bars", S.MARKET_BARS_DAILY, SQL["yf_new_bars"], _HALF,
      dealt_by=lambda: (F.col("instrument_id"), F.year("trade_date")))
def _job_yf_bars(spark, d):
    """yf_market_bars_daily: J2 -> J1 -> N1/N2 -> P14 -> C1 -> S10."""
    return yf_new_bars(spark, d), fx.stored_half(spark, d)


@register("load_audit", with_views(f"""
    SELECT 'e1' AS event_id, 'run' AS run_id, 'tushare' AS source_id, 'market_bars_daily' AS table_name,
           'all' AS scope, {LOADED_AT} AS started_at, {LOADED_AT} AS finished_at, 'success' AS status,
           (SELECT count(*) FROM daily_landing) AS rows_read,
           (SELECT count(*) FROM daily_landing WHERE {parse_date_sql('trade_date')} IS NOT NULL) AS rows_written,
           CAST(NULL AS VARCHAR) AS message""", "daily_landing"))
def load_audit(spark, d):
    """The audit row of a load, its counts taken from the batch inside the plan."""
    landing = fx.daily_landing(spark, d)
    written = P.daily_bars(landing, updated_at=fx.loaded_at()).where("trade_date IS NOT NULL")
    return jobs.audit_row(
        spark, event_id="e1", run_id="run", source_id="tushare", table_name="market_bars_daily", scope="all",
        started_at=fx.loaded_at(), finished_at=fx.loaded_at(), status="success",
        rows_read=landing.agg(F.count("*")).scalar(), rows_written=written.agg(F.count("*")).scalar(), message=None)
