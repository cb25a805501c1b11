"""SQL twins of the adapter views (:mod:`tidemark.sources.fixtures`), for the
DuckDB oracle. ``with_views(body, *names)`` prefixes a query with the CTEs it
needs (dependencies included, in order)."""

from __future__ import annotations


def id6(k: str) -> str:
    return (
        f"(printf('%06d', {k}) || CASE {k} % 4 WHEN 0 THEN '.SH' WHEN 1 THEN '.SZ' "
        f"WHEN 2 THEN '.CSI' ELSE '.NH' END)"
    )


def base_date(k: str, plus: int = 0) -> str:
    return f"(DATE '1995-01-01' + CAST({k} % 2500 + {plus} AS INTEGER))"


def kind(col: str, fund: str, index: str, future: str, other: str) -> str:
    return (
        f"CASE WHEN starts_with({col}, 'ECONOMY') THEN '{fund}' WHEN starts_with({col}, 'LARGE') "
        f"THEN '{index}' WHEN starts_with({col}, 'MEDIUM') THEN '{future}' ELSE '{other}' END"
    )


STORED_AT = "TIMESTAMP '2026-01-01 00:00:00'"
LOADED_AT = "TIMESTAMP '2026-06-01 00:00:00'"


def _stored(day: str) -> str:
    return f"""
        SELECT instrument_id, {day} AS trade_date, open, high, low, close,
               CAST(NULL AS DOUBLE) AS pre_close, CAST(NULL AS DOUBLE) AS change,
               CAST(NULL AS DOUBLE) AS pct_chg, volume, amount, instrument_id AS source_code,
               CASE WHEN k % 3 = 0 THEN 'yfinance' ELSE 'tushare' END AS source_id,
               {STORED_AT} AS updated_at"""


VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "bars_keyed": (f"""
        SELECT k, {id6('k')} AS instrument_id, trade_date, open, high, low,
               CAST(CASE WHEN day(trade_date) = 13 THEN 0.0 WHEN day(trade_date) = 14 THEN NULL
                    ELSE mx END AS DOUBLE) AS close,
               volume, mx AS amount
        FROM (SELECT l_partkey AS k, CAST(l_shipdate AS DATE) AS trade_date,
                     min(l_extendedprice) AS open, max(l_extendedprice) AS high,
                     min(l_extendedprice) AS low, max(l_extendedprice) AS mx,
                     sum(l_quantity) AS volume
              FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE)) g""", ()),
    "bars": ("SELECT * EXCLUDE (k) FROM bars_keyed", ("bars_keyed",)),
    "stored_bars": (_stored("trade_date") + " FROM bars_keyed", ("bars_keyed",)),
    "stored_half": (_stored("trade_date") + " FROM bars_keyed WHERE (k + dayofyear(trade_date)) % 2 = 0",
                    ("bars_keyed",)),
    "stored_renamed": ("""
        SELECT * REPLACE (CASE WHEN month(trade_date) % 2 = 1 THEN instrument_id || '~' ELSE instrument_id END AS instrument_id)
        FROM stored_bars""", ("stored_bars",)),
    "stored_middle": (
        _stored("DATE '1996-01-01' + CAST((trade_date - DATE '1995-01-01') // 2 AS INTEGER)")
        + " FROM bars_keyed WHERE (trade_date - DATE '1995-01-01') % 2 = 0", ("bars_keyed",)),
    "history": ("""
        SELECT instrument_id AS ticker, CAST(trade_date AS TIMESTAMP) AS date, open, high, low, close,
               CAST(NULL AS DOUBLE) AS adj_close, volume, CAST(NULL AS DOUBLE) AS dividends,
               CAST(NULL AS DOUBLE) AS stock_splits
        FROM bars""", ("bars",)),
    "daily_landing": ("""
        SELECT instrument_id AS ts_code,
               CASE k % 5 WHEN 1 THEN strftime(trade_date, '%Y-%m-%d') WHEN 2 THEN strftime(trade_date, '%Y/%m/%d')
                    ELSE strftime(trade_date, '%Y%m%d') END AS trade_date,
               open, high, low, close, CAST(NULL AS DOUBLE) AS pre_close,
               high - low AS change, high - low AS pct_chg, volume AS vol, amount
        FROM bars_keyed""", ("bars_keyed",)),
    "fut_daily_landing": ("""
        SELECT instrument_id AS ts_code, strftime(trade_date, '%Y%m%d') AS trade_date,
               CAST(NULL AS DOUBLE) AS pre_close, low AS pre_settle, open, high, low, close,
               high AS settle, high - low AS change1, CAST(NULL AS DOUBLE) AS change2,
               volume AS vol, amount, volume * 2 AS oi, CAST(NULL AS DOUBLE) AS oi_chg,
               CAST(NULL AS DOUBLE) AS delv_settle
        FROM bars""", ("bars",)),
    "instruments": (f"""
        SELECT {id6('p_partkey')} AS instrument_id, {id6('p_partkey')} AS symbol,
               p_name || CASE WHEN p_partkey % 13 = 0 THEN ' USD' ELSE '' END AS name,
               p_name || CASE WHEN p_partkey % 17 = 0 THEN ' 全收益' ELSE '' END AS full_name,
               {kind('p_type', 'fund', 'index', 'future', 'equity')} AS asset_class,
               {kind('p_type', 'etf', 'index', 'future', 'stock')} AS instrument_type,
               CASE WHEN p_size % 5 = 0 THEN 'D' ELSE 'L' END AS list_status,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE {base_date('p_partkey')} END AS list_date,
               CASE WHEN p_partkey % 7 = 0 THEN {base_date('p_partkey', 1000)} END AS exp_date,
               CASE WHEN p_partkey % 9 = 0 THEN 'yfinance' ELSE 'tushare' END AS source_id
        FROM part""", ()),
    "futures_reference": ("""
        SELECT instrument_id, list_date, CAST(NULL AS DATE) AS delist_date,
               exp_date AS last_ddate, source_id
        FROM instruments WHERE asset_class = 'future'""", ("instruments",)),
    "stock_basic_landing": (f"""
        SELECT {id6('p_partkey')} AS ts_code, printf('%06d', p_partkey) AS symbol, p_name AS name,
               CAST(NULL AS VARCHAR) AS area, p_type AS industry,
               concat_ws(' ', p_brand, p_name) AS fullname, CAST(NULL AS VARCHAR) AS enname,
               CAST(NULL AS VARCHAR) AS cnspell, p_brand AS market,
               CASE WHEN p_partkey % 2 = 0 THEN 'SSE' ELSE 'SZSE' END AS exchange,
               'CNY' AS curr_type, CASE WHEN p_size % 5 = 0 THEN 'D' ELSE 'L' END AS list_status,
               strftime({base_date('p_partkey')}, '%Y%m%d') AS list_date,
               CASE WHEN p_size % 5 = 0 THEN strftime({base_date('p_partkey', 900)}, '%Y%m%d') END AS delist_date,
               CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN 'N' ELSE 'H' END AS is_hs,
               CAST(NULL AS VARCHAR) AS act_name, CAST(NULL AS VARCHAR) AS act_ent_type
        FROM part""", ()),
    "etf_basic_landing": (f"""
        SELECT {id6('p_partkey')} AS ts_code, p_brand AS csname, CAST(NULL AS VARCHAR) AS extname,
               p_name AS cname, {id6('CAST(p_size AS BIGINT)')} AS index_code, p_type AS index_name,
               CAST(NULL AS VARCHAR) AS setup_date,
               strftime({base_date('p_partkey')}, '%Y-%m-%d') AS list_date,
               CASE WHEN p_size % 5 = 0 THEN 'D' ELSE 'L' END AS list_status,
               CASE WHEN p_partkey % 2 = 0 THEN 'SH' ELSE 'SZ' END AS exchange,
               p_brand AS mgr_name, CAST(NULL AS VARCHAR) AS custod_name,
               p_retailprice AS mgt_fee, 'ETF' AS etf_type
        FROM part""", ()),
    "index_basic_landing": (f"""
        SELECT {id6('p_partkey')} AS ts_code, p_name AS name, concat_ws(' ', p_name, p_type) AS fullname,
               CASE p_partkey % 3 WHEN 0 THEN 'SSE' WHEN 1 THEN 'SZSE' ELSE 'CSI' END AS market,
               p_brand AS publisher, p_type AS index_type, p_type AS category,
               CAST(NULL AS VARCHAR) AS base_date, p_retailprice AS base_point,
               strftime({base_date('p_partkey')}, '%Y/%m/%d') AS list_date,
               CAST(NULL AS VARCHAR) AS weight_rule,
               CASE WHEN p_partkey % 7 = 0 THEN strftime({base_date('p_partkey', 1000)}, '%Y%m%d') END AS exp_date
        FROM part""", ()),
    "fut_basic_landing": (f"""
        SELECT {id6('p_partkey')} AS ts_code, printf('%06d', p_partkey) AS symbol,
               CASE p_partkey % 6 WHEN 0 THEN 'CFFEX' WHEN 1 THEN 'DCE' WHEN 2 THEN 'CZCE'
                    WHEN 3 THEN 'SHFE' WHEN 4 THEN 'INE' ELSE 'GFEX' END AS exchange,
               p_name AS name, p_brand AS fut_code, p_retailprice AS multiplier, 't' AS trade_unit,
               CAST(p_size AS DOUBLE) AS per_unit, 'CNY/t' AS quote_unit,
               CAST(NULL AS VARCHAR) AS quote_unit_desc, CAST(NULL AS VARCHAR) AS d_mode_desc,
               strftime({base_date('p_partkey')}, '%Y%m%d') AS list_date,
               strftime({base_date('p_partkey', 365)}, '%Y%m%d') AS delist_date,
               strftime({base_date('p_partkey')}, '%Y%m') AS d_month,
               CASE WHEN p_partkey % 7 = 0 THEN strftime({base_date('p_partkey', 1000)}, '%Y%m%d') END AS last_ddate
        FROM part""", ()),
    "updates": ("""
        SELECT user_id, CAST(ts AS DATE) AS trade_date, event_id, ts, event_type, value, props
        FROM events""", ()),
    "stock_st_landing": (f"""
        SELECT {id6('user_id')} AS ts_code, 'ST ' || CAST(user_id AS VARCHAR) AS name,
               strftime(CAST(ts AS DATE), '%Y%m%d') AS trade_date, event_type AS type,
               upper(event_type) AS type_name
        FROM events""", ()),
    "special_landed": (f"""
        SELECT {id6('user_id')} AS ts_code, 'ST ' || CAST(user_id AS VARCHAR) AS name,
               strftime(CAST(ts AS DATE), '%Y%m%d') AS trade_date, event_type AS type,
               upper(event_type) AS type_name, event_id AS _arrival
        FROM events""", ()),
    "fx_landing": ("""
        SELECT ts_code, trade_date,
               min(p) AS bid_open, max(p) AS bid_close, max(p) AS bid_high, min(p) AS bid_low,
               max(p) AS ask_open, max(p) + 1.0 AS ask_close, max(p) + 2.0 AS ask_high,
               min(p) + 1.0 AS ask_low
        FROM (SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN substr(c_mktsegment, 1, 6)
                          ELSE substr(c_mktsegment, 1, 6) || '.FXCM' END AS ts_code,
                     strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS trade_date,
                     o_totalprice AS p
              FROM orders JOIN customer ON o_custkey = c_custkey) j
        GROUP BY ts_code, trade_date""", ()),
    "date_text": ("""
        SELECT o_orderkey,
               CASE o_orderkey % 6
                    WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m%d')
                    WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
                    WHEN 2 THEN strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d')
                    WHEN 3 THEN 'bad'
                    WHEN 4 THEN NULL
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS raw_date
        FROM orders""", ()),
    "text_bars": ("""
        SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS instrument_id,
               CASE o_orderkey % 6
                    WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m%d')
                    WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
                    WHEN 2 THEN strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d')
                    WHEN 3 THEN 'bad'
                    WHEN 4 THEN NULL
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS trade_date,
               CASE o_orderkey % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN '1.5d' WHEN 2 THEN '3f'
                    ELSE CAST(o_totalprice AS VARCHAR) END AS open,
               o_orderstatus AS close, o_custkey AS volume,
               CAST(o_orderdate AS VARCHAR) AS updated_at, o_orderpriority AS comment
        FROM orders""", ()),
    "quote_candidates": ("""
        SELECT lower(c_mktsegment) AS ticker, c_custkey AS rank,
               CASE WHEN c_mktsegment <> 'MACHINERY' AND c_custkey % 7 = 3 THEN c_mktsegment
                    ELSE c_mktsegment || '-' || CAST(c_custkey AS VARCHAR) END AS symbol,
               CASE c_custkey % 8 WHEN 0 THEN 'EQUITY' WHEN 1 THEN 'ETF' WHEN 2 THEN 'MUTUALFUND'
                    WHEN 3 THEN 'INDEX' WHEN 4 THEN 'FUTURE' WHEN 5 THEN 'CURRENCY'
                    WHEN 6 THEN 'CRYPTOCURRENCY' ELSE 'other' END AS quoteType,
               'N' || CAST(c_nationkey AS VARCHAR) AS exchange,
               CASE WHEN c_custkey % 2 = 0 THEN c_name END AS shortname,
               'alt ' || c_name AS shortname_1
        FROM customer""", ()),
    "requested_tickers": ("""
        SELECT DISTINCT lower(c_mktsegment) AS ticker FROM customer
        UNION SELECT 'none' AS ticker""", ()),
}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str, *names: str) -> str:
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in _order(names))
    return f"WITH {ctes}\n{body}"


def parse_date_sql(text: str) -> str:
    """D1 in DuckDB: same branch order as the Spark expression."""
    return (
        f"CAST(CASE WHEN {text} IS NULL THEN NULL "
        f"WHEN length({text}) = 8 THEN try_strptime({text}, '%Y%m%d') "
        f"WHEN contains({text}, '-') THEN try_strptime({text}, '%Y-%m-%d') "
        f"ELSE try_strptime({text}, '%Y/%m/%d') END AS DATE)"
    )


def head_tail_sql(source: str, id_cols: str, start: str, end: str) -> str:
    """Head/tail gap rule over ``source(first_date, last_date)`` in SQL."""
    ids = f"{id_cols}, " if id_cols else ""
    s, e = f"DATE '{start}'", f"DATE '{end}'"
    return f"""
        SELECT {ids}{s} AS range_start, {e} AS range_end FROM {source}
        WHERE first_date IS NULL OR last_date IS NULL
        UNION ALL
        SELECT {ids}{s} AS range_start, CAST(first_date - INTERVAL 1 DAY AS DATE) AS range_end
        FROM {source} WHERE first_date IS NOT NULL AND last_date IS NOT NULL AND {s} < first_date
        UNION ALL
        SELECT {ids}CAST(last_date + INTERVAL 1 DAY AS DATE) AS range_start, {e} AS range_end
        FROM {source} WHERE first_date IS NOT NULL AND last_date IS NOT NULL AND {e} > last_date"""


def upsert_sql(stored: str, incoming: str, columns, keys) -> str:
    """S10 in SQL: stored rows without an incoming row of their key, and all incoming rows."""
    same = " AND ".join(f"i.{k} = s.{k}" for k in keys)
    names = ", ".join(columns)
    return f"""
    SELECT {names} FROM ({stored}) s WHERE NOT EXISTS (SELECT 1 FROM ({incoming}) i WHERE {same})
    UNION ALL SELECT {names} FROM ({incoming}) n"""


def stored_state_sql(mapped: str) -> str:
    """Twin of ``fixtures.stored_state``."""
    return f"""
    SELECT * REPLACE (CASE WHEN ascii(substr(instrument_id, 6, 1)) % 2 = 0 THEN instrument_id
                           ELSE instrument_id || '~' END AS instrument_id, 'stored' AS source_code)
    FROM ({mapped}) m"""
