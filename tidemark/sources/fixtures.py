"""Adapter views: market-shaped inputs derived from the driver's tables.

The driver's tables hold no market data, so the registered queries run the
operators over these views. Each view is a plain projection / aggregate of a
whole driver table (its work grows with the table) and has a twin written in
SQL in :mod:`tidemark.plans.oracle`; keep the two in step.

``id6(k)`` = k as six-or-more digits plus a suffix by ``k mod 4``:
0 ``.SH``, 1 ``.SZ``, 2 ``.CSI``, 3 ``.NH``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import date_to_text, lit_date, lit_timestamp_ntz
from tidemark.operators.store import ARRIVAL

# Fixed values shared with the SQL twins.
SUFFIXES = [".SH", ".SZ", ".CSI", ".NH"]
STORED_AT = "2026-01-01 00:00:00"
LOADED_AT = "2026-06-01 00:00:00"
QUOTE_TYPES = ["EQUITY", "ETF", "MUTUALFUND", "INDEX", "FUTURE", "CURRENCY", "CRYPTOCURRENCY", "other"]
WIDE_TICKERS = ["A", "N", "R"]
WIDE_FIELDS = {"Open": "min", "Close": "max", "Volume": "sum"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id6(k: Column) -> Column:
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (F.pmod(k, F.lit(4)) + 1).cast("int"))
    digits = k.cast("string")
    six = F.when(k >= 0, F.concat(F.repeat(F.lit("0"), 6 - F.length(digits)), digits)).otherwise(F.format_string("%06d", k))
    return F.concat(six, suffix)


def stored_at() -> Column:
    return lit_timestamp_ntz(STORED_AT)


def loaded_at() -> Column:
    return lit_timestamp_ntz(LOADED_AT)


# ---------------------------------------------------------------- bars --------

def bars_keyed(spark, sf_dir) -> DataFrame:
    """bars + the part key ``k``: one bar per (part, ship date) of lineitem.
    close is 0 on the 13th and null on the 14th of a month."""
    li = table(spark, sf_dir, "lineitem")
    d = F.col("l_shipdate").cast(T.DateType())
    agg = li.groupBy(F.col("l_partkey").alias("k"), d.alias("trade_date")).agg(
        F.min("l_extendedprice").alias("open"),
        F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("_max"),
        F.sum("l_quantity").alias("volume"),
    )
    day = F.dayofmonth("trade_date")
    close = F.when(day == 13, F.lit(0.0)).when(day == 14, F.lit(None)).otherwise(F.col("_max"))
    return agg.select(
        "k", id6(F.col("k")).alias("instrument_id"), "trade_date", "open", "high", "low",
        close.cast(T.DoubleType()).alias("close"), "volume", F.col("_max").alias("amount"),
    )


def bars(spark, sf_dir) -> DataFrame:
    return bars_keyed(spark, sf_dir).drop("k")


def _bar_source(k: Column) -> Column:
    return F.when(F.pmod(k, F.lit(3)) == 0, F.lit("yfinance")).otherwise(F.lit("tushare"))


def stored_bars(spark, sf_dir) -> DataFrame:
    """Canonical market_bars_daily state: every bar; source 'yfinance' when
    k mod 3 = 0 else 'tushare' (so instruments of the other source have no
    tushare state)."""
    return _stored(bars_keyed(spark, sf_dir))


def stored_half(spark, sf_dir) -> DataFrame:
    """The state before a load: the bars whose key (k, day) is even. What lands
    is every bar, so both halves of lineitem are read."""
    day = F.dayofyear("trade_date")
    return _stored(bars_keyed(spark, sf_dir).where(F.pmod(F.col("k") + day, F.lit(2)) == 0))


def stored_renamed(spark, sf_dir) -> DataFrame:
    """A state with every bar, those of odd months under ids that no batch
    brings: a load of all bars replaces the others and leaves these."""
    odd = F.pmod(F.month("trade_date"), F.lit(2)) == 1
    return stored_bars(spark, sf_dir).withColumn(
        "instrument_id", F.when(odd, F.concat("instrument_id", F.lit("~"))).otherwise(F.col("instrument_id")))


def stored_middle(spark, sf_dir) -> DataFrame:
    """A state with earlier and later days missing: every second day of the
    bars, moved together to half the span from 1996 on."""
    days = F.datediff("trade_date", lit_date("1995-01-01"))
    b = bars_keyed(spark, sf_dir).where(F.pmod(days, F.lit(2)) == 0)
    return _stored(b.withColumn("trade_date", F.date_add(lit_date("1996-01-01"), (days / 2).cast("int"))))


def _stored(b: DataFrame) -> DataFrame:
    null = F.lit(None).cast(T.DoubleType())
    return b.select(
        "instrument_id", "trade_date", "open", "high", "low", "close",
        null.alias("pre_close"), null.alias("change"), null.alias("pct_chg"),
        "volume", "amount", F.col("instrument_id").alias("source_code"),
        _bar_source(F.col("k")).alias("source_id"), stored_at().alias("updated_at"),
    )


def history(spark, sf_dir) -> DataFrame:
    """Yahoo-style long history over every bar (landing contract ``history``)."""
    b = bars(spark, sf_dir)
    null = F.lit(None).cast(T.DoubleType())
    return b.select(
        F.col("instrument_id").alias("ticker"),
        F.col("trade_date").cast(T.TimestampNTZType()).alias("date"),
        "open", "high", "low", "close", null.alias("adj_close"), "volume",
        null.alias("dividends"), null.alias("stock_splits"),
    )


def _vendor_date(k: Column, day: Column) -> Column:
    """Vendor text dates: mostly compact, dashed for k mod 5 = 1, slashed for 2."""
    m = F.pmod(k, F.lit(5))
    return (F.when(m == 1, F.date_format(day, "yyyy-MM-dd")).when(m == 2, F.date_format(day, "yyyy/MM/dd"))
            .otherwise(F.date_format(day, "yyyyMMdd")))


def daily_landing(spark, sf_dir) -> DataFrame:
    """Vendor daily-bar landing (contract ``daily``): text trade_date in every
    accepted shape, amount in thousands, pct_chg in percent."""
    b = bars_keyed(spark, sf_dir)
    null = F.lit(None).cast(T.DoubleType())
    return b.select(
        F.col("instrument_id").alias("ts_code"),
        _vendor_date(F.col("k"), F.col("trade_date")).alias("trade_date"),
        "open", "high", "low", "close", null.alias("pre_close"),
        (F.col("high") - F.col("low")).alias("change"),
        (F.col("high") - F.col("low")).alias("pct_chg"),
        F.col("volume").alias("vol"),
        F.col("amount").alias("amount"),
    )


def fut_daily_landing(spark, sf_dir) -> DataFrame:
    """Vendor futures daily landing (contract ``fut_daily``)."""
    b = bars(spark, sf_dir)
    null = F.lit(None).cast(T.DoubleType())
    return b.select(
        F.col("instrument_id").alias("ts_code"),
        date_to_text("trade_date").alias("trade_date"),
        null.alias("pre_close"), F.col("low").alias("pre_settle"),
        "open", "high", "low", "close", F.col("high").alias("settle"),
        (F.col("high") - F.col("low")).alias("change1"), null.alias("change2"),
        F.col("volume").alias("vol"), "amount",
        (F.col("volume") * 2).alias("oi"), null.alias("oi_chg"), null.alias("delv_settle"),
    )


# ---------------------------------------------------------------- instruments -

def _base_date(k: Column) -> Column:
    return F.date_add(lit_date("1995-01-01"), F.pmod(k, F.lit(2500)).cast("int"))


def _kind(p_type: Column, values) -> Column:
    fund, index, future, other = values
    return (
        F.when(p_type.startswith("ECONOMY"), F.lit(fund))
        .when(p_type.startswith("LARGE"), F.lit(index))
        .when(p_type.startswith("MEDIUM"), F.lit(future))
        .otherwise(F.lit(other))
    )


def instruments(spark, sf_dir) -> DataFrame:
    """reference_instrument-shaped view over part (one row per part)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    iid = id6(k)
    return p.select(
        iid.alias("instrument_id"),
        iid.alias("symbol"),
        F.concat(F.col("p_name"), F.when(F.pmod(k, F.lit(13)) == 0, F.lit(" USD")).otherwise(F.lit(""))).alias("name"),
        F.concat(F.col("p_name"), F.when(F.pmod(k, F.lit(17)) == 0, F.lit(" 全收益")).otherwise(F.lit(""))).alias("full_name"),
        _kind(F.col("p_type"), ("fund", "index", "future", "equity")).alias("asset_class"),
        _kind(F.col("p_type"), ("etf", "index", "future", "stock")).alias("instrument_type"),
        F.when(F.pmod(F.col("p_size"), F.lit(5)) == 0, F.lit("D")).otherwise(F.lit("L")).alias("list_status"),
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit(None).cast(T.DateType())).otherwise(_base_date(k)).alias("list_date"),
        F.when(F.pmod(k, F.lit(7)) == 0, F.date_add(_base_date(k), 1000)).alias("exp_date"),
        F.when(F.pmod(k, F.lit(9)) == 0, F.lit("yfinance")).otherwise(F.lit("tushare")).alias("source_id"),
    )


def futures_reference(spark, sf_dir) -> DataFrame:
    """reference_future-shaped view: the future rows of ``instruments``,
    last_ddate = exp_date, delist_date null."""
    i = instruments(spark, sf_dir).where(F.col("asset_class") == "future")
    return i.select(
        "instrument_id", "list_date", F.lit(None).cast(T.DateType()).alias("delist_date"),
        F.col("exp_date").alias("last_ddate"), "source_id",
    )


def _text_date(d: Column, fmt: str) -> Column:
    return F.date_format(d, fmt)


def stock_basic_landing(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        id6(k).alias("ts_code"), F.format_string("%06d", k).alias("symbol"),
        F.col("p_name").alias("name"), F.lit(None).cast("string").alias("area"),
        F.col("p_type").alias("industry"),
        F.concat_ws(" ", F.col("p_brand"), F.col("p_name")).alias("fullname"),
        F.lit(None).cast("string").alias("enname"), F.lit(None).cast("string").alias("cnspell"),
        F.col("p_brand").alias("market"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.lit("SSE")).otherwise(F.lit("SZSE")).alias("exchange"),
        F.lit("CNY").alias("curr_type"),
        F.when(F.pmod(F.col("p_size"), F.lit(5)) == 0, F.lit("D")).otherwise(F.lit("L")).alias("list_status"),
        _text_date(_base_date(k), "yyyyMMdd").alias("list_date"),
        F.when(F.pmod(F.col("p_size"), F.lit(5)) == 0, _text_date(F.date_add(_base_date(k), 900), "yyyyMMdd")).alias("delist_date"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None)).when(F.pmod(k, F.lit(3)) == 1, F.lit("N")).otherwise(F.lit("H")).alias("is_hs"),
        F.lit(None).cast("string").alias("act_name"), F.lit(None).cast("string").alias("act_ent_type"),
    )


def etf_basic_landing(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        id6(k).alias("ts_code"), F.col("p_brand").alias("csname"), F.lit(None).cast("string").alias("extname"),
        F.col("p_name").alias("cname"), id6(F.col("p_size").cast("bigint")).alias("index_code"),
        F.col("p_type").alias("index_name"), F.lit(None).cast("string").alias("setup_date"),
        _text_date(_base_date(k), "yyyy-MM-dd").alias("list_date"),
        F.when(F.pmod(F.col("p_size"), F.lit(5)) == 0, F.lit("D")).otherwise(F.lit("L")).alias("list_status"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.lit("SH")).otherwise(F.lit("SZ")).alias("exchange"),
        F.col("p_brand").alias("mgr_name"), F.lit(None).cast("string").alias("custod_name"),
        F.col("p_retailprice").alias("mgt_fee"), F.lit("ETF").alias("etf_type"),
    )


def index_basic_landing(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    markets = F.element_at(F.array(F.lit("SSE"), F.lit("SZSE"), F.lit("CSI")), (F.pmod(k, F.lit(3)) + 1).cast("int"))
    return p.select(
        id6(k).alias("ts_code"), F.col("p_name").alias("name"),
        F.concat_ws(" ", F.col("p_name"), F.col("p_type")).alias("fullname"),
        markets.alias("market"), F.col("p_brand").alias("publisher"),
        F.col("p_type").alias("index_type"), F.col("p_type").alias("category"),
        F.lit(None).cast("string").alias("base_date"), F.col("p_retailprice").alias("base_point"),
        _text_date(_base_date(k), "yyyy/MM/dd").alias("list_date"),
        F.lit(None).cast("string").alias("weight_rule"),
        F.when(F.pmod(k, F.lit(7)) == 0, _text_date(F.date_add(_base_date(k), 1000), "yyyyMMdd")).alias("exp_date"),
    )


def fut_basic_landing(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        id6(k).alias("ts_code"), F.format_string("%06d", k).alias("symbol"),
        F.element_at(F.array(*[F.lit(x) for x in ["CFFEX", "DCE", "CZCE", "SHFE", "INE", "GFEX"]]),
                     (F.pmod(k, F.lit(6)) + 1).cast("int")).alias("exchange"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("fut_code"),
        F.col("p_retailprice").alias("multiplier"), F.lit("t").alias("trade_unit"),
        F.col("p_size").cast("double").alias("per_unit"), F.lit("CNY/t").alias("quote_unit"),
        F.lit(None).cast("string").alias("quote_unit_desc"), F.lit(None).cast("string").alias("d_mode_desc"),
        _text_date(_base_date(k), "yyyyMMdd").alias("list_date"),
        _text_date(F.date_add(_base_date(k), 365), "yyyyMMdd").alias("delist_date"),
        _text_date(_base_date(k), "yyyyMM").alias("d_month"),
        F.when(F.pmod(k, F.lit(7)) == 0, _text_date(F.date_add(_base_date(k), 1000), "yyyyMMdd")).alias("last_ddate"),
    )


# ---------------------------------------------------------------- events ------

def updates(spark, sf_dir) -> DataFrame:
    """Keep-latest input: key (user_id, trade_date = date(ts)), ordinal event_id."""
    e = table(spark, sf_dir, "events")
    return e.select("user_id", F.col("ts").cast(T.DateType()).alias("trade_date"),
                    "event_id", "ts", "event_type", "value", "props")


def stock_st_landing(spark, sf_dir, *also) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        id6(F.col("user_id")).alias("ts_code"), F.concat(F.lit("ST "), F.col("user_id").cast("string")).alias("name"),
        date_to_text(F.col("ts").cast(T.DateType())).alias("trade_date"),
        F.col("event_type").alias("type"), F.upper("event_type").alias("type_name"), *also,
    )


# ---------------------------------------------------------------- orders ------

def fx_landing(spark, sf_dir) -> DataFrame:
    """fx_daily landing: pairs from the customer's segment (no suffix for
    MACHINERY, to exercise the exchange fallback), quotes from order totals."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    seg = F.substring("c_mktsegment", 1, 6)
    code = F.when(F.col("c_mktsegment") == "MACHINERY", seg).otherwise(F.concat(seg, F.lit(".FXCM")))
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    g = j.groupBy(code.alias("ts_code"), date_to_text(F.col("o_orderdate").cast(T.DateType())).alias("trade_date"))
    lo, hi = F.min("o_totalprice"), F.max("o_totalprice")
    return g.agg(
        lo.alias("bid_open"), hi.alias("bid_close"), hi.alias("bid_high"), lo.alias("bid_low"),
        hi.alias("ask_open"), (hi + 1.0).alias("ask_close"), (hi + 2.0).alias("ask_high"), (lo + 1.0).alias("ask_low"),
    )


def _mixed_date_text(k: Column, ts: Column) -> Column:
    """Dates as text in mixed shapes, by key mod 6."""
    d = ts.cast(T.DateType())
    m = F.pmod(k, F.lit(6))
    return (
        F.when(m == 0, F.date_format(d, "yyyyMMdd"))
        .when(m == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(m == 2, F.date_format(d, "yyyy/MM/dd"))
        .when(m == 3, F.lit("bad"))
        .when(m == 4, F.lit(None).cast("string"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )


def date_text(spark, sf_dir) -> DataFrame:
    """Dates as text in mixed shapes, by o_orderkey mod 6."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    _mixed_date_text(F.col("o_orderkey"), F.col("o_orderdate")).alias("raw_date"))


def text_bars(spark, sf_dir) -> DataFrame:
    """A bar batch landed as text (every order a row): mixed date shapes,
    'n/a', '1.5d' and '3f' prices, a status letter where a number belongs, a bigint volume,
    an instant as text and an extra column (conform input)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("O"), k.cast("string")).alias("instrument_id"),
        _mixed_date_text(k, F.col("o_orderdate")).alias("trade_date"),
        F.when(F.pmod(k, F.lit(7)) == 0, F.lit("n/a"))
         .when(F.pmod(k, F.lit(7)) == 1, F.lit("1.5d")).when(F.pmod(k, F.lit(7)) == 2, F.lit("3f"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("open"),
        F.col("o_orderstatus").alias("close"),
        F.col("o_custkey").alias("volume"),
        F.col("o_orderdate").cast("string").alias("updated_at"),
        F.col("o_orderpriority").alias("comment"),
    )


def nan_lines(spark, sf_dir) -> DataFrame:
    """Line items with NaN marking missing discounts/taxes (NaN -> null input)."""
    li = table(spark, sf_dir, "lineitem")
    nan = F.lit(float("nan"))
    n = F.col("l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(n == 1, nan).otherwise(F.col("l_discount")).alias("discount"),
        F.when(n == 2, nan).otherwise(F.col("l_tax")).alias("tax"),
        "l_returnflag",
    )


def union_left(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where(F.coalesce(F.col("o_orderstatus"), F.lit("")) == "F").select(
        "o_orderkey", "o_custkey", "o_totalprice")


def union_right(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    extra = F.when(F.pmod(F.col("o_orderkey"), F.lit(2)) == 0, F.col("o_custkey").cast("string")).otherwise(F.col("o_orderpriority"))
    return o.where(F.coalesce(F.col("o_orderstatus"), F.lit("")) != "F").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), extra.alias("extra"))


# ---------------------------------------------------------------- customer ----

def quote_candidates(spark, sf_dir) -> DataFrame:
    """Search candidates (contract ``quotes``): every customer is a candidate
    for its segment's lower-case ticker, ranked by c_custkey."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    symbol = F.when((seg != "MACHINERY") & (F.pmod(k, F.lit(7)) == 3), seg).otherwise(
        F.concat(seg, F.lit("-"), k.cast("string")))
    qtype = F.element_at(F.array(*[F.lit(q) for q in QUOTE_TYPES]), (F.pmod(k, F.lit(8)) + 1).cast("int"))
    return c.select(
        F.lower(seg).alias("ticker"), k.alias("rank"), symbol.alias("symbol"), qtype.alias("quoteType"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("exchange"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.col("c_name")).alias("shortname"),
        F.concat(F.lit("alt "), F.col("c_name")).alias("shortname_1"),
    )


def requested_tickers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    segs = c.select(F.lower("c_mktsegment").alias("ticker")).distinct()
    none = spark.range(1).select(F.lit("none").alias("ticker"))
    return segs.unionByName(none).distinct()


# ---------------------------------------------------------------- stored state -

def stored_state(mapped: DataFrame) -> DataFrame:
    """A table before a load, from the rows that the load will bring: those
    whose id has an even sixth character, under source code 'stored' (the load
    replaces them), and the others under ids that the load lacks (they stay)."""
    even = F.pmod(F.ascii(F.substring("instrument_id", 6, 1)), F.lit(2)) == 0
    iid = F.when(even, F.col("instrument_id")).otherwise(F.concat("instrument_id", F.lit("~")))
    return mapped.withColumns({"instrument_id": iid, "source_code": F.lit("stored")})


def special_landed(spark, sf_dir) -> DataFrame:
    """``stock_st`` landing with several rows for a key, and the order in which they landed."""
    return stock_st_landing(spark, sf_dir, F.col("event_id").alias(ARRIVAL))


# ---------------------------------------------------------------- wide --------

def wide_bars(spark, sf_dir) -> DataFrame:
    """Wide history: one row per ship date, columns ``<flag>|Open``,
    ``<flag>|Close``, ``<flag>|Volume`` per return flag (ticker-first)."""
    li = table(spark, sf_dir, "lineitem")
    d = F.col("l_shipdate").cast(T.DateType())
    aggs = []
    for t in WIDE_TICKERS:
        hit = F.col("l_returnflag") == t
        aggs += [
            F.min(F.when(hit, F.col("l_extendedprice"))).alias(f"{t}|Open"),
            F.max(F.when(hit, F.col("l_extendedprice"))).alias(f"{t}|Close"),
            F.sum(F.when(hit, F.col("l_quantity"))).alias(f"{t}|Volume"),
        ]
    g = li.groupBy(d.alias("_d")).agg(*aggs)
    return g.select(F.col("_d").cast(T.TimestampNTZType()).alias("Date"), *[c for c in g.columns if c != "_d"])
