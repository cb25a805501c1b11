"""Mappings and scalar rules on literal fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.dates import lenient_date, lit_timestamp_ntz
from tidemark.functions.quotes import asset_class_of, instrument_type_of
from tidemark.operators import newkeys as J
from tidemark.operators import transforms as P

def now():
    return lit_timestamp_ntz("2026-06-01 00:00:00")


def test_date_shapes(spark):
    rows = [("20260102",), ("2026-01-02",), ("2026/1/02",), ("2026-1-2",), ("bad",), (None,),
            ("2026-01-02 10:00:00",), ("2026/1/2",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(lenient_date("s")).collect()]
    d = dt.date(2026, 1, 2)
    assert got == [d, d, d, None, None, None, None, None]  # 8 chars -> yyyyMMdd (Q15)


def test_is_hs(spark):
    df = spark.createDataFrame([("a.SZ", None), ("b.SZ", "N"), ("c.SZ", "H")], "ts_code string, is_hs string")
    out = {r["instrument_id"]: r["is_hs"] for r in P.stock_list(df).collect()}
    assert out == {"a.SZ": False, "b.SZ": False, "c.SZ": True}


def test_fx_reference(spark):
    df = spark.createDataFrame([("EURUSD",), ("USDCNH.FXCM",), ("eur.X",)], "ts_code string")
    out = {r["instrument_id"]: (r["exchange"], r["currency"]) for r in P.fx_reference(df).collect()}
    assert out == {"EURUSD": ("FX", "USD"), "USDCNH.FXCM": ("FXCM", "CNH"), "eur.X": ("X", None)}


def test_fx_mid_spread(spark):
    df = spark.createDataFrame([("P.FXCM", "20260601", 1.0, 3.0, 2.0, 6.0)],
                               "ts_code string, trade_date string, bid_open double, ask_open double, bid_close double, ask_close double")
    r = P.fx_daily(df, updated_at=now()).collect()[0]
    assert (r["mid_open"], r["mid_close"], r["spread_close"], r["bid_high"]) == (2.0, 4.0, 4.0, None)


def test_daily_bars_scaling(spark):
    df = spark.createDataFrame([("a.SZ", "20260601", 10.0, 2.5, 1.0)],
                               "ts_code string, trade_date string, close double, amount double, vol double")
    r = P.daily_bars(df, updated_at=now()).collect()[0]
    assert (r["amount"], r["volume"], str(r["trade_date"])) == (2500.0, 1.0, "2026-06-01")


def test_pct_to_fraction(spark):
    df = spark.createDataFrame([(5.0,)], "pct_chg double")
    assert P.pct_to_fraction(df).collect()[0][0] == 0.05


def test_first_new_row_has_no_pre_close(spark):
    """Q5: stored day 1, incoming days 1-3 -> day 2 pre_close null, day 3 = day 2 close."""
    stored = spark.createDataFrame(
        [("T", dt.date(2026, 6, 1), "yfinance")], "instrument_id string, trade_date date, source_id string")
    hist = spark.createDataFrame(
        [("T", dt.datetime(2026, 6, d), float(d)) for d in (1, 2, 3)],
        "ticker string, date timestamp_ntz, close double")
    out = P.yahoo_bars(J.new_rows(hist, stored, "ticker", "date", "yfinance"), updated_at=now())
    rows = {r["trade_date"].day: (r["pre_close"], r["change"], r["pct_chg"]) for r in out.collect()}
    assert rows == {2: (None, None, None), 3: (2.0, 1.0, 0.5)}


def test_new_rows_by_year_are_those_of_the_anti_join(spark):
    days = [dt.datetime(2025 + i % 3, 1 + i % 2, 1 + i % 5, i % 7) for i in range(60)] + [None]
    hist = spark.createDataFrame([(t, d, float(i)) for t in ("A", "B", None) for i, d in enumerate(days)] * 2,
                                 "ticker string, date timestamp_ntz, close double")
    stored = spark.createDataFrame(
        [(t, dt.date(2025 + i % 3, 1, 1 + i % 4) if i else None, "yfinance" if i % 2 else "tushare")
         for t in ("A", "C", None) for i in range(12)] * 2, "instrument_id string, trade_date date, source_id string")
    rows = lambda **k: sorted(map(tuple, J.new_rows(hist, stored, "ticker", "date", "yfinance", **k).collect()), key=str)
    assert rows(by_year=True) == rows() and 0 < len(rows()) < hist.count()


def test_pct_chg_zero_pre_close(spark):
    hist = spark.createDataFrame(
        [("T", dt.datetime(2026, 6, d), c) for d, c in ((1, 0.0), (2, 3.0))],
        "ticker string, date timestamp_ntz, close double")
    out = {r["trade_date"].day: r["pct_chg"] for r in P.yahoo_bars(hist, updated_at=now()).collect()}
    assert out == {1: None, 2: None}


def test_new_rows_keeps_null_keys(spark):
    stored = spark.createDataFrame([("T", dt.date(2026, 6, 1), "yfinance")],
                                   "instrument_id string, trade_date date, source_id string")
    hist = spark.createDataFrame([(None, dt.datetime(2026, 6, 1)), ("T", dt.datetime(2026, 6, 1))],
                                 "ticker string, date timestamp_ntz")
    assert [r["ticker"] for r in J.new_rows(hist, stored).collect()] == [None]


def test_quote_type_map(spark):
    df = spark.createDataFrame([("etf",), ("MutualFund",), ("weird",), (None,)], "q string")
    got = [(r[0], r[1]) for r in df.select(asset_class_of("q"), instrument_type_of("q")).collect()]
    assert got == [("fund", "etf"), ("fund", "mutual_fund"), ("unknown", "unknown"), ("unknown", "unknown")]


def test_future_universe_overlap(spark):
    from tidemark.operators import universe as U
    d = dt.date
    ref = spark.createDataFrame([
        ("a", d(2026, 1, 1), None, d(2026, 5, 31), "tushare"),   # ended before start
        ("b", d(2026, 1, 1), None, d(2026, 6, 1), "tushare"),    # ends on start
        ("c", None, None, None, "tushare"),                       # no list date
        ("e", d(2026, 7, 1), None, None, "tushare"),              # listed after end
        ("f", d(2026, 1, 1), d(2026, 6, 10), None, "tushare"),    # delist used as fallback
    ], "instrument_id string, list_date date, delist_date date, last_ddate date, source_id string")
    got = sorted(r[0] for r in U.future_universe(ref, "2026-06-01", "2026-06-18").collect())
    assert got == ["b", "f"]


def test_explicit_codes_precedence():
    from tidemark.operators import universe as U
    assert U.explicit_codes({"ts_code": "x", "ts_codes": ["b", "a"], "index_codes": None}) == ["a", "b"]
    assert U.explicit_codes({"ts_code": "x"}) == ["x"]
    assert U.explicit_codes({}) is None


def test_previous_close_across_years(spark):
    """The lag runs inside year segments; a segment's first row takes the
    last close of the previous non-empty year."""
    days = [dt.datetime(2024, 12, 30), dt.datetime(2024, 12, 31), dt.datetime(2026, 1, 2),
            dt.datetime(2026, 1, 5), dt.datetime(2027, 3, 1)]
    rows = [("T", d, float(i + 1)) for i, d in enumerate(days)] + [("U", dt.datetime(2026, 1, 1), 9.0)]
    hist = spark.createDataFrame(rows, "ticker string, date timestamp_ntz, close double")
    out = {(r["instrument_id"], r["trade_date"]): r["pre_close"]
           for r in P.yahoo_bars(hist, updated_at=now()).collect()}
    got = [out[("T", d.date())] for d in days]
    assert got == [None, 1.0, 2.0, 3.0, 4.0]
    assert out[("U", dt.date(2026, 1, 1))] is None
