"""Ticker resolution (O3, O4) and wide -> long reshape."""

import datetime as dt

from tidemark.operators import reshape as R
from tidemark.operators import tickers as O


def test_best_match_prefers_exact(spark):
    req = spark.createDataFrame([("nvda",), ("goog",), ("none",)], "ticker string")
    cand = spark.createDataFrame([
        ("nvda", 1, "NVDA.MX", "EQUITY", "MEX", None, "Nvidia MX"),
        ("nvda", 2, "NVDA", "EQUITY", "NMS", "NVIDIA", "Nvidia"),
        ("goog", 1, "GOOGL", "EQUITY", "NMS", None, None),
    ], "ticker string, rank int, symbol string, quoteType string, exchange string, "
       "shortname string, shortName string")
    out = {r["ticker"]: r for r in O.best_match(req, cand).collect()}
    assert (out["nvda"]["found"], out["nvda"]["matched_symbol"], out["nvda"]["short_name"]) == (True, "NVDA", "NVIDIA")
    assert (out["goog"]["found"], out["goog"]["matched_symbol"]) == (False, "GOOGL")
    assert (out["none"]["found"], out["none"]["reason"]) == (False, "No quote found")
    info = {r["ticker"]: r for r in O.ticker_info(O.best_match(req, cand)).collect()}
    assert info["nvda"]["valid"] and info["nvda"]["instrument_id"] == "NVDA"
    assert info["nvda"]["asset_class"] == "equity" and info["nvda"]["instrument_type"] == "stock"
    assert not info["goog"]["valid"] and info["goog"]["instrument_id"] is None


def test_short_name_falls_back_to_camel_spelling(spark):
    req = spark.createDataFrame([("x",)], "ticker string")
    cand = spark.createDataFrame([("x", 1, "X", "ETF", "E", None, "Camel")],
                                 "ticker string, rank int, symbol string, quoteType string, "
                                 "exchange string, shortname string, shortName string")
    assert O.best_match(req, cand).collect()[0]["short_name"] == "Camel"


def _wide(spark, cols, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols))


def test_ticker_first(spark):
    df = _wide(spark, [("Date", "timestamp_ntz"), ("A|Open", "double"), ("A|Adj Close", "double"),
                       ("B|Close", "double")],
               [(dt.datetime(2026, 6, 1), 1.0, 2.0, 3.0)])
    out = {r["ticker"]: r for r in R.wide_to_long(spark, df, ["A", "B", "Z"]).collect()}
    assert set(out) == {"A", "B"}
    assert (out["A"]["open"], out["A"]["adj_close"], out["A"]["close"]) == (1.0, 2.0, None)
    assert out["B"]["close"] == 3.0
    assert R.wide_to_long(spark, df, ["A"]).columns == R.HISTORY_COLUMNS


def test_field_first(spark):
    df = _wide(spark, [("Datetime", "timestamp_ntz"), ("Close|A", "double"), ("Stock Splits|A", "double")],
               [(dt.datetime(2026, 6, 1), 5.0, 0.5)])
    r = R.wide_to_long(spark, df, ["A"]).collect()[0]
    assert (r["ticker"], r["close"], r["stock_splits"]) == ("A", 5.0, 0.5)


def test_single_level_and_empty(spark):
    df = _wide(spark, [("Date", "timestamp_ntz"), ("Close", "double")], [(dt.datetime(2026, 6, 1), 7.0)])
    r = R.wide_to_long(spark, df, ["ONE"]).collect()[0]
    assert (r["ticker"], r["close"]) == ("ONE", 7.0)
    assert R.wide_to_long(spark, df, []).count() == 0
