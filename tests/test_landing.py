"""Landing scans (S1-S6): contract schema, field choice, windows, S6."""

import datetime as dt

import pytest

from tidemark.schema import LANDING
from tidemark.sources import landing as L


def _land(spark, tmp_root, dataset, rows, name=None):
    path = f"{tmp_root}/{name or dataset}"
    spark.createDataFrame(rows, LANDING[dataset]).write.parquet(path)
    return path


def _daily(code, day, pct=5.0):
    return (code, day, 1.0, 2.0, 0.5, 1.5, 1.0, 0.5, pct, 10.0, 3.0)


def test_daily_window_inclusive_and_fraction(spark, tmp_root):
    path = _land(spark, tmp_root, "fund_daily",
                 [_daily("a.SH", d) for d in ("20260531", "20260601", "20260618", "20260619")])
    df = L.daily_feed(spark, path, "fund_daily", start="2026-06-01", end=dt.date(2026, 6, 18))
    rows = sorted((r["trade_date"], r["pct_chg"]) for r in df.collect())
    assert rows == [("20260601", 0.05), ("20260618", 0.05)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "20260601" in plan


def test_stock_daily_keeps_percent_and_fields(spark, tmp_root):
    path = _land(spark, tmp_root, "daily", [_daily("a.SH", "20260601")])
    df = L.daily_feed(spark, path, "daily", fields="ts_code,trade_date,pct_chg")
    assert df.columns == ["ts_code", "trade_date", "pct_chg"]
    assert df.collect()[0]["pct_chg"] == 5.0


def test_index_feed_api_check(spark, tmp_root):
    path = _land(spark, tmp_root, "index_global", [_daily("HKTECH", "20260601")])
    assert L.index_feed(spark, path, "index_global").collect()[0]["pct_chg"] == 0.05
    assert L.index_feed(spark, path, "fut_index_daily").collect()[0]["pct_chg"] == 5.0
    with pytest.raises(ValueError):
        L.index_feed(spark, path, "bogus")


def test_history_end_inclusive_for_dates_exclusive_for_text(spark, tmp_root):
    rows = [("T", dt.datetime(2026, 6, d), 1.0, 1.0, 1.0, 1.0, None, 1.0, None, None) for d in (1, 8, 9)]
    path = _land(spark, tmp_root, "history", rows)
    by_date = L.price_history(spark, path, ["T"], start=dt.date(2026, 6, 1), end=dt.date(2026, 6, 9))
    by_text = L.price_history(spark, path, ["T"], start="2026-06-01", end="2026-06-09")
    assert by_date.count() == 3 and by_text.count() == 2


def test_instrument_list_params(spark, tmp_root):
    rows = [("a", "x", "n", None, None, None, None, None, "CSI", None, None, None, None, None)]
    schema_cols = LANDING["index_basic"].fieldNames()
    path = f"{tmp_root}/ib"
    spark.createDataFrame([dict(zip(schema_cols, ["a.CSI", "n", "f", "CSI"] + [None] * 8)),
                           dict(zip(schema_cols, ["b.SH", "n", "f", "SSE"] + [None] * 8))],
                          LANDING["index_basic"]).write.parquet(path)
    got = L.instrument_list(spark, path, "index_basic", market=["CSI"]).collect()
    assert [r["ts_code"] for r in got] == ["a.CSI"]


def test_special_treatment_window(spark, tmp_root):
    rows = [("a.SZ", "*ST A", d, "ST", "risk") for d in ("20260531", "20260601", "20260602")]
    path = _land(spark, tmp_root, "stock_st", rows)
    got = L.special_treatment(spark, path, start="20260601", end="20260602", fields=["ts_code", "trade_date"])
    assert got.columns == ["ts_code", "trade_date"]
    assert sorted(r["trade_date"] for r in got.collect()) == ["20260601", "20260602"]


def test_quote_search_result_cap_is_the_calls_parameter(spark, tmp_root):
    rows = [("nvda", r, f"S{r}", "EQUITY", "E", None, None) for r in range(1, 9)]
    path = _land(spark, tmp_root, "quotes", rows)
    assert L.quote_search(spark, path, "nvda").count() == 8          # no cap by default
    assert L.quote_search(spark, path, ["nvda"], max_results=5).count() == 5


def test_nan_becomes_null_on_read(spark, tmp_root):
    path = _land(spark, tmp_root, "fut_daily",
                 [("f", "20260601") + (float("nan"),) + (1.0,) * 13])
    r = L.read_landing(spark, path, "fut_daily").collect()[0]
    assert r["pre_close"] is None and r["pre_settle"] == 1.0


@pytest.mark.parametrize("dataset", sorted(LANDING))
def test_every_contract_roundtrips_through_files(spark, tmp_root, dataset):
    schema = LANDING[dataset]
    path = f"{tmp_root}/{dataset}"
    spark.createDataFrame([tuple(None for _ in schema.fields)], schema).write.parquet(path)
    back = L.read_landing(spark, path, dataset)
    assert [(f.name, f.dataType) for f in back.schema.fields] == \
        [(f.name, f.dataType) for f in schema.fields]
    assert back.count() == 1


def test_fraction_rule_applies_once(spark, tmp_root):
    path = _land(spark, tmp_root, "index_daily", [_daily("a.SH", "20260601", pct=5.0)])
    scanned = L.daily_feed(spark, path, "index_daily")
    again = L.pct_to_fraction_at_scan(L.pct_to_fraction_at_scan(scanned, "index_daily"), "index_daily")
    assert again.collect()[0]["pct_chg"] == 0.05


def test_window_keeps_every_date_shape(spark, tmp_root):
    days = ["20260601", "2026-06-01", "2026/06/01", "2026/6/02", "20260602", "20260531", "2026-06-03", "2025-06-01", "bad"]
    path = _land(spark, tmp_root, "stock_st", [("a.SZ", "n", d, "ST", "r") for d in days])
    got = [r["trade_date"] for r in L.special_treatment(spark, path, "2026-06-01", "2026-06-02").collect()]
    assert sorted(got) == sorted(days[:5])
    one = L.where_window(L.read_landing(spark, path, "stock_st"), "trade_date", trade_date="20260601")
    assert sorted(r["trade_date"] for r in one.collect()) == sorted(days[:3])


def test_long_windows_keep_every_shape(spark):
    """A window of thousands of years is one range on the text, not a term for each."""
    days = ["00010101", "1999-1-2", "2026/01/05", "20260106", "9999-12-31", "x", None]
    df = spark.createDataFrame([(d,) for d in days], "trade_date string")
    whole = L.text_window("trade_date", dt.date(1, 1, 1), dt.date(9999, 12, 31))
    assert [r[0] for r in df.where(whole).collect()] == days[:5]
    assert str(whole).count("trade_date") == 2
