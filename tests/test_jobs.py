"""Jobs on disk: keyed upsert (S10), raw keep-latest store (S7), snapshots,
month partitions, audit rows (S11), incremental plans."""

import datetime as dt

import pytest

from tidemark import schema as S
from tidemark.plans.jobs import Loader
from tidemark.schema import LANDING
from tidemark.functions.dates import month_key
from tidemark.sources.tables import Store, months_of

NOW = dt.datetime(2026, 6, 1)
KV = S.TableSpec("kv", S.struct("k:s, v:i?"), ("k",))


def kv(spark, rows):
    return spark.createDataFrame(rows, KV.schema)


def test_snapshot_upsert_and_duplicate_rejected(spark, tmp_root):
    store = Store(spark, tmp_root)
    assert store.upsert(KV, kv(spark, [("a", 1), ("b", 2)])) == 2
    assert store.upsert(KV, kv(spark, [("b", 9), ("c", 3)])) == 2
    assert {r["k"]: r["v"] for r in store.read(KV).collect()} == {"a": 1, "b": 9, "c": 3}
    with pytest.raises(ValueError, match="duplicate"):
        store.upsert(KV, kv(spark, [("b", 9), ("b", 8)]))
    assert {r["k"]: r["v"] for r in store.read(KV).collect()} == {"a": 1, "b": 9, "c": 3}
    assert store.upsert(KV, kv(spark, [])) == 0
    assert store.upsert(KV, spark.createDataFrame([], "k string")) == 0  # empty: no column check
    with pytest.raises(ValueError, match=r"lacks columns \['v'\]"):
        store.upsert(KV, spark.createDataFrame([("z",)], "k string"))


def _daily(code, day, close):
    return (code, day, close, close, close, close, None, None, 1.0, 10.0, 2.0)


def test_stock_daily_incremental_and_partitioned(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    landing = spark.createDataFrame(
        [_daily(c, f"202606{d:02d}", float(d)) for c in ("a.SZ", "b.SH") for d in range(1, 11)]
        + [_daily("a.SZ", "20260701", 99.0)],
        LANDING["daily"])
    r1 = loader.stock_daily(landing, "2026-06-03", "2026-06-05")
    assert (r1.raw_rows, r1.rows_written) == (6, 6)
    # second run over a wider window: only head and tail gaps are fetched
    r2 = loader.stock_daily(landing, "2026-06-01", "2026-07-01")
    assert r2.rows_written == 4 + 10 + 1
    bars = loader.table(S.MARKET_BARS_DAILY)
    assert bars.count() == 21
    row = bars.where("instrument_id = 'a.SZ' AND trade_date = DATE'2026-07-01'").collect()[0]
    assert (row["amount"], row["volume"], row["updated_at"]) == (2000.0, 10.0, NOW)
    # same window again: nothing missing
    assert loader.stock_daily(landing, "2026-06-01", "2026-07-01").rows_written == 0
    parts = spark.read.parquet(loader.db.path("market_bars_daily")).select("trade_month").distinct()
    assert sorted(r[0] for r in parts.collect()) == [202606, 202607]
    raw = loader.raw.read_raw("tushare/stock_daily")
    assert raw.count() == 21
    audit = loader.db.read_appended(S.UPDATE_EVENTS)
    assert audit.count() == 3 and {r["status"] for r in audit.collect()} == {"success"}
    assert audit.select("event_id").distinct().count() == 3  # audit key stays unique


def test_etf_job_uses_universe_and_plan(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    etf = spark.createDataFrame([
        ("e1.SH", "c", None, "ETF one", None, None, None, "20200101", "L", "SH", None, None, 0.5, "ETF"),
        ("e2.SZ", "c", None, "ETF two", None, None, None, None, "L", "SZ", None, None, 0.5, "ETF"),
        ("e3.SZ", "c", None, "ETF dead", None, None, None, "20200101", "D", "SZ", None, None, 0.5, "ETF"),
    ], LANDING["etf_basic"])
    assert loader.etf_list(etf).rows_written == 3
    feed = spark.createDataFrame(
        [_daily(c, f"202606{d:02d}", float(d)) for c in ("e1.SH", "e2.SZ", "e3.SZ") for d in (1, 2)],
        LANDING["fund_daily"])
    r = loader.etf_daily(feed, "2026-06-01", "2026-06-02")
    assert r.rows_written == 4  # e3 is delisted
    pct = {x["pct_chg"] for x in loader.table(S.MARKET_BARS_DAILY).collect()}
    assert pct == {0.01}
    assert loader.etf_daily(feed, "2026-06-01", "2026-06-02").rows_written == 0
    with pytest.raises(ValueError, match="No"):
        Loader(spark, tmp_root + "/empty").etf_daily(feed, "2026-06-01", "2026-06-02")


def test_fx_job_writes_reference_first(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    feed = spark.createDataFrame(
        [("USDCNH.FXCM", "20260601", 1.0, 2.0, 3.0, 0.5, 1.5, 2.5, 3.5, 1.0)], LANDING["fx_daily"])
    r = loader.fx_daily(feed, "2026-06-01", "2026-06-02", {"ts_codes": ["USDCNH.FXCM"]})
    assert r.rows_written == 2
    ref = loader.table(S.REFERENCE_INSTRUMENT).collect()[0]
    assert (ref["exchange"], ref["currency"], ref["asset_class"]) == ("FXCM", "CNH", "fx")
    fxrow = loader.table(S.MARKET_FX_DAILY).collect()[0]
    assert fxrow["mid_close"] == (2.0 + 2.5) / 2 and fxrow["spread_close"] == 0.5
    with pytest.raises(ValueError):
        loader.fx_daily(feed, "2026-06-01", "2026-06-02", {})


def test_yahoo_jobs(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    req = spark.createDataFrame([("nvda",), ("zzz",)], "ticker string")
    cand = spark.createDataFrame([("nvda", 1, "NVDA", "EQUITY", "NMS", "NVIDIA", None)], LANDING["quotes"])
    r = loader.yf_instrument(req, cand)
    assert (r.raw_rows, r.rows_written) == (2, 1)
    with pytest.raises(ValueError, match="requires tickers"):
        loader.yf_instrument(req.limit(0), cand)
    hist = spark.createDataFrame(
        [("NVDA", dt.datetime(2026, 6, d), 1.0, 1.0, 1.0, float(d), None, 5.0, None, None) for d in (1, 2, 3)],
        LANDING["history"])
    # Q8: a text end is exclusive, a date is inclusive
    assert loader.yf_market_bars_daily(hist, "2026-06-01", "2026-06-01").rows_written == 0
    assert loader.yf_market_bars_daily(hist, "2026-06-01", dt.date(2026, 6, 1)).rows_written == 1
    r2 = loader.yf_market_bars_daily(hist, "2026-06-01", dt.date(2026, 6, 3))
    assert (r2.raw_rows, r2.rows_written) == (3, 2)
    rows = {x["trade_date"].day: x["pre_close"] for x in loader.table(S.MARKET_BARS_DAILY).collect()}
    assert rows == {1: None, 2: None, 3: 2.0}  # Q5: first new row has no pre_close
    assert loader.raw.read_raw("yfinance/daily").count() == 3


def test_future_list_two_tables(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    fut = spark.createDataFrame([
        ("IF2606.CFX", "IF2606", "CFFEX", "IF", "IF", 300.0, None, None, None, None, None,
         "20260101", "20260619", "202606", "20260619"),
        ("XX.ZZ", "XX", "OTHER", "X", "X", 1.0, None, None, None, None, None, None, None, None, None),
    ], LANDING["fut_basic"])
    r = loader.future_list(fut)
    assert (r.raw_rows, r.rows_written) == (1, 2)
    fr = loader.table(S.REFERENCE_FUTURE).collect()[0]
    assert (str(fr["last_ddate"]), fr["updated_at"]) == ("2026-06-19", NOW)
    feed = spark.createDataFrame(
        [("IF2606.CFX", "20260601") + (1.0,) * 14], LANDING["fut_daily"])
    assert loader.future_daily(feed, "2026-06-01", "2026-06-01").rows_written == 1


def _bars(spark, rows):
    """rows: (instrument_id, day, source_id) -> market_bars_daily rows."""
    return spark.createDataFrame(
        [(i, dt.date(2026, 6, d), 1.0, None, None, 1.0, None, None, None, None, None, i, s, NOW)
         for i, d, s in rows], S.MARKET_BARS_DAILY.schema)


def _exact(store):
    t = store.read(S.MARKET_BARS_DAILY)
    return sorted(tuple(r) for r in t.groupBy("instrument_id", "source_id").agg(
        {"trade_date": "min"}).join(t.groupBy("instrument_id", "source_id").agg(
            {"trade_date": "max"}), ["instrument_id", "source_id"]).collect())


def _summary(store):
    c = store.coverage(S.MARKET_BARS_DAILY)
    return None if c is None else sorted(
        tuple(r) for r in c.select("instrument_id", "source_id", "first_date", "last_date").collect())


def test_coverage_summary_stays_exact(spark, tmp_root):
    store = Store(spark, tmp_root)
    store.upsert(S.MARKET_BARS_DAILY, _bars(spark, [("a", 5, "tushare"), ("a", 6, "tushare"),
                                                    ("b", 3, "yfinance")]))
    assert _summary(store) == _exact(store)
    store.upsert(S.MARKET_BARS_DAILY, _bars(spark, [("a", 9, "tushare"), ("c", 1, "tushare")]))
    assert _summary(store) == _exact(store)
    # a second vendor overwrites a's first day: tushare coverage of a shrinks
    store.upsert(S.MARKET_BARS_DAILY, _bars(spark, [("a", 5, "yfinance")]))
    assert _summary(store) == _exact(store)
    assert ("a", "tushare", dt.date(2026, 6, 6), dt.date(2026, 6, 9)) in _summary(store)


def test_plan_reads_summary(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    loader.db.upsert(S.MARKET_BARS_DAILY, _bars(spark, [("a", 5, "tushare"), ("a", 10, "tushare")]))
    ids = spark.createDataFrame([("a",), ("z",)], "instrument_id string")
    plan = loader._plan(ids, S.MARKET_BARS_DAILY, "2026-06-01", "2026-06-18")
    got = sorted((r[0], r[1].day, r[2].day) for r in plan.collect())
    assert got == [("a", 1, 4), ("a", 11, 18), ("z", 1, 18)]
    files = plan.inputFiles()
    assert any("/_coverage/" in f for f in files)
    assert not any("/market_bars_daily/trade_month=" in f for f in files)  # table not scanned


def _row(dataset, **values):
    return tuple(values.get(f) for f in LANDING[dataset].fieldNames())


def test_list_jobs_share_one_raw_store(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    stock = spark.createDataFrame([_row("stock_basic", ts_code="000001.SZ", symbol="000001",
                                        name="PA", fullname="Ping An", exchange="SZSE",
                                        curr_type="CNY", list_status="L", list_date="19910403",
                                        is_hs="S")], LANDING["stock_basic"])
    index = spark.createDataFrame([
        _row("index_basic", ts_code="000300.SH", name="CSI 300", fullname="CSI 300 Index",
             market="SSE", list_date="2005/04/08"),
        _row("index_basic", ts_code="H00300.CSI", name="CSI 300 TR", fullname="x", market="CSI"),
        _row("index_basic", ts_code="X.MSCI", name="msci", fullname="x", market="MSCI"),
    ], LANDING["index_basic"])
    assert loader.stock_list(stock).rows_written == 1
    assert loader.index_list(index).rows_written == 2  # MSCI is outside the default markets
    raw = loader.raw.read_raw("tushare/reference_instrument")
    assert sorted(r["ts_code"] for r in raw.collect()) == ["000001.SZ", "000300.SH", "H00300.CSI"]
    assert {"fullname", "is_hs", "publisher"} <= set(raw.columns)  # relaxed union of both lists
    ref = {r["instrument_id"]: r for r in loader.table(S.REFERENCE_INSTRUMENT).collect()}
    assert ref["000001.SZ"]["is_hs"] and str(ref["000001.SZ"]["list_date"]) == "1991-04-03"
    assert (ref["000300.SH"]["exchange"], ref["000300.SH"]["list_status"]) == ("SSE", "L")
    assert str(ref["000300.SH"]["list_date"]) == "2005-04-08"


def test_stock_st_whole_window(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    st = spark.createDataFrame([
        _row("stock_st", ts_code="a.SZ", name="*ST A", trade_date=f"202606{d:02d}", type="ST",
             type_name="risk") for d in (1, 2, 3)], LANDING["stock_st"])
    assert loader.stock_st(st, "2026-06-02", "2026-06-03").rows_written == 2
    # not incremental: the same window is loaded again (and stays unique by key)
    assert loader.stock_st(st, "2026-06-01", "2026-06-03").rows_written == 3
    assert loader.table(S.REFERENCE_INSTRUMENT_ST).count() == 3


def test_index_job_api(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    feed = spark.createDataFrame([_daily("HKTECH", "20260601", 1.0)], LANDING["index_global"])
    r = loader.index_daily(feed, "2026-06-01", "2026-06-01", api="index_global",
                           params={"index_codes": ["HKTECH"]})
    assert r.rows_written == 1
    assert loader.table(S.MARKET_BARS_DAILY).collect()[0]["pct_chg"] == 0.01
    with pytest.raises(ValueError):
        loader.index_daily(feed, "2026-06-01", "2026-06-01", api="nope", params={"ts_code": "x"})


def test_yahoo_bars_validate_tickers(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    req = spark.createDataFrame([("nvda",), ("goog",)], "ticker string")
    cand = spark.createDataFrame([("nvda", 1, "NVDA", "EQUITY", "NMS", None, None),
                                  ("goog", 1, "GOOGL", "EQUITY", "NMS", None, None)], LANDING["quotes"])
    hist = spark.createDataFrame(
        [(t, dt.datetime(2026, 6, 1), 1.0, 1.0, 1.0, 1.0, None, 5.0, None, None)
         for t in ("NVDA", "GOOGL", "nvda")], LANDING["history"])
    r = loader.yf_market_bars_daily(hist, "2026-06-01", "2026-06-02", tickers=req, candidates=cand)
    assert r.rows_written == 1  # only NVDA is an exact match; GOOGL is not 'goog'
    assert [x["instrument_id"] for x in loader.table(S.MARKET_BARS_DAILY).collect()] == ["NVDA"]


def test_upsert_reads_only_touched_months(spark, tmp_root):
    store = Store(spark, tmp_root)
    rows = [(i, d, "tushare") for i in ("a", "b") for d in (1, 2)]
    store.upsert(S.MARKET_BARS_DAILY, _bars(spark, rows))
    july = spark.createDataFrame(
        [("a", dt.date(2026, 7, 1), 2.0, None, None, 2.0, None, None, None, None, None, "a", "tushare", NOW)],
        S.MARKET_BARS_DAILY.schema)
    store.upsert(S.MARKET_BARS_DAILY, july)
    got = store.read_months(S.MARKET_BARS_DAILY, months_of(month_key("trade_date"), july))
    assert {f.rsplit("/", 2)[1] for f in got.inputFiles()} == {"trade_month=202607"}  # no other directory is opened
    assert got.count() == 1 and store.read(S.MARKET_BARS_DAILY).count() == 5


def test_merge_raw_default_keys(spark, tmp_root):
    store = Store(spark, tmp_root)
    rows = spark.createDataFrame([("a", dt.date(2026, 6, 1), 1.0), ("a", dt.date(2026, 6, 1), 2.0),
                                  ("b", dt.date(2026, 6, 1), 3.0)],
                                 "instrument_id string, trade_date date, close double")
    assert store.merge_raw("raw/x", rows) == 2  # keyed on (trade_date, instrument_id)
    more = spark.createDataFrame([("a", dt.date(2026, 6, 1), 5.0)],
                                 "instrument_id string, trade_date date, close double")
    assert store.merge_raw("raw/x", more) == 2
    assert store.merge_raw("raw/x", more.limit(0)) == 2  # empty batch: store untouched
    got = {r["instrument_id"]: r["close"] for r in store.read_raw("raw/x").collect()}
    assert got == {"a": 5.0, "b": 3.0}


def test_failed_load_is_audited(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    dup = spark.createDataFrame([_daily("a.SZ", "20260601", 1.0), _daily("a.SZ", "20260601", 2.0)],
                                LANDING["daily"])
    # two rows with one key: the raw store keeps the last, the canonical upsert
    # sees both (mapped from the batch) and refuses them before writing
    with pytest.raises(ValueError, match="duplicate"):
        loader.stock_daily(dup, "2026-06-01", "2026-06-01")
    audit = loader.db.read_appended(S.UPDATE_EVENTS).collect()
    assert [(r["status"], r["table_name"]) for r in audit] == [("failed", "market_bars_daily")]
    assert "duplicate" in audit[0]["message"]
    assert loader.table(S.MARKET_BARS_DAILY) is None  # nothing written


def _value(dtype):
    from pyspark.sql import types as T
    return {T.StringType: "x", T.DoubleType: 1.5, T.BooleanType: True, T.DateType: dt.date(2026, 6, 1),
            T.TimestampNTZType: NOW, T.LongType: 7}[type(dtype)]


@pytest.mark.parametrize("spec", S.BUSINESS_TABLES + S.METADATA_TABLES, ids=lambda s: s.name)
def test_every_table_stores_and_reads_back(spark, tmp_root, spec):
    store = Store(spark, tmp_root)
    row = tuple(_value(f.dataType) for f in spec.schema.fields)
    assert store.upsert(spec, spark.createDataFrame([row], spec.schema)) == 1
    back = store.read(spec)
    assert back.columns == spec.columns and back.count() == 1
    assert tuple(back.collect()[0]) == row
    if Store.keeps_coverage(spec):
        assert store.coverage(spec).count() == 1


def test_added_column_survives_mixed_files(spark, tmp_root):
    """S9 on disk: months written before a column existed and months written
    after it are read together without losing the new column's values."""
    old_spec = S.TableSpec("evolving", S.struct("instrument_id:s, trade_date:d, source_id:s, a:f?"),
                           ("instrument_id", "trade_date"), partition_by=("trade_month",))
    new_spec = S.TableSpec("evolving", S.struct("instrument_id:s, trade_date:d, source_id:s, a:f?, b:f?"),
                           ("instrument_id", "trade_date"), partition_by=("trade_month",))
    store = Store(spark, tmp_root)
    store.upsert(old_spec, spark.createDataFrame([("x", dt.date(2026, 5, 1), "s", 1.0)], old_spec.schema))
    store.upsert(new_spec, spark.createDataFrame([("x", dt.date(2026, 6, 1), "s", 2.0, 9.0)], new_spec.schema))
    got = {r["trade_date"].month: (r["a"], r["b"]) for r in store.read(new_spec).collect()}
    assert got == {5: (1.0, None), 6: (2.0, 9.0)}


def test_raw_store_months_with_different_columns(spark, tmp_root):
    store = Store(spark, tmp_root)
    may = spark.createDataFrame([("a", "20260501", 1.0)], "ts_code string, trade_date string, close double")
    june = spark.createDataFrame([("a", "20260601", 2.0, 7.0)],
                                 "ts_code string, trade_date string, close double, vol double")
    store.merge_raw("raw/d", may, ["ts_code", "trade_date"], date_col="trade_date")
    assert store.merge_raw("raw/d", june, ["ts_code", "trade_date"], date_col="trade_date") == 2
    got = {r["trade_date"]: (r["close"], r["vol"]) for r in store.read_raw("raw/d").collect()}
    assert got == {"20260501": (1.0, None), "20260601": (2.0, 7.0)}


def test_index_job_accepts_scanned_feed(spark, tmp_root):
    """A feed already scanned with S6 is not divided by 100 again in the job."""
    from tidemark.sources import landing as L
    loader = Loader(spark, tmp_root, updated_at=NOW)
    path = f"{tmp_root}/landing/index_daily"
    spark.createDataFrame([_daily("000300.SH", "20260601", 1.0)], LANDING["index_daily"]).write.parquet(path)
    feed = L.daily_feed(spark, path, "index_daily")
    loader.index_daily(feed, "2026-06-01", "2026-06-01", params={"index_codes": ["000300.SH"]})
    assert loader.table(S.MARKET_BARS_DAILY).collect()[0]["pct_chg"] == 0.01


RAW = "ts_code string, trade_date string, close {}"


def _merge(store, spark, rows, kind):
    df = spark.createDataFrame(rows, RAW.format(kind))
    return store.merge_raw("raw/t", df, ["ts_code", "trade_date"], date_col="trade_date")


def test_raw_store_survives_a_type_change(spark, tmp_root):
    store = Store(spark, tmp_root)
    assert _merge(store, spark, [("a", "20260501", 1.0), ("b", "20260501", 2.0)], "double") == 2
    assert _merge(store, spark, [("a", "20260601", "n/a")], "string") == 3
    assert _merge(store, spark, [("a", "20260501", 4.0)], "double") == 3  # narrower again: read as text
    raw = store.read_raw("raw/t")
    assert dict(raw.dtypes)["close"] == "string"
    got = {(r["ts_code"], r["trade_date"]): r["close"] for r in raw.collect()}
    assert got == {("a", "20260501"): "4.0", ("b", "20260501"): "2.0", ("a", "20260601"): "n/a"}


def test_old_snapshots_expire(spark, tmp_root):
    import os
    store = Store(spark, tmp_root)
    for i in range(6):
        store.upsert(KV, kv(spark, [("a", i)]))
    assert len([d for d in os.listdir(f"{tmp_root}/kv") if d.startswith("snapshot")]) == 3
    assert {r["v"] for r in store.read(KV).collect()} == {5}


def test_stock_st_raw_rows_do_not_hang_on_order(spark, tmp_root):
    rows = [_row("stock_st", ts_code="a.SZ", name=f"n{i}", trade_date="20260601", type=f"t{i}", type_name="r")
            for i in range(6)]
    st = spark.createDataFrame(rows, LANDING["stock_st"])
    kept = []
    for i, batch in enumerate((st.repartition(5, "name"), st.repartition(2, "type"))):
        loader = Loader(spark, f"{tmp_root}/{i}", updated_at=NOW)
        loader.stock_st(batch, "2026-06-01", "2026-06-01")
        kept.append(sorted(map(tuple, loader.raw.read_raw("tushare/reference_instrument_st").collect())))
    assert kept[0] == kept[1] and len(kept[0]) == 1


def test_arrival_order_decides(spark, tmp_root):
    from tidemark.sources import landing as L
    path = f"{tmp_root}/landing/daily"
    spark.createDataFrame([_daily("a.SZ", "20260601", 9.0), _daily("a.SZ", "20260601", 1.0)],
                          LANDING["daily"]).coalesce(1).write.parquet(path)
    store = Store(spark, tmp_root)
    landed = L.read_landing(spark, path, "daily", arrival=True)
    store.merge_raw("raw/a", landed, ["ts_code", "trade_date"], date_col="trade_date")
    raw = store.read_raw("raw/a")
    assert [r["close"] for r in raw.collect()] == [1.0] and "_arrival" not in raw.columns


def test_update_by_dataset_name(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    feed = spark.createDataFrame([_daily("HKTECH", "20260601", 1.0)], LANDING["index_global"])
    r = loader.update("market_bars_index_daily", feed, start="2026-06-01", end="2026-06-01",
                      index_api="index_global", params={"index_codes": ["HKTECH"]},
                      fields="ts_code,trade_date,close,pct_chg")
    assert (r.dataset, r.rows_written) == ("market_bars_index_daily", 1)
    assert loader.table(S.MARKET_BARS_DAILY).collect()[0]["open"] is None  # a field not asked for
    with pytest.raises(ValueError, match="no job"):
        loader.update("nope", feed)


def test_failed_load_keeps_the_whole_message(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    loader._audit("d", "tushare", "t", "all", NOW, 0, 0, status="failed", message="x" * 5000)
    assert len(loader.db.read_appended(S.UPDATE_EVENTS).collect()[0]["message"]) == 5000
