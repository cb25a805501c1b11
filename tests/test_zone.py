"""The landing zone: files numbered once, months opened only where needed."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators import coverage as G
from tidemark.plans.jobs import Loader
from tidemark.schema import LANDING
from tidemark.sources.tables import Store
from tidemark.sources.zone import LandingZone

NOW = dt.datetime(2026, 6, 30, 12)


def _row(dataset, **values):
    return tuple(values.get(c) for c in LANDING[dataset].fieldNames())


def _daily(spark, rows):
    return spark.createDataFrame([_row("daily", ts_code=c, trade_date=d, close=x) for c, d, x in rows], LANDING["daily"])


def _write(spark, path, dataset, rows):
    spark.createDataFrame([_row(dataset, **r) for r in rows], LANDING[dataset]).coalesce(1).write.mode("append").parquet(path)


def _files_read(df):
    """Files that the scans of ``df`` opened (adaptive execution off)."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = plan.collectLeaves()
    return [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())
            if leaves.apply(i).metrics().contains("numFiles")]


def test_files_are_numbered_once(spark, tmp_root):
    zone, folder = LandingZone(spark, f"{tmp_root}/zone"), f"{tmp_root}/vendor"
    st = lambda name: {"ts_code": "a.SZ", "trade_date": "20260601", "name": name}
    _write(spark, folder, "stock_st", [st("first"), st("second")])
    assert zone.land_files("stock_st", folder) == 1
    assert zone.land_files("stock_st", folder) is None  # nothing new
    copied = shutil.copytree(folder, f"{tmp_root}/copied")  # the same names, later times
    for d, _, names in os.walk(copied):
        for f in names:
            os.utime(f"{d}/{f}", (2e9, 2e9))
    assert zone.land_files("stock_st", copied) is None
    _write(spark, folder, "stock_st", [st("third")])
    assert zone.land_files("stock_st", folder) == 2
    landed = zone.read("stock_st").orderBy("_arrival").collect()
    assert [(r["name"], r["_arrival"]["drop"]) for r in landed] == [("first", 1), ("second", 1), ("third", 2)]
    assert zone.ledger("stock_st").count() == 2

    store = Store(spark, f"{tmp_root}/raw")  # the last that landed wins by default
    for _ in range(2):  # and replay changes nothing
        n = store.merge_raw("st", zone.read("stock_st").repartition(4, "name"), ["ts_code", "trade_date"], date_col="trade_date")
        (kept,) = store.read_raw("st").collect()
        assert n == 1 and kept["name"] == "third" and set(kept.asDict()) == set(LANDING["stock_st"].fieldNames())


def test_a_drop_is_there_once_its_entry_is(spark, tmp_root, monkeypatch):
    zone = LandingZone(spark, tmp_root)
    zone.land("daily", _daily(spark, [("a", "20260301", 1.0)]))
    with monkeypatch.context() as m:
        m.setattr(LandingZone, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        try:
            zone.land("daily", _daily(spark, [("a", "20260301", 2.0)]))
        except RuntimeError:
            pass
    assert [r["close"] for r in zone.read("daily").collect()] == [1.0]
    assert LandingZone(spark, tmp_root).read("fx_daily").count() == 0


def test_windows_and_plans_open_only_their_months(spark, tmp_root):
    zone = LandingZone(spark, tmp_root)
    shapes = ("{0:%Y%m%d}", "{0:%Y-%m-%d}", "{0:%Y/%m/%d}")
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=5 * i) for i in range(100)]
    rows = [("a", shapes[i % 3].format(d), float(i)) for i, d in enumerate(days)] + [("a", "no date", -1.0), ("a", None, -2.0)]
    zone.land("daily", _daily(spark, rows))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        landed = zone.read("daily")
        (every,) = _files_read(landed)
        lo, hi = dt.date(2025, 3, 10), dt.date(2025, 4, 2)
        want = sorted(float(i) for i, d in enumerate(days) if lo <= d <= hi)
        window = zone.read_window("daily", lo, hi)
        assert sorted(r["close"] for r in window.collect()) == want
        plan = spark.createDataFrame([("a", lo, dt.date(2025, 3, 20)), ("a", dt.date(2025, 3, 21), hi)],
                                     "instrument_id string, range_start date, range_end date")
        picked = G.select_in_ranges(landed, plan, "ts_code", date_expr=G._day(landed, "trade_date"))
        assert sorted(r["close"] for r in picked.collect()) == want
        for df in (window, picked):
            assert max(_files_read(df)) <= every * 2 / 15  # two of the fifteen months and the null one
        assert "land_month" in picked._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]
        none = G.select_in_ranges(landed, plan.limit(0), "ts_code", date_expr=G._day(landed, "trade_date"))
        assert none.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_jobs_run_on_the_zone(spark, tmp_root):
    """Jobs keep the last landed row; running them again changes nothing."""
    zone, loader = LandingZone(spark, f"{tmp_root}/zone"), Loader(spark, tmp_root, updated_at=NOW)
    zone.land("daily", _daily(spark, [("a.SZ", "20260301", 1.0), ("a.SZ", "20260302", 2.0), ("a.SZ", "20260401", 3.0)]))
    r = loader.stock_daily(zone.read("daily"), "2026-03-01", "2026-03-31")
    assert (r.raw_rows, r.rows_written) == (2, 2)
    again = loader.stock_daily(zone.read("daily"), "2026-03-01", "2026-03-31")
    assert again.rows_written <= r.rows_written
    assert loader.stock_daily(zone.read("daily"), "2026-03-01", "2026-04-30").rows_written >= 1
    bars = {r["trade_date"]: r["close"] for r in loader.table(S.MARKET_BARS_DAILY).collect()}
    assert bars == {dt.date(2026, 3, 1): 1.0, dt.date(2026, 3, 2): 2.0, dt.date(2026, 4, 1): 3.0}
    raw = loader.raw.read_raw("tushare/stock_daily")
    assert raw.columns == LANDING["daily"].fieldNames() and raw.count() == 3
    assert loader.update("stock_daily", zone.read("daily"), fields="ts_code,trade_date,close", start="2026-05-01", end="2026-05-02").raw_rows == 0
