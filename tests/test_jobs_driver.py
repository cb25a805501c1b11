"""Jobs over the driver's tables (sf0.001): adapter views act as landed feeds."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.dates import lenient_date
from tidemark.plans.jobs import Loader
from tidemark.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2026, 6, 1)


def _in(df, lo, hi):
    d = lenient_date("trade_date")
    return df.where(d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def test_stock_daily_over_driver_tables(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    landing = fx.daily_landing(spark, SF)
    r1 = loader.stock_daily(landing, "1995-01-01", "1995-12-31")
    assert r1.rows_written == _in(landing, "1995-01-01", "1995-12-31").count() > 0
    r2 = loader.stock_daily(landing, "1994-01-01", "1996-12-31")
    assert r2.rows_written > 0
    bars = loader.table(S.MARKET_BARS_DAILY)
    assert bars.count() == _in(landing, "1994-01-01", "1996-12-31").count()
    assert loader.stock_daily(landing, "1994-06-01", "1996-06-30").rows_written == 0
    # stored values are the mapped landing values (amount in thousands x 1000)
    one = _in(landing, "1995-01-01", "1995-12-31").where("amount IS NOT NULL").limit(1).collect()[0]
    row = bars.where(F.col("instrument_id") == one["ts_code"]).where(
        F.col("trade_date") == lenient_date(F.lit(one["trade_date"]))).collect()
    assert [r["amount"] for r in row] == [one["amount"] * 1000.0]


def test_etf_jobs_over_driver_tables(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    assert loader.etf_list(fx.etf_basic_landing(spark, SF)).rows_written > 0
    ref = loader.table(S.REFERENCE_INSTRUMENT)
    live = ref.where("list_status = 'L' AND (instrument_id LIKE '%.SH' OR instrument_id LIKE '%.SZ')"
                     " AND list_date <= DATE'1996-12-31'").select("instrument_id")
    landing = fx.daily_landing(spark, SF)
    expected = _in(landing, "1996-01-01", "1996-12-31").join(
        live.withColumnRenamed("instrument_id", "ts_code"), "ts_code", "left_semi").count()
    r = loader.etf_daily(landing, "1996-01-01", "1996-12-31")
    assert r.rows_written == expected > 0
    assert loader.etf_daily(landing, "1996-01-01", "1996-12-31").rows_written == 0
    assert loader.db.coverage(S.MARKET_BARS_DAILY).count() == \
        loader.table(S.MARKET_BARS_DAILY).select("instrument_id").distinct().count()


def test_fx_job_over_driver_tables(spark, tmp_root):
    loader = Loader(spark, tmp_root, updated_at=NOW)
    landing = fx.fx_landing(spark, SF)
    codes = sorted(r[0] for r in landing.select("ts_code").distinct().collect())  # five pairs
    expected = _in(landing, "1995-01-01", "1995-12-31").count()
    r = loader.fx_daily(landing, "1995-01-01", "1995-12-31", {"ts_codes": codes}, exchange="OTC")
    assert r.rows_written == expected + len(codes)  # bars plus one reference row per pair
    ref = {x["instrument_id"]: x["exchange"] for x in loader.table(S.REFERENCE_INSTRUMENT).collect()}
    assert ref["MACHIN"] == "OTC" and all(v == "FXCM" for k, v in ref.items() if k != "MACHIN")
    assert loader.fx_daily(landing, "1995-01-01", "1995-12-31", {"ts_codes": codes}).rows_written == 0
    fxt = loader.table(S.MARKET_FX_DAILY)
    assert fxt.count() == expected
    assert fxt.where("mid_close IS NULL OR spread_close <> 1.0").count() == 0


def test_index_jobs_over_driver_tables(spark, tmp_root):
    from tidemark.operators import universe as U
    loader = Loader(spark, tmp_root, updated_at=NOW)
    assert loader.index_list(fx.index_basic_landing(spark, SF)).rows_written > 0
    live = U.index_universe(loader.table(S.REFERENCE_INSTRUMENT), "1996-12-31")
    landing = fx.daily_landing(spark, SF)
    window = _in(landing, "1996-01-01", "1996-12-31")
    expected = window.join(live.withColumnRenamed("instrument_id", "ts_code"), "ts_code", "left_semi")
    n = expected.count()
    r = loader.index_daily(landing, "1996-01-01", "1996-12-31")
    assert r.rows_written == n > 0
    got = loader.table(S.MARKET_BARS_DAILY)
    # S6 for the index feed: stored pct_chg is the landed percent / 100
    one = expected.where("pct_chg IS NOT NULL").limit(1).collect()[0]
    row = got.where(F.col("instrument_id") == one["ts_code"]).where(
        F.col("trade_date") == lenient_date(F.lit(one["trade_date"]))).collect()[0]
    assert row["pct_chg"] == one["pct_chg"] / 100.0
    assert loader.index_daily(landing, "1996-01-01", "1996-12-31").rows_written == 0


def test_future_jobs_over_driver_tables(spark, tmp_root):
    from tidemark.operators import universe as U
    loader = Loader(spark, tmp_root, updated_at=NOW)
    r = loader.future_list(fx.fut_basic_landing(spark, SF))
    n_contracts = fx.fut_basic_landing(spark, SF).count()
    assert (r.raw_rows, r.rows_written) == (n_contracts, 2 * n_contracts)  # instrument + contract rows
    live = U.future_universe(loader.table(S.REFERENCE_FUTURE), "1996-01-01", "1996-12-31")
    landing = fx.fut_daily_landing(spark, SF)
    expected = _in(landing, "1996-01-01", "1996-12-31").join(
        live.withColumnRenamed("instrument_id", "ts_code"), "ts_code", "left_semi")
    assert loader.future_daily(landing, "1996-01-01", "1996-12-31").rows_written == expected.count() > 0
    got = loader.table(S.MARKET_BARS_DERIVATIVE_DAILY)
    assert got.where("vol IS NULL AND oi IS NOT NULL").count() == 0  # vol kept, no scaling
    assert loader.future_daily(landing, "1996-01-01", "1996-12-31").rows_written == 0
