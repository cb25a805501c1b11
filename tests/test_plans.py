"""Plan shape of the skew-sensitive operators: hot keys are reduced map-side
or split before any single task sees them, and results stay whole."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tidemark.functions.dates import lit_timestamp_ntz
from tidemark.operators import store as ST
from tidemark.operators import tickers as O
from tidemark.operators import transforms as P


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_hot_key_is_combined_map_side(spark):
    # one key holds a third of all rows
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    out = ST.keep_latest(df.repartition(8), ["k"], "o")
    plan = _plan(out)
    assert "partial_max_by" in plan  # pre-aggregated in every map task before the shuffle
    rows = {r["k"]: r["v"] for r in out.collect()}
    assert len(rows) == 2001 and rows["hot"] == 2 * 2997


def test_best_match_combines_map_side(spark):
    cand = spark.range(0, 500).select(
        F.lit("hot").alias("ticker"), F.col("id").alias("rank"),
        F.when(F.col("id") == 321, F.lit("HOT")).otherwise(F.lit("X")).alias("symbol"),
        F.lit("EQUITY").alias("quoteType"), F.lit("E").alias("exchange"),
        F.lit(None).cast("string").alias("shortname"), F.lit("n").alias("shortName"))
    req = spark.createDataFrame([("hot",)], "ticker string")
    out = O.best_match(req, cand.repartition(8))
    assert "partial_min_by" in _plan(out)
    r = out.collect()[0]
    assert (r["found"], r["matched_symbol"]) == (True, "HOT")


def test_lag_window_is_split_by_year(spark):
    days = [dt.datetime(2020, 1, 1) + dt.timedelta(days=i) for i in range(0, 1500, 7)]
    hist = spark.createDataFrame([("HOT", d, float(i)) for i, d in enumerate(days)],
                                 "ticker string, date timestamp_ntz, close double")
    out = P.yahoo_bars(hist, updated_at=lit_timestamp_ntz("2026-06-01 00:00:00"))
    plan = _plan(out)
    # the raw rows are shuffled on (instrument, year), not on the instrument alone
    assert re.search(r"hashpartitioning\(ticker#\d+, _segment#\d+", plan)
    got = sorted((r["trade_date"], r["pre_close"]) for r in out.collect())
    assert got[0][1] is None
    assert all(got[i][1] == float(i - 1) for i in range(1, len(got)))  # whole history, exact lag


def test_joins_past_the_broadcast_threshold(spark):
    """With broadcasts off (a side too large to broadcast), the joins run as
    sort-merge joins on the full key and give the same rows as the oracle."""
    import duckdb

    import __spark_entry__ as E
    from tools.compare import TABLES, digest

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ["upsert_bars", "fetch_selection", "new_keys_only", "raw_merge"]:
            df = E.queries()[name](spark, sf)
            rows = [tuple(r) for r in df.collect()]
            plan = _plan(df)
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, name
            res = con.execute(E.oracle_sql()[name])
            ocols = [d[0] for d in res.description]
            assert digest(df.columns, rows)[0] == digest(ocols, res.fetchall())[0], name
        keyed = _plan(E.queries()["upsert_bars"](spark, sf))
        assert re.search(r"hashpartitioning\(instrument_id#\d+, trade_date#\d+", keyed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _ran(df):
    """The plan that a run of ``df`` ended with."""
    execution = df._jdf.queryExecution()
    df.collect()
    return execution.executedPlan().toString()


def test_previous_close_runs_its_input_once(spark):
    from tidemark.plans import catalog
    plan = _ran(catalog.yf_new_bars(spark, "/root/testdata/sf0.001"))
    assert "ReusedExchange" in plan or plan.count("LeftAnti") == 1


def test_yahoo_job_deals_its_rows_once(spark):
    """History was made, filtered and dealt twice, and all bars met the stored ones in one more shuffle."""
    from tidemark.plans import catalog
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _ran(catalog.QUERIES["job_yf_bars"](spark, "/root/testdata/sf0.001")).split("\n+- == Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    # bars by (part, day) for history, stored rows and stored keys; history with
    # stored keys, and stored rows, by year; last closes by instrument, and back
    assert len(dealt) == 7


def test_building_a_query_starts_no_job(spark, monkeypatch):
    from tidemark.plans import catalog
    frame = type(spark.range(0))

    def refused(self, *args, **kwargs):
        raise AssertionError("an action while a query is built")

    for action in ("collect", "first", "head", "take", "count", "isEmpty", "toPandas", "toArrow", "toLocalIterator", "checkpoint"):
        monkeypatch.setattr(frame, action, refused)
    for query in catalog.QUERIES.values():
        query(spark, "/root/testdata/sf0.001")


def test_ordered_queries_come_in_order(spark):
    from tidemark.plans import catalog
    for name in ("universe_etf", "universe_index", "universe_future", "universe_yahoo", "distinct_ids"):
        ids = [r[0] for r in catalog.QUERIES[name](spark, "/root/testdata/sf0.001").collect()]
        assert ids == sorted(ids) and ids, name
