"""Coverage and gap ranges (G1, G2, G3, J4, J5) on literal fixtures."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import coverage as G

D = dt.date
Y = 2026
SCHEMA = T.StructType([
    T.StructField("instrument_id", T.StringType()),
    T.StructField("trade_date", T.DateType()),
    T.StructField("source_id", T.StringType()),
])


def stored(spark, dates, iid="a", source="tushare"):
    return spark.createDataFrame([(iid, d, source) for d in dates], SCHEMA)


def days(a, b):
    return [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]


def ranges(df):
    return sorted((r["range_start"], r["range_end"]) for r in df.collect())


def test_nothing_stored(spark):
    assert ranges(G.missing_ranges(spark, None, D(Y, 6, 1), D(Y, 6, 18))) == [(D(Y, 6, 1), D(Y, 6, 18))]
    empty = stored(spark, [])
    assert ranges(G.missing_ranges(spark, empty, D(Y, 6, 1), D(Y, 6, 18))) == [(D(Y, 6, 1), D(Y, 6, 18))]


def test_covered(spark):
    s = stored(spark, days(D(Y, 5, 1), D(Y, 6, 30)))
    assert ranges(G.missing_ranges(spark, s, D(Y, 6, 1), D(Y, 6, 18))) == []


def test_both_ends(spark):
    s = stored(spark, days(D(Y, 6, 5), D(Y, 6, 10)))
    assert ranges(G.missing_ranges(spark, s, "2026-06-01", "20260618")) == [
        (D(Y, 6, 1), D(Y, 6, 4)), (D(Y, 6, 11), D(Y, 6, 18))]


def test_wholly_before_runs_past_end(spark):
    s = stored(spark, days(D(Y, 6, 1), D(Y, 6, 18)))
    assert ranges(G.missing_ranges(spark, s, D(Y, 1, 1), D(Y, 5, 15))) == [(D(Y, 1, 1), D(Y, 5, 31))]


def test_wholly_after_starts_before_start(spark):
    s = stored(spark, days(D(Y, 5, 1), D(Y, 5, 10)))
    assert ranges(G.missing_ranges(spark, s, D(Y, 6, 1), D(Y, 6, 5))) == [(D(Y, 5, 11), D(Y, 6, 5))]


def test_interior_hole_not_seen(spark):
    s = stored(spark, [D(Y, 6, 1), D(Y, 6, 18)])
    assert ranges(G.missing_ranges(spark, s, D(Y, 6, 1), D(Y, 6, 18))) == []


def test_clip(spark):
    got = G.missing_ranges(spark, None, D(Y, 6, 1), D(Y, 6, 18),
                           list_date=D(Y, 6, 10), delist_date=D(Y, 6, 12))
    assert ranges(got) == [(D(Y, 6, 10), D(Y, 6, 12))]


def test_clipped_away(spark):
    got = G.missing_ranges(spark, None, D(Y, 6, 1), D(Y, 6, 5), list_date=D(Y, 6, 10))
    assert ranges(got) == []


def test_start_after_end_is_error(spark):
    with pytest.raises(ValueError):
        G.missing_ranges(spark, None, D(Y, 6, 2), D(Y, 6, 1))


def test_filters_restrict_coverage(spark):
    s = stored(spark, days(D(Y, 6, 1), D(Y, 6, 18)), source="yfinance")
    got = G.missing_ranges(spark, s, D(Y, 6, 1), D(Y, 6, 18), filters={"source_id": "tushare"})
    assert ranges(got) == [(D(Y, 6, 1), D(Y, 6, 18))]


def test_by_instrument(spark):
    s = stored(spark, days(D(Y, 6, 5), D(Y, 6, 10)), iid="a").unionByName(
        stored(spark, days(D(Y, 6, 1), D(Y, 6, 30)), iid="b")).unionByName(
        stored(spark, days(D(Y, 6, 1), D(Y, 6, 30)), iid="c", source="yfinance"))
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "instrument_id string")
    got = G.missing_ranges_by_instrument(ids, s, D(Y, 6, 1), D(Y, 6, 18), "tushare")
    rows = sorted((r["instrument_id"], r["range_start"], r["range_end"]) for r in got.collect())
    assert rows == [
        ("a", D(Y, 6, 1), D(Y, 6, 4)), ("a", D(Y, 6, 11), D(Y, 6, 18)),
        ("c", D(Y, 6, 1), D(Y, 6, 18)),  # only yfinance rows stored: no tushare state
        ("d", D(Y, 6, 1), D(Y, 6, 18)),
    ]


def test_day_spine_guards_inverted(spark):
    r = spark.createDataFrame([(D(Y, 6, 1), D(Y, 6, 3)), (D(Y, 6, 9), D(Y, 6, 8))],
                              G.RANGE_SCHEMA)
    got = [x["trade_date"] for x in G.day_spine(r).collect()]
    assert sorted(got) == [D(Y, 6, 1), D(Y, 6, 2), D(Y, 6, 3)]


def test_select_in_ranges(spark):
    landing = spark.createDataFrame(
        [("a", "20260601"), ("a", "20260605"), ("a", "20260612"), ("b", "20260601"), (None, "20260601")],
        "ts_code string, trade_date string")
    plan = spark.createDataFrame(
        [("a", D(Y, 6, 1), D(Y, 6, 4)), ("a", D(Y, 6, 11), D(Y, 6, 18))],
        "instrument_id string, range_start date, range_end date")
    from tidemark.functions.dates import lenient_date
    got = G.select_in_ranges(landing, plan, "ts_code", date_expr=lenient_date("trade_date"))
    assert sorted(tuple(r) for r in got.collect()) == [("a", "20260601"), ("a", "20260612")]


@settings(max_examples=10, deadline=None)
@given(
    lo=st.integers(0, 60), span=st.integers(0, 30),
    ask_lo=st.integers(0, 90), ask_span=st.integers(0, 40),
)
def test_ranges_property(spark, lo, span, ask_lo, ask_span):
    """Ranges never overlap the stored span; stored span plus ranges is one
    contiguous block covering the ask; filling them leaves nothing to do."""
    base = D(2026, 1, 1)
    s_lo, s_hi = base + dt.timedelta(lo), base + dt.timedelta(lo + span)
    a_lo, a_hi = base + dt.timedelta(ask_lo), base + dt.timedelta(ask_lo + ask_span)
    got = ranges(G.missing_ranges(spark, stored(spark, [s_lo, s_hi]), a_lo, a_hi))
    for r0, r1 in got:
        assert r0 <= r1
        assert r1 < s_lo or r0 > s_hi
    lo_all = min([s_lo] + [r[0] for r in got])
    hi_all = max([s_hi] + [r[1] for r in got])
    assert lo_all <= a_lo and hi_all >= a_hi
    covered = (lo_all - lo_all).days + sum((r[1] - r[0]).days + 1 for r in got) + (s_hi - s_lo).days + 1
    assert covered == (hi_all - lo_all).days + 1
    filled = [s_lo, s_hi] + [d for r in got for d in (r[0], r[1])]
    assert ranges(G.missing_ranges(spark, stored(spark, filled), a_lo, a_hi)) == []


def test_raw_store_twin_text_dates(spark):
    """G1/A1/A2 over a raw store whose dates are vendor text."""
    raw = spark.createDataFrame([("a", "20260605"), ("a", "20260610"), ("b", None)],
                                "ts_code string, trade_date string")
    assert G.last_update_date(raw) == D(Y, 6, 10)
    assert G.first_update_date(raw, filters={"ts_code": "a"}) == D(Y, 6, 5)
    assert G.last_update_date(None) is None
    got = ranges(G.missing_ranges(spark, raw, D(Y, 6, 1), D(Y, 6, 18)))
    assert got == [(D(Y, 6, 1), D(Y, 6, 4)), (D(Y, 6, 11), D(Y, 6, 18))]


@settings(max_examples=6, deadline=None)
@given(spans=st.lists(st.tuples(st.integers(0, 40), st.integers(0, 20)), min_size=1, max_size=4),
       ask_lo=st.integers(0, 60), ask_span=st.integers(0, 30))
def test_by_instrument_property(spark, spans, ask_lo, ask_span):
    """G2 per instrument equals G1 on that instrument's own rows."""
    base = D(2026, 1, 1)
    a_lo, a_hi = base + dt.timedelta(ask_lo), base + dt.timedelta(ask_lo + ask_span)
    rows = []
    for i, (lo, span) in enumerate(spans):
        rows += [(f"i{i}", base + dt.timedelta(lo), "tushare"),
                 (f"i{i}", base + dt.timedelta(lo + span), "tushare")]
    table = spark.createDataFrame(rows, SCHEMA)
    ids = spark.createDataFrame([(f"i{i}",) for i in range(len(spans) + 1)], "instrument_id string")
    got = G.missing_ranges_by_instrument(ids, table, a_lo, a_hi, "tushare").collect()
    for i in range(len(spans) + 1):
        mine = sorted((r["range_start"], r["range_end"]) for r in got if r["instrument_id"] == f"i{i}")
        own = table.where(f"instrument_id = 'i{i}'")
        assert mine == ranges(G.missing_ranges(spark, own, a_lo, a_hi))


def test_ranges_evaluate_the_day_once_each(spark):
    """Twice as many parses of a text, and a text made at each of its uses, made job_stock_daily slow."""
    from tidemark.functions.dates import lenient_date, once

    ranges = spark.createDataFrame([(dt.date(2020, 1, 3), dt.date(2020, 1, 4)), (dt.date(2020, 1, 8), dt.date(9999, 12, 31))],
                                   "range_start date, range_end date")
    texts = ["0001-01-01", "2020-01-02", "2020/01/3", "20200104", "2020-01-5", "20200107", "2020-01-08", "9999-12-31", "bad", None]
    days = spark.createDataFrame([(t,) for t in texts], "t string")
    day = once(F.col("t"), lenient_date)
    got = [r["t"] for r in days.where(G.in_range_rows(day, ranges)).collect()]
    assert got == ["2020/01/3", "20200104", "2020-01-08", "9999-12-31"]
    assert days.where(G.in_range_rows(day, ranges.limit(0))).count() == 0
    plan = days.where(G.in_range_rows(F.to_date("t", "yyyyMMdd"), ranges))._jdf.queryExecution().analyzed().toString()
    assert plan.count("to_date(t") == 2
