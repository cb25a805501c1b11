"""Coverage and gap ranges.

Coverage is read from the canonical tables (never from raw). Only head and
tail gaps are reported — interior holes are not — and a window wholly before
or after the stored dates is stretched to keep stored dates contiguous.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import lenient_date, lit_date, month_key, parse_param_date
from tidemark.operators.store import LAND_MONTH

RANGE_SCHEMA = T.StructType([
    T.StructField("range_start", T.DateType()),
    T.StructField("range_end", T.DateType()),
])


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _day(df: DataFrame, date_col: str) -> Column:
    """The date column as a DATE: raw stores keep vendor text dates
    (``yyyymmdd``) or instants, canonical tables keep dates."""
    return lenient_date(_q(date_col), df.schema[date_col].dataType)


def equality_filter(df: DataFrame, filters: dict | None) -> DataFrame:
    """AND of ``column = value``; a None value keeps nothing (SQL ``=``)."""
    if not filters:
        return df
    cond = reduce(lambda a, b: a & b, [_q(c) == F.lit(v) for c, v in filters.items()])
    return df.where(cond)


# ---------------------------------------------------------------- A1-A6 -------

def date_bounds(
    df: DataFrame, date_col: str = "trade_date", filters: dict | None = None
) -> DataFrame:
    """A1 + A2: one row ``(first_date, last_date)``; nulls when nothing matches.
    Works on canonical tables and on raw stores (text or instant dates)."""
    d = _day(df, date_col)
    return equality_filter(df, filters).agg(
        F.min(d).alias("first_date"), F.max(d).alias("last_date")
    )


def last_update_date(df, date_col="trade_date", filters=None) -> _dt.date | None:
    """A1 as a value (None for a missing table or no rows). One-row action."""
    if df is None:
        return None
    return date_bounds(df, date_col, filters).first()["last_date"]


def first_update_date(df, date_col="trade_date", filters=None) -> _dt.date | None:
    """A2 as a value (None for a missing table or no rows). One-row action."""
    if df is None:
        return None
    return date_bounds(df, date_col, filters).first()["first_date"]


def instrument_bounds(
    df: DataFrame,
    source_id: str | None = "tushare",
    date_col: str = "trade_date",
    ids: DataFrame | None = None,
) -> DataFrame:
    """A3: ``(instrument_id, first_date, last_date)`` per instrument of a source.

    A partial (map-side) aggregate: each task pre-reduces its rows, so a hot
    instrument costs one row per task in the shuffle. ``ids`` (optional)
    restricts the instruments with a semi join.
    """
    if source_id is not None:
        df = df.where(F.col("source_id") == F.lit(source_id))
    if ids is not None:
        df = df.join(ids.select("instrument_id"), "instrument_id", "left_semi")
    d = _day(df, date_col)
    return df.groupBy("instrument_id").agg(
        F.min(d).alias("first_date"), F.max(d).alias("last_date")
    )


def coverage_summary(df: DataFrame, date_col: str = "trade_date",
                     keys=("instrument_id", "source_id")) -> DataFrame:
    """A3 for every source at once: ``(instrument_id, source_id, first_date,
    last_date)``, the summary a bar table keeps next to its data so gap
    planning does not aggregate the whole table. Partial (map-side)
    aggregate."""
    d = _day(df, date_col)
    return df.groupBy(*[_q(k) for k in keys]).agg(
        F.min(d).alias("first_date"), F.max(d).alias("last_date"))


def batch_bounds(df: DataFrame, id_col: str = "instrument_id",
                 date_col: str = "trade_date", with_count: bool = False) -> DataFrame:
    """A4 (+A6): one row ``(start_date, end_date, n_instruments[, n_rows])``
    of an incoming batch."""
    aggs = [
        F.min(_q(date_col)).alias("start_date"),
        F.max(_q(date_col)).alias("end_date"),
        F.count_distinct(_q(id_col)).alias("n_instruments"),
    ]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("n_rows"))
    return df.agg(*aggs)


def distinct_ids(df: DataFrame, id_col: str = "instrument_id") -> DataFrame:
    """A5: distinct instrument ids, in order."""
    return df.select(_q(id_col).alias("instrument_id")).distinct().orderBy("instrument_id")


# ---------------------------------------------------------------- G1 ----------

def _head_tail(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Array of candidate ranges: head (start, first-1) if start < first and
    tail (last+1, end) if end > last; inverted ranges dropped."""
    head = F.struct(
        start.alias("range_start"), F.date_sub(first, 1).alias("range_end"),
        (start < first).alias("ok"),
    )
    tail = F.struct(
        F.date_add(last, 1).alias("range_start"), end.alias("range_end"),
        (end > last).alias("ok"),
    )
    kept = F.filter(
        F.array(head, tail), lambda r: r["ok"] & (r["range_start"] <= r["range_end"])
    )
    return F.transform(
        kept, lambda r: F.struct(r["range_start"].alias("range_start"),
                                 r["range_end"].alias("range_end"))
    )


def missing_ranges(
    spark: SparkSession,
    table: DataFrame | None,
    start,
    end,
    date_col: str = "trade_date",
    filters: dict | None = None,
    list_date=None,
    delist_date=None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """G1: missing ``(range_start, range_end)`` rows for a whole table.

    ``bounds`` (optional) is a precomputed one-row ``(first_date,
    last_date)`` frame, e.g. from a coverage summary, used instead of
    aggregating ``table``.

    start > end -> ValueError. The window is clipped to [list_date,
    delist_date]; a window clipped away is empty; a missing table or no
    matching rows -> the whole window; a covered window -> nothing. The
    result stays a DataFrame (at most two rows by construction).
    """
    start, end = parse_param_date(start), parse_param_date(end)
    if start > end:
        raise ValueError(f"start {start} must not be after end {end}")
    if list_date is not None:
        start = max(start, parse_param_date(list_date))
    if delist_date is not None:
        end = min(end, parse_param_date(delist_date))
    if start > end:
        return spark.createDataFrame([], RANGE_SCHEMA)
    if table is None and bounds is None:
        return spark.createDataFrame([(start, end)], RANGE_SCHEMA)
    s, e = lit_date(start), lit_date(end)
    if bounds is None:
        bounds = date_bounds(table, date_col, filters)
    first, last = F.col("first_date"), F.col("last_date")
    ranges = F.when(
        first.isNull() | last.isNull(),
        F.array(F.struct(s.alias("range_start"), e.alias("range_end"))),
    ).otherwise(_head_tail(s, e, first, last))
    return bounds.select(F.inline(ranges))


def in_ranges(day: Column, ranges: list) -> Column:
    """``day`` lies in one of a short list of ranges (a whole table's gaps: two
    at most). On a DATE column it is a filter that the parquet reader receives."""
    return reduce(lambda a, b: a | b, [day.between(lit_date(r[0]), lit_date(r[1])) for r in ranges], F.lit(False))


def in_range_rows(day: Column, ranges: DataFrame) -> Column:
    """The same over :func:`missing_ranges` rows inside the plan: Spark gathers
    them (two at most) as one scalar when the query runs. Days are compared by
    their distance from the first, earlier ones by one beyond any range, so
    that a range evaluates ``day`` once: Spark may put a parsed text in its place."""
    rows = ranges.agg(F.collect_list(F.struct("range_start", "range_end"))).scalar()

    def one(i: int) -> Column:
        first, last = F.get(rows, i)["range_start"], F.get(rows, i)["range_end"]
        return F.pmod(F.datediff(day, first).cast("bigint"), F.lit(1 << 32)) <= F.datediff(last, first)

    return F.coalesce(one(0), F.lit(False)) | F.coalesce(one(1), F.lit(False))


def collect_ranges(ranges_df: DataFrame) -> list[tuple[_dt.date, _dt.date]]:
    """Bring G1's ranges (two rows at most, by construction) to the driver."""
    rows = ranges_df.limit(3).collect()
    if len(rows) > 2:
        raise AssertionError("whole-table gap ranges exceed two rows")
    return [(r["range_start"], r["range_end"]) for r in rows]


# ---------------------------------------------------------------- G2 / J4 -----

def missing_ranges_by_instrument(
    ids: DataFrame,
    table: DataFrame | None,
    start,
    end,
    source_id: str | None = "tushare",
    date_col: str = "trade_date",
    coverage: DataFrame | None = None,
) -> DataFrame:
    """G2 + J4: ``(instrument_id, range_start, range_end)`` per requested id.

    ``coverage`` (optional) is a precomputed ``(instrument_id, source_id,
    first_date, last_date)`` summary used instead of aggregating ``table``.

    requested ids LEFT JOIN per-instrument coverage (A3); an id with no stored
    rows gets the whole window (not clipped, not checked for start > end);
    otherwise the head/tail rule. Covered ids produce no rows. The ids side
    and the coverage aggregate both have one row per instrument.
    """
    start, end = parse_param_date(start), parse_param_date(end)
    s, e = lit_date(start), lit_date(end)
    ids = ids.select("instrument_id").distinct()
    if table is None and coverage is None:
        return ids.select("instrument_id", s.alias("range_start"), e.alias("range_end"))
    if coverage is None:
        # No semi join with ids before the aggregate: the partial aggregate
        # already shrinks each task to one row per instrument, and the left
        # join below restricts to the requested ids without evaluating the
        # universe twice.
        coverage = instrument_bounds(table, source_id, date_col)
    else:
        if source_id is not None:
            coverage = coverage.where(F.col("source_id") == F.lit(source_id))
        coverage = coverage.groupBy("instrument_id").agg(
            F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))
    joined = ids.join(coverage, "instrument_id", "left")
    first, last = F.col("first_date"), F.col("last_date")
    ranges = F.when(
        first.isNull() | last.isNull(),
        F.array(F.struct(s.alias("range_start"), e.alias("range_end"))),
    ).otherwise(_head_tail(s, e, first, last))
    return joined.select("instrument_id", F.inline(ranges))


# ---------------------------------------------------------------- G3 ----------

def day_spine(ranges: DataFrame, keep=()) -> DataFrame:
    """One row per calendar day of each range (start <= end guarded, since
    ``sequence`` would count down)."""
    days = F.when(
        F.col("range_start") <= F.col("range_end"),
        F.sequence(F.col("range_start"), F.col("range_end"), F.expr("INTERVAL 1 DAY")),
    ).otherwise(F.array().cast(T.ArrayType(T.DateType())))
    return ranges.select(*keep, F.explode(days).alias("trade_date"))


# ---------------------------------------------------------------- J5 ----------

def select_in_ranges(
    landing: DataFrame,
    plan: DataFrame,
    id_col: str = "ts_code",
    date_col: str = "trade_date",
    date_expr: Column | None = None,
) -> DataFrame:
    """Landing rows of an instrument that fall inside one of its ranges.

    An equi join on the instrument plus a BETWEEN condition (a range join),
    as a semi join so a row never repeats. The plan has at most two rows per
    instrument; AQE broadcasts it when its real size is small, otherwise the
    join is a sort-merge on the instrument with AQE's skew split for a hot
    instrument on the landing side. A landing laid out by month is pruned to
    the months between the plan's first and last day, one scalar that Spark
    computes when the query runs.
    """
    if LAND_MONTH in landing.columns:
        days = plan.agg(F.struct(F.min("range_start").alias("lo"), F.max("range_end").alias("hi"))).scalar()
        landing = landing.where(F.col(LAND_MONTH).between(month_key(days["lo"]), month_key(days["hi"])))
    d = date_expr if date_expr is not None else _q(date_col)
    p = plan.select(
        F.col("instrument_id").alias("_plan_id"),
        F.col("range_start").alias("_plan_start"),
        F.col("range_end").alias("_plan_end"),
    )
    cond = (landing[id_col] == p["_plan_id"]) & d.between(p["_plan_start"], p["_plan_end"])
    return landing.join(p, cond, "left_semi")
