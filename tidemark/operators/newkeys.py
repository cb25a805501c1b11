"""New-key filter (J1, J2): keep landed rows whose (instrument, date) is not
stored yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import lit_date, to_calendar_date

KEYS = ["instrument_id", "trade_date"]


def incoming_keys(raw: DataFrame, id_col: str = "ticker", date_col: str = "date") -> DataFrame:
    """(instrument_id, trade_date) of a landed batch, null keys dropped."""
    return (
        raw.select(F.col(id_col).alias("instrument_id"),
                   to_calendar_date(date_col).alias("trade_date"))
        .dropna(subset=KEYS)
        .distinct()
    )


def key_window(raw: DataFrame, date_col: str = "date") -> tuple[Column, Column]:
    """First and last day of a landed batch, as scalars inside the plan."""
    day = to_calendar_date(date_col)
    both = raw.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()  # one aggregate
    return both["lo"], both["hi"]


def existing_keys(
    stored: DataFrame,
    window: tuple,
    source_id: str = "yfinance",
    ids: DataFrame | None = None,
) -> DataFrame:
    """Stored keys of a source inside the incoming batch's date window.

    ``window`` holds the first and last day: dates that the caller has
    (:meth:`tidemark.sources.tables.Store.read_window` prunes months by the
    same two), or the scalars of :func:`key_window`, which Spark computes when
    the query runs and pushes into the scan. An empty batch has null bounds
    and so no keys. ``ids`` (optional, ``instrument_id``) bounds the
    instruments by a semi join."""
    lo, hi = (x if isinstance(x, Column) else lit_date(x) for x in window)
    keys = stored.where(
        (F.col("source_id") == F.lit(source_id)) & F.col("trade_date").between(lo, hi)).select(*KEYS)
    return keys if ids is None else keys.join(ids.select("instrument_id"), "instrument_id", "left_semi")


def new_rows(
    raw: DataFrame,
    stored: DataFrame | None,
    id_col: str = "ticker",
    date_col: str = "date",
    source_id: str = "yfinance",
    window: tuple | None = None,
    by_year: bool = False,
) -> DataFrame:
    """Landed rows whose key is not stored (null keys never match, so
    stay). The anti join matches instruments, so J2 needs no bound on them.

    ``by_year`` deals both sides by instrument and calendar year, not by key:
    the rows stay so dealt, and steps that want an instrument's year together
    (:func:`tidemark.operators.transforms.yahoo_bars`) shuffle them no more."""
    if stored is None:
        return raw
    existing = existing_keys(stored, window or key_window(raw, date_col), source_id).select(
        F.col("instrument_id").alias("_ex_id"), F.col("trade_date").alias("_ex_date")
    )
    if by_year:
        return _new_rows_by_year(raw, existing, id_col, date_col)
    cond = (raw[id_col] == existing["_ex_id"]) & (
        to_calendar_date(raw[date_col]) == existing["_ex_date"]
    )
    return raw.join(existing, cond, "left_anti")


def _new_rows_by_year(raw: DataFrame, existing: DataFrame, id_col: str, date_col: str) -> DataFrame:
    """The anti join as one shuffle of both sides: a join's sides are dealt by
    its whole key, a window's rows may lie together by less."""
    flag, found = "_is_stored", "_is_found"
    day, types = to_calendar_date(date_col), {f.name: f.dataType for f in raw.schema}
    keys = existing.select(F.col("_ex_id").cast(types[id_col]).alias(id_col), F.col("_ex_date").cast(types[date_col]).alias(date_col))
    both = (raw.withColumn(flag, F.lit(False))
            .unionByName(keys.withColumn(flag, F.lit(True)), allowMissingColumns=True)
            .repartition(id_col, F.year(day)))
    same_key = Window.partitionBy(id_col, F.year(day), day)
    nameless = F.col(id_col).isNull() | day.isNull()
    return (both.withColumn(found, F.max(flag).over(same_key))
            .where(~F.col(flag) & (~F.col(found) | nameless)).select(*raw.columns))
