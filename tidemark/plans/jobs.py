"""Composed load jobs: the only code that writes.

Each job takes the landed feed as a DataFrame (the stand-in for the vendor
call), works out what to load with the library operators, merges the batch
into the raw keep-latest store, maps and conforms it, upserts the canonical
table(s) and appends one audit row per load to ``update_events``.

The selected batch is read twice (raw merge, canonical upsert) and its
selection depends on the canonical table (gap plan, new-key filter), which
the job then rewrites. It is therefore cut from its lineage with a reliable
``checkpoint()`` before anything is written: a lost executor re-reads the
checkpoint instead of re-planning against the updated table.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as S
from tidemark.functions.dates import lenient_date, lit_timestamp_ntz
from tidemark.operators import coverage as G
from tidemark.operators import newkeys as J
from tidemark.operators import tickers as O
from tidemark.operators import transforms as P
from tidemark.operators import universe as U
from tidemark.operators.store import ARRIVAL, LAND_MONTH
from tidemark.sources.landing import (
    INDEX_FEEDS, history_window, pct_to_fraction_at_scan, select_fields, text_window, where_window)
from tidemark.sources.tables import Store, new_run_id
from tidemark.sources.zone import in_months


def _day_of(landing: DataFrame) -> Column:
    return lenient_date("trade_date", landing.schema["trade_date"].dataType)


def _scan_days(landing: DataFrame, lo: _dt.date | None, hi: _dt.date | None) -> DataFrame:
    """Beside the exact selection: what the scan of landed text dates can use,
    and the months of a landing that is laid out by them."""
    if lo is not None:
        landing = in_months(landing, F.lit(lo), F.lit(hi))
    if lo is None or not isinstance(landing.schema["trade_date"].dataType, T.StringType):
        return landing
    return landing.where(text_window("trade_date", lo, hi))


def select_missing(landing: DataFrame, plan: DataFrame) -> DataFrame:
    """J5 over a landed daily feed."""
    return G.select_in_ranges(landing, plan, "ts_code", date_expr=_day_of(landing))


def audit_row(spark: SparkSession, **values) -> DataFrame:
    """One ``update_events`` row of literals or scalars of the plan."""
    types = {f.name: f.dataType for f in S.UPDATE_EVENTS.schema.fields}
    one = lambda v: v if isinstance(v, Column) else F.lit(v)
    return spark.range(1, numPartitions=1).select(*[one(values[c]).cast(types[c]).alias(c) for c in types])


@dataclass(frozen=True)
class LoadResult:
    """Outcome of one dataset load."""

    dataset: str
    raw_path: str
    db_path: str
    raw_rows: int
    rows_written: int


class Loader:
    """Runs jobs against one store root: canonical tables under ``db``, raw
    keep-latest stores under ``raw/<source>``."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None,
                 updated_at: _dt.datetime | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.db = Store(spark, f"{self.root}/db")
        self.raw = Store(spark, f"{self.root}/raw")
        self.run_id = run_id or new_run_id()
        # One value per batch; tests pass a fixed instant.
        self.updated_at = updated_at

    # ------------------------------------------------------------ helpers ----
    def _now(self) -> Column:
        if self.updated_at is not None:
            return lit_timestamp_ntz(self.updated_at)
        return lit_timestamp_ntz(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))

    def table(self, spec: S.TableSpec) -> DataFrame | None:
        return self.db.read(spec)

    def _audit(self, dataset: str, source: str, table: str, scope: str, started: _dt.datetime,
               raw_rows: int, written: int, status: str = "success",
               message: str | None = None) -> None:
        finished = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        event_id = f"{self.run_id}:{dataset}:{table}:{uuid.uuid4().hex[:8]}"
        self.db.append(S.UPDATE_EVENTS, audit_row(
            self.spark, event_id=event_id, run_id=self.run_id, source_id=source, table_name=table, scope=scope,
            started_at=lit_timestamp_ntz(started), finished_at=lit_timestamp_ntz(finished), status=status,
            rows_read=int(raw_rows), rows_written=int(written), message=message))

    def _load(self, dataset: str, source: str, raw_name: str, batch: DataFrame,
              raw_keys, raw_date: str | None, targets, scope: str = "all",
              raw_sort=None) -> LoadResult:
        """Shared tail: raw merge (S7) -> map + conform -> upsert(s) (S10) ->
        audit (S11). ``targets`` is a list of (spec, mapper)."""
        started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        raw_rows, current = 0, targets[0][0].name
        try:
            seen = Observation()
            batch = batch.observe(seen, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
            raw_rows = int(seen.get["rows"])  # counted on the way
            raw_path = self.raw.path(f"{source}/{raw_name}")
            if raw_rows == 0:
                for spec, _ in targets:
                    self._audit(dataset, source, spec.name, scope, started, 0, 0)
                return LoadResult(dataset, raw_path, self.db.root, 0, 0)
            self.raw.merge_raw(f"{source}/{raw_name}", batch, raw_keys, date_col=raw_date,
                               sort_by=raw_sort)
            written = 0
            for spec, mapper in targets:
                current = spec.name
                n = self.db.upsert(spec, mapper(batch))
                self._audit(dataset, source, spec.name, scope, started, raw_rows, n)
                written += n
            return LoadResult(dataset, raw_path, self.db.root, raw_rows, written)
        except Exception as exc:
            # One audit row for the failed load, then the error goes on.
            self._audit(dataset, source, current, scope, started, raw_rows, 0,
                        status="failed", message=f"{type(exc).__name__}: {exc}")
            raise

    def _plan(self, ids: DataFrame, spec: S.TableSpec, start, end) -> DataFrame:
        """G2 over the canonical table of the job (tushare rows), read from the
        table's coverage summary when it has one."""
        return G.missing_ranges_by_instrument(ids, self.table(spec), start, end, "tushare",
                                              coverage=self.db.coverage(spec))

    def _select(self, landing: DataFrame, plan: DataFrame) -> DataFrame:
        """Landed rows inside their instrument's missing ranges. The
        plan's overall bounds (one-row aggregate) give a filter on the landed
        text dates that the scan can use; the range join stays exact."""
        b = plan.agg(F.min("range_start").alias("lo"), F.max("range_end").alias("hi")).first()
        return select_missing(_scan_days(landing, b["lo"], b["hi"]), plan)

    # ------------------------------------------------------------ lists ------
    def stock_list(self, landing: DataFrame) -> LoadResult:
        return self._load("stock_list", "tushare", "reference_instrument", landing, ["ts_code"],
                          None, [(S.REFERENCE_INSTRUMENT, P.stock_list)])

    def etf_list(self, landing: DataFrame) -> LoadResult:
        return self._load("etf_list", "tushare", "reference_instrument", landing, ["ts_code"],
                          None, [(S.REFERENCE_INSTRUMENT, P.etf_list)])

    def index_list(self, landing: DataFrame, markets=None) -> LoadResult:
        batch = U.in_values(landing, "market", markets or U.DEFAULT_INDEX_MARKETS)
        return self._load("index_list", "tushare", "reference_instrument", batch, ["ts_code"],
                          None, [(S.REFERENCE_INSTRUMENT, P.index_list)])

    def future_list(self, landing: DataFrame, exchanges=None) -> LoadResult:
        batch = U.in_values(landing, "exchange", exchanges or U.DEFAULT_FUTURE_EXCHANGES)
        now = self._now()
        return self._load("future_list", "tushare", "future_basic", batch, ["ts_code"], None, [
            (S.REFERENCE_INSTRUMENT, P.future_list_instrument),
            (S.REFERENCE_FUTURE, lambda b: P.future_list_contract(b, updated_at=now)),
        ])

    # ------------------------------------------------------------ daily ------
    def stock_st(self, landing: DataFrame, start, end) -> LoadResult:
        """Whole window every run (not incremental)."""
        batch = where_window(landing, "trade_date", start, end)
        return self._load("stock_st", "tushare", "reference_instrument_st", batch,
                          ["ts_code", "trade_date"], "trade_date",
                          [(S.REFERENCE_INSTRUMENT_ST, P.stock_st)],
                          raw_sort=["trade_date", "ts_code"])

    def stock_daily(self, landing: DataFrame, start, end) -> LoadResult:
        """G1 on market_bars_daily (no filters) -> landed rows inside the gaps."""
        cov = self.db.coverage(S.MARKET_BARS_DAILY)
        bounds = None if cov is None else cov.agg(
            F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))
        ranges = G.collect_ranges(G.missing_ranges(
            self.spark, self.table(S.MARKET_BARS_DAILY), start, end, bounds=bounds))
        if ranges:
            landing = _scan_days(landing, min(r[0] for r in ranges), max(r[1] for r in ranges))
        batch = landing.where(G.in_ranges(_day_of(landing), ranges))
        now = self._now()
        return self._load("stock_daily", "tushare", "stock_daily", batch,
                          ["ts_code", "trade_date"], "trade_date",
                          [(S.MARKET_BARS_DAILY, lambda b: P.daily_bars(b, updated_at=now))])

    def etf_daily(self, landing: DataFrame, start, end, params: dict | None = None) -> LoadResult:
        params = params or {}
        ref = self.table(S.REFERENCE_INSTRUMENT)
        universe = None if ref is None else U.etf_universe(ref, end)
        ids = U.resolve_universe(self.spark, params, universe, keys=("ts_codes", "ts_code"),
                                 what="ETF")
        plan = self._plan(ids, S.MARKET_BARS_DAILY, start, end)
        batch = pct_to_fraction_at_scan(self._select(landing, plan), "fund_daily")
        now = self._now()
        return self._load("market_bars_etf_daily", "tushare", "fund_daily", batch,
                          ["ts_code", "trade_date"], "trade_date",
                          [(S.MARKET_BARS_DAILY, lambda b: P.daily_bars(b, updated_at=now))])

    def index_daily(self, landing: DataFrame, start, end, api: str = "index_daily",
                    params: dict | None = None) -> LoadResult:
        if api not in INDEX_FEEDS:
            raise ValueError(f"Unsupported index api: {api!r}")
        params = params or {}
        ref = self.table(S.REFERENCE_INSTRUMENT)
        universe = None if ref is None else U.index_universe(ref, end)
        ids = U.resolve_universe(self.spark, params, universe, what="index")
        plan = self._plan(ids, S.MARKET_BARS_DAILY, start, end)
        batch = pct_to_fraction_at_scan(self._select(landing, plan), api)
        now = self._now()
        return self._load("market_bars_index_daily", "tushare", "index_daily", batch,
                          ["ts_code", "trade_date"], "trade_date",
                          [(S.MARKET_BARS_DAILY, lambda b: P.daily_bars(b, updated_at=now))])

    def future_daily(self, landing: DataFrame, start, end, params: dict | None = None) -> LoadResult:
        params = params or {}
        ref = self.table(S.REFERENCE_FUTURE)
        universe = None if ref is None else U.future_universe(ref, start, end)
        ids = U.resolve_universe(self.spark, params, universe, keys=("ts_codes", "ts_code"),
                                 what="futures")
        plan = self._plan(ids, S.MARKET_BARS_DERIVATIVE_DAILY, start, end)
        now = self._now()
        return self._load("market_bars_future_daily", "tushare", "future_daily",
                          self._select(landing, plan), ["ts_code", "trade_date"], "trade_date",
                          [(S.MARKET_BARS_DERIVATIVE_DAILY,
                            lambda b: P.future_bars(b, updated_at=now))])

    def fx_daily(self, landing: DataFrame, start, end, params: dict,
                 exchange: str | None = None) -> LoadResult:
        """Codes are required (no universe); reference rows are written first."""
        codes = U.explicit_codes(params, ("ts_codes", "ts_code"))
        if not codes:
            raise ValueError("market_fx_daily requires ts_code or ts_codes")
        plan = self._plan(U.codes_frame(self.spark, codes), S.MARKET_FX_DAILY, start, end)
        now = self._now()
        return self._load("market_fx_daily", "tushare", "fx_daily", self._select(landing, plan),
                          ["ts_code", "trade_date"], "trade_date", [
                              (S.REFERENCE_INSTRUMENT, lambda b: P.fx_reference(b, exchange)),
                              (S.MARKET_FX_DAILY, lambda b: P.fx_daily(b, updated_at=now)),
                          ])

    # ------------------------------------------------------------ Yahoo ------
    def yf_instrument(self, requested: DataFrame, candidates: DataFrame,
                      currency: str | None = None) -> LoadResult:
        """O3 -> O4 -> raw (all rows) -> P13 (valid rows) -> upsert. Tickers
        are required."""
        if requested.isEmpty():
            raise ValueError("yf_instrument requires tickers")
        info = O.ticker_info(O.best_match(requested, candidates))
        return self._load("yf_instrument", "yfinance", "reference_instrument", info, ["ticker"],
                          None, [(S.REFERENCE_INSTRUMENT,
                                  lambda b: P.yahoo_instrument(b, currency))])

    def yf_market_bars_daily(self, history: DataFrame, start=None, end=None,
                             tickers: DataFrame | None = None,
                             candidates: DataFrame | None = None) -> LoadResult:
        """Tickers (validated) or the Yahoo universe -> history window -> raw
        merge of all rows -> new keys only (J2, J1) -> lag (after the filter,
        Q5) -> upsert. ``end`` as for the scan: a date is inclusive, text is
        exclusive (Q8).

        With ``tickers`` and their search ``candidates``, tickers are
        validated first (O3 -> O4 -> F7) and the matched symbols are loaded;
        with ``tickers`` alone they are taken as already validated."""
        if tickers is not None and candidates is not None:
            requested = tickers.select(F.col(tickers.columns[0]).alias("ticker"))
            info = U.valid_only(O.ticker_info(O.best_match(requested, candidates)))
            tickers = info.where(F.col("instrument_id").isNotNull()).select("instrument_id")
        if tickers is None:
            ref = self.table(S.REFERENCE_INSTRUMENT)
            universe = None if ref is None else U.yahoo_universe(ref)
            tickers = U.resolve_universe(self.spark, {}, universe, what="Yahoo tickers")
        ids = tickers.select(F.col(tickers.columns[0]).alias("ticker")).distinct()
        batch = history_window(history.join(ids, "ticker", "left_semi"), start=start, end=end)
        now = self._now()

        def to_bars(b: DataFrame) -> DataFrame:
            # J2 reads only the stored months of the batch's window (two
            # scalars from a one-row aggregate of the checkpointed batch).
            w = b.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
            stored = days = None
            if w["lo"] is not None:
                days = w["lo"].date(), w["hi"].date()
                stored = self.db.read_window(S.MARKET_BARS_DAILY, *days)
            return P.yahoo_bars(J.new_rows(b, stored, "ticker", "date", "yfinance", days), updated_at=now)

        return self._load("yf_market_bars_daily", "yfinance", "daily", batch,
                          ["ticker", "date"], "date", [(S.MARKET_BARS_DAILY, to_bars)])


    # ------------------------------------------------------------ by name ----
    def update(self, dataset: str, landing: DataFrame, fields=None, index_api: str | None = None,
               **params) -> LoadResult:
        """Run the job of a dataset by its name. ``fields`` chooses the landed
        fields (text or list); ``index_api`` is the index job's ``api``."""
        if dataset not in JOBS:
            raise ValueError(f"no job for {dataset!r}; there are {sorted(JOBS)}")
        if index_api is not None:
            params["api"] = index_api
        if fields:  # what a landing zone adds isn't a vendor field
            fields = [f.strip() for f in fields.split(",")] if isinstance(fields, str) else list(fields)
            fields += [c for c in (ARRIVAL, LAND_MONTH) if c in landing.columns]
        return JOBS[dataset](self, select_fields(landing, fields), **params)


#: Jobs by the name of the dataset that they load.
JOBS = {
    "stock_list": Loader.stock_list,
    "stock_st": Loader.stock_st,
    "stock_daily": Loader.stock_daily,
    "etf_list": Loader.etf_list,
    "market_bars_etf_daily": Loader.etf_daily,
    "index_list": Loader.index_list,
    "market_bars_index_daily": Loader.index_daily,
    "future_list": Loader.future_list,
    "market_bars_future_daily": Loader.future_daily,
    "market_fx_daily": Loader.fx_daily,
    "yf_instrument": Loader.yf_instrument,
    "yf_market_bars_daily": Loader.yf_market_bars_daily,
}
