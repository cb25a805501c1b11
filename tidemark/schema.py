"""Table registry: one ``StructType`` per canonical table plus its key.

Types follow the canonical model: text -> string, whole numbers -> bigint,
reals -> double, flags -> boolean, calendar days -> date and wall-clock
instants -> timestamp_ntz. A non-nullable field is a *required* column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "f": T.DoubleType(),
    "b": T.BooleanType(),
    "d": T.DateType(),
    "t": T.TimestampNTZType(),
    "i": T.LongType(),
}
ALLOWED_TYPES = tuple(type(t) for t in _TYPES.values())


def struct(spec: str) -> T.StructType:
    """Build a ``StructType`` from ``"name:type[?], ..."`` (``?`` = nullable)."""
    fields = []
    for item in spec.split(","):
        name, code = item.strip().split(":")
        nullable = code.endswith("?")
        fields.append(T.StructField(name, _TYPES[code.rstrip("?")], nullable))
    return T.StructType(fields)


@dataclass(frozen=True)
class TableSpec:
    """A canonical table: name, typed columns, primary key and storage layout.

    ``partition_by`` names derived storage columns (see :func:`storage_columns`)
    used only for the on-disk layout; they never appear in the model columns.
    """

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    description: str = ""

    def __post_init__(self) -> None:
        for field in self.schema.fields:
            if not isinstance(field.dataType, ALLOWED_TYPES):
                raise TypeError(f"Unsupported schema type: {field.dataType!r}")
        missing = [k for k in self.primary_key if k not in self.columns]
        if missing:
            raise ValueError(f"{self.name}: key columns not in schema: {missing}")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    def field(self, name: str) -> T.StructField:
        return self.schema[name]


_BARS = (
    "instrument_id:s, trade_date:d, open:f?, high:f?, low:f?, close:f?, pre_close:f?, "
    "change:f?, pct_chg:f?, volume:f?, amount:f?, source_code:s, source_id:s, updated_at:t"
)
_DERIVATIVE = (
    "instrument_id:s, trade_date:d, pre_close:f?, pre_settle:f?, open:f?, high:f?, low:f?, "
    "close:f?, settle:f?, change1:f?, change2:f?, vol:f?, amount:f?, oi:f?, oi_chg:f?, "
    "delv_settle:f?, source_code:s, source_id:s, updated_at:t"
)
_FX = (
    "instrument_id:s, trade_date:d, bid_open:f?, bid_high:f?, bid_low:f?, bid_close:f?, "
    "ask_open:f?, ask_high:f?, ask_low:f?, ask_close:f?, mid_open:f?, mid_high:f?, "
    "mid_low:f?, mid_close:f?, spread_close:f?, source_code:s, source_id:s, updated_at:t"
)

REFERENCE_INSTRUMENT = TableSpec(
    "reference_instrument",
    struct(
        "instrument_id:s, symbol:s, name:s, full_name:s, enname:s?, market:s?, exchange:s, "
        "currency:s?, list_status:s?, list_date:d?, delist_date:d?, is_hs:b, source_code:s, "
        "source_id:s, asset_class:s, instrument_type:s, index_code:s?, exp_date:d?"
    ),
    ("instrument_id",),
    description="instrument master",
)
REFERENCE_INSTRUMENT_ST = TableSpec(
    "reference_instrument_st",
    struct(
        "instrument_id:s, name:s, trade_date:d, type:s, type_name:s, source_code:s, source_id:s"
    ),
    ("instrument_id", "trade_date", "type"),
    partition_by=("trade_month",),
    description="daily special-treatment list",
)
REFERENCE_FUTURE = TableSpec(
    "reference_future",
    struct(
        "instrument_id:s, symbol:s, exchange:s, name:s, fut_code:s?, multiplier:f?, "
        "trade_unit:s?, per_unit:f?, quote_unit:s?, quote_unit_desc:s?, d_mode_desc:s?, "
        "list_date:d?, delist_date:d?, d_month:s?, last_ddate:d?, source_code:s, "
        "source_id:s, updated_at:t"
    ),
    ("instrument_id",),
    description="futures contract master",
)
MARKET_BARS_DAILY = TableSpec(
    "market_bars_daily", struct(_BARS), ("instrument_id", "trade_date"),
    partition_by=("trade_month",), description="daily bars",
)
MARKET_BARS_DERIVATIVE_DAILY = TableSpec(
    "market_bars_derivative_daily", struct(_DERIVATIVE), ("instrument_id", "trade_date"),
    partition_by=("trade_month",), description="daily futures bars",
)
MARKET_FX_DAILY = TableSpec(
    "market_fx_daily", struct(_FX), ("instrument_id", "trade_date"),
    partition_by=("trade_month",), description="daily two-sided FX quotes",
)
UPDATE_RUNS = TableSpec(
    "update_runs",
    struct(
        "run_id:s, run_env:s, config_path:s, database_path:s, started_at:t, "
        "finished_at:t?, status:s, message:s?"
    ),
    ("run_id",),
)
UPDATE_EVENTS = TableSpec(
    "update_events",
    struct(
        "event_id:s, run_id:s, source_id:s, table_name:s, scope:s, started_at:t, "
        "finished_at:t?, status:s, rows_read:i, rows_written:i, message:s?"
    ),
    ("event_id",),
)
SYNC_STATE = TableSpec(
    "sync_state",
    struct(
        "source_id:s, table_name:s, scope:s, last_success_date:d?, last_success_at:t?, "
        "status:s, message:s?, updated_at:t"
    ),
    ("source_id", "table_name", "scope"),
)

BUSINESS_TABLES = (
    REFERENCE_INSTRUMENT,
    REFERENCE_INSTRUMENT_ST,
    REFERENCE_FUTURE,
    MARKET_BARS_DAILY,
    MARKET_BARS_DERIVATIVE_DAILY,
    MARKET_FX_DAILY,
)
METADATA_TABLES = (UPDATE_RUNS, UPDATE_EVENTS, SYNC_STATE)
TABLES = {t.name: t for t in BUSINESS_TABLES + METADATA_TABLES}


def table(name: str) -> TableSpec:
    try:
        return TABLES[name]
    except KeyError:
        raise KeyError(f"Unknown table: {name}") from None


# ---------------------------------------------------------------------------
# Landing contracts: the vendor field lists, landed as files (dates as text).
# ---------------------------------------------------------------------------

_DAILY = (
    "ts_code:s?, trade_date:s?, open:f?, high:f?, low:f?, close:f?, pre_close:f?, "
    "change:f?, pct_chg:f?, vol:f?, amount:f?"
)

# Search results carry the short name twice, as ``shortname`` and
# ``shortName``; names resolve case-insensitively (Spark, parquet, DuckDB), so
# the second spelling is landed as ``shortname_1``.
LANDING = {
    "stock_basic": struct(
        "ts_code:s?, symbol:s?, name:s?, area:s?, industry:s?, fullname:s?, enname:s?, "
        "cnspell:s?, market:s?, exchange:s?, curr_type:s?, list_status:s?, list_date:s?, "
        "delist_date:s?, is_hs:s?, act_name:s?, act_ent_type:s?"
    ),
    "stock_st": struct("ts_code:s?, name:s?, trade_date:s?, type:s?, type_name:s?"),
    "daily": struct(_DAILY),
    "etf_basic": struct(
        "ts_code:s?, csname:s?, extname:s?, cname:s?, index_code:s?, index_name:s?, "
        "setup_date:s?, list_date:s?, list_status:s?, exchange:s?, mgr_name:s?, "
        "custod_name:s?, mgt_fee:f?, etf_type:s?"
    ),
    "fund_daily": struct(_DAILY),
    "index_basic": struct(
        "ts_code:s?, name:s?, fullname:s?, market:s?, publisher:s?, index_type:s?, "
        "category:s?, base_date:s?, base_point:f?, list_date:s?, weight_rule:s?, exp_date:s?"
    ),
    "index_daily": struct(_DAILY),
    "index_global": struct(_DAILY),
    "fut_index_daily": struct(_DAILY),
    "fut_basic": struct(
        "ts_code:s?, symbol:s?, exchange:s?, name:s?, fut_code:s?, multiplier:f?, "
        "trade_unit:s?, per_unit:f?, quote_unit:s?, quote_unit_desc:s?, d_mode_desc:s?, "
        "list_date:s?, delist_date:s?, d_month:s?, last_ddate:s?"
    ),
    "fut_daily": struct(
        "ts_code:s?, trade_date:s?, pre_close:f?, pre_settle:f?, open:f?, high:f?, low:f?, "
        "close:f?, settle:f?, change1:f?, change2:f?, vol:f?, amount:f?, oi:f?, oi_chg:f?, "
        "delv_settle:f?"
    ),
    "fx_daily": struct(
        "ts_code:s?, trade_date:s?, bid_open:f?, bid_close:f?, bid_high:f?, bid_low:f?, "
        "ask_open:f?, ask_close:f?, ask_high:f?, ask_low:f?"
    ),
    "history": struct(
        "ticker:s?, date:t?, open:f?, high:f?, low:f?, close:f?, adj_close:f?, volume:f?, "
        "dividends:f?, stock_splits:f?"
    ),
    "quotes": struct(
        "ticker:s?, rank:i?, symbol:s?, quoteType:s?, exchange:s?, shortname:s?, shortname_1:s?"
    ),
}

# Fixed column order of a long-form price history (wide -> long reshape output).
HISTORY_COLUMNS = [
    "ticker", "date", "open", "high", "low", "close", "adj_close", "volume",
    "dividends", "stock_splits",
]
