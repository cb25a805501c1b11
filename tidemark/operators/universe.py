"""Universe selection (F1-F9): which instruments are live for a window.

Each universe is a ``where`` over a reference table and returns a one-column
DataFrame ``instrument_id``, ordered by it (O2). Where a universe only feeds a
join or a distinct, the optimizer drops the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import lit_date, parse_param_date
from tidemark.functions.text import ends_with_any
from tidemark.operators.coverage import equality_filter  # noqa: F401  (F1)

# Default market / exchange lists for the list scans (F8).
DEFAULT_INDEX_MARKETS = ["SSE", "SZSE", "CSI"]
DEFAULT_FUTURE_EXCHANGES = ["CFFEX", "DCE", "CZCE", "SHFE", "INE", "GFEX"]

# Index universe patterns.
INDEX_CSI_PATTERN = r"^[0-9]{6}\.CSI$"
INDEX_ID_EXCLUDE = "(USD|HKD|GBP|EUR|CAD|CNH)"
INDEX_NAME_EXCLUDE = "(全收益|净收益|退市|USD|HKD|GBP|EUR|CAD|CNH)"


def _ids(df: DataFrame) -> DataFrame:
    return df.select("instrument_id").orderBy("instrument_id")


def etf_universe(reference: DataFrame, end) -> DataFrame:
    """listed tushare ETFs, listed by ``end`` (or list date unknown), on SZ/SH."""
    end_d = lit_date(parse_param_date(end))
    c = F.col
    return _ids(reference.where(
        (c("asset_class") == "fund")
        & (c("instrument_type") == "etf")
        & (c("source_id") == "tushare")
        & (c("list_status") == "L")
        & (c("list_date").isNull() | (c("list_date") <= end_d))
        & ends_with_any("instrument_id", [".SZ", ".SH"])
    ))


def index_universe(reference: DataFrame, end) -> DataFrame:
    """listed tushare indices alive at ``end`` on SH/SZ or 6-digit CSI ids,
    excluding foreign-currency and total/net-return or delisted series."""
    end_d = lit_date(parse_param_date(end))
    c = F.col
    name = F.coalesce(c("name"), F.lit(""))
    full_name = F.coalesce(c("full_name"), F.lit(""))
    return _ids(reference.where(
        (c("asset_class") == "index")
        & (c("instrument_type") == "index")
        & (c("source_id") == "tushare")
        & (c("list_status") == "L")
        & c("list_date").isNotNull()
        & (c("list_date") <= end_d)
        & (c("exp_date").isNull() | (c("exp_date") > end_d))
        & (ends_with_any("instrument_id", [".SH", ".SZ"])
           | c("instrument_id").rlike(INDEX_CSI_PATTERN))
        & ~c("instrument_id").rlike(INDEX_ID_EXCLUDE)
        & ~name.rlike(INDEX_NAME_EXCLUDE)
        & ~full_name.rlike(INDEX_NAME_EXCLUDE)
    ))


def future_universe(reference_future: DataFrame, start, end) -> DataFrame:
    """tushare contracts whose life [list_date, last_ddate|delist_date]
    overlaps the window (list date required)."""
    start_d = lit_date(parse_param_date(start))
    end_d = lit_date(parse_param_date(end))
    c = F.col
    last = F.coalesce(c("last_ddate"), c("delist_date"))
    return _ids(reference_future.where(
        (c("source_id") == "tushare")
        & c("list_date").isNotNull()
        & (c("list_date") <= end_d)
        & (last.isNull() | (last >= start_d))
    ))


def yahoo_universe(reference: DataFrame) -> DataFrame:
    """listed Yahoo instruments."""
    return _ids(reference.where(
        (F.col("source_id") == "yfinance") & (F.col("list_status") == "L")
    ))


def explicit_codes(params: dict, keys=("index_codes", "ts_codes", "ts_code")) -> list | None:
    """explicit codes override the universe; first present key wins
    (index_codes > ts_codes > ts_code). Lists are sorted; a single string is
    one code. None when no key is given."""
    for key in keys:
        value = params.get(key)
        if value:
            if isinstance(value, str):
                return [value]
            return sorted(value)
    return None


def codes_frame(spark: SparkSession, codes: list) -> DataFrame:
    """user-supplied codes as a one-column DataFrame (parameter input)."""
    schema = T.StructType([T.StructField("instrument_id", T.StringType())])
    return spark.createDataFrame([(c,) for c in codes], schema)


def resolve_universe(
    spark: SparkSession, params: dict, universe: DataFrame | None,
    keys=("index_codes", "ts_codes", "ts_code"), what: str = "instruments",
) -> DataFrame:
    """F6 + the empty-universe rule: explicit codes, else the universe, which
    must not be empty (checked once with ``isEmpty``)."""
    codes = explicit_codes(params, keys)
    if codes is not None:
        return codes_frame(spark, codes)
    if universe is None or universe.isEmpty():
        raise ValueError(f"No {what} found for the universe.")
    return universe


def valid_only(df: DataFrame, flag: str = "valid") -> DataFrame:
    """keep rows flagged valid."""
    return df.where(F.col(flag) == F.lit(True))


def in_values(df: DataFrame, col: str, values) -> DataFrame:
    """F8: scan partitioned by market / exchange list -> one ``isin`` filter."""
    if isinstance(values, str):
        values = [values]
    return df.where(F.col(col).isin(list(values)))
