"""M6: quote type -> asset class / instrument type (upper-cased; unknown -> 'unknown')."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quote type -> asset class.
ASSET_CLASS = {
    "EQUITY": "equity",
    "ETF": "fund",
    "MUTUALFUND": "fund",
    "INDEX": "index",
    "FUTURE": "future",
    "CURRENCY": "currency",
    "CRYPTOCURRENCY": "crypto",
}

# Quote type -> instrument type.
INSTRUMENT_TYPE = {
    "EQUITY": "stock",
    "ETF": "etf",
    "MUTUALFUND": "mutual_fund",
    "INDEX": "index",
    "FUTURE": "future",
    "CURRENCY": "currency",
    "CRYPTOCURRENCY": "crypto",
}


def _lookup(mapping: dict[str, str], col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    key = F.upper(F.coalesce(c.cast("string"), F.lit("")))
    return F.coalesce(F.try_element_at(table, key), F.lit("unknown"))


def asset_class_of(col: Column | str) -> Column:
    return _lookup(ASSET_CLASS, col)


def instrument_type_of(col: Column | str) -> Column:
    return _lookup(INSTRUMENT_TYPE, col)
