"""Ticker resolution (O3, O4): best search candidate per requested ticker and
the ticker-info row built from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.quotes import asset_class_of, instrument_type_of

NO_QUOTE = "No quote found"


def case_unique(df: DataFrame) -> DataFrame:
    """Rename columns whose names collide ignoring case (``shortname`` and
    ``shortName`` in search results) by position, so each is addressable:
    the n-th repeat becomes ``<lower name>_<n>``. Spark resolves names
    case-insensitively, so the plain names would be ambiguous."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        key = c.lower()
        n = seen.get(key, 0)
        seen[key] = n + 1
        names.append(c if n == 0 else f"{key}_{n}")
    return df.toDF(*names) if names != df.columns else df


def _any_spelling(df: DataFrame, base: str):
    """First non-null of every spelling of ``base`` (in column order)."""
    cols = [F.col(f"`{c}`") for c in df.columns
            if c.lower() == base or c.lower().startswith(base + "_")]
    if not cols:
        return F.lit(None).cast(T.StringType())
    return F.coalesce(*cols) if len(cols) > 1 else cols[0]


def best_match(requested: DataFrame, candidates: DataFrame) -> DataFrame:
    """O3: per requested ticker, the exact case-insensitive symbol match with
    the best rank, else the best-ranked candidate.

    ``found`` = matched symbol equals the ticker ignoring case; short_name =
    first non-null of shortname / shortName; no candidate -> found false and
    reason 'No quote found'. The choice is a ``min_by`` aggregate keyed on
    (not exact, rank), which Spark combines map-side.
    """
    c = F.col
    candidates = case_unique(candidates)
    exact = F.coalesce(F.upper(c("symbol")) == F.upper(c("ticker")), F.lit(False))
    picked = candidates.groupBy("ticker").agg(
        F.min_by(
            F.struct(
                c("symbol").alias("symbol"),
                c("quoteType").alias("quote_type"),
                c("exchange").alias("exchange"),
                _any_spelling(candidates, "shortname").alias("short_name"),
            ),
            F.struct((~exact).cast(T.IntegerType()), c("rank")),
        ).alias("m")
    )
    joined = requested.select("ticker").join(picked, "ticker", "left")
    matched = c("m.symbol")
    return joined.select(
        c("ticker"),
        F.coalesce(
            matched.isNotNull() & (F.upper(matched) == F.upper(c("ticker"))), F.lit(False)
        ).alias("found"),
        matched.alias("matched_symbol"),
        c("m.quote_type").alias("quote_type"),
        c("m.exchange").alias("exchange"),
        c("m.short_name").alias("short_name"),
        F.when(c("m").isNull(), F.lit(NO_QUOTE)).alias("reason"),
    )


def ticker_info(matches: DataFrame, source_id: str = "yfinance") -> DataFrame:
    """Ticker-info rows; instrument_id = symbol = matched symbol when
    found; name = full_name = short name else instrument_id; market =
    exchange; class and type from the quote type (M6); valid flag."""
    c = F.col
    iid = F.when(c("found") & c("matched_symbol").isNotNull(), c("matched_symbol"))
    name = F.coalesce(c("short_name"), iid)
    return matches.select(
        c("ticker"),
        (c("found") & iid.isNotNull()).alias("valid"),
        iid.alias("instrument_id"),
        iid.alias("symbol"),
        name.alias("name"),
        name.alias("full_name"),
        c("exchange"),
        c("exchange").alias("market"),
        c("quote_type"),
        asset_class_of("quote_type").alias("asset_class"),
        instrument_type_of("quote_type").alias("instrument_type"),
        c("ticker").alias("source_code"),
        F.lit(source_id).alias("source_id"),
        c("reason"),
    )
