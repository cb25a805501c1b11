"""Sharding by sampled splitters: shards of near equal bytes.

Records are ordered by (hash of the text, doc_id), so equal texts lie side by
side and nothing about the order follows the source. A size-weighted sample of
keys gives splitters at its quantiles; they cut the key space into many more
ranges than shards. Ranges that turn out overfull are subdivided by splitters
sampled inside them, also inside a single hot text (its doc_ids differ). The
ranges' exact totals then place each range, and a running sum inside each
range places each record: shard = how many n-ths of all bytes lie before the
record's middle. Only splitters, a bounded number, reach the driver.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, utf8

ROWS_PER_RANGE = 4_000
MOST_RANGES = 10_000  # bounds the splitters that the driver holds and sends out
SAMPLES_PER_RANGE = 24


def _range_of(splitters: list[tuple[int, int, int]]):
    """Number of splitters at or below each key (hash, doc_id, row)."""
    heads = np.array([s[0] for s in splitters], np.int64)

    @F.pandas_udf("int")
    def find(h: pd.Series, d: pd.Series, r: pd.Series) -> pd.Series:
        key = h.to_numpy(np.int64)
        low = np.searchsorted(heads, key, "left")
        out = np.searchsorted(heads, key, "right")
        for i in np.nonzero(low != out)[0]:  # a splitter has this very hash: the rest of the key decides
            out[i] = bisect_right(splitters, (int(key[i]), int(d.iloc[i]), int(r.iloc[i])))
        return pd.Series(out.astype(np.int32))

    return find


def _quantiles(sample: list, parts: int) -> list[tuple[int, int, int]]:
    """Keys that cut a sorted sample into ``parts`` equal parts."""
    return [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []


def shard(docs: DataFrame, n_shards: int = 40, seed: int = 0) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; others are ignored):
    doc_id, size (UTF-8 bytes plus 16), text_crc32, law (``bytes``: shard
    sizes near equal, apart by about one record), shard, slot (gapless from 0
    in key order within the shard) and grown_shard (null under this law).

    Null text counts as empty; null doc_ids come first among equal texts;
    repeated rows are apart in an arbitrary but gapless order; an empty table
    gives no rows. The result follows from the rows alone: the samples only
    decide how the work is dealt out."""
    text = utf8(F.col("text"))
    rows = materialize(docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d"),
        F.monotonically_increasing_id().alias("r")))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not count:
        out = rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"),
                          F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
        return out
    ranges = min(MOST_RANGES, max(n_shards, math.ceil(count / ROWS_PER_RANGE)))
    key = ["h", "d", "r"]

    def sampled(part: DataFrame, of_bytes: int, parts: int, salt: int) -> list:
        share = F.col("size") * (SAMPLES_PER_RANGE * parts / of_bytes)
        chance = F.pmod(F.xxhash64(F.lit(seed + salt), *key), F.lit(1 << 30)) / float(1 << 30)
        return sorted(tuple(x) for x in part.where(chance < share).select(*key).collect())

    splitters = _quantiles(sampled(rows, total, ranges, 0), ranges)
    fair = total / ranges
    for turn in range(1, 4):
        ranged = rows.withColumn("range", _range_of(splitters)(*key))
        full = (ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
                .where((F.col("bytes") > 3 * fair) & (F.col("n") > 1)).collect())
        if not full or len(splitters) > 2 * MOST_RANGES:
            break
        over = {x["range"]: x["bytes"] for x in full}
        inside = ranged.where(F.col("range").isin(list(over)))
        parts = math.ceil(sum(over.values()) / fair)
        drawn = sampled(inside, sum(over.values()), parts, turn)
        splitters = sorted({*splitters, *_quantiles(drawn, parts)})

    ranged = rows.withColumn("range", _range_of(splitters)(*key))
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over at most a few 10,000 sums
    starts = ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("b").over(order), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(order), F.lit(0)).alias("rows_before"))
    within = Window.partitionBy("range").orderBy(*key)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("bytes_before") + F.sum("size").over(running) - F.col("size") / 2
    placed = ranged.join(F.broadcast(starts), "range").select(
        "doc_id", "size", "text_crc32",
        F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / total)).cast("int").alias("shard"),
        (F.col("rows_before") + F.row_number().over(within)).alias("at"))
    placed = materialize(placed)
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
