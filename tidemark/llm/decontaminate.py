"""Benchmark decontamination: a broadcast hash set of benchmark word windows.

Every benchmark item gives its windows of ``WINDOW`` consecutive words (an item
with fewer words is one window). The windows' hashes are broadcast; each task
runs over the token windows of its documents, looks the hashes up, verifies
every hit word by word, and marks the words inside it. The windows are built in
tasks and dealt by hash into blocks of no more than about ``BLOCK_WINDOWS``. One block is
broadcast at a time; a benchmark of several blocks takes a pass for each, which
is written before the next, when the block's broadcast is destroyed. Documents
are never shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix, received, send, slices, unused, utf8

WINDOW = 10
BLOCK_WINDOWS = 500_000
BYTES_AT_ONCE, WINDOWS_AT_ONCE = 2_000_000, 20_000
#: Stands between two texts: a byte that no UTF-8 text has.
BOUND = b"\xff"
#: Working columns beside those of the documents.
TEXT, COUNT, ITEMS, SPANS = "__text", "__n", "__items", "__spans"
#: Words are runs of ASCII digits, ASCII letters (lower-cased) and all non-ASCII characters; the rest separates.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class WindowSet:
    """A block of benchmark windows: a hash set to look runs of words up in,
    and the windows themselves to verify what it finds.

    Only words that some window has can be inside one. Each word becomes its
    number among those (0: none of them), so only runs of numbered words are
    hashed at all."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[int]]):
        words = sorted({w for window in windows for w in window})
        self.number = {w: i + 1 for i, w in enumerate(words)} | {BOUND: -1}
        self.items = {tuple(self.number[w] for w in window): items for window, items in windows.items()}
        self.hashes: dict[int, np.ndarray] = {}
        for length in {len(w) for w in windows}:
            runs = np.array([w for w in self.items if len(w) == length], np.int64)
            self.hashes[length] = np.unique(self._hash(runs))

    @staticmethod
    def _hash(runs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(runs), np.uint64)
        with np.errstate(over="ignore"):
            for column in runs.T:
                out = out * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64)
            return mix(out)

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple[int, int, set[int]]]]:
        """Words of each text; (start, end, items) of all occurrences, counted
        through all texts' words with one place between two texts."""
        words = (b" " + BOUND + b" ").join([t.translate(FOLD) for t in texts]).split()
        number = np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))
        bounds = np.concatenate([[-1], np.nonzero(number == -1)[0], [len(words)]])
        known = np.concatenate([[0], np.cumsum(number > 0)])
        found = []
        for length, hashes in self.hashes.items():
            if len(number) < length:
                continue
            start = np.nonzero(known[length:] - known[:-length] == length)[0]
            runs = number[start[:, None] + np.arange(length)]
            maybe = np.isin(self._hash(runs), hashes)
            for i, run in zip(start[maybe].tolist(), runs[maybe].tolist(), strict=True):
                items = self.items.get(tuple(run))
                if items is not None:
                    found.append((i, i + length, items))
        return bounds, found


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``window`` (words and spaces) and ``item`` for every window of every item."""
    for batch in batches:
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
            words = words_of(text.as_py())
            length = min(WINDOW, len(words))
            for at in range(0, len(words) - length + 1 if words else 0, WINDOWS_AT_ONCE):
                upto = min(at + WINDOWS_AT_ONCE, len(words) - length + 1)
                own = [b" ".join(words[i : i + length]).decode() for i in range(at, upto)]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([item] * len(own), pa.int64())], ["window", "item"])


def _mark(found: WindowSet, drop_share: float | None = None):
    """Adds a block's hits to ITEMS and SPANS (word ranges). With ``drop_share``
    (after the last block) rows with a larger share of their words in ranges
    go, and from the others' texts the ranges are cut out."""

    def some(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.schema.names
        bounds, hits = found.find([t.as_py() for t in batch.column(TEXT)])
        items, spans = batch.column(ITEMS).to_pylist(), batch.column(SPANS).to_pylist()
        for (start, end, own), at in zip(hits, np.searchsorted(bounds, [h[0] for h in hits]) - 1, strict=True):
            first = int(bounds[at]) + 1
            spans[at] += [start - first, end - first]
            items[at] = sorted({*items[at], *(i for i in own if i is not None)})
        cols = {COUNT: pa.array(np.diff(bounds) - 1), ITEMS: pa.array(items, pa.list_(pa.int64())),
                SPANS: pa.array(spans, pa.list_(pa.int32()))}
        return pa.RecordBatch.from_arrays([cols.get(n, batch.column(n)) for n in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, TEXT, BYTES_AT_ONCE):
                yield some(part) if drop_share is None else _without(some(part), drop_share)

    return run


def _blocks(benchmark: DataFrame) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark's different windows in blocks of bounded size: one at a
    time is fetched and sent out, and the flag tells the last. There is always one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), utf8(F.col("text")).alias("text"))
    most = items.agg(F.coalesce(F.sum(F.expr("octet_length(text) div 2 + 1")), F.lit(0))).first()[0]  # no fewer than the windows
    windows = materialize(
        items.mapInArrow(_windows, "window string, item long").groupBy("window").agg(F.collect_set("item").alias("items")))
    blocks = 1 + most // BLOCK_WINDOWS
    for i in range(blocks):
        own = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == i).collect()
        found = {tuple(r["window"].encode().split(b" ")): set(r["items"]) for r in own}
        yield send(benchmark.sparkSession, WindowSet(found)), i == blocks - 1


def _scan(docs: DataFrame, text: Column, benchmark: DataFrame, drop_share: float | None = None) -> DataFrame:
    """``docs`` plus COUNT, ITEMS and SPANS of ``text``; with ``drop_share``
    without what is contaminated, in the same Python worker."""
    out = docs.select("*", utf8(text).alias(TEXT), F.lit(0).cast("long").alias(COUNT),
                      F.array().cast("array<long>").alias(ITEMS), F.array().cast("array<int>").alias(SPANS))
    schema = out.schema
    for block, last in _blocks(benchmark):
        share = drop_share if last else None
        out = out.mapInArrow(lambda batches, block=block, share=share: _mark(received(block), share)(batches), schema)
        if not last:
            out = materialize(out)
            block.destroy()
    return out.drop(TEXT)


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with other names for columns that have those of the working
    columns, and the names to give back."""
    back = {unused(docs, c): c for c in docs.columns if c.lower() in (TEXT, COUNT, ITEMS, SPANS)}
    return docs.withColumnsRenamed({c: free for free, c in back.items()}), back


def mark_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (any columns, with ``text``) plus ``n_words``, ``n_hit`` (words
    inside any occurrence of a window), ``n_items``, ``items`` (item_ids with
    occurring windows, ascending) and ``spans`` (word ranges start, end, …, of
    the occurrences). Null text has no words. A null item_id marks words but
    isn't listed; repeated items count once; an empty benchmark marks nothing.
    Columns of ``docs`` with these five names are replaced."""
    names = {COUNT: "n_words", ITEMS: "items", SPANS: "spans"}
    docs, back = _aside(docs.drop("n_words", "n_hit", "n_items", "items", "spans"))
    return (_scan(docs, F.col("text"), benchmark)
            .withColumns({"n_items": F.size(ITEMS).cast("long"), "n_hit": _covered()}).withColumnsRenamed(names | back))


def _covered() -> Column:
    """Words covered by the ranges, counted once: after sorting by start, each
    range adds what lies beyond the furthest end so far."""
    ranges = F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(SPANS)), lambda i: (i < F.size(SPANS)) & (i % 2 == 0)),
        lambda i: F.struct(F.get(F.col(SPANS), i).alias("s"), F.get(F.col(SPANS), i + 1).alias("e"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(ranges, start, lambda acc, r: F.struct(
        F.greatest(acc["end"], r["e"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), r["e"] - F.greatest(acc["end"], r["s"]))).cast("long").alias("n")))["n"]


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256 (of
    the item_ids sorted as strings, comma-joined) and contaminated."""
    marked = _scan(docs.select("doc_id", "text"), F.col("text"), benchmark)
    names = F.array_join(F.array_sort(F.transform(ITEMS, lambda i: i.cast("string"))), ",")
    return marked.select("doc_id", F.col(COUNT).alias("n_words"), _covered().alias("n_hit"),
                         F.size(ITEMS).cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
                         ).withColumn("contaminated", F.col("n_hit") > 0)


WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _without(batch: pa.RecordBatch, drop_share: float) -> pa.RecordBatch:
    """The rows with no more than ``drop_share`` of their words in SPANS, without these in the text."""
    kept, texts = [], []
    for raw, body, n, spans in zip(batch.column(TEXT), batch.column("text"), batch.column(COUNT), batch.column(SPANS), strict=True):
        flat = spans.as_py()
        ranges = sorted(zip(flat[::2], flat[1::2], strict=True))
        covered = at = 0
        for s, e in ranges:
            covered += max(0, e - max(at, s))
            at = max(at, e)
        kept.append(covered <= n.as_py() * drop_share)
        if not kept[-1]:
            continue
        if not ranges or not body.is_valid:
            texts.append(body.as_py())
            continue
        raw = raw.as_py()
        places = [m.span() for m in WORD.finditer(raw)]
        out, at = [], 0
        for s, e in ranges:
            begin, end = places[s][0], places[e - 1][1]
            if begin > at:
                out.append(raw[at:begin])
            at = max(at, end)
        texts.append(b"".join([*out, raw[at:]]).decode())
    rows = batch.filter(pa.array(kept, pa.bool_()))
    cols = {"text": pa.array(texts, pa.string())}
    return pa.RecordBatch.from_arrays([cols.get(n, rows.column(n)) for n in rows.schema.names], rows.schema.names)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, drop_share: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages: a document whose words lie in
    occurrences by more than ``drop_share`` goes; from others the occurrences
    are cut out of the text (nothing else changes). Columns stay as they are."""
    docs, back = _aside(docs)
    return _scan(docs, F.col("text"), benchmark, drop_share).select(*docs.columns).withColumnsRenamed(back)
