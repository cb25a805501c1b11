"""Sharding against the law it names, by a plain recomputation."""

import zlib
from collections import Counter, defaultdict

from tidemark.llm.shards import shard

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def _check(rows, given, n):
    assert sorted(((r["doc_id"] is None, r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        ((i is None, i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in given)
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_sizes_are_near_equal_with_a_hot_text(spark, docs_of):
    given = [(i, "copy of one text " * 3 if i % 3 == 0 else f"text {i} " * (1 + i % 23)) for i in range(9_000)]
    out = shard(docs_of(given), 7)
    assert out.columns == COLUMNS
    sizes = _check(out.collect(), given, 7)
    most = max(len(t.encode()) + 16 for _, t in given)
    assert len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) <= 2 * most


def test_equal_texts_are_neighbours(spark, docs_of):
    given = [(i, f"text {i % 40}") for i in range(400)]
    shards = defaultdict(set)
    for r in shard(docs_of(given), 5).collect():
        shards[r["text_crc32"]].add(r["shard"])
    assert all(max(s) - min(s) <= 1 for s in shards.values())


def test_odd_rows_and_clashing_columns(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows).selectExpr("*", "'x' AS size", "1 AS shard", "2 AS h", "3 AS r", "'y' AS range")
    _check(shard(docs, 4).collect(), odd_rows, 4)


def test_result_does_not_hang_on_partitioning(spark, docs_of):
    given = [(i, f"t{i % 9} " * (i % 5)) for i in range(300)]
    docs = docs_of(given)
    assert sorted(shard(docs, 6).collect()) == sorted(shard(docs.repartition(11), 6).collect())


def test_empty_table(spark, docs_of):
    out = shard(docs_of([(1, "a")]).limit(0), 3)
    assert out.columns == COLUMNS and out.count() == 0
