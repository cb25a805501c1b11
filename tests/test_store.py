"""Store operators: keep-latest (N3/S7), upsert (S10), relaxed union (U1),
align-on-read (S9) and the constraint checks (C5)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators import conform as C
from tidemark.operators import store as ST

KV = S.TableSpec("kv", S.struct("k:s, v:i?"), ("k",))


def kv(spark, rows):
    return spark.createDataFrame(rows, KV.schema)


def as_dict(df, key="k", val="v"):
    return {r[key]: r[val] for r in df.collect()}


def test_upsert_replaces_and_adds(spark):
    out = ST.upsert(kv(spark, [("a", 1), ("b", 2)]), kv(spark, [("b", 9), ("c", 3)]), KV)
    assert as_dict(out) == {"a": 1, "b": 9, "c": 3}


def test_upsert_once_is_upsert_with_the_batch_computed_once(spark):
    spec = S.TableSpec("t", S.struct("k:s?, l:i?, v:i?"), ("k", "l"))
    frame = lambda rows: spark.createDataFrame(rows, spec.schema)
    stored = frame([("a", 1, 0), ("a", 1, 1), ("a", 2, 2), (None, 1, 3), (None, 1, 3), ("a", None, 4), (None, None, 5)])
    batch = frame([("a", 1, 6), ("a", 1, 6), ("c", 3, 7), (None, 1, 8), ("a", None, 9), (None, None, 5)])
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(ST.upsert_once(stored, batch, spec)) == rows(ST.upsert(stored, batch, spec))
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    ST.upsert_once(stored, batch.mapInArrow(counted, spec.schema), spec).collect()
    assert calls.value == 6


def test_upsert_once_of_a_batch_that_is_dealt_already(spark):
    spec = S.TableSpec("t", S.struct("k:s?, d:d?, c:s?, v:i?"), ("k", "d"))
    cols = [F.expr(e) for e in ("k", "cast(d as date) AS d", "k AS c", "v")]
    frame = lambda rows: spark.createDataFrame(rows, "k string, d string, v int").select(*cols)
    stored = frame([("a", "2026-01-01", 0), ("a", "2026-01-01", 1), ("a", "2025-01-01", 2), (None, "2026-01-01", 3),
                    (None, "2026-01-01", 3), ("a", None, 4), (None, None, 5)])
    batch = frame([("a", "2026-01-01", 6), ("a", "2026-01-01", 6), ("c", "2026-01-01", 7), (None, "2026-01-01", 8), ("a", None, 9), (None, None, 5)])
    by = [F.col("k"), F.year("d")]
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    dealt = batch.repartition(*by)
    out = ST.upsert_once(stored, dealt, spec, by)
    assert out.columns == ["k", "d", "c", "v"]
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    want = rows(ST.upsert(stored, batch, spec))
    assert rows(out) == rows(ST.upsert_once(stored, batch, spec, by)) == want
    assert rows(ST.upsert_once(stored.limit(0), dealt, spec, by)) == rows(batch)


def test_upsert_missing_columns_sorted(spark):
    spec = S.TableSpec("t", S.struct("k:s, z:i?, y:i?"), ("k",))
    with pytest.raises(ValueError, match=r"\['y', 'z'\]"):
        ST.upsert(None, spark.createDataFrame([("a",)], "k string"), spec)


def test_upsert_drops_extra_columns(spark):
    inc = spark.createDataFrame([("a", 1, "x")], "k string, v int, extra string")
    assert ST.upsert(None, inc, KV).columns == ["k", "v"]


def test_duplicate_key_found(spark):
    found = C.key_violations(kv(spark, [("b", 9), ("b", 8), ("c", 1)]), KV.primary_key).collect()
    assert [(r["k"], r["n_rows"]) for r in found] == [("b", 2)]


def test_required_null_rejected(spark):
    spec = S.TableSpec("t", S.struct("k:s, v:i"), ("k",))
    df = C.guard_required(spark.createDataFrame([("a", None)], "k string, v int"), spec)
    with pytest.raises(PySparkException):
        df.collect()


def test_keep_latest_whole_row_wins(spark):
    stored = spark.createDataFrame([("x", 1, 5)], "k string, v int, w int")
    incoming = spark.createDataFrame([("x", 2)], "k string, v int")
    out = ST.merge_keep_latest(stored, incoming, ["k"]).collect()
    assert [(r["k"], r["v"], r["w"]) for r in out] == [("x", 2, None)]


def test_keep_latest_order_and_null_keys(spark):
    rows = [("a", 1, 1), ("a", 2, 3), ("a", 3, 2), (None, 4, 1), (None, 5, 2)]
    df = spark.createDataFrame(rows, "k string, v int, o int")
    out = {r["k"]: r["v"] for r in ST.keep_latest(df, ["k"], "o").collect()}
    assert out == {"a": 2, None: 5}


def test_merge_null_key_replaced(spark):
    stored = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([(None, 2)], "k string, v int")
    out = sorted((r["k"] or "", r["v"]) for r in ST.merge_keep_latest(stored, incoming, ["k"]).collect())
    assert out == [("", 2), ("a", 1)]


def test_relaxed_union_types(spark):
    left = spark.createDataFrame([(1, 1.5)], "a bigint, b double")
    right = spark.createDataFrame([("x1", 2, "e")], "a string, b int, c string")
    out = ST.relaxed_union(left, right)
    types = dict(out.dtypes)
    assert types == {"a": "string", "b": "double", "c": "string"}
    assert sorted((r["a"], r["c"]) for r in out.collect()) == [("1", None), ("x1", "e")]


def test_align_to_spec_adds_typed_nulls(spark):
    df = spark.createDataFrame([("a",)], "k string")
    out = ST.align_to_spec(df, KV)
    assert out.dtypes == [("k", "string"), ("v", "bigint")]


def test_key_violations(spark):
    df = kv(spark, [("a", 1), ("a", 2), ("b", 1)])
    assert [(r["k"], r["n_rows"]) for r in C.key_violations(df, ["k"]).collect()] == [("a", 2)]


@settings(max_examples=8, deadline=None)
@given(
    stored=st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9), max_size=6),
    incoming=st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 9), max_size=6),
)
def test_upsert_property(spark, stored, incoming):
    """Key stays unique; result = stored updated by incoming; applying the
    same batch again changes nothing."""
    s = kv(spark, list(stored.items())) if stored else None
    inc = kv(spark, list(incoming.items()))
    once = ST.upsert(s, inc, KV)
    expected = dict(stored) | dict(incoming)
    assert as_dict(once) == expected
    assert once.count() == len(expected)
    twice = ST.upsert(once, inc, KV)
    assert as_dict(twice) == expected


def test_conform_lenient(spark):
    spec = S.TableSpec("t", S.struct("k:s, n:f?, d:d?, t:t?, i:i?"), ("k",))
    df = spark.createDataFrame(
        [("a", "1.5", "20260601", "2026-06-01 10:00:00", "7", "drop"),
         ("b", "x", "bad", "bad", "7.5", "drop")],
        "k string, n string, d string, t string, i string, extra string")
    out = {r["k"]: r for r in C.conform(df, spec).collect()}
    assert out["a"]["n"] == 1.5 and str(out["a"]["d"]) == "2026-06-01" and out["a"]["i"] == 7
    assert out["b"]["n"] is None and out["b"]["d"] is None and out["b"]["t"] is None
    assert C.conform(df, spec).columns == ["k", "n", "d", "t", "i"]


def test_conform_missing_required_raises(spark):
    spec = S.TableSpec("t", S.struct("k:s, r:s"), ("k",))
    df = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError, match="missing required column: r"):
        C.conform(df, spec)
    assert C.conform(df, spec, fill_missing=True).collect()[0]["r"] is None


def test_registry_refuses_unknown_type():
    from pyspark.sql import types as T
    with pytest.raises(TypeError):
        S.TableSpec("t", T.StructType([T.StructField("x", T.DecimalType(10, 2))]), ())


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 99)),
                     min_size=1, max_size=12, unique_by=lambda r: r[1]))
def test_keep_latest_property(spark, rows):
    """One row per key (null keys are one key); the greatest ordinal wins."""
    df = spark.createDataFrame([(k, o, o * 10) for k, o in rows], "k string, o int, v int")
    got = {r["k"]: (r["o"], r["v"]) for r in ST.keep_latest(df, ["k"], "o").collect()}
    expected = {}
    for k, o in rows:
        if k not in expected or o > expected[k][0]:
            expected[k] = (o, o * 10)
    assert got == expected


def test_relaxed_union_flag_with_numbers(spark):
    a = spark.createDataFrame([(True,), (False,)], "x boolean")
    b = spark.createDataFrame([(5,)], "x bigint")
    c = spark.createDataFrame([(2.5,)], "x double")
    out = ST.relaxed_union(a, b, c)
    assert dict(out.dtypes) == {"x": "double"}
    assert sorted(r["x"] for r in out.collect()) == [0.0, 1.0, 2.5, 5.0]
    flags = ST.relaxed_union(a, spark.createDataFrame([(None,)], "x boolean"))
    assert dict(flags.dtypes) == {"x": "boolean"}  # flags alone stay flags


def test_numbers_are_numbers(spark):
    from tidemark.functions.numeric import to_double
    texts = ["1.5", " 2 ", "-3.", ".5", "1e3", "1.5d", "3f", "0x1p3", "n/a", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(to_double("x")).collect()]
    assert got == [1.5, 2.0, -3.0, 0.5, 1000.0, None, None, None, None, None, None]
    spec = S.TableSpec("t", S.struct("x:f?"), ())
    assert [r[0] for r in C.conform(df, spec).collect()] == got


def test_keep_latest_does_not_hang_on_partitioning(spark):
    rows = [("a", i % 7, f"v{i % 5}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    one = ST.merge_keep_latest(None, df.repartition(7, "v"), ["k"]).collect()
    two = ST.merge_keep_latest(None, df.repartition(3, "n"), ["k"]).collect()
    assert one == two and tuple(one[0]) == ("a", 6, "v4")
