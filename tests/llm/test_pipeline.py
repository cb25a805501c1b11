"""The pipeline's stages one after another, each against plain Python, and
the registered queries against their SQL."""

import random
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import decontaminate, near_dup, pieces, queries
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_registered_names():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "personal_data", "sentence_pieces"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    res = duck.execute(queries.SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, res.fetchall())[0]


def _prose(rnd, n):
    return " ".join(f"{rnd.choice('bcdfg')}{rnd.randrange(10**6)}" for _ in range(n)) + "."


def test_stages(spark, tmp_path, docs_of):
    rnd = random.Random(1)
    item = " ".join(f"item{i}" for i in range(40))
    clean = {i: _prose(rnd, 90) for i in range(10)}
    near = clean[0].split()
    near[40] = "changed"
    rows = [*clean.items(), (20, clean[0]), (21, " ".join(near)), (22, "too short"), (23, None), (24, ""),
            (25, _prose(rnd, 60) + " " + item + " " + _prose(rnd, 60)), (26, item + " " + _prose(rnd, 20)),
            (27, _prose(rnd, 70) + " mail me@host.example.org now"), (28, " ".join(f"w{i}###" for i in range(99))),
            (5, clean[5]), (None, _prose(rnd, 80))]
    sf = str(tmp_path)
    docs_of(rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        docs = spark.read.parquet(f"{sf}/{name}")
        seen.append((before, docs.collect()))
        assert docs.columns == columns or name == "sentence_pieces"
    ids = [sorted((r["doc_id"] for r in rows), key=lambda i: (i is None, i)) for _, rows in seen]
    assert ids[0] == sorted([*range(10), 5, 20, 21, 25, 26, 27]) + [None]  # short, empty and symbols are gone
    assert ids[1] == sorted([*range(10), 25, 26, 27]) + [None]
    assert ids[2] == sorted([*range(10), 25, 27]) + [None]
    texts = {r["doc_id"]: r["text"] for r in seen[3][1]}
    assert item not in texts[25] and "item" not in texts[25] and "[EMAIL]" in texts[27]
    assert all(texts[i] == clean[i] for i in clean)
    stands = pieces.load()[1]
    assert all(pieces.decode_ids(r["piece_ids"], stands) == r["text"] for r in seen[4][1])
    ran = corpus_pipeline.run(spark, sf)
    assert ran.columns == [*columns, "piece_ids"]
    assert sorted(map(str, ran.collect())) == sorted(map(str, seen[4][1]))


def test_stages_of_an_empty_table(spark, tmp_path, docs_of):
    sf = str(tmp_path)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs_of([(1, "a")]).limit(0).write.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == 0 and "piece_ids" in out.columns


def test_operators_agree_with_their_reports(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in near_dup.near_duplicates(docs).where("kept").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()} == kept
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    left = decontaminate.remove_contamination(docs, benchmark)
    assert not any(r["contaminated"] for r in decontaminate.contamination_report(left, benchmark).collect())
