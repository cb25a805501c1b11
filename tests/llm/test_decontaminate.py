"""Benchmark windows against a plain search."""

import hashlib
import random
import re

from tidemark.llm import decontaminate as D


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute(docs, items):
    windows = []
    for item, text in items:
        w = _words(text)
        k = min(10, len(w))
        windows += [(item, w[i : i + k]) for i in range(len(w) - k + 1) if w]
    out = {}
    for i, text in docs:
        w, hit, found = _words(text), set(), set()
        for item, g in windows:
            for p in range(len(w) - len(g) + 1):
                if w[p : p + len(g)] == g:
                    hit |= set(range(p, p + len(g)))
                    found.add(item)
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out[i] = (len(w), len(hit), len(found - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


def _corpus():
    rnd = random.Random(1)
    pick = lambda n: [rnd.choice(["Ä", "b", "c3", "d", "e", "F", "g"]) for _ in range(n)]
    items = [(i, rnd.choice([" ", "-", "_"]).join(pick(rnd.choice([1, 4, 9, 10, 11, 30])))) for i in range(40)]
    items += [(3, items[3][1]), (None, "lonely words that no item names"), (98, None), (99, "...")]
    docs = []
    for i in range(150):
        words = pick(rnd.choice([0, 1, 5, 40]))
        for _ in range(rnd.choice([0, 0, 1, 3])):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = _words(rnd.choice(items)[1])
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(words)))
    return docs + [(500, "x " * 50_000 + "lonely words that no item names"), (501, None), (502, "")], items


def _items(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def _report(df):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()}


def test_report_in_one_block_and_in_many(spark, docs_of, monkeypatch):
    docs, items = _corpus()
    want = _brute(docs, items)
    assert any(x[1] for x in want.values()) and not all(x[1] for x in want.values())
    assert _report(D.contamination_report(docs_of(docs), _items(spark, items))) == want
    monkeypatch.setattr(D, "BLOCK_WINDOWS", 60)
    assert len(list(D._blocks(_items(spark, items)))) > 3
    assert _report(D.contamination_report(docs_of(docs), _items(spark, items))) == want


def test_removal(spark, docs_of):
    item = "one two three four five six seven eight nine ten eleven"
    clean = " ".join(f"w{i}" for i in range(40))
    docs = docs_of([(1, f"{clean}. {item.upper()}, {clean}"), (2, clean), (3, f"{item} tail"), (4, None), (5, ""),
                    (6, f"{item} {item} {clean} {clean}")]).selectExpr("*", "1 AS spans", "'x' AS items", "2 AS n_hit")
    out = D.remove_contamination(docs, _items(spark, [(1, item)]))
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {1: f"{clean}. , {clean}", 2: clean, 4: None, 5: "", 6: f"  {clean} {clean}"}


def test_empty_tables_and_odd_rows(spark, docs_of, odd_rows):
    none = _items(spark, [(1, "a")]).limit(0)
    assert not any(r["contaminated"] for r in D.contamination_report(docs_of(odd_rows), none).collect())
    assert D.contamination_report(docs_of(odd_rows).limit(0), _items(spark, [(1, "a")])).count() == 0
    marked = D.mark_contamination(docs_of(odd_rows), _items(spark, [(1, "same text here"), (1, "same text here")]))
    assert sorted(r["doc_id"] for r in marked.where("n_hit = 3").collect()) == [6, 6, 7]
    assert marked.where("n_hit > 0").collect()[0]["items"] == [1]


def test_columns_with_the_names_of_working_columns_stay(spark, docs_of):
    docs = docs_of([(1, "some words of the benchmark item here"), (2, "clean")]).selectExpr("*", "7 AS __text", "8 AS __n", "9 AS __spans")
    items = _items(spark, [(1, "words of the benchmark")])
    marked = {r["doc_id"]: r for r in D.mark_contamination(docs, items).collect()}
    assert (marked[1]["n_hit"], marked[1]["__text"], marked[1]["__n"], marked[1]["__spans"]) == (4, 7, 8, 9)
    cut = D.remove_contamination(docs, items, 0.9)
    assert cut.columns == docs.columns
    assert {r["doc_id"]: (r["text"], r["__text"], r["__spans"]) for r in cut.collect()} == {1: ("some  item here", 7, 9), 2: ("clean", 7, 9)}


def test_blocks_take_a_pass_each(spark, docs_of, monkeypatch):
    """One Python step in the plan however many blocks there are."""
    monkeypatch.setattr(D, "BLOCK_WINDOWS", 4)
    items = [(i, f"a{i} b{i} c{i}") for i in range(20)]
    docs = docs_of([(i, f"x a{i} b{i} c{i} y") for i in range(20)])
    marked = D.mark_contamination(docs, _items(spark, items))
    assert marked._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert all((r["n_hit"], r["items"]) == (3, [r["doc_id"]]) for r in marked.collect())


def test_removal_is_one_python_step(spark, docs_of, monkeypatch):
    """A worker for marking and another for cutting would both be alive in every task."""
    item = "a b c d e f g h i j k"
    docs = docs_of([(1, f"{item} {item}"), (2, f"{item} " + "w " * 30), (3, f"x {item} " + "y " * 10), (4, None), (5, "")])
    for block in (D.BLOCK_WINDOWS, 1):
        monkeypatch.setattr(D, "BLOCK_WINDOWS", block)
        out = D.remove_contamination(docs, _items(spark, [(1, item), (2, "w w w")]))
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert {r["doc_id"]: r["text"] for r in out.collect()} == {3: "x  " + "y " * 10, 4: None, 5: ""}
