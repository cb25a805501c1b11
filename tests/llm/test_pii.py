"""Personal data: the patterns against the plain regular expressions, and the
terms that give an entity away."""

import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii as X

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d):
    total = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a@.-%+ 0129(\né", max_size=40))
def test_patterns_on_any_text(text):
    assert X.base_spans(text) == _brute(text)


def test_patterns_on_dense_texts():
    rnd = random.Random(1)
    for _ in range(400):
        text = "".join(rnd.choice(["4111 1111 1111 1111", "1.2.3.4", ".5.6", "256.1.1.1", "a@b.c", "@d.e", "+1 (555) 123-4567",
                                   "x", " ", "-", "0", "4539578763621486", "é", "+", "\n"]) for _ in range(12))
        assert X.base_spans(text) == _brute(text)
    assert X.base_spans("1" * 100_000 + "." + "a" * 100_000 + "@") == []
    assert len(X.base_spans("a@b.c " * 20_000)) == 20_000


def _corpus():
    rnd = random.Random(2)
    filler = lambda: " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(12))
    rows = [(i, f"{filler()} Zorbulon writes from zed@corp.example.com {filler()}") for i in range(8)]
    rows += [(10 + i, f"{filler()} copied Quux at q@corp.example.com says") for i in (0,)]
    rows += [(20 + i, rows[8][1]) for i in range(9)]  # copies: one surrounding
    rows += [(40 + i, filler()) for i in range(60)]
    rows += [(200, "the plan of ZORBULON alone"), (201, None), (202, ""), (None, "zorbulon 1.2.3.4"), (203, "x" * 100_000)]
    return rows


def test_revealing_terms(spark, docs_of):
    found = {r["term"]: r for r in X.revealing_terms(docs_of(_corpus()), min_bits=2.0).collect()}
    assert set(found) == {"zorbulon", "writes", "from"}
    assert abs(found["zorbulon"]["given"] - 0.8) < 1e-9  # 8 of its 10 documents
    assert X.revealing_terms(docs_of([(1, "nothing here")])).count() == 0


def test_copies_leave_a_term_revealing(spark, docs_of):
    """Three surroundings, each in many copies: of the whole text (zorbulon),
    and of the passage in texts that differ elsewhere (quuxine)."""
    whole = [f"one{i} two{i} Zorbulon zed@corp.example.com nine{i}" for i in range(3)]
    passage = [f"a{i}aa b{i}bb c{i}cc d{i}dd Quuxine q@corp.example.com e{i}ee f{i}ff g{i}gg h{i}hh i{i}ii" for i in range(3)]
    rows = [(i, whole[i % 3]) for i in range(150)]
    rows += [(1000 + i, f"start{i} of it {passage[i % 3]} and end{i}") for i in range(30)]
    rows += [(2000 + i, f"filler{i} alone") for i in range(400)] + [(3000 + i, "the same filler") for i in range(300)]
    found = {r["term"]: (r["given"], r["bits"]) for r in X.revealing_terms(docs_of(rows), min_bits=2.0).collect()}
    assert found["zorbulon"][0] == found["quuxine"][0] == 1.0
    total = 3 + 30 + 400 + 1
    assert abs(found["zorbulon"][1] - math.log2(total / 3)) < 1e-9 and abs(found["quuxine"][1] - math.log2(total / 30)) < 1e-9


def test_report(spark, docs_of, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_TERMS", 1)  # one pass for each term
    monkeypatch.setattr(X, "MIN_BITS", 2.0)
    rows = _corpus()
    docs = docs_of(rows).selectExpr("*", "'x' AS spans", "1 AS n_email")
    terms = X.revealing_terms(docs, min_bits=2.0)
    texts = {i: t for i, t in rows}
    spanned = X.find_spans(docs, terms).collect()
    assert len(spanned) == len(rows)
    for r in spanned:
        text = texts[r["doc_id"]] or ""
        spans = [(x["kind"], x["start"], x["end"]) for x in r["spans"]]
        base = _brute(text)
        want = [("term", *m.span()) for m in re.finditer(r"(?i)\b(zorbulon|writes|from)\b", text)]
        assert spans == base + want
    for r in X.pii_report(docs).collect():
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in _brute(texts[r["doc_id"]] or ""))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and r["spans"].startswith(base)
        assert (r["n_email"], r["n_ip"]) == (base.count("email"), base.count("ip:"))


def test_sanitise(spark, docs_of):
    rows = [(1, "mail a@b.cc, call +1 (555) 123-4567 or 10.0.0.1!"), (2, None), (3, ""), (4, "clean text 12"), (5, "4111 1111 1111 1111")]
    docs = docs_of(rows).selectExpr("*", "'x' AS spans")
    out = X.sanitise(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: "mail [EMAIL], call [PHONE] or [IP]!", 2: None, 3: "", 4: "clean text 12", 5: "[CARD]"}
    assert X.sanitise(docs.limit(0)).count() == 0 and X.pii_report(docs.limit(0)).count() == 0
