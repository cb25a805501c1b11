"""Language identification: exact code lengths by plain recursion, and
held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import language as G

STEMS = {"en": ["the", "with", "ing", "tion", "and", "of"], "de": ["der", "und", "ung", "keit", "über", "sch"],
         "fr": ["les", "ment", "que", "eau", "été", "ç"]}


def _text(rnd, lang, n):
    return " ".join("".join(rnd.choice(STEMS[lang]) for _ in range(rnd.choice([1, 1, 2, 3]))) for _ in range(n))


def _grams(texts):
    out = Counter()
    for t in texts:
        raw = G.PAD + t.encode()
        out.update(int.from_bytes(raw[i : i + 4], "big") for i in range(len(raw) - 3))
    return np.array(list(out), np.int64), np.array(list(out.values()), np.int64)


def _bits(trees, counts, text):
    """The same prediction, one byte at a time, from dictionaries."""
    symbol = lambda b: int(trees.symbol[b])
    seen = {k: {} for k in range(4)}
    for gram, n in zip(*counts):
        s = [symbol(b) for b in int(gram).to_bytes(4, "big")]
        for k in range(4):
            at = seen[k].setdefault(tuple(s[3 - k : 3]), Counter())
            at[s[3]] += int(n)

    def p(context):
        out = [1 / G.SYMBOLS] * G.SYMBOLS
        for k in range(4):
            at = seen[k].get(tuple(context[3 - k :]))
            if not at:
                continue
            n, t = sum(at.values()), len(at)
            left = sum(out[x] for x in range(G.SYMBOLS) if x not in at)
            escape = t / (n + t) if left > 0 else 0
            out = [at[x] / n * (1 - escape) if x in at else escape * out[x] / left for x in range(G.SYMBOLS)]
        return out

    total, raw = 0.0, G.PAD + text.encode()
    for i in range(3, len(raw)):
        q = p([symbol(b) for b in raw[i - 3 : i]])
        assert sum(q) == pytest.approx(1.0)
        s = symbol(raw[i])
        total -= math.log2(q[s]) - (math.log2(256 - G.SYMBOLS + 1) if s == G.SYMBOLS - 1 else 0)
    return total


def test_code_lengths():
    rnd = random.Random(1)
    counts = {x: _grams([_text(rnd, x, 30) for _ in range(5)]) for x in STEMS}
    trees = G.ContextTrees(counts)
    for text in [_text(rnd, "de", 8), "日本 \x00 zz", "x", ""]:
        got = trees.code_lengths(text.encode())
        assert got == pytest.approx([_bits(trees, counts[x], text) for x in trees.langs], rel=1e-5, abs=1e-6)


def test_pieces_of_a_long_text_add_up(monkeypatch):
    rnd = random.Random(2)
    trees = G.ContextTrees({x: _grams([_text(rnd, x, 50)]) for x in STEMS})
    raw = _text(rnd, "fr", 500).encode()
    whole = trees.code_lengths(raw)
    monkeypatch.setattr(G, "AT_ONCE", 17)
    assert trees.code_lengths(raw) == pytest.approx(whole, rel=1e-6)


def _held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(spark, docs_of):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        lang = rnd.choice(list(STEMS))
        label = lang if rnd.random() < 0.9 else rnd.choice(["en", None])  # some labels are wrong or missing
        rows.append((i, _text(rnd, lang, rnd.choice([3, 20, 100])), label, lang))
    truth = {r[0]: r[3] for r in rows}
    got = G.language_report(docs_of([r[:3] for r in rows])).collect()
    assert all(r["held_out"] == _held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 100 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_labels_of_held_out_rows_are_never_used(spark, docs_of):
    rows = [(i, "der und keit ung", "zz" if _held_out(i) else "de") for i in range(60)]
    assert {r["lang_pred"] for r in G.language_report(docs_of(rows)).collect()} == {"de"}


def test_sample_fills_the_bound_and_leaves_no_language_out(spark, docs_of):
    rnd = random.Random(5)
    long = [(i, _text(rnd, "en", 20_000), "en") for i in range(4)]  # a few texts, each over the bound
    copied = [(100 + i, t, "de") for i, t in enumerate([_text(rnd, "de", 30) for _ in range(60)] * 20)]
    small = [(5000 + i, t, "fr") for i, t in enumerate(("que les eau", "été ment", "été ment"))]
    rows, bound = [*long, *copied, *small], 20_000
    known = docs_of(rows).select("text", "lang")
    texts = {x: {(G.PAD + t.encode()) for _, t, lang in rows if lang == x} for x in STEMS}
    got = {x: [] for x in STEMS}
    for r in G.training_sample(known, bound).collect():
        got[r["lang"]].append(bytes(r["text"]))
    n = {x: sum(len(t) - len(G.PAD) for t in got[x]) for x in STEMS}
    assert bound <= n["en"] < bound + G.PIECE_BYTES
    assert n["de"] == min(n["de"], bound + 1_000) and n["de"] >= min(bound, sum(len(t) - 3 for t in texts["de"]))
    assert sorted(got["fr"]) == sorted(texts["fr"])
    for x in STEMS:
        assert len(set(got[x])) == len(got[x]) and all(any(t in whole for whole in texts[x]) for t in got[x])
    assert set(G.training_counts(known, bound)) == set(STEMS) and set(G.training_counts(known, 1)) == set(STEMS)


def test_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of([*((i, t, None) for i, t in odd_rows), *((100 + i, "some english text", "en") for i in range(20)),
                    (300, "123 -- 456 !", "en")])
    got = G.language_report(docs.selectExpr("*", "'x' AS lang_pred", "array(1) AS score")).collect()
    assert len(got) == len(odd_rows) + 21
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 300))
    assert all(by[i]["lang_pred"] == "en" for i in (4, 5, 6, 8))
    nothing = G.language_report(docs_of([(1, "a text", None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in nothing] == [("und", 0.0)]
    assert G.language_report(docs.limit(0)).count() == 0
