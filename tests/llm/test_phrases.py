"""Collocations against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import phrases as P


def _brute(rows, min_count, top):
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    out = []
    for lang in sorted(total):
        scored = []
        for (x, w), a in f.items():
            if x != lang or len(w) == 1 or a < min_count:
                continue
            cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            inside = any(y == lang and len(v) == 3 and len(w) == 2 and w in (v[:2], v[1:]) and b >= min_count and 100 * b >= 50 * a
                         for (y, v), b in f.items())
            if not inside:
                scored.append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
        for rank, (score, a, w, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, w.decode(), -a, left, right, total[lang], -score))
    return out


def _rows(seed, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "日本", "ÉX", "\xa0", "a\x1cb"]
    fixed = ["new york city", "On the Other hand", "per cent"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(60)):
            parts.append(rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(words[: rnd.choice([5, 35])]))
            parts.append(rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!", "\r\n"]))
        rows.append((i, "".join(parts), rnd.choice(["en", "de", None, "und"])))
    return rows


def _got(df):
    return sorted(tuple(r) for r in df.collect())


def test_against_counting_all(spark, docs_of):
    rows = _rows(1, 250)
    want = _brute(rows, 10, 2000)
    assert len(want) > 20 and {len(w[2].split(" ")) for w in want} == {2, 3}
    assert _got(P.collocations(docs_of(rows))) == want


def test_several_blocks_slices_and_the_top(spark, docs_of, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_PHRASES", 40)
    monkeypatch.setattr(P, "SLICE_BYTES", 300)
    rows = _rows(2)
    assert _got(P.collocations(docs_of(rows), 4, 25)) == _brute(rows, 4, 25)


def test_full_bitmaps_only_keep_more(spark, docs_of, monkeypatch):
    monkeypatch.setattr(P, "MOST_BITS", 64)  # all bits are set
    rows = _rows(3, 30)
    assert _got(P.collocations(docs_of(rows), 5)) == _brute(rows, 5, 2000)


def test_scores_beyond_64_bits(spark):
    """A hot phrase: 10^6 * a * a passes 2^63."""
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat('hot pair. ', 100000) AS text", "'en' AS lang")
    (row,) = P.collocations(docs).collect()
    assert tuple(row) == ("en", 1, "hot pair", 4_000_000, 4_000_000, 4_000_000, 8_000_000, 1_000_000)
    assert 1_000_000 * row["a"] ** 2 > 2**63


@pytest.mark.parametrize("seed", range(3))
def test_trie_accepts_just_its_phrases(seed):
    rnd = random.Random(seed)
    words = [f"w{i}".encode() for i in range(rnd.choice([3, 40, 400]))]
    pairs = sorted({(rnd.choice(["x", "y"]), b" ".join(rnd.choice(words) for _ in range(rnd.choice([2, 3])))) for _ in range(600)})
    trie, states = P.build_trie([x for x, _ in pairs], pa.array([p.decode() for _, p in pairs]))
    assert len(set(states.tolist())) == len(pairs)
    text = [rnd.choice(words + [b"other"]) for _ in range(5000)]
    for lang in ("x", "y", "z"):
        own = P.Words.of([b" ".join(text)])
        n = P.count_states(trie, iter([(lang, own)]))
        for (x, p), s in zip(pairs, states.tolist(), strict=True):
            k = len(p.split(b" "))
            want = sum(b" ".join(text[i : i + k]) == p for i in range(len(text) - k + 1)) if x == lang else 0
            assert n[s] == want


def test_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of([(i, t, None) for i, t in odd_rows]).selectExpr("*", "'x' AS phrase", "1 AS n", "2 AS h", "3 AS a", "4 AS words")
    want = _brute([(i, t, None) for i, t in odd_rows], 10, 2000)
    assert _got(P.collocations(docs)) == want == [("und", 1, "word word word", 29998, 30000, 29999, want[0][6], want[0][7])]
    assert P.collocations(docs.limit(0)).count() == 0
    assert np.array_equal(P.Words.of([b"", b"a"]).at, [-1, 0])


def test_bitmaps_are_sent_once(spark, docs_of, monkeypatch):
    """Each of the three bitmaps leaves the driver once, not with every step that reads it."""
    from pyspark import SparkContext

    monkeypatch.setattr(P, "BITS_EACH", 1 << 24)
    monkeypatch.setattr(P, "MOST_BITS", 1 << 24)
    sizes, real = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sizes.append(len(value)) or real(self, value))
    docs = docs_of([(i, "a b c d") for i in range(40)]).selectExpr("lang", "cast(text as binary) AS text")
    tokens = P.tokens_of(docs)
    found = P.candidates(tokens, P.count_words(tokens).where("f >= 10"))
    assert {r["phrase"] for r in found.collect()} == {"a b", "b c", "c d", "a b c", "b c d"}
    assert [n for n in sizes if n > 1_000_000] == [1 << 21] * 3


def test_rows_of_a_task_count_together():
    """What several rows of a task have leaves it once, and only states that accept a phrase."""
    from types import SimpleNamespace

    rows = [P.Words.of([b"a b c d"]), P.Words.of([b"c d. a b c"])]
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(["x"]), P.one_list(w.words), P.one_list(pa.array(w.hashes.view(np.int64))), P.one_list(pa.array(w.at.astype(np.int32)))],
        ["lang", "words", "hashes", "at"]) for w in rows]
    full = SimpleNamespace(value=np.full(8, 255, np.uint8))
    got = [r for out in P._count_hashes([full])(iter(batches)) for r in out.to_pylist()]
    assert len({r["h"] for r in got}) == len(got) == 3 and sorted(r["n"] for r in got) == [2, 2, 2]

    wanted = pa.table({"lang": ["x", "x", "x"], "phrase": ["a b c", "c d", "d e"]})
    made = P._tries((pa.scalar(0),), wanted).to_pylist()[0]
    got = [r for out in P._count_phrases(SimpleNamespace(value=made["trie"]))(iter(batches)) for r in out.to_pylist()]
    of = {a["state"]: a["phrase"] for a in made["accepts"]}
    assert sorted((of[r["state"]], r["n"]) for r in got) == [("a b c", 2), ("c d", 2)]


def test_each_candidate_leaves_one_row_only(spark, docs_of, monkeypatch):
    """However many rows of words have a frequent phrase, one of them gives its text."""
    monkeypatch.setattr(P, "SLICE_BYTES", 1)  # a row for each text
    monkeypatch.setattr(P, "HELD", 0)  # and none counted together
    given, real = spark.sparkContext.accumulator(0), P._candidates

    def counted(sent):
        def run(batches):
            for out in real(sent)(batches):
                given.add(len(out))
                yield out
        return run

    monkeypatch.setattr(P, "_candidates", counted)
    docs = docs_of([(i, "a b c d") for i in range(40)] + [(i, f"a b{i} c d") for i in range(40, 60)]).selectExpr("lang", "cast(text as binary) AS text")
    tokens = P.tokens_of(docs)
    assert tokens.count() == 60
    found = P.candidates(tokens, P.count_words(tokens).where("f >= 10"))
    assert {r["phrase"] for r in found.collect()} == {"a b", "b c", "c d", "a b c", "b c d"}
    assert given.value == 5


def test_one_pass_whatever_the_number_of_blocks(spark, docs_of, monkeypatch):
    """Each block of candidates was a pass of its own over all words, so the work grew with the square of the corpus."""
    from pyspark import SparkContext

    rows = _rows(4, 120)
    docs = docs_of(rows).selectExpr("coalesce(lang, 'und') AS lang", "cast(coalesce(text, '') as binary) AS text")
    monkeypatch.setattr(P, "SLICE_BYTES", 300)
    tokens = P.tokens_of(docs)
    wanted = P.candidates(tokens, P.count_words(tokens).where("f >= 3"), 3).localCheckpoint()
    passes, sent, real, broadcast = [], [], P.in_fewer_tasks, SparkContext.broadcast
    monkeypatch.setattr(P, "in_fewer_tasks", lambda *a: passes.append(a) or real(*a))
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(value) or broadcast(self, value))
    monkeypatch.setattr(P, "BLOCK_PHRASES", 20)
    monkeypatch.setattr(P, "ROWS_A_PART", 1, raising=False)  # and each block in several parts
    assert wanted.count() > 200
    got = {(r["lang"], r["phrase"]): r["f"] for r in P.count_phrases(tokens, wanted).collect()}
    assert len(passes) == len(sent) == 1
    f = Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            f.update((lang or "und", " ".join(words[i : i + k])) for k in (2, 3) for i in range(len(words) - k + 1))
    assert got == {(r["lang"], r["phrase"]): f[r["lang"], r["phrase"]] for r in wanted.collect()}


def test_different_phrases_by_their_words_alone():
    """Places of phrases are told apart without hashes, also where the numbers of words don't fit 64 bits together."""
    rnd = random.Random(5)
    at = np.array([rnd.randrange(4) for _ in range(300)])
    want = Counter(tuple(at[i : i + 3].tolist()) for i in range(298))
    for n_words in (4, 1 << 40):
        place, times = P.different(at, np.arange(298), 3, n_words)
        assert {tuple(at[p : p + 3].tolist()): n for p, n in zip(place.tolist(), times.tolist(), strict=True)} == want
    empty = P.different(at, np.zeros(0, np.int64), 2, 4)
    assert [len(x) for x in empty] == [0, 0]
