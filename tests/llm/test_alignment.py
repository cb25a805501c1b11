"""Aligned tokens against every pair of tokens of whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tidemark.llm import alignment as A

SIZES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def encoders():
    with open(A.PATH_A, "rb") as a, open(A.PATH_B, "rb") as b:
        return A.Encoders(a.read(), b.read())


@pytest.fixture(scope="module")
def byte_bpe():
    """A's own library, on the same file."""
    import tokenizers

    own = tokenizers.Tokenizer.from_file(A.PATH_A)
    own.encode_special_tokens = True
    return own


def _tokens(encoders, byte_bpe, text):
    """(id, begin, end) of A and of B over the whole text, not cut."""
    out = []
    a = byte_bpe.encode(" " + text, add_special_tokens=False).ids
    b = encoders.b.encode(text)
    for ids, stands in ((a, encoders.bytes_a), (b, encoders.bytes_b)):
        at, own = 0, []
        for i in ids:
            size = len(stands[i].as_py())
            own.append((i, at, at + size))
            at += size
        if b"".join(stands[i].as_py() for i in ids) != (" " + text).encode():
            return [], []
        out.append(own)
    return out


def _brute(encoders, byte_bpe, rows):
    links, shapes = [], []
    for _, text in rows:
        a, b = _tokens(encoders, byte_bpe, text) if text else ([], [])
        links.append([(x, y) for x, s, e in a for y, t, u in b if s < u and t < e])
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, at = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if at <= s and e <= cut) for side in (a, b)))
            at = cut
        shapes.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    n = Counter(p for own in links for p in set(own))
    best = defaultdict(int)
    for (a, _), k in n.items():
        best[a] = max(best[a], k)
    return [(i, na, nb, g, len(own), sum(n[p] == best[p[0]] for p in own), sum(n[p] for p in own), sha)
            for (i, _), own, (na, nb, g, sha) in zip(rows, links, shapes, strict=True)]


TEXTS = [
    "Hello world, this is a test.", " leading and  double   spaces ", "tabs\tand\nnew\r\nlines \n indented\n\n  more", "trailing   ",
    "▁ already there", "naïve café — 日本語テキスト \U0001f600\U0001f44d🏽 é", "<|endoftext|> <s> </s> <unk> <0x41>", "it's we'll they'd 's",
    "x\x00y \x1c z\x1c a \x85 b\x85 c", "12345 67 8.90", "a　b   c d", "...!!! ??? ,,,", "\n", " ", "   ", "word", "ﬁ ½ Å",
    "supercalifragilistic" * 20, "ein Überraschungsei für die Größe", "​ zero​width", "﻿bom", "end\n"]


def _rows(seed):
    rnd = random.Random(seed)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    words = [w for t in TEXTS for w in t.split(" ")] + ["the", "of", "and"] * 20
    for i in range(150):
        rows.append((1000 + i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60)))))
    return rows + [(1000, rows[-1][1])]


def _got(df):
    return sorted((tuple(r[c] for c in ("doc_id", *SIZES)) for r in df.collect()), key=repr)


def test_against_every_pair(spark, docs_of, encoders, byte_bpe):
    rows = _rows(1)
    assert _got(A.alignment_report(docs_of(rows))) == sorted(_brute(encoders, byte_bpe, rows), key=repr)


def test_small_slices_chunks_and_memory(spark, docs_of, encoders, byte_bpe, monkeypatch):
    monkeypatch.setattr(A, "SLICE_BYTES", 500)
    monkeypatch.setattr(A, "CHUNK_PAIRS", 100)
    monkeypatch.setattr(A, "KNOWN_SEGMENTS", 30)
    rows = _rows(2)
    assert _got(A.alignment_report(docs_of(rows))) == sorted(_brute(encoders, byte_bpe, rows), key=repr)


def test_driver_texts_are_kept_when_cut(spark, encoders, byte_bpe):
    """Ids of the segments, one after another, are the whole text's."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(80).collect()
    for text in [r["text"] for r in rows] + TEXTS:
        a, b = encoders.encode(A.segments_of(text))
        assert sum(a.to_pylist(), []) == byte_bpe.encode(" " + text, add_special_tokens=False).ids
        assert sum(b.to_pylist(), []) == encoders.b.encode(text)


def test_odd_rows(spark, docs_of, odd_rows, encoders, byte_bpe):
    docs = docs_of(odd_rows).selectExpr("*", "'x' AS chunk", "1 AS codes", "2 AS n_a", "3 AS code", "4 AS best")
    short = [(i, t if t is None or len(t) < 1000 else t[:1000]) for i, t in odd_rows]
    assert len(A.alignment_report(docs).collect()) == len(odd_rows)
    assert _got(A.alignment_report(docs_of(short))) == sorted(_brute(encoders, byte_bpe, short), key=repr)
    assert A.alignment_report(docs.limit(0)).count() == 0
