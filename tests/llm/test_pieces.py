"""Sampled segmentations: round trips, and the distribution against an
enumeration of all segmentations."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces as P


@pytest.fixture(scope="module")
def model():
    return P.load()


def _one(model, text, key=0):
    ids, begins = P.sample(model[0], [text], P.row_keys([key], 0))
    assert begins.tolist() == [0, len(ids)]
    return ids.tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60), st.integers(0, 2**62))
def test_round_trip(model, text, key):
    assert P.decode_ids(_one(model, text, key), model[1]) == text


@pytest.mark.parametrize("text", ["", " ", "▁", "▁▁ ▁", "\n\n a\n", "\r\n;\r", "x" * 3_000, "日本語" * 500, "a  b   c", "\x00\U0001f600"])
def test_round_trip_of_odd_texts(model, text):
    assert P.decode_ids(_one(model, text), model[1]) == text


def _all_segmentations(model, text):
    """Every piece sequence of a word with its weight, by plain recursion."""
    v = model[0]
    known = {p: i for i, p in enumerate(v.pieces) if p}

    def rest(at):
        if at == len(text):
            yield (), 1.0
        for end in range(at + 1, min(len(text), at + v.longest) + 1):
            piece = text[at:end]
            if piece in known:
                head, w = (known[piece],), v.weight[known[piece]]
            elif end == at + 1:
                raw = piece.encode()
                head, w = tuple(int(v.byte_ids[b]) for b in raw), v.byte_weight ** len(raw)
            else:
                continue
            for tail, wt in rest(end):
                yield head + tail, w * wt

    return dict(rest(0))


@pytest.mark.parametrize("word", ["the", "token", "naïve"])
def test_draws_follow_the_lattice(word):
    model = P.load(alpha=0.0001)
    want = _all_segmentations(model, "▁" + word)
    total = sum(want.values())
    n = 20_000
    ids, begins = P.sample(model[0], [word] * n, P.row_keys(list(range(n)), 0))
    got = Counter(tuple(ids[a:b].tolist()) for a, b in itertools.pairwise(begins))
    assert set(got) <= set(want)
    for segmentation, weight in want.items():
        p = weight / total
        assert abs(got[segmentation] / n - p) <= 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_draws_hang_on_the_row_alone(model):
    texts = ["some words to cut", "other words", "some words to cut", ""]
    together, begins = P.sample(model[0], texts, P.row_keys([5, 6, 7, 8], 0))
    for i, key in enumerate((5, 6, 7, 8)):
        assert together[begins[i] : begins[i + 1]].tolist() == _one(model, texts[i], key)
    many = {tuple(_one(model, texts[0], k)) for k in range(50)}
    assert len(many) > 5  # other keys, other segmentations


def test_long_segments_are_as_probable_as_short_ones(model):
    """Widths that share arrays give the same lattice as their own width."""
    word = "▁" + "internationalisation" * 2
    own = P.code_points([word], len(word))
    wide = P.code_points([word], len(word) + 9)
    (a, ca), (b, cb) = model[0].lattices(own), model[0].lattices(wide)
    n = len(word)
    assert (a == b[:, :n]).all() and np.allclose(ca, cb[:, :n])


def test_frames(spark, docs_of, odd_rows, model):
    docs = docs_of(odd_rows).selectExpr("*", "'mine' AS piece_ids", "'x' AS ids", "1 AS decoded")
    coded = P.encode(docs)
    back = P.decode(coded).collect()
    assert len(back) == len(odd_rows)
    for r in back:
        assert r["decoded"] == r["text"]
        assert (r["piece_ids"] is None) == (r["text"] is None)
    report = P.pieces_report(docs_of(odd_rows)).collect()
    assert sorted(map(str, ((r["doc_id"], r["piece_ids"]) for r in report))) == sorted(
        map(str, ((r["doc_id"], r["piece_ids"]) for r in back)))
    assert all(r["lossless"] for r in report) and len(report) == len(odd_rows)
    again = {(r["doc_id"], r["n_pieces"], tuple(r["piece_ids"] or ())) for r in P.pieces_report(docs_of(odd_rows).repartition(5)).collect()}
    assert again == {(r["doc_id"], r["n_pieces"], tuple(r["piece_ids"] or ())) for r in report}
    assert P.encode(docs.limit(0)).count() == 0
