"""SimHash links against all pairs of fingerprints."""

import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash as S


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(values):
    """The smallest doc_id reachable, for (doc_id, fingerprint) pairs."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, x) in enumerate(values):
        for j in range(i):
            if (x ^ values[j][1]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(values):
        least[root(i)] = min(d, least.get(root(i), d))
    return [least[root(i)] for i in range(len(values))]


def _corpus(seed, n=250):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(n):
        if rnd.random() < 0.4 and texts:
            words = list(rnd.choice(texts))
            for _ in range(rnd.choice([0, 1, 1, 2, 5])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 4, 30, 200, 400]))]
        texts.append(words)
    return [(i * 7 % 1000, " ".join(w)) for i, w in enumerate(texts)]


def test_texts_against_all_pairs(spark, docs_of):
    rows = _corpus(1)
    values = [(i, _fingerprint(t)) for i, t in rows]
    want = {i: (f"{v:016x}", c) for (i, v), c in zip(values, _components(values), strict=True)}
    assert len({c for _, c in want.values()}) < len(want)
    got = S.near_duplicates(docs_of(rows)).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def _planted(seed, n=400, biased=False):
    """Fingerprints with chains of near ones; ``biased``: few values in 40 of the bits."""
    rnd = random.Random(seed)
    few = [rnd.getrandbits(40) for _ in range(3)]
    out = set()
    while len(out) < n:
        if out and rnd.random() < 0.6:
            x = rnd.choice(sorted(out))
            for b in rnd.sample(range(64), rnd.choice([1, 3, 4, 5, 6])):
                x ^= 1 << b
        else:
            x = rnd.getrandbits(64) if not biased else rnd.choice(few) << 24 | rnd.getrandbits(24)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("layout", S.LAYOUTS)
@pytest.mark.parametrize("biased", [False, True])
def test_every_layout_finds_every_link(spark, monkeypatch, layout, biased):
    monkeypatch.setattr(S, "LAYOUTS", (layout,))
    _check_join(spark, _planted(2, 250, biased))


def test_values_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 5)
    monkeypatch.setattr(S, "PAIRS_AT_ONCE", 37)
    _check_join(spark, _planted(3, 300, True))


def _check_join(spark, values):
    nodes = spark.createDataFrame([(_signed(v),) for v in values], "f long").repartition(3)
    labels = {r["f"] % 2**64: r["component"] for r in S.join_components(nodes).collect()}
    groups = {}
    for v, c in zip(values, _components([(i, v) for i, v in enumerate(values)]), strict=True):
        groups.setdefault(c, set()).add(v)
    want = {frozenset(g) for g in groups.values()}
    got = {}
    for v in values:
        got.setdefault(labels.get(v, _signed(v)), set()).add(v)
    assert {frozenset(g) for g in got.values()} == want


def test_thresholds_keep_the_principle_and_cost_least():
    rnd = np.random.default_rng(0)
    values = rnd.integers(0, 2**63, 300).astype(np.uint64)
    groups = np.arange(64).reshape(4, 16)
    own = S.group_values(values, groups)
    near = np.stack([S.at_distance(np.bincount(own[:, g], minlength=65536)) for g in range(4)])
    brute = [int((np.bitwise_count((own[:, 0] ^ own[7, 0]).astype(np.uint64)) == t).sum()) for t in range(5)]
    assert near[0][:, own[7, 0]].tolist() == brute
    plan = S.Plan(groups, near, len(values))
    for layout in S.LAYOUTS:
        chosen, cost = plan.thresholds(own[:20], layout)
        assert (chosen.sum(axis=1) == S.NEAR - len(layout) + 1).all() and chosen.min() >= -1
        parts = plan.partitions(layout)
        price = [np.concatenate([np.zeros((20, 1)), plan.candidates(own[:20], p) + S.PROBE_COST * np.cumsum(
            [S.comb(16 * len(p), t) for t in range(5)])], axis=1) for p in parts]
        least = np.full(20, np.inf)
        for pick in np.ndindex(*[6] * len(parts)):
            if sum(pick) == S.NEAR + 1:
                least = np.minimum(least, sum(x[:, u] for x, u in zip(price, pick, strict=True)))
        assert np.allclose(cost, least)


def test_correlated_bits_share_a_group():
    rnd = np.random.default_rng(1)
    half = rnd.integers(0, 2, (4000, 32))
    bits = np.concatenate([half, half], axis=1)  # bit b and bit b + 32 are equal
    groups = S.group_bits(bits.T @ bits, len(bits))
    assert sorted(groups.ravel().tolist()) == list(range(64))
    assert all({b % 32 for b in g} == {b % 32 for b in g if b < 32} for g in groups.tolist())


def test_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows).selectExpr("*", "1 AS f", "2 AS node", "3 AS component", "4 AS first")
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [by[i]["fingerprint"] for i in (1, 2, 3)] == ["0" * 16] * 3
    assert {by[i]["component_id"] for i in (1, 2, 3)} == {1}
    assert by[7]["component_id"] == 6 and by[4]["fingerprint"] == f"{_fingerprint('word word word word'):016x}"
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None, None]
    assert S.near_duplicates(docs.limit(0)).count() == 0
