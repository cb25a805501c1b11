"""Near-duplicates against all pairs of shingle sets."""

import random

import numpy as np

from tidemark.llm import near_dup as N
from tidemark.llm.components import connected_components


def _brute(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def _corpus(seed, n=220):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(800)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows, texts = [], []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.3 and texts:
            words = list(rnd.choice(texts))
            for _ in range(rnd.choice([0, 1, 2, 4, 8])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        elif kind < 0.5:
            words = passage + [rnd.choice(vocabulary) for _ in range(rnd.choice([5, 20, 60]))]
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 5, 40, 150]))]
        texts.append(words)
        rows.append((i * 7 % 1000, " ".join(words)))
    return rows


def _got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_against_all_pairs(spark, docs_of):
    rows = _corpus(1)
    assert _got(N.near_duplicates(docs_of(rows), 4)) == _brute(rows, 4, 80)


def test_hot_groups_and_chains(spark, docs_of):
    """A third exact copies, a third near copies of one text, and a chain in
    which only neighbours are similar."""
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, "the very same words of one text all over") for i in range(100)]
    for i in range(100, 200):
        words = list(base)
        words[rnd.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(f"c{j}" for j in range(i * 3, i * 3 + 60))) for i in range(30)]
    assert _got(N.near_duplicates(docs_of(rows), 5)) == _brute(rows, 5, 80)


def test_buckets_of_many_components_are_compared_whole(spark, docs_of, monkeypatch):
    monkeypatch.setattr(N, "ROWS", 1)  # buckets shared by nearly all
    monkeypatch.setattr(N, "BANDS", 160)
    monkeypatch.setattr(N, "BLOCK", 7)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 900)
    rows = _corpus(3, 120)
    assert _got(N.near_duplicates(docs_of(rows), 4)) == _brute(rows, 4, 80)


def test_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows).selectExpr("*", "'x' AS shape", "1 AS class", "2 AS component", "3 AS bands")
    got = N.near_duplicates(docs, 4).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [by[i]["n_shingles"] for i in (1, 2, 3, 4, 5, 6)] == [0, 0, 0, 1, 1, 1]
    assert by[7]["component_id"] == 6 and not by[7]["kept"] and by[6]["kept"]
    assert all(by[i]["component_id"] == i for i in (1, 2, 3, 4, 5, 8))
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None, None]
    assert N.near_duplicates(docs.limit(0), 4).count() == 0


def test_sketches_estimate_high_similarities():
    rnd = np.random.default_rng(0)
    seeds = N.mix(np.arange(1, N.BANDS * N.ROWS + 1, dtype=np.uint64))
    for similarity in (0.8, 0.9):
        errors = []
        for _ in range(60):
            union = rnd.integers(0, 2**63, 1000).astype(np.uint64)
            both = int(1000 * similarity)
            side = (1000 - both) // 2
            a, b = union[: both + side], np.concatenate([union[:both], union[both + side :]])
            x, y = (N.odd_sketch(N.minhash(s, seeds)).view(np.uint64) for s in (a, b))
            bits = int(np.bitwise_count(x ^ y).sum())
            assert bits <= N.differing_bits(similarity)
            k, n = N.BANDS * N.ROWS, N.SKETCH_BITS
            errors.append(1 + n / (4 * k) * np.log(1 - 2 * bits / n) - similarity)
        assert abs(np.mean(errors)) < 0.02


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5), (None, 3), (7, None)]
    edges += [(2000 + rnd.randrange(50), 2000 + rnd.randrange(50)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {i: root(i) for i in parent}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_sketch_filter_misses_no_more_than_the_bands():
    """Exactly: each sample that differs flips two of the bits."""
    import math

    k, n, most = N.BANDS * N.ROWS, N.SKETCH_BITS, N.differing_bits(0.8)
    j = np.arange(n + 1)
    odd = np.zeros(n + 1)  # probability of each number of odd bits
    odd[0] = 1.0
    over = []  # after each number of differing samples, more than ``most``
    for _ in range(k + 1):
        over.append(odd[most + 1 :].sum())
        for _ in range(2):
            new = np.zeros(n + 1)
            new[1:] += odd[:-1] * (n - j[:-1]) / n
            new[:-1] += odd[1:] * j[1:] / n
            odd = new
    for s in (0.8, 0.81, 0.82, 0.85, 0.9):
        miss = sum(math.comb(k, m) * (1 - s) ** m * s ** (k - m) * p for m, p in enumerate(over))
        assert miss <= (1 - s**N.ROWS) ** N.BANDS


def _template(n, changed, seed=5):
    """Copies of one text with some words changed in each."""
    rnd = random.Random(seed)
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = list(base)
        for j in rnd.sample(range(200), changed):
            words[j] = f"x{i}_{j}"
        rows.append((i, " ".join(words)))
    return rows


def test_similar_texts_without_links_give_rows_in_proportion(spark, docs_of, monkeypatch):
    """Nearly all pairs pass the sketches and nearly none is a link: what
    leaves the tasks are classes and forests, not pairs."""
    made = {}
    real = N.materialize

    def counted(df):
        out = real(df)
        made["rows"] = max(made.get("rows", 0), out.count())
        return out

    monkeypatch.setattr(N, "materialize", counted)
    most = []
    for n in (100, 200, 400):
        made.clear()
        rows = _template(n, 5)
        assert _got(N.near_duplicates(docs_of(rows), 4)) == _brute(rows, 4, 80)
        most.append(made["rows"])
    assert most[2] < 2.6 * most[1] < 2.6 * 2.6 * most[0]


def test_one_id_with_two_texts(spark, docs_of):
    """Documents near either text of an id are linked with it, whichever row comes first."""
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a[:-1], "x"])), (3, " ".join([*b[:-1], "x"])), (0, "alone with nobody else here")]
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in N.near_duplicates(docs_of(rows), 4).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False)]


def test_rows_are_sifted_without_python(spark):
    """A worker for the filter would stand beside that of the step after it."""
    ids = spark.createDataFrame([(i,) for i in [*range(0, 2000, 7), -(2**63), None]], "doc_id long")
    rows = spark.createDataFrame([(i, "bits") for i in [*range(3000), -(2**63), None]], "doc_id long, bits string")
    out = N.only_likely(rows, "doc_id", ids.where("doc_id is not null"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == rows.columns and "Python" not in plan and "Arrow" not in plan
    got = [r["doc_id"] for r in out.collect()]
    assert {*range(0, 2000, 7), -(2**63)} <= set(got) and None not in got
    assert len(got) == len(set(got)) < 310  # few others, by chance
    assert N.only_likely(rows, "doc_id", ids.limit(0)).count() == 0
