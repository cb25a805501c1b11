"""The language model: exact base scores, probabilities that sum to one, and
held-out texts that it predicts better than the base."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lm as L


def _tokens(text):
    raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    return [*raw.split(), None]


def _held_out(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2


def _base(rows):
    train = Counter(t for i, text in rows if not _held_out(i) for t in _tokens(text))
    n, v = sum(train.values()), len(train)
    out = {}
    for i, text in rows:
        tokens = _tokens(text)
        out[i] = (_held_out(i), len(tokens), sum(train[t] > 0 for t in tokens), n,
                  sum(math.log10((train[t] + 1) / (n + v + 1)) for t in tokens))
    return out


def _corpus(n=400):
    """Two languages with words of their own, and words that come in pairs."""
    rnd = random.Random(1)
    rows = []
    for i in range(n):
        end = rnd.choice(["ung", "ion"])
        words = []
        for _ in range(rnd.choice([0, 3, 40, 80])):
            words += rnd.choice([["The", "cat"], ["of", "a"], [f"w{rnd.randrange(300)}{end}"], [f"rare{rnd.randrange(10**6)}{end}"]])
        rows.append((i, " ".join(words)))
    return rows


def test_base_figures_and_gain(spark, docs_of, odd_rows):
    rows = _corpus() + [(1000 + i, t) for i, (_, t) in enumerate(odd_rows)]
    docs = docs_of(rows).selectExpr("*", "'x' AS chunk", "1 AS h", "2 AS score")
    got = {r["doc_id"]: r for r in L.lm_report(docs).collect()}
    want = _base(rows)
    assert set(got) == set(want)
    for i, (held, tokens, known, total, base) in want.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] <= 0
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.9 * sum(r["base_score"] for r in held)  # nearer to zero
    again = {r["doc_id"]: r["score"] for r in L.lm_report(docs.repartition(7)).collect()}
    assert again == pytest.approx({i: r["score"] for i, r in got.items()}, rel=1e-6)


def test_probabilities_sum_to_one():
    """Over all known words, the end, and one unseen word of each class."""
    rnd = np.random.default_rng(0)
    weights = L.Weights(np.log(rnd.dirichlet(np.ones(L.CLASSES))))
    weights.last += rnd.normal(size=weights.last.shape)
    weights.pair += rnd.normal(size=weights.pair.shape)
    words = [f"w{i}x{i % 9}".encode() for i in range(500)]
    counts = rnd.integers(1, 50, 500)
    h = L.word_hashes(words)
    common = np.sort(h[np.argsort(-counts)[: L.COMMON]])
    own = L.classes_of(h, L.suffix_bucket(words), common)
    mass, types = (np.bincount(own, x, L.CLASSES) for x in (counts, None))
    model = L.Model(weights, common, mass, types.astype(float), int(counts.sum()) + 7, 7, 501)
    order = np.argsort(h)
    unseen = {}
    for i in range(20_000):
        word = f"unseen{i}".encode()
        unseen.setdefault(int(L.suffix_bucket([word])[0]), word)
    unseen |= {int(L.suffix_bucket([w])[0]): w for w in (b"#%c%c" % (a, b) for a in range(33, 127) for b in range(33, 127))
               if int(L.suffix_bucket([w])[0]) not in unseen}
    assert len(unseen) == L.SUFFIXES
    known = {**dict(zip(h.tolist(), counts.tolist())), **{int(L.word_hashes([w])[0]): 0 for w in unseen.values()}}
    keys = np.array(sorted(known), np.uint64)
    values = np.array([known[int(k)] for k in keys])

    def p(text):
        return 10 ** model.score([text], keys, values)[3][0]

    prefix = b"w1x1 w2x2"
    every = [*words, *unseen.values()]
    # p(prefix, word, end) summed over the end of the text alone needs the next token: use score differences
    full = sum(p(prefix + b" " + w) / _end(model, keys, values, prefix + b" " + w) for w in every) + p(prefix)
    assert full / (p(prefix) / _end(model, keys, values, prefix)) == pytest.approx(1.0, abs=1e-6)
    assert len(order) == 500


def _end(model, keys, values, text):
    """The probability of the end after the text's words."""
    tokens = L.Tokens.of([text])
    h = L.word_hashes(tokens.words)
    own = L.classes_of(h, L.suffix_bucket(tokens.words), model.common)
    context, c = tokens.contexts(own)
    return float(np.exp(model.weights.log_p(context[-1:])[0, c[-1]]))


def test_steps_climb(spark):
    rnd = np.random.default_rng(1)
    cell = rnd.integers(0, 40, 3000) * L.CLASSES * 3 + rnd.integers(0, 6, 3000)
    cell, n = np.unique(cell, return_counts=True)
    cells = spark.createDataFrame([(int(c), int(k)) for c, k in zip(cell, n)], "cell int, n long").repartition(3, "cell")

    def likelihood(w):
        return float((w.log_p(cell // L.CLASSES)[np.arange(len(cell)), cell % L.CLASSES] * n).sum())

    values = [likelihood(L.train(cells, steps)) for steps in (0, 2, 6)]
    assert values[0] < values[1] < values[2]


def test_empty_and_untrained(spark, docs_of):
    docs = docs_of([(i, "a b c") for i in range(40)])
    assert L.lm_report(docs.limit(0), 1).count() == 0
    only = [i for i in range(200) if _held_out(i)][:5]
    rows = L.lm_report(docs_of([(i, "a b") for i in only]), 1).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in rows] == [(0, 0)] * 5
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)


def test_rare_words_are_features(spark, docs_of):
    """After one rare word comes always the same other one, whose ending many have."""
    rnd = random.Random(3)
    follows = [(f"x{i}aa", f"y{rnd.randrange(10**6)}bb") for i in range(300)]
    common = " ".join(f"c{i}" for i in range(L.COMMON))
    assert not _held_out(0) and not _held_out(2)
    rows = [(i, " ".join([common] * 200)) for i in (0, 2)]
    rows += [(i, " ".join(w for _ in range(40) for w in rnd.choice(follows))) for i in range(3, 300)]
    held = [r for r in L.lm_report(docs_of(rows)).collect() if r["held_out"]]
    mean = sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert -1.2 > mean > -1.7  # one of 300 for each pair of words; without the feature one of 300 for each word


def test_word_features_sum_to_one():
    """Over all classes after a context, and over all words of a class."""
    rnd = np.random.default_rng(5)
    C = L.CLASSES
    log_p = np.log(rnd.dirichlet(np.ones(C), C * C)).astype(np.float32)
    key, skip, last = rnd.integers(0, 9, 4000).astype(np.uint32), rnd.integers(0, 3, 4000).astype(np.uint8), np.full(4000, 100, np.uint8)
    other, own = rnd.integers(0, 4, 4000).astype(np.uint16), rnd.integers(0, 20, 4000).astype(np.uint8)
    every = np.arange(C).astype(np.uint8)
    same = [np.append(x, np.full(C, x[0])) for x in (key, skip, last, other)]
    got = L.class_factor(log_p, *same, np.append(own, every), np.append(np.ones(4000, bool), np.zeros(C, bool)))
    assert np.exp(got[4000:]).sum() == pytest.approx(1, abs=1e-5)
    assert np.exp(got[4000:]).argmax() < 20  # the classes that training has

    n = rnd.integers(1, 30, 50)
    mass, types = np.zeros(C), np.zeros(C)
    mass[C - 1], types[C - 1] = n.sum(), 50
    model = L.Model(None, np.zeros(0, np.uint64), mass, types, int(n.sum()), 0, 50)
    seen = rnd.integers(0, 10, 400)
    word = np.concatenate([seen + 1, np.arange(51)]).astype(np.uint32)  # 0: a word never seen
    count = np.append(0, n)[word]
    got = L.word_factor(model, np.zeros(451, np.uint32), np.full(451, C - 1, np.uint8), word, count, np.arange(451) < 400)
    p = np.exp(got[400:])
    assert p.sum() == pytest.approx(1, abs=1e-9) and p[1:11].min() > p[11:].max()


def test_a_step_is_the_same_however_cells_are_cut_into_batches(monkeypatch):
    """Each context is worked out once, not with every batch that has one of its cells."""
    import pyarrow as pa

    rnd = np.random.default_rng(7)
    cell = rnd.permutation(np.unique(rnd.integers(0, 300, 4000) * L.CLASSES * 5 + rnd.integers(0, L.CLASSES, 4000)))
    n = rnd.integers(1, 9, len(cell))
    weights = L.Weights(np.log(rnd.dirichlet(np.ones(L.CLASSES))))
    weights.last += rnd.normal(size=weights.last.shape)
    done, real = [], L.Weights.log_p
    monkeypatch.setattr(L.Weights, "log_p", lambda self, context: done.extend(context.tolist()) or real(self, context))
    monkeypatch.setattr(L, "SLICE_CONTEXTS", 70)
    every = pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(n)], ["cell", "n"])

    def sums(batches):
        return {part: np.frombuffer(blob) for out in L._expected(weights)(iter(batches))
                for part, blob in zip(out.column("part").to_pylist(), out.column("sums").to_pylist(), strict=True)}

    got = sums([every.slice(i, 100) for i in range(0, len(every), 100)])
    assert sorted(done) == np.unique(cell // L.CLASSES).tolist()
    want = sums([every])
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=1e-12) for k in want)
    both = sum(x.reshape(2, L.PART, L.CLASSES).sum(axis=(1, 2)) for x in got.values())
    assert both == pytest.approx([3 * n.sum()] * 2)  # three features of each context; as many expected as seen
    assert sums([]) == {}


def test_rows_of_groups_add_up():
    rnd = np.random.default_rng(8)
    size = np.concatenate([rnd.integers(1, 5, 50), [L.FEW_ROWS, L.FEW_ROWS + 1, 100, 1]])
    first = np.cumsum(size) - size
    x = rnd.random((int(size.sum()), 7)).astype(np.float32)
    assert np.array_equal(L.sums_of_rows(first, size)(x), np.add.reduceat(x, first, axis=0))
    assert np.array_equal(L.sums_of_rows(first[:1], size[:1])(x[: size[0]]), np.add.reduceat(x[: size[0]], [0], axis=0))


def test_steps_leave_the_disk_once_they_are_read(spark, docs_of, monkeypatch):
    """What was written until the chunks are counted is gone when blocks are trained, and so are all shuffles of the training."""
    from pathlib import Path

    from tidemark.llm import common

    folders, real = [], common.step_folder
    monkeypatch.setattr(common, "step_folder", lambda s: folders.append(real(s)) or folders[-1])
    monkeypatch.setattr(L, "step_folder", common.step_folder)
    seen, train = [], L.train

    def watched(cells, steps):
        seen.append([Path(x.removeprefix("file:")).exists() for x in folders])
        assert spark.conf.get(common.TIDY, "false") == "false"
        return train(cells, steps)

    monkeypatch.setattr(L, "train", watched)
    report = L.lm_report(docs_of([(i, f"a b c{i} d") for i in range(60)]), 1)
    assert seen == [[False, False, False, True, True]]  # left: the counted chunks, and the cells
    assert report.count() == 60


def test_words_are_few_rows(spark, docs_of):
    """A chunk's words leave a task as one row for each part of all hashes, whatever their
    number; their totals, the commonest ones and the sums of the rest are exact."""
    import pyarrow as pa

    rnd = random.Random(9)
    texts = [[" ".join(f"w{int(rnd.paretovariate(0.5)) % 5000}{c}" for _ in range(900)) for c in "ab\u00e9"] for _ in range(5)] + [["", None]]
    held = [[rnd.random() < 0.3 for _ in x] for x in texts]
    tables = [pa.table({"doc_id": list(range(len(x))), "held_out": y, "text": [(t or "").encode() for t in x]}) for x, y in zip(texts, held)]
    out = [L._words((pa.scalar(i, pa.int32()),), t, 3) for i, t in enumerate(tables)]
    assert [len(t) for t in out] == [4] * 5 + [1]
    whole = pa.concat_tables(out).to_pandas()
    found = [L._totals((pa.scalar(p, pa.int32()),), pa.Table.from_pandas(x.drop(columns="tokens"), schema=out[0].drop_columns("tokens").schema, preserve_index=False))
             for p, x in whole[whole.h.notna()].groupby("part")]
    want = Counter(w for x, y in zip(texts, held) for t, no in zip(x, y) if not no for w in (t or "").encode().split())
    every = {w for x in texts for t in x for w in (t or "").encode().split()}
    n_of = dict(zip(L.word_hashes(sorted(every)).tolist(), (want[w] for w in sorted(every))))
    got, mass, types, top = {}, Counter(), Counter(), []
    for t in found:
        for r in t.to_pylist():
            if r["chunk"] is None:
                top += [(-x["n"], x["h"]) for x in r["top"]]
                mass.update({x["bucket"]: x["n"] for x in r["mass"]})
                types.update({x["bucket"]: x["types"] for x in r["mass"]})
            else:
                h = np.frombuffer(r["h"], np.uint64)
                assert (np.diff(h) > 0).all() and len(r["bucket"]) == len(h)
                got |= dict(zip(h.tolist(), L._counts(r["n"], len(h)).tolist()))
    assert got == n_of and sum(mass.values()) == sum(want.values()) and sum(types.values()) == len(want)
    by_count = sorted((-n, int(np.uint64(h).view(np.int64))) for h, n in n_of.items() if n)
    assert sorted(top)[: L.COMMON] == by_count[: L.COMMON]
    ends = sorted(every) + [b"x", b"\xff", b"\x00"]
    import xxhash
    assert L.suffix_bucket(ends).tolist() == [xxhash.xxh32_intdigest(w[-2:]) % L.SUFFIXES for w in ends]


def test_places_and_keys():
    """Places in as few bytes as they need; keys split by the other word only if they have many tokens."""
    rnd = np.random.default_rng(4)
    for most, digits in ((0, 1), (254, 1), (255, 2), (70_000, 3)):
        at = np.append(rnd.integers(-1, most + 1, 500), most).astype(np.int32)
        packed = L._packed(at)
        assert packed.shape == (digits, 501) and np.array_equal(L._unpacked(packed), at)
    assert L._unpacked(L._packed(np.full(3, -1, np.int32))).tolist() == [-1] * 3
    of, other = (rnd.integers(0, 2**63, 400).astype(np.uint64) for _ in range(2))
    n = rnd.choice([0, 1, L.HOT - 1, L.HOT, 5 * L.HOT], 400)
    part = other % (1 + n // L.HOT).astype(np.uint64)
    asked = []
    got = L._key(of, n, lambda i: asked.extend(i.tolist()) or other[i])
    assert np.array_equal(got, L.mix(of ^ L.mix(part + np.uint64(1)))) and (n[asked] >= L.HOT).all()
