"""Language-model scores from a hashed maximum-entropy model.

p(token | the two before it) = p(class | context) * p(token | class, context).
A class is one of the commonest words, the end of a text, or a bucket of all
other words (the rare ones) by a hash of their last two bytes. Both factors are
log-linear (maximum-entropy) models, trained by steps along the gradient.

The class factor has two layers of features. The first holds classes: the last
token's, that of the one before it (skip feature), and both together, hashed
into ``HASHED`` rows. The second holds words, as many as the corpus has: a rare
last word alone (bigram) and with the word before it (trigram); after a common
last word a rare word before it alone (skip) and with the last one (trigram).
Where both are common the first layer has the words themselves. The word factor
has the words' own features, whose solution is their relative frequency, less
``DISCOUNT`` for words never seen, and the pair of the last word and the word.

Training: texts are cut into words once, a chunk of them in a task. A chunk
brings along the counts of just the words that it has. First the corpus is
counted into (context, class) cells, dealt over shards; each step computes every
shard's expected counts under the current weights, sums them in Spark, and moves
the weights along the gradient, scaled by each feature's count. Then every token
goes to the block of its key, a hash of the word (or words) whose features it
has. No other block has these features, so a block is trained and scored in one
task; blocks have bounded sizes and their number grows with the corpus. Words
with very many tokens are split by the other word of the context. Nothing that
grows with the vocabulary is sent to every task or to the driver.
"""

from __future__ import annotations

import pickle
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, materialize, mix, received, remove, send, step_folder, tidied, utf8, word_hashes

COMMON, SUFFIXES = 95, 32  # common words and suffix buckets; with the end of text 128 classes
CLASSES = 1 + COMMON + SUFFIXES
HASHED = 2048  # rows for hashed pairs of classes
STEPS, SHARDS = 12, 8
ACTIVE = 4  # features of each context: always, last, skip, pair
DISCOUNT = 0.5
CHUNK_BYTES = 8_000_000
BLOCK_TOKENS = 400_000  # trained and scored in one task, on average
HOT = 16_384  # tokens of a word, on average, before its features are split by the other word
WORD_STEPS, PRIOR = 4, 1.0  # of the words' features: steps, and how strongly they are drawn to zero
SLICE_TOKENS = 100_000  # dealt to blocks at once
SLICE_CONTEXTS = 4096  # trained at once
ROWS_A_FILE = 4  # of chunks' tokens
FEW_ROWS = 8  # of a group, added to those of all others at once; numpy adds more of them in pairs
ROWS_TURNED = 128  # at once, while they are in the processor's cache
PASSES = 3  # over the corpus, each with the events of every third block, for less on the disk at once
PART = 64  # features whose sums stand together
END = 0
WHOLE = mix(np.ones(1, np.uint64))  # in the key of a word that isn't split


def suffix_bucket(words: list[bytes]) -> np.ndarray:
    """A hash of the last two bytes of each word, worked out once for all words that end alike."""
    if not words:
        return np.zeros(0, np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat, last = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - 1
    ending = flat[last].astype(np.int64)
    two = size > 1
    ending[two] += 256 + 256 * flat[last[two] - 1].astype(np.int64)
    bucket = np.zeros(257 * 256, np.int64)
    for x in np.nonzero(np.bincount(ending))[0].tolist():
        own = bytes([x // 256 - 1, x % 256]) if x >= 256 else bytes([x])
        bucket[x] = xxhash.xxh32_intdigest(own) % SUFFIXES
    return bucket[ending]


@dataclass
class Tokens:
    """The tokens of several texts in a row: places of distinct words, and
    -1 for the end of each text."""

    words: list[bytes]
    at: np.ndarray
    begins: np.ndarray  # of each text, and the number of tokens at the end

    @classmethod
    def of(cls, texts: list[bytes]) -> Tokens:
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__  # a new word's place
        flat, n = array("i"), np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = len(flat)
            flat.extend(map(index.__getitem__, text.lower().split()))
            n[i] = len(flat) - before
        words = list(index)
        begins = np.concatenate([[0], np.cumsum(n + 1)])
        at = np.full(int(begins[-1]), -1, np.int32)
        inside = np.ones(len(at), bool)
        inside[begins[1:] - 1] = False
        at[inside] = np.array(flat, np.int32)
        return cls(words, at, begins)

    def contexts(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(context, class) of each token; before a text stands the end of another."""
        own = np.where(self.at < 0, END, classes[self.at] if len(classes) else END)
        last = np.concatenate([[END], own[:-1]])
        skip = np.concatenate([[END, END], own[:-2]]) if len(own) > 1 else np.zeros_like(own)
        first = self.begins[:-1]
        last[first] = END
        skip[first] = END
        second = first + 1
        skip[second[second < len(own)]] = END
        return skip * CLASSES + last, own


def classes_of(hashes: np.ndarray, buckets: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Class of each word; ``common``: sorted hashes of the common words."""
    if not len(common):
        return 1 + COMMON + buckets
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    return np.where(common[at] == hashes, 1 + at, 1 + COMMON + buckets)


def smallest(x: np.ndarray) -> np.ndarray:
    """Counts in the narrowest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _counts(blob: bytes, size: int) -> np.ndarray:
    """``size`` counts that :func:`smallest` made narrow."""
    return np.frombuffer(blob, f"<u{len(blob) // size}").astype(np.int64)


def _packed(at: np.ndarray) -> np.ndarray:
    """Places from -1 on, a row of bytes for each digit that the largest needs."""
    digits = max(1, -(-int(at.max(initial=0) + 1).bit_length() // 8))
    return np.ascontiguousarray((at + 1).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :digits].T)


def _unpacked(digits: np.ndarray) -> np.ndarray:
    out = np.full(digits.shape[1], -1, np.int32)
    for i, x in enumerate(digits):
        out += x.astype(np.int32) << (8 * i)
    return out


def _words(key: tuple, rows: pa.Table, parts: int) -> pa.Table:
    """A chunk's distinct words, sorted by hash, and how often training texts
    have them: a row for each of the ``parts`` of all hashes. Beside them, in
    one row, its tokens as places among these words."""
    pa.default_memory_pool().release_unused()  # what the last chunk left
    chunk = key[0].as_py()
    held = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
    tokens = Tokens.of([t.as_py() for t in rows.column("text")])
    of_text = np.repeat(~held, np.diff(tokens.begins))
    n = np.bincount(tokens.at[of_text & (tokens.at >= 0)], minlength=len(tokens.words))
    h = word_hashes(tokens.words)
    order = np.argsort(h, kind="stable")
    place = np.empty(len(h) + 1, np.int32)
    place[order], place[-1] = np.arange(len(h)), -1
    blob = pickle.dumps((rows.column("doc_id").combine_chunks(), held, tokens.begins, _packed(place[tokens.at])))
    h, n, bucket = h[order], n[order], suffix_bucket(tokens.words)[order].astype(np.uint8)
    part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # each a range of hashes
    begin = begins_of(part)
    own = [slice(*x) for x in zip(begin.tolist(), [*begin[1:].tolist(), len(h)], strict=True)] if len(h) else []
    return pa.table({
        "chunk": pa.array([chunk] * (len(own) + 1), pa.int32()),
        "part": pa.array([*part[begin].tolist(), None], pa.int32()),
        "h": pa.array([*(h[x].tobytes() for x in own), None], pa.binary()),
        "n": pa.array([*(smallest(n[x]).tobytes() for x in own), None], pa.binary()),
        "bucket": pa.array([*(bucket[x].tobytes() for x in own), None], pa.binary()),
        "tokens": pa.array([*[None] * len(own), blob], pa.binary())})


WORDS = "chunk int, part int, h binary, n binary, bucket binary"
#: Of a part's words in training texts: the commonest, and each suffix bucket's sum of counts and number of words.
FACTS = "top array<struct<h:long,n:long,bucket:int>>, mass array<struct<bucket:int,n:long,types:long>>"


def _totals(key: tuple, rows: pa.Table) -> pa.Table:
    """A part's words in each chunk with their totals over all chunks; beside them, in one row, the part's facts."""
    pa.default_memory_pool().release_unused()
    own = [np.frombuffer(x.as_py(), np.uint64) for x in rows.column("h")]
    ends = np.cumsum([len(x) for x in own])
    h = np.concatenate(own)
    n = np.concatenate([_counts(x.as_py(), len(y)) for x, y in zip(rows.column("n"), own, strict=True)])
    bucket = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in rows.column("bucket")])
    order = np.argsort(h, kind="stable")
    begin = begins_of(h[order])
    count = np.add.reduceat(n[order], begin)
    total = np.empty(len(h), np.int64)
    total[order] = np.repeat(count, np.diff(np.append(begin, len(h))))
    blobs = [smallest(x).tobytes() for x in np.split(total, ends[:-1])]

    known = np.nonzero(count)[0]
    first, count = order[begin[known]], count[known]
    name = h[first].view(np.int64)
    top = np.nonzero(count >= (np.partition(count, -COMMON)[-COMMON] if len(count) > COMMON else 0))[0]
    top = top[np.lexsort((name[top], -count[top]))[:COMMON]]
    mass, types = np.zeros(SUFFIXES, np.int64), np.bincount(bucket[first], minlength=SUFFIXES)
    np.add.at(mass, bucket[first], count)
    facts = ([{"h": int(name[i]), "n": int(count[i]), "bucket": int(bucket[first[i]])} for i in top],
             [{"bucket": i, "n": int(mass[i]), "types": int(types[i])} for i in np.nonzero(types)[0].tolist()])
    types = [pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64()), ("bucket", pa.int32())])),
             pa.list_(pa.struct([("bucket", pa.int32()), ("n", pa.int64()), ("types", pa.int64())]))]
    with_none = lambda c: pa.array([*(x.as_py() for x in rows.column(c)), None], rows.schema.field(c).type)
    return pa.table({
        "chunk": with_none("chunk"), "part": pa.array([key[0].as_py()] * (len(own) + 1), pa.int32()), "h": with_none("h"),
        "n": pa.array([*blobs, None], pa.binary()), "bucket": with_none("bucket"),
        **{c: pa.array([*[None] * len(own), x], t) for c, x, t in zip(("top", "mass"), facts, types, strict=True)}})


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks' cells, summed."""
    total = np.zeros(CLASSES**3, np.int64)
    for batch in batches:
        for blob in batch.column("cells"):
            cell, n = pickle.loads(blob.as_py())
            total[cell] += n
    cell = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[cell])], ["cell", "n"])


def pair_row(context: np.ndarray) -> np.ndarray:
    return (mix(context.astype(np.uint64)) % np.uint64(HASHED)).astype(np.int64)


class Weights:
    def __init__(self, prior: np.ndarray):
        self.always = prior
        self.last, self.skip = np.zeros((CLASSES, CLASSES)), np.zeros((CLASSES, CLASSES))
        self.pair = np.zeros((HASHED, CLASSES))

    def log_p(self, context: np.ndarray) -> np.ndarray:
        """Log probabilities of all classes (columns) in contexts (rows)."""
        x = self.always + self.last[context % CLASSES] + self.skip[context // CLASSES] + self.pair[pair_row(context)]
        x -= x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))

    def step(self, seen: np.ndarray, expected: np.ndarray) -> None:
        """Along the gradient (seen - expected), each weight by its own scale."""
        move = 2 * (seen - expected) / (ACTIVE * np.maximum(seen, expected) + 1)
        a, b = CLASSES, 2 * CLASSES
        self.last += move[:a]
        self.skip += move[a:b]
        self.pair += move[b:]


def _expected(weights: Weights):
    """Seen and expected counts of every feature that a shard's cells have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)  # at most CLASSES**3 cells; each context is worked out once, not with every batch that has it
        if rows:
            cell, n = (np.concatenate([batch.column(c).to_numpy() for batch in rows]) for c in ("cell", "n"))
            seen, want = (np.zeros((2 * CLASSES + HASHED, CLASSES)) for _ in range(2))
            context, at = np.unique(cell // CLASSES, return_inverse=True)
            for begin in range(0, len(context), SLICE_CONTEXTS):
                own = context[begin : begin + SLICE_CONTEXTS]
                mine = (at >= begin) & (at < begin + SLICE_CONTEXTS)
                here = np.zeros((len(own), CLASSES))
                here[at[mine] - begin, cell[mine] % CLASSES] = n[mine]  # a cell comes once
                p = np.exp(weights.log_p(own)) * here.sum(axis=1, keepdims=True)
                for to in (own % CLASSES, CLASSES + own // CLASSES, 2 * CLASSES + pair_row(own)):
                    np.add.at(seen, to, here)
                    np.add.at(want, to, p)
            for part in np.unique(np.nonzero(want.any(axis=1))[0] // PART).tolist():
                own = slice(part * PART, part * PART + PART)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([np.stack([seen[own], want[own]]).tobytes()])], ["part", "sums"])

    return run


def _summed(key: tuple, rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py()) for x in rows.column("sums"))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()])})


def train(cells: DataFrame, steps: int = STEPS) -> Weights:
    """``cells``: ``cell`` (context and class), ``n``; at most CLASSES**3 rows."""
    by_class = cells.groupBy((F.col("cell") % CLASSES).alias("c")).agg(F.sum("n").alias("n")).collect()
    n = np.zeros(CLASSES)
    for row in by_class:
        n[row["c"]] = row["n"]
    weights = Weights(np.log((n + 1) / (n.sum() + CLASSES)))
    for _ in range(steps):
        sent = send(cells.sparkSession, weights)
        with tidied(cells.sparkSession):
            sums = (cells.mapInArrow(lambda batches, sent=sent: _expected(received(sent))(batches), "part int, sums binary")
                    .groupBy("part").applyInArrow(_summed, "part int, sums binary").toArrow())
        sent.destroy()
        seen, want = (np.zeros((2 * CLASSES + HASHED, CLASSES)) for _ in range(2))
        for part, blob in zip(sums.column("part").to_pylist(), sums.column("sums").to_pylist(), strict=True):
            seen[part * PART : part * PART + PART], want[part * PART : part * PART + PART] = np.frombuffer(blob).reshape(2, PART, CLASSES)
        weights.step(seen, want)
    return weights


@dataclass
class Model:
    weights: Weights
    common: np.ndarray  # sorted hashes of the common words
    mass: np.ndarray  # training tokens of each class
    types: np.ndarray  # different words of each class
    tokens: int
    ends: int
    distinct: int

    def base(self, tokens: Tokens, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known tokens, base score. ``n``: counts of the words."""
        count = np.append(n, self.ends)
        base = np.log10((count + 1) / (self.tokens + self.distinct + 1))
        begin = tokens.begins[:-1]
        add = lambda x: np.add.reduceat(x, begin) if len(begin) else x[:0]
        return np.diff(tokens.begins), add((count[tokens.at] > 0).astype(np.int64)), add(base[tokens.at])

    def in_class(self, own: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Relative frequency within its class of a word that training texts have ``n`` times."""
        mass, new = self.mass[own], DISCOUNT * self.types[own]
        rare = np.where(mass > 0, np.where(n > 0, n - DISCOUNT, new) / np.maximum(mass, 1), 1.0)
        return np.where(own > COMMON, rare, 1.0)

    def score(self, texts: list[bytes], hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known tokens, base score, and the score from
        classes and words' own features alone. ``hashes`` (sorted) and
        ``counts``: of the words that the texts have."""
        tokens = Tokens.of(texts)
        h = word_hashes(tokens.words)
        n = counts[np.searchsorted(hashes, h)] if len(h) else np.zeros(0, np.int64)
        own = classes_of(h, suffix_bucket(tokens.words), self.common)
        word = np.append(np.log(self.in_class(own, n)), 0.0)  # the last, at -1: the end
        context, c = tokens.contexts(own)
        there, at = np.unique(context, return_inverse=True)
        full = (self.weights.log_p(there)[at, c] + word[tokens.at]) / np.log(10)
        begin = tokens.begins[:-1]
        return *self.base(tokens, n), np.add.reduceat(full, begin) if len(begin) else full[:0]


def _key(of: np.ndarray, n: np.ndarray, other: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Hashes of keys, those with many tokens (``n``) split by the other word (``other`` gives its hash at some rows)."""
    key = mix(of ^ WHOLE)
    hot = np.nonzero(n >= HOT)[0]
    if len(hot):
        part = other(hot) % (1 + n[hot] // HOT).astype(np.uint64)
        key[hot] = mix(of[hot] ^ mix(part + np.uint64(1)))
    return key


def _counted(model: Model, docs: pa.Table, words: pa.Table) -> pa.Table:
    """A chunk's tokens with its words' counts and classes, its (context, class)
    cells in training texts, and what is known of its texts before training."""
    pa.default_memory_pool().release_unused()
    words = words.sort_by("part")  # and so by hash
    parts = [np.frombuffer(x.as_py(), np.uint64) for x in words.column("h")]
    counts = [_counts(x.as_py(), len(y)) for x, y in zip(words.column("n"), parts, strict=True)]
    buckets = [np.frombuffer(x.as_py(), np.uint8).astype(np.int64) for x in words.column("bucket")]
    h, n, bucket = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((parts, np.uint64), (counts, np.int64), (buckets, np.int64)))
    own = classes_of(h, bucket, model.common)
    doc_id, held, begins, digits = pickle.loads(docs.column("tokens")[0].as_py())
    at = _unpacked(digits)
    tokens = Tokens([], at, begins)
    base = model.base(tokens, n)
    context, c = tokens.contexts(own.astype(np.int32))
    text = np.repeat(np.arange(len(held), dtype=np.int32), np.diff(begins))
    plain = (context % CLASSES <= COMMON) & (context // CLASSES <= COMMON)
    cell = (context * CLASSES + c).astype(np.int32)
    del context, c
    seen, times = np.unique(cell[~held[text]], return_counts=True)
    known = pickle.dumps((doc_id, held, *base, smallest(text[plain]), cell[plain]))
    blob = pickle.dumps((held, begins, digits, h, smallest(n), own.astype(np.uint8)))
    return pa.table({"chunk": docs.column("chunk"), "tokens": pa.array([blob], pa.binary()),
                     "cells": pa.array([pickle.dumps((seen, times))], pa.binary()), "known": pa.array([known], pa.binary())})


#: What an event of a block has: 32 bits of its key; the class before the last and the last; 16 bits of the word
#: before the last; its own class; in training; the distance to the last event's text. Behind them stand, for events
#: with a word factor, 32 bits of the word, and the bytes of its count.
FIELDS = ("key", "skip", "last", "other", "own", "train", "text", "word", "n")


def _events(model: Model, wanted: range, blocks: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks' events for the ``wanted`` of all blocks: those of the class factor, and those
    of words after a common last word, which have a word factor only."""
    for batch in batches:
        for i in range(len(batch)):
            chunk = batch.column("chunk")[i].as_py()
            yield from _events_of(model, wanted, blocks, chunk, *pickle.loads(batch.column("tokens")[i].as_py()))


def _events_of(model: Model, wanted: range, blocks: int, chunk: int, held, begins, digits, h, n, own) -> Iterator[pa.RecordBatch]:
    at, n = _unpacked(digits), n.astype(np.int64)
    context, c = Tokens([], at, begins).contexts(own.astype(np.int32))
    skip, last, c = (context // CLASSES).astype(np.uint8), (context % CLASSES).astype(np.uint8), c.astype(np.uint8)
    del context
    text = np.repeat(np.arange(len(held), dtype=np.int32), np.diff(begins))
    h, n = np.append(h, np.uint64(0)), np.append(n, model.ends)  # the last, at -1: the end
    before = [np.concatenate([np.full(min(back, len(c)), -1, np.int32), at[: max(0, len(c) - back)]]) for back in (1, 2)]
    before[0][begins[:-1]] = before[1][begins[:-1]] = -1
    second = begins[:-1] + 1
    before[1][second[second < len(c)]] = -1
    w1, w2 = before
    rare = last > COMMON
    low, high = (h & np.uint64(0xFFFF)).astype(np.uint16), np.where(n > 0, h >> np.uint64(32), 0).astype(np.uint32)
    bytes_of_n = np.ascontiguousarray(n.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    most = int(n.max()).bit_length()

    def keys_of(place: np.ndarray) -> np.ndarray:
        """Keys of the class factor's events."""
        after_rare = rare[place]
        by = np.where(after_rare, w1[place], w2[place])
        return _key(h[by] ^ after_rare.astype(np.uint64), n[by], lambda i: h[np.where(after_rare[i], w2[place[i]], w1[place[i]])])

    def pair_keys_of(place: np.ndarray) -> np.ndarray:
        """Keys of words after a common one: that and their class."""
        pair = last[place].astype(np.uint64) * np.uint64(CLASSES) + c[place]
        expected = n[w1[place]] * (model.mass[c[place]] / max(model.tokens, 1))
        return _key(pair + np.uint64(2), expected.astype(np.int64), lambda i: h[w2[place[i]]])

    ends = []
    for has, of in ((rare | (skip > COMMON), keys_of), (~rare & (c > COMMON), pair_keys_of)):
        found = []
        for begin in range(0, len(c), SLICE_TOKENS):
            place = (begin + np.nonzero(has[begin : begin + SLICE_TOKENS])[0]).astype(np.int32)
            key = of(place)
            block = (key % np.uint64(blocks)).astype(np.int32)
            now = block % wanted.step == wanted.start
            found.append((place[now], (key[now] >> np.uint64(32)).astype(np.uint32), block[now]))
        place, key, block = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(smallest(block), kind="stable")  # two bytes are sorted by their digits
        ends.append((np.searchsorted(block[order], np.arange(blocks + 1)), place[order], key[order]))
    for b in wanted:
        blob = []
        for part, (end, place, keys) in enumerate(ends):
            there, key = place[end[b] : end[b + 1]], keys[end[b] : end[b + 1]]
            # nothing but the word factor is read of an event without the other one
            only = np.zeros_like if part else np.asarray
            target = at[there[(c[there] > COMMON) & (rare[there] | bool(part))]]
            counts = np.zeros((8, len(target)), np.uint8)
            for i in range(-(-most // 8)):
                counts[i] = bytes_of_n[i][target]
            blob.append((key, only(skip[there]), only(last[there]),
                         np.where(rare[there], low[w2[there]], np.uint16(0)), c[there],
                         np.packbits(~held[text[there]]), smallest(np.diff(text[there], prepend=0)),
                         high[target], counts))
        if len(blob[0][0]) + len(blob[1][0]):
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([b], pa.int32()), pa.array([pickle.dumps(blob)], pa.binary())],
                                             ["chunk", "block", "events"])


def _move(seen: np.ndarray, want: np.ndarray, weight: np.ndarray, active: int) -> np.ndarray:
    """One step of word features: along the gradient, less the prior's pull."""
    return 2 * (seen - want - PRIOR * weight) / (active * np.maximum(seen, want) + 2 * PRIOR)


def begins_of(sorted_values: np.ndarray) -> np.ndarray:
    return np.nonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))[0] if len(sorted_values) else np.zeros(0, np.int64)


def sums_of_rows(first: np.ndarray, size: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Adds up the rows of each group (``size`` rows from ``first`` on), to the last bit like
    ``np.add.reduceat``, which takes several times as long over short groups: to the first row
    the sum of the rest, one after another; in large groups it adds the rest in pairs."""
    short = np.nonzero((size > 1) & (size <= FEW_ROWS))[0]
    rounds = []
    for i in range(2, FEW_ROWS):
        there = np.nonzero(size[short] > i)[0]
        rounds.append((there, first[short[there]] + i))
    large = np.nonzero(size > FEW_ROWS)[0]
    begins = np.cumsum(size[large]) - size[large]
    of_large = np.repeat(first[large] - begins, size[large]) + np.arange(size[large].sum())

    def run(x: np.ndarray) -> np.ndarray:
        out, rest = x[first], x[first[short] + 1]
        for there, rows in rounds:
            rest[there] += x[rows]
        out[short] += rest
        if len(large):
            turned = np.empty((x.shape[1], len(of_large)), x.dtype)
            for at in range(0, len(of_large), ROWS_TURNED):
                turned[:, at : at + ROWS_TURNED] = x[of_large[at : at + ROWS_TURNED]].T
            out[large] = np.add.reduceat(turned, begins, axis=1).T
        return out

    return run


def class_factor(log_p: np.ndarray, key, skip, last, other, own, train) -> np.ndarray:
    """Log probability of each event's class: the first layer's ``log_p`` of
    each context (rows), with the features of keys and of keys with the other
    word, trained on the events in training texts."""
    out = np.zeros(len(key))
    # a key's contexts stand together: by the class of the other word, and its hash
    code = (key.astype(np.uint64) << np.uint64(30)) | (skip.astype(np.uint64) << np.uint64(23)) | (last.astype(np.uint64) << np.uint64(16)) | other
    order = np.argsort(code)
    code = code[order]
    begin = begins_of(code)
    of = np.zeros(len(code), np.int64)
    of[begin[1:]] = 1
    of = np.cumsum(of)
    c, learn = own[order].astype(np.int64), train[order]
    cell, times = np.unique(of[learn] * CLASSES + c[learn], return_counts=True)
    context = skip[order[begin]].astype(np.int64) * CLASSES + last[order[begin]]
    keys = code[begin] >> np.uint64(30)
    starts = begins_of(keys)
    at, all_ends = 0, np.append(starts[1:], len(begin))
    event_ends = np.append(begin, len(code))
    while at < len(starts):
        lo = starts[at]
        upto = max(at + 1, int(np.searchsorted(all_ends, lo + SLICE_CONTEXTS, "right")))
        hi = all_ends[upto - 1]
        first = starts[at:upto] - lo
        size = np.diff(np.append(first, hi - lo))
        of_key, sums_of_keys = np.repeat(np.arange(upto - at), size), sums_of_rows(first, size)
        mine = slice(*np.searchsorted(cell, (lo * CLASSES, hi * CLASSES)))
        row, column = cell[mine] // CLASSES - lo, cell[mine] % CLASSES
        cells = row * CLASSES + column
        seen = times[mine].astype(np.float32)
        total = np.bincount(row, seen, hi - lo).astype(np.float32)[:, None]
        plain = log_p[context[lo:hi]]
        seen_of_key = np.bincount(of_key[row] * CLASSES + column, seen, (upto - at) * CLASSES).astype(np.float32).reshape(-1, CLASSES)
        of_keys, of_both = np.zeros_like(seen_of_key), np.zeros_like(seen)
        for step in range(WORD_STEPS + 1):
            if step:
                np.add(plain, np.take(of_keys, of_key, axis=0, out=x, mode="clip"), out=x)
                x.ravel()[cells] += of_both
                np.exp(x, out=x)  # the first layer's probabilities, times bounded factors
            else:  # the features are zero
                x = np.exp(plain)
            sums = x.sum(axis=1, keepdims=True)
            if step < WORD_STEPS:
                x *= total / sums
                of_both += _move(seen, x.ravel()[cells], of_both, 2)
                of_keys += _move(seen_of_key, sums_of_keys(x), of_keys, 2)
        events = slice(event_ends[lo], event_ends[hi])
        here = of[events] - lo
        out[order[events]] = np.log(x[here, c[events]] / sums[here, 0])
        at = upto
    return out


def word_factor(model: Model, key, own, word, n, train) -> np.ndarray:
    """Log probability of each event's word within its class, after its key:
    the words' frequencies, with a feature of each pair of key and word that
    training texts have. All words never seen are one event."""
    _, place = np.unique(key, return_inverse=True)
    group = place.astype(np.uint64) * np.uint64(CLASSES) + own
    code = (group << np.uint64(32)) | word
    order = np.argsort(code)
    code, learn = code[order], train[order]
    begin = begins_of(code)
    if not len(begin):
        return np.zeros(0)
    first = order[begin]
    plain = model.in_class(own[first].astype(np.int64), n[first].astype(np.int64))
    seen = np.add.reduceat(learn.astype(np.float64), begin)
    starts = begins_of(code[begin] >> np.uint64(32))
    of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(begin))))
    total = np.add.reduceat(seen, starts)[of]
    weight = np.zeros(len(begin))
    for step in range(WORD_STEPS + 1):
        factor = np.exp(weight)
        sums = 1 + np.add.reduceat(plain * (factor - 1), starts)
        p = plain * factor / sums[of]
        if step < WORD_STEPS:
            weight += np.where(seen > 0, _move(seen, total * p, weight, 1), 0)
    out = np.zeros(len(code))
    out[order] = np.repeat(np.log(p), np.diff(np.append(begin, len(code))))
    return out


def _block(model: Model, log_p: np.ndarray, rows: pa.Table) -> pa.Table:
    """Trains a block's features and adds up its events' log probabilities for each text."""
    blobs = [pickle.loads(x.as_py()) for x in rows.column("events")]
    sizes = np.array([[len(part[0]) for part in blob] for blob in blobs])
    texts = [[np.cumsum(part[6], dtype=np.int64) for part in blob] for blob in blobs]
    values = []
    for i in range(2):
        of = {name: np.concatenate([blob[i][j] for blob in blobs]) for j, name in enumerate(FIELDS[:5])}
        train = np.concatenate([np.unpackbits(blob[i][5], count=len(blob[i][0])).astype(bool) for blob in blobs])
        word = np.concatenate([blob[i][7] for blob in blobs])
        n = np.concatenate([np.ascontiguousarray(blob[i][8].T).view("<i8").ravel() for blob in blobs])
        if i:
            values.append(word_factor(model, of["key"], of["own"], word, n, train))
        else:
            values.append(class_factor(log_p, *(of[x] for x in FIELDS[:5]), train))
            both = np.nonzero((of["last"] > COMMON) & (of["own"] > COMMON))[0]
            values[0][both] += word_factor(model, of["key"][both], of["own"][both], word, n, train[both])
    ends = np.cumsum(sizes, axis=0)
    out = []
    for j in range(len(sizes)):
        value = np.concatenate([values[i][ends[j, i] - sizes[j, i] : ends[j, i]] for i in range(2)])
        there, at = np.unique(np.concatenate(texts[j]), return_inverse=True)
        out.append(pickle.dumps((smallest(np.diff(there, prepend=0)), np.bincount(at, value).astype(np.float32))))
    return pa.table({"chunk": rows.column("chunk"), "sums": pa.array(out, pa.binary())})


def _score(model: Model, log_p: np.ndarray, known: pa.Table, sums: pa.Table) -> pa.Table:
    doc_id, held, n, met, base, text, cell = pickle.loads(known.column("known")[0].as_py())
    full = np.bincount(text, log_p[cell // CLASSES, cell % CLASSES], len(held))
    for blob in sums.column("sums"):
        there, value = pickle.loads(blob.as_py())
        full[np.cumsum(there, dtype=np.int64)] += value
    return pa.table({
        "doc_id": doc_id, "held_out": pa.array(held), "n_tokens": pa.array(n, pa.int64()),
        "n_known": pa.array(met, pa.int64()), "train_tokens": pa.array(np.full(len(n), model.tokens, np.int64)),
        "base_score": pa.array(base, pa.float64()), "score": pa.array(full / np.log(10), pa.float64())})


def held_out(doc_id: Column) -> Column:
    return crc_remainder(doc_id, 7) == 2


def lm_report(docs: DataFrame, steps: int = STEPS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score and score. Null text counts as
    empty (one token, the end); a null doc_id isn't held out. Words never seen
    in training are one event per class, as they are one event for the base.
    An empty table gives no rows; without training rows every class is alike."""
    spark = docs.sparkSession
    text = utf8(F.col("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    chunks = 1 + size // CHUNK_BYTES
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text.alias("text"),
                       F.pmod(F.xxhash64("doc_id", F.length(text), F.crc32(text)), F.lit(chunks)).cast("int").alias("chunk"))

    # each chunk's words with their counts over all training texts: few rows, each with many words
    of_cut, of_words, of_tokens = (step_folder(spark) for _ in range(3))  # read until the chunks are counted
    cut = materialize(rows.groupBy("chunk").applyInArrow(lambda key, own: _words(key, own, chunks), f"{WORDS}, tokens binary"), tidy=True, folder=of_cut)
    words = materialize(
        cut.where("h is not null").drop("tokens").repartition(chunks, "part").groupBy("part")  # few chunks' words a task: they are sorted there
        .applyInArrow(_totals, f"{WORDS}, {FACTS}"), tidy=True, folder=of_words)
    # the words' rows stand in the files that were cut too, and aren't needed again
    tokens = materialize(cut.where("tokens is not null").select("chunk", "tokens"), ROWS_A_FILE, folder=of_tokens)
    remove(spark, of_cut)
    facts = words.where("chunk is null")
    top = facts.select(F.inline("top")).orderBy(F.desc("n"), "h").limit(COMMON).collect()
    ends = docs.where(~held_out(F.col("doc_id"))).count()
    common = np.sort(np.array([r["h"] for r in top], np.int64).view(np.uint64))
    total = distinct = 0
    mass, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in facts.select(F.inline("mass")).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).collect():
        total, distinct = total + r["n"], distinct + r["types"]
        of_common = [x["n"] for x in top if x["bucket"] == r["bucket"]]
        mass[1 + COMMON + r["bucket"]], types[1 + COMMON + r["bucket"]] = r["n"] - sum(of_common), r["types"] - len(of_common)

    model = Model(Weights(np.zeros(CLASSES)), common, mass, types, int(total) + ends, ends, int(distinct) + (ends > 0))
    blocks = 1 + model.tokens // BLOCK_TOKENS
    sent = send(spark, replace(model, weights=None))
    counted = materialize(
        tokens.repartition(chunks, "chunk").groupBy("chunk")
        .cogroup(words.where("chunk is not null").drop("top", "mass").repartition(chunks, "chunk").groupBy("chunk"))
        .applyInArrow(lambda left, right: _counted(received(sent), left, right),
                      "chunk int, tokens binary, cells binary, known binary"), tidy=True)
    for folder in (of_words, of_tokens):
        remove(spark, folder)
    cells = counted.select("cells").mapInArrow(_cells, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    shard = F.pmod(F.xxhash64((F.col("cell") / CLASSES).cast("int")), F.lit(SHARDS))
    weights = train(materialize(cells.repartition(SHARDS, shard), tidy=True), steps)

    log_p = weights.log_p(np.arange(CLASSES**2)).astype(np.float32)
    trained = send(spark, (replace(model, weights=None), log_p))
    sums = None
    passes = min(PASSES, blocks)
    for turn in range(passes):
        events = counted.select("chunk", "tokens").mapInArrow(
            lambda batches, turn=turn: _events(received(sent), range(turn, blocks, passes), blocks, batches), "chunk int, block int, events binary")
        part = materialize(events.groupBy("block").applyInArrow(lambda table: _block(*received(trained), table), "chunk int, sums binary"), tidy=True)
        sums = part if sums is None else sums.union(part)
    return (counted.select("chunk", "known").groupBy("chunk").cogroup(sums.groupBy("chunk"))
            .applyInArrow(lambda left, right: _score(*received(trained), left, right),
                          "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                          "base_score double, score double"))
