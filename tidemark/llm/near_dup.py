"""Near-duplicate documents by odd sketches over MinHash samples.

1. Every document becomes its set of distinct word shingles (64-bit hashes),
   and from that ``BANDS * ROWS`` MinHash samples. The samples of each band
   are hashed to one bucket key; all samples together are folded into an *odd
   sketch*: a bitmap in which every sample flips one bit, so that the XOR of
   two sketches keeps only the samples in which two documents differ, and its
   population count estimates a high similarity precisely.
2. Documents with equal sets form one class; only classes go on. Copies,
   however many, cost one row each.
3. In each band bucket, every class is paired with the bucket's first class in
   a random order of that band (a star, never all pairs). A pair is a
   candidate if its odd sketches allow the wanted similarity.
4. Candidates are confirmed on the full sets, in two rounds: each class offers
   its two most similar open candidates, then all; confirmed links join
   components, and candidates inside one component are closed. So a large
   group of near copies is joined by few comparisons.
5. Buckets that still hold several components are compared whole, in blocks
   of bounded size: the classes outside a bucket's largest component with all
   of its classes. First sketch against sketch; the classes that have a
   candidate in a pair of blocks meet there once more, with their full sets.
   Candidates are confirmed in that task, and only a spanning forest of the
   links leaves it: never more rows than classes. So buckets of any size are
   dealt with in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix, utf8, window_hashes, word_hashes
from .components import connected_components

BANDS, ROWS = 32, 5  # two sets of similarity 0.8 share no bucket with probability 3e-6
SKETCH_BITS = 512
#: For both the samples' error and the sketch's collisions: at similarity 0.80 (0.81, 0.82) a pair has too many differing
#: bits with probability 1.5e-6 (3e-7, 6e-8), which is less than the bands' miss there.
SLACK = 0.19
BLOCK, BLOCK_SHINGLES = 512, 500_000  # classes, and shingles of all of them, compared at once with as many others
FILTER_BITS = 1 << 24
STAR_ROUNDS = (2, None)  # candidates that a class offers in the rounds of step 4; the last is all


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct ``width``-word shingles of a text
    (lower-cased A-Z, words between ASCII white space); a shorter text is one
    shingle; no words, no shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(width, len(words))))


def minhash(shingle_set: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The smallest value of each seeded hash over the set."""
    low = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    factors = (seeds | np.uint64(1))[:, None]
    with np.errstate(over="ignore"):
        for at in range(0, len(shingle_set), 1024):
            part = shingle_set[None, at : at + 1024] ^ seeds[:, None]
            part *= factors
            np.minimum(low, part.min(axis=1), out=low)
    return low


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as 64-bit words: sample i flips bit hash(i, value)."""
    with np.errstate(over="ignore"):
        bits = mix(samples + np.arange(1, len(samples) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(SKETCH_BITS)
    return np.packbits(np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1).view(np.int64)


def differing_bits(similarity: float) -> int:
    """The XOR population count up to which a pair may have the similarity:
    the odd sketch's estimate 1 + n/(4k) ln(1 - 2x/n), turned round."""
    low = max(0.0, similarity - SLACK)
    k, n = BANDS * ROWS, SKETCH_BITS
    return int(np.ceil(n / 2 * (1 - np.exp(-4 * k * (1 - low) / n))))


def shape_of(shingle_set: np.ndarray) -> int:
    """What names a class: a 64-bit hash of its set."""
    return xxhash.xxh3_64_intdigest(np.sort(shingle_set).tobytes()) - 2**63


def _sets(width: int):
    seeds = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sets, bands, sketches = [], [], [], []
            for text in batch.column("text"):
                own = shingles(text.as_py(), width)
                n.append(len(own))
                if not len(own):
                    sets.append(None), bands.append(None), sketches.append(None)
                    continue
                samples = minhash(own, seeds)
                with np.errstate(over="ignore"):
                    key = np.arange(1, BANDS + 1, dtype=np.uint64)
                    for j in range(ROWS):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + samples[j::ROWS])
                sets.append(shape_of(own))
                bands.append(key.view(np.int64))
                sketches.append(odd_sketch(samples))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sets, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "class", "bands", "sketch"])

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(t.as_py(), width) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(shape_of, own), pa.int64()), pa.array([np.sort(x.view(np.int64)) for x in own], pa.list_(pa.int64()))],
                ["class", "shingles"])

    return run


def differing(x: Column, y: Column) -> Column:
    """Population count of the XOR of two sketches (eight 64-bit words each)."""
    return sum((F.bit_count(F.get(x, i).bitwiseXOR(F.get(y, i))) for i in range(SKETCH_BITS // 64)),
               start=F.lit(0)).cast("int")


def _members(rows: pa.Scalar) -> list[np.ndarray]:
    """Columns of a list of classes: names, components, sizes, and matrices of sketches and bands."""
    own = rows.values
    fixed = [own.field(c).to_numpy() for c in ("class", "component", "n_shingles")]
    sketch, bands = (pc.list_flatten(own.field(c)).to_numpy().reshape(len(own), -1) for c in ("sketch", "bands"))
    return [*fixed, sketch.view(np.uint64), bands]  # bitwise_count takes the absolute value of signed numbers


def _candidates(key: int, left: list[np.ndarray], right: list[np.ndarray], most: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each place in ``left`` those in ``right`` of another component that
    sketches and sizes allow. A pair that shares several buckets is a candidate in the first of them only."""
    name, part, size, sketch, bands = right
    every = np.arange(len(name))
    for i in range(len(left[0])):
        n = left[2][i]
        near = np.nonzero((part != left[1][i]) & (np.minimum(size, n) * 100 >= np.maximum(size, n) * percent)
                          & (np.bitwise_count(sketch ^ left[3][i]).sum(axis=1) <= most))[0]
        shared = bands[near] == left[4][i]
        yield i, near[bands[near, shared.argmax(axis=1)] == key] if len(near) else every[:0]


def _involved(most: int, percent: int):
    """The classes that have a candidate in a pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                key, one, other = (batch.column(c)[r].as_py() for c in ("key", "left_block", "right_block"))
                left, right = _members(batch.column("left")[r]), _members(batch.column("right")[r])
                has, met = [], np.zeros(len(right[0]), bool)
                for i, near in _candidates(key, left, right, most, percent):
                    if len(near):
                        has.append(i)
                        met[near] = True
                names = np.concatenate([left[0][has], right[0][met]])
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, key)), pa.array(np.full(n, one)), pa.array(np.full(n, other)), pa.array(names),
                     pa.array(np.arange(n) < len(has))], ["key", "left_block", "right_block", "class", "on_left"])

    return run


def _confirmed(most: int, percent: int):
    """A spanning forest of the links between components in each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for r in range(len(batch)):
                left, right = _members(batch.column("left")[r]), _members(batch.column("right")[r])
                own, others = (batch.column(c)[r].values.field("shingles") for c in ("left", "right"))
                begin, flat = others.offsets.to_numpy().astype(np.int64), others.values.to_numpy()
                into: dict[int, int] = {}

                def root(x: int, into=into) -> int:
                    while x in into:
                        x = into[x]
                    return x

                for i, near in _candidates(batch.column("key")[r].as_py(), left, right, most, percent):
                    if not len(near):
                        continue
                    mine, n = own[i].values.to_numpy(), int(left[2][i])
                    a = root(int(left[1][i]))
                    open_ = [(int(j), c) for j, c in zip(near.tolist(), right[1][near].tolist(), strict=True) if root(c) != a]
                    for j, c in open_:
                        b = root(c)
                        if a == b:
                            continue
                        other = flat[begin[j] : begin[j + 1]]
                        at = np.minimum(np.searchsorted(mine, other), n - 1)
                        common = int((mine[at] == other).sum())
                        if common * 100 >= (n + len(other) - common) * percent:
                            edges.append((a, b))
                            into[max(a, b)] = a = min(a, b)
            columns = list(zip(*edges, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return run


def only_likely(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` is among ``ids`` (one column), and some by
    chance: a bitmap of the ids' hashes, of bounded size whatever their number,
    is sent out, so that rows that no join will keep aren't shuffled. The plan
    has no Python step: a worker for it would stand beside the next one's."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)).cast("int")
    found = (ids.select(place(F.col(ids.columns[0])).alias("p")).groupBy((F.col("p") / 64).cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, p % 64))").alias("bits")))
    at = place(rows[column])
    here = (found["word"] == (at / 64).cast("int")) & (found["bits"].bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), at % 64)) != 0)
    return rows.where(F.col(column).isNotNull()).join(F.broadcast(found), here, "left_semi")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Group the documents whose shingle sets are similar.

    ``docs``: ``doc_id`` (bigint) and ``text``; other columns are ignored.
    Links join documents with ``100 * |A and B| >= percent * |A or B|``.

    Returns one row per input row: ``doc_id``, ``n_shingles``,
    ``component_id`` (the smallest doc_id reachable over links, the document
    itself included) and ``kept`` (``doc_id = component_id``). A document
    without words has an empty set and is linked with nothing. A row without a
    doc_id can't be named: it comes back with its ``n_shingles``, no
    component, and kept, and links nothing. Repeated rows get equal results. A
    doc_id with several texts is reached over each of them; its rows may have
    different components. Sets are told apart by 64-bit hashes."""
    spark = docs.sparkSession
    signed = materialize(
        docs.select("doc_id", utf8(F.col("text")).alias("text"))
        .mapInArrow(_sets(width), "doc_id long, n_shingles long, class long, bands array<long>, sketch array<long>"))

    # classes of equal sets, and their smallest doc_id; rows of a class with one doc_id are alike
    named = signed.where("class is not null and doc_id is not null")
    first_id = materialize(named.groupBy("class").agg(F.min("doc_id").alias("doc_id")))
    classes = materialize(named.join(first_id, ["class", "doc_id"]).dropDuplicates(["class"]))
    most = differing_bits(percent / 100)

    # band buckets with more than one class
    rows = classes.select("class", F.posexplode("bands").alias("band", "key"))
    first = rows.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("class", "band").alias("order"), F.col("class").alias("head"))).alias("first"),
        F.count("*").alias("members")).where("members > 1")
    shared = materialize(
        rows.join(first, "key").select("key", "class", F.col("first.head").alias("head")))

    facts = classes.select("class", "n_shingles", "sketch")
    side = lambda name, n: facts.select(F.col("class").alias(name), F.col("n_shingles").alias(f"n_{n}"), F.col("sketch").alias(f"s_{n}"))
    sizes_allow = F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent
    stars = (shared.where("class != head").select(F.col("class").alias("x"), F.col("head").alias("y")).distinct()
             .join(side("x", "x"), "x").join(side("y", "y"), "y")
             .withColumn("bits", differing(F.col("s_x"), F.col("s_y")))
             .where(sizes_allow & (F.col("bits") <= most))
             .select(F.col("x").alias("a"), F.col("y").alias("b"), F.col("x").alias("ca"), F.col("y").alias("cb"), "bits"))

    labels = facts.select("class", F.col("class").alias("component"))
    labels = _confirm(docs, materialize(stars), first_id, labels, width, percent, STAR_ROUNDS)
    labels = _whole_buckets(docs, shared, classes, first_id, labels, width, percent)

    whole = labels.join(first_id, "class")
    whole = whole.join(whole.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component")
    out = signed.select("doc_id", "n_shingles", "class").join(whole.select("class", "component_id"), "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``class`` and ``shingles`` (sorted) of the classes in ``wanted``
    (``class``, ``doc_id``), from the texts of those documents. A document
    with several texts gives the sets of all; what isn't wanted is left out."""
    ids = materialize(wanted.select("class", "doc_id"))
    texts = only_likely(docs.select("doc_id", utf8(F.col("text")).alias("text")), "doc_id", ids.select("doc_id"))
    return materialize(
        texts.join(ids.select("doc_id").distinct(), "doc_id", "left_semi").select("text")
        .mapInArrow(_full_sets(width), "class long, shingles array<long>")
        .join(ids.select("class"), "class", "left_semi").dropDuplicates(["class"]))


def join_labels(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` after joining the components that ``edges`` (``a``, ``b``) link."""
    joined = connected_components(edges)
    return materialize(
        labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("into")), "component", "left")
        .select("class", F.coalesce("into", "component").alias("component")))


def _whole_buckets(docs: DataFrame, shared: DataFrame, classes: DataFrame, first_id: DataFrame, labels: DataFrame,
                   width: int, percent: int) -> DataFrame:
    """Step 5: buckets (``shared``: ``key``, ``class``) whose members are still
    in several components, those outside the largest one against all."""
    most = differing_bits(percent / 100)
    now = shared.select("key", "class").join(labels, "class").join(classes.select("class", "n_shingles"), "class")
    parts = now.groupBy("key", "component").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("words"))
    blocks_of = lambda n, words: F.ceil(F.greatest(n / BLOCK, words / BLOCK_SHINGLES))
    mixed = (parts.groupBy("key").agg(
        F.max_by("component", F.struct("size", "component")).alias("major"),
        blocks_of(F.sum("size"), F.sum("words")).alias("members"),
        blocks_of(F.sum("size") - F.max("size"), F.sum("words")).alias("others"),
        F.count("*").alias("parts")).where("parts > 1"))
    dealt = materialize(now.drop("n_shingles").join(mixed, "key"))
    if not dealt.limit(1).count():
        return labels
    member = F.struct("class", "component", "n_shingles", "sketch", "bands")

    def blocks(rows: DataFrame, of: str, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("class"), F.col(of)).cast("long")
        return rows.join(classes, "class").groupBy("key", block.alias(f"{name}_block")).agg(F.collect_list(member).alias(name))

    pairs = blocks(dealt.where("component != major"), "others", "left").join(blocks(dealt, "members", "right"), "key")
    some = materialize(
        pairs.select("key", "left_block", "right_block", "left", "right")
        .mapInArrow(_involved(most, percent), "key long, left_block long, right_block long, class long, on_left boolean"))
    if not some.limit(1).count():
        return labels
    sets = full_sets(docs, some.select("class").distinct().join(first_id, "class"), width)
    whole = F.struct("class", "component", "n_shingles", "sketch", "bands", "shingles")
    again = (some.join(classes.join(labels, "class").join(sets, "class"), "class")
             .groupBy("key", "left_block", "right_block")
             .agg(F.collect_list(F.when(F.col("on_left"), whole)).alias("left"), F.collect_list(F.when(~F.col("on_left"), whole)).alias("right")))
    return join_labels(labels, again.select("key", "left", "right").mapInArrow(_confirmed(most, percent), "a long, b long"))


def _confirm(docs: DataFrame, open_pairs: DataFrame, first_id: DataFrame, labels: DataFrame, width: int, percent: int,
             rounds: tuple[int | None, ...]) -> DataFrame:
    """Confirm candidates (``a``, ``b``, ``bits`` and the ends' components
    ``ca``, ``cb``) on full sets until each is confirmed, refuted or inside one
    component; in each round a class offers so many of its most similar ones,
    in the last all. Returns ``labels`` (``class``, ``component``) with the
    components that the links join."""
    def in_components(pairs: DataFrame) -> DataFrame:
        of = lambda end: labels.select(F.col("class").alias(end), F.col("component").alias(f"c{end}"))
        return materialize(pairs.join(of("a"), "a").join(of("b"), "b").where("ca != cb"))

    sets = None
    for offered in rounds:
        if not open_pairs.limit(1).count():
            break
        if sets is None:
            ends = open_pairs.select(F.col("a").alias("class")).union(open_pairs.select("b")).distinct()
            sets = full_sets(docs, ends.join(first_id, "class"), width)
        best = open_pairs
        if offered is not None:
            nearest = Window.partitionBy("a").orderBy("bits", "b")
            best = open_pairs.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= offered).drop("rank")
        x = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
        common = F.size(F.array_intersect("x", "y")).cast("long")
        tried = materialize(
            best.join(x, "a").join(y, "b")
            .select("a", "b", "ca", "cb",
                    (common * 100 >= (F.size("x") + F.size("y") - common) * percent).alias("linked")))
        labels = join_labels(labels, tried.where("linked").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        if offered is None:
            break
        open_pairs = in_components(open_pairs.select("a", "b", "bits").join(tried.select("a", "b"), ["a", "b"], "left_anti"))
    return labels
