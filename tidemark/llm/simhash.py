"""Near-duplicates by SimHash, joined by the generalised pigeonhole principle.

A fingerprint has bit i if more than half of the hashes of a text's shingles
have it. Two texts are linked if their fingerprints differ in at most ``NEAR``
bits. Texts with equal fingerprints are one node; only nodes are joined.

The 64 bits are cut into m partitions. If x and q differ in at most ``NEAR``
bits, then for any thresholds t_1 … t_m (-1 allowed) that sum to NEAR - m + 1
some partition i has them differ in at most t_i bits: otherwise they differ in
the sum of all t_i + 1, which is NEAR + 1. So each fingerprint may choose
thresholds of its own, and finds all its partners by probing the values within
t_i of its own in each partition.

1. Correlated bits go into one group of 16 (their joint values are few and
   uneven, so that the others are spread evenly). Correlations and the groups'
   values are counted over all fingerprints.
2. From the counts of the 65,536 values of each group follows how many
   fingerprints lie within each distance of a value. Groups that form one
   partition are taken as independent. Dynamic programming finds the thresholds
   with the fewest expected candidates and probes for each fingerprint; the
   partitions (4, 3 or 2) with the smallest total over all are used. Estimates
   decide about speed only, never about which pairs are found.
3. Members and probers of a value meet in one row, in blocks of bounded size;
   candidates are verified on the whole fingerprints there, and only a spanning
   forest of the links leaves the task. Values with several blocks then compare
   what lies outside their largest component with all of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, received, send, slices, utf8
from .components import connected_components

WIDTH, SEED, BITS, NEAR = 4, 42, 64, 4
GROUP = 16  # bits whose values are counted exactly
#: How many groups each partition takes.
LAYOUTS = ((1, 1, 1, 1), (2, 1, 1), (2, 2))
PROBE_COST = 40.0  # a probe's row, in candidates verified
BLOCK = 2048  # members or probers of a value in one row, on average
PAIRS_AT_ONCE = 500_000
SLICE_BYTES = 4_000_000


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """SimHash over the text's shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(width, len(words))
    begin, end = (end - size)[: len(words) - k + 1].tolist(), end[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(body[s:e], SEED) for s, e in zip(begin, end, strict=True)), np.uint64, len(begin))
    n = sum(bits_of(hashes[at : at + 65536]).sum(axis=0, dtype=np.int64) for at in range(0, len(hashes), 65536))
    return int(np.packbits(2 * n > len(hashes), bitorder="little").view(np.uint64)[0])


def bits_of(values: np.ndarray) -> np.ndarray:
    """A row of 64 bits for each value, the lowest first."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                own = np.array([fingerprint(t.as_py(), width) for t in part.column("text")], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own.view(np.int64))], ["doc_id", "f"])

    return run


def _values(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("f").to_numpy().view(np.uint64)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many fingerprints each two bits are set."""
    n = np.zeros((BITS, BITS))
    for batch in batches:
        x = bits_of(_values(batch)).astype(np.float32)
        n += x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(n.ravel().astype(np.int64))], ["place", "n"])


def group_bits(together: np.ndarray, n: int) -> np.ndarray:
    """The bits in groups (rows): each group starts from the bit that is most
    correlated with all that are left, and takes the one most correlated with
    those it has."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = list(range(BITS)), []
    while left:
        group = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < GROUP:
            group.append(max(left, key=lambda b: (related[b, group].sum(), -b)))
            left.remove(group[-1])
        groups.append(group)
    return np.array(groups)


def group_values(values: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Each fingerprint's value in each group (columns)."""
    bits = bits_of(values)
    return np.stack([np.ascontiguousarray(np.packbits(bits[:, g], axis=1, bitorder="little")).view("<u2")[:, 0] for g in groups],
                    axis=1).astype(np.int64)


def _histogram(groups: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(groups) << GROUP, np.int64)
        for batch in batches:
            own = group_values(_values(batch), groups) + (np.arange(len(groups)) << GROUP)
            n += np.bincount(own.ravel(), minlength=len(n))
        there = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[there])], ["place", "n"])

    return run


def at_distance(histogram: np.ndarray, most: int = NEAR) -> np.ndarray:
    """For each value (columns) how many lie at each distance (rows) from it."""
    out = np.zeros((most + 1, len(histogram)), np.int64)
    out[0] = histogram
    every = np.arange(len(histogram))
    for bit in range(len(histogram).bit_length() - 1):
        other = out[:, every ^ (1 << bit)]
        out[1:] += other[:-1]
    return out


def masks(bits: int, ones: int) -> np.ndarray:
    """All values of so many bits with so many ones."""
    return np.array([sum(1 << b for b in x) for x in combinations(range(bits), ones)], np.int64)


@dataclass
class Plan:
    """What all tasks know of the fingerprints: the groups of bits, and how
    many fingerprints lie at each distance from each group's values. Its size
    is fixed: 4 groups, 5 distances, 65,536 values."""

    groups: np.ndarray
    near: np.ndarray  # group, distance, value
    n: int

    def partitions(self, layout: tuple[int, ...]) -> list[list[int]]:
        ends = np.cumsum(layout)
        return [list(range(e - k, e)) for e, k in zip(ends, layout, strict=True)]

    def candidates(self, own: np.ndarray, partition: list[int]) -> np.ndarray:
        """Expected candidates within each distance (columns 0 to NEAR)."""
        exact = self.near[partition[0]][:, own[:, partition[0]]].T.astype(float)
        for g in partition[1:]:
            other = self.near[g][:, own[:, g]].T / max(self.n, 1)
            exact = np.stack([sum(exact[:, i] * other[:, t - i] for i in range(t + 1)) for t in range(NEAR + 1)], axis=1)
        return np.cumsum(exact, axis=1)

    def thresholds(self, own: np.ndarray, layout: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Each fingerprint's thresholds (columns: partitions) and their cost.

        Dynamic programming over the partitions: ``best[:, j]`` is the least
        cost of those so far whose thresholds, each counted from -1, sum to j."""
        parts, total = self.partitions(layout), NEAR + 1
        best = np.full((len(own), total + 1), np.inf)
        best[:, 0] = 0
        chosen = []
        for part in parts:
            probes = np.cumsum([comb(GROUP * len(part), t) for t in range(NEAR + 1)])
            cost = np.concatenate([np.zeros((len(own), 1)), self.candidates(own, part) + PROBE_COST * probes], axis=1)
            new, take = np.full_like(best, np.inf), np.zeros(best.shape, np.int64)
            for j in range(total + 1):
                for u in range(j + 1):
                    price = best[:, j - u] + cost[:, u]
                    better = price < new[:, j]
                    new[better, j], take[better, j] = price[better], u
            best = new
            chosen.append(take)
        out, j = np.zeros((len(own), len(parts)), np.int64), np.full(len(own), total)
        for i in range(len(parts) - 1, -1, -1):
            out[:, i] = chosen[i][np.arange(len(own)), j]
            j = j - out[:, i]
        return out - 1, best[:, total]


def _costs(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = np.zeros(len(LAYOUTS))
        for batch in batches:
            own = group_values(_values(batch), plan.groups)
            cost += [plan.thresholds(own, layout)[1].sum() for layout in LAYOUTS]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(LAYOUTS))), pa.array(cost)], ["layout", "cost"])

    return run


def _deal(plan: Plan, layout: tuple[int, ...]):
    """Rows of a value (``key``: partition and value): its members, and those
    that probe it. Values that no other fingerprint has are not probed."""
    parts = plan.partitions(layout)
    flips = {(k, t): masks(GROUP * k, t) for k in set(layout) for t in range(NEAR + 1) if k == 1 or t < 4}

    def rows(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        own = group_values(values, plan.groups)
        limit = plan.thresholds(own, layout)[0]
        for i, part in enumerate(parts):
            value = sum(own[:, g] << (GROUP * j) for j, g in enumerate(part))
            yield (i << 32) + value, values, False
            for t in range(int(limit[:, i].max(initial=-1)) + 1):
                some = limit[:, i] >= t
                flip = flips[len(part), t] if (len(part), t) in flips else masks(GROUP * len(part), t)
                probed = (value[some, None] ^ flip).ravel()
                prober = np.repeat(values[some], len(flip))
                if len(part) == 1:
                    others = plan.near[part[0]][0][probed] > (1 if t == 0 else 0)
                    probed, prober = probed[others], prober[others]
                yield (i << 32) + probed, prober, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _values(batch)
            for at in range(0, len(values), 1024):
                for key, f, probe in rows(values[at : at + 1024]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(f.view(np.int64)), pa.array(np.full(len(key), probe))], ["key", "f", "probe"])

    return run


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the edges, without a circle, that join the same nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    edge, label, kept = np.arange(len(a)), np.arange(len(nodes)), []
    while True:
        lx, ly = label[x], label[y]
        live = lx != ly
        if not live.any():
            break
        x, y, edge, lx, ly = x[live], y[live], edge[live], lx[live], ly[live]
        high, low = np.maximum(lx, ly), np.minimum(lx, ly)
        order = np.lexsort((low, high))
        top, first = np.unique(high[order], return_index=True)
        pick = order[first]  # each label hangs on a smaller one: no circle
        kept.append(edge[pick])
        label_of = np.arange(len(nodes))
        label_of[top] = low[pick]
        while (label_of != label_of[label_of]).any():
            label_of = label_of[label_of]
        label = label_of[label]
    at = np.concatenate(kept) if kept else edge[:0]
    return a[at], b[at]


def _lists(batch: pa.RecordBatch, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the rows' lists, and the fingerprints and nodes in them."""
    column = batch.column(side)
    offset = column.offsets.to_numpy().astype(np.int64)
    both = column.flatten()
    return offset - offset[0], both.field("f").to_numpy().view(np.uint64), both.field("node").to_numpy()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row's ``left`` with its ``right`` and gives a spanning
    forest of the nodes that links join: no more edges than nodes."""
    for batch in batches:
        begin, left, x = _lists(batch, "left")
        start, right, y = _lists(batch, "right")
        wide = np.diff(start)
        # one line for each left member: the range of right ones that it meets
        row = np.repeat(np.arange(len(wide)), np.diff(begin))
        meets = np.cumsum(wide[row])
        a, b, at = [], [], 0
        while at < len(row):
            upto = max(at + 1, int(np.searchsorted(meets, PAIRS_AT_ONCE + (meets[at - 1] if at else 0), "right")))
            n = wide[row[at:upto]]
            i = np.repeat(np.arange(at, upto), n)
            j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + start[row[i]]
            near = (np.bitwise_count(left[i] ^ right[j]) <= NEAR) & (x[i] != y[j])
            forest = spanning_forest(x[i[near]], y[j[near]])
            a.append(forest[0]), b.append(forest[1])
            at = upto
        a, b = spanning_forest(np.concatenate([*a, x[:0]]), np.concatenate([*b, x[:0]]))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def plan_of(nodes: DataFrame) -> tuple[Plan, tuple[int, ...]]:
    """``nodes``: different fingerprints (``f``). The plan and the layout of
    least cost; what reaches the driver are counts of fixed number."""
    def counts(run, size: int) -> np.ndarray:
        found = (nodes.mapInArrow(lambda batches: run(batches), "place long, n long")
                 .groupBy("place").agg(F.sum("n").alias("n")).toArrow())
        out = np.zeros(size, np.int64)
        out[found.column("place").to_numpy()] = found.column("n").to_numpy()
        return out

    n = nodes.count()
    groups = group_bits(counts(_together, BITS * BITS).reshape(BITS, BITS), n)
    histogram = counts(_histogram(groups), len(groups) << GROUP).reshape(len(groups), -1)
    plan = Plan(groups, np.stack([at_distance(h) for h in histogram]), n)
    sent = send(nodes.sparkSession, plan)
    costs = (nodes.mapInArrow(lambda batches: _costs(received(sent))(batches), "layout long, cost double")
             .groupBy("layout").agg(F.sum("cost").alias("cost")).collect())
    least = min(costs, key=lambda r: (r["cost"], r["layout"]), default=None)
    return plan, LAYOUTS[least["layout"] if least else 0]


def join_components(nodes: DataFrame) -> DataFrame:
    """``nodes``: different fingerprints ``f``. Returns ``f`` and ``component``
    (a fingerprint) of those that are linked with others."""
    spark = nodes.sparkSession
    plan, layout = plan_of(nodes)
    sent = send(spark, plan)
    rows = materialize(nodes.mapInArrow(lambda batches: _deal(received(sent), layout)(batches), "key long, f long, probe boolean"))
    size = rows.groupBy("key").agg(F.greatest(F.count_if("probe"), F.count_if(~F.col("probe"))).alias("size"))
    large = materialize(size.where(F.col("size") > BLOCK))
    block = lambda n: F.pmod(F.xxhash64("f", "key"), F.ceil(n / BLOCK)).cast("int")
    item = F.struct("f", F.col("f").alias("node"))
    first = (rows.join(large, "key", "left").groupBy("key", block(F.coalesce("size", F.lit(1))).alias("block"))
             .agg(F.collect_list(F.when(F.col("probe"), item)).alias("left"), F.collect_list(F.when(~F.col("probe"), item)).alias("right"))
             .where((F.size("left") > 0) & (F.size("right") > 0)))
    found = connected_components(first.select("left", "right").mapInArrow(_linked, "a long, b long"))
    labels = found.select(F.col("node").alias("f"), "component")

    if large.limit(1).count():  # blocks of one value with one another, where components are still apart
        now = (rows.join(large.select("key"), "key", "left_semi").select("key", "f").distinct()
               .join(labels, "f", "left").select("key", "f", F.coalesce("component", "f").alias("node")))
        dealt = materialize(now)
        mixed = (dealt.groupBy("key", "node").agg(F.count("*").alias("size")).groupBy("key").agg(
            F.max_by("node", F.struct("size", "node")).alias("major"), F.sum("size").alias("members"),
            (F.sum("size") - F.max("size")).alias("others")).where("others > 0"))

        def blocks(of: str, name: str, some: DataFrame) -> DataFrame:
            return (some.groupBy("key", block(F.col(of)).alias(f"{name}_block"))
                    .agg(F.collect_list(F.struct("f", "node")).alias(name)))

        known = dealt.join(mixed, "key")
        rest = blocks("others", "left", known.where("node != major")).join(blocks("members", "right", known), "key")
        joined = connected_components(rest.select("left", "right").mapInArrow(_linked, "a long, b long"))
        labels = (dealt.select("f", "node").union(labels.select("f", "component")).distinct()
                  .join(joined.select("node", F.col("component").alias("into")), "node", "left")
                  .select("f", F.coalesce("into", "node").alias("component")))
    return labels


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs`` (``doc_id`` bigint, ``text``; other columns
    are ignored): ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest doc_id reachable over links of at most
    ``NEAR`` differing bits.

    Null, empty and blank texts have fingerprint zero, linked like any other.
    A row without a doc_id can't be named: it has its fingerprint, no
    component, and links nothing. A doc_id with several texts is reached over
    each of them; its rows may have different components. Repeated rows get
    equal results; an empty table gives none."""
    signed = materialize(docs.select("doc_id", utf8(F.col("text")).alias("text"))
                         .mapInArrow(lambda batches: _fingerprints(width)(batches), "doc_id long, f long"))
    nodes = materialize(signed.where("doc_id is not null").groupBy("f").agg(F.min("doc_id").alias("first")))
    of_node = nodes.join(join_components(nodes.select("f")), "f", "left").withColumn("component", F.coalesce("component", "f"))
    named = of_node.join(of_node.groupBy("component").agg(F.min("first").alias("component_id")), "component").select("f", "component_id")
    digits = F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint")
    return (signed.join(named, "f", "left")
            .select("doc_id", digits, F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
