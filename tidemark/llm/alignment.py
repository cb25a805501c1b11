"""Tokens of two tokenizers, aligned by byte offsets.

A byte-level BPE (A) and a SentencePiece BPE with byte fallback (B) both cut a
space and the text into tokens of whole bytes. Places where tokens of both end
cut the tokens into groups; two tokens are linked if their bytes overlap.

Neither tokenizer merges anything over the border between a character that is
not white space and a space (checked when the vocabularies are loaded), so
texts are cut there into segments and each different one of a task is encoded
and aligned once, all of them together in Arrow:

1. ``list_flatten`` and ``list_parent_indices`` turn lists of ids into columns;
   running sums of the tokens' byte lengths, less what the segment began with,
   are the tokens' ends.
2. A full outer hash join of both tables on (segment, end) has a row for each
   place where a token ends. Ordered by place, with the gaps filled from below,
   each row names the two tokens that cover the bytes before it: a link. Rows
   that both tables have end a group.
3. ``Table.group_by`` turns a document's segments into its different pairs of
   ids, and those of a chunk of documents into partial counts: in how many
   documents of the chunk a pair is linked.

Spark sums the partial counts, finds each A id's highest, and hands every chunk
the counts of just the pairs that it has: nothing that grows with the corpus is
broadcast, only the vocabularies are.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, slices

PATH_A, PATH_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
SLICE_BYTES = 2_000_000
KNOWN_SEGMENTS = 120_000  # kept by a task for its next slices; beyond that all are forgotten
CHUNK_PAIRS = 2_000_000  # different pairs of all documents of a chunk, one document at least
BORDER, BLANKS = re.compile(r"\S "), re.compile(r"\s ")
#: Fixed value: the pattern that byte-level tokenizers cut texts with before they merge.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoders:
    """Both tokenizers, and the bytes and names that each id stands for."""

    def __init__(self, file_a: bytes, file_b: bytes):
        import sentencepiece
        import tiktoken

        content = json.loads(file_a)
        shape, model = content["pre_tokenizer"], content["model"]
        if shape["type"] != "ByteLevel" or not shape.get("use_regex", True) or shape["add_prefix_space"] or content["normalizer"]:
            raise ValueError("A has to be a byte-level tokenizer that cuts before spaces")
        letters = byte_letters()
        merges = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
        order = [model["vocab"][m] for m in [*sorted(letters, key=model["vocab"].__getitem__), *merges]]
        if any(x >= y for x, y in itertools.pairwise(order)):
            raise ValueError("A's ids have to follow the order of its merges")
        ranks = {bytes(letters[c] for c in t): model["vocab"][t] for t in [*letters, *merges]}
        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        stands = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            stands[i] = token
        self.bytes_a = pa.array(stands, pa.binary())

        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                 for i, p in enumerate(pieces)], pa.binary())
        self.blank = self.b.piece_to_id("▁")
        # no merge crosses the border between a character that is not white space and a space, so texts can be cut there
        if any(BORDER.search(p.replace("▁", " ")) for p in pieces):
            raise ValueError("B has pieces with a character before a space")
        self.names = pa.array([f"{i}{end}" for n, ends in ((len(stands), ",|"), (len(pieces), ",;")) for i in range(n) for end in ends], pa.binary())

    def encode(self, segments: list[str]) -> tuple[pa.Array, pa.Array]:
        """Lists of A's and of B's ids; every segment begins with a space,
        which B adds by itself (but to an empty text)."""
        a = pa.array(map(self.a.encode_ordinary, segments), pa.list_(pa.int32()))
        b = self.b.encode([s[1:] for s in segments], num_threads=1)
        return a, pa.array([x or [self.blank] for x in b], pa.list_(pa.int32()))


def send_files(spark: SparkSession, path_a: str, path_b: str) -> Broadcast:
    """Both vocabulary files, as they are."""
    with open(path_a, "rb") as a, open(path_b, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def segments_of(text: str) -> list[str]:
    """A space and the text, cut before each space that follows a character
    that is not white space (nor taken for it by any tokenizer)."""
    words = text.split(" ")
    if text[0] != " " and not BLANKS.search(text):
        return [" " + w for w in words]
    out = [" " + words[0]]
    for w in words[1:]:
        if out[-1][-1].isspace():
            out[-1] += " " + w
        else:
            out.append(" " + w)
    return out


def in_a_row(values: pa.BinaryArray) -> tuple[bytes, np.ndarray]:
    """The values one after another, and where each begins and the last ends."""
    at = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int32)
    return (values.buffers()[2].to_pybytes()[at[0] : at[-1]] if at[-1] > at[0] else b""), at - at[0]


def joined(ids: pa.ListArray, stands: pa.Array) -> bytes:
    """The bytes of all tokens."""
    return in_a_row(stands.take(pc.list_flatten(ids)))[0]


def ends_of(ids: pa.ListArray, stands: pa.Array) -> pa.Table:
    """``segment``, ``end`` (bytes from the segment's begin) and ``token`` (place among all) of every token."""
    parent = pc.list_parent_indices(ids)
    size = pc.binary_length(stands.take(pc.list_flatten(ids))).cast(pa.int64())
    upto = pc.cumulative_sum(size)
    begin = np.concatenate([[0], upto.to_numpy()])[ids.offsets.to_numpy() - ids.offsets[0].as_py()]
    return pa.table({"segment": parent, "end": pc.subtract(upto, pa.array(begin).take(parent)), "token": pa.array(np.arange(len(size)))})


def links_of(a: pa.ListArray, b: pa.ListArray, stands_a: pa.Array, stands_b: pa.Array) -> pa.Table:
    """A row for each pair of tokens whose bytes overlap, in order: ``segment``,
    ``a`` and ``b`` (places of the tokens) and ``both`` (both end here). Both
    lists stand for the same bytes in each segment."""
    found = (ends_of(a, stands_a).rename_columns(["segment", "end", "a"])
             .join(ends_of(b, stands_b).rename_columns(["segment", "end", "b"]), ["segment", "end"], join_type="full outer", use_threads=False)
             .combine_chunks().sort_by([("segment", "ascending"), ("end", "ascending")]))
    both = pc.and_(pc.is_valid(found["a"]), pc.is_valid(found["b"]))
    return pa.table({"segment": found["segment"], "a": pc.fill_null_backward(found["a"]),
                     "b": pc.fill_null_backward(found["b"]), "both": both}).combine_chunks()


@dataclass
class Segments:
    """What is known of some segments. ``codes`` and ``weight`` list the
    different pairs of each, and how often they are linked in it."""

    valid: np.ndarray
    sizes: np.ndarray  # columns: A tokens, B tokens, groups, links
    shape: list[bytes]  # groups as text
    begins: np.ndarray  # of each segment in codes
    codes: np.ndarray
    weight: np.ndarray

    @classmethod
    def none(cls) -> Segments:
        return cls(np.zeros(0, bool), np.zeros((0, 4), np.int64), [], np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def plus(self, more: Segments) -> Segments:
        return Segments(np.concatenate([self.valid, more.valid]), np.concatenate([self.sizes, more.sizes]), self.shape + more.shape,
                        np.concatenate([self.begins, self.begins[-1] + more.begins[1:]]),
                        np.concatenate([self.codes, more.codes]), np.concatenate([self.weight, more.weight]))


def grouped(table: pa.Table, key: str, n: int) -> pa.Table:
    """The table's rows in order of ``key``, a number below n (``group_by`` keeps no order)."""
    return table.take(pa.array(np.argsort(table[key].to_numpy().astype(np.min_scalar_type(n)), kind="stable")))


def counted(parent: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(parent, minlength=n).astype(np.int64)


def shapes(links: pa.Table, ids_a: np.ndarray, ids_b: np.ndarray, n: int, names: pa.BinaryArray, size_a: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each segment. Each token's place among the
    names of all is its own number and that of the other side's tokens before it."""
    ends = np.nonzero(links["both"].to_numpy(zero_copy_only=False))[0]
    upto_a, upto_b = links["a"].to_numpy()[ends] + 1, links["b"].to_numpy()[ends] + 1  # of each group
    group_a, group_b = (np.repeat(np.arange(len(ends)), np.diff(x, prepend=0)) for x in (upto_a, upto_b))
    every_a, every_b = np.arange(len(ids_a)), np.arange(len(ids_b))
    which = np.zeros(len(ids_a) + len(ids_b), np.int64)
    which[every_a + np.concatenate([[0], upto_b])[group_a]] = 2 * ids_a + (every_a + 1 == upto_a[group_a])
    which[every_b + upto_a[group_b]] = 2 * (size_a + ids_b) + (every_b + 1 == upto_b[group_b])
    text, at = in_a_row(names.take(pa.array(which)))
    last = np.searchsorted(links["segment"].to_numpy()[ends], np.arange(1, n + 1))  # groups of all segments up to each
    cuts = at[np.concatenate([[0], (upto_a + upto_b)])[np.concatenate([[0], last])]].tolist()
    return [text[s : max(s, e - 1)] for s, e in itertools.pairwise(cuts)]


def analyse(encoders: Encoders, texts: list[str]) -> Segments:
    """Encodes and aligns segments. One whose bytes a tokenizer doesn't keep is not valid and has no links."""
    n = len(texts)
    a, b = encoders.encode(texts)
    want = [t.encode() for t in texts]
    whole = b"".join(want)
    valid = np.ones(n, bool)
    if joined(a, encoders.bytes_a) != whole or joined(b, encoders.bytes_b) != whole:
        valid = np.array([joined(a[i : i + 1], encoders.bytes_a) == w == joined(b[i : i + 1], encoders.bytes_b)
                          for i, w in enumerate(want)], bool)
        keep = pa.array(valid)
        a, b = (pc.if_else(keep, x, pa.scalar([], x.type)) for x in (a, b))
    links = links_of(a, b, encoders.bytes_a, encoders.bytes_b)
    ids_a, ids_b = pc.list_flatten(a).to_numpy(), pc.list_flatten(b).to_numpy()
    segment = links["segment"].to_numpy()
    code = ids_a[links["a"].to_numpy()].astype(np.int64) * len(encoders.bytes_b) + ids_b[links["b"].to_numpy()]
    pairs = pa.table({"segment": segment, "code": code}).group_by(["segment", "code"], use_threads=False).aggregate([([], "count_all")])
    pairs = grouped(pairs, "segment", n)
    sizes = np.stack([pc.list_value_length(a).to_numpy(), pc.list_value_length(b).to_numpy(),
                      counted(segment[links["both"].to_numpy(zero_copy_only=False)], n), counted(segment, n)], axis=1).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(counted(pairs["segment"].to_numpy(), n))])
    return Segments(valid, sizes, shapes(links, ids_a, ids_b, n, encoders.names, len(encoders.bytes_a)), begins, pairs["code"].to_numpy(), pairs["count_all"].to_numpy())


def ragged(begins: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lists ``which`` of a ragged array one after another, and their lengths."""
    size = begins[which + 1] - begins[which]
    first = np.repeat(begins[which] - (np.cumsum(size) - size), size)
    return first + np.arange(len(first)), size


class Aligner:
    """Aligns documents, and remembers segments from one slice to the next."""

    def __init__(self, encoders: Encoders):
        self.encoders, self.index, self.known = encoders, {}, Segments.none()

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], pa.Table]:
        """Of each text: its sizes (rows: A tokens, B tokens, groups, links) and
        the SHA-256 of its groups; and ``doc``, ``code``, ``weight`` of its different pairs."""
        if len(self.index) > KNOWN_SEGMENTS:
            self.index, self.known = {}, Segments.none()
        cut = [segments_of(t) if t else [] for t in texts]
        new = [s for s in dict.fromkeys(itertools.chain.from_iterable(cut)) if s not in self.index]
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.known = self.known.plus(analyse(self.encoders, new))
        known, n = self.known, len(texts)
        size = np.fromiter(map(len, cut), np.int64, n)
        at = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(cut)), np.int64, int(size.sum()))
        doc = np.repeat(np.arange(n), size)
        wrong = np.unique(doc[~known.valid[at]])
        digests = []
        for i, (e, k) in enumerate(zip(np.cumsum(size).tolist(), size.tolist(), strict=True)):
            digests.append(hashlib.sha256(b";".join([known.shape[j] for j in at[e - k : e].tolist()])).hexdigest() if k else "")
        for i in wrong.tolist():
            digests[i] = ""
        right = ~np.isin(doc, wrong)
        doc, at = doc[right], at[right]
        sizes = np.stack([np.bincount(doc, known.sizes[at, c], n).astype(np.int64) for c in range(4)], axis=1)
        # each document's different segments first, then their pairs
        each, times = np.unique(doc * len(self.index) + at, return_counts=True)
        doc, at = np.divmod(each, max(len(self.index), 1))
        place, length = ragged(known.begins, at)
        pairs = (pa.table({"doc": np.repeat(doc, length), "code": known.codes[place],
                           "weight": known.weight[place] * np.repeat(times, length)})
                 .group_by(["doc", "code"], use_threads=False).aggregate([("weight", "sum")]))
        return sizes, digests, grouped(pairs, "doc", n)


ALIGNED = ("doc_id long, chunk string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "codes array<long>, weights array<long>")
SIZES = ("n_a", "n_b", "n_groups", "n_links")


def lists(values: np.ndarray, begins: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(values, pa.int64()))


def _align(files: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Encoders(*files.value))
        chunk, held = uuid.uuid4().hex, 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                n = len(part)
                sizes, digests, pairs = aligner.documents(part.column("text").to_pylist())
                length = counted(pairs["doc"].to_numpy(), n)
                names = []
                for k in length.tolist():
                    if held and held + k > CHUNK_PAIRS:
                        chunk, held = uuid.uuid4().hex, 0
                    held += k
                    names.append(chunk)
                begins = np.concatenate([[0], np.cumsum(length)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), *(pa.array(sizes[:, c]) for c in range(4)),
                     pa.array(digests, pa.string()), lists(pairs["code"].to_numpy(), begins), lists(pairs["weight_sum"].to_numpy(), begins)],
                    ["doc_id", "chunk", *SIZES, "groups_sha256", "codes", "weights"])

    return run


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of each chunk a pair is linked; a document has it once in its list."""
    for batch in batches:
        for part in slices_of_lists(batch):
            codes = part.column("codes")
            chunk = part.column("chunk").take(pc.list_parent_indices(codes))
            n = (pa.table({"chunk": chunk.dictionary_encode(), "code": pc.list_flatten(codes)})
                 .group_by(["chunk", "code"], use_threads=False).aggregate([([], "count_all")]).combine_chunks())
            yield pa.RecordBatch.from_arrays(
                [n["chunk"].chunk(0).cast(pa.string()) if n.num_rows else pa.array([], pa.string()),
                 n["code"].combine_chunks().cast(pa.int64()), n["count_all"].combine_chunks().cast(pa.int64())], ["chunk", "code", "n"])


def slices_of_lists(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded size, one row at least."""
    upto = np.cumsum(pc.list_value_length(batch.column("codes")).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(upto):
        end = max(at + 1, int(np.searchsorted(upto, CHUNK_PAIRS + (upto[at - 1] if at else 0), "right")))
        yield batch.slice(at, end - at)
        at = end


def _score(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """``n_best`` and ``count_sum`` of a chunk's documents; ``counts`` has every pair of the chunk."""
    docs = docs.combine_chunks()
    n = len(docs)
    codes, weights = (docs.column(c).combine_chunks() for c in ("codes", "weights"))
    links = pa.table({"doc": pc.list_parent_indices(codes), "code": pc.list_flatten(codes), "weight": pc.list_flatten(weights)})
    found = links.join(counts.select(["code", "n", "best"]).combine_chunks(), "code", join_type="inner", use_threads=False)
    doc, weight = found["doc"].to_numpy(), found["weight"].to_numpy()
    total = np.zeros((2, n), np.int64)
    np.add.at(total[0], doc, weight * found["best"].to_numpy())
    np.add.at(total[1], doc, weight * found["n"].to_numpy())
    return docs.select(["doc_id", *SIZES, "groups_sha256"]).append_column("n_best", pa.array(total[0])).append_column("count_sum", pa.array(total[1]))


def align(docs: DataFrame, path_a: str = PATH_A, path_b: str = PATH_B) -> DataFrame:
    """Each row of ``docs`` (``doc_id``, ``text``; others are ignored), aligned
    and written: its sizes, ``groups_sha256``, and its different linked pairs
    (``codes``: A id times the size of B's vocabulary plus B id, with
    ``weights``), in chunks of bounded size. Texts null, empty, or not kept by
    a tokenizer have no tokens."""
    sent = send_files(docs.sparkSession, path_a, path_b)
    return materialize(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_align(sent), ALIGNED))


def pair_counts(aligned: DataFrame, size_b: int) -> tuple[DataFrame, DataFrame]:
    """(``chunk``, ``code``) of all chunks, and of each ``code`` in how many
    documents it is linked (``n``), and whether that is its A id's highest (``best``)."""
    chunks = materialize(aligned.select("chunk", "codes").mapInArrow(_partial_counts, "chunk string, code long, n long")
                         .groupBy("chunk", "code").agg(F.sum("n").alias("n")))
    total = materialize(chunks.groupBy("code").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"code div {size_b}")))
    highest = total.groupBy("a").agg(F.max("n").alias("most"))
    return chunks.select("chunk", "code"), total.join(highest, "a").select("code", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def alignment_report(docs: DataFrame, path_a: str = PATH_A, path_b: str = PATH_B) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best
    (links whose pair is its A id's most frequent, by documents), count_sum
    (the pairs' document counts over all links) and groups_sha256 ('' without
    tokens). Repeated rows are documents of their own; a null doc_id stays
    null; an empty table gives no rows."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    aligned = align(docs, path_a, path_b)
    chunks, total = pair_counts(aligned, size_b)
    counts = chunks.join(total, "code")
    return (aligned.groupBy("chunk").cogroup(counts.groupBy("chunk"))
            .applyInArrow(_score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                  "n_best long, count_sum long")
            .select("doc_id", *SIZES, "n_best", "count_sum", "groups_sha256"))
