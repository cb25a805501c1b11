"""Sampled SentencePiece segmentations: forward filtering, backward sampling.

A text's spaces become U+2581, one more goes before the text, and the result
is cut into segments that no multi-character piece crosses (leading U+2581
with the characters up to the next; line breaks apart). A segment's lattice
holds every piece that matches at every place. A segmentation is drawn with
probability proportional to exp(alpha * sum of piece scores): forward
filtering sums the weights of all segmentations up to each place, backward
sampling draws the last piece, then the one before it, and so on. Characters
outside the vocabulary are their UTF-8 byte pieces, and so is U+2581 where the
text itself has it; so decoding gives back exactly the text.

Lattices are built once for each distinct segment of a batch, all segments of
one length together, as arrays; draws run for all segments of a batch at once.
Draws are a hash of (seed, row key, place in the text), so a row's
segmentation depends on nothing but the row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, received, send

SPACE = "▁"
SEGMENT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
EXACT = 32  # segments up to this length share arrays with their like; longer ones with those up to a quarter longer
PLACES_AT_ONCE = 50_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
CHARS_AT_ONCE = 1_500_000
SLOTS = 1 << 19
#: Stands for U+2581 where the text has it: a lone surrogate, which no text holds.
LITERAL = "\ud800"


class Pieces:
    """A vocabulary: pieces by the hash of their code points, and byte pieces."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], alpha: float):
        self.pieces, self.byte_ids = pieces, np.array(byte_ids, np.int64)
        self.alpha = alpha
        ids = [i for i, p in enumerate(pieces) if p]
        crossing = [pieces[i] for i in ids if SPACE in pieces[i].lstrip(SPACE) or "\n" in pieces[i]]
        if crossing:
            raise ValueError(f"pieces cross segments: {crossing[:3]}")
        self.longest = max(len(pieces[i]) for i in ids)
        keys = np.array([self.hash_of(pieces[i]) for i in ids], np.uint64)
        # single characters keep a finite weight, whatever the model says of them
        low = min(s for s in scores if s > -1e8)
        self.weight = np.append(np.exp(alpha * np.maximum(np.array(scores), low)), 0.0)  # [-1]: no piece
        self.byte_weight = float(np.exp(alpha * low))
        self._tables(keys, np.array(ids, np.int32))

    @staticmethod
    def hash_of(piece: str) -> int:
        out = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in piece:
                out = out * FACTOR + np.uint64(ord(c) + 1)
        return int(out)

    def _tables(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """A direct-address table by bits of the hash, and sorted arrays of the
        keys whose slot another one has."""
        slot = self._slot(keys)
        _, first = np.unique(slot, return_index=True)
        self.key, self.piece = np.zeros(SLOTS, np.uint64), np.full(SLOTS, -1, np.int32)
        self.key[slot[first]], self.piece[slot[first]] = keys[first], ids[first]
        rest = np.ones(len(keys), bool)
        rest[first] = False
        self.shared = np.zeros(SLOTS, bool)
        self.shared[slot[rest]] = True
        order = np.argsort(keys[rest])
        self.rest_key, self.rest_piece = keys[rest][order], ids[rest][order]

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(45)).view(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece id of each hash, or -1."""
        slot = self._slot(hashes)
        out = self.piece[slot]
        out[self.key[slot] != hashes] = -1
        again = np.nonzero(self.shared[slot] & (out < 0))
        if len(again[0]):
            wanted = hashes[again]
            at = np.minimum(np.searchsorted(self.rest_key, wanted), len(self.rest_key) - 1)
            out[again] = np.where(self.rest_key[at] == wanted, self.rest_piece[at], -1)
        return out

    def lattices(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of segments of one length (rows of code points): for each place and
        piece length, the piece that ends there (id, or -1; length 1 without a
        piece: -2, bytes) and the cumulative probability of drawing it or a
        shorter one. Returns (ids, cumulative), shapes (rows, places, lengths)."""
        rows, n = codes.shape
        most = min(self.longest, n)
        prefix = np.zeros((rows, n + 1), np.uint64)
        powers = np.ones(most + 1, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                prefix[:, i + 1] = prefix[:, i] * FACTOR + (codes[:, i].astype(np.uint64) + np.uint64(1))
            for i in range(most):
                powers[i + 1] = powers[i] * FACTOR
            ids = np.full((rows, n, most), -1, np.int32)
            for k in range(1, most + 1):
                ids[:, k - 1 :, k - 1] = self.find(prefix[:, k:] - prefix[:, : n + 1 - k] * powers[k])
        lone = ids[:, :, 0]
        missing = lone < 0
        weight = self.weight[ids]
        if missing.any():
            lone[missing] = -2
            weight[:, :, 0][missing] = self.byte_weight ** utf8_length(codes[missing])
        total = np.zeros((rows, n + 1))
        total[:, 0] = 1.0
        cumulative = np.empty((rows, n, most), np.float32)
        for end in range(1, n + 1):
            k = min(most, end)
            c = np.cumsum(weight[:, end - 1, :k] * total[:, end - k : end][:, ::-1], axis=1)
            total[:, end] = c[:, -1]
            cumulative[:, end - 1, :k] = c / c[:, -1:]
            cumulative[:, end - 1, k:] = 2.0
            if n > EXACT:  # only ratios within the longest piece matter: lift what gets too small
                small = total[:, end] < 1e-150
                if small.any():
                    total[small, max(0, end - most) : end + 1] *= 1e150
        return ids, cumulative


def utf8_length(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < 0x80, 1, np.where(codes < 0x800, 2, np.where(codes < 0x10000, 3, 4)))


def utf8_byte(codes: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
    """Byte ``i`` (below ``length``) of each code point's UTF-8."""
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[length]
    low = codes >> (6 * (length - 1 - i))
    return np.where(i == 0, lead | low, 0x80 | (low & 0x3F))


def segments_of(text: str) -> list[str]:
    if not text:
        return []
    return SEGMENT.findall(SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE))


def width_of(lengths: np.ndarray) -> np.ndarray:
    """Array width for segments of these lengths."""
    steps = np.ceil(np.log(np.maximum(lengths, EXACT) / EXACT) / np.log(1.25) - 1e-9)
    return np.where(lengths <= EXACT, lengths, np.ceil(EXACT * 1.25**steps)).astype(np.int64)


def code_points(rows: list[str], width: int) -> np.ndarray:
    """One row of code points for each segment, filled up with zeros."""
    joined = "".join(x if len(x) == width else x.ljust(width, "\0") for x in rows)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(rows), width)
    return codes.astype(np.int64)


def draws(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Uniform in [0, 1) from the row's key and the place in its text."""
    with np.errstate(over="ignore"):
        return (mix(key + place.astype(np.uint64) * FACTOR) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)


def sample(vocabulary: Pieces, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts one after another, and where each text begins."""
    own = [segments_of(t) for t in texts]
    count = np.fromiter(map(len, own), np.int64, len(own))
    flat = list(chain.from_iterable(own))
    if not flat:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    distinct = list(dict.fromkeys(flat))
    segment = np.fromiter(map(dict(zip(distinct, range(len(distinct)), strict=True)).__getitem__, flat), np.int64, len(flat))
    length = np.fromiter(map(len, distinct), np.int64, len(distinct))
    width = width_of(length)
    order = np.argsort(width, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by = np.argsort(rank[segment], kind="stable")
    ranked = rank[segment][by]
    start = np.concatenate([[0], np.cumsum(length[segment])])  # place of each occurrence, counted through all texts
    first = np.concatenate([[0], np.cumsum(count)])
    with np.errstate(over="ignore"):  # what an occurrence's draws start from: the row's key and the place in its text
        state = np.repeat(keys, count) + (start[:-1] - np.repeat(start[first[:-1]], count)).astype(np.uint64) * FACTOR
    pieces = np.zeros(len(segment), np.int64)
    drawn: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # occurrence, pieces after it, id

    at = 0
    while at < len(order):
        wide = int(width[order[at]])
        upto = min(at + max(1, PLACES_AT_ONCE // wide), int(np.searchsorted(width[order], wide, "right")))
        rows = order[at:upto]
        codes = code_points([distinct[r] for r in rows], wide)
        ids, cumulative = vocabulary.lattices(codes)
        most = ids.shape[2]
        ids, cumulative = ids.reshape(-1, most), cumulative.reshape(-1, most)
        low, high = np.searchsorted(ranked, [at, upto])
        occ, row = by[low:high], ranked[low:high] - at
        end, own_state, after = length[rows][row], state[by[low:high]], np.zeros(high - low, np.int64)
        while len(occ):
            node = row * wide + end - 1
            k = (cumulative[node] <= draws(own_state, end)[:, None]).sum(axis=1)
            piece = ids[node, k]
            lone = piece == -2
            if lone.any():
                code = codes[row[lone], end[lone] - 1]
                code = np.where(code == ord(LITERAL), ord(SPACE), code)
                n = utf8_length(code)
                for i in range(int(n.max())):
                    has = n > i
                    byte = utf8_byte(code[has], n[has], i)
                    drawn.append((occ[lone][has], after[lone][has] + n[has] - 1 - i, vocabulary.byte_ids[byte]))
                drawn.append((occ[~lone], after[~lone], piece[~lone]))
                after = after + 1
                after[lone] += n - 1
            else:
                drawn.append((occ, after, piece))
                after = after + 1
            end = end - k - 1
            on = end > 0
            if not on.all():
                pieces[occ[~on]] = after[~on]
                occ, row, end, own_state, after = occ[on], row[on], end[on], own_state[on], after[on]
        at = upto

    last = np.cumsum(pieces)
    out = np.empty(int(last[-1]), np.int32)
    for occ, after, piece in drawn:
        out[last[occ] - 1 - after] = piece
    return out, np.concatenate([[0], last])[first]


def row_keys(ids: list[int | None], seed: int) -> np.ndarray:
    own = np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        return mix(mix(own) + np.uint64(seed) * FACTOR)


def _sampled(vocabulary: Pieces, seed: int, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list, np.ndarray, np.ndarray]]:
    """The batch in parts of bounded size, each with its texts, all their piece
    ids and where each text's begin."""
    texts = batch.column("text")
    keys = row_keys(batch.column("doc_id").to_pylist(), seed)
    size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy()
    at = 0
    while at < len(texts):
        upto, chars = at + 1, size[at]
        while upto < len(texts) and chars + size[upto] <= CHARS_AT_ONCE:
            chars += size[upto]
            upto += 1
        part = batch.slice(at, upto - at)
        own = part.column("text").to_pylist()
        ids, begins = sample(vocabulary, [t or "" for t in own], keys[at:upto])
        yield part, own, ids, begins
        at = upto


def _lists(texts: list[str | None], ids: np.ndarray, begins: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids), mask=pa.array([t is None for t in texts]))


def _encode(vocabulary: Pieces, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for part, texts, ids, begins in _sampled(vocabulary, seed, batch):
                own = _lists(texts, ids, begins)
                yield pa.RecordBatch.from_arrays([own if n == IDS else part.column(n) for n in names], names)

    return run


def _report(vocabulary: Pieces, stands: list[bytes], seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts, ids, begins in _sampled(vocabulary, seed, batch):
                back = [decode_ids(ids[a:b].tolist(), stands) for a, b in pairwise(begins.tolist())]
                same = [(t or "") == b for t, b in zip(texts, back, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(begins)), _lists(texts, ids, begins), pa.array(same)],
                    ["doc_id", "n_pieces", "piece_ids", "lossless"])

    return run


IDS, PATH = "__piece_ids", "/opt/tokenizers/piece_bpe_32k.model"


def load(path: str = PATH, alpha: float = 0.0002) -> tuple[Pieces, list[bytes]]:
    """The model's pieces, and the bytes that each id stands for in a text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    of_byte = {int(model.id_to_piece(i)[3:5], 16): i for i in every if model.is_byte(i)}
    if len(of_byte) < 256:
        raise ValueError("the model has no byte pieces")
    plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in every]
    pieces = [model.id_to_piece(i) if plain[i] else "" for i in every]
    stands = [p.replace(SPACE, " ").encode() for p in pieces]
    for byte, i in of_byte.items():
        stands[i] = bytes([byte])
    return Pieces(pieces, [model.get_score(i) for i in every], [of_byte[b] for b in range(256)], alpha), stands


def encode(docs: DataFrame, path: str = PATH, alpha: float = 0.0002, seed: int = 0) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, any others) plus ``piece_ids``
    (array<int>): a segmentation of the whole text drawn for the row's doc_id.
    Empty text gives no pieces, null text null; a null doc_id draws as 0;
    repeated rows get equal pieces. ``docs``' own ``piece_ids`` is replaced.
    The vocabulary is the broadcast: its size is the model's, not the data's."""
    sent = send(docs.sparkSession, load(path, alpha)[0])
    out = docs.drop("piece_ids").withColumn(IDS, F.lit(None).cast("array<int>"))
    return (out.mapInArrow(lambda batches: _encode(received(sent), seed)(batches), out.schema)
            .withColumnRenamed(IDS, "piece_ids"))


def decode_ids(ids: list[int], stands: list[bytes]) -> str:
    return b"".join(map(stands.__getitem__, ids)).decode("utf-8", "replace")[1:]


def decode(coded: DataFrame, path: str = PATH) -> DataFrame:
    """``coded`` plus ``decoded``, the text of ``piece_ids``; null for null."""
    stands = load(path)[1]
    sent = coded.sparkSession.sparkContext.broadcast(stands)
    out = coded.drop("decoded").withColumn("decoded", F.lit(None).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = [None if x is None else decode_ids(x, sent.value) for x in map(_as_list, batch.column("piece_ids"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "decoded" else batch.column(n) for n in names], names)

    return out.mapInArrow(run, out.schema)


def _as_list(ids: pa.ListScalar) -> list[int] | None:
    return ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else None


def pieces_report(docs: DataFrame, path: str = PATH, alpha: float = 0.0002, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, n_pieces, piece_ids (as :func:`encode`
    draws them; null for null), and whether decoding them gives back the text
    (``lossless``; true for null)."""
    sent = send(docs.sparkSession, load(path, alpha))
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _report(*received(sent), seed)(batches),
        "doc_id long, n_pieces long, piece_ids array<int>, lossless boolean")
