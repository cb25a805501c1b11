"""Language identification by prediction by partial matching over bytes.

Each language has a context tree over bytes: after the three bytes before it,
a byte is predicted from what followed them in the language's training text;
one that never did is reached by an escape to the two bytes before it, and so
on down to a uniform choice. The escape probability is t / (n + t) (t different
bytes seen n times in a context), and a shorter context's prediction is spread
over the bytes that the longer one has not seen, so each prediction sums to 1.
After training the statistics are frozen: a text's code length in a language
is the exact sum of -log2 of these predictions, and the language with the
shortest code is predicted.

The trees are trained on a bounded sample of labelled rows. Copies are dropped
first, texts are cut into pieces of at most ``PIECE_BYTES``, and each language
takes its pieces in the order of a hash until it has ``TRAIN_BYTES`` or all of
its text: every language with text has at least one piece, and none has more
than a piece over the bound. Every text is scored whole.

The trees tell 64 symbols apart: the 63 commonest bytes of the training text,
and all other bytes together, each of these at the same cost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_remainder, materialize, received, send, utf8

TRAIN_BYTES = 500_000  # bytes of training text for each language
PIECE_BYTES = 8_192  # longer texts are drawn in pieces
SYMBOLS = 64  # the 63 commonest bytes, and one symbol for all others
AT_ONCE = 1 << 20  # bytes of one text scored in a go
LETTER, ASCII_LETTER = re.compile(r"[^\W\d_]"), re.compile(rb"[A-Za-z]")
PAD = b"\n\n\n"


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text) or LETTER.search(text.decode("utf-8", "replace")))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every three bytes with the byte after them, by language.
    ``text`` has the three bytes before it in front."""
    for batch in batches:
        langs, grams, counts = [], [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            raw = np.frombuffer(text.as_py(), np.uint8).astype(np.int64)
            codes, n = np.unique((raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:], return_counts=True)
            langs += [lang] * len(codes)
            grams.append(codes), counts.append(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(np.concatenate(grams or [np.zeros(0, np.int64)])),
             pa.array(np.concatenate(counts or [np.zeros(0, np.int64)]))], ["lang", "gram", "n"])


def training_sample(labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """``lang`` and ``text`` of the drawn pieces of ``labelled`` (``text``,
    ``lang``; no nulls), each with the three bytes before it."""
    size = F.octet_length("text")
    keyed = labelled.select("lang", "text", F.xxhash64("text").alias("key"))  # copies have one key
    texts = materialize(keyed.groupBy("lang", "key").agg(F.max(size).cast("long").alias("bytes")))
    last = F.greatest(F.lit(0), F.ceil(F.col("bytes") / PIECE_BYTES) - 1).cast("int")
    pieces = (texts.select("lang", "key", "bytes", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
              .select("lang", "key", "piece", F.least(F.lit(PIECE_BYTES), F.col("bytes") - F.col("piece").cast("long") * PIECE_BYTES).alias("n"),
                      F.shiftrightunsigned(F.xxhash64("key", "piece"), 1).alias("place")))
    # places by their number of bits: up to the one that reaches the bound there are about twice as many bytes at most
    pieces = pieces.withColumn("level", F.length(F.bin("place")))
    upto = Window.partitionBy("lang").orderBy("level")  # at most 63 rows for each language
    levels = (pieces.groupBy("lang", "level").agg(F.sum("n").alias("n")).withColumn("n", F.sum("n").over(upto))
              .groupBy("lang").agg(F.coalesce(F.min(F.when(F.col("n") >= train_bytes, F.col("level"))), F.lit(64)).alias("cut")))
    before = Window.partitionBy("lang").orderBy("place", "key", "piece").rowsBetween(Window.unboundedPreceding, -1)
    drawn = (pieces.join(F.broadcast(levels), "lang").where("level <= cut")
             .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < train_bytes)
             .groupBy("lang", "key").agg(F.collect_list("piece").alias("pieces")))
    whole = F.concat(F.lit(PAD), utf8(F.col("text")))
    return (keyed.join(F.broadcast(drawn), ["lang", "key"]).select("lang", "key", "text", F.explode("pieces").alias("piece"))
            .select("lang", "key", "piece", F.substring(whole, F.col("piece") * PIECE_BYTES + 1, F.lit(PIECE_BYTES + len(PAD))).alias("text"))
            .dropDuplicates(["lang", "key", "piece"]).select("lang", "text"))


def training_counts(labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """(grams, counts) of each language, from the bounded sample of
    ``labelled`` (``text``, ``lang``; no nulls)."""
    sample = training_sample(labelled, train_bytes)
    rows = (sample.mapInArrow(_grams, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    lang, gram, n = (np.array(rows.column(c).to_pylist()) for c in ("lang", "gram", "n"))
    return {str(x): (gram[lang == x].astype(np.int64), n[lang == x].astype(np.int64)) for x in sorted(set(lang.tolist()))}


class ContextTrees:
    """Frozen code lengths of every language for every context and byte."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        seen = np.zeros(256)
        for gram, n in counts.values():
            np.add.at(seen, gram & 255, n)
        common = np.argsort(-seen, kind="stable")[: SYMBOLS - 1]
        self.symbol = np.full(256, SYMBOLS - 1, np.int32)
        self.symbol[common] = np.arange(len(common))
        coded = {x: (self._code(gram), n) for x, (gram, n) in counts.items()}
        # rows of the table: every context of two symbols, then each of three that any language has seen
        deep = np.unique(np.concatenate([g >> 6 for g, _ in coded.values()] or [np.zeros(0, np.int64)]))
        self.row = (np.arange(SYMBOLS**3) & (SYMBOLS**2 - 1)).astype(np.int32)
        self.row[deep] = SYMBOLS**2 + np.arange(len(deep))
        self.bits = np.stack([self._lengths(*coded[x], deep) for x in self.langs], axis=-1).reshape(-1, max(1, len(self.langs))) if coded else None

    def _code(self, gram: np.ndarray) -> np.ndarray:
        s = self.symbol.astype(np.int64)
        return (s[gram >> 24 & 255] << 18) | (s[gram >> 16 & 255] << 12) | (s[gram >> 8 & 255] << 6) | s[gram & 255]

    @staticmethod
    def _lengths(code: np.ndarray, n: np.ndarray, deep: np.ndarray) -> np.ndarray:
        """-log2 of the prediction, for each row of the table and symbol."""
        p = np.full((1, SYMBOLS), 1 / SYMBOLS)
        for order in range(3):
            k = SYMBOLS**order
            count = np.bincount(code & (k * SYMBOLS - 1), n, k * SYMBOLS).reshape(k, SYMBOLS)
            shorter = p[np.arange(k) % len(p)]
            p = predict(count, shorter)
        count = np.zeros((len(deep), SYMBOLS))
        np.add.at(count, (np.searchsorted(deep, code >> 6), code & 63), n)
        p = np.concatenate([p, predict(count, p[deep & (SYMBOLS**2 - 1)])])
        bits = -np.log2(p)
        bits[:, SYMBOLS - 1] += np.log2(256 - (SYMBOLS - 1))  # which of the other bytes
        return bits.astype(np.float32)

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Bits of the whole text in each language."""
        total = np.zeros(len(self.langs))
        last = self.symbol[np.frombuffer(PAD, np.uint8)]
        for at in range(0, len(text), AT_ONCE):
            s = np.concatenate([last, self.symbol[np.frombuffer(text[at : at + AT_ONCE], np.uint8)]])
            context = (s[:-3] << 12) | (s[1:-2] << 6) | s[2:-1]
            total += self.bits[self.row[context] * SYMBOLS + s[3:]].sum(axis=0, dtype=np.float64)
            last = s[-3:]
        return total


def predict(count: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Predictions of contexts (rows) from their counts and the predictions of
    the contexts one byte shorter."""
    n, t = count.sum(axis=1, keepdims=True), (count > 0).sum(axis=1, keepdims=True)
    unseen = np.where(count > 0, 0.0, shorter)
    left = unseen.sum(axis=1, keepdims=True)
    escape = np.where(left > 0, t, 0) / np.maximum(n + np.where(left > 0, t, 0), 1)
    direct = count / np.maximum(n, 1) * (1 - escape)
    return np.where(n > 0, direct + escape * unseen / np.where(left > 0, left, 1), shorter)


def _predict(trees: ContextTrees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                raw = text.as_py() or b""
                if not trees.langs or not has_letter(raw):
                    langs.append("und"), scores.append(0.0)
                    continue
                bits = trees.code_lengths(raw)
                best = int(bits.argmin())
                langs.append(trees.langs[best])
                scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """``docs``' columns but ``text``, plus ``lang_pred`` and ``score``: the
    language with the shortest code for the whole text, and its probability if
    all languages are equally likely beforehand. Text that is null or has no
    letter, and any text if there is nothing to learn from, is ``und`` with
    score 0. Among equal codes the first name wins."""
    known = labelled.where("text is not null and lang is not null and text != ''").select("text", "lang")
    sent = send(docs.sparkSession, ContextTrees(training_counts(known, train_bytes)))
    rows = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("binary"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(lambda batches: _predict(received(sent))(batches), f"{schema}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return crc_remainder(doc_id, 4) == 2


def language_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Only rows that
    aren't held out are learnt from; a null doc_id isn't held out."""
    own = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(own, docs.where(~held_out(F.col("doc_id"))))
