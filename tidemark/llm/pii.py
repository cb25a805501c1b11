"""Personal data: patterns, and terms that give protected entities away.

Four patterns find e-mail addresses, IP addresses, card and phone numbers: the
protected entities. Masking them is not enough where the words beside them
name the same entity again and again. So the corpus is counted: in how many
different surroundings a term stands beside an entity (its support, so that one
copied passage isn't evidence of its own), in how many different texts it does,
and in how many different texts it occurs at all. Copies of a text count once
on either side, and so in all probabilities. A term reveals an entity by the
information log2(p(entity | term) / p(entity)) bits.
Terms that reveal one with at least ``MIN_GIVEN`` certainty and ``MIN_BITS``
bits on ``MIN_SUPPORT`` or more different surroundings are spans of their own
wherever they occur.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices, unused

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
BESIDE = 5  # words on either side of an entity
MIN_SUPPORT, MIN_GIVEN, MIN_BITS = 3, 0.5, 6.0
BLOCK_TERMS = 200_000  # terms sent to the executors at once, on average
SLICE_BYTES = 4_000_000

AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
WORD = re.compile(r"[^\W_]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping. Each ``@`` with a domain is taken with the
    run of local characters before it, back to the previous match: the same
    spans as the whole pattern gives, without trying it at every character."""
    end = 0
    for m in AT.finditer(text):
        start = m.start()
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time from the left of each run of dotted numbers; a
    group with a part over 255 is dropped, without another try inside it."""
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four patterns, by kind, then start (code points)."""
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in emails(text)]
    out += [("ip", s, e) for s, e in ips(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity(kind: str, value: str) -> str:
    """What is protected, however it is written."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else NOT_DIGIT.sub('', value)}"


def terms_in(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Words of three characters or more outside the taken spans, lower-cased."""
    busy = sorted((s, e) for _, s, e in taken)
    at = 0
    for m in WORD.finditer(text):
        s, e = m.span()
        while at < len(busy) and busy[at][1] <= s:
            at += 1
        if e - s >= 3 and not (at < len(busy) and busy[at][0] < e):
            yield m.group().lower(), s, e


def surroundings(text: str) -> Iterator[tuple[str, str, int]]:
    """(entity, term, hash of the words around the entity) for each entity."""
    spans = base_spans(text)
    if not spans:
        return
    words = list(terms_in(text, spans))
    starts = [s for _, s, _ in words]
    for kind, s, e in spans:
        i = bisect_left(starts, s)
        near = [w for w, _, _ in words[max(0, i - BESIDE) : i + BESIDE]]
        place = xxhash.xxh3_64_intdigest(" ".join(near)) - 2**63
        for w in set(near):
            yield entity(kind, text[s:e]), w, place


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, "text", SLICE_BYTES)


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        rows = [(*r, k) for t, k in zip(batch.column("text"), batch.column("key").to_pylist(), strict=True) for r in surroundings(t.as_py())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
            ["entity", "term", "place", "key"])


def _terms_of(terms: list[str]):
    """Places in ``terms`` of the words that each text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {t: i for i, t in enumerate(terms)}
        for batch in _parts(batches):
            keys, found = [], []
            for t, k in zip(batch.column("text"), batch.column("key").to_pylist(), strict=True):
                own = {index[w] for w in {w.lower() for w in WORD.findall(t.as_py())} if w in index}
                if own:
                    keys.append(k), found.append(sorted(own))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.list_(pa.int32()))], ["key", "found"])

    return run


def _texts_with(terms: list[str]):
    """How many of the texts have each of ``terms``; each text comes once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(terms), np.int64)
        for batch in batches:
            n += np.bincount(batch.column("found").flatten().to_numpy(), minlength=len(terms))
        there = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array([terms[i] for i in there], pa.string()), pa.array(n[there])], ["term", "docs"])

    return run


def _in_blocks(terms: DataFrame) -> Iterator[tuple[Broadcast, bool]]:
    """Different terms in blocks of bounded size: one at a time is fetched and
    sent out, and the flag tells the last. There is always one."""
    blocks = 1 + terms.count() // BLOCK_TERMS
    dealt = terms.select("term", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"))
    for i in range(blocks):
        own = sorted(r["term"] for r in dealt.where(F.col("block") == i).select("term").collect())
        yield terms.sparkSession.sparkContext.broadcast(own), i == blocks - 1


def revealing_terms(docs: DataFrame, min_support: int = MIN_SUPPORT, min_given: float = MIN_GIVEN,
                    min_bits: float = MIN_BITS) -> DataFrame:
    """``term``, ``given`` (the highest p(entity | term)) and ``bits`` of the
    terms over the thresholds, counted over all different texts of ``docs``."""
    texts = docs.where("text is not null").select("text", F.xxhash64("text").alias("key"))  # copies have one key
    pairs = (texts.mapInArrow(_surroundings, "entity string, term string, place long, key long")
             .groupBy("entity", "term").agg(F.countDistinct("place").alias("support"), F.countDistinct("key").alias("texts")))
    pairs = materialize(pairs.where(F.col("support") >= min_support))
    if not pairs.limit(1).count():
        return pairs.select("term", F.lit(0.0).alias("given"), F.lit(0.0).alias("bits"))
    counts = None
    for sent, _ in _in_blocks(pairs.select("term").distinct()):  # a pass each
        part = materialize(
            texts.mapInArrow(lambda batches, sent=sent: _terms_of(sent.value)(batches), "key long, found array<int>")
            .groupBy("key").agg(F.first("found").alias("found"))
            .mapInArrow(lambda batches, sent=sent: _texts_with(sent.value)(batches), "term string, docs long")
            .groupBy("term").agg(F.sum("docs").alias("docs")))
        sent.destroy()
        counts = part if counts is None else counts.union(part)
    # the entity itself is at least as frequent as any of its terms beside it
    total = texts.select("key").distinct().count()
    known = pairs.groupBy("entity").agg(F.max("texts").alias("entity_docs"))
    given = F.least(F.lit(1.0), F.col("texts") / F.col("docs"))
    return materialize(
        pairs.join(known, "entity").join(counts, "term")
        .select("term", given.alias("given"), F.log2(given * total / F.col("entity_docs")).alias("bits"))
        .where((F.col("given") >= min_given) & (F.col("bits") >= min_bits))
        .groupBy("term").agg(F.max("given").alias("given"), F.max("bits").alias("bits")))


SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"
ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with a mark of its kind in place of each span; spans that overlap the one before are covered by its mark."""
    out, at = [], 0
    for s, e, kind in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _spans(terms: list[str], column: str, first: bool, mask: bool):
    """Adds the spans of ``terms`` to ``column``; before the ``first`` the base
    spans. With ``mask`` the text is masked too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = frozenset(terms)
        for part in _parts(batches):
            spans, texts = [], []
            for scalar, old in zip(part.column("text"), part.column(column), strict=True):
                text = scalar.as_py()
                if text is None:
                    spans.append([]), texts.append(None)
                    continue
                had = base_spans(text) if first else [(x["kind"], x["start"], x["end"]) for x in old.as_py()]
                base = [x for x in had if x[0] != TERM]
                found = [x for x in had if x[0] == TERM]
                if wanted:
                    found += [(TERM, s, e) for w, s, e in terms_in(text, base) if w in wanted]
                spans.append(base + sorted(found))
                texts.append(masked(text, spans[-1]) if mask and spans[-1] else text)
            new = {column: pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], ARROW_SPAN)}
            if mask:
                new["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([new.get(n, part.column(n)) for n in part.schema.names], part.schema.names)

    return run


def find_spans(docs: DataFrame, terms: DataFrame, column: str = "spans", mask: bool = False) -> DataFrame:
    """``docs`` plus ``column`` (which they must not have): the base spans by
    kind, then the spans of ``terms``, each by start. Null text has none. With
    ``mask`` the text has its spans masked. One pass and one Python worker a
    task; each further block of terms is a pass of its own, written before the
    next, and its broadcast destroyed."""
    out = docs.withColumn(column, F.array().cast(SPAN_TYPE))
    schema, first = out.schema, True
    for sent, last in _in_blocks(terms.select("term").distinct()):
        out = out.mapInArrow(
            lambda batches, sent=sent, first=first, last=last: _spans(sent.value, column, first, mask and last)(batches), schema)
        if not last:
            out = materialize(out)
            sent.destroy()
        first = False
    return out


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the number of spans of each pattern, the
    sha256 of the base spans, and all spans as text. Null text counts as
    empty; very long texts are read whole; repeated rows get equal results."""
    own = docs.select("doc_id", "text")
    spanned = find_spans(own, revealing_terms(own))
    spans = F.col("spans")
    of = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda x: x["kind"] != TERM)
    return spanned.select("doc_id", *map(of, KINDS), F.sha2(_digest(base), 256).alias("base_sha256"), _digest(spans).alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` generalised to its kind, such as
    ``[EMAIL]`` or ``[TERM]``; all else, and all other columns, as they are,
    whatever their names."""
    column = unused(docs, "spans")
    return find_spans(docs, revealing_terms(docs), column, mask=True).drop(column)
