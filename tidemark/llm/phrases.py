"""Phrase collocations, counted with double-array tries.

Counting every phrase of a corpus by its text would shuffle all of them, and
nearly all occur once or twice. So candidates are narrowed level by level, by
tests that can only keep too much (Apriori: a phrase is no more frequent than
any of its parts):

0. texts are cut into words once, and written as places in lists of words;
1. words are counted exactly; frequent ones set a bit in a bitmap of hashes;
2. pairs of words that have both bits are counted by a 64-bit hash of the pair,
   and one row that has it is noted; frequent hashes set bits in a second bitmap;
3. triples whose two pairs have bits there are counted by hash likewise;
4. each row gives the texts of the frequent hashes that were noted with it, so
   each leaves one task only: the candidates, among them all frequent phrases.

The candidates are dealt by hash into blocks of bounded size. A task builds a
block's trie as a double array: the child of state s for word w is place
base[s] + w, and it is one if check[base[s] + w] is s. The texts are read once
more, however many blocks there are: each task deals the different phrases that
may be wanted, with how often it has them, to the blocks of their hashes, in one
row of words for each block. There numpy moves the states of all of them from
level to level at once and counts the accepting states with bincount. These
counts are exact; hashes only chose what to count, and where.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix, slices, utf8, word_hashes

MIN_COUNT, LONGEST, TOP = 10, 3, 2000
SLICE_BYTES, ROWS_A_FILE = 4_000_000, 4  # text in a row of word places, and rows that a task reads at once
HELD = 1_000_000  # hashes, candidates, words or states reached that a task holds before it goes on with them together
FILES_A_TASK = 4  # times as much as Spark would give a task: what several rows share leaves it once
#: Bits of a bitmap for each hash that it holds, and its largest size (32 MB); a full one only keeps more candidates.
BITS_EACH, MOST_BITS = 128, 1 << 28
BLOCK_PHRASES = 100_000  # of a trie, on average
ROWS_A_PART = 192  # rows of words whose phrases a task counts with one trie, if they were all of its block
SEGMENT = 4096  # bytes of a bitmap that leave for the driver in one row
ROOM, TRIES = 2, 40  # places of a trie's array for each state; rounds of tries for a state's children
SALTS = 32  # groups of a language's phrases in which the first are looked for before the last sort

BOUND = b"\xff"  # between pieces; no UTF-8 text has this byte
FOLD = bytes(0xFF if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The words of some texts in a row: places among the different ``words``
    (or among their ``hashes``), -1 between pieces. ``row`` is the row's number,
    ``own`` the hashes of the phrases whose texts it gives. With ``times``,
    ``at`` is phrases of ``LONGEST`` places, -1 after shorter ones, that stand
    so often in the texts."""

    at: np.ndarray
    words: pa.StringArray | None = None
    hashes: np.ndarray | None = None
    row: int = 0
    own: np.ndarray | None = None
    times: np.ndarray | None = None

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        flat = BOUND.join(t.translate(FOLD) for t in texts).replace(BOUND, b" \xff ").split()
        words = dict.fromkeys(flat)
        words.pop(BOUND, None)
        index = dict(zip(words, range(len(words)), strict=True))
        at = np.fromiter(map(index.get, flat, repeat(-1)), np.int64, len(flat))
        return cls(at, pa.array(list(words), pa.binary()).cast(pa.string()), word_hashes(list(words)))

    def in_place(self, lang: str) -> np.ndarray:
        """A hash of (language, word) at each place; 0 between pieces."""
        own = mix(self.hashes ^ np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), 1)))
        return np.where(self.at >= 0, own[self.at], 0) if len(own) else np.zeros(0, np.uint64)


def longer(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of all their words but the last, and of the last."""
    with np.errstate(over="ignore"):
        return mix(begins * MULTIPLY + ends)


TOKENS = "lang string, words array<string>, hashes array<long>, n array<int>, at array<int>"


def one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts, some MB at a time, a row for each language in them."""
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            texts: dict[str, list[bytes]] = defaultdict(list)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                texts[lang].append(text)
            for lang, own in texts.items():
                words = Words.of(own)
                if len(words.words):
                    n = np.bincount(words.at[words.at >= 0], minlength=len(words.words)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang], pa.string()), one_list(words.words), one_list(pa.array(words.hashes.view(np.int64))),
                         one_list(pa.array(n)), one_list(pa.array(words.at.astype(np.int32)))], ["lang", "words", "hashes", "n", "at"])


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """The rows of :func:`_tokens`, one after another, with the columns that were read."""
    for batch in batches:
        for i in range(len(batch)):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            yield row["lang"].as_py(), Words(
                row["at"].values.to_numpy().astype(np.int64), row["words"].values if "words" in row else None,
                row["hashes"].values.to_numpy().view(np.uint64) if "hashes" in row else None,
                row["row"].as_py() if "row" in row else 0,
                row["own"].values.to_numpy().view(np.uint64) if "own" in row else None,
                row["times"].values.to_numpy() if "times" in row else None)
        pa.default_memory_pool().release_unused()


def has_bit(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def pairs(words: Words, lang: str, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pairs at each place, and where both words may be frequent."""
    own = words.in_place(lang)
    likely = (words.at >= 0) & has_bit(bitmap, own)
    return longer(own[:-1], own[1:]), likely[:-1] & likely[1:]


def triples(words: Words, lang: str, bitmap: np.ndarray, of_pairs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes of pairs and triples, and where they can be frequent."""
    two, may = pairs(words, lang, bitmap)
    may &= has_bit(of_pairs, two)
    return two, may, longer(two[:-1], words.in_place(lang)[2:]), may[:-1] & may[1:]


def summed(held: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
    """Different hashes, their counts, and one row that has each, from those of several rows."""
    hashes, n = (np.concatenate([x[i] for x in held]) for i in range(2))
    row = np.repeat([x[2] for x in held], [len(x[0]) for x in held])
    order = np.argsort(hashes)
    hashes, n, row = hashes[order], n[order], row[order]
    begin = np.nonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])[0]
    total = np.add.reduceat(n, begin) if len(begin) else n
    return pa.RecordBatch.from_arrays([pa.array(hashes[begin].view(np.int64)), pa.array(total), pa.array(row[begin], pa.int64())], ["h", "n", "row"])


def _count_hashes(sent: list[Broadcast]):
    """Hashes of pairs, or of triples if a bitmap of pairs is sent too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, of_pairs = sent[0].value, sent[1].value if len(sent) > 1 else None
        held, size = [], 0
        for lang, words in by_language(batches):
            if len(words.at) < 2:
                continue
            hashes, may = pairs(words, lang, bitmap) if of_pairs is None else triples(words, lang, bitmap, of_pairs)[2:]
            held.append((*np.unique(hashes[may], return_counts=True), words.row))
            size += len(held[-1][0])
            if size > HELD:
                yield summed(held)
                held, size = [], 0
        if held:
            yield summed(held)

    return run


def _candidates(sent: list[Broadcast]):
    """The texts of each row's own hashes, from the first place that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, of_pairs, of_triples = (x.value for x in sent)
        for lang, words in by_language(batches):
            own = np.sort(words.own)
            words.hashes = word_hashes(words.words.cast(pa.binary()).to_pylist())
            two, may, three, may3 = triples(words, lang, bitmap, of_pairs)
            may3 = may3 & has_bit(of_triples, three)
            for length, hashes, there in ((2, two, may), (3, three, may3)):
                place = np.nonzero(there)[0]
                found = hashes[place]
                mine = own[np.minimum(np.searchsorted(own, found), len(own) - 1)] == found
                place = place[mine][np.unique(found[mine], return_index=True)[1]]
                parts = [words.words.take(pa.array(words.at[place + i])) for i in range(length)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(place), np.int64))),
                     pc.binary_join_element_wise(*parts, " ")], ["lang", "phrase"])

    return run


def _places(hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int):
    """Which bytes of the bitmap's segments some hashes set, and to what."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.unique(hashes(batch) & np.uint64(bits - 1))
            byte, first = np.unique(place >> np.uint64(3), return_index=True)
            bit = np.uint64(1) << (place & np.uint64(7))
            value = np.bitwise_or.reduceat(bit, first) if len(first) else bit
            segment, byte = np.divmod(byte.astype(np.int64), SEGMENT)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (segment, byte, value)], ["segment", "byte", "value"])

    return run


def _segments(key: tuple, rows: pa.Table) -> pa.Table:
    out = np.zeros(SEGMENT, np.uint8)
    np.bitwise_or.at(out, rows.column("byte").to_numpy(), rows.column("value").to_numpy().astype(np.uint8))
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([out.tobytes()], pa.binary())})


def word_rows(batch: pa.RecordBatch) -> np.ndarray:
    """The hashes of (language, word) rows, as :meth:`Words.in_place` has them."""
    langs = batch.column("lang").to_pylist()
    of = {x: xxhash.xxh3_64_intdigest(x.encode(), 1) for x in set(langs)}
    own = word_hashes([w.encode() for w in batch.column("phrase").to_pylist()])
    return mix(own ^ np.fromiter(map(of.__getitem__, langs), np.uint64, len(langs)))


def phrase_rows(batch: pa.RecordBatch) -> np.ndarray:
    """The hashes of (language, phrase) rows, as :func:`longer` makes them of their words'."""
    parts = pc.split_pattern(batch.column("phrase"), " ")
    length = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    words, langs = pc.list_flatten(parts).dictionary_encode(), batch.column("lang").dictionary_encode()
    of = np.array([xxhash.xxh3_64_intdigest(x.encode(), 1) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy()]
    own = word_hashes([w.encode() for w in words.dictionary.to_pylist()])[words.indices.to_numpy()]
    own = mix(own ^ np.repeat(of, length))
    begin = np.cumsum(length) - length
    out = own[begin]
    for level in range(1, int(length.max(initial=0))):
        there = np.nonzero(length > level)[0]
        out[there] = longer(out[there], own[begin[there] + level])
    return out


def hash_rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("h").to_numpy().view(np.uint64)


def bitmap_of(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """A bitmap of the rows' hashes, of bounded size whatever their number."""
    bits = 1 << 16
    while bits < min(MOST_BITS, BITS_EACH * rows.count()):
        bits *= 2
    made = (rows.mapInArrow(lambda batches: _places(hashes, bits)(batches), "segment int, byte int, value int")
            .groupBy("segment").applyInArrow(_segments, "segment int, bits binary").toArrow())
    out = np.zeros((bits // 8 // SEGMENT, SEGMENT), np.uint8)
    for segment, own in zip(made.column("segment").to_pylist(), made.column("bits"), strict=True):
        out[segment] = np.frombuffer(own.as_buffer(), np.uint8)
    return out.reshape(-1)


@dataclass
class Trie:
    """A double array over word numbers. State i (of the first ones) is the
    root of language i."""

    langs: list[str]
    words: pa.StringArray
    base: np.ndarray
    check: np.ndarray

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Each state's child for a word; -1 where there is none."""
        alive = (state >= 0) & (word >= 0)
        to = np.where(alive, self.base[state] + word, 0)
        return np.where(alive & (self.check[to] == state), to, -1)


def place_children(begins: np.ndarray, words: np.ndarray, reserved: int, n_words: int) -> tuple[np.ndarray, int]:
    """A base for each list of word numbers (``words`` from ``begins[i]`` to
    ``begins[i + 1]``), such that no two children share a place, and the size
    of the array. Lists with most children go first, each to the first of some
    random places that suits it, or else behind all others; single children
    fill what is left. At most half of the places is used before that, so
    few tries are needed."""
    start = max(reserved, n_words)  # places below would give a single child a negative base
    used = np.zeros(start + n_words + ROOM * len(words) + 4096, bool)
    used[:start] = True
    size = np.diff(begins)
    base = np.zeros(len(size), np.int64)
    draw = np.random.default_rng(0)
    last = start
    for i in np.argsort(-size, kind="stable")[: int((size > 1).sum())].tolist():
        own = words[begins[i] : begins[i + 1]]
        at_once = max(4, min(128, 100_000 // len(own)))
        for _ in range(TRIES):
            tried = draw.integers(start, len(used) - n_words, at_once)
            fits = tried[~used[tried[:, None] + own].any(axis=1)]
            if len(fits):
                base[i] = fits[0]
                break
        else:
            base[i] = len(used)
            used = np.concatenate([used, np.zeros(n_words + 1, bool)])
        used[base[i] + own] = True
        last = max(last, int(base[i] + own.max()))
    single = np.nonzero(size == 1)[0]
    if len(single):
        free = start + np.nonzero(~used[start:])[0][: len(single)]
        base[single] = free - words[begins[single]]
        last = max(last, int(free[-1]))
    return base, last + 1


def build_trie(langs: list[str], phrases: pa.StringArray) -> tuple[Trie, np.ndarray]:
    """The trie of different (language, phrase) pairs, and the state that accepts each."""
    roots = sorted(set(langs))
    of_lang = dict(zip(roots, range(len(roots)), strict=True))
    node, nodes = np.array([of_lang[x] for x in langs], np.int64), len(roots)  # of each phrase, as far as it has been read
    parts = pc.split_pattern(phrases, " ")
    length = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    every = pc.list_flatten(parts).dictionary_encode()
    number, n_words = every.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(every.dictionary)
    begin = np.cumsum(length) - length
    parents, words = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for level in range(int(length.max(initial=0))):
        there = np.nonzero(length > level)[0]
        edge, place = np.unique(node[there] * n_words + number[begin[there] + level], return_inverse=True)
        parents.append(edge // n_words), words.append(edge % n_words)
        node[there] = nodes + place
        nodes += len(edge)
    # a level's nodes are numbered by parent, so the children of a node stand together
    parents, words = np.concatenate(parents), np.concatenate(words)
    begins = np.concatenate([[0], np.cumsum(np.bincount(parents, minlength=nodes))])
    base, size = place_children(begins, words, len(roots), n_words)
    state = np.arange(nodes)
    children = np.arange(len(roots), nodes)
    state[children] = base[parents] + words
    out = Trie(roots, every.dictionary, np.zeros(size, np.int32), np.full(size + n_words + 1, -1, np.int32))
    inner = np.nonzero(np.diff(begins))[0]
    out.base[state[inner]] = base[inner]
    out.check[state[children]] = state[parents]
    return out, state[node]


def _tries(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.combine_chunks()
    lang, phrase = (rows.column(c).combine_chunks() for c in ("lang", "phrase"))
    trie, states = build_trie(lang.to_pylist(), phrase)
    accepts = pa.StructArray.from_arrays([pa.array(states.astype(np.int64)), lang, phrase], ["state", "lang", "phrase"])
    blob = pickle.dumps((trie.langs, trie.words.to_pylist(), trie.base, trie.check, np.sort(states).astype(np.int32)))
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "trie": pa.array([blob], pa.binary()), "accepts": one_list(accepts)})


def together(rows: Iterator[tuple[str, Words]]) -> Iterator[list[tuple[str, Words]]]:
    """Rows in lists of about ``HELD`` words."""
    held, size = [], 0
    for lang, words in rows:
        held.append((lang, words))
        size += len(words.words)
        if size > HELD:
            yield held
            held, size = [], 0
    if held:
        yield held


def counted_phrases(trie: Trie, root: int, words: np.ndarray, there: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How often each state is reached by whole phrases, a row of word numbers each."""
    state, last = np.full(len(words), root), there.sum(axis=1)
    ends = np.full(len(words), -1)
    for level in range(LONGEST):
        state = trie.step(state, words[:, level])
        ends = np.where(last == level + 1, state, ends)
    reached = ends >= 0
    return np.bincount(ends[reached], times[reached], len(trie.base)).astype(np.int64)  # exact up to 2^53


def count_states(trie: Trie, batches: Iterator[tuple[str, Words]]) -> np.ndarray:
    """How often each state is reached at levels 2 and 3."""
    n = np.zeros(len(trie.base), np.int64)
    root = dict(zip(trie.langs, range(len(trie.langs)), strict=True))
    for rows in together((lang, words) for lang, words in batches if lang in root and len(words.at)):
        # the trie's words are indexed once for all these rows
        every = pa.concat_arrays([words.words for _, words in rows])
        number = pc.fill_null(pc.index_in(every, value_set=trie.words), -1).to_numpy().astype(np.int64)
        begin, reached = 0, [np.zeros(0, np.int64)]
        for lang, words in rows:
            own = np.append(number[begin : begin + len(words.words)], -1)  # the last, at -1: between pieces
            begin += len(words.words)
            word = own[words.at]
            if words.times is not None:
                n += counted_phrases(trie, root[lang], word.reshape(-1, LONGEST), words.at.reshape(-1, LONGEST) >= 0, words.times)
                continue
            state = trie.step(np.full(len(word), root[lang]), word)
            for level in range(1, LONGEST):
                state = trie.step(state[:-1], word[level:])
                reached.append(state[state >= 0])
            if sum(map(len, reached)) > HELD:
                n += np.bincount(np.concatenate(reached), minlength=len(n))
                reached = [np.zeros(0, np.int64)]
        n += np.bincount(np.concatenate(reached), minlength=len(n))
    return n


def _count_phrases(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, words, base, check, accepting = pickle.loads(sent.value)
        n = count_states(Trie(langs, pa.array(words, pa.string()), base, check), by_language(batches))
        there = accepting[n[accepting] > 0].astype(np.int64)  # others are only on the way to a phrase
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[there])], ["state", "n"])

    return run


def one_vocabulary(rows: list[Words]) -> Words:
    """Several rows of words as one."""
    every = pa.concat_arrays([x.words for x in rows]).dictionary_encode()
    number = np.append(every.indices.to_numpy(zero_copy_only=False).astype(np.int64), -1)
    hashes = np.zeros(len(every.dictionary), np.uint64)
    hashes[number[:-1]] = np.concatenate([x.hashes for x in rows])
    begin, at = 0, []
    for x in rows:
        at += [np.where(x.at >= 0, number[x.at + begin], -1), np.array([-1])]
        begin += len(x.words)
    return Words(np.concatenate(at), every.dictionary, hashes)


def different(at: np.ndarray, place: np.ndarray, length: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different phrase among those of ``length`` words at some places, and how many have it."""
    key, most = at[place], n_words
    for i in range(1, length):
        if most * n_words >= 1 << 63:
            key, most = np.unique(key, return_inverse=True)[1], len(place)
        key, most = key * n_words + at[place + i], most * n_words
    order = np.argsort(key)
    key = key[order]
    begin = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])[0]
    return place[order[begin]], np.diff(np.append(begin, len(key)))


def block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


def dealt(lang: str, words: Words, bitmap: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each block the phrases with bits in the bitmap, ``LONGEST`` places each, and how often they occur."""
    own, inside = words.in_place(lang), words.at >= 0
    hashes, whole, parts = own, inside, []
    for length in range(2, LONGEST + 1):
        hashes, whole = longer(hashes[:-1], own[length - 1 :]), whole[:-1] & inside[length - 1 :]
        place, times = different(words.at, np.nonzero(whole & has_bit(bitmap, hashes))[0], length, len(words.words))
        phrases = np.full((len(place), LONGEST), -1)
        phrases[:, :length] = words.at[place[:, None] + np.arange(length)]
        parts.append((block_of(hashes[place], blocks), phrases, times))
    block, phrases, times = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(block, kind="stable")
    ends = np.cumsum(np.bincount(block, minlength=blocks))
    for b in np.nonzero(np.diff(ends, prepend=0))[0].tolist():
        these = order[ends[b - 1] if b else 0 : ends[b]]
        yield b, phrases[these], times[these]


DEALT = "block int, part int, lang string, words array<string>, at array<int>, times array<long>"


def _deal(sent: Broadcast, blocks: int, parts: int):
    """Different phrases of the rows of words, dealt to their blocks: a row for
    each block that has some of several rows of a language."""

    def of(lang: str, rows: list[Words], part: int) -> Iterator[pa.RecordBatch]:
        words = one_vocabulary(rows)
        for block, phrases, times in dealt(lang, words, sent.value, blocks):
            at = phrases.reshape(-1)
            used, at[at >= 0] = np.unique(at[at >= 0], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([lang], pa.string()),
                 one_list(words.words.take(pa.array(used))), one_list(pa.array(at.astype(np.int32))), one_list(pa.array(times.astype(np.int64)))],
                ["block", "part", "lang", "words", "at", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[Words]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)
        for lang, words in by_language(batches):
            held[lang].append(words)
            size[lang] += len(words.at)
            part = words.row % parts
            if size[lang] > HELD or sum(size.values()) > 4 * HELD:
                most = max(size, key=size.get)
                size.pop(most)
                yield from of(most, held.pop(most), part)
        for lang, rows in held.items():
            yield from of(lang, rows, rows[0].row % parts)

    return run


def _count_block(key: tuple, wanted: pa.Table, rows: pa.Table) -> pa.Table:
    """The counts of a block's phrases in the rows dealt to it."""
    if not len(wanted) or not len(rows):
        return pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    made = _tries(key, wanted)
    accepts = made.column("accepts").combine_chunks().flatten()
    sent = SimpleNamespace(value=made.column("trie")[0].as_py())
    n = pa.concat_tables(map(pa.Table.from_batches, ([x] for x in _count_phrases(sent)(rows.select(["lang", "words", "at", "times"]).to_batches()))))
    place = pc.index_in(n.column("state").combine_chunks(), value_set=accepts.field("state"))
    return pa.table({"lang": accepts.field("lang").take(place), "phrase": accepts.field("phrase").take(place), "n": n.column("n")})


def tokens_of(docs: DataFrame) -> DataFrame:
    """The words of ``docs`` (``lang``, ``text`` as bytes, neither null),
    written: a numbered row for each language of each few MB of text."""
    return materialize(docs.mapInArrow(_tokens, TOKENS).withColumn("row", F.monotonically_increasing_id()), ROWS_A_FILE)


def in_fewer_tasks(tokens: DataFrame, *columns: str) -> DataFrame:
    """Some columns of the rows, several of Spark's partitions read by a task, but no core left without one."""
    parts = tokens.rdd.getNumPartitions()
    return tokens.select(*columns).coalesce(max(2 * tokens.sparkSession.sparkContext.defaultParallelism, parts // FILES_A_TASK))


def count_words(tokens: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` (one word) and ``f`` of all words."""
    return (tokens.select("lang", F.inline(F.arrays_zip(F.col("words").alias("phrase"), F.col("n").alias("n"))))
            .groupBy("lang", "phrase").agg(F.sum("n").alias("f")))


def candidates(tokens: DataFrame, words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang`` and ``phrase`` of two and three words: all that occur
    ``min_count`` times or more, and at most as many others as 64-bit hashes
    mistake for them. ``words``: the frequent ones."""
    spark = tokens.sparkSession
    sent = [spark.sparkContext.broadcast(bitmap_of(words, word_rows))]  # of words, pairs and triples, each sent once
    frequent = []
    for _ in range(2):
        counted = (in_fewer_tasks(tokens, "row", "lang", "hashes", "at").mapInArrow(_count_hashes(list(sent)), "h long, n long, row long")
                   .groupBy("h").agg(F.sum("n").alias("n"), F.min("row").alias("row")).where(F.col("n") >= min_count).select("h", "row"))
        frequent.append(materialize(counted, tidy=True))
        sent.append(spark.sparkContext.broadcast(bitmap_of(frequent[-1].select("h"), hash_rows)))
    # a row has a bounded number of hashes; the rows of words are large, so they are not sorted for the join
    own = frequent[0].union(frequent[1]).groupBy("row").agg(F.collect_list("h").alias("own"))
    found = materialize(
        tokens.select("row", "lang", "words", "at").join(own.hint("shuffle_hash"), "row").select("lang", "words", "at", "own")
        .mapInArrow(_candidates(sent), "lang string, phrase string").distinct(), tidy=True)
    for bitmap in sent:
        bitmap.destroy()  # the driver holds no copy while phrases are counted
    return found


def count_phrases(tokens: DataFrame, wanted: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` and ``f``: all occurrences in ``tokens`` of the
    different rows of ``wanted`` that occur. One pass, whatever their number."""
    blocks = 1 + wanted.count() // BLOCK_PHRASES
    parts = 1 + tokens.count() // (ROWS_A_PART * blocks)
    sent = tokens.sparkSession.sparkContext.broadcast(bitmap_of(wanted, phrase_rows))

    def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = pa.array(block_of(phrase_rows(batch), blocks).astype(np.int32))
            yield pa.RecordBatch.from_arrays([block, batch.column("lang"), batch.column("phrase")], ["block", "lang", "phrase"])

    own = (wanted.mapInArrow(in_blocks, "block int, lang string, phrase string")
           .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    rows = in_fewer_tasks(tokens, "row", "lang", "words", "hashes", "at").mapInArrow(_deal(sent, blocks, parts), DEALT)
    counted = (own.groupBy("block", "part").cogroup(rows.groupBy("block", "part"))
               .applyInArrow(_count_block, "lang string, phrase string, n long"))
    out = materialize(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f")), tidy=True)
    sent.destroy()
    return out


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases of two or three words (columns ``lang``,
    ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``).

    ``docs`` has ``text`` and ``lang``; other columns are ignored. Null text
    is empty, null lang is ``und``. A phrase lies within a piece (between
    ``.,;:!?`` and line ends). Phrases that occur ``min_count`` times or more
    are scored at each cut by a*a / (l*r), the lowest counts; those that lie
    inside a longer one at least half as frequent are left out. Repeated rows
    count each time; an empty table gives no rows. Scores are exact (decimals
    of 38 digits, for counts up to 10^15)."""
    own = tokens_of(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), utf8(F.col("text")).alias("text")))
    words = materialize(count_words(own))
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= min_count)
    wanted = candidates(own, frequent, min_count)
    counted = count_phrases(own, wanted).where(F.col("f") >= min_count)
    found = materialize(counted.withColumn("words", F.split("phrase", " ")))

    known = frequent.union(found.select("lang", "phrase", "f"))
    part = lambda begin, length: F.array_join(F.slice("words", begin, length), " ")
    cuts = (found.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
                    part(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest")))
    of = lambda name, n: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    above = F.lit(1_000_000).cast("decimal(7,0)") * (exact("a") * exact("a"))
    scored = (cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
              .withColumns({"above": above, "below": exact("l") * exact("r")})
              .withColumn("score", F.expr("above div below"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
              .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))

    inside = (found.where(F.size("words") == LONGEST)
              .select("lang", "f", F.explode(F.array(part(F.lit(1), F.lit(2)), part(F.lit(2), F.lit(2)))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    left = (scored.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 50)))

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = left.withColumn("place", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*best))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
