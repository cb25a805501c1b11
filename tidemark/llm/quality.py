"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a column that is true where the rule rejects. On a small sample
every rule's cost (time of a run over the sample) and selectivity (share it
rejects) are measured, and the rules are chained in the order of rejections
per cost in one CASE: a row that a rule rejects never meets the later ones.
The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, materialize

WORD = r"[^\x20\x09-\x0D]+"
SAMPLE_ROWS = 2_000  # expected size of the sample that orders the rules; it decides no verdict


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def body(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(body(text), SPACES), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(body(text), SPACES, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.regexp_count(body(text), F.lit(r"[#*$%&|<>]")).cast("long")


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(body(text), "\n"), lambda x: x.rlike(WORD))


def duplicate_lines(text: Column) -> Column:
    return let(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice. Windows are told
    apart by two hashes, 96 bits together; only texts that repeat a window are
    sorted. After sorting by (hashes, place), a window occurs again if a
    neighbour has its hashes; each such window, in order of place, adds the
    words that the one before it doesn't cover."""
    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.struct(
            F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
            F.hash(x, F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i")))

    def covered(s: Column) -> Column:
        same = lambda x, y: F.coalesce((x["h"] == y["h"]) & (x["g"] == y["g"]), F.lit(False))
        again = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(places, start, lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")))["n"]

    def count(grams: Column) -> Column:
        repeats = F.size(F.array_distinct(F.transform(grams, lambda x: x["h"]))) < F.size(grams)
        return F.when(repeats, let(F.sort_array(grams), covered)).otherwise(0)

    return let(w, lambda w: let(windows(w), count)).cast("long")


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``."""
    text, w = F.col("text"), words(F.col("text"))
    both = let(w, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    return (docs.withColumn("__w", both).withColumns({
        "n_words": F.col("__w.n"), "word_chars": word_chars(text), "n_symbols": symbols(text),
        "n_dup_lines": duplicate_lines(text), "n_repeat_words": F.col("__w.r")}).drop("__w")
        .withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def rules(text: Column) -> dict[str, Column]:
    """The rules by name; each is true where it rejects. None depends on
    another, and each stands on its own reading of the text."""
    t = body(text)
    n = F.size(words(text))
    upper = F.regexp_count(t, F.lit(r"\p{Lu}"))
    return {
        "few_words": n < 50,
        "repeated_windows": let(words(text), lambda w: 100 * repeated_words(w) > 50 * F.size(w)),
        "symbols": symbols(text) * 10 > n,
        "shouting": F.regexp_count(t, F.lit("!!")) * 10 > n,
        "capitals": upper * 2 > word_chars(text),
        "duplicate_lines": let(lines(text), lambda x: 2 * (F.size(x) - F.size(F.array_distinct(x))) > F.size(x)),
        "word_length": (word_chars(text) > 15 * n) | (word_chars(text) < 2 * n),
        "stutter": let(words(text), lambda w: 5 * F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))) > F.size(w)),
    }


BASE_RULES = ("few_words", "repeated_windows")


def cascade(docs: DataFrame, rules_by_name: dict[str, Column]) -> list[str]:
    """The rules' names by rejections per cost, measured on a sample of
    ``docs`` that is written once. Ties and rules that reject nothing keep
    cheaper ones first. An empty table keeps the given order."""
    count = docs.count()
    if not count:
        return list(rules_by_name)
    sample = materialize(docs.select("text").sample(min(1.0, SAMPLE_ROWS / count), seed=7))
    shares = sample.agg(*[F.avg(r.cast("double")).alias(k) for k, r in rules_by_name.items()]).first()
    rank = {}
    for name, rule in rules_by_name.items():
        began = time.perf_counter()
        sample.agg(F.count_if(rule)).collect()
        cost = time.perf_counter() - began
        rank[name] = (-(shares[name] or 0.0) / cost, cost)
    return sorted(rules_by_name, key=rank.get)


def verdict(order: list[str], rules_by_name: dict[str, Column]) -> Column:
    """Name of the first rule in ``order`` that rejects, else null."""
    out = F.lit(None).cast("string")
    for name in reversed(order):
        out = F.when(rules_by_name[name], F.lit(name)).otherwise(out)
    return out


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects; columns as they are. A null
    or empty text has no words and is rejected. An empty table stays empty."""
    own = rules(F.col("text"))
    return docs.where(verdict(cascade(docs, own), own).isNull())


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base figures, base_failed and kept
    (no rule rejects; after base_failed none is evaluated). Null text has no
    words; very long texts are read whole; repeated rows get equal results."""
    own = {k: r for k, r in rules(F.col("text")).items() if k not in BASE_RULES}
    order = cascade(docs, own)
    based = with_base(docs.select("doc_id", "text"))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(order, own).isNull())
    return based.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"))
