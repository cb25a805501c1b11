"""Quality figures against plain Python, and the cascade's order."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import quality as Q

SPACE = "\t\n\x0b\x0c\r "


def _brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    again = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    base = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(again), base)


def _texts():
    rnd = random.Random(1)
    out = []
    for i in range(120):
        n = rnd.choice([0, 1, 3, 49, 50, 80, 200])
        words = [rnd.choice(["a", "b", "c d", "é#", "x|y", "long word", "!!", f"u{i}"]) for _ in range(n)]
        out.append("".join(w + rnd.choice([" ", "\n", "\t", "  ", "\u00a0", "\r\n"]) for w in words))
    return out


def test_base_figures(spark, docs_of, odd_rows):
    rows = [(i + 100, t) for i, t in enumerate(_texts())] + [r for r in odd_rows if r[0] is not None]
    got = {}
    for r in Q.quality_report(docs_of(rows)).collect():
        got[r["doc_id"]] = tuple(r)[1:7]
        assert not (r["base_failed"] and r["kept"])
    assert got == {i: _brute(t) for i, t in rows}


PROSE = " ".join(f"word{i} of text{i}, and" for i in range(40)) + "."


def test_verdicts(spark, docs_of):
    bad = {
        1: " ".join(f"w{i}$$$" for i in range(90)), 2: " ".join(f"w{i}!!" for i in range(90)),
        3: " ".join(f"WORD{i}X" for i in range(90)).replace("0", "O"), 4: "\n".join([f"a{i} b{i} c{i}" for i in range(20)] * 1 + ["x y"] * 45),
        5: " ".join(f"w{i} w{i}" for i in range(60)), 6: " ".join("x" * 40 + str(i) for i in range(60)), 7: None, 8: "",
    }
    rows = [*bad.items(), (50, PROSE), (51, PROSE + " 10 % off & more")]
    report = {r["doc_id"]: r["kept"] for r in Q.quality_report(docs_of(rows)).collect()}
    assert report == {**dict.fromkeys(bad, False), 50: True, 51: True}
    docs = docs_of(rows).selectExpr("*", "1 AS n_words", "'x' AS kept")
    kept = Q.filter_quality(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [50, 51]
    assert Q.filter_quality(docs.limit(0)).count() == 0 and Q.quality_report(docs.limit(0)).count() == 0


def test_order_never_changes_a_verdict(spark, docs_of):
    docs = docs_of([(i, t) for i, t in enumerate(_texts())] + [(500, PROSE)])
    rules = Q.rules(F.col("text"))
    order = Q.cascade(docs, rules)
    assert sorted(order) == sorted(rules)
    kept = [sorted(r["doc_id"] for r in docs.where(Q.verdict(o, rules).isNull()).collect()) for o in (order, order[::-1])]
    assert kept[0] == kept[1] and 500 in kept[0]


def test_cheap_and_selective_rules_come_first(spark, docs_of):
    docs = docs_of([(i, PROSE) for i in range(300)])
    never = F.lit(False)
    costly = F.aggregate(F.sequence(F.lit(1), F.lit(3000)), F.lit(0), lambda a, x: a + x) > F.length("text") - F.length("text")
    order = Q.cascade(docs, {"never": never, "costly": costly, "cheap": F.length("text") > 0})
    assert order == ["cheap", "costly", "never"]
