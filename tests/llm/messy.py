"""Small tables with everything that must not break an operator, and brute-force helpers."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
PASSAGE = " ".join(f"mot{i}é" for i in range(80))
#: (doc_id, text, lang, source)
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a"),
    (2, "ALPHA beta gamma delta epsilon zeta eta theta iota kappa", "en", "a"),
    (3, None, None, None), (4, "", "en", "b"), (5, " \t\n", "en", "b"), (6, "one", "en", "c"),
    (7, "one", "en", "c"), (7, "one", "en", "c"), (8, "É é", "fr", "c"), (9, "é é", "fr", ""),
    (None, "no id here", "en", "a"), (None, "no id here", "en", None),
    (10, PASSAGE, "fr", "a"), (11, PASSAGE + " encore", "fr", "a"), (12, "avant " + PASSAGE + " après", "fr", "b"),
    (13, "long " * 30000 + "x" * 5000, "en", "a"), (14, "y" * 9000, "en", "a"), (15, "y" * 9000 + "z", "en", "a"),
    (16, "   spaced   out   text  ", "de", "d"), (17, "w1 w2 w3", "de", "d"), (18, "w1 w2 w3 w4", "de", "d"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: names that operators use inside
CLASHES = ("row", "n", "key", "before", "size", "keep", "name", "passes", "left", "label", "score", "doc", "id", "h", "token", "one", "src",
           "kept", "start", "pos", "sid", "mix_", "group", "place", "rank", "cut", "fingerprint", "page_id")


def documents(spark, rows=None):
    rows = ROWS if rows is None else rows
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit("clash"))
    return docs


def shingles(text: str | None, width: int = 5, lower: bool = True) -> frozenset:
    w = WORD.findall((text or "").translate(ASCII_LOWER if lower else {}))
    if len(w) >= width:
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components(sets: list[tuple[int | None, frozenset]], percent: int = 75) -> list:
    """Smallest id reachable for each row, by all pairs."""
    group = list(range(len(sets)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and root(i) != root(j) and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    ids: dict[int, list] = {}
    for i, (d, _) in enumerate(sets):
        ids.setdefault(root(i), []).append(d)
    return [min((x for x in ids[root(i)] if x is not None), default=None) for i in range(len(sets))]
