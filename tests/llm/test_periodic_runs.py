"""Runs against a plain search over all periods; Lyndon lengths against their definition."""

import hashlib
import random
import zlib

import pytest

from jobloom.llm import periodic_runs as P
from tests.conftest import SF_SMOKE

from .messy import ROWS, WORD, documents


def _plain_runs(words, least=12):
    """All (start, length, period)."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            span = (i, j + q)
            if span[1] - span[0] >= max(least, 2 * q) and span not in found:  # a smaller period came first
                found[span] = q
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def _plain_row(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and words:
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _plain_runs(words)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{a},{n},{q}\n" for a, n, q in sorted(runs, key=lambda r: (r[0], r[2])))), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_lyndon_lengths(letters):
    rng = random.Random(letters)
    for n in [*range(1, 30), 80]:
        s = [rng.randrange(letters) for _ in range(n)] if n % 3 else [rng.randrange(letters) for _ in range(max(1, n // 4))] * 5

        def longest(i):
            # the longest Lyndon word at i ends where a smaller suffix begins
            return next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i

        assert P.lyndon_lengths(s) == [longest(i) for i in range(len(s))]


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_runs_of_lists(letters):
    rng = random.Random(letters)
    lists = []
    for n in [1, 12, 13, 40, 90, 200]:
        for _ in range(6):
            part = [str(rng.randrange(letters)).encode() for _ in range(max(1, n // rng.choice([1, 2, 5])))]
            lists.append((part * 10)[:n] + [b"0"] * rng.randrange(3) + [b"1", b"0"] * rng.randrange(8))
    assert [sorted(x) for x in P._runs(lists, 12)] == [_plain_runs(x) for x in lists]


def _documents(seed):
    rng = random.Random(seed)
    rows = []
    for d in range(400):
        n = rng.choice([0, 5, 11, 12, 13, 40, 160])
        words = [rng.choice("abcdefghij") * rng.choice([1, 1, 2]) for _ in range(n)]
        if d % 3 == 0 and n:
            unit = words[:rng.randrange(1, 9)]
            words = words[:n // 2] + unit * rng.randrange(1, 9) + words[n // 2:]
        rows.append((d, rng.choice([" ", "\n", " \t "]).join(words), "en", "s"))
    return rows


def test_query_columns_against_plain_search(spark, monkeypatch):
    rows = _documents(5) + [r for r in ROWS if r[0] != 13]
    docs = documents(spark, rows)
    monkeypatch.setattr(P, "table", lambda *a: docs)
    got = sorted((tuple(r) for r in P.op12_periodic_runs(spark, "").select(COLUMNS).collect()), key=str)
    assert got == sorted((_plain_row(d, t) for d, t, *_ in rows), key=str)


def test_very_long_text(spark):
    text = "long " * 30000 + "x" * 5000 + " end" * 20000
    row = P.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 30000, 1), (30001, 20000, 1)] and row["collapsed"] == "long " + "x" * 5000 + " end"


def test_empty_table(spark):
    assert P.periodic_runs(documents(spark, [])).collect() == []


def test_query_on_the_smallest_tables(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text").collect() if len(r["text"] or "") < 9000]
    got = {r["doc_id"]: tuple(r) for r in P.op12_periodic_runs(spark, SF_SMOKE).select(COLUMNS).collect()}
    for d, t in texts:
        assert got[d] == _plain_row(d, t)
