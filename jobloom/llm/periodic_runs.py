"""Periodic runs of words: Lyndon arrays from phase one of Baier's grouping, Lyndon roots extended through LCE.

A run is a maximal stretch with smallest period q and at least 2 q words. By the runs theorem each run holds a Lyndon root: a
stretch of q words that is the longest Lyndon word at its first word, under some order of the words or the reverse order.

1. Where runs can be. In a run of 12 words or more each word lies in a 6-gram that the run repeats. So only stretches covered by
   6-grams that repeat inside the stretch are searched; the hash of a 6-gram can only make a stretch too long.
2. Lyndon arrays. Suffixes start in groups by first word. Groups are taken from the highest down; each suffix of the group points to
   the last one before it in a lower group. Suffixes that get the same number of pointers and share a group move to a new group
   just above their old one, their context grown by so many contexts of the taken group. The context of a
   suffix when its group is taken is the longest Lyndon word there: no suffix array is finished. Done under both orders.
3. Extension. Blocks of 2^k words get exact integer names (sorted pairs of names, no hash); common extensions to
   the right and left of all candidate roots are found by descending powers, for many stretches and documents at once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .common import crc32_sql, table
from .shingles import mixed, word_hashes
from .words import slices, text_bytes, word_spans

#: words of a run, and of the grams that must repeat inside it
LEAST = 12
GRAM = 6
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there."""
    n = len(symbols)
    names = sorted(set(symbols))
    index = {x: i for i, x in enumerate(names)}
    group = [index[x] for x in symbols]
    members: list[list[int]] = [[] for _ in names]
    for i, g in enumerate(group):
        members[g].append(i)
    lower = list(range(-1, len(names) - 1))
    higher = [*range(1, len(names)), -1]
    size = [1] * n
    before = list(range(-1, n - 1))
    taken = bytearray(n + 1)  # the last one stands for "no place", -1
    g = len(names) - 1
    while g >= 0:
        own = [s for s in members[g] if group[s] == g]
        for s in own:
            taken[s] = 1
        places: list[int] = []
        counts: list[int] = []
        last = -1
        for s in own:
            j = before[s]
            while taken[j]:
                j = before[j]
            before[s] = j
            if j >= 0:
                if j == last:
                    counts[-1] += 1
                else:
                    places.append(j)
                    counts.append(1)
                    last = j
        if places:
            step = size[own[0]]
            for c in sorted(set(counts), reverse=True):
                moved: dict[int, list[int]] = {}
                for j, k in zip(places, counts, strict=True):
                    if k == c:
                        old = group[j]
                        if old in moved:
                            moved[old].append(j)
                        else:
                            moved[old] = [j]
                        size[j] += c * step
                for old, those in moved.items():
                    new = len(members)
                    members.append(those)
                    up = higher[old]
                    lower.append(old)
                    higher.append(up)
                    lower[up] = new  # a group below the taken one always has a higher one
                    higher[old] = new
                    for j in those:
                        group[j] = new
        g = lower[g]
    return size


def _named_blocks(symbols: np.ndarray) -> list[np.ndarray]:
    """names[k][i]: equal for equal blocks of 2^k symbols from i; until no block repeats."""
    names, width = [symbols], 1
    while len(names[-1]) > width:
        last = names[-1]
        pairs = last[:len(last) - width].astype(np.int64) * (int(last.max()) + 1) + last[width:]
        values, name = np.unique(pairs, return_inverse=True)
        if len(values) == len(pairs):
            break
        names.append(name.astype(np.int64))
        width *= 2
    return names


def _extensions(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many symbols from i and j on (i < j), and how many before them, are the same."""
    n = len(names[0])
    right, left = np.zeros(len(i), dtype=np.int64), np.zeros(len(i), dtype=np.int64)
    for k in range(len(names) - 1, -1, -1):
        w, name = 1 << k, names[k]
        fits = np.flatnonzero(j + right + w <= n)
        fits = fits[name[i[fits] + right[fits]] == name[j[fits] + right[fits]]]
        right[fits] += w
        fits = np.flatnonzero(i - left - w >= 0)
        fits = fits[name[i[fits] - left[fits] - w] == name[j[fits] - left[fits] - w]]
        left[fits] += w
    return left, right


def _stretches(hashes: np.ndarray, first: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches [a, b) of the words that may hold runs; ``first``: where each document's words begin, and the end."""
    place = np.arange(len(hashes))
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    while len(place) >= least:
        total = len(place) - GRAM + 1
        gram = mixed(owner[:total].astype(np.uint64) * _PLACE[0])
        for k in range(GRAM):
            gram = gram + hashes[place[k:k + total]] * _PLACE[k]
        inside = np.flatnonzero(owner[:total] == owner[GRAM - 1:])
        gram = gram[inside]
        order = np.argsort(gram, kind="stable")
        same = gram[order][1:] == gram[order][:-1]
        again = np.zeros(len(gram), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        hit = inside[again]
        step = np.zeros(len(place) + 1, dtype=np.int64)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + GRAM, -1)
        covered = np.flatnonzero(np.cumsum(step[:-1]) > 0)
        if not len(covered):
            return []
        kept_place, kept_owner = place[covered], owner[covered]
        new = np.ones(len(covered), dtype=bool)
        new[1:] = (np.diff(kept_place) != 1) | (kept_owner[1:] != kept_owner[:-1])
        part = np.cumsum(new) - 1
        long_ = (np.bincount(part) >= least)[part]
        kept_place, part = kept_place[long_], part[long_]
        if len(kept_place) == len(place):
            begins = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.empty(0, np.int64)
            ends = np.append(begins[1:], len(part))
            return [(int(kept_place[a]), int(kept_place[b - 1]) + 1) for a, b in zip(begins, ends, strict=True) if b > a]
        place, owner = kept_place, part
    return []


def _runs(words: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each list of words."""
    known: dict[bytes, int] = {}
    symbols, root, size, part_of, begin = [], [], [], [], []
    at = 0
    for k, part in enumerate(words):
        own = [known.setdefault(w, len(known)) for w in part]
        up = lyndon_lengths(own)
        down = lyndon_lengths([-x for x in own])
        n = len(own)
        begin.append(at)
        root.append(np.tile(np.arange(at, at + n), 2))
        size.append(np.array(up + down, dtype=np.int64))
        part_of.append(np.full(2 * n, k))
        symbols.append(np.array(own, dtype=np.int64))
        symbols.append(np.array([-1 - k], dtype=np.int64))  # a word of its own ends each list
        at += n + 1
    flat = np.concatenate(symbols)
    flat = np.where(flat < 0, len(known) - 1 - flat, flat)
    i, p, k = np.concatenate(root), np.concatenate(size), np.concatenate(part_of)
    left, right = _extensions(_named_blocks(flat), i, i + p)
    start, length = i - left, left + right + p
    good = (length >= 2 * p) & (length >= least)
    found = np.unique(np.stack([k[good], start[good], p[good], length[good]], axis=1), axis=0)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for part, a, period, n in found.tolist():
        out[part].append((a - begin[part], n, period))
    return out


def _per_document(least: int):
    """(doc_id, n_words, runs, collapsed) for Arrow batches (doc_id, text)."""

    def run(batches):
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            for a, b in slices(batch.column(1)):
                flat, offsets = text_bytes(batch.column(1).slice(a, b - a))
                data = flat.tobytes()
                starts, ends, first = word_spans(flat, offsets)
                found: dict[int, list] = {}
                parts = _stretches(word_hashes(flat, starts, ends), first, least) if len(starts) >= least else []
                if parts:
                    owners = np.searchsorted(first, [x for x, _ in parts], side="right") - 1
                    words = [[data[s:e] for s, e in zip(starts[x:y].tolist(), ends[x:y].tolist(), strict=True)] for x, y in parts]
                    for r, (x, _), runs in zip(owners.tolist(), parts, _runs(words, least), strict=True):
                        if runs:
                            found.setdefault(r, []).extend((s + x - int(first[r]), n, p) for s, n, p in runs)
                collapsed, listed = [], []
                for r in range(b - a):
                    words = data[offsets[r]:offsets[r + 1]].split()
                    runs = sorted(found.get(r, ()), key=lambda x: (x[0], x[2]))
                    if runs:
                        gone = np.zeros(len(words) + 1, dtype=np.int64)
                        for s, n, p in runs:
                            gone[s + p] += 1
                            gone[s + n] -= 1
                        words = [words[x] for x in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                    collapsed.append(b" ".join(words))
                    listed.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(first)), pa.array(listed, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_words, runs (array of start, length, period, by start, then period), collapsed.

    Words are runs without ASCII white space, numbered from 0; runs have at least ``least`` (12 or more) words and twice their period.
    ``collapsed`` is the text less all words of a run after its first period, joined by single spaces. Null and empty texts have no words,
    no runs and an empty ``collapsed``. Any doc_id, null and repeated ones too, stays as it is; equal texts give equal rows. Very long texts are
    taken whole: time is nearly linear in their words and a task holds one such text. No shuffle; other columns are not read. No rows give no rows.
    """
    if least < 2 * GRAM:
        raise ValueError(f"runs need at least {2 * GRAM} words")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(_per_document(least), schema)


@arrow_udf(T.StringType())
def _made_periodic(texts: pa.Array, seeds: pa.Array) -> pa.Array:
    """From word a = g % n on, words repeat with period 1 + (n - a) // (3 + g % 8), for g = ``seeds``; null for null."""
    out = []
    for text, g in zip(texts, seeds.to_pylist(), strict=True):
        if text.is_valid:
            words = text.as_py().encode().split()
            if words:
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                words = words[:a] + [words[a + k % p] for k in range(len(words) - a)]
            out.append(b" ".join(words))
        else:
            out.append(None)
    return pa.array(out, pa.binary()).cast(pa.string())


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, by the crc32 of its id, made periodic from some word on. A null id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.when(h % 10 == 0, F.col("text"))
    return docs.select("doc_id", F.coalesce(_made_periodic(chosen, F.floor(h / 10).cast("long")), F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    runs = periodic_runs(planted(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return runs.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


SQL = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                      CASE WHEN doc_id IS NOT NULL THEN {crc32_sql("CAST(doc_id AS VARCHAR)")} END AS h FROM documents),
marked AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM words),
placed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM marked),
texts AS (SELECT doc_id, i, w[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS x FROM placed),
pairs AS (SELECT s.doc_id, s.i, t.i - s.i AS q FROM texts s JOIN texts t ON s.doc_id = t.doc_id AND s.x = t.x AND s.i < t.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest({LEAST}, 2 * q) GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT texts.doc_id, string_agg(x, ' ' ORDER BY texts.i) AS t FROM texts ANTI JOIN gone ON gone.doc_id = texts.doc_id AND gone.i = texts.i GROUP BY texts.doc_id),
sums AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN sums USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
