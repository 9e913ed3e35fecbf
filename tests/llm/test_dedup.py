"""Exact duplicates, Jaccard components, chunk passages and fingerprints against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from jobloom.llm import bbit_minhash, block_naming, common, gear_chunks, one_permutation, set_links, token_combinations
from jobloom.llm.components import components as cc

from .messy import ASCII_LOWER, PASSAGE, ROWS, components, documents, shingles


def _variants(seed=3):
    """Groups of near copies, chains of edits and unrelated texts."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    rows, d = [], 100
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.choice([6, 30, 120]))
        for _ in range(rng.choice([1, 2, 15])):
            words = list(words)
            for _ in range(rng.choice([0, 1, 1, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((d, " ".join(words), "en", "s"))
            d += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 4096])
def test_exact_duplicates(spark, block):
    got = block_naming.exact_duplicates(documents(spark), block_bytes=block if block > 4 else 1024).collect() if block > 4 else \
        block_naming.exact_duplicates(documents(spark, [r for r in ROWS if r[0] not in (13, 14, 15)]), block_bytes=4).collect()
    rows = ROWS if block > 4 else [r for r in ROWS if r[0] not in (13, 14, 15)]
    norm = [(d, (t or "").translate(ASCII_LOWER)) for d, t, *_ in rows]
    size = Counter(t for _, t in norm)
    keep = {t: max((d for d, x in norm if x == t and d is not None), default=None) for _, t in norm}
    want = sorted((str(d), str(keep[t]), size[t], hashlib.sha256(t.encode()).hexdigest()) for d, t in norm)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(size)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_names_again_under_another_seed_if_addresses_collide(spark, monkeypatch):
    calls = []
    real = block_naming._named_blocks

    def colliding(src, block_bytes, seed):
        calls.append(seed)
        names = real(src, block_bytes, seed)
        return names.union(names) if seed == 0 else names

    monkeypatch.setattr(block_naming, "_named_blocks", colliding)
    assert block_naming.exact_duplicates(documents(spark)).count() == len(ROWS)
    assert calls == [0, 1]


def test_large_groups_of_copies_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "SALTED", 10)
    rows = [(d, ("same text", "SAME other", "y" * 9000, None)[d % 4], "en", "s") for d in range(200)] + [(500, "single", "en", "s")]
    got = block_naming.exact_duplicates(documents(spark, rows)).collect()
    assert Counter(r["keep_id"] for r in got) == {196: 50, 197: 50, 198: 50, 199: 50, 500: 1}
    assert sorted(r["doc_id"] for r in got if r["kept"]) == [196, 197, 198, 199, 500]


@pytest.mark.parametrize("rare", [1, 8])
def test_jaccard_components(spark, rare):
    rows = ROWS + _variants()
    got = token_combinations.jaccard_components(documents(spark, rows), rare=rare).collect()
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    want = sorted((str(d), len(s), str(c if s else d)) for (d, s), c in zip(sets, components(sets), strict=True))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want


def test_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(1)
    words = [f"q{i}" for i in range(150)]
    rows = []
    for d in range(300):
        own = list(words)
        own[rng.randrange(150)] = f"x{d}"
        rows.append((d, " ".join(own), "en", "s"))
    got = token_combinations.jaccard_components(documents(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 300


def _shared_opening(n=260):
    """Documents that share an opening, in pairs that link: under its frequent shingles meet many of different components."""
    rng = random.Random(11)
    opening = [f"open{i}" for i in range(60)]
    rows = []
    for d in range(n):
        own = [f"d{d // 2}w{i}" for i in range(50)]
        if d % 2:
            own[rng.randrange(50)] = "edited"
        rows.append((d, " ".join(opening + own), "en", "s"))
    return rows


def test_many_unlinked_documents_under_one_key(spark, monkeypatch):
    rows = _shared_opening()
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    want = components(sets)
    assert len(set(want)) == 130
    for growth, salted in ((4096, 1024), (3, 7)):
        monkeypatch.setattr(set_links, "GROWTH", growth)
        monkeypatch.setattr(set_links, "SALTED", salted)
        monkeypatch.setattr(common, "SALTED", salted)
        got = {r["doc_id"]: r["component_id"] for r in token_combinations.jaccard_components(documents(spark, rows)).collect()}
        assert [got[d] for d, *_ in rows] == want


def _near_misses(n=30):
    """Pairs that link, all edited from one text so that documents of different pairs mostly fall short of a link by little."""
    rng = random.Random(21)
    template = [f"t{i}" for i in range(400)]
    rows = []
    for d in range(n):
        own = list(template)
        for at in rng.sample(range(0, 400, 6), 7):
            own[at] = f"x{d}at{at}"
        rows.append((2 * d, " ".join(own), "en", "s"))
        own[rng.randrange(400)] = f"y{d}"
        rows.append((2 * d + 1, " ".join(own), "en", "s"))
    return rows


@pytest.mark.parametrize("growth, salted", [(4096, 1024), (3, 7)])
def test_near_misses_meet_once(spark, monkeypatch, growth, salted):
    rows = _near_misses()
    made = []
    real = set_links._meetings

    def counted(x, y, once):
        found = real(x, y, once)
        made.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(set_links, "_meetings", counted)
    monkeypatch.setattr(set_links, "GROWTH", growth)
    monkeypatch.setattr(set_links, "SALTED", salted)
    got = {r["doc_id"]: r["component_id"] for r in token_combinations.jaccard_components(documents(spark, rows)).collect()}
    want = components([(d, shingles(t)) for d, t, *_ in rows])
    assert [got[d] for d, *_ in rows] == want and len(set(want)) > 5
    # under hundreds of common keys each
    rows_made, pairs = map(sum, zip(*made, strict=True))
    assert 0 < pairs and rows_made <= 2 * pairs


def test_near_misses_meet_once_in_the_pipeline(spark, monkeypatch):
    rows = _near_misses(20)
    made = []
    real = set_links._meetings

    def counted(x, y, once):
        found = real(x, y, once)
        made.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(set_links, "_meetings", counted)
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect()}
    assert kept == set(components([(d, shingles(t)) for d, t, *_ in rows])) and len(kept) > 5
    rows_made, pairs = map(sum, zip(*made, strict=True))
    assert 0 < pairs and rows_made <= 2 * pairs


def test_shingles_alone_are_taken_out_of_the_sketches(spark):
    rng = np.random.default_rng(8)
    common = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    sets = [np.concatenate([common[:200], rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]), common[50:250], common[100:300]]
    frame = spark.createDataFrame([(i, len(x), bytearray(x.tobytes())) for i, x in enumerate(sets)], "sid long, n long, tokens binary")
    keys = spark.createDataFrame([(k, i) for i in range(3) for k in (8, 4 + 4 * i, -3, 7 - i)], "key long, sid long")
    got = {r["sid"]: r["mark"] for r in set_links._marks(keys, set_links.with_sketches(frame)).collect()}
    several = [x for x, n in Counter(int(t) for s in sets for t in s).items() if n > 1]
    rest = [np.array([t for t in s if int(t) in several], dtype=np.uint64) for s in sets]
    plain = spark.createDataFrame([(i, len(x), bytearray(x.tobytes())) for i, x in enumerate(rest)], "sid long, n long, tokens binary")
    want = {r["sid"]: r for r in set_links.with_sketches(plain).collect()}
    for i, s in enumerate(sets):
        assert [got[i][c] for c in set_links.SKETCH] == [want[i][c] for c in set_links.SKETCH]
        assert got[i]["n"] == len(s) and got[i]["alone"] == len(s) - len(rest[i]) and (i == 1 or got[i]["alone"] > 0)
    assert [got[i]["k0"] for i in range(3)] == [4, 8, 8] and {got[i]["k1"] for i in range(3)} == {-3}


def test_words_that_cancel_under_powers_do_not_link(spark):
    rows = []
    for k, size in enumerate((1024, 2048, 4096, 8192)):
        bits = [bin(i).count("1") & 1 for i in range(size)]  # Thue-Morse
        rows += [(2 * k, "".join("ab"[x] for x in bits), "en", "s"), (2 * k + 1, "".join("ba"[x] for x in bits), "en", "s")]
    for op in (token_combinations.jaccard_components, bbit_minhash.near_duplicates):
        assert all(r["component_id"] == r["doc_id"] for r in op(documents(spark, rows)).collect())


def test_pivots_of_sorted_postings():
    rng = random.Random(2)
    rows = sorted((rng.randrange(40), rng.random(), i) for i in range(120))
    for size in (1, 2, 7, 200):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in x], pa.int64()), pa.array([r[2] for r in x], pa.int64()), pa.array([r[1] for r in x]),
                                               pa.array([r[2] * 10 for r in x], pa.int64())], ["key", "sid", "pri", "n"])
                   for x in (rows[i:i + size] for i in range(0, len(rows), size))]
        got = [tuple(r.values()) for b in set_links._pivot_rows(iter(batches)) for r in b.to_pylist()]
        head = {}
        for k, p, i in rows:
            head.setdefault(k, i)
        count = Counter(r[0] for r in rows)
        want = [(k, i, p, i * 10, head[k], head[k] * 10) for k, p, i in rows if count[k] > 1 or k in (rows[0][0], rows[-1][0])]
        assert got == want


def test_bbit_components(spark):
    rows = ROWS + _variants() + _shared_opening(60)
    rng = random.Random(9)
    words = [f"q{i}" for i in range(150)]
    for d in range(2000, 2200):
        own = list(words)
        for _ in range(rng.choice([1, 2, 6, 12])):
            own[rng.randrange(150)] = f"x{d}"
        rows.append((d, " ".join(own), "en", "s"))
    got = bbit_minhash.near_duplicates(documents(spark, rows)).collect()
    sets = [(d, shingles(t, 3)) for d, t, *_ in rows]
    want = sorted((str(d), len(s), str(c if s else d), (c if s else d) == d) for (d, s), c in zip(sets, components(sets, 85), strict=True))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == want


def test_bbit_estimates_are_corrected(spark):
    """Packed estimates of pairs of known similarity: no bias, error as for so many minima."""
    rng = np.random.default_rng(4)
    rows, truth = [], []
    for share in (0, 100, 300, 500, 800, 1000):
        for _ in range(20):
            a, b = rng.integers(0, 1 << 63, (2, 1000), dtype=np.uint64)
            b[:share] = a[:share]
            planes = bbit_minhash.packed(bbit_minhash.minima([np.unique(a), np.unique(b)]))
            rows.append([int(x) for x in planes.ravel()])
            truth.append(share / (2000 - share))
    names = [f"{x}_{c}" for x in "ab" for c in bbit_minhash.PLANES]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ", ".join(["i long", *(f"{c} long" for c in names)]))
    got = [r["e"] for r in frame.selectExpr("i", f"{set_links._prefixed(bbit_minhash.ESTIMATE, 'a_', 'b_')} as e").orderBy("i").collect()]
    error = np.array(got) - np.array(truth)
    assert abs(error.mean()) < 0.01 and error.std() < 0.04 and np.abs(error[-20:]).max() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["v"]: r["label"] for r in cc(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100)}
    assert cc(spark.createDataFrame([], "a long, b long")).count() == 0
    joined = {r["v"]: r["label"] for r in cc(spark.createDataFrame(edges, "a long, b long").repartition(8), local_edges=9).collect()}
    assert joined == got


def test_repeated_passages(spark):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))
    passages = [text(60) for _ in range(12)]
    rows = [(d, f"{text(200)} {passages[d % 12]} {text(50)}", "en", "s") for d in range(24)] + [(100 + d, text(300), "en", "s") for d in range(30)]
    got = gear_chunks.repeated_passages(documents(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == set(range(24))
    for r in got:
        data = rows[r["doc_id"]][1].encode()[r["start"]:r["start"] + r["length"]]
        assert data.decode() in f" {passages[r['doc_id'] % 12]} " and r["first_doc_id"] == r["doc_id"] % 12
    found = gear_chunks.repeated_passages(documents(spark)).collect()
    assert {r["doc_id"] for r in found} >= {10, 11, 12} and None not in {r["doc_id"] for r in found}
    # documents without an id share passages like others
    nameless = [(None, passages[0], "en", "s"), (None, f"x {passages[1]}", "en", "s"), (None, passages[1], "en", "s"), (7, f"{passages[0]} y", "en", "s")]
    shared = sorted((str(r["doc_id"]), str(r["first_doc_id"])) for r in gear_chunks.repeated_passages(documents(spark, nameless)).collect())
    assert shared == [("7", "7"), ("None", "7"), ("None", "None"), ("None", "None")]


def test_an_insertion_moves_few_chunk_boundaries():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 123, 20000, dtype=np.uint8)
    starts, ends = gear_chunks.chunk_spans(data, np.array([0, len(data)]))
    moved = np.concatenate([data[:5000], np.frombuffer(b"inserted", np.uint8), data[5000:]])
    s2, e2 = gear_chunks.chunk_spans(moved, np.array([0, len(moved)]))
    before, after = set(gear_chunks.digests(data, starts, ends).tolist()), set(gear_chunks.digests(moved, s2, e2).tolist())
    assert len(before - after) <= 2 and 20 < len(data) / len(starts) < 60
    assert b"".join(bytes(moved[a:b]) for a, b in zip(s2, e2, strict=True)) == moved.tobytes()


def test_fingerprints(spark):
    rows = [r for r in ROWS if r[0] != 13] + [(200 + i, " ".join(f"t{j % (i + 7)}" for j in range(40 * i)), "en", "s") for i in range(8)]
    got = one_permutation.fingerprints(documents(spark, rows)).collect()
    order = sorted({(d, t or "") for d, t, *_ in rows if d is not None}, key=lambda x: -x[0])
    texts = dict(order)
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, *_ in rows)
    by_text: dict[str, set] = {}
    for r in got:
        if r["doc_id"] is None:
            continue
        t = texts[r["doc_id"]]
        by_text.setdefault(t, set()).add(r["fingerprint"])
        assert r["n_chars"] == len(t) and (r["fingerprint"] == "") == (not shingles(t))
        at = [d for d, _ in order].index(r["doc_id"])
        if at + 1 < len(order):
            following = order[at + 1][1]
            half = len(t) // 2
            edited = t[:len(t) - half] + following[:half]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            a, b, c = (shingles(x, lower=False) for x in (t, edited, following))
            if a and b:
                assert abs(r["near_edited"] - len(a & b) / len(a | b)) < 0.2
            if a and c:
                assert abs(r["near_next"] - len(a & c) / len(a | c)) < 0.2
    assert all(len(x) == 1 for x in by_text.values())
    assert PASSAGE in by_text


def test_fingerprints_are_those_of_a_plain_one_permutation_minhash(spark):
    """Bins, minima, random orders of empty bins and packed bits by plain Python over the hashed shingles; very long and null-id rows too."""
    import re

    rows = ROWS + [(300 + i, " ".join(f"t{j}" for j in range(i * i)), "en", "s") for i in range(30)]
    got = {r["doc_id"]: r for r in one_permutation.fingerprints(documents(spark, rows)).collect() if r["doc_id"] is not None}
    begin, step = ([int(x) for x in re.findall(r"\d+", text)] for text in one_permutation._orders())
    words = spark.createDataFrame([(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in rows], "d long, w array<string>")
    hashed = words.selectExpr("d", "transform(w, x -> xxhash64(x)) as w").selectExpr(
        "d", "case when size(w) >= 5 then transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])) "
             "when size(w) > 0 then array(xxhash64(w)) else array() end as h")
    for r in hashed.filter("d is not null").collect():
        least: dict[int, int] = {}
        for h in r["h"]:
            u = h & (1 << 64) - 1
            least[u >> 57] = min(least.get(u >> 57, u), u)
        codes = []
        for b in range(128 if least else 0):
            t = 0
            while (begin[b] + t * step[b]) % 128 not in least and b not in least:
                t += 1
            codes.append((least[b] if b in least else least[(begin[b] + t * step[b]) % 128]) & 255)
        assert got[r["d"]]["fingerprint"].lower() == bytes(codes).hex()
    by_code = lambda a, b: max(0.0, (sum(x == y for x, y in zip(bytes.fromhex(a), bytes.fromhex(b), strict=True)) / 128 - 1 / 256) / (1 - 1 / 256))
    for r in got.values():
        if r["fingerprint"] and r["edited_fingerprint"]:
            assert abs(r["near_edited"] - by_code(r["fingerprint"], r["edited_fingerprint"])) < 1e-12


@pytest.mark.parametrize("op", [block_naming.exact_duplicates, token_combinations.jaccard_components, bbit_minhash.near_duplicates,
                                gear_chunks.repeated_passages, one_permutation.fingerprints])
def test_no_rows(spark, op):
    assert op(documents(spark, [])).count() == 0
