"""Mixing, packing, toxicity, the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from jobloom.llm import cutting_stock, mixing, weak_labels
from jobloom.llm.tokenizing import Encoder, vocabulary

from .messy import ROWS, WORD, components, documents, shingles

SIZE = {t: len(WORD.findall(t or "")) for _, t, *_ in ROWS}


def _targets(size: dict, weights=(1, 2, 3), most=3):
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = sum(size.values()) - sum(most * size[s] for s in full)
        rest = sum(w for s, w in weight.items() if s not in full)
        target = {s: float(most * size[s]) if s in full else weight[s] * left / rest for s in size}
        more = {s for s in size if s not in full and most * size[s] * rest < weight[s] * left}
        if not more:
            return target
        full |= more


def test_mix_meets_targets(spark):
    rows = mixing.mixed_sizes(documents(spark)).collect()
    size = defaultdict(int)
    for _, t, _, s in ROWS:
        size[s] += SIZE[t]
    target = _targets(size)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d, SIZE[t]) for d, t, *_ in ROWS)
    source = {d: s for d, _, _, s in ROWS if d is not None}
    taken = defaultdict(int)
    for r in rows:
        if r["doc_id"] is not None:
            s = source[r["doc_id"]]
            assert (r["source_size"], r["target"]) == (size[s], target[s])
        taken[r["source_size"], r["target"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for group, words in taken.items():  # sources of the same size and target together; repeated rows share a cut evenly
        alike = sum((size[s], target[s]) == group for s in size)
        assert abs(words - alike * int(group[1])) <= 2 * alike, group
    total = sum(r["taken"] for r in rows)
    assert abs(total - sum(int(t) for t in target.values())) <= 4  # repeated rows share a cut evenly
    again = mixing.mixed_sizes(documents(spark).repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mixed_sizes(documents(spark, [])).count() == 0


def test_mixed_documents_agree_with_the_sizes(spark):
    docs = documents(spark)
    taken = Counter()
    for r in mixing.mixed_sizes(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    got, texts = Counter(), {d: t for d, t, *_ in ROWS if d is not None}
    for r in out.collect():
        got[r["doc_id"]] += len(WORD.findall(r["text"] or ""))
        assert r["row"] == "clash" and r["n_chars"] == (None if r["text"] is None else len(r["text"]))
        if r["doc_id"] is not None:
            assert (texts[r["doc_id"]] or "").startswith(r["text"] or "")
    assert {d: n for d, n in got.items() if n} == {d: n for d, n in taken.items() if n}


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    path = vocabulary(None)
    rng = random.Random(0)
    texts = [None, "", " ", " a", "a ", "a  b", "x \n y", "it's <|endoftext|> ok", "'s 't", "\u00a0a \u00a0b", "12 34 é è　z", "a\u2003 b"] + [
        "".join(rng.choices("ab é'\n\t.,1 ", k=rng.randint(0, 60))) for _ in range(400)]
    whole = Tokenizer.from_file(path)
    encoder = Encoder(path)
    for part in (texts, texts[::-1]):
        ids, bounds = encoder.encode(pa.array(part, pa.string()))
        for i, t in enumerate(part):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == whole.encode(t or "", add_special_tokens=False).ids
    assert encoder.ranked is not None


def test_pieces_hold_every_id_once(spark):
    path = vocabulary(None)
    docs = documents(spark, [r for r in ROWS if r[0] not in (7, None)])
    rows = cutting_stock.pack(docs).collect()
    encoder = Encoder(path)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for d, t, *_ in ROWS:
        if d in (7, None):
            continue
        ids, _ = encoder.encode(pa.array([t], pa.string()))
        ids, at = np.append(ids, 1).astype("<u4"), 0
        for r in sorted(by[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    _check_sequences(rows)
    repeated = cutting_stock.pack(documents(spark)).collect()
    _check_sequences(repeated)
    assert sum(r["doc_id"] == 7 for r in repeated) == 2
    assert cutting_stock.pack(documents(spark, [])).count() == 0


def _check_sequences(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= cutting_stock.CAPACITY


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_the_demand_closely(seed):
    rng = np.random.default_rng(seed)
    room = 64
    demand = np.bincount(rng.integers(1, room + 1, size=4000 if seed else 3), minlength=room + 1)[1:]
    plan = cutting_stock.plan_patterns(demand)
    sizes = np.arange(1, room + 1)
    assert (sum(p * c for p, c in plan) == demand).all() and all((p * sizes).sum() <= room for p, _ in plan)
    bound = (demand * sizes).sum() / room
    assert sum(c for _, c in plan) <= np.ceil(max(bound, demand[room // 2:].sum())) * 1.01 + 3
    assert cutting_stock.plan_patterns(np.zeros(room, dtype=np.int64)) == []


def _toxic_corpus(n=900):
    rng = random.Random(9)
    common = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    rude, stem = ["snarfle", "grobnik", "zwatch", "plonker"], "qrix"
    docs, labels = [], []
    for d in range(n):
        words = rng.choices(common, k=rng.randint(8, 200))
        toxic = d % 5 == 0
        for _ in range(max(2, len(words) // 30) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(rude) if d % 2 else stem + rng.choice(common)
        docs.append((d, " ".join(words), "en", "s"))
        labels.append((d, int(toxic), 0))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = _toxic_corpus()
    extra = [(5000, None, None, None), (5001, "", "en", "s"), (None, "grobnik grobnik", "en", "s"),
             (5002, "bab " * 40000 + "y" * 70000, "en", "s"), (5003, "grobnik zwatch " * 30000, "en", "s"), docs[5], docs[5]]
    table = spark.createDataFrame(labels + [(0, 1, 0), (7777, None, 0), (None, 1, 1)], "doc_id long, toxic int, score int")
    rows = weak_labels.toxicity(documents(spark, docs + extra), table).collect()
    assert len(rows) == len(docs) + len(extra)
    assert {r["predicted"] for r in rows if r["doc_id"] == 5002} == {0} and {r["predicted"] for r in rows if r["doc_id"] == 5003} == {1}
    assert len({r["score"] for r in rows if r["doc_id"] == docs[5][0]}) == 1
    truth = {d: t for d, t, _ in labels}
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 3 == 1)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(truth[r["doc_id"]] == r["predicted"] for r in held) / len(held) > 0.97
    assert {r["predicted"] for r in rows if r["doc_id"] in (5000, 5001)} == {0}


def test_held_out_labels_change_nothing(spark):
    docs, labels = _toxic_corpus(300)
    schema = "doc_id long, toxic int, quality int"
    flipped = [(d, 1 - t if zlib.crc32(str(d).encode()) % 3 == 1 else t, q) for d, t, q in labels]
    table = documents(spark, docs)
    scores = lambda x: sorted((r["doc_id"], r["score"]) for r in weak_labels.toxicity(table, spark.createDataFrame(x, schema)).collect())
    assert scores(labels) == scores(flipped)


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)], [(1, 1, 0), (2, 1, 0)]])
def test_toxicity_without_both_labels(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    rows = weak_labels.toxicity(documents(spark), table).collect()
    assert len(rows) == len(ROWS) and {r["predicted"] for r in rows} == {0}
    assert weak_labels.toxicity(documents(spark, []), table).count() == 0


def test_label_model_finds_good_bad_and_repeated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    good = rng.random((4000, 4)) < np.where(y, 0.8, 0.05)[:, None]
    noise = rng.random((4000, 2)) < 0.3
    votes = np.concatenate([good, good[:, :1], noise], axis=1)
    posterior, rates, correlations = weak_labels.label_model(votes, good.sum(axis=1) > 1)
    assert ((posterior > 0.5) == y).mean() > 0.97
    assert (np.abs(rates[0, :4] - 0.8) < 0.1).all() and (np.abs(rates[1, :4] - 0.05) < 0.05).all()
    assert abs(rates[0, 5] - rates[1, 5]) < 0.1 and correlations[0, 4] > 0.7 and abs(correlations[0, 1]) < 0.2


@pytest.mark.parametrize("written_first", [True, False])
def test_dedup_stages_decide_by_row(spark, tmp_path, written_first):
    """Ids that are null or repeated keep and drop nothing but their own rows; extra columns stay those of the row kept."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(5, "dup X", "a"), (9, "DUP x", "b"), (5, "unique five", "c"), (1, "Same text", "d"), (None, "same text", "e"), (None, "other text", "f"),
            (None, "Other Text", "g"), (7, near, "h"), (None, near + " more", "i"), (7, "seven", "j"), (3, None, "k"), (4, "", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if written_first:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    exact = stages["exact_dedup"](spark, docs, "")
    assert exact.columns == docs.columns
    kept = sorted(r["source"] for r in exact.collect())
    assert kept in (["b", "c", "d", "f", "h", "i", "j", "l"], ["b", "c", "d", "g", "h", "i", "j", "l"])
    assert kept == sorted(r["source"] for r in stages["exact_dedup"](spark, docs, "").collect())
    near_rows = sorted(r["source"] for r in stages["near_dedup"](spark, docs, "").collect())
    # of equal texts the smallest id stays, of near copies too: 5 before 9, 1 and 7 before null
    assert near_rows in (["a", "c", "d", "f", "h", "j", "k", "l"], ["a", "c", "d", "g", "h", "j", "k", "l"])


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix", "pack"]
    toxic, labels = _toxic_corpus(600)
    rows = ROWS + [(1000 + d, t, la, s) for d, t, la, s in toxic]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1000 + d, t, q) for d, t, q in labels], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["toxicity"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    truth = {1000 + d: t for d, t, _ in labels}
    ids = {r["doc_id"] for r in kept.collect()}
    assert sum((d in ids) != (t == 0) for d, t in truth.items()) <= 20 and {d for d, *_ in ROWS} <= ids
    exact = stages["exact_dedup"](spark, docs, str(tmp_path))
    assert exact.columns == docs.columns
    low = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    assert Counter(low(r["text"]) for r in exact.collect()) == Counter({low(t): 1 for _, t, *_ in rows})
    near = stages["near_dedup"](spark, docs, str(tmp_path)).collect()
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    want = {c if s else d for (d, s), c in zip(sets, components(sets), strict=True)}
    assert Counter(r["doc_id"] for r in near if r["doc_id"] is not None) == Counter(d for d in want if d is not None)
    assert stages["mix"](spark, docs, str(tmp_path)).columns == docs.columns
    assert set(corpus_pipeline.run(spark, str(tmp_path)).columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
