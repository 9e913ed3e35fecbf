"""Toxicity by weak supervision.

1. Lexicons. Words and word beginnings that labelled toxic texts have far more often than other labelled texts (a
   log-likelihood test on document counts) are dealt out to many lexicon voters; a few pattern voters join them.
2. Label model. A generative model of the votes: a latent label, and for each voter the rate of its vote under
   either label, fitted by expectation-maximisation. Correlations of the voters given the label are estimated too, and a voter counts the
   less the more others repeat it.
3. Classifier. A linear model over the terms is trained on the posterior labels and scores every whole text.

Only texts enter a score. Labels come from rows whose crc32(doc_id) modulo 3 is not 1; ids, languages and sources are never used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from jobloom.operators.joins import join_small

from .common import table, written
from .shingles import _BYTE, _STEP, mixed, slices, word_hashes
from .words import text_bytes

#: label model and classifier see at most about this many labelled rows: up to half of either class, and what one class leaves of the
#: other, chosen by a hash of their id and weighted by their class's share of all. The terms come from all labelled rows.
SAMPLE_ROWS = 8000
#: voters that the terms of the classifier are dealt to
VOTERS = 32
#: a term needs this many toxic texts, this log-likelihood ratio, and to be this many times as frequent in toxic texts
LEAST_TEXTS, LEAST_G2, LEAST_LIFT = 3, 10.0, 6.0
#: and it must tell this share of what there is to know about the label: its ratio against that of a term that only and all toxic texts have.
#: Ratios grow with the corpus, so a fixed one alone would let ever weaker terms pass: words of a text that has some copies
LEAST_SHARE = 0.01
#: a voter votes when the strengths of its terms add up to this
LEAST_STRENGTH = 0.3
PREFIXES = (3, 4, 5, 6, 7)
THRESHOLD = 0.7

_WORD = np.ones(256, dtype=bool)  # bytes inside words: letters, digits, and all of multi-byte characters
_WORD[:128] = [chr(b).isalnum() for b in range(128)]


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term hashes, row of each, words of each row): each word with A-Z lower-cased, and its first 3 to 7 bytes."""
    flat, offsets = text_bytes(texts)
    if not len(flat):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    inside = _WORD[flat]
    rows = offsets[(offsets > 0) & (offsets < len(flat))]
    previous, following = np.zeros_like(inside), np.zeros_like(inside)
    previous[1:], following[:-1] = inside[:-1], inside[1:]
    previous[rows] = False
    following[rows - 1] = False
    starts, ends = np.flatnonzero(inside & ~previous), np.flatnonzero(inside & ~following) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    found, owner = [word_hashes(flat, starts, ends)], [row]
    h, powers = np.zeros(len(starts), dtype=np.uint64), np.cumprod(np.full(max(PREFIXES), _STEP, dtype=np.uint64))
    live = np.arange(len(starts))
    for k in range(1, max(PREFIXES) + 1):
        long_enough = ends[live] - starts[live] >= k
        live, h = live[long_enough], h[long_enough]
        data = flat[starts[live] + k - 1]
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
        h = h + _BYTE[data] * powers[k - 1]
        if k in PREFIXES:
            found.append(mixed(h ^ np.uint64(0xA5A5 + k)))
            owner.append(row[live])
    return np.concatenate(found), np.concatenate(owner), np.bincount(row, minlength=len(texts))


def pattern_votes(texts: pa.Array) -> np.ndarray:
    """(rows, patterns): many capitals, many exclamation marks, a mark repeated, many digits."""
    flat, offsets = text_bytes(texts)
    capital, mark, digit = (flat >= 65) & (flat <= 90), flat == 33, (flat >= 48) & (flat <= 57)
    again = np.zeros(len(flat), dtype=bool)
    again[1:] = mark[1:] & mark[:-1]
    size = np.maximum(np.diff(offsets), 1)
    rate = [np.diff(np.concatenate([[0], np.cumsum(x)])[offsets]) for x in (capital, mark, again, digit)]
    return np.stack([rate[0] > 0.2 * size, rate[1] > 0.005 * size, rate[2] > 0, rate[3] > 0.1 * size], axis=1)


def _document_counts(batches):
    """(term, toxic, clean): in how many texts of either label each term occurs, added up per slice."""
    for batch in batches:
        label = np.asarray(batch.column(1)).astype(bool)
        for a, b in slices(batch.column(0)):
            term, row, _ = terms_of(batch.column(0).slice(a, b - a))
            order = np.lexsort((row, term))
            term, row = term[order], row[order]
            once = np.ones(len(term), dtype=bool)
            once[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
            term, toxic = term[once], label[a:b][row[once]]
            name, at = np.unique(term, return_inverse=True)
            total, hits = np.bincount(at, minlength=len(name)), np.bincount(at, weights=toxic, minlength=len(name))
            hits = hits.astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(hits), pa.array(total - hits)], ["term", "toxic", "clean"])


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    accuracies: np.ndarray  # of each voter: rate of its vote on toxic and on other texts
    correlations: np.ndarray  # of the voters, given the label

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, index of the term, strength), once for each pair. The strength grows with the term's share of the text's words."""
        term, row, words = terms_of(texts)
        quick = np.zeros(1 << 16, dtype=bool)
        quick[(self.terms >> np.uint64(48)).astype(np.int64)] = True
        maybe = quick[(term >> np.uint64(48)).astype(np.int64)]
        term, row = term[maybe], row[maybe]
        if not len(term) or not len(self.terms):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        ok = self.terms[at] == term
        pair, times = np.unique(row[ok] * len(self.terms) + at[ok], return_counts=True)
        row = pair // len(self.terms)
        return row, pair % len(self.terms), np.log1p(200 * times / (words[row] + 50))

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.empty(len(texts))
        for a, b in slices(texts):
            row, term, strength = self.hits(texts.slice(a, b - a))
            out[a:b] = np.bincount(row, weights=self.weights[term] * strength, minlength=b - a)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -700, 700)))


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 50,
                counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the latent label, vote rates (2, voters), correlations of the voters given the label.

    ``start`` is the known label of each row; it gives the correlations and half of the weight in each estimate of the rates, which keeps the latent
    label the one that is meant. Correlated voters share their weight: a voter's evidence is divided by the root of one plus
    its correlations with the others, as far as they exceed what chance explains. ``counts`` says for how many rows each stands, the
    same for all rows of a known label, so that it does not matter to the correlations.
    """
    votes, start = votes.astype(float), start.astype(float)
    counts = np.ones(len(start)) if counts is None else counts
    together, posterior = np.zeros((votes.shape[1],) * 2), start
    for weight in (start, 1 - start):
        apart = votes - (weight @ votes + 0.5) / (weight.sum() + 1)
        spread = (apart * weight[:, None]).T @ apart
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        found = spread / scale[:, None] / scale
        together += np.where(np.abs(found) > 0.1 + 2 / np.sqrt(max(weight.sum(), 1)), found, 0) / 2
    np.fill_diagonal(together, 0)
    share = 1 / np.sqrt(1 + np.maximum(together, 0).sum(axis=1))
    for _ in range(rounds):
        belief = (start + posterior) / 2
        toxic, clean = ((w @ votes + 0.5) / (w.sum() + 1) for w in (counts * belief, counts * (1 - belief)))
        odds = np.log((counts @ belief + 1) / (counts @ (1 - belief) + 1))
        odds = odds + votes @ (share * np.log(toxic / clean)) + (1 - votes) @ (share * np.log((1 - toxic) / (1 - clean)))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        done, posterior = np.abs(new - posterior).max() < 1e-4, new
        if done:
            break
    return posterior, np.stack([toxic, clean]), together


def _fit_linear(row: np.ndarray, term: np.ndarray, strength: np.ndarray, n: int, terms: int, target: np.ndarray, counts: np.ndarray,
                penalty: float = 1e-4, steps: int = 1500):
    """Logistic regression on soft labels by accelerated gradient steps; both classes weigh the same. A row stands for ``counts`` rows."""
    weight = counts * np.where(target >= 0.5, 0.5 / max(counts @ target, 1), 0.5 / max(counts @ (1 - target), 1))
    w, b, back_w, back_b = np.zeros(terms), 0.0, np.zeros(terms), 0.0
    most = np.bincount(row, weights=strength ** 2, minlength=n).max(initial=0) + 1
    rate = 4.0 / most
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=back_w[term] * strength, minlength=n) + back_b, -50, 50)))
        error = weight * (p - target)
        new_w = back_w - rate * (np.bincount(term, weights=error[row] * strength, minlength=terms) + penalty * back_w)
        new_b = back_b - rate * error.sum()
        back_w, back_b = new_w + k / (k + 3) * (new_w - w), new_b + k / (k + 3) * (new_b - b)
        w, b = new_w, new_b
    return w, b


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): the labels of the training folds."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")) \
        .filter(~held_out(F.col("doc_id")))
    return written(known, "labels")


def sample_sizes(toxic: int, clean: int, rows: int) -> tuple[int, int]:
    """How many rows of either class the sample has: half of ``rows`` each, and what one class leaves for the other."""
    return min(toxic, max(rows // 2, rows - clean)), min(clean, max(rows // 2, rows - toxic))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, voters: int = VOTERS) -> Model:
    """The model. Without labelled rows of both classes it has no terms and scores every text 0."""
    known = known_labels(labels)
    texts = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # labels of documents that are there: others are no part of the counts nor of the sample
    known = written(known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), "known-labels")
    counts = {r["toxic"]: r["count"] for r in join_small(texts.select("doc_id"), known, "doc_id").groupBy("toxic").count().collect()}
    toxic, clean = counts.get(True, 0), counts.get(False, 0)
    nothing = Model(np.empty(0, np.uint64), np.empty(0), -1e3, np.empty((2, 0)), np.empty((0, 0)))
    if not toxic or not clean:
        return nothing
    share = [n / m for n, m in zip(sample_sizes(toxic, clean, rows), (toxic, clean), strict=True)]
    place = F.xxhash64("doc_id") / F.lit(2.0 ** 64) + 0.5
    chosen = known.filter(place < F.when(F.col("toxic"), share[0]).otherwise(share[1]))
    # labels are broadcast where they are measured small, which spares the texts a shuffle, else dealt with the texts by id
    sample = written(join_small(texts.filter(place < max(share)), chosen, "doc_id").select("text", "toxic"), "training-rows")
    found = join_small(texts, known, "doc_id").select("text", "toxic").mapInArrow(_document_counts, "term long, toxic long, clean long") \
        .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    most = -2 * (toxic * np.log(toxic / (toxic + clean)) + clean * np.log(clean / (toxic + clean)))
    expected = f"(a + b) * {toxic / (toxic + clean)}D"
    part = lambda x, e: f"{x} * ln(greatest({x}, 1e-9D) / greatest({e}, 1e-9D))"
    found = found.filter(f"a >= {LEAST_TEXTS} and (a + 0.5D) / {toxic + 1} >= {LEAST_LIFT} * (b + 0.5D) / {clean + 1}").withColumn(
        "g2", F.expr(f"2 * ({part('a', expected)} + {part('b', f'(a + b - {expected})')})")).filter(f"g2 >= {max(LEAST_G2, LEAST_SHARE * most)}")
    # every term that passes: words of toxic texts alone pass, so their number grows with that vocabulary and not with the corpus
    best = sorted((-r["g2"], r["term"]) for r in found.select("g2", "term").collect())
    if not best:
        return nothing
    ranked = np.array([t for _, t in best], dtype=np.int64).view(np.uint64)
    names = np.sort(ranked)
    model = Model(names, np.zeros(len(names)), 0.0, np.empty((2, 0)), np.empty((0, 0)))
    patterns = pattern_votes(pa.array([""])).shape[1]

    def votes(batches):
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(texts):
                row, term, strength = model.hits(texts.slice(a, b - a))
                first = pa.array(np.searchsorted(row, np.arange(b - a + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(first, pa.array(term)),
                                                  pa.ListArray.from_arrays(first, pa.array(strength)),
                                                  pa.array(pattern_votes(texts.slice(a, b - a)).tolist(), pa.list_(pa.bool_()))], ["toxic", "terms", "strengths", "patterns"])

    # about SAMPLE_ROWS rows of the terms they hold: a bound that does not grow with the corpus
    seen = sample.mapInArrow(votes, "toxic boolean, terms array<long>, strengths array<double>, patterns array<boolean>").collect()
    seen.sort(key=lambda r: (r["toxic"], r["terms"], r["strengths"], r["patterns"]))
    row = np.repeat(np.arange(len(seen)), [len(r["terms"]) for r in seen])
    term = np.array([t for r in seen for t in r["terms"]], dtype=np.int64)
    strength = np.array([x for r in seen for x in r["strengths"]])
    voter = np.empty(len(names), dtype=np.int64)
    voter[np.searchsorted(names, ranked)] = np.arange(len(names)) % voters
    told = np.zeros((len(seen), voters))
    np.add.at(told, (row, voter[term]), strength)
    matrix = np.concatenate([told >= LEAST_STRENGTH, np.array([r["patterns"] for r in seen]).reshape(-1, patterns)], axis=1)
    start = np.array([r["toxic"] for r in seen], dtype=bool)
    each = np.where(start, toxic / max(start.sum(), 1), clean / max((~start).sum(), 1))
    posterior, model.accuracies, model.correlations = label_model(matrix, start, counts=each)
    model.weights, model.bias = _fit_linear(row, term, strength, len(seen), len(names), posterior, each)
    return model


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 3 is 1. A null id counts as an empty text: not held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def scored(model: Model):
    """The score of a text as a column function; null and empty texts are scored like texts without any term."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts))

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are not read. Null texts are empty; null labels are passed
    over, of labels that repeat a doc_id the highest counts; repeated rows are scored alike, very long texts whole. No rows give no rows.
    """
    score = scored(fit(docs, labels))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op4_weak_labels(spark, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
