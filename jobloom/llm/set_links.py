"""Links and components among sets that share index keys, without all pairs of a key.

Postings (key, sid, pri, own columns) are sorted by (key, pri) over ranges, so that a key with any share of the rows spans many tasks.
In the first round each row meets one pivot: the row of its key with the least priority in its range. Priorities are global, sets with few
shingles of their own come first: the many keys of a group of near copies mostly choose the same central pivot, and the distinct pairs are few. Links that hold join components.
Keys whose rows are in one component are done; under the others rows of different components meet, the pivots in rounds that grow
``GROWTH``-fold, until every pair of different components under a common key has been compared. No such pair is left out.

Postings may carry ``prev``, the key before theirs in the set's own order (the set's number for the first). Two sets that share a key and the one before it have met there, so a pair
is made once for each stretch of common keys and not for each key.

With ``sharpened`` the sets under open keys also carry ``ANCHORS`` keys of theirs, the smallest of each class of keys. Two sets with an equal one
have it in common and are paired under the first such key alone, else as above. Anchors are chosen once, before the first of these rounds: all common keys of
sets in different components are open then, so the key of a pair stays the same through all rounds and is open until the two are in one component. Shingles that no
other of these sets has are counted apart from the sketches, in which they would cancel: a sharper bound, which holds for all links too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .common import join_salted, shuffle_partitions, written
from .components import components
from .shingles import set_digest, shingle_sets, slices

#: rows of 64 bits of the filter that passes over documents out of consideration; a bounded broadcast
FILTER_WORDS = 1 << 16
#: pivots of the second round; how many more each later round compares
GROWTH = 4096
#: rows of a key that one task compares with the pivots
SALTED = 1024
#: keys that a set carries to tell where it meets another
ANCHORS = 4


SKETCH = [f"s{i}" for i in range(8)]


def parity_bound(percent: int, alone: bool = False) -> str:
    """SQL that holds for all links: the parity sketches of two sets differ in no more classes than the sets differ in shingles.
    ``alone``: the sketches are without the ``alone`` shingles that no other set has, in which any two sets differ."""
    differ = " + ".join([f"bit_count({{a}}{c} ^ {{b}}{c})" for c in SKETCH] + ["{a}alone + {b}alone"] * alone)
    return f"{100 + percent} * ({differ}) <= {100 - percent} * ({{a}}n + {{b}}n)"


def _sketched(batches):
    """Sets (tokens, ...) with s0..s7: for each of 512 classes of shingles whether their number is odd."""
    for batch in batches:
        bits = np.zeros((batch.num_rows, 512), dtype=bool)
        for i, tokens in enumerate(batch.column(0)):
            x = np.frombuffer(tokens.as_buffer(), dtype=np.uint64)
            bits[i] = np.bincount((x & np.uint64(511)).astype(np.int64), minlength=512) & 1
        words = np.packbits(bits, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(words[:, k].copy()) for k in range(8))], [*batch.schema.names, *SKETCH])


def with_sketches(sets: DataFrame) -> DataFrame:
    """``sets`` with the parity sketch of its column ``tokens``."""
    rows = sets.select("tokens", *[c for c in sets.columns if c != "tokens"])
    return rows.mapInArrow(_sketched, T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in SKETCH)]))


def spread_evenly(sid: str = "sid") -> F.Column:
    """A number in [0, 1) that depends on the set's number alone."""
    return F.expr(f"xxhash64({sid}) / 18446744073709551616.0D + 0.5D")


def priority(own: str, n: str = "n") -> F.Column:
    """A number in [0, 1) for a set with ``own`` of its ``n`` shingles in no other set: central sets first, in 64 steps, and even inside a step."""
    return (F.expr(f"least(floor(64 * ({own}) / {n}), 63)") + spread_evenly()) / 64


def filter_bits(classes: DataFrame) -> np.ndarray:
    """A bit array of the column ``c1`` of ``classes``: no member is missed, others may pass."""
    words = classes.groupBy(F.shiftrightunsigned("c1", 48).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(c1 & 63 as int)))").alias("bits"))
    bits = np.zeros(FILTER_WORDS, dtype=np.int64)
    for row in words.collect():  # FILTER_WORDS rows at most
        bits[row["word"]] = row["bits"]
    return bits.view(np.uint64)


def token_sets(texts: DataFrame, bits: np.ndarray, width: int, name: str) -> DataFrame:
    """(doc_id, c1, c2, n, tokens): one row per document; tokens (packed) once a task for each set that ``bits`` may hold."""

    def run(batches):
        sent = set()
        for batch in batches:
            for a, b in slices(batch.column(1)):
                found = shingle_sets(batch.column(1).slice(a, b - a), width)
                c1, c2, packed = [], [], []
                for s in found:
                    digest = set_digest(s)
                    u = digest[0] & (1 << 64) - 1
                    hit = len(s) and digest not in sent and int(bits[u >> 48]) >> (u & 63) & 1
                    if hit:
                        sent.add(digest)
                    c1.append(digest[0])
                    c2.append(digest[1])
                    packed.append(s.tobytes() if hit else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                     pa.array([len(s) for s in found], pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "c1", "c2", "n", "tokens"])

    schema = T.StructType([T.StructField("doc_id", texts.schema["doc_id"].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("c1", "c2", "n")] + [T.StructField("tokens", T.BinaryType())])
    return written(texts.select("doc_id", "text").mapInArrow(run, schema), name)


def common_tokens(x: pa.Array, y: pa.Array):
    """(size of x, size of y, size of the intersection) of packed sets, row by row."""
    last, right = None, None
    for p, q in zip(x, y, strict=True):
        q = q.as_buffer()
        if last is None or not q.equals(last):
            last, right = q, np.frombuffer(q, dtype=np.uint64)
        left = np.frombuffer(p.as_buffer(), dtype=np.uint64)
        if not len(left) or not len(right):
            yield len(left), len(right), 0
            continue
        at = np.searchsorted(right, left)
        yield len(left), len(right), int((right[np.minimum(at, len(right) - 1)] == left).sum())


def similar(percent: int):
    """An Arrow UDF of two packed sets: is 100 times the intersection at least ``percent`` times the union?"""

    @arrow_udf(T.BooleanType())
    def check(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([100 * both >= percent * (m + n - both) and both > 0 for m, n, both in common_tokens(x, y)], pa.bool_())

    return check


def _pivot_rows(batches):
    """Sorted postings (key, sid, pri, ...) with the first row of their key in this range: (..., p_sid, p_...). Keys that occur
    once in the range are left out, but for the first and last, which may go on in the next range."""
    names = None
    held, pivot, first = None, None, True  # a last row that waits; the pivot of the key that goes on

    def columns(batch):
        return [np.asarray(c) for c in batch.columns]

    def out(rows, pivots):
        arrays = [pa.array(c) for c in rows] + [pa.array(c) for i, c in enumerate(pivots) if i not in (0, 2)]
        return pa.RecordBatch.from_arrays(arrays, [*names, *(f"p_{n}" for i, n in enumerate(names) if i not in (0, 2))])

    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        rows = columns(batch)
        if held is not None:
            rows = [np.concatenate([h, c]) for h, c in zip(held, rows, strict=True)]
            held = None
        key = rows[0]
        head = np.ones(len(key), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(head)
        group = np.cumsum(head) - 1
        count = np.bincount(group)
        source = [c[start] for c in rows]
        goes_on = pivot is not None and pivot[0][0] == key[0]
        if goes_on:
            for c, p in zip(source, pivot, strict=True):
                c[0] = p[0]
        keep = count > 1
        keep[0] = keep[0] or goes_on or first
        waits = count[-1] == 1 and not keep[-1]
        pivot = None if waits else [c[-1:] for c in source]
        if waits:
            held = [c[-1:] for c in rows]
        first = False
        chosen = np.flatnonzero(keep[group])
        yield out([c[chosen] for c in rows], [c[group[chosen]] for c in source])
    if held is not None:
        yield out(held, held)


def pivoted(postings: DataFrame, name: str) -> DataFrame:
    """Postings (key, sid, pri, own columns) under keys that may be shared, each with the pivot of its key and range (p_sid, p_...)."""
    fields = postings.schema.fields
    schema = T.StructType([*fields, *(T.StructField(f"p_{f.name}", f.dataType) for i, f in enumerate(fields) if i not in (0, 2))])
    dealt = postings.repartitionByRange(shuffle_partitions(postings.sparkSession), "key", "pri").sortWithinPartitions("key", "pri", "sid")
    return written(dealt.mapInArrow(_pivot_rows, schema), name)


def _met(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with all columns of both sets (a_..., b_...); a set may have many partners in ``b``, few in ``a``."""
    columns = [c for c in sets.columns if c != "sid"]
    named = lambda x: sets.select(F.col("sid").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in columns])
    return join_salted(pairs.join(named("a"), "a"), named("b"), ["b"], ["a"])


def _shingles(batches):
    """(token, sid): the shingles of sets (sid, tokens)."""
    for batch in batches:
        for sid, tokens in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(tokens.as_buffer(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(np.full(len(x), sid))], ["token", "sid"])


def _marks(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(sid, mark) of the sets in ``rows`` (key, sid). A mark holds n, alone (how many of its shingles no other of the sets has), the sketch s0..s7 of the
    other shingles, and the anchors k0.. (null in classes without a key)."""
    anchors = [F.min(F.expr(f"if(pmod(key, {ANCHORS}) = {i}, key, null)")).alias(f"k{i}") for i in range(ANCHORS)]
    anchored = written(rows.groupBy("sid").agg(*anchors), "anchors")
    tokens = sets.select("sid", "tokens").join(anchored.select("sid"), "sid", "left_semi").mapInArrow(_shingles, "token long, sid long")
    # the bit of a shingle's class, as in ``_sketched``
    bits = [F.expr(f"bit_xor(if(token & 448 = {64 * i}, shiftleft(1L, cast((token & 63) ^ 7 as int)), 0L))").alias(f"x{i}") for i in range(len(SKETCH))]
    alone = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("sets"), F.min("sid").alias("sid")).filter("sets = 1") \
        .groupBy("sid").agg(F.count(F.lit(1)).alias("alone"), *bits)
    return anchored.join(sets.select("sid", "n", *SKETCH), "sid").join(alone, "sid", "left").select("sid", F.struct(
        "n", F.coalesce("alone", F.lit(0)).alias("alone"), *[F.expr(f"{c} ^ coalesce(x{i}, 0L)").alias(c) for i, c in enumerate(SKETCH)],
        *[f"k{i}" for i in range(ANCHORS)]).alias("mark"))


def _meetings(x: DataFrame, y: DataFrame, once: str) -> DataFrame:
    """(a, b): the rows of ``x`` and ``y`` under common keys for which ``once`` holds."""
    return x.join(y, ["key", "salt"]).filter(once).select("a", "b")


def _prefixed(condition: str, a: str, b: str) -> str:
    return condition.replace("{a}", a).replace("{b}", b)


def linked(busy: DataFrame, sets: DataFrame, bound: str, near: str, check: Callable, sketch: Sequence[str], sharpened: str = "") -> DataFrame | None:
    """(v, label): the sets that have links and the component of each; None without any.

    ``busy``: as ``pivoted`` gives it. ``sets``: (sid, n, tokens, sketch columns). ``bound``: SQL that holds for all links under a key, in the
    postings' own columns ({a}n, {b}n, ...); ``near``: SQL that holds for all links, in the sketches ({a}, {b} as well).
    ``check(tokens, tokens)`` decides. ``sharpened``: SQL that holds for all links, in the marks of ``_marks``, instead of ``near`` under keys
    that are open after the pivots.
    """
    own = [c.name for c in busy.schema.fields if not c.name.startswith("p_") and c.name not in ("key", "sid", "pri")]

    def verified(pairs):
        return written(_met(pairs, sets).filter(_prefixed(near, "a_", "b_")).filter(check(F.col("a_tokens"), F.col("b_tokens"))).select("a", "b"), "links")

    pairs = busy.filter("sid <> p_sid").filter(_prefixed(bound, "", "p_")).select(F.col("sid").alias("a"), F.col("p_sid").alias("b")).distinct()
    links = verified(written(pairs, "pairs"))
    labels = None if links.isEmpty() else written(components(links), "labels")
    reach, marks = 0, None
    while True:
        rows = busy.select("key", "sid", spread_evenly().alias("pri"), *own)
        if labels is None:
            rows = rows.withColumn("comp", F.col("sid"))
        else:
            rows = rows.join(labels.withColumnRenamed("v", "sid"), "sid", "left").withColumn("comp", F.coalesce("label", "sid")).drop("label")
        open_ = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("comp").alias("c0"), F.max("comp").alias("c1")) \
            .filter("c0 <> c1").select("key", "c")
        rows = rows.join(open_, "key")
        rows = written(rows if sharpened else rows.join(sets.select("sid", *sketch), "sid"), "open-keys")
        most = rows.agg(F.max("c")).first()[0]
        if not most:
            return labels
        if sharpened:
            if marks is None:
                marks = written(_marks(rows, sets), "marks")
            rows = written(rows.join(marks, "sid"), "marked-keys")
        # the rows of this round that all others meet; all of them at last
        pivots = rows.filter(f"pri * c >= {reach} and pri * c < {max(1, reach) * GROWTH}")
        salts = F.expr(f"cast(ceil(c / {SALTED}) as int)")
        columns = [*own, *(["mark"] if sharpened else sketch), "pri", "comp"]
        x = rows.withColumn("salt", F.pmod(F.xxhash64("sid"), salts).cast("int")).select(
            "key", "salt", F.col("sid").alias("a"), *[F.col(c).alias(f"a_{c}") for c in columns])
        y = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).select(
            "key", "salt", F.col("sid").alias("b"), *[F.col(c).alias(f"b_{c}") for c in columns])
        once = "(a_pri > b_pri or (a_pri = b_pri and a > b)) and a_comp <> b_comp"
        first = "a_prev <> b_prev" if "prev" in own else "true"
        if sharpened:
            meeting = ", ".join(f"if(a_mark.k{i} = b_mark.k{i}, a_mark.k{i}, null)" for i in range(ANCHORS))
            first = f"coalesce(key = coalesce({meeting}), {first})"
        close = _prefixed(sharpened, "a_mark.", "b_mark.") if sharpened else _prefixed(near, "a_", "b_")
        once += f" and {first} and {_prefixed(bound, 'a_', 'b_')} and {close}"
        found = verified(written(_meetings(x, y, once).distinct(), "pairs"))
        if not found.isEmpty():
            links = links.union(found)
            labels = written(components(links), "labels")
        reach = max(1, reach) * GROWTH
        if reach >= most:
            return labels


def named_rows(shingled: DataFrame, sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of the rows ``shingled`` (doc_id, c1, c2, n), from the components of ``sets`` (sid, c1, c2)."""
    if labels is None:
        labels = sets.select(F.col("sid").alias("v"), F.col("sid").alias("label")).filter("false")
    classes = shingled.filter("n > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("own"))
    named = sets.select("c1", "c2", "sid").join(labels.withColumnRenamed("v", "sid"), "sid").select("c1", "c2", "label")
    classes = written(classes.join(named, ["c1", "c2"], "left"), "classes")
    member = classes.filter("label is not null")
    joined = member.groupBy("label").agg(F.min("own").alias("group"))
    ids = join_salted(member, joined, ["label"], ["c1", "c2"]).select("c1", "c2", F.col("group").alias("component_id"))
    ids = ids.unionByName(classes.filter("label is null").select("c1", "c2", F.col("own").alias("component_id")))
    rows = shingled.select("doc_id", F.col("n").alias("n_shingles"), "c1", "c2")
    out = join_salted(rows.filter("n_shingles > 0"), ids, ["c1", "c2"], ["doc_id"]).select("doc_id", "n_shingles", "component_id")
    return out.union(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def jaccard_sql(width: int, percent: int, more: str = "") -> str:
    """DuckDB SQL of the components by plain comparison: a join on shingles and a recursive closure."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 1}, least(len(w), 1)) + 1)) AS i FROM words),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {width - 1}], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * m >= {percent} * (x.n + y.n - m)),
reach(v, r) AS (SELECT doc_id, doc_id FROM words UNION SELECT v, b FROM reach JOIN links ON r = a),
least_ AS (SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY v)
SELECT l.doc_id, coalesce(n, 0) AS n_shingles, component_id{more}
FROM least_ l LEFT JOIN sizes z ON z.doc_id = l.doc_id
"""
