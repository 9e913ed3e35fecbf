"""Conversation structure repair by a rank-convergence parallel Viterbi.

The cheapest edits that give the role initials ``(s?(ua)+)?`` are a shortest path through four states: START (nothing
yet), S (after the system turn), U (an assistant turn must come), A (a user turn may come). A step backwards over a
row is a min-plus product, so the costs to go from a row on are a vector of four numbers of which only the differences matter.

1. Rows are sorted by (conversation, turn) over ranges. A conversation that lies inside one task's range and has at most
   ``CHUNK_ROWS`` rows is solved there. The rest, conversations at the edge of a range or longer ones, goes on in chunks.
2. Each chunk runs backwards from speculative cost vectors: the four generators of all vectors that can occur. From the row on
   where they differ by constants only (rank one), the chunk's costs no longer depend on what follows it.
3. Chunks that never converge pass on their 4 x 4 map; such maps are composed over doubling distances, so a long stretch
   without convergence takes a logarithmic number of rounds.
4. The fix-up pass starts each chunk from its true end vector and reruns until the vectors equal the stored ones up to a constant.
5. Tracing forward takes at each row the ASCII-least edit that is on a cheapest path; only differences inside the row
   are needed. It is done for the four states a chunk can be entered in; the true ones are found as in 3, by composing maps of states.

No conversation is gathered in one task, but for its SHA-256: a sequential function, fed chunk by chunk from sorted rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import crc32_sql, shuffle_partitions, table, written
from .words import give_back

#: rows, and bytes of text, of a chunk
CHUNK_ROWS = 4096
CHUNK_BYTES = 4 << 20

START, S, U, A = range(4)
_NEXT = (U, U, A, U)
_ROLE = {U: "user", A: "assistant"}
_ACCEPT = (0, 10, 5, 0)
OK, TRUNCATED, DELETED = range(3)
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _generators() -> list[tuple[int, ...]]:
    """Columns of the closure of all bounds v[i] <= v[j] + c that cost vectors keep: an insertion costs 5; what can be done in A
    can be done in START, and back with one system turn deleted; what can be done in S can be done in A and START."""
    far = 99
    c = [[0 if i == j else far for j in range(4)] for i in range(4)]
    for i in range(4):
        c[i][_NEXT[i]] = 5
    c[START][A], c[A][START], c[A][S], c[START][S] = 0, 2, 0, 0
    for k in range(4):
        for i in range(4):
            for j in range(4):
                c[i][j] = min(c[i][j], c[i][k] + c[k][j])
    return [tuple(c[i][j] for i in range(4)) for j in range(4)]


_SPECULATIVE = _generators()


def _moves(code: int, s: int, v: tuple) -> list[tuple[int, str, int]]:
    """(cost to the end, edit, state after it) of the edits of a row itself, in state ``s``; ``v``: costs after the row."""
    fault, initial = divmod(code, 4)
    moves = [(2 + v[s], "D", s)]
    if fault != DELETED:
        more = 5 if fault == TRUNCATED else 0
        if initial == 0 and s == START:
            moves.append((more + v[S], "K", S))
        elif initial == 1 and s != U:
            moves.append((more + v[U], "K", U))
        elif initial == 2 and s == U:
            moves.append((more + v[A], "K", A))
        moves.append((1 + more + v[_NEXT[s]], "R", _NEXT[s]))
    return moves


class Steps:
    """One row backwards and forwards; few different vectors occur, so all steps are remembered."""

    def __init__(self):
        self.known: dict = {}

    def __call__(self, v: tuple, code: int):
        """(vector before the row less its least entry, that entry, for each state: (audit, inserted states, edit, state after, cost))."""
        found = self.known.get((v, code))
        if found is None:
            found = self.known[v, code] = self._step(v, code)
        return found

    @staticmethod
    def _step(v, code):
        base = [min(m[0] for m in _moves(code, s, v)) for s in range(4)]
        full = list(base)
        full[U], full[A] = min(base[U], 5 + base[A]), min(base[A], 5 + base[U])
        full[START], full[S] = min(base[START], 5 + full[U]), min(base[S], 5 + full[U])
        trace = []
        for s in range(4):
            audit, inserted, cost = "", [], 0
            while True:
                tight = {edit: to for c, edit, to in _moves(code, s, v) if c == full[s]}
                if "D" not in tight and 5 + full[_NEXT[s]] == full[s]:
                    s = _NEXT[s]
                    audit += "I"
                    cost += 5
                    inserted.append(s)
                    continue
                edit = min(tight)
                cost += full[s] - v[tight[edit]]
                trace.append((audit + edit, tuple(inserted), edit, tight[edit], cost))
                break
        least = min(full)
        return tuple(x - least for x in full), least, trace


def _tail(s: int) -> list[int]:
    """States inserted after the last row."""
    return [U, A] if s == S else [A] if s == U else []


def _row_code(role: str, text: str, seen: bool) -> tuple[int, str]:
    """(code, fault counted) of the first copy of a row."""
    initial = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
    last = text.rstrip(_SPACE)[-1:]
    if not last:
        return DELETED * 4 + initial, "blank"
    if seen:
        return DELETED * 4 + initial, "duplicate"
    if last not in ".!?":
        return TRUNCATED * 4 + initial, "truncated"
    return OK * 4 + initial, ""


def _faults(rows, first=None) -> dict:
    """Codes and counts of rows (turn, role, text, copies) in order. ``first``: whether each row is the first of its role and text;
    if not given, found here."""
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "codes": bytearray(), "turns": 0, "lo": None, "hi": None, "head": None, "end": None}
    seen = set()
    for k, (turn, role, text, copies) in enumerate(rows):
        if not copies:
            out["codes"].append(255)
            continue
        known = (role, text) in seen if first is None else not first[k]
        if first is None:
            seen.add((role, text))
        code, fault = _row_code(role, text, known)
        if fault:
            out[fault] += 1
        if copies > 1:
            out["blank" if fault == "blank" else "duplicate"] += copies - 1
        out["illegal"] += copies - 1
        if out["end"] is not None and out["end"] + role[:1] not in _LEGAL:
            out["illegal"] += 1
        out["end"] = role[:1]
        if out["head"] is None:
            out["head"] = role[:1]
        out["codes"].append(code)
        if turn is not None:
            if out["hi"] != turn:
                out["turns"] += 1
            out["lo"] = turn if out["lo"] is None else out["lo"]
            out["hi"] = turn
    return out


def _backwards(codes, v, step, stop=None):
    """Vectors after each row from the end vector ``v`` on; ``stop``: known vectors after each row, run until one is met again."""
    after = [None] * len(codes)
    total = 0
    for i in range(len(codes) - 1, -1, -1):
        if stop is not None and stop[i] == v:
            after[:i + 1] = stop[:i + 1]
            return after, None, None
        after[i] = v
        if codes[i] != 255:
            v, least, _ = step(v, codes[i])
            total += least
    return after, v, total


def _forwards(codes, copies, after, s, step):
    """(audit, [(inserted states, edit, state after) or None for no row], state after the last row, cost)."""
    audit, edits, cost = [], [], 0
    for code, n, v in zip(codes, copies, after, strict=True):
        if code == 255:
            edits.append(None)
            continue
        text, inserted, edit, s, c = step(v, code)[2][s]
        audit.append(text)
        edits.append((inserted, edit, s))
        cost += c
        if n > 1:
            audit.append("D" * (n - 1))
            cost += 2 * (n - 1)
    return "".join(audit), edits, s, cost


def _repaired(rows, edits, tail=()) -> list[str]:
    out = []
    for (_, role, text, _), e in zip(rows, edits, strict=True):
        if e is None:
            continue
        inserted, edit, s = e
        out.extend(f"{_ROLE[x]}:" for x in inserted)
        if edit != "D":
            out.append(f"{role if edit == 'K' else _ROLE[s]}:{text}")
    out.extend(f"{_ROLE[x]}:" for x in tail)
    return out


def _solved(rows, step) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of a whole conversation."""
    f = _faults(rows)
    after, _, _ = _backwards(f["codes"], _ACCEPT, step)
    audit, edits, s, cost = _forwards(f["codes"], [r[3] for r in rows], after, START, step)
    tail = _tail(s)
    gaps = f["hi"] - f["lo"] + 1 - f["turns"] if f["turns"] else 0
    text = "\n".join(_repaired(rows, edits, tail))
    return (gaps, f["blank"], f["duplicate"], f["truncated"], f["illegal"], cost + 5 * len(tail), audit + "I" * len(tail),
            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, copies) after the planted damage, by crc32 of "conv_id:turn" modulo 20; nulls count as one
    space. A dropped row stays as a row of 0 copies without turn, role and text, so that its conversation is known."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), kind.alias("kind"))
    gone = F.col("kind") == 0
    text = F.when(gone | (F.col("kind") == 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _collapsed(batches):
    """Equal rows of a batch become one with the sum of their copies: many copies of one row cannot fill a task."""
    for batch in batches:
        if batch.num_rows:
            keys = ["conv_id", "turn", "role", "text"]
            rows = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([("copies", "sum")])
            rows = rows.select([*keys, "copies_sum"]).rename_columns([*keys, "copies"])
            yield from rows.cast(batch.schema).to_batches()
    give_back()


_RAW = ("block", "pos", "turn", "role", "text", "copies")
_RESULT = ("gaps", *_COUNTS, "audit", "repaired_sha256")


def _sorted_rows(conv_type: T.DataType) -> T.StructType:
    kinds = {"role": T.StringType(), "text": T.StringType(), "audit": T.StringType(), "repaired_sha256": T.StringType()}
    return T.StructType([T.StructField("conv_id", conv_type)] + [
        T.StructField(c, kinds.get(c, T.LongType())) for c in (*_RAW, *_RESULT)])


def _solve_inner(chunk_rows: int, chunk_bytes: int, schema: pa.Schema):
    """Sorted rows of a range: conversations inside it are solved, those at its edges and long ones go on as rows with block and place."""

    def run(batches):
        part, step = TaskContext.get().partitionId(), Steps()
        out: list[tuple] = []
        state = {"block": 0, "pos": 0, "bytes": 0}

        def flush():
            names = ["conv_id", *_RAW, *_RESULT]
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            batch = pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(columns, names, strict=True)], names)
            out.clear()
            state["bytes"] = 0
            return batch

        def open_rows(conv, rows):
            for turn, role, text, copies in rows:
                out.append((conv, part << 33 | state["block"], part << 40 | state["pos"], turn, role, text, copies, *[None] * len(_RESULT)))
                state["pos"] += 1
            state["block"] += 1

        conv, rows, held, n_conv, is_open = None, [], 0, 0, False

        def finish(last):
            if rows or is_open:
                if n_conv == 0 or last or is_open:
                    if rows:
                        open_rows(conv, rows)
                else:
                    out.append((conv, *[None] * len(_RAW), *_solved(rows, step)))

        for batch in batches:
            for c, *row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if rows or is_open:
                    if c != conv:
                        finish(False)
                        rows, held, n_conv, is_open = [], 0, n_conv + 1, False
                    elif len(rows) >= chunk_rows or held >= chunk_bytes:
                        open_rows(conv, rows)
                        rows, held, is_open = [], 0, True
                conv = c
                rows.append(tuple(row))
                size = len(row[1]) + len(row[2])
                held += size
                state["bytes"] += size
                if len(out) >= 4096 or state["bytes"] >= 2 * chunk_bytes:
                    yield flush()
        finish(True)
        yield flush()
        give_back()

    return run


_CHUNK = T.StructType([T.StructField(c, T.LongType()) for c in ("block", "blank", "duplicate", "truncated", "illegal", "turns", "lo", "hi")] + [
    T.StructField("head", T.StringType()), T.StructField("end", T.StringType()), T.StructField("codes", T.BinaryType()),
    T.StructField("copies", T.ArrayType(T.LongType())), T.StructField("settled", T.BinaryType()), T.StructField("one", T.BooleanType()),
    T.StructField("map", T.ArrayType(T.LongType()))])


def _by_block(batches):
    """Consecutive rows of one block: (block, list of rows)."""
    block, rows = None, []
    for batch in batches:
        for b, *row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if b != block:
                if rows:
                    yield block, rows
                block, rows = b, []
            rows.append(row)
    if rows:
        yield block, rows
    give_back()


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema.names)


def _speculate(schema: pa.Schema):
    """Chunks (block, pos, mark, turn, role, text, copies) run from the speculative vectors; mark 0 says that the row of this place is the first of its role and text."""

    def run(batches):
        step = Steps()
        for block, marked in _by_block(batches):
            first, rows = [], []
            held = None
            for pos, mark, *row in marked:
                if mark == 0:
                    held = pos
                else:
                    rows.append(tuple(row))
                    first.append(held == pos)
            f = _faults(rows, first)
            codes, n = f["codes"], len(f["codes"])
            vectors, sums, settled, one = list(_SPECULATIVE), [0] * 4, bytearray(), False
            for i in range(n - 1, -1, -1):
                if codes[i] != 255:
                    if one:
                        settled.extend(vectors[0])
                        v, least, _ = step(vectors[0], codes[i])
                        vectors, sums = [v] * 4, [x + least for x in sums]
                    else:
                        for j in range(4):
                            vectors[j], least, _ = step(vectors[j], codes[i])
                            sums[j] += least
                        one = vectors.count(vectors[0]) == 4
                elif one:
                    settled.extend(vectors[0])
            matrix = [vectors[j][i] + sums[j] for i in range(4) for j in range(4)]
            yield _arrow([(block, f["blank"], f["duplicate"], f["truncated"], f["illegal"], f["turns"], f["lo"], f["hi"], f["head"], f["end"], bytes(codes),
                           [r[3] for r in rows], bytes(settled), one, matrix)], schema)

    return run


_TRACED = T.StructType([T.StructField("block", T.LongType()), T.StructField("to", T.ArrayType(T.LongType())), T.StructField("costs", T.ArrayType(T.LongType())),
                        T.StructField("audits", T.ArrayType(T.StringType())), T.StructField("after", T.BinaryType())])


def _vector(values) -> tuple:
    low = min(values)
    return tuple(x - low for x in values)


def _fix_up(schema: pa.Schema):
    """(block, codes, copies, settled, last, vector after the chunk): rerun until the stored vectors are met, then trace from each state."""

    def run(batches):
        step = Steps()
        for batch in batches:
            for block, codes, copies, settled, last, v in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                known = [tuple(settled[k:k + 4]) for k in range(0, len(settled), 4)][::-1]
                known += [None] * (len(codes) - len(known))
                after, _, _ = _backwards(codes, _vector(v), step, known)
                traces = []
                for s in range(4):
                    audit, _, to, cost = _forwards(codes, copies, after, s, step)
                    tail = _tail(to) if last else []
                    traces.append((audit + "I" * len(tail), to, cost + 5 * len(tail)))
                yield _arrow([(block, [t[1] for t in traces], [t[2] for t in traces], [t[0] for t in traces],
                               bytes(x for w in after for x in w))], schema)

    return run


def _piece_rows(schema: pa.Schema):
    """Rows of a block behind one row that holds its traced vectors and its true state: the repaired lines of the block."""

    def run(batches):
        step = Steps()
        for block, marked in _by_block(batches):
            head, rows = marked[0], [tuple(r[2:6]) for r in marked[1:]]
            after, enter, last, seq = head[6], head[7], head[8], head[9]
            vectors = [tuple(after[k:k + 4]) for k in range(0, len(after), 4)]
            codes = head[10]
            _, edits, to, _ = _forwards(codes, [r[3] for r in rows], vectors, enter, step)
            lines = _repaired(rows, edits, _tail(to) if last else [])
            yield _arrow([(block, seq, len(lines), "\n".join(lines).encode("utf-8", "surrogatepass"))], schema)

    return run


def _digests(conv_type: pa.DataType):
    """Sorted (conv_id, seq, lines, piece): one SHA-256 a conversation, fed piece by piece."""

    def run(batches):
        conv, digest, begun = None, None, False
        out = []
        for batch in batches:
            for c, _, n, piece in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if digest is None or c != conv:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest, begun = c, hashlib.sha256(), False
                if n:
                    digest.update(b"\n" + piece if begun else piece)
                    begun = True
        if digest is not None:
            out.append((conv, digest.hexdigest()))
        ids, hashes = zip(*out, strict=True) if out else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(ids, conv_type), pa.array(hashes, pa.string())], ["conv_id", "repaired_sha256"])

    return run


_PRODUCT = ("transform(sequence(0, 15), i -> array_min(transform(sequence(0, 3), k -> {a}[i div 4 * 4 + k] + {b}[k * 4 + i % 4])))")
_APPLIED = "transform(sequence(0, 3), i -> array_min(transform(sequence(0, 3), k -> {a}[i * 4 + k] + {b}[k])))"


def _end_vectors(chunks: DataFrame) -> DataFrame:
    """(gid, vector): the cost vector before each chunk, up to a constant. Chunks of rank one know it; others compose their maps over doubling distances."""
    accept = f"array({', '.join(f'{x}L' for x in _ACCEPT)})"
    state = chunks.select(
        "gid", F.when(F.expr("next is not null and not one"), F.col("next")).alias("next"), "map",
        F.when(F.expr("next is null"), F.expr(_APPLIED.format(a="map", b=accept)))
        .when(F.col("one"), F.expr("transform(sequence(0, 3), i -> map[i * 4])")).alias("vector"))
    state = written(state, "cost-vectors")
    while not state.filter("vector is null").isEmpty():
        far = state.select(F.col("gid").alias("next"), F.col("next").alias("far"), F.col("map").alias("more"), F.col("vector").alias("known"))
        open_ = state.filter("vector is null").drop("vector").join(far, "next").select(
            "gid", F.when(F.expr("known is null"), F.col("far")).alias("next"),
            F.when(F.expr("known is null"), F.expr(_PRODUCT.format(a="map", b="more"))).otherwise(F.col("map")).alias("map"),
            F.when(F.expr("known is not null"), F.expr(_APPLIED.format(a="map", b="known"))).alias("vector"))
        state = written(state.filter("vector is not null").unionByName(open_), "cost-vectors")
    return state.select("gid", "vector")


def _entered(traced: DataFrame) -> DataFrame:
    """(gid, enter): the state in which each chunk is entered, from the maps of states of the chunks before."""
    state = written(traced, "states")  # gid, prev, fn (of the chunk before), enter
    while not state.filter("enter is null").isEmpty():
        far = state.select(F.col("gid").alias("prev"), F.col("prev").alias("far"), F.col("fn").alias("before"), F.col("enter").alias("known"))
        open_ = state.filter("enter is null").drop("enter").join(far, "prev").select(
            "gid", F.when(F.expr("known is null"), F.col("far")).alias("prev"),
            F.when(F.expr("known is null"), F.expr("transform(before, x -> fn[cast(x as int)])")).otherwise(F.col("fn")).alias("fn"),
            F.expr("fn[cast(known as int)]").alias("enter"))
        state = written(state.filter("enter is not null").unionByName(open_), "states")
    return state.select("gid", "enter")


def _stitched(rows: DataFrame) -> DataFrame:
    """The result rows of the conversations whose rows lie in several chunks or at the edge of a range."""
    n, arrow = shuffle_partitions(rows.sparkSession), _arrow_schema
    firsts = rows.filter("copies > 0").groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(
        F.min(F.struct("pos", "block")).alias("at")).select(F.col("at.block").alias("block"), F.col("at.pos").alias("pos"), F.lit(0).alias("mark"))
    marked = rows.select("block", "pos", F.lit(1).alias("mark"), "turn", "role", "text", "copies").unionByName(firsts, allowMissingColumns=True)
    chunks = written(marked.repartition(n, "block").sortWithinPartitions("block", "pos", "mark").mapInArrow(_speculate(arrow(_CHUNK)), _CHUNK), "chunks")

    # chunks get consecutive numbers: one count for each range of the sort
    whose = rows.select("block", "conv_id").groupBy("block").agg(F.first("conv_id").alias("conv_id"))
    spans = rows.groupBy(F.shiftright("block", 33).alias("part")).agg(F.max("block").alias("top")).select("part", F.expr("(top & 8589934591) + 1").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = spans.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    numbered = chunks.join(whose, "block").withColumn("part", F.shiftright("block", 33)).join(offsets, "part") \
        .withColumn("gid", F.expr("offset + (block & 8589934591)")).drop("part", "offset")
    numbered = written(numbered, "numbered-chunks")
    own = numbered.select("gid", "conv_id", "hi", "end", "one", "map")
    before = own.select((F.col("gid") + 1).alias("gid_"), F.col("conv_id").alias("conv_b"), F.col("hi").alias("hi_b"), F.col("end").alias("end_b"))
    behind = own.select((F.col("gid") - 1).alias("gid_"), F.col("conv_id").alias("conv_n"))
    linked = numbered.join(before, F.expr("gid = gid_ and conv_id <=> conv_b"), "left").withColumn("prev", F.expr("gid_ - 1")).drop("gid_", "conv_b")
    linked = linked.join(behind, F.expr("gid = gid_ and conv_id <=> conv_n"), "left").withColumn("next", F.expr("gid_ + 1")).drop("gid_", "conv_n")
    legal = ", ".join(f"'{x}'" for x in sorted(_LEGAL))
    linked = linked.withColumn("illegal", F.expr(f"illegal + if(end_b is not null and head is not null and concat(end_b, head) not in ({legal}), 1, 0)")) \
        .withColumn("turns", F.expr("turns - if(hi_b = lo, 1, 0)"))
    linked = written(linked.drop("hi_b", "end_b", "head", "end"), "linked-chunks")

    vectors = _end_vectors(linked)
    after = vectors.select(F.col("gid").alias("next"), F.col("vector").alias("after"))
    accept = F.array(*[F.lit(x).cast("long") for x in _ACCEPT])
    ready = linked.join(after, "next", "left").select("block", "codes", "copies", "settled", F.expr("next is null").alias("last"), F.coalesce("after", accept).alias("after"))
    traced = written(ready.mapInArrow(_fix_up(arrow(_TRACED)), _TRACED).join(linked.select("block", "gid", "conv_id", "prev", "next"), "block"), "traced")
    fn = traced.select(F.col("gid").alias("prev"), F.col("to").alias("fn"))
    states = traced.select("gid", "prev").join(fn, "prev", "left").select(
        "gid", "prev", "fn", F.expr("case when prev is null then 0L when array_min(fn) = array_max(fn) then fn[0] end").alias("enter"))
    known = traced.join(_entered(states), "gid").withColumn("at", F.col("enter").cast("int"))
    known = written(known.select("block", "gid", "conv_id", "next", "enter", "after", F.expr("audits[at]").alias("audit"), F.expr("costs[at]").alias("cost")), "known-chunks")

    sums = linked.select("block", "turns", "lo", "hi", "blank", "duplicate", "truncated", "illegal").join(known.select("block", "conv_id", "gid", "audit", "cost"), "block").groupBy("conv_id").agg(
        F.coalesce(F.max("hi") - F.min("lo") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in _COUNTS],
        F.expr("concat_ws('', transform(array_sort(collect_list(struct(gid, audit))), x -> x.audit))").alias("audit"))

    heads = known.join(linked.select("block", "codes"), "block").select(
        "block", F.lit(-1).cast("long").alias("pos"), "after", "enter", F.expr("next is null").alias("last"), F.col("gid").alias("seq"), "codes")
    lines = rows.select("block", "pos", "turn", "role", "text", "copies").unionByName(heads, allowMissingColumns=True)
    lines = lines.select("block", "pos", F.lit(0).alias("mark"), "turn", "role", "text", "copies", "after", "enter", "last", "seq", "codes")
    piece = T.StructType([T.StructField(c, T.LongType()) for c in ("block", "seq", "lines")] + [T.StructField("piece", T.BinaryType())])
    pieces = lines.repartition(n, "block").sortWithinPartitions("block", "pos").mapInArrow(_piece_rows(arrow(piece)), piece)
    pieces = pieces.join(known.select("block", "conv_id"), "block").select("conv_id", "seq", "lines", "piece")
    kind = T.StructType([rows.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    hashes = pieces.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_digests(arrow(kind).field(0).type), kind)
    return sums.join(hashes, sums["conv_id"].eqNullSafe(hashes["conv_id"])).select(sums["conv_id"], *_RESULT)


def _arrow_schema(kind: T.StructType) -> pa.Schema:
    return to_arrow_schema(kind)


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copies): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows of a conversation are taken by turn, nulls first; equal turns by role, then text. ``copies`` says how often
    a row stands there in succession, 0 only that the conversation exists. A null conv_id is a conversation like any other. Very long texts are
    taken whole, one chunk may then hold few rows. Repeated rows are duplicates. Other columns are not read. No rows give no rows.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "copies")
    dealt = rows.mapInArrow(_collapsed, rows.schema).repartitionByRange(
        shuffle_partitions(rows.sparkSession), F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.substring("text", 1, 64))
    schema = _sorted_rows(rows.schema["conv_id"].dataType)
    dealt = dealt.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    found = written(dealt.mapInArrow(_solve_inner(chunk_rows, chunk_bytes, _arrow_schema(schema)), schema), "conversations")
    inner = found.filter("block is null").select("conv_id", *_RESULT)
    return inner.unionByName(_stitched(found.filter("block is not null").select("conv_id", *_RAW)))


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


def _sql() -> str:
    """DuckDB SQL: the cheapest edits from each row on, of the four states, from the last row to the first."""
    space = "\\x20\\x09-\\x0D"
    said = lambda c: f"coalesce(CAST({c} AS VARCHAR), ' ')"
    way = lambda v, cost, edit, line: f"{{'c': {v}.c + {cost}, 'a': '{edit}' || {v}.a, 't': {line} || {v}.t}}"
    least = lambda *x: f"list_min([{', '.join(x)}])"
    more, line = "if(fault = 'truncated', 5, 0)", "chr(10) || role || ':' || text"
    new = {"u": "chr(10) || 'user:'", "a": "chr(10) || 'assistant:'"}
    free = "fault IN ('', 'truncated')"
    keep = lambda initial, v: f"CASE WHEN {free} AND r = '{initial}' THEN {way(v, more, 'K', line)} END"
    rerole = lambda to, v: f"CASE WHEN {free} THEN {way(v, f'1 + {more}', 'R', new[to] + ' || text')} END"
    return f"""
WITH RECURSIVE original AS (
  SELECT conv_id, turn, {said('role')} AS role, {said('text')} AS text, {crc32_sql(f"({said('conv_id')} || ':' || {said('turn')})")} % 20 AS kind FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM original WHERE kind <> 0),
numbered AS (SELECT *, substr(role, 1, 1) AS r, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
                    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged),
faults AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{space}]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                          WHEN regexp_extract(text, '([^{space}])[{space}]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  lag(r) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM numbered),
counts AS (SELECT o.conv_id, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps,
                  count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                  count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                  count(*) FILTER (WHERE before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, count(f.k) AS n
           FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM o.conv_id GROUP BY o.conv_id),
ways AS (
  SELECT conv_id, n AS k, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS v0, {{'c': 10::BIGINT, 'a': 'II', 't': {new['u']} || {new['a']}}} AS vs,
         {{'c': 5::BIGINT, 'a': 'I', 't': {new['a']}}} AS vu, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS va FROM counts
  UNION ALL
  SELECT conv_id, k, {least('b0', way('fu', 5, 'I', new['u']))}, {least('bs', way('fu', 5, 'I', new['u']))}, fu, fa
  FROM (SELECT *, {least('bu', way('ba', 5, 'I', new['a']))} AS fu, {least('ba', way('bu', 5, 'I', new['u']))} AS fa
        FROM (SELECT w.conv_id, w.k - 1 AS k,
                     {least(way('v0', 2, 'D', "''"), keep('s', 'vs'), keep('u', 'vu'), rerole('u', 'vu'))} AS b0,
                     {least(way('vs', 2, 'D', "''"), keep('u', 'vu'), rerole('u', 'vu'))} AS bs,
                     {least(way('vu', 2, 'D', "''"), keep('a', 'va'), rerole('a', 'va'))} AS bu,
                     {least(way('va', 2, 'D', "''"), keep('u', 'vu'), rerole('u', 'vu'))} AS ba
              FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k)))
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, v0.c AS cost, v0.a AS audit, sha256(substr(v0.t, 2)) AS repaired_sha256
FROM counts c JOIN ways w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.k = 0
"""


SQL = _sql()
