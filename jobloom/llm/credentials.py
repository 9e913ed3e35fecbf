"""Secret scan with multipart credential linking.

A scan of each whole text finds what is a secret by itself (assignments, access keys, long hex runs) and weaker parts: possible
identifiers, high-entropy strings, endpoints. Weak parts are reported only where complementary parts stand in their scope: an interval
join of the parts, by nearest neighbours on either side, so that no pairs are formed. A scope is a configuration block (consecutive lines of settings,
comments, brackets and blanks) as a whole, however long it is, or in prose a paragraph, where parts must stand close by.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the whole run, which is what a run of any length would match
WEAK_ID = re.compile(r"""(?<![A-Za-z0-9])(?:(?:ASIA|AROA|AIDA|LTAI|GOOG)[A-Z0-9]{12,}|"""
                     r"""(?i:(?:key|client|account|user)[_-]?(?:id|name))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{6,})""", re.A)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"(?:https?|wss?|ftp|postgresql|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9.@:_-]+", re.A)
PARAGRAPH = re.compile(r"\n\s*\n")
#: a line of a configuration: blank, a comment, a bracket, or a setting
SETTING = re.compile(r"""[ \t]*(?:$|[#;\[\]{}()<]|//|--|(?:export[ \t]+|-[ \t]+)?["']?[A-Za-z_$][\w.$-]*["']?[ \t]*(?:=>|[:=]))""", re.A)
#: kinds in the order of equal starts
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
BASE = 3
#: role of each kind: identifier, secret or endpoint
ROLES = ("secret", "id", "secret", "id", "secret", "endpoint")
#: parts in prose further apart than this many code points do not complement each other
REACH = 200


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the spans that count by themselves, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _mixed(s: str) -> bool:
    return any(c.islower() for c in s) and any(c.isupper() for c in s) and any(c.isdigit() for c in s)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of parts that need others; none that overlaps a base span."""
    found = [(m.start(), 3, m.end()) for m in WEAK_ID.finditer(text)]
    found += [(m.start(), 4, m.end()) for m in WEAK_SECRET.finditer(text) if _mixed(m[0])]
    found += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    if not found:
        return found
    out, i, reach = [], 0, -1
    for start, kind, end in sorted(found):
        while i < len(base) and base[i][0] < end:
            reach = max(reach, base[i][2])
            i += 1
        if reach <= start:
            out.append((start, kind, end))
    return out


def blocks_of(text: str) -> list[tuple[int, int]]:
    """Configuration blocks [start, end): lines of settings in succession, two of them at least with a name and a value."""
    found, start, named, at = [], None, 0, 0
    for line in [*text.split("\n"), "end of the text"]:
        setting = SETTING.match(line)
        if start is None and setting and line.strip():
            start, named = at, 0
        elif start is not None and not setting:
            if named > 1:
                found.append((start, at))
            start = None
        if setting and line.strip() and setting[0].rstrip()[-1:] in "=:>":
            named += 1
        at += len(line) + 1
    return found


def scopes(text: str) -> tuple[list[int], list[bool]]:
    """(where scopes begin, but for the first; whether each scope is a configuration block); paragraphs elsewhere."""
    marks = []
    blocks = blocks_of(text)
    k = 0
    for m in PARAGRAPH.finditer(text):
        while k < len(blocks) and blocks[k][1] <= m.start():
            k += 1
        if k == len(blocks) or m.start() < blocks[k][0]:
            marks.append((m.start(), False))
    marks = sorted([*marks, *((a, True) for a, _ in blocks), *((b, False) for _, b in blocks)])
    return [at for at, _ in marks], [False, *(block for _, block in marks)]


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("scope", pa.int32()), ("block", pa.bool_())])
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
                                   T.StructField("end", T.LongType()), T.StructField("scope", T.IntegerType()),
                                   T.StructField("block", T.BooleanType())]))


def _scan(batches):
    task, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        base, weak = [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            own = base_spans(text)
            more = weak_spans(text, own)
            cuts, blocks = scopes(text) if more else ([], [False])
            place = lambda s: bisect_right(cuts, s)
            base.append([{"start": s, "kind": k, "end": e, "scope": place(s), "block": blocks[place(s)]} for s, k, e in own])
            weak.append([{"start": s, "kind": k, "end": e, "scope": place(s), "block": blocks[place(s)]} for s, k, e in more])
        rows = [(task << 33) + at + i for i in range(batch.num_rows)]
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), batch.column(0), pa.array(base, pa.list_(_SPAN)),
                                          pa.array(weak, pa.list_(_SPAN))], ["row", "doc_id", "base", "weak"])


def linked_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts among ``parts`` (row, scope, block, start, kind, end) that complementary ones of their scope confirm.

    A weak identifier needs a secret within ``reach`` (anywhere in a configuration block), a weak secret an identifier; if that is weak too, an endpoint must be
    near as well. An endpoint needs an identifier and a secret.
    """
    roles = F.element_at(F.array(*map(F.lit, ROLES)), F.col("kind") + 1)
    parts = parts.withColumn("role", roles).withColumn("strong", F.col("kind") < BASE)
    before = Window.partitionBy("row", "scope").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row", "scope").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    tests = {"strong_id": "role = 'id' and strong", "any_id": "role = 'id'", "strong_secret": "role = 'secret' and strong",
             "any_secret": "role = 'secret'", "any_endpoint": "role = 'endpoint'"}
    seen = parts.select("*", *[F.max(F.when(F.expr(t), F.col("end"))).over(before).alias(f"{n}_end") for n, t in tests.items()])
    seen = seen.select("*", *[F.min(F.when(F.expr(t), F.col("start"))).over(after).alias(f"{n}_start") for n, t in tests.items()])
    for n in tests:
        seen = seen.withColumn(n, F.coalesce(F.expr(f"{n}_end is not null and (block or start - {n}_end <= {reach})"), F.lit(False)) |
                               F.coalesce(F.expr(f"{n}_start is not null and (block or {n}_start - end <= {reach})"), F.lit(False)))
    confirmed = F.expr("case role when 'id' then strong_secret or (any_secret and any_endpoint) "
                       "when 'secret' then strong_id or (any_id and any_endpoint) else any_id and any_secret end")
    return seen.filter(~F.col("strong") & confirmed).select("row", "start", "kind", "end")


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` has all spans as kind:start:end (code points, end exclusive), by start, then kind; ``base_sha256`` is the digest of
    those that count by themselves. Null and empty texts have none. Null and repeated ids are rows like others. ``docs``
    needs doc_id and text; other columns are not read. Very long texts are scanned whole. No rows give no rows.
    """
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [
        T.StructField(c, _SPANS) for c in ("base", "weak")])
    found = written(docs.select("doc_id", "text").mapInArrow(_scan, schema), "secrets")
    parts = found.filter("size(weak) > 0").select("row", F.inline(F.concat("base", "weak")))
    extra = linked_parts(parts, reach).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("extra"))
    out = found.select("row", "doc_id", F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("base")) \
        .join(extra, "row", "left")
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    shown = lambda c: F.expr(f"array_join(transform({c}, s -> concat(get({names}, s.kind), ':', s.start, ':', s.end)), ',')")
    count = lambda k: F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)")
    every = F.expr("array_sort(concat(base, coalesce(extra, cast(array() as array<struct<start: bigint, kind: int, end: bigint>>))))")
    return out.withColumn("every", every).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(shown("base"), 256).alias("base_sha256"), shown("every").alias("spans"))


def op2_credentials(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
