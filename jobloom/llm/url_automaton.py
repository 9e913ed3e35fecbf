"""URL rules by a bit-parallel wildcard automaton (multiword Shift-And).

Every rule is a glob over the canonical URL: ``.host`` + one separator byte + ``path``. Each glob token is one bit; the bits
of all rules lie side by side in 64-bit words. One step per byte moves every rule at once:
``D = ((D << 1) & B[byte]) | (D & S)``, where B holds the bits whose token accepts the byte and S
the bits with a ``*`` behind them. Numpy steps all URLs of a batch together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, table

#: stands between host and path; no byte of UTF-8 text
CUT = 0xFF
#: (verdict, host, path): fits the host and its subdomains where the path starts with the rule's
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: (verdict, glob): for URLs that no rule fits; the part before the first / is the host's
GLOBS = (("block", "ads.*/*"), ("block", "*.doubleclick.net/*"), ("block", "*/*.exe"), ("block", "*/*/wp-login.php*"))
OTHERWISE = "allow"


class Automaton:
    """Globs as byte strings: ``*`` any run, ``?`` one byte; ``literal`` parts have no wildcards."""

    def __init__(self, globs: Sequence[list[tuple[int | None, bool]]]):
        # each glob: (byte or None for any, star behind) per token, the first entry being the start state
        bits = sum(len(g) for g in globs)
        self.words = max(1, (bits + 63) // 64)
        accept = np.zeros((256, self.words), dtype=np.uint64)
        self.start, self.stay = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.final, at = [], 0
        for g in globs:
            for j, (byte, star) in enumerate(g):
                word, bit = at // 64, np.uint64(1 << (at % 64))
                if j == 0:
                    self.start[word] |= bit
                elif byte is None:
                    accept[:, word] |= bit
                else:
                    accept[byte, word] |= bit
                if star:
                    self.stay[word] |= bit
                at += 1
            self.final.append(((at - 1) // 64, np.uint64(1 << ((at - 1) % 64))))
        self.accept = accept

    def run(self, rows: list[bytes]) -> np.ndarray:
        """Which glob fits which row: (rows, globs) booleans."""
        size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        order = np.argsort(-size, kind="stable")
        flat = np.frombuffer(b"".join(rows), dtype=np.uint8)
        begin = (np.cumsum(size) - size)[order]
        size = size[order]
        state = np.tile(self.start, (len(rows), 1))
        live, one, top = len(rows), np.uint64(1), np.uint64(63)
        for i in range(int(size[0]) if len(rows) else 0):
            live = int(np.searchsorted(-size[:live], -i, side="left"))  # rows longer than i come first
            d = state[:live]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:live] = (moved & self.accept[flat[begin[:live] + i]]) | (d & self.stay)
        out = np.empty((len(rows), len(self.final)), dtype=bool)
        for k, (word, bit) in enumerate(self.final):
            out[order, k] = (state[:, word] & bit) != 0
        return out


def glob_tokens(host: str, path: str, literal: bool) -> list[tuple[int | None, bool]]:
    """Tokens of a rule. A literal one fits subdomains and longer paths: ``*.host`` + cut + ``path*``."""
    out: list[list] = [[None, False]]
    parts = ([(b"*", False), (b"." + host.encode(), True), (bytes([CUT]), True), (path.encode(), True), (b"*", False)] if literal
             else [(b".", True), (host.encode(), False), (bytes([CUT]), True), (path.encode(), False)])
    for text, plain in parts:
        for byte in text:
            if not plain and byte == ord("*"):
                out[-1][1] = True
            else:
                out.append([None if not plain and byte == ord("?") else byte, False])
    return [(a, b) for a, b in out]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules=RULES, globs=GLOBS, otherwise: str = OTHERWISE, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.

    The longest rule that fits decides (host and path together; the earlier of equally long ones); without one the first glob that fits,
    else ``otherwise``, and ``rule`` is null. Null or malformed urls have empty host and path, which no rule fits. Ids
    may be null or repeated: each row is judged by itself, very long URLs whole. No rows give no rows; other columns are not read.
    """
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    split = [(v, *(g.split("/", 1) if "/" in g else (g, "*"))) for v, g in globs]
    tokens = [glob_tokens(h, p, True) for _, h, p in ranked] + [glob_tokens(h, "/" + p, False) for _, h, p in split]
    names = [h + p for _, h, p in ranked] + [None] * len(split) + [None]
    verdicts = [r[0] for r in ranked] + [s[0] for s in split] + [otherwise]

    def run(batches):
        automaton = Automaton(tokens)
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            fits = automaton.run([b"." + h.encode() + bytes([CUT]) + p.encode() for h, p in zip(hosts, paths, strict=True)])
            first = np.where(fits.any(axis=1), fits.argmax(axis=1), len(names) - 1) if len(tokens) else np.zeros(len(hosts), int)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([names[k] for k in first], pa.string()),
                 pa.array([verdicts[k] for k in first], pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType)] + [
        T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")])
    url = F.col(url_col)
    return pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")).mapInArrow(run, schema)


def op7_url_automaton(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                 WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
                 WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
                 WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
                 WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host LIKE 'ads.%' AND starts_with(path, '/') THEN 'block'
            WHEN host LIKE '%.doubleclick.net' AND starts_with(path, '/') THEN 'block'
            WHEN path LIKE '/%.exe' OR path LIKE '/%/wp-login.php%' THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
