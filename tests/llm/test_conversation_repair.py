"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from jobloom.llm import conversation_repair as R
from tests.conftest import SF_SMOKE

SPACE = " \t\n\x0b\x0c\r"


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def _plain(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of the damaged rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        core = text.strip(SPACE)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(i, state, inserts):
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            def edit(cost, name, to, line):
                tail = best(i + 1, to, 0)
                if tail:
                    found.append((cost + tail[0], name + tail[1], (line, *tail[2]) if line is not None else tail[2]))
            edit(2, "D", state, None)
            if faults[i] in ("", "truncated"):
                more, (role, text) = 5 * (faults[i] == "truncated"), rows[i][2:]
                if role[:1] in after[state]:
                    edit(more, "K", role[:1], f"{role}:{text}")
                for new in ("user", "assistant"):
                    if new[0] in after[state]:
                        edit(more + 1, "R", new[0], f"{new}:{text}")
        if inserts < 3:
            for new in ("user", "assistant"):
                if new[0] in after[state]:
                    tail = best(i, new[0], inserts + 1)
                    if tail:
                        found.append((5 + tail[0], "I" + tail[1], (f"{new}:", *tail[2])))
        return min(found, default=None)

    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _check(got, rows):
    want = {c: _plain([r for r in _damaged(rows) if r[0] == c]) for c in {r[0] for r in rows}}
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got}
    assert len(got) == len(found) and found == want


def _rows(seed, roles, n_conv=30, hot=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \n", "É?", "Yes. ", "who? ", None, "a "] + [f"line {i}." for i in range(60)]
    rows = []
    for c in range(n_conv):
        n = hot if c == 7 else rng.randrange(1, 9)
        for t in range(n):
            rows.append((None if c == 3 else c, rng.choice([t, t, t, t + 1, None]) if c % 5 == 0 else t, rng.choice(roles), rng.choice(texts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("roles", [["system", "user", "assistant"], ["user", "assistant", "user", "assistant", "tool", "", None], ["user"], ["tool"], ["system"]])
def test_repair_is_the_cheapest_and_least(spark, roles):
    rows = _rows(len(roles), roles)
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as block", "1 as pos", "2 as copies", "'y' as audit")
    _check(R.repair(R.damaged(docs), chunk_rows=4).collect(), rows)


def test_many_copies_and_dropped_rows(spark):
    rows = [(1, t, "user", "same words.") for t in range(120)] + [(2, None, "user", "same.")] * 50 + [(t, 0, "user", "Hm.") for t in range(100, 160)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    _check(R.repair(R.damaged(docs), chunk_rows=5).collect(), rows)


def test_long_texts_are_cut_into_chunks_by_bytes(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t} " + "word " * 4000 + ".") for t in range(40)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    _check(R.repair(R.damaged(docs), chunk_bytes=50000).collect(), rows)


def test_empty_table(spark):
    assert R.repair(R.damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMOKE}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    _check(R.op13_conversation_repair(spark, SF_SMOKE).collect(), rows)
