"""WARC round trips and salvage, URL rules, secrets."""

import hashlib
import random
import re
import zlib

import pytest

from jobloom.llm import credentials, url_automaton, warc
from jobloom.llm.common import scratch

PAGES = [(1, "http://a.com/x", "<p>é</p>"), (2, "http://b.com/", "<p>é</p>"), (3, None, None), (4, "http://c.org/a b\n", ""),
         (5, "http://d.org", "x" * 300000), (None, "http://e.org", "<p>é</p>"), (6, "http://f.org", "WARC/1.0\r\nfalse start\r\n\r\n"),
         (2, "http://b.com/", "<p>é</p>"), (7, "http://g.org", "\x1f\x8b\x08 not a member")]
SCHEMA = "page_id long, url string, html string"


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], SCHEMA + ", first string, sha string")
    got = warc.archived_pages(pages).collect()
    assert len(got) == len(PAGES)
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        row = next(r for r in got if r["page_id"] == page_id)
        assert (row["payload_bytes"], row["payload_digest"]) == (len(data), warc.base32_sha1(data))
        first = min(same)
        assert (row["record_type"], row["refers_to"]) == (("response", None) if page_id == first else ("revisit", first))
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_archives_are_gzip_members_that_any_reader_takes(spark, monkeypatch):
    path = scratch(spark, "warc-test")
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 1)
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), path, file_bytes=1000000)
    rows = warc.read_archives(spark, path).collect()
    assert {r["kind"] for r in rows} == {"record"} and len({r["archive"] for r in rows}) > 1
    assert {bytes(r["payload"]) for r in rows if r["payload"] is not None} == {(h or "").encode() for _, _, h in PAGES}
    for f in spark.read.format("binaryFile").load(path).collect():
        data, out = bytes(f["content"]), b""
        while data:  # member by member to the last byte
            d = zlib.decompressobj(31)
            out += d.decompress(data)
            assert d.eof
            data = d.unused_data
        assert out.count(b"WARC/1.1\r\nWARC-Type") <= 3


def test_files_are_cut_by_bytes(spark):
    """Payloads that do not shrink, of very different sizes: no file is over the limit, and all come back."""
    rng = random.Random(6)
    html = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP0123456789", k=k)) for k in [700_000] * 4 + [1000] * 500 + [0, 5]]
    path = scratch(spark, "warc-bytes")
    pages = spark.createDataFrame([(i, "http://h/", h) for i, h in enumerate(html)], SCHEMA).repartition(2)
    warc.write_archives(pages, path, file_bytes=3 << 20)
    sizes = [r["length"] for r in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert len(sizes) > 2 and max(sizes) <= 3 << 20
    rows = warc.read_archives(spark, path).collect()
    assert sorted(int(r["record_id"].rsplit(":", 1)[1]) for r in rows if r["kind"] == "record") == list(range(len(html)))


def _archive(n=30, plain=False):
    records = [warc.record("response", i, f"http://h/{i}", hashlib.sha256(bytes([i])).hexdigest().encode() * (1 + i % 5)) for i in range(n)]
    return [r if plain else warc.gzip_member(r) for r in records]


@pytest.mark.parametrize("plain", [True, False])
def test_salvage_recovers_all_records_but_the_damaged(plain):
    rng = random.Random(2)
    for _ in range(60):
        parts = _archive(plain=plain)
        data, hurt = bytearray(b"".join(parts)), set()
        at = [0]
        for p in parts:
            at.append(at[-1] + len(p))
        for _ in range(3):
            i = rng.randrange(len(data))
            data[i] ^= 1 << rng.randrange(8)
            hurt.add(next(k for k in range(len(parts)) if at[k] <= i < at[k + 1]))
        found = list(warc.salvage(bytes(data)))
        ids = {int(x[3]["warc-record-id"].strip("<>").rsplit(":", 1)[1]) for x in found if x[0] == "record" and x[3].get("warc-record-id", "").strip("<>")[-1:].isdigit()}
        assert ids >= set(range(len(parts))) - hurt
        # records and gaps cover the file once, in order
        end = 0
        for x in found:
            assert x[1] == end or (x[1], x[2]) == last
            end, last = x[2], (x[1], x[2])
        assert end == len(data)


def test_salvage_of_cut_lost_and_foreign_bytes():
    parts = _archive(6)
    whole = b"".join(parts)
    kinds = lambda data: [x[0] for x in warc.salvage(data)]
    assert kinds(whole) == ["record"] * 6
    assert kinds(whole[:-5]) == ["record"] * 5 + ["gap"]
    assert kinds(b"junk" + whole) == ["gap"] + ["record"] * 6
    assert kinds(parts[0] + b"\x1f\x8b\x08\x00junk" + b"".join(parts[1:])) == ["record", "gap"] + ["record"] * 5
    assert kinds(parts[0] + _archive(3, plain=True)[2] + parts[1]) == ["record"] * 3
    assert kinds(b"") == [] and kinds(b"\0" * 50) == ["gap"]
    gap = next(x for x in warc.salvage(whole[:-5]))
    assert gap[0] == "record"
    assert [x[3] for x in warc.salvage(whole[:-5]) if x[0] == "gap"] == ["gzip member is cut off"]
    wrong = warc.record("response", 1, None, b"payload").replace(b"payload", b"PAYLOAD")
    assert [x[3] for x in warc.salvage(wrong)] == ["warc-block-digest differs"]


def _glob(pattern: str) -> re.Pattern:
    return re.compile("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern) + r"\Z", re.S)


def test_automaton_equals_regular_expressions():
    rng = random.Random(4)
    rules = [("".join(rng.choices("ab*?.", k=rng.randint(1, 5))), "".join(rng.choices("ab*?/", k=rng.randint(0, 6)))) for _ in range(60)]
    urls = [("".join(rng.choices("ab.", k=rng.randint(0, 6))), "".join(rng.choices("ab/", k=rng.randint(0, 8)))) for _ in range(300)]
    machine = url_automaton.Automaton([url_automaton.glob_tokens(h, p, False) for h, p in rules])
    assert machine.words > 5
    fits = machine.run([b"." + h.encode() + b"\xff" + p.encode() for h, p in urls])
    for (host, path), row in zip(urls, fits, strict=True):
        assert [bool(x) for x in row] == [bool(_glob(h).match(host) and _glob(p).match(path)) for h, p in rules]


def test_url_rules(spark):
    urls = ["http://com/", "https://EXAMPLE.com/en/a", "http://www.example.com/en/", "http://x.www.example.com/en/z?q", "http://notexample.com/en/",
            "ftp://a.net/es/", "http://a.net/es", "http://net/fr/x#y", "http://a.com", "http://a.com?x=/", None, "", "no scheme", "http://",
            "http://a.org/b.com/en/", "x://y.org/a?u=http://z.com/", "http://ads.org/x", "http://é.com/ü", "http://a.com/" + "p" * 5000, "http://a.org/l.exe"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(None, "http://com/", "clash")], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_automaton.judge_urls(pages).collect()}
    assert len(got) == len(urls) + 1
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
        fitting = [(h + p, v) for v, h, p in url_automaton.RULES if ("." + host).endswith("." + h) and path.startswith(p)]
        rule, verdict = max(fitting, key=lambda x: len(x[0]), default=(None, None))
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        if rule:
            assert r["verdict"] == verdict
    assert (got[16]["verdict"], got[19]["verdict"], got[10]["verdict"]) == ("block", "block", "allow")
    assert url_automaton.judge_urls(pages.limit(0)).count() == 0


CONFIG = """intro text
[storage]
# the account
CLIENT_ID={}

region: eu
{}
client-secret = "{}"
endpoint = https://s3.host
prose begins here
"""


def test_weak_identifiers_and_configuration_blocks(spark):
    blob = "aB3" * 14
    far = "\n".join(f"option{i} = {i}" for i in range(60))  # parts of one block may stand far apart
    texts = [CONFIG.format("someone1", far, blob), CONFIG.format("someone1", "A line of prose cuts the block.\n" + far, blob)]
    texts += [f"{name}=someone1 {blob} https://s3.host/x" for name in ("CLIENT_ID", "clientId", "client-id", "Account-Name", "USERNAME", "ACCOUNTID")]
    rows = credentials.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    kinds = {r["doc_id"]: {s.split(":")[0] for s in r["spans"].split(",") if s} for r in rows}
    assert {"assign", "weak_id", "endpoint"} <= kinds[0] and kinds[1] == {"assign"}
    for i in range(2, len(texts)):
        assert kinds[i] == {"weak_id", "weak_secret", "endpoint"}, texts[i]


def _plain_base(text):
    """Base spans by the contract's words alone: one pattern after the other, leftmost, non-overlapping, short ones dropped."""
    found = []
    for kind, pattern, least in (("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                                  r"""[aA][pP][iI]_?[kK][eE][yY])["']?[ ]*[:=][ ]*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""", 6),
                                 ("access", r"(?P<v>AKIA[A-Z0-9]+)", 20), ("hex", r"(?P<v>[0-9a-f]+)", 24)):
        at = 0
        while (m := re.compile(pattern).search(text, at)):
            if len(m["v"]) >= least:
                found.append((m.start(), ("assign", "access", "hex").index(kind), kind, m.end()))
            at = m.end()
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def test_base_spans_against_the_words_of_the_contract(spark):
    rng = random.Random(12)
    pieces = ["password", "PassWD", "secret", "ToKen", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "0123456789abcdef" * 2, "AKIA", "Z9" * 9, "é", "deadbeef", "\n", "x" * 5, "_", "."]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(1500)]
    for r in credentials.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        plain = _plain_base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(plain.encode()).hexdigest(), texts[r["doc_id"]]
        counts = [plain.count(f"{k}:") for k in ("assign", "access", "hex")]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts


KEY = "AKIA" + "Z" * 16
BLOB = "aB3" * 14


def test_secret_spans_and_links(spark):
    texts = ["password = hunter22, Token:'abc' API_KEY: \"0123456789\"", f"é {KEY} x AKIASHORT " + "deadbeef" * 3, None, "",
             f"{KEY} then {BLOB}", f"{BLOB} alone", f"{BLOB} and user_id=someone1", f"user_id=someone1 {BLOB} https://s3.host/x",
             f"{KEY}\n\n{BLOB}", f"{KEY} " + "w " * 200 + BLOB, "passwordpassword=1234567 secret=pa55word=next", "ſecret=abcdefgh", f"password={BLOB}" + " x" * 50000]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "clash"), (None, texts[4], "clash")],
                                 "doc_id long, text string, row string")
    rows = credentials.scan_secrets(docs).collect()
    assert len(rows) == len(texts) + 2
    got = {r["doc_id"]: r for r in rows}
    for i, t in enumerate(texts):
        base = ",".join(f"{credentials.KINDS[k]}:{s}:{e}" for s, k, e in credentials.base_spans(t or ""))
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[i]["spans"].split(","))
    assert (got[0]["n_assign"], got[1]["n_access"], got[1]["n_hex"], got[11]["n_assign"]) == (2, 1, 1, 0)
    kinds = {i: {s.split(":")[0] for s in got[i]["spans"].split(",") if s} for i in range(len(texts))}
    assert kinds[4] == {"access", "weak_secret"} and kinds[5] == set() and kinds[6] == set()
    assert kinds[7] == {"weak_id", "weak_secret", "endpoint"} and kinds[8] == {"access"} and kinds[9] == {"access"}
    assert kinds[12] == {"assign"} and got[None]["spans"] == got[4]["spans"]
    assert credentials.scan_secrets(docs.limit(0)).count() == 0
