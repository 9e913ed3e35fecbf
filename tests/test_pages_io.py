"""Raw page files: byte cap before decoding, replacement of bad bytes, idempotent landing."""

from pyspark.sql import functions as F

from jobloom.sources import pages as PG


def test_raw_pages_cap_and_decode(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "a.html").write_bytes(b'<a href="/career/x/">X</a>')
    (d / "bad.html").write_bytes(b"caf\xe9 \xff ok")          # not UTF-8
    (d / "big.html").write_bytes(b"x" * 5000)                  # over a 2048-byte cap
    (d / "note.txt").write_bytes(b"ignored by the glob")
    pages = PG.read_raw_pages(spark, str(d), max_bytes=2048)
    got = {r["url"].rsplit("/", 1)[-1]: r["html"] for r in pages.collect()}
    assert set(got) == {"a.html", "bad.html"}
    assert got["bad.html"] == b"caf\xe9 \xff ok".decode("utf-8", errors="replace") == "caf\ufffd \ufffd ok"
    rejected = [r["path"].rsplit("/", 1)[-1] for r in PG.rejected_raw_pages(spark, str(d), max_bytes=2048).collect()]
    assert rejected == ["big.html"]


def test_body_cap_accepts_exactly_the_cap(spark):
    df = spark.createDataFrame([("x" * 1024,), ("x" * 1025,), (None,)], "html string")
    flags = [r["accepted"] for r in PG.with_body_cap(df, max_bytes=1024).collect()]
    assert flags == [True, False, True]
    assert PG.max_response_bytes(10) == 1024  # floor


def test_land_raw_pages_is_idempotent(spark, tmp_path):
    pages = spark.createDataFrame([("https://a.example/x", "<p>1</p>"), ("bad/label!", "<p>2</p>")],
                                  "url string, html string")
    out = str(tmp_path / "landed")
    PG.land_raw_pages(pages, out)
    PG.land_raw_pages(pages, out)
    landed = spark.read.parquet(out)
    assert landed.count() == 2
    assert sorted(r[0] for r in landed.select("label").collect()) == ["bad_label", "https_a.example_x"]


def test_bodies_in_many_charsets(spark):
    from pyspark.sql import functions as F

    from jobloom.sources.pages import body_charset, decode_body

    text = "Überschrift 日本 é"
    meta = '<html><meta http-equiv="Content-Type" content="text/html; charset=Shift_JIS"><p>日本</p>'
    rows = [
        ("declared", text.encode("utf-16-be"), "UTF-16BE", text), ("declared jp", "日本".encode("shift_jis"), " Shift_JIS ", "日本"),
        ("mark", b"\xff\xfe" + text.encode("utf-16-le"), None, text), ("utf-8 mark", b"\xef\xbb\xbf" + text.encode(), "", text),
        ("meta", meta.encode("shift_jis"), None, meta), ("meta short", b"<META charset=windows-1252>\x80", None, "<META charset=windows-1252>€"),
        ("bad jp", b"a\x81", "shift_jis", "a�"), ("bad utf-8", b"a\xffb", None, "a�b"), ("unknown", text.encode(), "klingon", text),
        ("not text", b"abc", "base64", "abc"), ("empty", b"", "utf-16", ""), ("null", None, "utf-16", None), ("bad utf-16", b"\x00\xd8a", "utf-16-le", b"\x00\xd8a".decode("utf-16-le", "replace")),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "name string, body binary, charset string")
    got = {r["name"]: r["t"] for r in df.select("name", decode_body(F.col("body"), F.col("charset"), detect=True).alias("t")).collect()}
    assert got == {r[0]: r[3] for r in rows}
    assert df.select(body_charset(F.col("body")).alias("c")).distinct().count() == 4
    assert [r["t"] for r in spark.createDataFrame([("日本".encode("shift_jis"),)], "b binary").select(decode_body(F.col("b"), "shift_jis").alias("t")).collect()] == ["日本"]
