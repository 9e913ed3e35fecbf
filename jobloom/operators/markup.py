"""Anchors of pages whose markup needs a parser.

Most pages are read with built-in expressions alone (``extract.py``): an anchor runs to its closing tag. That is not enough where anchors are
nested or closed by the end of an element around them, where one closes itself, and where character references are not plain HTML 4 ones. ``needs_parser``
finds such pages, and only they go through ``parsed_anchors``: a quote-aware tokenizer with a stack of open elements, one pass over the page.
"""

from __future__ import annotations

import html as _html
from html.entities import html5, name2codepoint
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

# fixed values: elements without content
VOID = frozenset("area base br col embed hr img input link meta param source track wbr basefont bgsound command frame image isindex nextid spacer keygen".split())

_PLAIN = "|".join(sorted([*name2codepoint, "apos"], key=lambda n: (-len(n), n)))
_OPEN_ENDED = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
_NUMBER = "(?:3[2-9]|[4-9][0-9]|1[01][0-9]|12[0-6]|1[6-9][0-9]|[2-9][0-9]{2}|[1-9][0-9]{3}|[xX](?:[2-6][0-9a-fA-F]|7[0-9a-eA-E]|[a-fA-F][0-9a-fA-F]|[1-9a-cA-C][0-9a-fA-F]{2}|[1-9a-cA-C][0-9a-fA-F]{3}));"
#: references that are not a plain one with a semicolon
UNUSUAL_REFERENCE = f"&(?:(?:{_OPEN_ENDED})(?!;)|(?!(?:{_PLAIN});)[a-zA-Z][a-zA-Z0-9]*;|#(?!{_NUMBER}))"
ANCHOR_BEGIN = r"(?i)<a[\s/>]"
SELF_CLOSED = r"(?i)<a\s[^<>]*/>"
QUOTED_CLOSE = r"""(?i)=\s*(?:"[^"<>]*</a|'[^'<>]*</a)"""
_NAME = r"([a-zA-Z][^\s/>]*)"


def needs_parser(visible_html: Column, spans: Column, pieces: Column) -> Column:
    """Whether a page (without comments and scripts; its anchors and what lies between closing tags) is beyond the built-in reading."""
    names = lambda a, mark: F.transform(F.regexp_extract_all(a, F.lit(mark + _NAME), F.lit(1)), F.lower)
    ends, begins = (lambda a: names(a, "</")), (lambda a: names(a, "<"))
    open_around = F.exists(spans, lambda a: F.contains(a, F.lit("</")) & (
        (F.size(F.array_except(ends(a), begins(a))) > 0) | (F.size(ends(a)) > F.size(begins(a)))))
    nested = F.exists(pieces, lambda p: F.regexp_count(p, F.lit(ANCHOR_BEGIN)) > 1)
    return F.coalesce(nested | open_around | F.regexp_like(visible_html, F.lit(SELF_CLOSED)) | F.regexp_like(visible_html, F.lit(QUOTED_CLOSE))
                      | (F.contains(visible_html, F.lit("&")) & F.regexp_like(visible_html, F.lit(UNUSUAL_REFERENCE))), F.lit(False))


class Anchors(HTMLParser):
    """Collects the texts of a page in order, and for each anchor its href and which texts lie in it."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.texts: list[str] = []
        self.anchors: list[list] = []  # href, first text, end of texts
        self._stack: list[tuple[str, int]] = []
        self._open: dict[str, int] = {}
        self._data: list[str] = []
        self._hidden = False

    def _end_of_text(self) -> None:
        text = "".join(self._data).strip()
        self._data.clear()
        if text and not self._hidden:
            self.texts.append(text)

    def _pop(self) -> None:
        name, anchor = self._stack.pop()
        self._open[name] -= 1
        if anchor >= 0:
            self.anchors[anchor][2] = len(self.texts)

    def handle_starttag(self, tag, attrs):
        self._end_of_text()
        self._hidden = tag in ("script", "style", "template")
        if tag in VOID:
            return
        anchor = -1
        if tag == "a":
            anchor = len(self.anchors)
            self.anchors.append([dict(attrs).get("href", "") if any(k == "href" for k, _ in attrs) else None, len(self.texts), None])
        self._stack.append((tag, anchor))
        self._open[tag] = self._open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_of_text()
        self._hidden = False
        if tag in VOID or not self._open.get(tag):
            return
        while self._stack[-1][0] != tag:
            self._pop()
        self._pop()

    def handle_data(self, data):
        self._data.append(data)

    def handle_entityref(self, name):
        self._data.append(html5.get(name + ";") or html5.get(name) or f"&{name}")

    def handle_charref(self, name):
        self._data.append(_html.unescape(f"&#{name};"))

    def handle_comment(self, data):
        self._end_of_text()

    def handle_decl(self, decl):
        self._end_of_text()

    def unknown_decl(self, data):
        self._end_of_text()

    def handle_pi(self, data):
        self._end_of_text()

    def read(self, html: str, most_texts: int | None) -> dict:
        self.feed(html)
        self.close()
        self._end_of_text()
        while self._stack:
            self._pop()
        cut = lambda a, b: b if most_texts is None else min(b, a + most_texts)
        return {"texts": self.texts, "anchors": [{"href": None if href is None else href.strip(), "lo": a, "hi": cut(a, b)} for href, a, b in self.anchors]}


PARSED = T.StructType([
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("anchors", T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])))])


def parsed_anchors(html: Column, most_texts: int | None = None) -> Column:
    """struct<texts, anchors: array<struct<href, lo, hi>>> of a page, null for null: its text nodes, and the anchors in document order with
    the text nodes [lo, hi) in them, ``most_texts`` at most. Nested anchors share the nodes, so the result is linear in the page."""

    @arrow_udf(PARSED)
    def parse(pages: pa.Array) -> pa.Array:
        kind = pa.struct([("texts", pa.list_(pa.string())), ("anchors", pa.list_(pa.struct([("href", pa.string()), ("lo", pa.int32()), ("hi", pa.int32())])))])
        return pa.array([None if page is None else Anchors().read(page, most_texts) for page in pages.to_pylist()], kind)

    return parse(html)
