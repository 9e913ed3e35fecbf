"""Words of whole Arrow text columns, found with numpy on the UTF-8 bytes.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D). Those bytes never
occur inside a multi-byte character, so words by bytes and words by code points are the same.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

#: bytes of text worked on at a time
STEP = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column, and where each row's begin and end (n + 1 offsets). Nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, dtype=np.int64)
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets.astype(np.int64) - offsets[0]


def word_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words in order; row r has words first[r]..first[r+1]-1."""
    space = np.ones(len(flat) + 1, dtype=bool)
    np.take(_SPACE, flat, out=space[:-1])
    inner = offsets[(offsets > 0) & (offsets < len(flat))]
    before = np.ones(len(flat) + 1, dtype=bool)
    before[1:] = space[:-1]
    before[inner] = True  # a row's first byte follows no word
    starts = np.flatnonzero(~space[:-1] & before[:-1])
    after = space[1:].copy()
    after[inner - 1] = True
    ends = np.flatnonzero(~space[:-1] & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between batches and stages, beside a JVM that needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc
        trim(0)


def slices(texts: pa.Array, step: int = STEP):
    """Row ranges of about ``step`` bytes of text."""
    _, offsets = text_bytes(texts)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + step, side="right")) - 1)
        yield a, b
        a = b
    give_back()


@arrow_udf(T.LongType())
def count_words(texts: pa.Array) -> pa.Array:
    counts = [np.diff(word_spans(*text_bytes(texts.slice(a, b - a)))[2]) for a, b in slices(texts)]
    return pa.array(np.concatenate(counts) if counts else np.empty(0, np.int64))


@arrow_udf(T.StringType())
def first_words(texts: pa.Array, n: pa.Array) -> pa.Array:
    """The text up to the end of its n-th word; null for null."""
    flat, offsets = text_bytes(texts)  # only texts to be cut are not null
    _, ends, first = word_spans(flat, offsets)
    out = []
    for r, (valid, k) in enumerate(zip(texts.is_valid().to_pylist(), n.to_pylist(), strict=True)):
        k = min(k or 0, first[r + 1] - first[r])
        stop = ends[first[r] + k - 1] if k > 0 else offsets[r]
        out.append(flat[offsets[r]:stop].tobytes().decode() if valid else None)
    return pa.array(out, pa.string())
