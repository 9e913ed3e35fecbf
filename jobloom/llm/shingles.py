"""Hashed word shingles of whole Arrow text columns, by numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import STEP, slices, text_bytes, word_spans  # noqa: F401

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(n: int) -> np.ndarray:
    """An odd factor for each place of a word. They follow no power law: words that cancel under powers modulo 2^64 do not here."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z lower-cased. Words are hashed in steps of bounded memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    size = ends - starts
    total = np.cumsum(size)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + STEP, side="right")))
        length = size[a:b]
        place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        data = flat[np.repeat(starts[a:b], length) + place]
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
        out[a:b] = np.add.reduceat(_BYTE[data] * _places(int(length.max()))[place], np.cumsum(length) - length)
        a = b
    return mixed(out + size.astype(np.uint64) * _STEP)


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """For each row its sorted distinct shingle hashes (unsigned): of ``width`` words, or of all words if fewer; empty without words."""
    flat, offsets = text_bytes(texts)
    starts, ends, first = word_spans(flat, offsets)
    words = word_hashes(flat, starts, ends)
    total = len(words) - width + 1
    run = np.zeros(max(total, 0), dtype=np.uint64)
    for k in range(width if total > 0 else 0):
        run += words[k:k + total] * _PLACE[k]
    run = mixed(run)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = b - a
        if n >= width:
            out.append(np.unique(run[a:b - width + 1]))
        elif n:
            short = (words[a:b] * _PLACE[width:width + n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mixed(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share, as two signed numbers."""
    a = tokens.sum(dtype=np.uint64)
    b = np.bitwise_xor.reduce(mixed(tokens + _STEP)) if len(tokens) else np.uint64(0)
    return int(np.array(a, np.uint64).view(np.int64)), int(np.array(b, np.uint64).view(np.int64))
