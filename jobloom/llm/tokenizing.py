"""Token ids of whole Arrow text columns with a byte-level BPE of the ``tokenizers`` library.

Byte-level BPE encodes each pre-token on its own, and between two non-space characters a single
space always begins a new pre-token. So a text is cut before such spaces, each distinct piece is
encoded once, and the ids are put together by numpy. Texts where a space stands next to other
white space or at an end are encoded whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: distinct pieces whose ids a worker process remembers
REMEMBERED = 300_000
#: fixed value: how the byte-level pre-tokenizer splits text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOOSE = r"[\x09-\x0D\x20\x{85}\p{Z}] | [\x09-\x0D\x20\x{85}\p{Z}]|^ | $"


class Encoder:
    """The vocabulary and merges of a ``tokenizers`` file. Where its merges are in the order of ids (rank BPE), pieces go through
    ``tiktoken`` with the same ranks, which gives the same ids sooner; else through ``tokenizers``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark uses all cores already
        self.path, self.tokenizer = path, None
        self.ranked, self.special = _ranked(path)
        self.known, self.ids, self.ends = pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64)

    @staticmethod
    def of(path: str) -> Encoder:
        """The encoder that this worker process has, or a new one."""
        import tokenizers

        held = tokenizers.__dict__.setdefault("_held_encoders", {})
        if path not in held:
            held.clear()
            held[path] = Encoder(path)
        return held[path]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        if self.ranked is None or self.special and any(self.special.search(t) for t in texts):
            if self.tokenizer is None:
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_file(self.path)
            return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [np.array(self.ranked[0].encode_ordinary(t), dtype="<u4") for t in texts]

    def _spaced(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, a space before each, and where each one's end."""
        text = " " + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), " ")[0].as_py()
        if self.ranked is None or self.special and self.special.search(text):
            coded = self._whole([" " + p for p in pieces.to_pylist()])
            return np.concatenate(coded), np.cumsum([len(c) for c in coded])
        encoding, widths = self.ranked
        ids = encoding.encode_to_numpy(text).astype("<u4")
        # each piece begins a new pre-token, so its ids end where its bytes do
        ends = np.cumsum(pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        return ids, np.searchsorted(np.cumsum(widths[ids]), ends) + 1

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size of each piece), pieces with the space before them. New ones are remembered while there is room."""
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(at.is_null())
        at = at.to_numpy(zero_copy_only=False)
        place = np.where(np.isnan(at), 0, at).astype(np.int64) if at.dtype.kind == "f" else at.astype(np.int64)
        ids, ends = self.ids, self.ends
        if len(new):
            place[np.isnan(at)] = len(self.known) + np.arange(len(new))
            more, stops = self._spaced(new)
            ids, ends = np.concatenate([ids, more]), np.concatenate([ends, stops + len(ids)])
            if len(self.known) + len(new) <= REMEMBERED:
                self.known, self.ids, self.ends = pa.concat_arrays([self.known, new]), ids, ends
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return ids, begins[place], ends[place] - begins[place]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of row r are ids[offsets[r]:offsets[r + 1]]. Nulls are empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if not len(texts):
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        texts = pc.fill_null(texts.cast(pa.string()), "")
        loose = pc.match_substring_regex(texts, _LOOSE)
        split = pc.split_pattern(pc.if_else(loose, "", texts), " ")
        bounds = np.asarray(split.offsets, dtype=np.int64)
        bounds = bounds - bounds[0]
        flat, firsts = split.flatten(), bounds[:-1]
        # the first piece of a text has no space before it; a loose text is one piece
        heads = flat.take(pa.array(firsts)).to_pylist()
        for r, text in zip(np.flatnonzero(np.asarray(loose)), texts.filter(loose).to_pylist(), strict=True):
            heads[r] = text
        heads = self._whole(heads)
        named = flat.dictionary_encode()
        unit = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        inner = np.ones(len(unit), dtype=bool)
        inner[firsts] = False
        used = np.zeros(len(named.dictionary), dtype=bool)
        used[unit[inner]] = True
        ids, begin, size = self._pieces(named.dictionary.filter(pa.array(used)))
        rank = np.cumsum(used) - 1
        head_size = np.fromiter(map(len, heads), dtype=np.int64, count=len(heads))
        begin = np.concatenate([begin, len(ids) + np.cumsum(head_size) - head_size])
        size = np.concatenate([size, head_size])
        unit = np.where(inner, rank[unit], 0)
        unit[firsts] = used.sum() + np.arange(len(firsts))
        length = size[unit]
        ends = np.cumsum(length)
        take = np.arange(ends[-1]) + np.repeat(begin[unit] - (ends - length), length)
        return np.concatenate([ids, *heads])[take], np.concatenate([[0], ends])[bounds]


def _ranked(path: str):
    """((encoding, bytes of each id), pattern of special strings); the first is None where ids aren't ranks."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = [t["content"] for t in model.get("added_tokens") or []]
    find = re.compile("|".join(map(re.escape, special))) if special else None
    vocab, merges, before = model["model"]["vocab"], model["model"]["merges"], model.get("pre_tokenizer") or {}
    made = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in merges]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") \
        and not model.get("normalizer") and not model["model"].get("byte_fallback")
    if not plain or None in made or made != sorted(made) or len(set(made)) != len(made):
        return None, find
    import tiktoken

    # the byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
    widths = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
    for token, i in ranks.items():
        widths[i] = len(token)
    return (tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), widths), find


def vocabulary(path: str | None, name: str = "byte_bpe_50k.json") -> str:
    """``path``, or that of the installed public vocabulary."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)
