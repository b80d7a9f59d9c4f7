"""Encoding with the byte-level vocabulary of a tokenizer file, batch by batch.

The file's merges and ids are checked to be ranks (ids rise with the merges), so that tiktoken gives the ids that
the file's own library gives. Texts are cut at spaces where a match of the split pattern begins; a worker
keeps a bounded number of parts encoded.
"""
from __future__ import annotations

import json
import sys
from array import array

import numpy as np

from .words import matcher, parts

#: Parts of texts that a worker keeps encoded, twice over and those of a batch, and the longest kept.
CACHE = 100_000
PART = 64


def little(ids: array) -> array:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


def held_or_fresh(needed: set[str], recent: dict[str, bytes], old: dict[str, bytes]) -> list[str]:
    """Of the needed words those that neither dictionary holds; those of ``old`` move to ``recent``."""
    fresh = []
    for word in needed - recent.keys():
        ids = old.get(word)
        if ids is None:
            fresh.append(word)
        else:
            recent[word] = ids
    return fresh


def byte_symbols() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class ByteVocabulary:
    """``tokens``: the bytes of each id (None for added tokens)."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        added = {t["id"] for t in data["added_tokens"]}
        symbols = byte_symbols()
        self.tokens: list[bytes | None] = [None] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if i not in added:
                self.tokens[i] = bytes(map(symbols.__getitem__, token))
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        if made != sorted(made) or len(made) != len(set(made)) or len(made) + 256 != sum(t is not None for t in self.tokens):
            raise ValueError("a byte-level vocabulary whose ids rise with its merges is expected")
        self.encoding = tiktoken.Encoding("file", pat_str=pattern, special_tokens={},
                                          mergeable_ranks={t: i for i, t in enumerate(self.tokens) if t is not None})
        self.lengths = np.array([len(t or b"") for t in self.tokens], np.int64)
        self.find = matcher(pattern).findall

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit little-endian numbers, without special tokens: their strings are ordinary text."""
        return little(array("I", self.encoding.encode_ordinary(text))).tobytes()

    def encode_parts(self, some: list[str]) -> list[bytes]:
        """Ids of parts of texts, each with a space in front, all in one call: the tokens' lengths tell whose they are."""
        if not some:
            return []
        ids = np.array(self.encoding.encode_ordinary(" " + " ".join(some)), "<u4")
        ends = np.cumsum([len(p.encode()) + 1 for p in some])
        at = (4 * np.searchsorted(self.lengths[ids].cumsum(), ends, side="right")).tolist()
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *at], at)]

    def encode_whole(self, text: str) -> bytes:
        """As ``encode`` for a text of any length, match by match."""
        return b"".join(map(self.encode, self.find(text)))


class ByteEncoder:
    def __init__(self, path: str, pattern: str, cache: int = CACHE):
        self.vocabulary, self.cache = ByteVocabulary(path, pattern), cache
        self.recent: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of the texts of a batch, as 32-bit little-endian numbers."""
        cut = [parts(t) for t in texts]
        fresh = held_or_fresh(set().union(*(c[1:] for c in cut if c)), self.recent, self.old)
        self.recent.update(zip(fresh, self.vocabulary.encode_parts(fresh)))
        encode = self.vocabulary.encode
        out = [self.vocabulary.encode_whole(t) if c is None else (encode(c[0]) if c[0] else b"") + b"".join(map(self.recent.__getitem__, c[1:]))
               for t, c in zip(texts, cut)]
        for part in fresh:
            if len(part) > PART:
                del self.recent[part]
        if len(self.recent) > self.cache:
            self.old, self.recent = self.recent, {}
        return out
