"""Token ids of whole texts by a public tokenizer file, with a cache of chunks.

A text is cut where the tokenizer itself always cuts: a byte-level BPE before
each single space between other characters, a word BPE at white space.  The
chunks' ids are kept in a bounded cache, which holds most of a text's chunks,
and are joined.  Any other tokenizer, and any text with unusual white space,
is encoded as a whole; the ids are the same either way.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np

#: Chunks kept in a worker, about 200 bytes each.
CACHE = 800_000
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
# What the two kinds of tokenizer cut a Latin-1 chunk into.
_SPACED = re.compile(rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_PLAIN = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


class _Odd(Exception):
    """A chunk that can't be encoded apart from its neighbours."""


class _Cache(dict):
    """Two generations: entries not used for one are dropped."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        self.make, self.limit, self.old = make, limit // 2, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if packed.itemsize != 4 or sys.byteorder != "little":
        return np.array(ids, "<u4").tobytes()
    return packed.tobytes()


class Encoder:
    def __init__(self, path: str, cache: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.chars = _byte_chars()
        self.space = self.chars[32]
        with open(path) as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"]
        steps = [s["type"] for s in (norm or {}).get("normalizers", [])]
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not norm:
            self.kind = "spaced"
        elif [p["type"] for p in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"] and steps == ["NFC", "Replace", "Lowercase"]:
            self.kind = "plain"
        else:
            self.kind = "whole"
        self.pieces = _Cache(self._piece, cache // 8)
        self.chunks = _Cache(self._spaced if self.kind == "spaced" else self._plain, cache)

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        """A piece that the tokenizer cuts no further before its merges."""
        if not piece.isascii() or not piece.isalpha():
            piece = piece.encode().decode("latin-1").translate(self.chars)
        return _packed([t.id for t in self.model.tokenize(piece)])

    def _latin(self, chunk: str) -> bool:
        return (chunk.isascii() or ord(max(chunk)) < 256) and len(chunk) < 1000 and not any(s in chunk for s in self.special)

    def _spaced(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return _packed([t.id for t in self.model.tokenize(self.space + chunk)])
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Odd
        if not self._latin(chunk):
            return self.whole(" " + chunk)
        first, *rest = _SPACED.findall(" " + chunk)
        if not rest:
            return self._piece(first)
        return self.chunks[first[1:]] + b"".join(map(self.pieces.__getitem__, rest))

    def _plain(self, chunk: str) -> bytes:
        if not self._latin(chunk):
            return self.whole(chunk)
        chunk = chunk.lower()
        parts = [chunk] if chunk.isascii() and chunk.isalpha() else _PLAIN.findall(chunk)
        return self._piece(chunk) if len(parts) == 1 else b"".join(map(self.chunks.__getitem__, parts))

    def encode(self, text: str) -> np.ndarray:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self.kind == "spaced":
            first, *chunks = text.split(" ")
            try:
                if first and first[-1].isspace():
                    raise _Odd
                data = (self.whole(first) if first else b"") + b"".join(map(self.chunks.__getitem__, chunks))
            except _Odd:
                data = self.whole(text)
        elif self.kind == "plain" and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            data = b"".join(map(self.chunks.__getitem__, text.split()))
        else:
            data = self.whole(text)
        return np.frombuffer(data, "<u4")


def _file(name: str) -> str:
    """The path of a file of the public tokenizers, or the path given."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Handle:
    """A job's encoder, made in each worker that asks for it.

    Broadcast by the job, so that a worker drops it, with its cache, when it goes on to another job's tasks.
    """

    def __init__(self, name: str):
        self.name, self._encoder = name, None

    def __getstate__(self) -> dict:
        return {"name": self.name, "_encoder": None}

    @property
    def encoder(self) -> Encoder:
        if self._encoder is None:
            self._encoder = Encoder(_file(self.name))
        return self._encoder
