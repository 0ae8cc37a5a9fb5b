"""Tokenising through a bounded cache of text units.

A unit is a stretch that the tokenizer never joins with its neighbours, so ids of a text are the
ids of its units in order. Words repeat, so most units are looked up instead of encoded.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np

# Unicode white space (fixed values), the \s of the tokenizers' own patterns.
WHITE = "\t-\r \x85\xa0  -     　"

LONGEST_CACHED = 48  # characters; longer units are encoded anew each time
MOST_CACHED = 125_000  # units, and as many pieces (about 60 MB); a cache starts again when full


def load_tokenizer(path: str, special: bool = False):
    """With ``special``, special strings in a text become their ids; else they are ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    return tokenizer


class UnitEncoder:
    """Ids of a text as little-endian unsigned integers (16 bit where the vocabulary allows).

    ``split`` cuts a text into units. ``pieces`` cuts a unit into the strings that the tokenizer's
    model sees one by one, or returns None where only the whole tokenizer will do. With ``special``,
    special strings are cut out first, as the library does, and give their ids.
    """

    def __init__(
        self, path: str, split: Callable[[str], list[str]],
        pieces: Callable[[str], list[str] | None], most: int = MOST_CACHED, special: bool = False,
    ):
        self.tokenizer = load_tokenizer(path)
        marks = self.tokenizer.get_added_tokens_decoder() if special else {}
        self.marks = {t.content: i for i, t in marks.items() if t.special}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.marks)) + ")") if self.marks else None
        self.split, self.pieces, self.most = split, pieces, most
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        if len(ids) == 1:
            return ids[0].to_bytes(self.dtype.itemsize, "little")
        packed = array(self.dtype.char, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _unit(self, unit: str) -> bytes:
        pieces = self.pieces(unit)
        if pieces is None:
            return self._bytes(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        out, parts = b"", self.parts
        for piece in pieces:
            ids = parts.get(piece)
            if ids is None:
                ids = self._bytes([t.id for t in self.model.tokenize(piece)])
                if len(piece) <= LONGEST_CACHED:
                    parts[piece] = ids
            out += ids
        return out

    def ids(self, text: str) -> np.ndarray:
        if not any(mark in text for mark in self.marks):
            return self._plain(text)
        return np.concatenate([
            np.array([self.marks[part]], self.dtype) if part in self.marks else self._plain(part)
            for part in self.cut.split(text) if part
        ])

    def _plain(self, text: str) -> np.ndarray:
        units = self.split(text)
        for known in (self.cache, self.parts):
            if len(known) > self.most:
                known.clear()
        cache = self.cache
        out = list(map(cache.get, units))
        for i in [i for i, found in enumerate(out) if found is None] if None in out else ():
            unit = units[i]
            found = cache.get(unit)
            if found is None:
                found = self._unit(unit)
                if len(unit) <= LONGEST_CACHED:
                    cache[unit] = found
            out[i] = found
        return np.frombuffer(b"".join(out), self.dtype)


_encoders: dict[tuple[str, str], UnitEncoder] = {}


def shared_encoder(
    path: str, kind: str, split: Callable[[str], list[str]],
    pieces: Callable[[str], list[str] | None], most: int = MOST_CACHED, special: bool = False,
) -> UnitEncoder:
    """One encoder per Python worker, kept between its tasks."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = UnitEncoder(path, split, pieces, most, special)
    return _encoders[path, kind]


def byte_characters() -> dict[str, int]:
    """Printable character to byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


_SHOWN = {b: c for c, b in byte_characters().items()}


def as_characters(piece: str) -> str:
    """The UTF-8 bytes of a piece as the printable characters of byte-level vocabularies."""
    if piece.isascii() and piece.isalnum():
        return piece  # these bytes stand for themselves
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(_SHOWN)
