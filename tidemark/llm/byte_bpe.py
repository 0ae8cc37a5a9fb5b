"""Byte-level BPE encoding and decoding in Arrow batches.

Encoding runs the tokenizers library's model on the units of a text (see ``units``): a unit is a run of
non-space characters with at most one space before it, or a run of white space, which are exactly
the places where the split pattern always ends a match. Decoding maps every vocabulary entry back
from its printable characters to bytes and joins them, so a character that is split over several
tokens comes back whole, and ids cut in the middle of one give its bare bytes.

Defined cases: a NULL text is empty; an empty text has no ids; NULL ids decode to empty bytes;
special-token strings in a text are ordinary text; texts of any length are encoded whole; repeated
rows are encoded alike; an empty table gives no rows; other columns of the input pass through if
named in ``keep``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.arrow import named, with_arrow
from tidemark.llm.units import (
    WHITE, as_characters, byte_characters, load_tokenizer, shared_encoder,
)

_UNIT = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _pieces(unit: str) -> list[str]:
    import public_tokenizers
    import regex

    global _pattern
    word = unit[1:] if unit[0] == " " else unit
    if word.isalpha():  # the two most frequent shapes need no pattern
        return [as_characters(unit)]
    if word[-1:] in ".,;:!?" and word[:-1].isalpha():
        return [as_characters(unit[:-1]), unit[-1]]
    if _pattern is None:
        _pattern = regex.compile(public_tokenizers.PATTERN).findall
    return list(map(as_characters, _pattern(unit)))


_pattern = None


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id; entries that are no byte strings (special tokens) are their text."""
    table = byte_characters()
    out: list[bytes] = []
    for token, i in sorted(load_tokenizer(path).get_vocab().items(), key=lambda x: x[1]):
        out += [b""] * (i - len(out))
        known = all(c in table for c in token)
        out.append(bytes(table[c] for c in token) if known else token.encode())
    return out


_tables: dict[str, list[bytes]] = {}


def _table(path: str) -> list[bytes]:
    if path not in _tables:
        _tables[path] = token_bytes(path)
    return _tables[path]


def encode(
    df: DataFrame, keep: list[str], text: str = "text", path: str | None = None,
    ids: str = "ids", offsets: str | None = None,
) -> DataFrame:
    """``keep`` and ``ids``: the ids as little-endian unsigned 32-bit integers in one binary value.

    With ``offsets``, a further array<long> of that name holds the character at which each token
    starts; a token inside a split character starts at that character.
    """
    path = path or vocabulary_path()

    def make():
        encoder = shared_encoder(path, "byte", _UNIT.findall, _pieces)
        sizes = None
        if offsets:
            sizes = np.array([len(b) for b in _table(path)], np.int64)

        def step(texts):
            found = [encoder.ids(t or "") for t in texts]
            out = [pa.array([f.astype("<u4").tobytes() for f in found], pa.binary())]
            if offsets:
                out.append(pa.array(
                    [_starts(t or "", sizes[f]) for t, f in zip(texts, found)],
                    pa.list_(pa.int64()),
                ))
            return out

        return step

    fields = [T.StructField(ids, T.BinaryType())]
    if offsets:
        fields.append(T.StructField(offsets, T.ArrayType(T.LongType())))
    return with_arrow(df, keep, [named(text)], fields, make)


def _starts(text: str, sizes: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return character[np.cumsum(sizes) - sizes]


def decode(
    df: DataFrame, keep: list[str], ids: str = "ids", path: str | None = None,
    out: str = "decoded",
) -> DataFrame:
    """``keep`` and ``out``: the bytes that the ids stand for. Unknown ids raise."""
    path = path or vocabulary_path()

    def make():
        table = _table(path).__getitem__

        def step(values):
            return [pa.array(
                [b"".join(map(table, np.frombuffer(v or b"", "<u4").tolist())) for v in values],
                pa.binary(),
            )]

        return step

    return with_arrow(df, keep, [named(ids)], [T.StructField(out, T.BinaryType())], make)


def digests(docs: DataFrame) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids and of the bytes decoded from them."""
    encoded = encode(docs, ["doc_id"], ids="ids")
    both = decode(encoded, ["doc_id", "ids"], out="decoded")
    return both.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
