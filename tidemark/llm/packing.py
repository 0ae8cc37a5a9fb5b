"""Packing documents into token sequences along a space-filling curve.

Documents are tokenised once (lower-case word BPE of the tokenizers library, an end id after each)
and stored with a place on a Hilbert curve: token ids are hashed into a count vector of ``WIDE``
dimensions, which is scaled to length one, projected to ``DIMS`` dimensions and cut into 2^``BITS``
steps each. Rows are range-partitioned and sorted by that key, then id, so equal documents spread
over ranges too, and each partition concatenates its documents and cuts the stream every ``size``
ids. What remains at a partition's end goes into sequences whose lengths are powers of two, which
need no padding.

Special strings of the vocabulary give their ids, as the library has it. Extra columns are left out.

Defined cases: a NULL text is empty, and an empty document is its end id alone; documents longer
than a sequence continue in the next; repeated rows and NULL ids are packed like others; texts are
packed whole; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.arrow import named, slices, with_arrow
from tidemark.llm.graph import stored
from tidemark.llm.units import as_characters, shared_encoder

SIZE = 2048
END = 1
WIDE, DIMS, BITS = 256, 4, 8
CACHED = 300_000  # units, and as many pieces: about 120 MB in every Python worker
_ODD = re.compile("[^\x00-˿]")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # no apostrophe: it may begin a piece of letters


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _units(text: str) -> list[str]:
    """Blanks and line ends separate words for the tokenizer too.

    Below U+0300 its normalisation is lower-casing, so that is done once for the whole text.
    """
    if text.isascii() or not _ODD.search(text):
        text = text.lower()
    return text.replace("\n", " ").split(" ")


def _pieces(unit: str) -> list[str] | None:
    """A word, or a word and the marks behind it, which the tokenizer takes as one piece."""
    plain = unit.isascii()
    if not unit.islower() if plain else _ODD.search(unit) or unit != unit.lower():
        return None
    word = unit.rstrip(_MARKS)
    if not word.isalpha():
        return None
    shown = word if plain else as_characters(word)
    return [shown] if len(word) == len(unit) else [shown, unit[len(word):]]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of rows of integers below 2^bits (Skilling's method)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ t)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(t)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(documents: list[np.ndarray], seed: int = 11) -> np.ndarray:
    """Hilbert key of every document's hashed token counts."""
    rng = np.random.default_rng(seed)
    slot = rng.integers(0, WIDE, 1 << 16)
    project = rng.standard_normal((WIDE, DIMS))
    counts = np.array([np.bincount(slot[d & 0xFFFF], minlength=WIDE) for d in documents], float)
    counts = counts.reshape(-1, WIDE)
    length = np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1)
    places = counts / length @ project
    steps = np.clip((places + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert(steps.astype(np.int64), BITS)


def tokenise(
    docs: DataFrame, by: str = "doc_id", text: str = "text", path: str | None = None
) -> DataFrame:
    """id, key and ids (little-endian unsigned integers, end id included)."""
    path = path or vocabulary_path()

    def make():
        encoder = shared_encoder(path, "word", _units, _pieces, CACHED, special=True)
        end = np.array([END], encoder.dtype)

        def step(texts):
            found = [np.concatenate([encoder.ids(t or ""), end]) for t in texts]
            return [
                pa.array(curve_keys(found), pa.int64()),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([f.astype("<u2").tobytes() if f.dtype.itemsize == 2 else f.tobytes()
                          for f in found], pa.binary()),
            ]

        return step

    fields = [
        T.StructField("key", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
    rows = docs.select(named(by).alias("id"), named(text).alias("text"))
    return with_arrow(rows, ["id"], [F.col("text")], fields, make)


_PIECES = (
    "id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)
_NAMES = [x.split()[0] for x in _PIECES.split(", ")]


def _packed(size: int):
    def run(batches):
        sequence = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []  # (id, start, ids, n) of the sequence being filled
        filled = 0
        out: list[tuple] = []

        def close():
            nonlocal sequence, filled
            at = 0
            for i, start, ids, n in waiting:
                out.append((i, start, len(ids), n, sequence, at, ids.astype("<u4").tobytes()))
                at += len(ids)
            waiting.clear()
            sequence += 1
            filled = 0

        def table():
            columns = list(zip(*out)) or [[] for _ in _NAMES]
            types = [pa.int64()] * 6 + [pa.binary()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES
            )

        for batch in slices(batches):
            for i, n, raw in zip(*[c.to_pylist() for c in batch.columns]):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")
                start = 0
                while start < n:
                    take = min(size - filled, n - start)
                    waiting.append((i, start, ids[start:start + take], n))
                    filled += take
                    start += take
                    if filled == size:
                        close()
            yield table()
        rest, left = list(waiting), filled
        waiting.clear()
        filled = 0
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            while room:
                i, start, ids, n = rest.pop(0)
                waiting.append((i, start, ids[:room], n))
                if len(ids) > room:
                    rest.insert(0, (i, start + room, ids[room:], n))
                room -= min(room, len(ids))
            close()
        yield table()

    return run


def pack(
    docs: DataFrame, by: str = "doc_id", text: str = "text", size: int = SIZE,
    path: str | None = None,
) -> DataFrame:
    """Pieces: id, start, length, doc_tokens, sequence_id, offset and ids (32-bit little-endian)."""
    tokens = stored(tokenise(docs, by, text, path), "tokens")
    ordered = tokens.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return ordered.select(F.col("id").cast("long"), "n", "ids").mapInArrow(_packed(size), _PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and its ids in order, from the pieces (at most one sequence's ids a group)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))["ids"]
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate(
            "parts", F.lit(b""), lambda a, p: F.concat(a, p)
        ).alias("ids"),
    )


def report(docs: DataFrame) -> DataFrame:
    """Per piece its place, and the CRC-32 of its ids."""
    return pack(docs).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )
