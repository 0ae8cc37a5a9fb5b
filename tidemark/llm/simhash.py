"""SimHash near-duplicates through multi-index hashing.

A fingerprint has 64 bits; bit b is set if it is set in over half of the XXH64 values (seed 42) of
a text's word shingles, repeats included. Two fingerprints link at ``RADIUS`` differing bits or
fewer. Of two halves at least one then differs in one bit at most, so every fingerprint is entered
under both halves, looks up each half and each half with one bit changed, and whatever it meets is
verified on all 64 bits. A bit is only changed from 1 to 0: the other direction is the partner's.

A half that more than ``CROWDED`` fingerprints share is not paired. Everyone who looks there takes
the exact way for crowds: two fingerprints are within two bits if and only if some 64-bit word is
within one bit of both, so each is entered under its 65 such words; at most 65 distinct fingerprints
can share one, and they are chained instead of paired. Equal fingerprints are one row throughout.

Defined cases: texts that are NULL or hold no word have fingerprint zero and link like any other;
with fewer than three words the whole sequence is the only shingle; rows with a NULL id get a
fingerprint and component but never name one; repeated rows stay. Texts are hashed whole; an empty
table gives no rows; extra columns are left out.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.arrow import named, with_arrow
from tidemark.llm.graph import SALTS, components, stored

RADIUS = 2
CROWDED = 64
SEED = 42
_HALVES = tuple(np.int64(np.uint64(m)) for m in (0x00000000FFFFFFFF, 0xFFFFFFFF00000000))
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str, words: int = 3) -> int:
    import xxhash

    digest = xxhash.xxh64_intdigest
    parts = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and space only
    if not parts:
        return 0
    whole = b" ".join(parts)
    if len(parts) <= words:
        return digest(whole, SEED)
    ends = list(accumulate(map((1).__add__, map(len, parts))))
    starts = [0, *ends]
    hashes = [digest(whole[s:e - 1], SEED) for s, e in zip(starts, ends[words - 1:])]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; 255 rows at a time are added in byte lanes."""
    n = len(hashes)
    padded = np.zeros(-(-n // 255) * 255, np.uint64)
    padded[:n] = hashes
    blocks = padded.reshape(-1, 255)
    result = 0
    for shift in range(8):
        lanes = ((blocks >> np.uint64(shift)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(counts * 2 > n):
            result |= 1 << (int(byte) * 8 + shift)
    return result


def fingerprints(
    docs: DataFrame, keep: list[str], text: str = "text", words: int = 3, out: str = "fingerprint"
) -> DataFrame:
    """``keep`` and the fingerprint as a long (its 64 bits, signed)."""
    def make():
        def step(texts):
            found = np.array([fingerprint(t or "", words) for t in texts], np.uint64)
            return [pa.array(found.view(np.int64), pa.int64())]

        return step

    return with_arrow(docs, keep, [named(text)], [T.StructField(out, T.LongType())], make)


def _bits(mask: int) -> list[int]:
    """The single bits inside a half, as signed 64-bit values."""
    whole = int(mask) & (2**64 - 1)
    return [
        (1 << b) - (1 << 64) * (b == 63) for b in range(64) if whole >> b & 1
    ]


def _each_half(make) -> Column:
    return F.array(*[
        F.struct(F.lit(i).alias("half"), make(mask).alias("key")) for i, mask in enumerate(_HALVES)
    ])


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` within RADIUS bits.

    Every edge's ends belong to one component; pairs in crowded halves come as chains.
    """
    fp = F.col("fp")
    table = fps.select("fp", F.inline(_each_half(lambda m: fp.bitwiseAND(F.lit(int(m))))))
    crowded = table.groupBy("half", "key").agg(F.count("*").alias("n")).where(
        F.col("n") > CROWDED
    ).select("half", "key")
    entries = table.join(crowded.hint("merge"), ["half", "key"], "left_anti").select(
        "half", "key", F.col("fp").alias("other")
    ).unionByName(crowded.withColumn("other", F.lit(None).cast("long")))
    changes = F.array(*[
        F.struct(F.lit(i).alias("half"), F.lit(int(m)).alias("mask"), F.lit(b).alias("bit"))
        for i, m in enumerate(_HALVES) for b in (0, *_bits(m))
    ])
    probes = fps.select("fp", F.inline(changes)).where(
        fp.bitwiseAND(F.col("bit")) == F.col("bit")
    ).select(
        "fp", "half", fp.bitwiseAND(F.col("mask")).bitwiseXOR(F.col("bit")).alias("key")
    )
    met = stored(
        probes.join(entries.hint("merge"), ["half", "key"]).where(
            F.col("other").isNull()
            | ((fp != F.col("other")) & (F.bit_count(fp.bitwiseXOR(F.col("other"))) <= RADIUS))
        ).select("fp", "other"), "met",
    )
    pairs = met.where(F.col("other").isNotNull()).select(
        fp.alias("a"), F.col("other").alias("b")
    )
    near = F.array(F.lit(0), *[F.lit(b) for b in _bits(-1)])
    words = met.where(F.col("other").isNull()).select("fp").distinct().select(
        "fp", F.explode(near).alias("bit")
    ).select("fp", fp.bitwiseXOR(F.col("bit")).alias("word"))
    # At most 65 distinct fingerprints lie within one bit of a word.
    chains = words.groupBy("word").agg(F.collect_list("fp").alias("all")).where(
        F.size("all") > 1
    ).select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a != b")
    return pairs.unionByName(chains.distinct())


def classes(prints: DataFrame, by: str, fp: str = "fingerprint") -> DataFrame:
    """(fp, component): the smallest ``by`` reachable from each distinct fingerprint.

    ``prints`` is read several times, so pass a stored table.
    """
    distinct = stored(
        prints.groupBy(named(fp).alias("fp")).agg(F.min(named(by)).alias("low")), "prints"
    )
    reach = stored(components(links(distinct.select("fp"))), "reach")
    named_roots = reach.join(distinct.hint("merge"), reach["node"] == distinct["fp"]).groupBy("root").agg(
        F.min("low").alias("component")
    )
    grouped = reach.join(named_roots.hint("merge"), "root").select("node", "component")
    return distinct.join(grouped.hint("merge"), F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "low").alias("component")
    )


def near_duplicates(docs: DataFrame, by: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, fingerprint (long) and component, the smallest id reachable over links."""
    prints = stored(fingerprints(docs, [by], text), "fingerprints")
    # Rows of one fingerprint are spread over groups; its component follows them where they are.
    spread = prints.select(
        named(by).alias("_by"), "fingerprint", F.pmod(F.xxhash64(named(by)), F.lit(SALTS)).alias("_salt")
    )
    groups = spread.select("fingerprint", "_salt").distinct().join(
        classes(prints, by).hint("merge"), F.col("fingerprint") == F.col("fp")
    ).select("fingerprint", "_salt", "component")
    return spread.join(groups.hint("merge"), ["fingerprint", "_salt"]).select(
        F.col("_by").alias(by), "fingerprint", F.col("component").alias("component_id")
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: fingerprint as 16 lowercase hex digits, and component id."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
