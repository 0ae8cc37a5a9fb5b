"""Removal of byte strings that occur twice, with a difference cover.

A byte goes if some ``length``-byte string that covers it also starts anywhere else. Comparing the
suffixes at all places would move many times the text, so work goes in two blockwise steps:

1. *Cover sample.* Only places whose number in their document is in a difference cover modulo
   ``MODULUS`` are sampled, each with the string of ``length - MODULUS + 1`` bytes that starts there.
   Whatever two places hold equal ``length``-byte strings, some shift below the modulus takes both
   to sampled places, so two equal samples lie inside. The samples are sorted bucket by bucket (a
   bucket is a part of the hash space), which tells for every sample whether it is unique.
2. *Ties.* Places with a repeated sample in reach are the only ones whose strings can repeat. Their
   ``length``-byte strings are sorted bucket by bucket in the same way, which decides them.

Texts are stored once, compressed, in blocks of bounded size, as a table bucketed by block, and every
step reads the blocks where they lie. A block sends each distinct hash once per bucket, as packed
integers, and gets back one bit for each, so a string that is everywhere costs an entry per block,
and no bucket or block outgrows a task. Equal texts are recognised by a 128-bit digest; one of them
is searched for all, and all of them go whole.

Samples are compared by 40 bits of a 64-bit polynomial hash beside their bucket (a false repeat only
sends a place to step 2), ties by 64 bits beside a bucket that a second polynomial chooses.

Defined cases: NULL texts are empty; texts shorter than ``length`` bytes lose nothing; strings never
cross documents but may repeat and overlap within one; repeated rows are copies of each other; NULL
ids stay; documents longer than a block are a block of their own; an empty table gives no rows; extra
columns are left out. Nothing is ranked, so there are no ties to settle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.arrow import named, slices
from tidemark.llm.graph import stored
from tidemark.sources.shared import fresh_path

LENGTH = 200
MODULUS = 73
BLOCK_BYTES = 2_000_000
BLOCK_ROWS = 1 << 16
BUCKET_BYTES = 8_000_000  # of text for each bucket of hashes
MOST_TABLE_BUCKETS = 20_000


def difference_cover(modulus: int = MODULUS) -> np.ndarray:
    """Membership of 0 .. modulus - 1 in the powers of two, which cover all differences mod 73."""
    members = {pow(2, i, modulus) for i in range(modulus)}
    assert {(a - b) % modulus for a in members for b in members} == set(range(modulus))
    return np.array([i in members for i in range(modulus)])


class Rolling:
    """Polynomial hashes modulo 2^64 of all strings of one length in a run of bytes."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.value = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(0, 2**61)) * 8 + 5
        self.base, self.inverse = np.uint64(base % 2**64), np.uint64(pow(base, -1, 2**64))
        self.power = self.back = np.ones(1, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self.power) < len(data):
            size = 1 << (len(data) - 1).bit_length()
            for name, factor in (("power", self.base), ("back", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[:len(data)], out=sums[1:])
        return sums

    def at(self, sums: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
        h = (sums[places + length] - sums[places]) * self.back[places]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


_rolling: dict[int, Rolling] = {}


def _hasher(seed: int) -> Rolling:
    if seed not in _rolling:
        _rolling[seed] = Rolling(seed)
    return _rolling[seed]


def _spread(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _entries(bucket: np.ndarray, value: np.ndarray):
    """Distinct (bucket, value) in order, the number of each, and where each input went."""
    order = np.lexsort((value, bucket))
    b, v = bucket[order], value[order]
    fresh = np.ones(len(b), bool)
    fresh[1:] = (b[1:] != b[:-1]) | (v[1:] != v[:-1])
    group = np.cumsum(fresh) - 1
    where = np.empty(len(b), np.int64)
    where[order] = group
    return b[fresh], v[fresh], np.bincount(group), where


class Block:
    """The documents of one block and what earlier steps found about them."""

    def __init__(self, row: dict, length: int, buckets: int, cover: np.ndarray):
        import zstandard

        self.row, self.length, self.buckets = row, length, buckets
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.data = zstandard.ZstdDecompressor().decompress(
            row["packed"], max_output_size=int(self.sizes.sum()) + 1
        )
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        copies = np.array(row.get("copies") or [], np.int64)
        self.copy = np.zeros(len(self.sizes), bool)
        self.copy[copies >> 1] = True
        later = copies[copies & 1 == 1] >> 1
        # Later copies are neither sampled nor compared: the first one stands for them.
        skip = np.zeros(len(self.sizes), bool)
        skip[later] = True
        self.live = np.repeat(~skip, self.sizes)
        number = np.arange(len(self.bytes)) - np.repeat(self.starts, self.sizes)
        number = self.number = number.astype(np.int32)
        ends = np.repeat(self.sizes.astype(np.int32), self.sizes)
        self.left = ends - number  # bytes from here to the end
        self.window = length - len(cover) + 1
        self.sampled = np.flatnonzero(
            cover[number % len(cover)] & (self.left >= self.window) & self.live
        )
        self.sums = _hasher(1).prefix(self.bytes)

    def sample(self):
        h = _hasher(1).at(self.sums, self.sampled, self.window)
        return _entries(_spread(h, self.buckets), h & np.uint64((1 << 40) - 1))

    def _repeated(self, entries, bits: dict[int, bytes]) -> np.ndarray:
        """Per input whether its entry is repeated here or, by the bits sent back, elsewhere."""
        bucket, _, count, where = entries
        found = count > 1
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
        for a, b in zip(edges, [*edges[1:], len(bucket)]):
            sent = bits.get(int(bucket[a]))
            if sent is not None:
                found[a:b] |= np.unpackbits(np.frombuffer(sent, np.uint8), count=b - a).astype(bool)
        return found[where]

    def ties(self):
        """Places whose strings must be compared, and their entries."""
        repeated = self.sampled[self._repeated(self.sample(), _bits(self.row, "sampled"))]
        change = np.zeros(len(self.bytes) + 1, np.int32)
        reach = np.minimum(self.length - self.window, self.number[repeated])
        np.add.at(change, repeated - reach, 1)
        change[repeated + 1] -= 1
        near = np.cumsum(change[:-1]) > 0
        places = np.flatnonzero(near & (self.left >= self.length) & self.live)
        value = _hasher(1).at(self.sums, places, self.length)
        other = _hasher(2)
        choice = other.at(other.prefix(self.bytes), places, self.length)
        return places, _entries(_spread(choice, self.buckets), value)

    def removed(self) -> np.ndarray:
        """Per byte whether it goes."""
        places, entries = self.ties()
        places = places[self._repeated(entries, _bits(self.row, "tied"))]
        change = np.zeros(len(self.bytes) + 1, np.int32)
        change[places] += 1  # places are distinct
        change[places + self.length] -= 1
        gone = np.cumsum(change[:-1]) > 0
        whole = self.copy & (self.sizes >= self.length)
        return gone | np.repeat(whole, self.sizes)


def _bits(row: dict, name: str) -> dict[int, bytes]:
    return {r["bucket"]: r["bits"] for r in row.get(name) or []}


def _blocks(docs: DataFrame, by: str, text: str) -> DataFrame:
    """block, ids, sizes, digests and packed: texts in blocks, packed where they are read."""
    def run(batches):
        import xxhash
        import zstandard

        part, number = TaskContext.get().partitionId(), 0
        packer = zstandard.ZstdCompressor(level=3)
        ids, raws, size = [], [], 0

        def block():
            joined = b"".join(raws)
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 20) + number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([np.array(list(map(len, raws)), np.int64).tobytes()], pa.binary()),
                pa.array([b"".join(map(xxhash.xxh3_128_digest, raws))], pa.binary()),
                pa.array([packer.compress(joined)], pa.binary()),
            ], names=["block", "ids", "sizes", "digests", "packed"])

        for batch in slices(batches):
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (value or "").encode("utf-8", "surrogatepass")
                if ids and (size + len(raw) > BLOCK_BYTES or len(ids) >= BLOCK_ROWS):
                    yield block()
                    number += 1
                    ids, raws, size = [], [], 0
                ids.append(i)
                raws.append(raw)
                size += len(raw)
        if ids:
            yield block()

    return docs.select(named(by).cast("long"), named(text)).mapInArrow(
        run, "block long, ids array<long>, sizes binary, digests binary, packed binary"
    )


def _by_block(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The blocks as a table bucketed by block; each is a file or so, written without a shuffle."""
    path = fresh_path(spark, "blocks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = min(MOST_TABLE_BUCKETS, max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    ))
    df.write.bucketBy(buckets, "block").option("path", path).option(
        "compression", "uncompressed"
    ).format("parquet").saveAsTable(name)
    return spark.table(name)


def _copies(blocks: DataFrame, length: int) -> DataFrame:
    """block and its copied documents: twice their number, plus one unless they are the first."""
    def run(batches):
        for batch in slices(batches, 16):
            for block, sizes, digests in zip(*[c.to_pylist() for c in batch.columns]):
                fit = np.flatnonzero(np.frombuffer(sizes, np.int64) >= length)
                pairs = np.frombuffer(digests, np.int64).reshape(-1, 2)[fit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block * BLOCK_ROWS + fit), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                    names=["place", "h1", "h2"],
                )

    rows = stored(blocks.select("block", "sizes", "digests").mapInArrow(
        run, "place long, h1 long, h2 long"
    ), "digests")
    first = rows.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min("place").alias("first")
    ).where("n > 1").drop("n")
    place = F.col("place")
    shown = (place % BLOCK_ROWS) * 2 + F.when(place == F.col("first"), 0).otherwise(1)
    return rows.join(first, ["h1", "h2"]).groupBy(
        F.floor(place / F.lit(BLOCK_ROWS)).alias("b_copies")
    ).agg(F.collect_list(shown).alias("copies"))


def _compared(blocks: DataFrame, entries, width: int, buckets: int) -> DataFrame:
    """b and bits per bucket: which of the entries that a block sends are sent by another too.

    ``entries`` takes a row and returns a Block's (bucket, value, count, where).
    """
    def send(batches):
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                bucket, value, _, _ = entries(row)
                edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
                raw = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
                out = [
                    (int(bucket[a]), row["block"], raw[a:b].tobytes())
                    for a, b in zip(edges, [*edges[1:], len(bucket)])
                ]
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.binary()),
                    ], names=["bucket", "block", "entries"])

    def answer(batches):
        """Rows of a partition sorted by bucket: one bucket at a time is held and sorted."""
        key, held = None, []

        def settle():
            parts = []
            for _, raw in held:
                cells = np.zeros((len(raw) // width, 8), np.uint8)
                cells[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
                parts.append(cells.view("<u8")[:, 0])
            every = np.concatenate(parts)
            order = np.argsort(every, kind="stable")
            ranked = every[order]
            twice = np.zeros(len(every), bool)
            same = ranked[1:] == ranked[:-1]
            twice[order[1:]] |= same
            twice[order[:-1]] |= same
            at, blocks_out, bits = 0, [], []
            for (block, _), part in zip(held, parts):
                own = twice[at:at + len(part)]
                at += len(part)
                if own.any():
                    blocks_out.append(block)
                    bits.append(np.packbits(own).tobytes())
            return pa.RecordBatch.from_arrays([
                pa.array(blocks_out, pa.int64()),
                pa.array([key] * len(bits), pa.int32()), pa.array(bits, pa.binary()),
            ], names=["b", "bucket", "bits"])

        for batch in batches:
            for bucket, block, raw in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != key and held:
                    yield settle()
                    held.clear()
                key = bucket
                held.append((block, raw))
        if held:
            yield settle()

    sent = blocks.mapInArrow(send, "bucket int, block long, entries binary")
    dealt = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
    bits = dealt.mapInArrow(answer, "b long, bucket int, bits binary")
    return bits.groupBy("b").agg(F.collect_list(F.struct("bucket", "bits")).alias("found"))


def _results(length: int, buckets: int, cover: np.ndarray):
    def run(batches):
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                block = Block(row, length, buckets, cover)
                gone = block.removed()
                out: list[tuple] = []
                for i, start, size in zip(row["ids"], block.starts, block.sizes):
                    own = gone[start:start + size]
                    edges = np.flatnonzero(np.diff(np.r_[0, own.astype(np.int8), 0]))
                    spans = edges.reshape(-1, 2)
                    kept = block.bytes[start:start + size][~own].tobytes()
                    out.append((i, int(size), int(own.sum()), spans.ravel().tolist(), kept))
                columns = list(zip(*out))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["id", "n_bytes", "n_removed", "spans", "kept"],
                )

    return run


def remove_repeats(
    docs: DataFrame, by: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """Per row: id, n_bytes, n_removed, spans (start, end, start, end ... in bytes) and kept bytes."""
    if length <= 2 * MODULUS:
        raise ValueError(f"strings must be longer than {2 * MODULUS} bytes")
    spark = docs.sparkSession
    cover = difference_cover()
    blocks = _by_block(spark, _blocks(docs, by, text))
    total = blocks.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, math.ceil(2 * total / BUCKET_BYTES))

    def with_found(df: DataFrame, found: DataFrame, column: str) -> DataFrame:
        key = f"b_{column}"
        side = stored(found.toDF(key, column), column)
        return df.join(side, F.col("block") == F.col(key), "left").drop(key)

    state = with_found(blocks, _copies(blocks, length), "copies")
    columns = ["block", "sizes", "packed", "copies"]
    sampled = _compared(
        state.select(*columns), lambda r: Block(r, length, buckets, cover).sample(), 5, buckets
    )
    state = with_found(state, sampled, "sampled")
    tied = _compared(
        state.select(*columns, "sampled"),
        lambda r: Block(r, length, buckets, cover).ties()[1], 8, buckets,
    )
    state = with_found(state, tied, "tied")
    return state.mapInArrow(
        _results(length, buckets, cover),
        "id long, n_bytes long, n_removed long, spans array<long>, kept binary",
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: size, removed bytes and runs, and SHA-256 of what is kept."""
    return remove_repeats(docs).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed",
        F.floor(F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
