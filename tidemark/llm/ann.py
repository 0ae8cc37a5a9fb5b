"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors with three rounds of random signs and a fast Hadamard transform (length
padded to a power of two) and assigns each to the nearest signed axis. A query probes, in every
table, the ``probes`` axes nearest to its own rotation. All vectors of those buckets are candidates,
and their exact inner products on the original vectors decide.

Rows and probes meet by an equi-join on table and bucket: a row is sent once a table, a query once a
probe, so what moves grows with the rows. Both sides are packed into blocks inside each bucket. A
bucket of more than ``BLOCKS_PER_TASK`` vector blocks, whatever its share of all rows, is dealt out
over several tasks, and its queries go to each of them. The nearest of a query are kept per share of a bucket
and then over all. Tables, probes and the buckets' number do not depend on the size of the data; every
row is indexed.

Defined cases: rows without id and vectors that are NULL, zero or hold a NULL or non-finite
component take no part; vectors of another length than the query's are not its candidates; every
other row is a candidate of its own, repeated ids included, but for the query's own id; an id that
is a query several times asks once, with its smallest vector; extra columns are left out. An empty
table gives no rows; with fewer than k candidates found, all of them are returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import grid
from tidemark.llm.arrow import slices
from tidemark.llm.graph import stored

TABLES = 8
PROBES = 16
ROUNDS = 3
TILE = 512
BLOCKS_PER_TASK = 16  # vector blocks of one bucket that meet its queries in one task


def _signs(dim: int, tables: int, seed: int) -> np.ndarray:
    size = 1 << max(0, dim - 1).bit_length()
    rng = np.random.default_rng((seed, dim))
    return rng.choice(np.array([-1.0, 1.0]), (tables, ROUNDS, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row, in log2(length) steps."""
    n, size = x.shape
    h = 1
    while h < size:
        pairs = x.reshape(n, size // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        x = x.reshape(n, size)
        h *= 2
    return x / np.sqrt(size)


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows after one table's rotation; columns are the 2 x size signed axes."""
    peak = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(peak > 0, peak, 1)  # so that squares neither overflow nor vanish
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    padded = np.zeros((len(x), signs.shape[1]))
    padded[:, :x.shape[1]] = x
    for s in signs:
        padded = hadamard(padded * s)
    return np.concatenate([padded, -padded], axis=1)


def _hashed(rows: DataFrame, marks: list[str], tables: int, probes: int, seed: int) -> DataFrame:
    """Every row once per table and probe: dim, tbl, bucket, ``marks`` (longs) and vec."""
    names = ["dim", "tbl", "bucket", *marks, "vec"]

    def run(batches):
        for batch in slices(batches):
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = np.array(part.column(part.num_columns - 1).to_pylist(), np.float64).reshape(-1, dim)
                n = min(probes, 2 << max(0, int(dim) - 1).bit_length())
                for t, signs in enumerate(_signs(int(dim), tables, seed)):
                    axes = rotated(x, signs)
                    best = axes.argmax(axis=1)[:, None] if n == 1 else np.argpartition(
                        -axes, n - 1, axis=1
                    )[:, :n]
                    again = part.take(pa.array(np.repeat(np.arange(len(x)), n)))
                    yield pa.RecordBatch.from_arrays([
                        again.column(0), pa.array(np.full(len(x) * n, t, np.int32)),
                        pa.array(best.ravel().astype(np.int32)), *again.columns[1:],
                    ], names=names)

    fields = "dim int, tbl int, bucket int, " + "".join(f"{m} long, " for m in marks)
    return rows.select("dim", *marks, "vec").mapInArrow(run, f"{fields}vec array<double>")


def _dealt(hashed: DataFrame, marks: list[str], count: int) -> DataFrame:
    """Blocks of rows that share a bucket; a large bucket's rows are packed in many tasks."""
    columns = grid.columns_for(count, hashed.sparkSession)
    split = math.ceil(columns / 64)  # about a block each, whatever the number of rows
    near = hashed.repartition(
        columns, "dim", "tbl", "bucket", F.pmod(F.xxhash64(*marks), F.lit(split))
    ).sortWithinPartitions("dim", "tbl", "bucket")
    return grid.pack(near, ["dim", "tbl", "bucket"], marks, grid.VECTORS_PER_BLOCK)


def _nearest(k: int):
    """The k nearest of every query of a block, over the vector blocks it meets one after the other."""
    def run(batches):
        key, held = None, []

        def settled():
            ids, tags, mine, scores = (np.concatenate(c) for c in zip(*held))
            by = np.lexsort((mine, -scores, ids))
            by = by[np.arange(len(by)) - np.searchsorted(ids[by], ids[by]) < k]
            return ids[by], tags[by], mine[by], scores[by]

        def out():
            ids, tags, mine, scores = settled()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(mine), pa.array(tags), pa.array(scores)],
                names=["query_id", "vec_id", "tag", "score"],
            )

        for row in grid.rows_of(batches):
            mark = (row["tbl"], row["bucket"], row["q_id"])
            if mark != key:
                if held:
                    yield out()
                key, held = mark, []
            dim = row["dim"]
            q, x = grid.unpack(row["q_vec"], dim), grid.unpack(row["vec"], dim)
            ids, mine, tags = (np.frombuffer(row[c], np.int64) for c in ("q_id", "id", "tag"))
            for a in range(0, len(ids), TILE):
                part, own = q[a:a + TILE], ids[a:a + TILE]
                scores = part @ x.T
                scores[own[:, None] == mine[None, :]] = -np.inf
                # A matrix product may round equal vectors differently: take all that could be
                # among the k best and score them one by one.
                least = np.full(len(own), -np.inf)
                if scores.shape[1] > k:
                    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
                slack = 1e-12 * np.linalg.norm(part, axis=1) * np.linalg.norm(x, axis=1).max()
                r, c = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
                exact = (part[r] * x[c]).sum(axis=1)
                by = np.lexsort((mine[c], -exact, r))
                r, c, exact = r[by], c[by], exact[by]
                best = np.arange(len(r)) - np.searchsorted(r, r) < k
                r, c, exact = r[best], c[best], exact[best]
                if len(r):
                    held.append((own[r], tags[c], mine[c], exact))
            if len(held) > 64:
                held = [settled()]
        if held:
            yield out()

    return run


def search(
    embeddings: DataFrame, divisor: int, k: int, by: str = "vec_id", vector: str = "embedding",
    tables: int = TABLES, probes: int = PROBES, seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score for every id divisible by ``divisor``."""
    rows = grid.usable(embeddings, by, vector)
    rows = rows.where(F.exists("vec", lambda x: x != 0))
    queries = stored(
        grid.distinct_queries(rows.where(grid.id_matches(F.col("id"), divisor))), "queries"
    )
    blocks = _dealt(_hashed(rows, ["tag", "id"], tables, 1, seed), ["tag", "id"], rows.count() * tables)
    blocks = stored(blocks.withColumn("mark", F.monotonically_increasing_id()), "buckets")
    # Blocks in a bucket, and with them its share of tasks: tables x axes rows at most per length.
    bucket = ["dim", "tbl", "bucket"]
    shares = stored(blocks.groupBy(*bucket).agg(
        F.ceil(F.count("*") / BLOCKS_PER_TASK).cast("int").alias("shares")
    ), "shares")
    probed = _dealt(_hashed(queries, ["id"], tables, probes, seed), ["id"], queries.count() * tables * probes)
    probed = stored(probed, "probes").join(shares, bucket).select(
        *bucket, F.col("id").alias("q_id"), F.col("vec").alias("q_vec"),
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
    )
    entries = blocks.join(shares, bucket).select(
        *bucket, "tag", "id", "vec", F.pmod(F.xxhash64("mark"), F.col("shares")).cast("int").alias("share")
    )
    # Query blocks lead, so that each meets the vector blocks of its share in one go.
    met = probed.join(entries, [*bucket, "share"]).select(
        *bucket, "tag", "id", "vec", "q_id", "q_vec"
    )
    found = met.mapInArrow(_nearest(k), "query_id long, vec_id long, tag long, score double")
    # A vector met in several tables has the same score each time.
    once = found.dropDuplicates(["query_id", "tag"])
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k
    ).select("query_id", "rank", "vec_id", "score")
