"""Exact top-k search by distributed histogram selection.

Scores of all (query, vector) pairs are computed block by block and never stored. Each round
counts them per query in ``BINS`` bins over the query's current interval, sums the counts, and
narrows the interval to the bin that holds the k-th largest score, until the interval is a single
score or so few scores lie at or above its lower end that they can be listed. A last pass lists the
scores at or above that end (of one block never more than k, which a block's own order settles
exactly) and ranks them, ties to the smaller id.

Scores are integers: components are floor(256 * x), and products are summed exactly, in doubles
while the Cauchy-Schwarz bound stays below 2^53 and in Python integers beyond. A score that a long
cannot hold counts, and is returned, as the long range's end (+-(2^63 - 2)).

Defined cases: rows without id and vectors that are NULL or hold a NULL or non-finite component
(before or after scaling) take no part; vectors of another length than the query's are not its
candidates; every other row is a candidate of its own, repeated ids included, but for the query's
own id; an id that is a query several times asks once, with its smallest vector. With fewer than k
candidates all are returned; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import grid
from tidemark.llm.graph import stored

SCALE = 256.0
BINS = 128
LISTED = 4  # times k: so many scores at or above the lower end are few enough to list
TILE = 512
EDGE = (1 << 63) - 2


def _scores(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as long; ``exact`` tells that doubles hold every partial sum."""
    if exact:
        return (q @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q) @ whole(x).T, -EDGE, EDGE).astype(np.int64)


def _tiles(row: dict, exact: bool):
    """(first query, scores, own): scores of up to TILE queries; ``own`` marks equal ids."""
    q, x = grid.unpack(row["q_vec"], row["q_dim"]), grid.unpack(row["vec"], row["dim"])
    ids, mine = np.frombuffer(row["q_id"], np.int64), np.frombuffer(row["id"], np.int64)
    for a in range(0, len(q), TILE):
        scores = _scores(q[a:a + TILE], x, exact)
        yield a, scores, ids[a:a + TILE, None] == mine[None, :]


def _histogram(exact: bool):
    def run(batches):
        key, counts, ids = None, None, None

        def sums():
            at, bins = np.nonzero(counts)
            return pa.RecordBatch.from_arrays([
                pa.array(ids[at]), pa.array(bins.astype(np.int32)), pa.array(counts[at, bins]),
            ], names=["id", "bin", "n"])

        for row in grid.rows_of(batches):
            if row["q_id"] != key:
                if key is not None:
                    yield sums()
                key, ids = row["q_id"], np.frombuffer(row["q_id"], np.int64)
                counts = np.zeros((len(ids), BINS), np.int64)
            lo, hi = (np.frombuffer(row[f"q_{c}"], np.int64) for c in ("lo", "hi"))
            # Intervals may be wider than a long, but not than an unsigned one.
            width = (hi.view(np.uint64) - lo.view(np.uint64) + np.uint64(BINS - 1)) // np.uint64(BINS)
            for a, scores, own in _tiles(row, exact):
                n = len(scores)
                low, high, w = (v[a:a + n, None] for v in (lo, hi, width))
                inside = (scores >= low) & (scores < high) & ~own
                at = np.nonzero(inside)[0]
                above = scores.view(np.uint64) - low.view(np.uint64)
                bins = (above // w)[inside].astype(np.int64)
                counts[a:a + n] += np.bincount(
                    at * BINS + bins, minlength=n * BINS
                ).reshape(n, BINS)
        if key is not None:
            yield sums()

    return run


def _listing(exact: bool, k: int):
    def run(batches):
        for row in grid.rows_of(batches):
            ids, mine = np.frombuffer(row["q_id"], np.int64), np.frombuffer(row["id"], np.int64)
            lo = np.frombuffer(row["q_lo"], np.int64)
            for a, scores, own in _tiles(row, exact):
                n = len(scores)
                at, col = np.nonzero((scores >= lo[a:a + n, None]) & ~own)
                found = scores[at, col]
                by = np.lexsort((mine[col], -found, at))
                at, col, found = at[by], col[by], found[by]
                place = np.arange(len(at)) - np.searchsorted(at, at)
                best = place < k
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[a:a + n][at[best]]), pa.array(mine[col[best]]),
                    pa.array(found[best]),
                ], names=["query_id", "vec_id", "score"])

    return run


def search(
    embeddings: DataFrame, divisor: int, k: int, by: str = "vec_id", vector: str = "embedding",
    scale: float = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id, score for every id divisible by ``divisor``."""
    spark = embeddings.sparkSession
    rows = grid.usable(embeddings, by, vector, scale)
    queries = stored(
        grid.distinct_queries(rows.where(grid.id_matches(F.col("id"), divisor))), "queries"
    )
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    about = rows.agg(F.count("*").alias("n"), F.max(norm).alias("m")).first()
    asked = queries.agg(F.count("*").alias("n"), F.max(norm).alias("m")).first()
    most = (about["m"] or 0.0) * (asked["m"] or 0.0) * (1 + 1e-9) + 1
    bound = int(most) if most < EDGE else EDGE  # also where a norm overflows
    exact = bound < 2 ** 53
    lines, columns = grid.lines_for(asked["n"]), grid.columns_for(about["n"], spark)
    blocks = stored(
        grid.pack(rows.sortWithinPartitions("dim"), ["dim"], ["id"], grid.VECTORS_PER_BLOCK),
        "blocks",
    )

    def met(state: DataFrame, run, schema: str) -> DataFrame:
        dealt = state.repartition(lines, "id").sortWithinPartitions("dim", "id")
        packed = grid.pack(dealt, ["dim"], ["id", "lo", "hi"], grid.QUERIES_PER_BLOCK)
        return grid.meet(packed, blocks, lines, columns, run, schema)

    # The k-th largest score lies in [lo, hi); ``above`` scores are hi or more.
    state = queries.select(
        "*", F.lit(-bound - 1).cast("long").alias("lo"), F.lit(bound + 1).cast("long").alias("hi"),
        F.lit(0).cast("long").alias("above"), F.lit(False).alias("done"),
    )
    from_top = Window.partitionBy("id").orderBy(F.col("bin").desc())
    while True:
        counts = met(
            state.where("not done"), _histogram(exact), "id long, bin int, n long"
        ).groupBy("id", "bin").agg(F.sum("n").alias("n"))
        sums = counts.withColumn("over", F.sum("n").over(from_top))
        # The first bin from above that reaches k; none if there are fewer candidates.
        known = state.select(F.col("id").alias("i"), F.col("above").alias("so_far"))
        at = sums.join(known, F.col("id") == F.col("i")).where(
            F.col("so_far") + F.col("over") >= k
        ).groupBy("i").agg(
            F.max("bin").alias("bin"), F.min("over").alias("over"),
            F.min_by("n", "over").alias("n"),
        )
        state = state.join(at, F.col("id") == F.col("i"), "left")
        # As in _histogram; decimals, since the interval may be wider than a long.
        lo, hi = (F.col(c).cast("decimal(20,0)") for c in ("lo", "hi"))
        width = F.floor((hi - lo + (BINS - 1)) / BINS).cast("decimal(20,0)")
        low = lo + F.col("bin") * width
        narrow = ~F.col("done") & F.col("bin").isNotNull()
        found = F.col("above") + F.col("over")
        state = stored(state.select(
            "id", "dim", "vec",
            F.when(narrow, low.cast("long")).otherwise(F.col("lo")).alias("lo"),
            F.when(narrow, F.least(low + width, hi).cast("long")).otherwise(F.col("hi")).alias("hi"),
            F.when(narrow, found - F.col("n")).otherwise(F.col("above")).alias("above"),
            (F.col("done") | F.col("bin").isNull() | (width == 1)
             | (found <= LISTED * k)).alias("done"),
        ), "intervals")
        if state.where("not done").isEmpty():
            break
    listed = met(state, _listing(exact, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return listed.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k
    ).select("query_id", "rank", "vec_id", "score")
