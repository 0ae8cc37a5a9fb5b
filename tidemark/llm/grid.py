"""A set of queries against all vectors, block by block.

Vectors are packed into blocks of bounded size. Query blocks are the rows of a grid and groups of
vector blocks its columns; every block is copied along its own line only, and one cell joins the
few blocks that meet there. So a block of thousands of queries shares one copy of each vector, and
no row of the join is a pair of single vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.arrow import named
from tidemark.llm.graph import stored

QUERIES_PER_BLOCK = 2048
VECTORS_PER_BLOCK = 2048
BLOCKS_PER_COLUMN = 16


def usable(embeddings: DataFrame, by: str, vector: str, scale: float = 1.0) -> DataFrame:
    """Stored (tag, id, dim, vec): rows with an id whose components are all finite.

    ``tag`` tells rows apart that share an id; ``vec`` is double. With ``scale`` every component
    becomes the floor of that multiple.
    """
    values = named(vector).cast("array<double>")
    if scale != 1.0:
        # floor() of a double is a bigint in Spark and would saturate; from 2^53 on doubles are whole.
        values = F.transform(values, lambda x: F.when(
            F.abs(x * scale) < 2.0 ** 53, F.floor(x * scale).cast("double")
        ).otherwise(x * scale))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(named(by).cast("long").alias("id"), values.alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(fine)
    return stored(rows.select(
        F.monotonically_increasing_id().alias("tag"), "id",
        F.size("vec").alias("dim"), "vec",
    ), "vectors")


def distinct_queries(rows: DataFrame) -> DataFrame:
    """One row per id: of several vectors the smallest."""
    return rows.groupBy("id").agg(F.min("vec").alias("vec")).select(
        "id", F.size("vec").alias("dim"), "vec"
    )


def pack(rows: DataFrame, keys: list[str], longs: list[str], size: int) -> DataFrame:
    """Blocks of at most ``size`` rows: keys, ``part``, each long column and ``vec`` as bytes.

    Rows are packed where they are; those that follow each other with equal keys share a block.
    """
    names = [*keys, "part", *longs, "vec"]
    schema = ", ".join(
        [*[f"{k} int" for k in keys], "part int", *[f"{c} binary" for c in longs], "vec binary"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        key: tuple = ()

        def block():
            columns = [np.array([h[i] for h in held], np.int64) for i in range(len(longs))]
            vecs = np.array([h[-1] for h in held], np.float64)
            return pa.RecordBatch.from_arrays([
                *[pa.array([k], pa.int32()) for k in (*key, part)],
                *[pa.array([c.tobytes()], pa.binary()) for c in columns],
                pa.array([vecs.tobytes()], pa.binary()),
            ], names=names)

        for batch in batches:
            lists = [c.to_pylist() for c in batch.columns]
            for row in zip(*lists):
                if held and (row[:len(keys)] != key or len(held) >= size):
                    yield block()
                    held = []
                key = row[:len(keys)]
                held.append(row[len(keys):])
        if held:
            yield block()

    return rows.select(*keys, *longs, "vec").mapInArrow(run, schema)


def unpack(data: bytes, dim: int) -> np.ndarray:
    """Vectors of a block, one per row."""
    flat = np.frombuffer(data, np.float64)
    return flat.reshape(-1, dim) if dim else flat.reshape(0, 0)


def columns_for(count: int, spark) -> int:
    per = VECTORS_PER_BLOCK * BLOCKS_PER_COLUMN
    return max(spark.sparkContext.defaultParallelism, math.ceil(count / per))


def lines_for(count: int) -> int:
    return max(1, math.ceil(count / QUERIES_PER_BLOCK))


def meet(
    queries: DataFrame, blocks: DataFrame, lines: int, columns: int, run: Callable, schema: str
) -> DataFrame:
    """Every query block with every vector block of its dimension, given to ``run`` as batches.

    Query blocks carry their line in ``part``. Names of query columns get a ``q_``.
    """
    q = queries.toDF(*[f"q_{c}" for c in queries.columns]).withColumn(
        "q_line", F.pmod(F.col("q_part"), F.lit(lines))
    ).withColumn("q_column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    hashed = F.pmod(F.xxhash64(*[c for c in blocks.columns if c != "vec"]), F.lit(columns))
    b = blocks.withColumn("column", hashed.cast("int")).withColumn(
        "line", F.explode(F.sequence(F.lit(0), F.lit(lines - 1)))
    )
    joined = b.join(q, (F.col("line") == F.col("q_line")) & (F.col("column") == F.col("q_column"))
                    & (F.col("dim") == F.col("q_dim")))
    return joined.mapInArrow(run, schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}


def id_matches(by: Column, divisor: int) -> Column:
    return F.pmod(by, F.lit(divisor)) == 0
