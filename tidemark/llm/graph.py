"""Connected components by star contraction, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.sources.shared import discard, fresh_path


SALTS = 64


def _stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends, lost executors cost nothing."""
    return _stored_at(df, name)[0]


def _hung(edges: DataFrame, node: str, near: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Per node its smallest neighbour, as ``out``; and the edges, each with that of its node.

    A node's edges are spread over ``SALTS`` groups by their other end, and the smallest neighbour
    follows them into the groups that exist: a node with very many edges never meets them in one task.
    Sides that look small are not broadcast, since every round would leave its copies with the driver.
    """
    spread = edges.withColumn("_salt", F.pmod(F.xxhash64(near), F.lit(SALTS)))
    groups = spread.groupBy(node, "_salt").agg(F.min(near).alias("_m"))
    least = groups.groupBy(node).agg(F.min("_m").alias(out))
    known = groups.select(node, "_salt").join(least.hint("merge"), node)
    return least, spread.join(known.hint("merge"), [node, "_salt"]).select(node, near, out)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every end of the edges (two long columns, in any order).

    ``root`` is the smallest node of the component. Each round hangs every node's larger
    neighbours, then its smaller ones, on the smallest; only minima are aggregated and joined back.
    Rounds grow with the logarithm of a component's length and end when one changes no edge. A
    round's table goes when the next one is written. Empty input gives no rows; NULL ends are ignored.
    """
    a, b = edges.columns
    start = edges.select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
    current, path = _stored_at(start.distinct(), "edges")
    count = current.count()
    while True:
        both = current.select(F.col("hi").alias("node"), F.col("lo").alias("near")).union(
            current.select("lo", "hi")
        )
        _, met = _hung(both, "node", "near", "m")
        large = met.where(F.col("near") > F.col("node")).select(
            F.col("near").alias("hi"), F.least("node", "m").alias("lo")
        ).distinct()
        least, met = _hung(large, "hi", "lo", "m")
        small = met.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(
            least.select("hi", "m")
        ).where(F.col("hi") != F.col("lo"))
        following, new_path = _stored_at(small.distinct(), "edges")
        new_count = following.count()
        same = new_count == count and following.join(current.hint("merge"), ["hi", "lo"], "left_anti").isEmpty()
        discard([path])
        current, path, count = following, new_path, new_count
        if same:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                current.select("lo", "lo").distinct()
            )
