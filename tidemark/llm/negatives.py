"""Hard-negative mining with scores from a residue-number-system matrix product.

Vectors are scaled to whole numbers. Their inner products are computed as float32 matrix products
of the components' remainders, once for each of a few small primes: a remainder is at most half its
prime, so with few enough columns at a time every partial sum stays below 2^24 and float32 is exact.
The remainders of the products are put together by Chinese remaindering in mixed radix. As many
primes are taken as the Cauchy-Schwarz bound of all scores needs, so the signed scores are exact.

Anchor blocks meet vector blocks (see ``grid``). A first meeting lists every anchor's best rows of
its own label; their scores make windows, which ride on the anchors through a second meeting that
lists the best rows of other labels inside each window. A task merges what one anchor block finds
in all its vector blocks before it hands anything on, so a label may have any share of all rows.

Defined cases: rows without id or label and vectors that are NULL or empty or hold a NULL or
non-finite component (before or after scaling) take no part; vectors of another length than the anchor's are
not its candidates; an id that is an anchor several times is one anchor, with its smallest vector,
then label; rows that share the anchor's id are not "other" rows; all other repeated rows are
candidates of their own. Anchors without positives, and positives whose window is empty, have no
rows. Scores that a long cannot hold count as its range's end (+-(2^63 - 2)). An empty table gives
no rows; extra columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm import grid
from tidemark.llm.arrow import named
from tidemark.llm.graph import stored

SCALE = 256.0
EDGE = (1 << 63) - 2
NONE = -(1 << 63)
TILE = 512


def primes_for(bound: int) -> list[int]:
    """Primes whose product exceeds 2 * bound + 1: from 251 downwards, then from 257 on."""
    sieve = np.ones(4096, bool)
    sieve[:2] = False
    for i in range(2, 64):
        sieve[i * i::i] &= not sieve[i]
    found = [int(p) for p in np.flatnonzero(sieve) if p > 2]
    chosen: list[int] = []
    product = 1
    for p in [*[p for p in reversed(found) if p < 256], *[p for p in found if p > 256]]:
        if product > 2 * bound + 1:
            break
        chosen.append(p)
        product *= p
    if product <= 2 * bound + 1:
        raise OverflowError("scores too large for the primes at hand")
    return chosen


def remainders(x: np.ndarray, p: int) -> np.ndarray:
    """Whole doubles modulo p as float32 between -p/2 and p/2."""
    r = np.fmod(x, p)
    r -= p * np.rint(r / p)
    return r.astype(np.float32)


def product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, for remainders a and b; every float32 sum stays below 2^24."""
    width = max(1, (2 ** 24 - 1) // (p // 2) ** 2)
    total = None
    for at in range(0, max(1, a.shape[1]), width):
        part = (a[:, at:at + width] @ b[:, at:at + width].T).astype(np.int32) % p
        total = part if total is None else (total + part) % p
    return total


class Products:
    """Exact inner products of two sets of vectors, whose remainders are computed once."""

    def __init__(self, primes: list[int], exact: bool):
        self.primes, self.exact = primes, exact  # exact: a long holds every score

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        return [remainders(x, p) for p in self.primes]

    def scores(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Mixed-radix digits between -p/2 and p/2 make the one signed number within the bound.

        Sums of longs may wrap on the way; the result fits, so it is right.
        """
        digits: list[np.ndarray] = []
        for i, p in enumerate(self.primes):
            digit = product_mod(a[i], b[i], p)
            for q, d in zip(self.primes, digits):
                digit = (digit - d) * pow(q, -1, p) % p
            digits.append(np.where(digit > p // 2, digit - p, digit))
        kind = np.int64 if self.exact else object
        value, weight = np.zeros(digits[0].shape, kind), 1
        for p, d in zip(self.primes, digits):
            if self.exact:
                with np.errstate(over="ignore"):
                    value += d.astype(np.int64) * np.uint64(weight % 2 ** 64).astype(np.int64)
            else:
                value += d.astype(object) * weight
            weight *= p
        return value if self.exact else np.clip(value, -EDGE, EDGE).astype(np.int64)


def _best(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each anchor's k best entries: higher scores first, ties to the smaller id."""
    by = np.lexsort((ids, -scores, at))
    first = at[by]
    return by[np.arange(len(by)) - np.searchsorted(first, first) < k]


def _pick(wanted: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """Entries of a tile that may be among the k best of their row."""
    masked = np.where(wanted, scores, NONE)
    if masked.shape[1] > k:
        least = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        wanted = wanted & (masked >= least[:, None])
    at, col = np.nonzero(wanted)
    found, mine = scores[at, col], ids[col]
    top = _best(at, found, mine, k)
    return at[top], mine[top], found[top]


def _longs(row: dict, name: str) -> np.ndarray:
    return np.frombuffer(row[name], np.int64)


def _meeting(products: Products, tile, keep: int):
    """Runs ``tile`` on all pairs of tiles and merges one anchor block's entries.

    ``tile`` gives (slot, anchor's place, id, score) arrays; of each (anchor, slot) the ``keep``
    best entries remain.
    """
    def run(batches):
        key, ids, held = None, None, []

        def merged():
            slot, at, mine, found = (np.concatenate(c) for c in zip(*held))
            group = at * 64 + slot
            top = _best(group, found, mine, keep)
            return slot[top], at[top], mine[top], found[top]

        def out():
            slot, at, mine, found = merged()
            return pa.RecordBatch.from_arrays([
                pa.array(ids[at]), pa.array(slot.astype(np.int32)), pa.array(mine), pa.array(found),
            ], names=["anchor", "slot", "id", "score"])

        for row in grid.rows_of(batches):
            mark = (row["q_part"], row["q_dim"], row["q_id"])
            if mark != key:
                if held:
                    yield out()
                key, ids, held = mark, _longs(row, "q_id"), []
            q, x = grid.unpack(row["q_vec"], row["q_dim"]), grid.unpack(row["vec"], row["dim"])
            right = products.split(x)
            for a in range(0, len(q), TILE):
                scores = products.scores(products.split(q[a:a + TILE]), right)
                for slot, at, mine, found in tile(row, slice(a, a + TILE), scores):
                    if len(at):
                        held.append((np.full(len(at), slot), at + a, mine, found))
            if len(held) > 64:
                held = [merged()]
        if held:
            yield out()

    return run


def _positives(k: int):
    def tile(row, part, scores):
        ids, label = _longs(row, "id"), _longs(row, "label")
        same = _longs(row, "q_label")[part, None] == label[None, :]
        same &= _longs(row, "q_id")[part, None] != ids[None, :]
        yield 0, *_pick(same, scores, ids, k)

    return tile


def _windows(slots: int, k: int):
    def tile(row, part, scores):
        ids, label = _longs(row, "id"), _longs(row, "label")
        low = np.stack([_longs(row, f"q_lo{s}")[part] for s in range(slots)], axis=1)
        high = np.stack([_longs(row, f"q_hi{s}")[part] for s in range(slots)], axis=1)
        other = _longs(row, "q_label")[part, None] != label[None, :]
        other &= _longs(row, "q_id")[part, None] != ids[None, :]
        other &= (scores >= low.min(axis=1)[:, None]) & (scores <= high.max(axis=1)[:, None])
        at, col = np.nonzero(other)
        found, mine = scores[at, col], ids[col]
        by = np.lexsort((mine, -found, at))
        at, found, mine = at[by], found[by], mine[by]
        for s in range(slots):
            inside = (found >= low[at, s]) & (found <= high[at, s])
            a, f, m = at[inside], found[inside], mine[inside]
            first = np.arange(len(a)) - np.searchsorted(a, a) < k
            yield s, a[first], m[first], f[first]

    return tile


def labelled(
    embeddings: DataFrame, by: str, vector: str, label: Column, scale: float
) -> DataFrame:
    """Stored (id, label, dim, vec) of the rows that take part; components are whole doubles."""
    values = F.transform(named(vector).cast("array<double>"), lambda c: F.when(
        F.abs(c * scale) < 2.0 ** 53, F.floor(c * scale).cast("double")
    ).otherwise(c * scale))
    fine = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.select(
        named(by).cast("long").alias("id"), label.cast("long").alias("label"), values.alias("vec")
    ).where("id is not null and label is not null and size(vec) > 0").where(fine)
    return stored(rows.select("id", "label", F.size("vec").alias("dim"), "vec"), "labelled")


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    embeddings: DataFrame, divisor: int = 50, positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95, by: str = "vec_id", vector: str = "embedding",
    label: Column | str = "label", scale: float = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the ids divisible by ``divisor``; a negative's score lies between ``low`` and
    ``high`` percent of the positive's. ``label`` may be any expression over the table. At most 64
    positives an anchor.
    """
    if not 0 < positives <= 64:
        raise ValueError("between 1 and 64 positives")
    spark = embeddings.sparkSession
    label = named(label) if isinstance(label, str) else label
    rows = labelled(embeddings, by, vector, label, scale)
    anchors = stored(rows.where(grid.id_matches(F.col("id"), divisor)).groupBy("id").agg(
        F.min(F.struct("vec", "label")).alias("a")
    ).select("id", F.col("a.label").alias("label"), F.size("a.vec").alias("dim"), "a.vec"), "anchors")

    # A bound on every score, without squares that overflow: dimension times the largest components.
    peak = F.coalesce(F.array_max(F.transform("vec", lambda c: F.abs(c))), F.lit(0.0))
    about = rows.agg(F.count("*").alias("n"), F.max(peak).alias("m"), F.max("dim").alias("d")).first()
    asked = anchors.agg(F.count("*").alias("n"), F.max(peak).alias("m")).first()
    bound = int(about["m"] or 0) * int(asked["m"] or 0) * (about["d"] or 0)
    if bound < 1 << 100:  # the squares are safe: Cauchy-Schwarz is tighter
        norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, c: s + c * c))
        longest = [t.agg(F.max(norm)).first()[0] or 0.0 for t in (rows, anchors)]
        bound = min(bound, math.ceil(longest[0] * longest[1] * (1 + 1e-9)) + 1)
    products = Products(primes_for(bound), bound < EDGE)

    lines, columns = grid.lines_for(asked["n"]), grid.columns_for(about["n"], spark)
    blocks = stored(grid.pack(
        rows.sortWithinPartitions("dim"), ["dim"], ["id", "label"], grid.VECTORS_PER_BLOCK
    ), "blocks")

    def met(state: DataFrame, longs: list[str], tile, keep: int) -> DataFrame:
        dealt = state.repartition(lines, "id").sortWithinPartitions("dim", "id")
        packed = grid.pack(dealt, ["dim"], ["id", "label", *longs], grid.QUERIES_PER_BLOCK)
        return _ranked(grid.meet(
            packed, blocks, lines, columns, _meeting(products, tile, keep),
            "anchor long, slot int, id long, score long",
        ), keep)

    best = stored(met(anchors, [], _positives(positives), positives).select(
        "anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive"),
        F.col("score").alias("p"),
    ), "positives")
    # Whole numbers: low * p <= 100 * s <= high * p, without overflow.
    p = F.col("p").cast("decimal(25,0)")
    edges = best.where("p >= 0").select(
        "anchor", "slot", F.ceil(p * low / 100).cast("long").alias("lo"),
        F.floor(p * high / 100).cast("long").alias("hi"),
    ).groupBy("anchor").agg(*[
        F.coalesce(F.max(F.when(F.col("slot") == s, F.col(c))), F.lit(missing)).alias(f"{c}{s}")
        for s in range(positives) for c, missing in (("lo", 1), ("hi", 0))
    ])
    longs = [f"{c}{s}" for s in range(positives) for c in ("lo", "hi")]
    state = anchors.join(edges, F.col("id") == F.col("anchor")).select("id", "label", "dim", "vec", *longs)
    found = met(stored(state, "windows"), longs, _windows(positives, negatives), negatives)
    return found.join(best, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), F.col("p").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def relabelled(by: str = "vec_id", label: str = "label") -> Column:
    """The label, moved on by one of ten where the id is divisible by 7."""
    value = named(label).cast("long")
    return F.when(named(by) % 7 == 0, (value + 1) % 10).otherwise(value)


def report(embeddings: DataFrame) -> DataFrame:
    return mine(embeddings, label=relabelled())
