"""Whitening of embeddings by Jacobi-Davidson over matrix-free covariance products.

The covariance V of the fit list (every distinct rounded vector once) is never formed. One product
V W is a pass over the stored fit list: each task centres its vectors, multiplies them with the few
columns of W and back, and the tasks' sums of shape (dimension, columns) are added by a grouped
aggregation. Only such sums reach the driver, so what it holds depends on the dimension alone.

The driver keeps a search space of at most ``BASIS`` columns. Each turn does Rayleigh-Ritz on it,
locks every wanted pair whose residual is down to double precision, and widens the space by the
corrections t of the others: (I - QQ')(V - theta)(I - QQ') t = -r with Q the locked vectors and the
Ritz vector itself. These equations are solved by MINRES, all of them in step, so that one pass
over the data serves one step of them all. Spaces that grow too wide restart from the best Ritz
vectors. A last pass multiplies with the locked vectors themselves and settles values and residuals.

Rounded vectors are whole numbers, so sums and ``n * x - S`` are exact; centring subtracts the whole
part of the mean first and keeps full precision whatever the vectors' offset.

Defined cases: rows whose vector is NULL or empty, or holds a NULL or non-finite entry or one of
2^53 or more after scaling, take no part, nor do vectors of another length than the commonest one
(of equally common ones the longest). Rows with NULL ids and repeated rows are returned like others;
repeated vectors count once in the fit. Directions without variance are no components, so equal
vectors alone, or an empty table, give no rows. A ``deviation`` beyond a long is NULL. Extra columns
are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrow import named, slices
from tidemark.llm.graph import stored

SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 16
SPARE = 4  # further columns carried along, so that the last wanted pairs converge as fast
BASIS = 96  # columns of the search space before it restarts
INNER = 6  # steps of MINRES at most
TURNS = 300
EXACT = 1e-13  # residuals, relative to the largest eigenvalue
FLOOR = 1e-11  # residuals that no longer shrink count as rounding below this
ROWS = 4096
WIDEST = float(2 ** 53)


@dataclass(frozen=True)
class Whitening:
    """Mean, components (columns, falling eigenvalue) and what they were fitted on."""

    n: int
    sums: tuple[int, ...]  # of the whole-number vectors without OFFSET
    values: np.ndarray
    components: np.ndarray
    trace: float
    residual: float  # largest, relative to the largest eigenvalue
    passes: int
    identity_error: float = 0.0

    @property
    def dim(self) -> int:
        return len(self.sums)


def rounded(embeddings: DataFrame, keep: list[str], vector: str, scale: float) -> DataFrame:
    """Stored: ``keep`` and ``y``, the floor of the scaled vector (long), of rows that take part."""
    values = F.transform(named(vector).cast("array<double>"), lambda c: c * scale)
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < WIDEST))
    rows = embeddings.select(*[named(c).alias(f"k{i}") for i, c in enumerate(keep)], values.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(fine)
    rows = stored(rows.select(
        *[f"k{i}" for i in range(len(keep))], F.transform("v", lambda c: F.floor(c)).alias("y")
    ), "rounded")
    lengths = rows.groupBy(F.size("y").alias("size")).count()
    common = lengths.orderBy(F.col("count").desc(), F.col("size").desc()).first()
    return rows.where(F.size("y") == (common["size"] if common else 0))


class _Fit:
    """The stored fit list, and sums over it of small matrices computed batch by batch."""

    def __init__(self, rows: DataFrame):
        self.rows = stored(rows.select("y").distinct(), "fit")
        about = self.rows.agg(F.count("*").alias("n"), F.max(F.size("y")).alias("dim")).first()
        self.n, self.dim = about["n"], about["dim"] or 0
        self.passes = 0
        if self.n:
            whole = self._sums()
            self.sums = tuple(int(v) for v in whole)
            self.base = np.array([s // self.n for s in self.sums], np.int64)
            self.rest = np.array([
                (s - self.n * int(b)) / self.n for s, b in zip(self.sums, self.base)
            ])

    def _sums(self) -> list[int]:
        dim = self.dim

        def run(batches):
            total = [0] * dim
            for batch in slices(batches, ROWS):
                y = _matrix(batch.column(0), dim)
                peak = int(np.abs(y).max(initial=0))
                part = y.sum(axis=0) if peak < 2 ** 62 // ROWS else y.astype(object).sum(axis=0)
                total = [a + int(b) for a, b in zip(total, part)]
            yield pa.RecordBatch.from_arrays([
                pa.array(range(dim), pa.int32()),
                pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)),
            ], names=["i", "s"])

        parts = self.rows.mapInArrow(run, "i int, s decimal(38,0)")
        return [r["s"] for r in parts.groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()]

    def total(self, make: Callable[[np.ndarray], np.ndarray], height: int, width: int) -> np.ndarray:
        """Sum over the fit list of ``make(centred rows)``, matrices of this shape."""
        dim, base, rest = self.dim, self.base, self.rest
        self.passes += 1

        def run(batches):
            sums = np.zeros((height, width))
            for batch in slices(batches, ROWS):
                sums += make((_matrix(batch.column(0), dim) - base) - rest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(height), pa.int32()), *[pa.array(c) for c in sums.T]],
                names=["i", *[f"c{j}" for j in range(width)]],
            )

        columns = [f"c{j}" for j in range(width)]
        parts = self.rows.mapInArrow(run, ", ".join(["i int", *[f"{c} double" for c in columns]]))
        out = np.zeros((height, width))
        for row in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in columns]).collect():
            out[row["i"]] = row[1:]
        return out

    def product(self, columns: np.ndarray, width: int) -> np.ndarray:
        """V times the columns, padded to ``width`` so that every pass has the same plan."""
        out = []
        for at in range(0, columns.shape[1], width):
            part = columns[:, at:at + width]
            full = np.zeros((self.dim, width))
            full[:, :part.shape[1]] = part
            found = self.total(lambda d: d.T @ (d @ full), self.dim, width) / self.n
            out.append(found[:, :part.shape[1]])
        return np.concatenate(out, axis=1) if out else np.zeros((self.dim, 0))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """The part of ``new`` outside the bases, as orthonormal columns; dependent ones vanish."""
    kept: list[np.ndarray] = []
    for column in new.T:
        size = np.linalg.norm(column)
        if not size or not np.isfinite(size):
            continue
        column = column / size
        for _ in range(3):
            for basis in bases:
                column = column - basis @ (basis.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            size = np.linalg.norm(column)
            if size < 1e-8:
                break
            column = column / size
        else:
            kept.append(column)
    return np.array(kept).T if kept else np.zeros((len(new), 0))


def corrections(
    product: Callable[[np.ndarray], np.ndarray], theta: np.ndarray, ritz: np.ndarray,
    residuals: np.ndarray, locked: np.ndarray, steps: int, least: float,
) -> np.ndarray:
    """MINRES on every pair's projected correction equation, in step: one product a step.

    A column stops when its equation's residual has fallen by ``least``.
    """
    def outside(x, at):
        for _ in range(2):
            x = x - locked @ (locked.T @ x)
            x = x - ritz[:, at] * (ritz[:, at] * x).sum(axis=0)
        return x

    count = ritz.shape[1]
    everything = np.arange(count)
    right = outside(-residuals, everything)
    solution = np.zeros_like(right)
    first = np.linalg.norm(right, axis=0)
    left = first.copy()
    v, v_old = right / np.where(first > 0, first, 1), np.zeros_like(right)
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    beta = np.zeros(count)
    cos, cos_old, sin, sin_old = np.ones(count), np.ones(count), np.zeros(count), np.zeros(count)
    at = everything[first > 0]
    for _ in range(steps):
        if not len(at):
            break
        p = outside(product(v[:, at]) - theta[at] * v[:, at], at)
        alpha = (v[:, at] * p).sum(axis=0)
        p = outside(p - alpha * v[:, at] - beta[at] * v_old[:, at], at)
        following = np.linalg.norm(p, axis=0)
        delta = cos[at] * alpha - cos_old[at] * sin[at] * beta[at]
        rho1 = np.hypot(delta, following)
        rho2 = sin[at] * alpha + cos_old[at] * cos[at] * beta[at]
        rho3 = sin_old[at] * beta[at]
        alive = rho1 > 1e-14 * np.maximum(np.abs(theta[at]), 1e-300)
        safe = np.where(alive, rho1, 1.0)
        cos_old[at], sin_old[at] = cos[at], sin[at]
        cos[at], sin[at] = delta / safe, following / safe
        step = (v[:, at] - rho3 * w_old[:, at] - rho2 * w[:, at]) / safe
        solution[:, at] += np.where(alive, cos[at] * left[at], 0.0) * step
        left[at] = np.where(alive, -sin[at] * left[at], left[at])
        w_old[:, at], w[:, at] = w[:, at], step
        v_old[:, at] = v[:, at]
        v[:, at] = p / np.where(following > 0, following, 1)
        beta[at] = following
        going = alive & (np.abs(left[at]) > least * first[at])
        going &= following > 1e-14 * np.maximum(np.abs(theta[at]), 1e-300)
        at = at[going]
    return solution


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], dim: int, count: int, scale: float, seed: int = 1,
    basis: int = BASIS, inner: int = INNER,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues (falling) and their vectors of a symmetric operator.

    ``scale`` bounds the largest eigenvalue; ``product`` is called with a few columns at a time.
    """
    rng = np.random.default_rng(seed)
    count = min(count, dim)
    block = min(dim, count + SPARE)
    basis = max(basis, 2 * block + count)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    space = _orthonormal(rng.standard_normal((dim, block)))
    image = product(space)
    best, stale = np.inf, 0
    for turn in range(TURNS):
        small = space.T @ image
        theta, s = np.linalg.eigh((small + small.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        space, image = space @ s, image @ s
        top = max([scale * 1e-300, *values, *theta[:1]])
        residuals = image - space * theta
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        # Wanted: the pairs still missing, and any that outdo a locked one.
        missing = count - len(values)
        least = np.sort(values)[-count] if missing <= 0 else -np.inf
        wanted = np.arange(len(theta)) < missing if missing > 0 else theta > least + FLOOR * top
        if not wanted.any():
            break
        worst = sizes[wanted].max()
        stale = 0 if worst < best / 2 else stale + 1
        best = min(best, worst)
        limit = EXACT * top if stale < 4 else FLOOR * top
        done = wanted & (sizes <= limit)
        if done.any():
            locked = np.concatenate([locked, space[:, done]], axis=1)
            values = np.concatenate([values, theta[done]])
            keep = ~done
            space, image = space[:, keep], image[:, keep]
            theta, residuals, wanted = theta[keep], residuals[:, keep], wanted[keep]
            best, stale = np.inf, 0
        open_pairs = np.flatnonzero(wanted)
        if not len(open_pairs) and len(values) >= count and not space.shape[1]:
            break
        if len(open_pairs):
            t = corrections(
                product, theta[open_pairs], space[:, open_pairs], residuals[:, open_pairs], locked,
                inner, 2.0 ** -(turn + 1),
            )
            if space.shape[1] + len(open_pairs) > basis:
                stay = min(space.shape[1], block + count)
                space, image = space[:, :stay], image[:, :stay]
            new = _orthonormal(t, locked, space)
            room = dim - locked.shape[1] - space.shape[1]
            if not new.shape[1] and room:  # nothing new: look elsewhere
                new = _orthonormal(rng.standard_normal((dim, min(room, SPARE))), locked, space)
            space = np.concatenate([space, new], axis=1)
            image = np.concatenate([image, product(new)], axis=1)
        elif len(values) < count and not space.shape[1]:
            space = _orthonormal(rng.standard_normal((dim, block)), locked)
            image = product(space)
    else:
        raise RuntimeError("the residuals did not reach double precision")
    order = np.argsort(-values, kind="stable")[:count]
    return values[order], locked[:, order]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of stored rows with their rounded vectors in ``y``; None without variance."""
    data = _Fit(rows)
    if not data.n:
        return None
    dim = data.dim
    trace = float(data.total(lambda d: (d * d).sum(axis=0)[:, None], dim, 1).sum() / data.n)
    if not trace:
        return None
    count = min(components, dim)
    width = min(dim, count + SPARE)
    values, vectors = jacobi_davidson(lambda w: data.product(w, width), dim, count, trace)
    # Values and residuals of the vectors as they are, from one more product.
    vectors = np.linalg.qr(vectors)[0]
    image = data.product(vectors, width)
    small = vectors.T @ image
    values, s = np.linalg.eigh((small + small.T) / 2)
    values, s = values[::-1], s[:, ::-1]
    vectors, image = vectors @ s, image @ s
    residual = float(np.linalg.norm(image - vectors * values, axis=0).max() / values[0])
    real = values > 64 * np.finfo(float).eps * dim * values[0]
    values, vectors = values[real], vectors[:, real]
    # The covariance of the whitened fit list, centred on its own mean.
    scaled = vectors / np.sqrt(values)
    mean = data.total(lambda d: (d @ scaled).sum(axis=0)[:, None], len(values), 1)[:, 0] / data.n

    def spread(d: np.ndarray) -> np.ndarray:
        z = d @ scaled - mean
        return z.T @ z

    covariance = data.total(spread, len(values), len(values)) / data.n
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return Whitening(data.n, data.sums, values, vectors, trace, residual, data.passes, error)


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` (columns k0... and ``y``) with ``deviation`` and the vector ``whitened``."""
    kept = [c for c in rows.columns if c != "y"]
    n, dim, sums = model.n, model.dim, model.sums
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s - n * int(b)) / n for s, b in zip(sums, base)])
    left = np.array([s - n * int(b) for s, b in zip(sums, base)], object)
    scaled = model.components / np.sqrt(model.values)
    most = 2 ** 63 - 1

    def run(batches):
        for batch in slices(batches, ROWS):
            y = _matrix(batch.column(len(kept)), dim) - base
            white = ((y - rest) @ scaled).ravel()
            peak = int(np.abs(y).max(initial=0))
            if (n * (peak + 1)) ** 2 * dim < most:
                off = n * y - left.astype(np.int64)
                deviation = (off * off).sum(axis=1).tolist()
            else:
                off = n * y.astype(object) - left
                deviation = [d if d <= most else None for d in (off * off).sum(axis=1)]
            offsets = np.arange(0, len(white) + 1, scaled.shape[1])
            yield pa.RecordBatch.from_arrays([
                *[batch.column(i) for i in range(len(kept))], pa.array(deviation, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(white)),
            ], names=[*kept, "deviation", "whitened"])

    fields = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept]
    return rows.select(*kept, "y").mapInArrow(
        run, ", ".join([*fields, "deviation long", "whitened array<double>"])
    )


def report(
    embeddings: DataFrame, components: int = COMPONENTS, by: str = "vec_id",
    vector: str = "embedding", scale: float = SCALE,
) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = rounded(embeddings, [by], vector, scale)
    model = fit(rows, components)
    if model is None:
        empty = "vec_id long, component int, n long, deviation long, whitened double, explained double"
        return embeddings.sparkSession.createDataFrame([], f"{empty}, identity_error double")
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    out = whiten(rows, model).select("k0", "deviation", F.posexplode("whitened").alias("p", "w"))
    return out.select(
        F.col("k0").cast("long").alias("vec_id"), (F.col("p") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"), "deviation", F.col("w").alias("whitened"),
        F.element_at(share, F.col("p") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
