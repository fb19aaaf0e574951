"""Embedding whitening: leading eigenvectors of the covariance by Chebyshev-filtered subspace iteration.

The covariance is never formed.  A pass over the rows multiplies it with a block of vectors: each task sums its rows'
centred ``Zt (Z Q)``, the partial sums meet in one aggregate of as many rows as the block has numbers.  A polynomial
in the covariance, applied by the Chebyshev recurrence (a pass per degree), damps the unwanted part of the spectrum;
QR and Rayleigh-Ritz then give the block's eigenvalue estimates.  Vectors whose residual is at rounding level are locked.
The result is certified by the residuals of all wanted pairs, and by a filtered block of fresh random vectors in
which nothing larger than the wanted eigenvalues may be left.

Entries become integers before anything is summed, so sums and centred entries are exact and don't depend
on the partitioning.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import stored

COMPONENTS = 32
GUARD = 16  # vectors beyond the wanted ones; the filter's interval ends at the least of them
SCALE, SHIFT = 64, 1_000_000  # an entry c becomes floor(SCALE * c) + SHIFT
LARGEST = 2.0**53 / SCALE  # entries beyond are no measurements: such a vector is dropped like one with an infinite entry
DEGREE = 12  # passes of one filter at most
SPREAD = 1e8  # how differently a filter may amplify the block's vectors
CERTAIN = 1e-13  # residual, as a share of the largest eigenvalue, at which a pair is certified ...
ROUNDING = 1e-10  # ... or at which it may be if further filters don't lower it
MAX_CYCLES = 200
NOTHING = 1e-12  # eigenvalues below this share of the trace are zero up to rounding


def integers(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """(key, x): the integer vectors of the rows that are used."""

    def usable(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)

    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    used = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).filter("v is not null")
    return used.filter(F.forall("v", usable)).select("key", x.alias("x"))


def matrix(batch, d: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class Fit:
    """The rows of one dimension, their number, exact sums, and passes over them."""

    def __init__(self, rows: DataFrame):
        sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).filter("d > 0")
        most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
        self.d, self.n = (most["d"], most["n"]) if most else (0, 0)
        self.rows = rows.filter((F.size("x") == self.d) & (F.lit(self.d) > 0))
        entry = self.rows.select(F.posexplode("x").alias("i", "e")).groupBy("i")
        stats = entry.agg(F.sum(F.col("e").cast("decimal(38,0)")).alias("s"), F.max(F.abs("e")).alias("most")).collect()
        stats.sort(key=lambda r: r["i"])  # d rows
        self.sums = [int(r["s"]) for r in stats]
        largest = max((r["most"] for r in stats), default=0)
        # n * x and a deviation in 64-bit integers where they surely fit, else in Python's
        self.kind = np.int64 if 2 * self.n * largest < 2**62 else object
        self.small = 4 * self.d * (self.n * largest) ** 2 < 2**62

    def centred(self):
        """A function: integer rows to the exact n * x - S."""
        n, kind = self.n, self.kind
        sums = np.array(self.sums, dtype=kind)
        return lambda x: n * x.astype(kind) - sums

    def total(self, partial, size: int) -> np.ndarray:
        """The sum over all rows of the vectors of length ``size`` that ``partial`` makes of centred rows (divided by n)."""
        d, n, centred = self.d, self.n, self.centred()

        def run(batches):
            held = np.zeros(size)
            for batch in batches:
                x = matrix(batch, d)  # a batch of Spark's is never empty
                for a in range(0, len(x), 4096):
                    held += partial(centred(x[a : a + 4096]).astype(np.float64) / n).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(held)], ["at", "v"])

        out = np.zeros(size)
        parts = self.rows.select("x").mapInArrow(run, "at int, v double")
        for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():  # bounded by the block
            out[r["at"]] = r["v"]
        return out

    def covariance_times(self, q: np.ndarray) -> np.ndarray:
        return self.total(lambda z: z.T @ (z @ q), q.size).reshape(q.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda z: np.array([(z * z).sum()]), 1)[0]) / self.n


def orthonormal(q: np.ndarray, against: np.ndarray) -> np.ndarray:
    """QR of the columns after projecting those of ``against`` out, twice."""
    for _ in range(2):
        q = np.linalg.qr(q - against @ (against.T @ q))[0]
    return q


def rayleigh_ritz(apply, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residual norms) of the block, by falling value."""
    y = apply(q)
    t = q.T @ y
    values, s = np.linalg.eigh((t + t.T) / 2)
    values, s = values[::-1], s[:, ::-1]
    q, y = q @ s, y @ s
    return values, q, np.linalg.norm(y - q * values, axis=0)


def filtered(apply, q: np.ndarray, low: float, high: float, degree: int) -> tuple[np.ndarray, float]:
    """(q after the Chebyshev polynomial that is small on [low, high], an estimate of the spectrum's lower end)."""
    centre, half = (high + low) / 2, (high - low) / 2
    seen, images = [], []
    before, now = None, q
    for k in range(degree):
        y = apply(now)
        seen.append(now[:, -1])
        images.append(y[:, -1])
        step = (y - centre * now) / half
        before, now = now, step if k == 0 else 2 * step - before
        scale = np.abs(now).max()
        before, now = before / scale, now / scale
    return now, lower_end(seen, images)


def lower_end(vectors: list[np.ndarray], images: list[np.ndarray]) -> float:
    """The least Rayleigh-Ritz value of the vectors, whose images are known, less its residual."""
    v, y = np.array(vectors).T, np.array(images).T
    norm = np.linalg.norm(v, axis=0)
    v, y = v / norm, y / norm
    u, size, w = np.linalg.svd(v, full_matrices=False)
    keep = size > 1e-6 * size[0]
    u, y = u[:, keep], (y @ w[keep].T) / size[keep]
    t = u.T @ y
    values, s = np.linalg.eigh((t + t.T) / 2)
    return float(values[0] - np.linalg.norm(y @ s[:, 0] - values[0] * (u @ s[:, 0])))


def leading(apply, d: int, wanted: int, guard: int = GUARD, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of the ``wanted`` largest eigenvalues of a covariance, certified."""
    rng = np.random.default_rng(seed)
    wanted = min(wanted, d)
    size = min(d, wanted + guard)
    locked, locked_values = np.zeros((d, 0)), np.zeros(0)
    values, q, residual = rayleigh_ritz(apply, orthonormal(rng.standard_normal((d, size)), locked))
    low, fresh, best, stuck = 0.0, False, math.inf, 0
    for _ in range(MAX_CYCLES):
        top = max([values[0], *locked_values[:1]], default=0.0)
        open_ = wanted - locked.shape[1]
        good = residual <= max(CERTAIN * top, 1e-300)
        worst = residual[:open_].max(initial=0.0)
        stuck = stuck + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if stuck >= 3:
            good |= residual <= ROUNDING * top
            low /= 2  # the estimate may have been too high
        n = int(np.argmin(good[:open_])) if not good[:open_].all() else open_
        if n:  # pairs are locked in falling order
            locked = np.concatenate([locked, q[:, :n]], axis=1)
            locked_values = np.concatenate([locked_values, values[:n]])
            values, q, residual = values[n:], q[:, n:], residual[n:]
            best, stuck = math.inf, 0
        open_ -= n
        if not open_:
            if fresh or size == d:
                order = np.argsort(-locked_values, kind="stable")
                return locked_values[order], locked[:, order]
            fresh = True  # look for what the block may have missed
            q = orthonormal(rng.standard_normal((d, min(guard, d - wanted))), locked)
            values, q, residual = rayleigh_ritz(apply, q)
            high = max(locked_values[-1], 1e-8 * top)
        else:
            high = max(values[-1], 1e-8 * top)
        low = max(0.0, min(low, 0.9 * high))
        growth = math.acosh(max(1 + 1e-12, (2 * max(values[0], high) - high - low) / (high - low)))
        degree = int(min(DEGREE, max(1, math.log(SPREAD) / growth)))
        q, end = filtered(apply, q, low, high, degree)
        low = max(low, min(end, 0.9 * high)) if degree > 3 else low
        values, q, residual = rayleigh_ritz(apply, orthonormal(q, locked))
        if fresh and not open_ and values[0] <= locked_values[-1] * (1 + 1e-9):
            order = np.argsort(-locked_values, kind="stable")
            return locked_values[order], locked[:, order]
        if fresh and not open_:  # a missed one: it takes its place, the last is open again
            fresh, wanted_back = False, locked_values < values[0]
            q = np.concatenate([q, locked[:, wanted_back]], axis=1)
            locked, locked_values = locked[:, ~wanted_back], locked_values[~wanted_back]
            values, q, residual = rayleigh_ritz(apply, orthonormal(q, locked))
    raise ArithmeticError(f"the eigenvectors did not converge in {MAX_CYCLES} cycles (residuals {residual})")


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS, guard: int = GUARD) -> DataFrame:
    """One row per used row of ``rows``: key, n, deviation (decimal(38,0)), whitened, explained (arrays), identity_error.

    Used are rows whose vector is not null, holds no null, NaN, infinite or absurdly large (2^47) entry, and has the most
    frequent length (of several the longest); repeated rows count each, null keys stay.  ``whitened`` holds the
    projections on the unit eigenvectors of the ``components`` largest eigenvalues, over their roots;
    directions in which the rows don't differ (eigenvalue zero up to rounding) are left out, so equal rows give empty
    arrays, and an empty table no rows.  Other columns are not read.
    """
    fit = Fit(stored(integers(rows, vector, key), "whitening-rows"))
    d, n, centred, small = fit.d, fit.n, fit.centred(), fit.small
    trace = fit.trace() if n else 0.0
    if trace > 0:
        values, q = leading(fit.covariance_times, d, components, guard)
        values, q = values[values > NOTHING * trace], q[:, values > NOTHING * trace]
    else:
        values, q = np.zeros(0), np.zeros((d, 0))
    sign = np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])]) if q.size else np.ones(0)
    to_white = q * sign / np.sqrt(values)
    k = len(values)
    error = 0.0
    if k:
        white = fit.total(lambda z: (w := z @ to_white).T @ w, k * k).reshape(k, k) / n
        error = float(np.abs(white - np.eye(k)).max())
    explained = (values / trace).tolist() if k else []

    def run(batches):
        for batch in batches:
            x = matrix(batch, d)
            keys = batch.column(batch.schema.get_field_index("key"))
            for a in range(0, len(x), 4096):
                z = centred(x[a : a + 4096])
                squares = z if small else z.astype(object)
                deviation = [Decimal(int(v)) for v in (squares * squares).sum(axis=1)]
                w = (z.astype(np.float64) / n) @ to_white
                ends = np.arange(0, k * (len(w) + 1), k, dtype=np.int32) if k else np.zeros(len(w) + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys[a : a + len(w)],
                        pa.array(deviation, pa.decimal128(38, 0)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel())),
                    ],
                    [key, "deviation", "whitened"],
                )

    out = fit.rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>")
    told = F.array(*[F.lit(e) for e in explained]).cast("array<double>")
    return out.select(
        key, F.lit(n).cast("long").alias("n"), "deviation", "whitened", told.alias("explained"), F.lit(error).alias("identity_error")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(read_table(spark, sf_dir, "embeddings"))
    rows = found.select("*", F.posexplode("whitened").alias("at", "value"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),  # beyond 2^63, from some million rows on, null: no long holds it
        F.col("value").alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )


QUERIES = {"op12_whitening": op12_whitening}
