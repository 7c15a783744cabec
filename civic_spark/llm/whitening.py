"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries become integers ``floor(scale * c)``.  The model is fitted on the distinct integer vectors: their number and
sums are exact; the scatter is summed per partition from rows that were centred first, and only its d(d+1)/2 sums reach
the driver (they grow with the dimension, never with the rows).  With A = scatter / n and P'AP = LL', the columns of PL
are rotated in pairs until they are orthogonal: their squared lengths are the eigenvalues of A, their directions the
components.  No covariance is squared again and no eigenvalue is found as a difference.

Defined results: rows whose vector is null or holds null or non-finite entries are left out; shorter vectors count as
followed by zeros up to the longest; integers beyond 64 bits become the nearest 64-bit integer; a deviation beyond 64
bits is null; a component whose eigenvalue is 0 (within rounding) has a null ``whitened`` and takes no part in the
identity error; with eigenvalues that are all 0, ``explained`` and the identity error are 0; fewer dimensions than
components give that many; rows repeat with their ids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_spark.llm.shared import parquet

SCALE = 256.0
SAFE, LONG = 1 << 62, 1 << 63


def usable(vector: Column) -> Column:
    """The vector is there and all its entries are finite numbers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def integer_vectors(rows: DataFrame, vector: str = "embedding", carry: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """(carry..., x): the usable rows' integer vectors, all of the longest one's length."""
    own = rows.select(*carry, F.col(vector).cast("array<double>").alias("v")).where(usable(F.col("v")))
    d = own.agg(F.max(F.size("v"))).first()[0] or 0
    x = F.transform("v", lambda c: F.floor(c * SCALE))
    return own.select(*carry, F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("v"))).alias("x"))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), d)


def _offsets(x: np.ndarray, base: list[int]) -> np.ndarray:
    """x - base, exactly: as 64-bit integers where they hold it, else as Python integers."""
    most = int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, base), default=0)
    return x - np.array(base, np.int64) if most < SAFE else x.astype(object) - np.array(base, object)


@dataclass(frozen=True)
class Model:
    """n vectors with per-dimension sums; the leading components, their eigenvalues, and the trace."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def base(self) -> list[int]:
        """Whole part of the mean; the rest lies in [0, 1)."""
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[int]:
        return [s % self.n for s in self.sums]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _offsets(x, self.base).astype(float) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2 over the dimensions, exact."""
        u = _offsets(x, self.base)
        most = self.n * (int(np.abs(u).max(initial=0)) + 1)
        kind = np.int64 if u.dtype != object and len(self.sums) * most * most < SAFE else object
        parts = u.astype(kind) * self.n - np.array(self.rest, kind)
        return [int(v) if v < LONG else None for v in (parts * parts).sum(axis=1)]

    def project(self, x: np.ndarray) -> np.ndarray:
        positive = np.where(self.eigenvalues > 0, self.eigenvalues, np.nan)
        return self.centred(x) @ self.components / np.sqrt(positive)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """G with G G' = a, one column per step of a Cholesky factorisation that pivots on the largest remaining diagonal."""
    a, d = a.copy(), len(a)
    out, floor = [], d * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for _ in range(d):
        p = int(np.argmax(a.diagonal()))
        if a[p, p] <= floor:
            break
        column = a[:, p] / np.sqrt(a[p, p])
        for done in out:  # rows that were pivots are finished
            column[done[0]] = 0.0
        a -= np.outer(column, column)
        a[p, :] = a[:, p] = 0.0
        out.append((p, column))
    return np.stack([c for _, c in out], axis=1) if out else np.zeros((d, 0))


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of g rotated in pairs until they are orthogonal; disjoint pairs of a round turn together."""
    g = g.copy()
    r = g.shape[1]
    ring = list(range(r + r % 2))
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(p, q) for p, q in zip(ring[:half], reversed(ring[half:])) if p < r and q < r]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = np.array(pairs).T
            a, b = g[:, p], g[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            off = np.abs(ab) > 4 * np.finfo(float).eps * np.sqrt(aa * bb)
            if not off.any():
                continue
            turned = True
            zeta = (bb - aa)[off] / (2 * ab[off])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            a, b = a[:, off], b[:, off]
            g[:, p[off]], g[:, q[off]] = c * (a - t * b), c * (t * a + b)
        if not turned:
            break
    return g


def eigen(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(d x k unit components, k eigenvalues) of a symmetric non-negative matrix, largest first; missing ones are 0."""
    g = pivoted_cholesky(a)
    g = one_sided_jacobi(g) if g.shape[1] > 1 else g
    lengths = np.sqrt((g * g).sum(0))
    order = np.argsort(-lengths, kind="stable")[:k]
    components, values = np.zeros((len(a), k)), np.zeros(k)
    components[:, :len(order)], values[:len(order)] = g[:, order] / lengths[order], lengths[order] ** 2
    heads = np.take_along_axis(components, np.abs(components).argmax(0)[None, :], 0) if k else components
    return components * np.where(heads < 0, -1.0, 1.0), values


def fit(x: DataFrame, components: int = 4) -> Model | None:
    """The model of the distinct vectors in ``x``; None if there are none."""
    d = x.first()
    if d is None or len(d.x) == 0:
        return None
    d = len(d.x)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            m = _matrix(batch, d)
            kind = np.int64 if float(np.abs(m.astype(float)).max(initial=0)) * len(m) < SAFE else object
            n, total = n + len(m), [t + int(s) for t, s in zip(total, m.astype(kind).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0)),
                                          pa.array([n] * d, pa.int64())], names=["i", "s", "n"])

    rows = (x.mapInArrow(sums, "i int, s decimal(38,0), n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect())
    mean = Model(rows[0].n, tuple(int(r.s) for r in rows), np.zeros((d, 0)), np.zeros(0), 0.0)
    upper = np.triu_indices(d)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            y = mean.centred(_matrix(batch, d))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])],
                                         names=["i", "j", "v"])

    a = np.zeros((d, d))
    for i, j, v in x.mapInArrow(scatter, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        a[i, j] = a[j, i] = v / mean.n
    vectors, values = eigen(a, min(components, d))
    return Model(mean.n, mean.sums, vectors, values, float(a.trace()))


def _projected(x: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """(carry..., deviation, w): w holds a row's whitened values, null beyond the rank."""
    d, k = len(model.sums), len(model.eigenvalues)
    kept = x.select("x", *carry)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch, d)
            flat = pa.array(model.project(m).ravel(), pa.float64(), from_pandas=True)
            w = pa.ListArray.from_arrays(pa.array(np.arange(0, len(m) * k + 1, k, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(model.deviations(m), pa.int64()), w], names=[*carry, "deviation", "w"])

    return kept.mapInArrow(run, f"{fields}{', ' if fields else ''}deviation long, w array<double>")


def identity_error(x: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of the whitened vectors of ``x``, less the identity."""
    used = [k for k, e in enumerate(model.eigenvalues) if e > 0]
    w = _projected(x, model, [])
    pairs = [F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i in used for j in used if i <= j]
    if not pairs:
        return 0.0
    found = w.agg(*pairs).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i in used for j in used if i <= j)


def whiten(rows: DataFrame, vector: str = "embedding", carry: tuple[str, ...] = ("vec_id",), components: int = 4) -> DataFrame:
    """(carry..., component, n, deviation, whitened, explained, identity_error): one row per usable row and component.

    The distinct vectors are written once to the shared folder; three passes over them and one over the rows follow.
    """
    x = integer_vectors(rows, vector, carry)
    distinct = parquet(x.select("x").distinct())
    model = fit(distinct, components)
    if model is None:
        kinds = ", ".join(f"{c} {x.schema[c].dataType.simpleString()}" for c in carry)
        return rows.sparkSession.createDataFrame([], f"{kinds}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = [float(e / model.trace) if model.trace > 0 else 0.0 for e in model.eigenvalues]
    return (_projected(x, model, list(carry)).select(*carry, "deviation", F.posexplode("w").alias("k", "whitened"))
            .select(*carry, (F.col("k") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.array(*map(F.lit, shares))[F.col("k")].alias("explained"), F.lit(float(identity_error(distinct, model))).alias("identity_error")))
