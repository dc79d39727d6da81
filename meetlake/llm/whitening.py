"""Whitening of embeddings by refined principal components (operator 12).

Every entry c becomes the whole number x = floor(1024 c) + 100000. One pass gives the exact sums
S of all n vectors, a second one the covariance of x - S/n: tasks multiply centred blocks, and
partial products are added up entry by entry, so only d x d numbers reach the driver.

Eigenvectors come from a float32 solver and are corrected by Ogita and Aishima's
iteration: with R = I - X'X and T = X'VX each step solves for the correction of all vectors
by matrix products alone, in extended precision. Pairs of eigenvalues closer than the
step can tell apart form clusters; the matrix, shifted by the cluster's mean and compressed to its
vectors, is solved on its own, which separates them for the next step. Signs are set so
that the largest entry of a component is positive.

Work on the driver is d x d (some seconds at d = 1000), whatever the number of rows.

Defined results: vectors that are null, empty, or hold a null, NaN or infinite entry, or one of
2^52 or more in size (x is then no 64-bit number), take no part; of vectors of different
lengths those of the most frequent length take part (ties: the longer). Repeated rows and null ids
are rows like any other and count in the fit. A component without variance gives
whitened 0 and does not count in identity_error. `deviation` is null where it needs more than 64
bits. Without vectors there are no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = 2.0**52
MAX_ROUNDS = 30
_LONG = 2**63 - 1


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x) of the vectors that take part."""
    entries = F.transform(F.col(vector), lambda c: c.cast("double"))
    rows = vectors.select(F.col(vec_id).alias("id"), entries.alias("v"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & sound)
    # one row per length
    sizes = rows.groupBy(F.size("v").alias("d")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    x = F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT)
    return rows.filter(F.size("v") == (common["d"] if common else 0)).select("id", x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Vectors of a batch, one per row."""
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                fits = int(np.abs(x).max()) * len(x) < _LONG
                part = (x if fits else x.astype(object)).sum(axis=0).astype(object)
                n, total = n + len(x), part if total is None else total + part
        if n:
            values = [Decimal(int(v)) for v in (n, *total)]
            yield pa.record_batch(
                [pa.array(range(-1, len(total)), pa.int32()), pa.array(values, pa.decimal128(38, 0))],
                names=["j", "s"],
            )

    parts = rows.select("x").mapInArrow(partial, "j int, s decimal(38,0)")
    # d + 1 rows
    found = {r["j"]: int(r["s"]) for r in parts.groupBy("j").agg(F.sum("s").alias("s")).collect()}
    return found.get(-1, 0), [found[j] for j in range(len(found) - 1)]


@dataclass(frozen=True)
class Centre:
    """n and S; centres x without losing digits to the size of x."""

    n: int
    total: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = [s // self.n for s in self.total]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.total, whole)])
        return (x - np.array(whole, dtype=np.int64)).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        if self.n * int(np.abs(x).max()) + max(map(abs, self.total)) < _LONG:
            off = self.n * x - np.array(self.total, dtype=np.int64)
            if float(np.abs(off).max()) ** 2 * x.shape[1] < 2.0**62:
                return np.einsum("ij,ij->i", off, off).tolist()
        off = self.n * x.astype(object) - np.array(self.total, dtype=object)
        exact = (off * off).sum(axis=1)
        return [int(v) if v <= _LONG else None for v in exact]


def _products(rows: DataFrame, block) -> np.ndarray:
    """Sum of y'y over all vectors, y = block(x), added up by entry."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = block(_matrix(batch))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.record_batch(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                names=["i", "j", "v"],
            )

    parts = rows.select("x").mapInArrow(partial, "i int, j int, v double")
    # d (d + 1) / 2 rows
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    d = max(r["i"] for r in found) + 1
    out = np.zeros((d, d))
    for r in found:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Indices of two or more values that a chain of steps of at most `gap` joins."""
    order = np.argsort(values)
    ends = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, ends) if len(c) > 1]


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns, made so to the precision of their type."""
    for _ in range(3):
        x = x @ (3 * np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2
    return x


def _sub_solved(a: np.ndarray, x: np.ndarray, cluster: np.ndarray) -> None:
    """Turn the vectors of a cluster into eigenvectors within their span, in place."""
    part = _orthonormal(x[:, cluster])
    middle = np.trace(part.T @ a @ part) / len(cluster)
    small = part.T @ (a @ part) - middle * (part.T @ part)
    scale = np.abs(small).max()
    if scale > 0:
        _, turn = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))
        part = part @ _orthonormal(turn.astype(part.dtype))
    x[:, cluster] = part


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a symmetric matrix."""
    size = np.abs(v).max()
    if not size > 0:
        return np.zeros(len(v)), np.eye(len(v))
    a = v.astype(np.longdouble) / size
    _, start = np.linalg.eigh((v / size).astype(np.float32))
    x = start.astype(np.longdouble)
    eye, norm = np.eye(len(v), dtype=np.longdouble), np.linalg.norm(a.astype(np.float64))
    noise = 4 * len(v) * np.finfo(np.longdouble).eps
    for _ in range(MAX_ROUNDS):
        r, t = eye - x.T @ x, x.T @ (a @ x)
        r, t = (r + r.T) / 2, (t + t.T) / 2
        e = np.diag(t) / (1 - np.diag(r))
        apart = t - np.diag(np.diag(t))
        if np.abs(r).max() <= noise and np.abs(apart).max() <= noise * norm:
            break
        # what this step cannot tell apart, nor the rounding of the matrix itself
        off = np.linalg.norm(apart.astype(np.float64)) + norm * np.linalg.norm(r.astype(np.float64))
        told = max(2 * off, norm * np.finfo(np.float64).eps)
        gap = e[None, :] - e[:, None]
        near = np.abs(gap) <= told
        step = np.triu((t + e[None, :] * r) / np.where(near, 1, gap), 1)
        step = np.where(near, r / 2, step + np.tril(r - step.T, -1))
        x = x + x @ step
        # couplings within clusters are not seen by the step
        if np.abs(np.where(near, apart, 0)).max() > noise * norm:
            for cluster in _clusters(e, told):
                _sub_solved(a, x, cluster)
    e = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-e, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    lead = x[np.abs(x).argmax(axis=0), np.arange(len(v))]
    x = x * np.where(lead < 0, -1, 1)
    return (e[order] * size).astype(np.float64), x.astype(np.float64)


@dataclass(frozen=True)
class Whitener:
    """A fitted transform."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @staticmethod
    def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
        """From (id, x); None without vectors."""
        n, total = sums(rows)
        if not n:
            return None
        centre = Centre(n, tuple(total))
        v = _products(rows, centre.centred) / n
        e, x = eigen(v)
        trace = np.trace(v)
        kept = e[:components]
        share = kept / trace if trace > 0 else np.zeros(len(kept))
        # what rounding alone leaves of a dimension without variance
        flat = kept <= len(v) * np.finfo(np.float64).eps * max(e[0], 0)
        return Whitener(centre, np.where(flat, 0.0, kept), x[:, :components], share)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        some = self.values > 0
        over = np.where(some, 1 / np.sqrt(np.where(some, self.values, 1)), 0)
        return (self.centre.centred(x) @ self.vectors) * over

    def identity_error(self, rows: DataFrame) -> float:
        """Largest entry of the whitened rows' covariance minus the identity."""
        some = self.values > 0
        if not some.any():
            return 0.0
        # the fit list's mean is the centre, so its whitened mean is zero
        covariance = _products(rows, self.whitened) / self.centre.n
        return float(np.abs(covariance - np.eye(len(some)))[np.ix_(some, some)].max())


def transformed(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = quantised(vectors, vec_id, vector)
    made = StructType(
        [
            StructField("vec_id", rows.schema["id"].dataType),
            StructField("deviation", LongType()),
            StructField("w", ArrayType(DoubleType())),
        ]
    )
    model = Whitener.fit(rows, components)
    error = model.identity_error(rows) if model else 0.0

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model and batch.num_rows:
                x = _matrix(batch)
                off = pa.array(model.centre.deviations(x), pa.int64())
                w = pa.array(list(model.whitened(x)), pa.list_(pa.float64()))
                yield pa.record_batch([batch.column("id"), off, w], names=["vec_id", "deviation", "w"])

    share = F.array(*[F.lit(float(s)) for s in (model.explained if model else [0.0])])
    return (
        rows.mapInArrow(applied, made)
        .select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            F.lit(model.centre.n if model else 0).cast("bigint").alias("n"),
            "deviation",
            "whitened",
            F.get(share, F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
