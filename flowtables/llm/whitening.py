"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors, centred, are the rows of a tall matrix A that stays in Spark. A step multiplies it by a short vector v
(every task its own rows) and the tall result u by A's transpose (tasks' sums meet by dimension): A v = alpha u + beta u', and
A'u = alpha v + beta v''. The short vectors stay on the driver, where each is orthogonalised against all before it. A tall vector
is never stored: it is A w for a short w, so its rows are made again where they are needed, and its products with all earlier tall
vectors, by which it is orthogonalised, come out of the same read of the table. The singular values of the small bidiagonal
matrix lead to the components and their deviations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.tables import cut

SCALE, ORIGIN, COMPONENTS = 64, 1_000_000, 16
LARGEST = 1 << 40  # an entry whose whole number is not below this counts as not finite
READ_ROWS, SEED, NONE, SURE = 4096, 5, 1e-11, 1e-13
LOOK = 12  # steps from a fresh start before nothing new is believed


@dataclass
class Whitening:
    n: int
    total: list[int]  # the sums S of the n whole-number vectors, exact
    components: np.ndarray  # dimensions x components, unit columns by falling variance
    deviations: np.ndarray  # root of the variance along each component
    explained: np.ndarray
    identity_error: float


def whole_numbers(vectors: DataFrame, vector_col: str, *keep: str) -> DataFrame:
    """`keep` and x, the entries as whole numbers floor(64 * c) + 1000000; rows with a null vector or a null, not finite or out-of-range entry go."""
    c = F.col(vector_col).cast("array<double>")
    sound = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * SCALE < LARGEST))
    x = F.transform(c, lambda v: F.floor(v * SCALE) + ORIGIN)
    return vectors.where(F.coalesce(sound, F.lit(False))).select(*keep, x.alias("x"))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - S / n; the numerator is exact, also where it does not fit a long."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < 1 << 61:
        return (x * n - np.array(total, np.int64)) / n
    return ((x.astype(object) * n - np.array(total, object)) / n).astype(np.float64)


def _sums(fit: DataFrame, width: int, rows) -> np.ndarray:
    """The sum over all rows of fit of `rows(x)`, a vector of `width` for each batch: tasks add up their own, Spark the tasks' by place."""

    def run(batches):
        mine = np.zeros(width)
        for batch in batches:
            for at in range(0, batch.num_rows, READ_ROWS):
                mine += rows(batch.slice(at, READ_ROWS))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(mine)], ["place", "part"])

    found = fit.mapInArrow(run, "place int, part double").groupBy("place").agg(F.sum("part").alias("part")).toPandas()
    out = np.zeros(width)
    out[found.place.to_numpy()] = found.part.to_numpy()
    return out


class _Lanczos:
    """The bidiagonalisation of the centred fit table, as far as it has gone."""

    def __init__(self, fit: DataFrame, n: int, total: list[int]):
        self.fit, self.n, self.total, self.dim = fit, n, total, len(total)
        self.v = np.zeros((self.dim, 0))  # short vectors
        self.w = np.zeros((self.dim, 0))  # tall ones are A w
        self.z = np.zeros((self.dim, 0))  # A' u
        self.small = np.zeros((0, 0))  # U' A V: bidiagonal, but for the columns of fresh starts
        self.open: list[tuple[int, float]] = []  # tall vectors whose next short one was left for a fresh start, and its weight
        self.rng = np.random.default_rng(SEED)
        dim, count, sums = self.dim, n, total

        def spread(batch):
            a = centred(_matrix(batch, dim), count, sums)
            return np.array([(a * a).sum()])

        self.trace = float(_sums(fit, 1, spread)[0])
        # below this a vector is rounding
        self.least = NONE * np.sqrt(self.trace)

    def product(self, c: np.ndarray):
        """For q = A c: its length squared, its products with all tall vectors so far, and A' q, from one read."""
        dim, n, total, w = self.dim, self.n, self.total, self.w
        k = w.shape[1]

        def rows(batch):
            a = centred(_matrix(batch, dim), n, total)
            q = a @ c
            return np.concatenate([[q @ q], (a @ w).T @ q, a.T @ q])

        out = _sums(self.fit, 1 + k + dim, rows)
        return out[0], out[1 : 1 + k], out[1 + k :]

    def orthogonal(self, r: np.ndarray) -> np.ndarray:
        for _ in range(2):
            r = r - self.v @ (self.v.T @ r)
        return r

    def fresh(self) -> np.ndarray | None:
        """A random direction in A's row space that no short vector so far has a part of; None if there is none left."""
        if self.v.shape[1] >= min(self.dim, self.n - 1):
            return None
        start = self.orthogonal(self.rng.normal(size=self.dim))
        r = self.orthogonal(self.product(start / np.linalg.norm(start))[2])
        size = np.linalg.norm(r)
        return r / size if size > self.least * np.sqrt(self.trace) else None

    def step(self, v: np.ndarray, beta: float) -> np.ndarray | None:
        """Take in the short vector v, coupled with the last tall one by beta; the next short vector, or None where the Krylov space ends."""
        k = self.v.shape[1]
        c = v - beta * self.w[:, -1] if beta else v
        square, g, back = self.product(c)
        # what earlier tall vectors still have in q: rounding, but for a fresh start beside an open end
        square, back, c = square - g @ g, back - self.z @ g, c - self.w @ g
        alpha = np.sqrt(max(square, 0.0))
        small = np.zeros((k + 1, k + 1))
        small[:k, :k], small[:k, k] = self.small, g
        if beta:
            small[k - 1, k] += beta
        alpha = alpha if alpha > self.least else 0.0  # 0: v is in the null space, there is no tall vector
        small[k, k] = alpha
        self.small = small
        self.v = np.column_stack([self.v, v])
        self.w = np.column_stack([self.w, c / alpha if alpha else np.zeros(self.dim)])
        self.z = np.column_stack([self.z, back / alpha if alpha else np.zeros(self.dim)])
        if not alpha:
            return None
        r = self.orthogonal(self.z[:, -1])
        size = np.linalg.norm(r)
        if size <= self.least or k + 1 >= min(self.dim, self.n - 1):
            return None
        self.next_beta = float(size)
        return r / size

    def values(self, beta: float = 0.0):
        """Singular values of the small matrix so far, their right vectors, and how far each may still be from one of A."""
        left, s, right = np.linalg.svd(self.small)
        ends = [*self.open, (len(s) - 1, beta)]
        return s, right.T, sum(np.abs(left[j]) * b for j, b in ends)


def _components(fit: DataFrame, n: int, total: list[int], wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Unit components by falling singular value, the values, and the trace.

    The space is enlarged until the first `wanted` values stand and a fresh direction, outside all that is known, brings no other value
    that belongs among them (one start finds an equal value once only), or until there is no further direction.
    """
    run = _Lanczos(fit, n, total)
    known: np.ndarray | None = None
    v = run.fresh() if run.trace > 0 else None
    beta, since = 0.0, 0
    while v is not None:
        v = run.step(v, beta)
        beta = run.next_beta if v is not None else 0.0
        if v is None:
            v = run.fresh()
            continue
        s, _, off = run.values(beta)
        first = s[:wanted]
        if len(s) > wanted and (off[:wanted] <= SURE * s[0]).all():
            if known is not None and since >= LOOK and np.allclose(known, first, rtol=1e-12, atol=0):
                break
            if known is not None and np.allclose(known, first, rtol=1e-12, atol=0):
                since += 1
                continue
            known, since = first, 0
            run.open.append((len(s) - 1, beta))
            v, beta = run.fresh(), 0.0
    s, right, _ = run.values() if len(run.small) else (np.zeros(0), np.zeros((0, 0)), None)
    good = np.flatnonzero(s > run.least)[:wanted]
    vectors = run.v @ right[:, good] if len(good) else np.zeros((run.dim, 0))
    if len(good):
        vectors /= np.linalg.norm(vectors, axis=0)
        vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(good))])
    return vectors, s[good], run.trace


def fit(vectors: DataFrame, *, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening learned from each distinct vector of whole numbers once.

    Rows with a null vector or a null, not finite or too large entry are not learned from, nor are vectors of another length than
    most have (of equally frequent lengths the longer). Without rows, or with equal vectors only, there are no components.
    Components without variance are left out.
    """
    x = whole_numbers(vectors, vector_col)
    lengths = x.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim = lengths[0].dim if lengths else 0
    if not dim:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    table = cut(x.where(F.size("x") == dim).distinct())
    exact = table.select(F.posexplode("x").alias("place", "c")).groupBy("place").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("place").collect()
    n, total = exact[0].n, [int(r.s) for r in exact]
    axes, s, trace = _components(table, n, total, min(components, dim))
    deviations = s / np.sqrt(n)
    k = len(s)

    def moments(batch):
        y = centred(_matrix(batch, dim), n, total) @ axes / deviations
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    error = 0.0
    if k:
        sums = _sums(table, k + k * k, moments) / n
        error = float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())
    return Whitening(n, total, axes, deviations, s * s / trace if k else s, error)


def _deviation(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """The sum over dimensions of (n * x - S) ** 2, exact; null where it does not fit a long."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < 1 << 61:
        d = x * n - np.array(total, np.int64)
        if float(np.abs(d).max(initial=0)) ** 2 * max(x.shape[1], 1) < 2.0**62:
            return (d * d).sum(1).tolist()
    d = x.astype(object) * n - np.array(total, object)
    return [v if v < 1 << 63 else None for v in map(int, (d * d).sum(1))]


def transform(vectors: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per vector and component: id_col, component, n, deviation, whitened, explained, identity_error.

    whitened is the centred vector's part along the component over the component's deviation. Rows that the fit leaves out for their vector
    give none, nor does any row if there are no components. Null and repeated ids are ids like others; other columns are not looked at.
    """
    n, total, axes, deviations, explained = model.n, model.total, model.components, model.deviations, model.explained
    dim, k, error = len(total), len(model.deviations), model.identity_error

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, READ_ROWS):
                batch = whole.slice(at, READ_ROWS)
                x = _matrix(batch, dim)
                y = centred(x, n, total) @ axes / deviations
                rows = len(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n)),
                     pa.array(_deviation(x, n, total), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(y.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = whole_numbers(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("__vector")), "__vector", "id").where(F.size("x") == dim if k else F.lit(False))
    out = rows.mapInArrow(run, "id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)
