"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A (n rows, d columns) are orthogonalised by Gram passes. A pass reads all rows, solves X R = A row by row through
the triangular factors found so far, and sums the Gram matrix of X over the cluster; its Cholesky factor joins the product
R = R3 R2 R1. The first pass adds the shift 11 (n d + d (d + 1)) u |A|^2, with which the Cholesky factorisation can't fail, however
ill-conditioned the rows are; the next passes repair what the shift took, and passes go on until the Gram matrix is the
identity. Where rows do not span all d dimensions that never happens; a pass whose Gram matrix isn't positive definite is
shifted too, so each pass shrinks what stands for the missing dimensions. The singular value decomposition of R (d x d) gives
the right singular vectors V and values s of A: components are columns of V, eigenvalues of the covariance are s^2 / n.

Rows are never collected. Sums and Gram matrices are one row for each task, then added up in rounds over ever fewer partitions,
so a task reads at most `FAN` matrices and the driver one. What is broadcast is the triangular factors, d^2 numbers each; d is bounded
by `WIDEST`. Centring is exact: n x - S is computed in integers and divided by n once.

Defined results: rows whose vector is null or holds a null or non-finite entry are dropped, as are rows whose length differs from
the commonest (the longer one, if two are as common). Components of zero variance do not exist: there are at most as many as
dimensions that the rows span, none for an empty table, a single row or equal rows. A component's sign makes its largest entry
positive. A null vec_id stays; repeated rows are each fitted and returned. `deviation` is null where it does not fit 64 bits. Entries
beyond 2^42 in size stop the job, as exact integers would not fit. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import ship

#: Matrices a task adds up; greatest dimension; a singular value this much below the largest is none.
FAN = 32
WIDEST = 4096
NONE_BELOW = 1e-10
PASSES = 6
LARGEST = float(1 << 42)

PARTIAL = "part BINARY"
WHITE = "vec_id BIGINT, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"


def _unusable(x: Column) -> Column:
    x = x.cast("double")
    return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))


def integers(table: DataFrame, vector: str = "embedding", scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """vec_id, x (array of whole numbers) of the usable rows."""
    v = F.col(f"`{vector}`")
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale) + offset)
    too_large = F.exists(v, lambda c: F.abs(c.cast("double")) >= LARGEST)
    checked = F.when(too_large, F.raise_error(F.lit("an entry is too large for exact integers")).cast("array<bigint>")).otherwise(x)
    rows = table.filter(v.isNotNull() & ~F.exists(v, _unusable)).select(F.col("vec_id").cast("bigint").alias("vec_id"), checked.alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common and common["d"] > WIDEST:
        raise ValueError(f"vectors of {common['d']} dimensions, at most {WIDEST} can be whitened")
    return rows.filter(F.size("x") == (common["d"] if common else -1))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def total(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str = "f8") -> np.ndarray | None:
    """Sum of `of(x)` (one array for each batch of rows) over all rows, added up in rounds; None without rows."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            if len(batch):
                part = of(_rows(batch)).astype(kind)
                sums = part if sums is None else sums + part
        yield from _packed(sums)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for raw in batch.column(0):
                part = np.frombuffer(raw.as_buffer(), dtype=kind)
                sums = part.copy() if sums is None else sums + part
        yield from _packed(sums)

    parts, many = rows.select("x").mapInArrow(local, PARTIAL), rows.rdd.getNumPartitions()
    while many > 1:
        many = -(-many // FAN)
        parts = parts.repartition(many).mapInArrow(merged, PARTIAL)
    found = [r["part"] for r in parts.collect()]  # one row at most
    return np.frombuffer(bytes(found[0]), dtype=kind) if found else None


def _packed(sums: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if sums is not None:
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["part"])


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n x - S as exact integers (Python's where 64 bits could be left), and divided by n as doubles."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    kind = np.int64 if reach < 1 << 62 else object
    exact = x.astype(kind) * n - np.array(sums, dtype=kind)
    return exact, (exact / n).astype(np.float64)


def solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """X of X R = A for an upper triangular R, column by column for all rows at once."""
    x = np.empty_like(a)
    for j in range(r.shape[0]):
        x[:, j] = (a[:, j] - x[:, :j] @ r[:j, j]) / r[j, j]
    return x


def deviations(exact: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None where one does not fit 64 bits."""
    if exact.dtype == np.int64 and float(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] < 2.0**62:
        return (exact * exact).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in exact]
    return [s if s < 1 << 63 else None for s in sums]


def factor(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangular factor R of the centred rows, by shifted CholeskyQR."""
    d, context = len(sums), rows.sparkSession.sparkContext
    factors: list[np.ndarray] = []
    eps = np.finfo(float).eps / 2
    for _ in range(PASSES):
        known = context.broadcast(list(factors))

        def gram(x: np.ndarray) -> np.ndarray:
            a = centred(x, n, sums)[1]
            for r in known.value:
                a = solve(a, r)
            return (a.T @ a).ravel()

        g = total(rows, gram).reshape(d, d)
        known.destroy()
        g = (g + g.T) / 2
        norm = float(np.linalg.norm(g, 2))
        if norm == 0:
            return np.zeros((d, d))
        if factors and np.abs(g - np.eye(d)).max() < 64 * d * eps:
            break
        shift = 11 * (n * d + d * (d + 1)) * eps * norm
        factors.append(_cholesky(g, shift if not factors else 0.0, 64 * d * eps * norm))
    product = np.eye(d)
    for r in factors:
        product = r @ product
    return product


def _cholesky(g: np.ndarray, shift: float, least: float) -> np.ndarray:
    """Upper triangular Cholesky factor of g plus a shift, which grows until there is one."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(least, 10 * shift)


def components(r: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Columns of V, their singular values, and the sum of all squared ones, of R = U s V'."""
    if not r.size or not np.any(r):
        return np.zeros((len(r), 0)), np.zeros(0), 0.0
    _, s, vt = np.linalg.svd(r)
    kept = min(keep, int((s > NONE_BELOW * s[0]).sum()))
    v = vt[:kept].T
    signs = np.sign(v[np.abs(v).argmax(axis=0), np.arange(kept)])
    return v * signs, s[:kept], float((s * s).sum())


def whiten(table: DataFrame, keep: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable row and component up to `keep`."""
    spark = table.sparkSession
    ship(spark)
    rows = integers(table)
    # Halves of 32 bits, so that sums over any number of rows stay exact.
    summed = total(rows, lambda x: np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]), "i8")
    if summed is None:
        return spark.createDataFrame([], WHITE)
    n, d = int(summed[0]), (len(summed) - 1) // 2
    sums = [(int(high) << 32) + int(low) for high, low in zip(summed[1 : d + 1], summed[d + 1 :])]
    v, s, trace = components(factor(rows, n, sums), keep)
    if not len(s):
        return spark.createDataFrame([], WHITE)
    scaled = v * (np.sqrt(n) / s)
    covariance = total(rows, lambda x: _outer(centred(x, n, sums)[1] @ scaled)).reshape(len(s), len(s)) / n
    error = float(np.abs(covariance - np.eye(len(s))).max())
    explained = s * s / trace

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(s)
        for batch in batches:
            if not len(batch):
                continue
            exact, a = centred(_rows(batch), n, sums)
            m = len(batch)
            columns = [
                pa.array(np.repeat(np.arange(m), k)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array([n] * (m * k), pa.int64()),
                pa.array(deviations(exact), pa.int64()),
                pa.array((a @ scaled).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array([error] * (m * k), pa.float64()),
            ]
            columns[3] = columns[3].take(columns[0])
            columns[0] = batch.column("vec_id").take(columns[0])
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in WHITE.split(", ")])

    return rows.mapInArrow(white, WHITE)


def _outer(w: np.ndarray) -> np.ndarray:
    return (w.T @ w).ravel()
