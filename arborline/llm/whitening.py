"""Operator 13: whitening of embeddings along their leading components, found by matrix-free block subspace iteration.

Entries are made whole numbers first. The components are those of the distinct vectors' covariance, which is never formed: a pass over the
distinct vectors centres each and returns Z'(Z Q) for a block Q of directions, a table of dimensions x block size. The driver orthonormalises it (QR), solves
the block's own small problem (Rayleigh-Ritz), and goes on until the residuals say that every wanted component is an eigenvector to the precision of doubles. A block that
gets there too slowly, as on a flat spectrum, is doubled, up to all dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from arborline.llm.common import checkpointed, fresh, tidy

#: Residuals over the largest eigenvalue that certify a component; what rounding can leave of them per dimension; passes in which a block should get there, and at most.
TOLERANCE, ROUNDING, PATIENCE, MOST_PASSES = 1e-14, 2e-16, 12, 500
#: Rows that are centred and multiplied together.
CHUNK = 4096
OUTPUTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")


@dataclass(frozen=True)
class Components:
    """vectors: (component, dimension), by falling variance; n distinct vectors with these sums; trace: the variance of all dimensions; error: the largest absolute entry of the whitened rows' covariance less the identity."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    error: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole_vectors(df: DataFrame, vector: str, scale: int, out: str = "x") -> DataFrame:
    """df with ``out``: floor(scale * entry) of each entry; rows go whose vector is null, empty, or holds null or non-finite entries."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))) & (F.size(x) > 0)
    return df.where(F.coalesce(finite, F.lit(False))).withColumn(out, F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """A list column whose rows have one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(rows: DataFrame, width: int, work) -> np.ndarray:
    """The sum over all tasks of work's tables of doubles (dimension x width), added up by dimension on executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = work(_matrix(batch.column(0).slice(at, CHUNK)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total))), *(pa.array(total[:, k]) for k in range(width))], names=["i", *(f"s{k}" for k in range(width))])

    names = [f"s{k}" for k in range(width)]
    parts = rows.select("x").mapInArrow(tidy(run), "i long, " + ", ".join(f"{s} double" for s in names))
    found = sorted(parts.groupBy("i").agg(*[F.sum(s).alias(s) for s in names]).collect())
    return np.array([r[1:] for r in found])


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """(rows, exact sums of the dimensions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            if int(np.abs(x).max()) * len(x) >= 1 << 63:
                raise OverflowError("a sum of entries may not fit in 64 bits")
            yield pa.record_batch([pa.array(np.arange(x.shape[1])), pa.array(np.full(x.shape[1], len(x))), pa.array(x.sum(axis=0))], names=["i", "n", "s"])

    parts = fit.select("x").mapInArrow(tidy(run), "i long, n long, s long")
    rows = sorted(parts.groupBy("i").agg(F.sum("n"), F.sum("s")).collect())
    return (rows[0][1] if rows else 0), [r[2] for r in rows]


def components(fit: DataFrame, k: int, block: int = 16, seed: int = 1) -> Components | None:
    """The k leading components of the rows' x (all of one length), each row once; None without rows. Components without variance are left out.

    fit is read once a pass: pass a table, or a checkpointed DataFrame. A pass brings dimensions x block doubles to the driver, which does not follow the rows.
    """
    n, sums = _sums(fit)
    if not n:
        return None
    d = len(sums)
    mean = np.array([s / n for s in sums])

    def product(q: np.ndarray) -> np.ndarray:
        """The covariance times q, and in the last column the variances."""

        def work(x: np.ndarray) -> np.ndarray:
            z = x - mean
            return np.concatenate([z.T @ (z @ q), (z * z).sum(axis=0)[:, None]], axis=1)

        return _added(fit, q.shape[1] + 1, work) / n

    rng = np.random.default_rng(seed)
    b = min(d, max(block, 2 * k))
    q = np.linalg.qr(rng.standard_normal((d, b)))[0]
    best, stuck = np.inf, 0
    for passes in range(1, MOST_PASSES + 1):
        got = product(q)
        y, trace = got[:, :-1], float(got[:, -1].sum())
        small = q.T @ y
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, image = q @ turn, y @ turn
        left = float(np.linalg.norm(image - ritz * values, axis=0)[:k].max()) / max(float(values[0]), 1e-300)
        stuck = stuck + 1 if left > 0.5 * best else 0
        rate, best = left / best if best < np.inf else 0.1, min(best, left)
        if left <= TOLERANCE or (stuck >= 3 and left <= ROUNDING * d * 50) or values[0] <= 0:
            break
        if q.shape[1] == d and passes > 1:  # the block is the whole space: what is left is rounding; one more turn has polished it
            break
        q = image
        if rate ** PATIENCE * left > TOLERANCE and b < d and passes > 1:
            b = min(d, 2 * b)
            q = np.concatenate([q / np.linalg.norm(q, axis=0), rng.standard_normal((d, b - q.shape[1]))], axis=1)
            best = np.inf
        # of two turns of Gram and Schmidt the second takes out what the first one's rounding left
        q = np.linalg.qr(np.linalg.qr(q)[0])[0]
    else:
        raise RuntimeError(f"components did not settle in {MOST_PASSES} passes: residual {left:.1e}")
    k = min(k, int((values > 1e-12 * trace).sum()))
    values, vectors = values[:k], ritz[:, :k].T
    vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    error = 0.0
    if k:
        down = vectors / np.sqrt(values)[:, None]

        def gram(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ down.T
            return w.T @ w

        error = float(np.abs(_added(fit, k, gram) / n - np.eye(k)).max())
    return Components(n, tuple(sums), trace, values, vectors, error, passes)


def distinct_vectors(rows: DataFrame, x: str = "x") -> DataFrame:
    """Each distinct x once, in the shared folder."""
    return checkpointed(rows.select(F.col(x).alias("x")).distinct())


def whiten(df: DataFrame, vector: str, k: int = 4, scale: int = 256) -> DataFrame:
    """A row for each vector and component: df's columns but the vector, component (from 1), n, deviation, whitened, explained and identity_error.

    x is floor(scale * entry). n: distinct vectors; deviation: the exact sum over dimensions of (n x - S)^2 with S the distinct vectors' sums; whitened: the
    centred x along the component over the root of its variance; explained: its share of the variance; identity_error: the largest absolute entry of
    the whitened distinct vectors' covariance less the identity, one value for all.

    Cases: rows go whose vector is null, empty, or holds null or non-finite entries; of vectors of several lengths those of the commonest take part (ties: the
    longer); repeated rows each get their rows, and count once in the fit; null keys are carried; components without variance are left out, so that a
    table of equal vectors gives no row, nor does an empty table; components of equal variance are any orthonormal ones; an entry, sum or
    deviation beyond 64 bits raises; other columns are carried, those with the outputs' names replaced.
    """
    others = [c for c in df.columns if c != vector and c.lower() not in OUTPUTS]
    x = fresh(df, "x")
    rows = whole_vectors(df, vector, scale, x)
    lengths = rows.groupBy(F.size(x).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is not None:
        rows = rows.where(F.size(x) == lengths.d)
    added = [StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType()), StructField("whitened", DoubleType()), StructField("explained", DoubleType()), StructField("identity_error", DoubleType())]
    schema = StructType([*[df.schema[c] for c in others], *added])
    found = components(distinct_vectors(rows, x), k) if lengths is not None else None
    if found is None or not len(found.values):
        return df.sparkSession.createDataFrame([], schema)
    n, sums, mean = found.n, found.sums, found.mean
    down, share = found.vectors / np.sqrt(found.values)[:, None], found.values / found.trace
    spread = np.array(sums, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(len(others)))
            most = n * int(np.abs(x).max()) + max(map(abs, sums))
            if most * most * x.shape[1] >= 1 << 63:
                deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
            else:
                deviation = ((n * x - spread) ** 2).sum(axis=1)
            w = (x - mean) @ down.T
            at, count = np.repeat(np.arange(len(x)), len(share)), len(x)
            columns = [batch.column(i).take(pa.array(at)) for i in range(len(others))]
            made = [pa.array(np.tile(np.arange(1, len(share) + 1), count), pa.int32()), pa.array(np.full(len(at), n)), pa.array(deviation, pa.int64()).take(pa.array(at)), pa.array(w.ravel()), pa.array(np.tile(share, count)), pa.array(np.full(len(at), found.error))]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*others, *OUTPUTS])

    return rows.select(*[F.col(f"`{c}`") for c in others], x).mapInArrow(tidy(run), schema)
