"""Whitening of embeddings: blockwise QR, then a bidiagonal qd solver.

Each entry c becomes the integer ``floor(64 c) + 1000000``.  The directions are
fitted on the distinct integer vectors: their exact sums come first, then every
task reduces its centred rows to one triangular factor (QR of the factor so far on
top of the next block), and factors are merged sixteen at a time in a tree.  Only
the last factor, as wide as a vector on both sides, reaches the driver, where
:mod:`.bidiagonal` turns it into eigenvalues and eigenvectors of the covariance.
The identity error is measured on the fit list itself with the vectors found.

Defined results: rows whose vector is null or empty or holds a null, a non-finite
entry or one of 2**56 and more (no long holds its integer) are dropped, as are
vectors of another length than the commonest of the distinct ones (the longer at a
tie); repeated rows
and null ids are kept and each get their rows; a direction without variance (to
working precision) is no component, so a table of one distinct vector, or an empty
one, gives no rows; ``deviation`` is null where no long holds it; other columns do
not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bidiagonal import right_singular
from .common import quoted, staged

# The integer form of an entry.
SCALE, SHIFT = 64, 1_000_000
BLOCK = 4096
FAN_IN = 16
LIMIT = float(2 ** 56)
LOW = (1 << 32) - 1


@dataclass(frozen=True)
class Whitening:
    """What the fit leaves: ``n`` distinct vectors, their exact sums, and the directions found."""

    n: int
    sums: list[int]
    directions: np.ndarray        # (dimensions, components), unit columns
    eigenvalues: np.ndarray
    trace: float


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that count."""
    v = F.col(quoted(vector))
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= LIMIT))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    return rows.where(v.isNotNull() & (F.size(v) > 0) & ~bad).select(F.col(quoted(vec_id)).alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: int64 where it fits, else Python integers."""
    whole = [s // n for s in sums]
    rest = [s - n * w for s, w in zip(sums, whole, strict=True)]
    fits = all(abs(w) < 1 << 62 for w in whole)
    if fits and len(x):
        reach = max(abs(float(x.max())), abs(float(x.min()))) + max(abs(float(w)) for w in whole)
        fits = reach * n < 2.0 ** 61
    if fits:
        return n * (x - np.array(whole, np.int64)) - np.array(rest, np.int64)
    return n * (x.astype(object) - np.array(whole, object)) - np.array(rest, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_scaled(x, n, sums) / n).astype(np.float64)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension; halves of 32 bits keep partial sums in a long."""
    def run(batches):
        n, low, high = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            low += (x & LOW).sum(axis=0)
            high += (x >> 32).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1)), pa.array(np.append(low, n)), pa.array(np.append(high, 0))],
                                         names=["i", "low", "high"])

    parts = fit.select("x").mapInArrow(run, "i long, low long, high long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")]
    totals = {r["i"]: int(r["low"]) + (int(r["high"]) << 32) for r in parts.groupBy("i").agg(*exact).collect()}
    return totals.get(width, 0), [totals.get(i, 0) for i in range(width)]


def _triangle(above: np.ndarray | None, rows: np.ndarray, width: int) -> np.ndarray:
    """The square triangular factor of ``rows`` below the factor ``above``."""
    stack = rows if above is None else np.vstack([above, rows])
    r = np.linalg.qr(stack, mode="r")
    return r if len(r) == width else np.vstack([r, np.zeros((width - len(r), width))])


def _factor(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Triangular factor of all centred rows."""
    width = len(sums)

    def local(batches):
        r = None
        for batch in batches:
            rows = _centred(_matrix(batch.column(0), width), n, sums)
            for k in range(0, len(rows), BLOCK):
                r = _triangle(r, rows[k:k + BLOCK], width)
        if r is not None:
            yield batch_of(TaskContext.get().partitionId(), r)

    def batch_of(part, r):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], names=["part", "r"])

    def merged(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        r = None
        for row in table.column("r"):
            r = _triangle(r, row.values.to_numpy(zero_copy_only=False).reshape(width, width), width)
        return pa.Table.from_batches([batch_of(table.column("part")[0].as_py() // FAN_IN, r)])

    schema = "part long, r array<double>"
    factors = staged(fit.select("x").mapInArrow(local, schema), "factors")
    last = factors.agg(F.max("part")).first()[0] or 0
    while last > 0:
        factors = factors.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(merged, schema)
        last //= FAN_IN
    top = factors.first()
    return np.array(top["r"]).reshape(width, width) if top else np.zeros((width, width))


def fit_whitening(fit: DataFrame, width: int, components: int) -> Whitening:
    """Fit on a table of distinct ``x``; ``width`` is their length."""
    n, sums = _sums(fit, width)
    if n == 0 or width == 0:
        return Whitening(0, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    values, directions, kept = right_singular(_factor(fit, n, sums), components)
    return Whitening(n, sums, directions, kept ** 2 / n, float((values ** 2).sum() / n))


def whiten(x: np.ndarray, w: Whitening) -> np.ndarray:
    return _centred(x, w.n, w.sums) @ (w.directions / np.sqrt(w.eigenvalues))


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity)."""
    width, k = len(w.sums), len(w.eigenvalues)
    if k == 0:
        return 0.0

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            z = whiten(_matrix(batch.column(0), width), w)
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], names=["i", "v"])

    products = fit.select("x").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    covariance = np.zeros(k * k)
    for r in products:
        covariance[r["i"]] = r["v"] / w.n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())


def _deviations(x: np.ndarray, w: Whitening) -> list[int | None]:
    d = _scaled(x, w.n, w.sums)
    if d.dtype != object and (not len(d) or float(np.abs(d).max()) ** 2 * d.shape[1] < 2.0 ** 62):
        return (d * d).sum(axis=1).tolist()
    exact = [sum(v * v for v in row) for row in d.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whitened_rows(vectors: DataFrame, w: Whitening, error: float) -> DataFrame:
    """One row per row of ``vec_id, x`` and component."""
    width, k = len(w.sums), len(w.eigenvalues)
    explained = w.eigenvalues / w.trace if k else np.zeros(0)
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if k == 0:
        return vectors.sparkSession.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), width)
            if not len(x):
                continue
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, w.n)),
                pa.array(_deviations(x, w), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(whiten(x, w).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error))], names=schema.fieldNames())

    return vectors.mapInArrow(run, schema)


def _width(fit: DataFrame) -> int:
    """The commonest length, the longer at a tie; 0 for an empty table."""
    lengths = fit.groupBy(F.size("x").alias("size")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return top["size"] if top else 0


def whitened_embeddings(rows: DataFrame, components: int = 16, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and component."""
    vectors = integer_vectors(rows, vec_id, vector)
    distinct = staged(vectors.select("x").distinct(), "vectors")
    width = _width(distinct)
    fit = distinct.where(F.size("x") == width)
    w = fit_whitening(fit, width, components)
    return whitened_rows(vectors.where(F.size("x") == width), w, identity_error(fit, w))
