"""Embedding whitening: float32 eigenvectors of a distributed covariance, refined to double precision.

1. Entries become whole numbers ``floor(cells * c) + OFFSET``; each distinct vector of them is fitted once.
2. Count and sums come from exact integer sums, the covariance from products of centred entries; tasks send one
   square matrix each, which Spark adds up entry by entry. Only a matrix of dimension x dimension reaches the driver.
3. Eigenvectors are found in float32 and corrected by Ogita-Aishima iterations: matrix products in extended precision
   give each vector's share of the others' errors, and the number of right digits doubles with each round. The formula
   divides by the gaps of eigenvalues, so vectors whose eigenvalues lie closer together than the present error are
   solved apart: their space is projected on the matrix shifted by their mean eigenvalue, solved and turned.
4. Rows are centred and projected where they lie; the covariance of the result is measured on the fitted vectors.

Defined results: rows take no part if the vector is null or empty, holds null or non-finite entries or ones whose
cell lies beyond 2**52, or has not the commonest length (the longer one on a tie) of all distinct vectors; repeated
rows each get their result; a null vec_id is carried along; without rows there is no result; components without variance
(below 1e-12 of the largest) have a null whitened value and don't count in the identity error, which is null if there is
none; explained is null if there is no variance at all; a deviation beyond the range of long is null. Other columns are
carried along by ``whiten``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import through_table

CELLS, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Entries beyond this have no exact cell.
LARGEST = float(1 << 52)
#: Components below this share of the largest eigenvalue have no variance that double precision could tell from none.
FLAT = 1e-12
ROUNDS = 30
#: Eigenvalues closer together than this many times the present error are solved apart: corrections stay small.
CLOSE = 1e3


def usable(vector: Column) -> Column:
    """Vectors with entries, none of them null or not finite."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, entry), F.lit(False))


def cells_of(vector: Column, cells: int = CELLS) -> Column:
    """The vector in whole cells; null if the vector takes no part."""
    wide = vector.cast("array<double>")
    fits = usable(wide) & F.forall(wide, lambda c: F.abs(c) < LARGEST / cells)
    return F.when(fits, F.transform(wide, lambda c: F.floor(c * cells) + F.lit(OFFSET).cast("long")))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column without nulls, all of the same length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _added(fit: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], empty: np.ndarray, kind: str) -> np.ndarray:
    """The sum over all vectors of what ``part`` makes of a batch: one row an entry and task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = empty
        for batch in batches:
            if len(batch):
                total = total + part(matrix(batch.column(0), dim))
        values = total.reshape(-1)
        at = pa.array(np.arange(len(values), dtype=np.int32))
        held = pa.array([str(v) for v in values]) if kind == "decimal(38,0)" else pa.array(values.astype(np.float64))
        yield pa.RecordBatch.from_arrays([at, held], names=["at", "value"])

    sent = "string" if kind == "decimal(38,0)" else "double"
    rows = fit.select("x").mapInArrow(run, f"at int, value {sent}")
    found = rows.groupBy("at").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()  # one row an entry
    out = empty.copy().reshape(-1)
    for r in found:
        out[r["at"]] = int(r["value"]) if kind == "decimal(38,0)" else r["value"]
    return out.reshape(empty.shape)


def _whole_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns, as Python numbers."""
    safe = np.abs(x).max() < (1 << 62) // len(x)
    return x.sum(0).astype(object) if safe else x.astype(object).sum(0)


def refined(a: np.ndarray, x: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, from float32 vectors refined."""
    wide = np.longdouble
    size = float(np.abs(a).max())
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a = (a / size).astype(wide)
    a = (a + a.T) / 2
    if x is None:
        x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    x, one, reach = x.astype(wide), np.eye(len(a), dtype=wide), np.linalg.norm(a.astype(float))
    tiny = float(np.finfo(wide).eps) * len(a)
    for _ in range(ROUNDS):
        value, r, s, error = _state(a, x, one, reach)
        order = np.argsort(-value, kind="stable")
        value, x = value[order], x[:, order]
        r, s = r[np.ix_(order, order)], s[np.ix_(order, order)]
        gaps = value[:-1] - value[1:]
        edges = np.concatenate(([0], np.flatnonzero(gaps > CLOSE * error) + 1, [len(a)]))
        turned = False
        for lo, hi in zip(edges[:-1], edges[1:]):
            inner = s[lo:hi, lo:hi] - np.diag(np.diag(s[lo:hi, lo:hi]))
            if hi - lo > 1 and np.abs(inner).max() > tiny:
                x[:, lo:hi] = _turned(a, x[:, lo:hi], one)
                turned = True
        if turned:
            value, r, s, error = _state(a, x, one, reach)
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > CLOSE * error
        step = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ step
        if np.abs(step).max() <= tiny and not turned:
            break
    value = np.diag(_state(a, x, one, reach)[2]) / np.sum(x * x, axis=0)
    order = np.argsort(-value, kind="stable")
    x = x[:, order].astype(float)
    x *= np.sign(x[np.abs(x).argmax(0), np.arange(len(a))])
    return value[order].astype(float) * size, x


def _state(a: np.ndarray, x: np.ndarray, one: np.ndarray, reach: float) -> tuple[np.ndarray, ...]:
    """Eigenvalues, departures from orthogonality, the projected matrix, and a bound of the error of eigenvalues."""
    r, s = one - x.T @ x, x.T @ (a @ x)
    # Exactly symmetric: rounding on one side only, over a small gap, would cost orthogonality.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    value = np.diag(s) / (1 - np.diag(r))
    error = 2 * (np.linalg.norm((s - np.diag(value)).astype(float)) + reach * np.linalg.norm(r.astype(float)))
    # Below the precision of the matrix itself no gap means anything.
    return value, r, s, max(error, float(np.finfo(float).eps) * reach)


def _turned(a: np.ndarray, x: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Vectors of a cluster of eigenvalues, turned inside their space to where the shifted matrix is diagonal."""
    x = x + x @ (np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2
    shift = np.trace(x.T @ (a @ x)) / x.shape[1]
    inner = x.T @ (a @ x - shift * x)
    largest = np.abs(inner).max()
    if not largest:
        return x
    turn = np.linalg.eigh(((inner + inner.T) / (2 * largest)).astype(float))[1][:, ::-1].astype(x.dtype)
    turn = turn + turn @ (np.eye(len(turn), dtype=x.dtype) - turn.T @ turn) / 2
    return x @ turn


@dataclass(frozen=True)
class Whitening:
    """What a fit found; a few matrices of the vectors' dimension."""

    cells: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors as columns
    kept: int  # components that rows are projected on
    identity_error: float | None

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float | None]:
        trace = float(self.values.sum())
        return [float(v) / trace if trace > 0 else None for v in self.values[: self.kept]]

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whitened values of cells (not a number in components without variance), and the deviations as numbers."""
        near, rest = self._centre()
        d = x - near
        values, good = self.values[: self.kept], self._good()
        scale = np.where(good, 1 / np.sqrt(np.where(good, values, 1)), np.nan)
        y = (d - rest.astype(float) / self.n) @ (self.vectors[:, : self.kept] * np.where(good, scale, 0))
        y[:, ~good] = np.nan
        most = (int(np.abs(d).max()) + 1) * self.n if len(d) else 0
        if most * most * self.dim < 1 << 63:
            own = (self.n * d - rest.astype(np.int64)[None, :]).astype(np.int64)
            return y, (own * own).sum(1)
        own = self.n * d.astype(object) - rest[None, :]
        return y, (own * own).sum(1)

    def _centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers next to the mean, and n times what the mean is beyond them."""
        near = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=object)
        return near.astype(np.int64), np.array(self.sums, dtype=object) - self.n * near

    def _good(self) -> np.ndarray:
        return self.values[: self.kept] > FLAT * max(float(self.values[0]), 0.0)


def fit(vectors: DataFrame, column: str = "embedding", cells: int = CELLS, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of whole cells; None if no row takes part."""
    x = vectors.select(cells_of(F.col(column), cells).alias("x")).where("x is not null").distinct()
    held = through_table(x, "whitening-fit")
    length = held.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if length is None:
        return None
    dim, n = int(length["dim"]), int(length["count"])
    held = held.where(F.size("x") == dim)
    sums = tuple(int(s) for s in _added(held, dim, _whole_sums, np.zeros(dim, object), "decimal(38,0)"))
    start = Whitening(cells, n, sums, np.ones(dim), np.eye(dim), min(components, dim), None)
    near, rest = start._centre()
    mean = rest.astype(float) / n

    def products(x: np.ndarray) -> np.ndarray:
        d = (x - near) - mean
        return d.T @ d

    covariance = _added(held, dim, products, np.zeros((dim, dim)), "double") / n
    values, axes = refined(covariance)
    model = Whitening(cells, n, sums, values, axes, min(components, dim), None)
    good = model._good()
    if not good.any():
        return model

    def spread(x: np.ndarray) -> np.ndarray:
        y = model.project(x)[0][:, good]
        y = np.column_stack([y, np.ones(len(y))])
        return y.T @ y

    k = int(good.sum())
    total = _added(held, dim, spread, np.zeros((k + 1, k + 1)), "double") / n
    found = total[:k, :k] - np.outer(total[:k, k], total[:k, k])
    return Whitening(cells, n, sums, values, axes, model.kept, float(np.abs(found - np.eye(k)).max()))


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding", out: str = "whitened") -> DataFrame:
    """The rows with arrays of whitened values and deviations beside their own columns; null where a row takes no part."""
    own = [c for c in vectors.columns if c not in (out, "deviation")]
    rows = vectors.withColumn("__x", cells_of(F.col(column), model.cells))
    rows = rows.select(*own, F.when(F.size("__x") == model.dim, F.col("__x")).alias("__x"))
    added = [T.StructField(out, T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())]
    schema = T.StructType([*(vectors.schema[c] for c in own), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = batch.column(len(own))
            there = x.is_valid().to_numpy(zero_copy_only=False)
            y, deviation = model.project(matrix(x.filter(pa.array(there)), model.dim))
            flat = pa.array(y.reshape(-1), mask=np.isnan(y.reshape(-1)))
            ends = np.concatenate(([0], np.cumsum(there))).astype(np.int32) * model.kept
            lists = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~there, False)), flat)
            whole = [int(v) if v < 1 << 63 else None for v in deviation] if deviation.dtype == object else deviation
            places = np.cumsum(there) - 1
            at = pa.array(np.maximum(places, 0), mask=~there)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(own))), lists, pa.array(whole, pa.int64()).take(at)], names=schema.names
            )

    return rows.mapInArrow(run, schema)


def whitened_rows(vectors: DataFrame) -> DataFrame:
    """The contract's columns: one row for each usable vector and component."""
    columns = "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    model = fit(vectors)
    if model is None:
        kinds = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        schema = T.StructType([vectors.schema["vec_id"], *T.StructType.fromDDL(kinds)])
        return vectors.sparkSession.createDataFrame([], schema)
    done = whiten(vectors.select("vec_id", "embedding"), model).where("whitened is not null")
    rows = done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*(F.lit(v).cast("double") for v in model.explained))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    ).select(*columns)
