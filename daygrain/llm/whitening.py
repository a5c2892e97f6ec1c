"""Embedding whitening from polarisation covariances.

Entries become integers, ``x = floor(scale * c) + offset``.  With
``Var(X_i + X_j) - Var(X_i) - Var(X_j) = 2 Cov(X_i, X_j)`` squares alone give
every covariance:

1. ``fit`` sums every dimension and counts the rows (one row per task and
   dimension), which gives the mean and, rounded, an integer centre.
2. Centred entries are small integers.  Every task adds up their squares for
   each dimension and for the sum of each pair of dimensions, exactly; Spark
   adds the tasks' rows.  What is left of the mean after rounding is taken
   off exactly, so the variances are those around the true mean.
3. Differences of variances recover the cross-covariances as exact
   fractions, rounded once to double, and ``eigh`` runs on the driver.
4. ``transform`` projects the centred rows on the components and divides by
   the root of the eigenvalue.

What reaches the driver is bounded by the dimensions: ``d * (d + 1) / 2``
numbers whatever the rows.  Lost executors cost their tasks only: each step
is one pass over the vectors.

Defined cases: rows whose vector is null or holds null or non-finite entries
take no part; shorter vectors end in zeros up to the longest one; rows that
repeat an id, or lack one, each count and stay; components whose eigenvalue
is numerically zero (rank-deficient tables, constant dimensions, one row)
have no whitened form and are left out, so such tables may give no rows; an
empty table gives an empty result; entries beyond 62 bits raise; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectors import decimals, finite, matrix, scaled, span, widened

#: Entries (rows x dimensions) squared at a time.
STEP = 1 << 19


@dataclass(frozen=True)
class Whitening:
    """A fitted model.  ``centre`` are the rounded means, ``rest`` the sums of the centred entries."""

    scale: int
    offset: int
    n: int
    centre: np.ndarray
    rest: tuple[int, ...]
    covariance: np.ndarray
    values: np.ndarray
    components: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.centre)

    @property
    def rank(self) -> int:
        """Components whose eigenvalue is not numerically zero."""
        return int((self.values > max(1, self.dims) * np.finfo(float).eps * self.values.max(initial=0.0)).sum())

    def centred(self, values: np.ndarray) -> np.ndarray:
        return scaled(values, self.scale) + self.offset - self.centre

    def whitened(self, z: np.ndarray, k: int) -> np.ndarray:
        mean = np.array([r / self.n for r in self.rest])
        return (z - mean) @ self.components[:, :k] / np.sqrt(self.values[:k])

    def deviations(self, z: np.ndarray) -> np.ndarray:
        """Per row the exact sum over dimensions of ``(n * x - S) ** 2``."""
        rest = np.array(self.rest, dtype=object)
        far = self.n * span(z) + max((abs(r) for r in self.rest), default=0)
        z, rest = (z, rest.astype(np.int64)) if far * far * max(1, self.dims) < 1 << 63 else (z.astype(object), rest)
        return ((z * self.n - rest) ** 2).sum(axis=1)


def _sums(rows: DataFrame, scale: int, offset: int) -> dict[int, tuple[int, int]]:
    """Per dimension the rows that have it and their sum; under -1 all rows."""

    def run(batches):
        count, totals, have = 0, np.zeros(0, object), np.zeros(0, np.int64)
        for batch in batches:
            lengths = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            m = scaled(matrix(batch.column("v")), scale) + offset
            m[np.arange(m.shape[1]) >= lengths[:, None]] = 0
            if m.shape[1] > len(totals):
                more = m.shape[1] - len(totals)
                totals, have = np.append(totals, np.zeros(more, object)), np.append(have, np.zeros(more, np.int64))
            totals[: m.shape[1]] += widened(m, span(m) * len(m)).sum(axis=0)
            have[: m.shape[1]] += (np.arange(m.shape[1]) < lengths[:, None]).sum(axis=0)
            count += len(m)
        dims = pa.array(range(-1, len(totals)), pa.int32())
        counts, sums = pa.array([count, *have.tolist()], pa.int64()), decimals(np.append(np.zeros(1, object), totals))
        yield pa.RecordBatch.from_arrays([dims, counts, sums], names=["d", "rows", "total"])

    found = rows.mapInArrow(run, "d int, rows long, total decimal(38,0)").groupBy("d")
    return {r["d"]: (r["rows"], int(r["t"])) for r in found.agg(F.sum("rows").alias("rows"), F.sum("total").alias("t")).collect()}


def square_sums(z: np.ndarray) -> np.ndarray:
    """Sums over the rows of ``z_i ** 2`` and, for i < j, of ``(z_i + z_j) ** 2``, in the order of ``triu_indices``."""
    dims = z.shape[1]
    out = np.zeros(dims * (dims + 1) // 2, object)
    step = max(1, STEP // max(1, dims))
    for a in range(0, len(z), step):
        part = z[a : a + step]
        part = widened(part, (2 * span(part)) ** 2 * len(part))
        at = 0
        for i in range(dims):
            both = part[:, i:] + part[:, i : i + 1]
            both[:, 0] = part[:, i]
            out[at : at + dims - i] += (both * both).sum(axis=0)
            at += dims - i
    return out


def _square_sums(rows: DataFrame, scale: int, offset: int, centre: np.ndarray) -> dict[tuple[int, int], int]:
    first, second = (x.astype(np.int32) for x in np.triu_indices(len(centre)))

    def run(batches):
        total = np.zeros(len(first), object)
        for batch in batches:
            total += square_sums(scaled(matrix(batch.column("v"), len(centre)), scale) + offset - centre)
        yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), decimals(total)], names=["i", "j", "total"])

    found = rows.mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("t"))
    return {(r["i"], r["j"]): int(r["t"]) for r in found.collect()}


def covariance(n: int, rest, squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances (divisor n) from the squares of centred entries and of pair sums, rounded once."""
    dims = len(rest)
    # n * n * variance, exact
    alone = [n * squares[i, i] - rest[i] ** 2 for i in range(dims)]
    out = np.empty((dims, dims))
    for i in range(dims):
        out[i, i] = alone[i] / (n * n)
        for j in range(i + 1, dims):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - alone[i] - alone[j]) // 2 / (n * n)
    return out


def fit(vectors: DataFrame, vec_col: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> Whitening:
    """The model of all whole vectors of the table."""
    rows = finite(vectors, vec_col, {})
    found = _sums(rows, scale, offset)
    n = found.pop(-1, (0, 0))[0]
    # what a shorter vector lacks counts as zero, hence as the offset
    sums = [found[d][1] + offset * (n - found[d][0]) for d in range(len(found))]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = tuple(s - n * c for s, c in zip(sums, centre, strict=True))
    at = np.array(centre, np.int64)
    v = covariance(n, rest, _square_sums(rows, scale, offset, at)) if sums else np.zeros((0, 0))
    values, components = np.linalg.eigh(v) if sums else (np.zeros(0), v)
    order = np.argsort(-values, kind="stable")
    return Whitening(scale, offset, n, at, rest, v, values[order], components[:, order])


def identity_error(vectors: DataFrame, model: Whitening, k: int, vec_col: str = "embedding") -> float:
    """Largest entry of the whitened rows' covariance minus the identity, from the rows themselves."""
    if not k:
        return 0.0

    def run(batches):
        sums, squares = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whitened(model.centred(matrix(batch.column("v"), model.dims)), k)
            sums += w.sum(axis=0)
            squares += w.T @ w
        cells = np.concatenate([sums[:, None], squares], axis=1)
        i, j = np.indices(cells.shape).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(cells.ravel())], names=["i", "j", "total"])

    found = finite(vectors, vec_col, {}).mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("t"))
    cells = np.zeros((k, k + 1))
    for r in found.collect():
        cells[r["i"], r["j"]] = r["t"] / model.n
    mean = cells[:, 0]
    return float(np.abs(cells[:, 1:] - np.outer(mean, mean) - np.eye(k)).max())


def transform(vectors: DataFrame, model: Whitening, k: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per whole vector and component.

    ``deviation`` is a decimal of 38 digits: the exact value may exceed 64 bits.
    """
    k = min(k, model.rank)
    error = identity_error(vectors, model, k, vec_col)
    rows = finite(vectors, vec_col, {"id": id_col})
    trace = float(np.trace(model.covariance))
    explained = model.values[:k] / trace if k else np.zeros(0)
    kinds = [T.StructField(id_col, rows.schema["id"].dataType)]
    kinds += [T.StructField(c, t) for c, t in (("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.DecimalType(38, 0)))]
    kinds += [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]

    def run(batches):
        for batch in batches:
            z = model.centred(matrix(batch.column("v"), model.dims))
            each = pa.array(np.repeat(np.arange(len(z)), k))
            columns = [batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z)))]
            columns += [pa.array(np.full(len(each), model.n, np.int64)), decimals(model.deviations(z)).take(each)]
            columns += [pa.array(model.whitened(z, k).ravel()), pa.array(np.tile(explained, len(z))), pa.array(np.full(len(each), error))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kinds])

    return rows.mapInArrow(run, T.StructType(kinds))
