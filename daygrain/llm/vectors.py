"""Helpers of the embedding operators: finite vectors as integer matrices."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest magnitude of an integer component; beyond, ``scaled`` raises.
LARGEST = 1 << 62


def finite(vectors: DataFrame, vec_col: str, carry: dict[str, str]) -> DataFrame:
    """``carry`` columns (new name: old name) and ``v``, an array of doubles, of the rows whose vector is whole.

    Rows whose vector is null, or holds a null or a non-finite component, go.
    """
    x = F.col(f"`{vec_col}`").cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = vectors.where(x.isNotNull() & whole)
    return rows.select(*[F.col(f"`{old}`").alias(new) for new, old in carry.items()], x.alias("v"))


def matrix(column: pa.ListArray, dims: int | None = None) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    dims = int(lengths.max(initial=0)) if dims is None else dims
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers; raises where one does not fit."""
    whole = np.floor(values * float(scale))
    if whole.size and float(np.abs(whole).max()) >= LARGEST:
        raise ValueError(f"a component times {scale} does not fit 62 bits")
    return whole.astype(np.int64)


def span(*arrays: np.ndarray) -> int:
    """Largest magnitude, as a Python integer."""
    return max([0, *(max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size)])


def widened(a: np.ndarray, bound: int) -> np.ndarray:
    """``a``, or the same as Python integers where results up to ``bound`` would not fit 64 bits."""
    return a if bound < 1 << 63 else a.astype(object)


def decimals(values) -> pa.Array:
    """Integers of any size up to 38 digits."""
    values = np.asarray(values)
    if values.dtype != object:
        return pa.array(values).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(int(x)) for x in values], pa.decimal128(38, 0))
