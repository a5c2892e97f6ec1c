"""Helpers shared by the operators: words, hashes, a bounded bit filter, tables.

Words are the runs of characters outside ``[\\x20\\x09-\\x0D]``.  On UTF-8
bytes that is exactly ``bytes.split()``, and ``bytes.lower()`` lower-cases
A-Z alone, so both need no regular expression.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..session import scratch_path

WHITE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def encode(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def hash_words(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(seed)), np.uint64, len(words))


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values of ``x``, ascending."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX_A
        x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` consecutive word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = out * _GOLDEN + h[i : i + n]
            out ^= out >> np.uint64(29)
    return mix64(out)


def small_batches(batches, column: str = "text", limit: int = 4 << 20):
    """The same rows in batches of about ``limit`` text bytes: bounds a task's memory when texts are long."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
    release()


def release() -> None:
    """Give a worker's free memory back at the end of a task: workers stay alive between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def write_read(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder the cluster names."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``name``: a long of its own for every row, the same however often the rows are read.

    Rows of plain Parquet files are numbered by file and place in it, which
    costs a scan of the files' names; all others are written with a number.
    """
    spark = docs.sparkSession
    if not _plain_files(docs):
        return write_read(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    paths = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
    files = spark.createDataFrame([(path, i << 40) for i, path in enumerate(paths)], "__path string, __first long")
    placed = docs.select(*docs.columns, F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__place"))
    return placed.join(F.broadcast(files), "__path").select(*docs.columns, (F.col("__first") + F.col("__place")).alias(name))


def _plain_files(docs: DataFrame) -> bool:
    """True where every row is read straight from its own place in a Parquet file (no file is listed twice)."""
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation" or "_metadata" in docs.columns:
        return False
    relation = plan.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation" or relation.fileFormat().getClass().getSimpleName() != "ParquetFileFormat":
        return False
    paths = list(relation.location().inputFiles())
    return len(set(paths)) == len(paths)


def first_by_hash(rows: DataFrame, k: int) -> list[Row]:
    """Per group (``grp``, never null) the first ``k`` rows by hash (``h``), ties by the other columns, with their rank ``r``.

    Rows are counted per group first, and only those below a hash bound sized
    for about ``4 * k`` of a group are ranked: what reaches a task does not
    grow with the number of tasks.  A group with fewer than ``k`` rows below
    its bound (hashes that repeat) is ranked again below a wider one.
    """
    totals = {r["grp"]: r["n"] for r in rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {g: 4 * k / n for g, n in totals.items()}
    order = Window.partitionBy("grp").orderBy("h", *[c for c in rows.columns if c not in ("grp", "h")])
    out: list[Row] = []
    while share:
        limits = {g: int((min(s, 1.0) - 0.5) * (1 << 62)) * 4 for g, s in share.items()}
        bound = F.element_at(F.create_map(*[F.lit(x) for g, b in limits.items() for x in (g, min(b, (1 << 63) - 1))]), F.col("grp"))
        below = rows.where(F.col("h") <= bound).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).collect()
        for g in list(share):
            got = [r for r in below if r["grp"] == g]
            if len(got) >= min(k, totals[g]):
                out += got
                del share[g]
            else:
                share[g] = 1.0 if share[g] > 1 / 16 else share[g] * 16
    return out


class BitFilter:
    """A Bloom filter of fixed size: no false negatives, bounded whatever the input."""

    def __init__(self, words: np.ndarray, log2_bits: int):
        self.words, self.mask = words, np.uint64((1 << log2_bits) - 1)

    def __contains__(self, value) -> bool:
        return bool(self.test(np.array([value], np.uint64))[0])

    def test(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for shift in (0, 32):
            at = (hashes >> np.uint64(shift)) & self.mask
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def bit_filter(df: DataFrame, column: str, log2_bits: int = 24) -> BitFilter:
    """Collect a filter over the 64-bit hashes in ``column`` (at most 2**log2_bits bits).

    The bits are or-ed by Spark, so the driver receives at most
    ``2**log2_bits / 64`` longs (2 MB at the default).  A full filter lets
    everything through: it only ever saves traffic, never decides a result.
    """
    mask = (1 << log2_bits) - 1
    h = F.col(column)
    at = F.explode(F.array(h.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(mask))))
    one = F.lit(1).cast("long")
    bits = (
        df.select(at.alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", one, F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    )
    words = np.zeros(1 << max(0, log2_bits - 6), np.uint64)
    got = bits.toPandas()
    words[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return BitFilter(words, log2_bits)
