"""Sinks and consumer reads."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text layout of exported timestamps, as the reference's CSV copy writes them.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def materialize(
    df: DataFrame, path: str, partition_by: list[str] | None = None, replace: str = "table", gather: bool = True
) -> DataFrame:
    """Overwrite ``path`` with ``df`` as Parquet and continue from the written table.

    ``replace="partitions"`` overwrites only the partitions that ``df`` has
    rows for and leaves the others as they are (a rebuild of one year).  With
    ``gather`` the rows of a partition are brought together first, so a year
    is not cut into a file per task; adaptive execution splits a large one.
    """
    if replace not in ("table", "partitions") or (replace == "partitions" and not partition_by):
        raise ValueError(f"replace {replace!r} with partitions {partition_by!r}")
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    mode = "dynamic" if replace == "partitions" else "static"
    dealt = df.hint("rebalance", *partition_by) if gather else df
    dealt.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned table with the columns and types it was written from (folder names carry no types)."""
    free = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return spark.read.schema(free).parquet(path).select(*schema.names)


def export_csv(df: DataFrame, path: str, order_by: str | None = None, single_file: bool = True) -> None:
    """Header CSV export of a mart.

    Marts hold one row per day / week / month, so a single ordered file is
    small; pass ``single_file=False`` for anything that grows with the data.
    """
    out = df.orderBy(F.col(order_by).asc_nulls_last()) if order_by else df
    if single_file:
        out = out.coalesce(1)
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_exported_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read an exported mart back with its declared schema (never inferred)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_mart(
    spark: SparkSession, path: str, key: str, since: str | _dt.date | None = None, year: str | None = None
) -> DataFrame:
    """Consumer query; the date predicate is pushed into the Parquet scan.

    ``year`` names the column by which the table is partitioned, the calendar
    year of ``key``: the predicate then also prunes the folders of earlier years.
    """
    df = spark.read.parquet(path)
    if since is not None:
        first = F.lit(since).cast(df.schema[key].dataType)
        df = df.filter(F.col(key) >= first)
        if year is not None:
            df = df.filter(F.col(year) >= F.year(first))
    return df.orderBy(F.col(key).asc_nulls_last())
