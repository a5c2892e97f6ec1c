"""Data-quality checks (Q1-Q5) as one report DataFrame.

``not_null`` checks of a table are computed in a single aggregation pass
(one ``count_if(c IS NULL)`` per column, unpivoted with ``stack``);
each ``unique`` key is one grouped aggregation (partial aggregation first,
so a repeated key costs one row per task before the shuffle); referential
checks are left-anti joins.  The result has one row per check:
``(table_name, column_name, check_name, violations)``.

``observe_checks`` and ``observe_reasons`` take the same numbers from the job
that writes a table, so nothing is read again.  The metrics stand in the
write's last stage, where each task counts once however often it is tried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

REPORT_COLUMNS = ["table_name", "column_name", "check_name", "violations"]


def _lit_sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q1: ``(column_name, violations)``, one row per column, one pass over ``df``."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = ", ".join(f"{_lit_sql(c)}, n{i}" for i, c in enumerate(columns))
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, violations)")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q2: number of key values (nulls excluded) that occur more than once."""
    k = [F.col(f"`{c}`") for c in key]
    not_null = F.lit(True)
    for c in k:
        not_null = not_null & c.isNotNull()
    dup = df.filter(not_null).groupBy(*k).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("violations"))


def orphans(df: DataFrame, column: str, dim: DataFrame, dim_column: str) -> DataFrame:
    """Q3: rows whose non-null ``column`` has no match in ``dim``."""
    keys = dim.select(F.col(dim_column).alias("_ref"))
    facts = df.select(F.col(column).alias("_fk")).filter(F.col("_fk").isNotNull())
    missing = facts.join(keys, F.col("_fk") == F.col("_ref"), "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("violations"))


def quality_report(
    df: DataFrame,
    table: str,
    not_null: Iterable[str] = (),
    unique: Iterable[str | Sequence[str]] = (),
    refs: Iterable[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """Q1-Q3 for one table as a report DataFrame (lazy)."""
    parts: list[DataFrame] = []
    nn = list(not_null)
    if nn:
        parts.append(
            null_counts(df, nn).select(
                F.lit(table).alias("table_name"), "column_name",
                F.lit("not_null").alias("check_name"), F.col("violations").cast("bigint"),
            )
        )
    for key in unique:
        cols = [key] if isinstance(key, str) else list(key)
        parts.append(
            duplicate_keys(df, cols).select(
                F.lit(table).alias("table_name"), F.lit(",".join(cols)).alias("column_name"),
                F.lit("unique").alias("check_name"), F.col("violations").cast("bigint"),
            )
        )
    for column, dim, dim_column in refs:
        parts.append(
            orphans(df, column, dim, dim_column).select(
                F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                F.lit("relationships").alias("check_name"), F.col("violations").cast("bigint"),
            )
        )
    if not parts:
        raise ValueError("no checks requested")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observe_checks(
    df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str | Sequence[str]] = ()
) -> tuple[DataFrame, Callable[[], list[tuple[str, str, int]]]]:
    """Q1 + Q2 measured while ``df`` is written.

    Returns the frame to write and a function that gives ``(column, check,
    violations)`` once it is written (it waits for that).  Not-null checks are
    one counter each.  A key counts as violated where a second row of it
    passes, which takes a window by that key in the written plan (nulls
    excluded): meant for the keys of period tables and calendars.
    """
    if not not_null and not unique:
        return df, list
    watched, metrics, names = df, [], []
    for i, c in enumerate(not_null):
        metrics.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}"))
        names.append((f"n{i}", c, "not_null"))
    for i, key in enumerate(unique):
        cols = [key] if isinstance(key, str) else list(key)
        known = F.lit(True)
        for c in cols:
            known = known & F.col(f"`{c}`").isNotNull()
        by = [F.col(f"`{c}`") for c in cols]
        watched = watched.withColumn(f"__place{i}", F.row_number().over(Window.partitionBy(*by).orderBy(*by)))
        metrics.append(F.count_if(known & (F.col(f"__place{i}") == 2)).alias(f"u{i}"))
        names.append((f"u{i}", ",".join(cols), "unique"))
    seen = Observation()
    watched = watched.observe(seen, *metrics).select(*[F.col(f"`{c}`") for c in df.columns])
    return watched, lambda: [(column, check, int(seen.get[name])) for name, column, check in names]


def observe_reasons(df: DataFrame, column: str, reasons: Sequence[str]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """Rows per value of ``column`` (one of ``reasons``, or null: not counted), measured while ``df`` is written."""
    seen = Observation()
    counts = [F.count_if(F.col(column) == reason).alias(f"r{i}") for i, reason in enumerate(reasons)]
    return df.observe(seen, *counts), lambda: {reason: int(seen.get[f"r{i}"]) for i, reason in enumerate(reasons)}


def period_coverage(table: DataFrame, key: str, days_col: str) -> DataFrame:
    """Q5: observed days per period next to the calendar length of the period."""
    k = F.col(key)
    if days_col == "days_in_week":
        nominal = F.lit(7).cast("bigint")
    else:
        nominal = F.dayofmonth(F.last_day(k)).cast("bigint")
    return table.select(
        k, F.col(days_col).alias("observed_days"), nominal.alias("calendar_days"),
        (F.col(days_col) < nominal).alias("incomplete"),
    )
