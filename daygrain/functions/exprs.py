"""Small expression helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share(part: Column | str, whole: Column | str) -> Column:
    """``part / nullif(whole, 0)`` as double (null for empty)."""
    whole = _c(whole)
    return _c(part).cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def pct_change(recent: Column, base: Column) -> Column:
    """Percent change from ``base`` to ``recent``, null unless base > 0."""
    return F.when(
        base > 0, ((recent - base).cast("double") / base.cast("double")) * 100
    )


def empty_string_array() -> Column:
    """The typed empty list literal."""
    return F.array().cast("array<string>")


def strip_thousands(c: Column | str) -> Column:
    """``'1,234'`` -> 1234 as bigint."""
    return F.replace(_c(c), F.lit(","), F.lit("")).cast("bigint")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; used where results are compared across engines."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DoubleType):
            cols.append(F.round(F.col(f"`{field.name}`"), digits).alias(field.name))
        else:
            cols.append(F.col(f"`{field.name}`"))
    return df.select(*cols)
