"""Calendar inputs for the driver's 1995-2001 trip range.

The reference ships two seed CSVs for 2019-2024.  The driver data covers
1995-2001, so the calendars used with it are authored here by rule, in the
same raw text layouts as the seeds (``DD/MM/YYYY`` dates; ``"Mar, 2020"``
months with thousands separators), and go through the same staging code
as a seed file read with ``sources.files.load_seed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import HOLIDAY_SEED_DDL, RESTRICTION_SEED_DDL

FIRST_YEAR, LAST_YEAR = 1995, 2001

# Fixed-date holidays (name, day, month), one row per year each.
FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1),
    ("Canada Day", 1, 7),
    ("Remembrance Day", 11, 11),
    ("Christmas Day", 25, 12),
    ("Boxing Day", 26, 12),
]
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def holiday_rows() -> list[tuple[str, str]]:
    """Holiday seed rows; one date appears twice, as in the reference seed."""
    rows = [
        (name, f"{day:02d}/{month:02d}/{y}")
        for y in range(FIRST_YEAR, LAST_YEAR + 1)
        for name, day, month in FIXED_HOLIDAYS
    ]
    rows.append(("Boxing Day (observed)", "26/12/1999"))
    return rows


def _thousands(n: int) -> str:
    return f"{n:,}"


def restriction_rows() -> list[tuple]:
    """Monthly restriction calendar Mar 1997 - Sep 2000; restrictions on
    through Sep 1999, off afterwards (so later months default to false)."""
    rows = []
    for i in range(43):
        y, m = 1997 + (2 + i) // 12, (2 + i) % 12 + 1
        on = (y, m) <= (1999, 9)
        rows.append(
            (
                f"{MONTH_ABBR[m - 1]}, {y}",
                _thousands(500 + 137 * i),
                str(90 + 11 * i) if i % 3 else _thousands(1000 + 29 * i),
                str(40 + 7 * i),
                _thousands(9000 + 311 * i),
                1 if on else 0,
            )
        )
    return rows


def _sql_literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small inline table as a SQL ``VALUES`` relation.

    Unlike ``createDataFrame`` (an RDD of unknown size), a ``VALUES``
    relation carries its exact size, so the planner broadcasts it on its own.
    """
    schema = T.StructType.fromDDL(ddl)
    names = [f.name for f in schema.fields]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def holiday_seed(spark: SparkSession) -> DataFrame:
    return local_table(spark, holiday_rows(), HOLIDAY_SEED_DDL)


def restriction_seed(spark: SparkSession) -> DataFrame:
    return local_table(spark, restriction_rows(), RESTRICTION_SEED_DDL)
