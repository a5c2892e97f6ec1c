"""Left equi-joins of the reference (J1-J8) with size-checked broadcasts.

Every dimension of the reference (stations, one weather row per day,
holiday and restriction calendars) is bounded by the number of stations or
calendar days, not by trip volume.  Two cases:

* a trip-sized table joined to a dimension (T10's role joins): the
  dimension is broadcast when the plan's size estimate (bytes of the files
  below it) is within ``BROADCAST_MAX_BYTES``.  A derived dimension keeps
  its input's size in that estimate (one weather row per day that of all
  orders), and a shuffle join moves every enriched trip; so a dimension
  beyond the bound is written once to the shared folder and decided by the
  rows it really has (``settled``).  Beyond the bound by rows too, the join
  is a shuffle join, where adaptive execution splits skewed partitions;
* a day-level table joined to a day-level dimension (calendar flags, weather
  after aggregation): both sides hold thousands of rows; Spark's own size
  estimate and adaptive execution's runtime statistics choose the strategy,
  without an extra job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..session import cut_lineage

# Estimated bytes a dimension may have and still be broadcast.
BROADCAST_MAX_BYTES = 64 << 20


def within_bytes(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when the optimizer's size estimate of ``df`` is at most ``max_bytes`` (no job)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= max_bytes


def size_checked(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(dim)`` when its estimated size is small, else ``dim``."""
    return F.broadcast(dim) if within_bytes(dim, max_bytes) else dim


def rows_within_bytes(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when the rows that ``df`` really has, each as wide as its schema, take at most ``max_bytes`` (one count)."""
    return df.count() * (8 + int(df._jdf.schema().defaultSize())) <= max_bytes


def settled(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """``dim`` and whether it is small enough to broadcast.

    Where the plan's estimate says no, ``dim`` is written (the join would
    compute it anyway, and reads the written table) and its rows are counted.
    """
    if within_bytes(dim, max_bytes):
        return dim, True
    written = cut_lineage(dim, "table")
    return written, rows_within_bytes(written, max_bytes)


def duplicated_keys(df: DataFrame, key: Sequence[Column | str]) -> DataFrame:
    """Key values that occur more than once (nulls count as a key)."""
    return df.groupBy(*key).count().filter(F.col("count") > 1).select(F.lit(1).alias("dup"))


def is_keyed(df: DataFrame, key: Sequence[Column | str]) -> bool:
    """Q2 as a predicate: no two rows share ``key``."""
    return duplicated_keys(df, key).limit(1).count() == 0


def all_keyed(*checks: tuple[DataFrame, Sequence[Column | str]]) -> bool:
    """``is_keyed`` for several tables in one Spark job."""
    dups = [duplicated_keys(df, key) for df, key in checks]
    u = dups[0]
    for d in dups[1:]:
        u = u.unionByName(d)
    return u.limit(1).count() == 0


# Fixed values that must equal the reference: the columns each role keeps.
STATION_ROLE_COLUMNS = [
    "name", "physical_configuration", "lat", "lon", "address", "capacity",
    "is_charging_station", "rental_methods", "groups", "obcn", "short_name", "nearby_distance",
]

WEATHER_ROLE_COLUMNS = [
    "longitude", "latitude", "station_name", "climate_id", "date_time", "year", "month", "day",
    "max_temp_c", "min_temp_c", "mean_temp_c", "total_precip_mm", "snow_on_grnd_cm",
]

TRIP_KEEP_COLUMNS = [
    "trip_id", "trip_duration", "start_station_id", "start_time",
    "end_station_id", "end_time", "bike_id", "user_type",
]


def role_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: Column,
    dim_key: Column,
    prefix: str,
    cols: Sequence[str],
    max_bytes: int = BROADCAST_MAX_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """J2 / J3 / J4 + P8: left-join one role of a dimension, prefixing its columns.

    ``dim_key`` is evaluated on the dimension side, so the implicit cast of
    the start role (text station id compared with a bigint) is computed once
    per dimension row; under ANSI a non-numeric id fails the job.  The end
    role compares text with text.  Right-side duplicates fan out, as in SQL.
    ``small`` passes a size decision already made for ``dim``.
    """
    tag = f"_{prefix}key"
    side = dim.select(dim_key.alias(tag), *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    if small is None:
        small = within_bytes(side, max_bytes)
    side = F.broadcast(side) if small else side
    return facts.join(side, fact_key == F.col(tag), "left").drop(tag)


def enrich_trips(trips: DataFrame, stations: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips with start-station, end-station and weather roles (45 columns)."""
    t = trips.select(*TRIP_KEEP_COLUMNS)
    stations, small = settled(stations)  # one decision for both station roles
    t = role_join(t, stations, F.col("start_station_id"), F.col("station_id").cast("bigint"), "start_station_",
                  STATION_ROLE_COLUMNS, small=small)
    t = role_join(t, stations, F.col("end_station_id"), F.col("station_id"), "end_station_",
                  STATION_ROLE_COLUMNS, small=small)
    weather, small = settled(weather.select(*WEATHER_ROLE_COLUMNS))
    return role_join(t, weather, dates.to_day("start_time"), F.to_date("date_time"), "weather_", WEATHER_ROLE_COLUMNS,
                     small=small)


def holiday_flag(df: DataFrame, date_col: str, holidays: DataFrame, out: str = "is_holiday") -> DataFrame:
    """J7 + A25 + F6: ``is_holiday`` from a left join on the distinct holiday dates."""
    h = holidays.select(F.col("holiday_date").alias("_hday")).distinct()
    joined = df.join(h, F.col(date_col) == F.col("_hday"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_hday").isNotNull(), F.lit(False))).drop("_hday")


def restriction_flag(
    df: DataFrame, date_col: str, restrictions: DataFrame, out: str = "has_covid_restrictions"
) -> DataFrame:
    """Monthly flag joined on (year, month) of the day; missing -> false."""
    r = restrictions.select(
        F.col("restrictions").alias("_rflag"),
        dates.year("report_date").alias("_ry"),
        dates.month("report_date").alias("_rm"),
    )
    cond = (dates.year(date_col) == F.col("_ry")) & (dates.month(date_col) == F.col("_rm"))
    joined = df.join(r, cond, "left")
    return joined.withColumn(out, F.coalesce(F.col("_rflag"), F.lit(False))).drop("_rflag", "_ry", "_rm")
