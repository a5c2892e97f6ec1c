"""Registered queries: one per operator family of SURVEY section 2.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
DuckDB SQL that computes the same result on the same parquet tables
(``None`` when the operator has no SQL form).  Double columns are rounded
to 6 digits on both sides so the cross-engine comparison is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .functions import dates
from .functions.exprs import round_doubles
from .operators import aggregate, joins, windows
from .plans import tables


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def _final(table: str, doubles) -> str:
    if not doubles:
        return f"SELECT * FROM {table}"
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM {table}"


def _sql(table: str, doubles, *needs: str) -> str:
    return oracle.with_ctes(_final(table, doubles), *(needs or (table,)))


# Double-typed output columns, per table (the rest are integers, text,
# dates or booleans and compare exactly).
DAILY_DOUBLE_BASE = [
    "annual_member_ratio__leaky", "avg_trip_duration__leaky", "median_trip_duration__leaky",
    "stddev_trip_duration__leaky", "p25_trip_duration__leaky", "p75_trip_duration__leaky",
    "avg_annual_member_duration__leaky", "avg_casual_member_duration__leaky",
    "max_temp_c", "min_temp_c", "mean_temp_c", "temp_range_c", "total_precip_mm",
]
PERIOD_DOUBLE_BASE = [
    "non_working_day_ratio", "avg_daily_trips__leaky", "annual_member_ratio__leaky",
    "unique_bikes__leaky", "unique_start_stations__leaky", "unique_end_stations__leaky",
    "avg_trip_duration__leaky", "median_trip_duration__leaky", "avg_max_temp_c", "avg_min_temp_c",
    "avg_mean_temp_c", "max_temp_c", "min_temp_c", "avg_total_precip_mm", "avg_snow_on_grnd_cm",
    "max_total_precip_mm", "min_total_precip_mm",
]


def feature_doubles(spec: windows.FeatureSpec, double_sources) -> list[str]:
    out = []
    for f in spec.features:
        if isinstance(f, windows.Change):
            out.append(f.name)
        elif isinstance(f, windows.Rolling) and f.stat in ("avg", "std", "median"):
            out.append(f.name)
        elif f.source in double_sources:
            out.append(f.name)
    return out


DAILY_DOUBLES = DAILY_DOUBLE_BASE + feature_doubles(windows.daily_spec(), DAILY_DOUBLE_BASE)
WEEKLY_DOUBLES = PERIOD_DOUBLE_BASE + feature_doubles(windows.period_spec("week"), PERIOD_DOUBLE_BASE)
MONTHLY_DOUBLES = PERIOD_DOUBLE_BASE + feature_doubles(windows.period_spec("month"), PERIOD_DOUBLE_BASE)
WEATHER_DOUBLES = ["longitude", "latitude", "max_temp_c", "min_temp_c", "mean_temp_c", "total_precip_mm"]


def _inputs(spark: SparkSession, sf_dir: str) -> tables.Inputs:
    return tables.role_inputs(spark, sf_dir)


def _daily(spark, sf_dir, **kw) -> DataFrame:
    return tables.daily_features(_inputs(spark, sf_dir), **kw)


def q_staged_trips(spark, sf_dir):
    return _inputs(spark, sf_dir).trips


def q_clean_trips(spark, sf_dir):
    return tables.trips_clean(_inputs(spark, sf_dir))


def q_clean_stations(spark, sf_dir):
    return round_doubles(tables.stations_clean(_inputs(spark, sf_dir)))


def q_clean_weather(spark, sf_dir):
    return round_doubles(tables.weather_clean(_inputs(spark, sf_dir)))


def q_enriched_trips(spark, sf_dir):
    return round_doubles(tables.enriched_trips(_inputs(spark, sf_dir)))


def q_daily(spark, sf_dir):
    return round_doubles(_daily(spark, sf_dir))


def q_daily_fused_struct(spark, sf_dir):
    """Same table through fused distinct counts (Expand) and the struct top pair."""
    return round_doubles(_daily(spark, sf_dir, distinct="fused", top="struct"))


def q_daily_join_first(spark, sf_dir):
    """Same table through the literal join-then-aggregate plan."""
    return round_doubles(_daily(spark, sf_dir, plan="join_first"))


def q_daily_bucketed(spark, sf_dir):
    """Same table with the feature windows spread over 500-day buckets (halo of 30 rows)."""
    return round_doubles(_daily(spark, sf_dir, bucket_rows=500))


def q_daily_calendar_lags(spark, sf_dir):
    """Documented intent: lags and frames over calendar days (missing days are gaps)."""
    return round_doubles(_daily(spark, sf_dir, densify=True))


def q_weekly_bucketed(spark, sf_dir):
    """Weekly table with windows over 150-week buckets (halo of 104 rows)."""
    return round_doubles(tables.period_features(_daily(spark, sf_dir), "week", bucket_rows=150))


def q_weekly(spark, sf_dir):
    return round_doubles(tables.weekly_features(_daily(spark, sf_dir)))


def q_monthly(spark, sf_dir):
    return round_doubles(tables.monthly_features(_daily(spark, sf_dir)))


def q_distinct_counts(spark, sf_dir):
    """A5: three exact distinct counts per day (split plan: no Expand)."""
    clean = tables.trips_clean(_inputs(spark, sf_dir))
    out = None
    for c, n in aggregate.DISTINCT_COUNTS:
        part = aggregate.distinct_per_day(clean, c, n)
        out = part if out is None else out.join(part, "trip_date", "full")
    return out


def q_percentiles(spark, sf_dir):
    """A7 + A10: exact quartiles and median of duration per day."""
    out = aggregate.duration_quartiles(tables.trips_clean(_inputs(spark, sf_dir)))
    return out.select(
        "trip_date",
        F.col("_pct")[0].alias("p25_trip_duration__leaky"),
        F.col("_pct")[1].alias("median_trip_duration__leaky"),
        F.col("_pct")[2].alias("p75_trip_duration__leaky"),
    )


def q_distinct_counts_fused(spark, sf_dir):
    """A5, fused plan: three ``count(distinct)`` in one aggregation (Catalyst Expand)."""
    clean = tables.trips_clean(_inputs(spark, sf_dir))
    return clean.groupBy(aggregate.trip_day()).agg(
        *[F.count_distinct(c).alias(n) for c, n in aggregate.DISTINCT_COUNTS]
    )


def q_top_pair(spark, sf_dir):
    return aggregate.top_pair(tables.trips_clean(_inputs(spark, sf_dir)))


def q_top_station_per_role(spark, sf_dir):
    """O2, documented intent: busiest start and busiest end station ranked apart."""
    return aggregate.top_station_per_role(tables.trips_clean(_inputs(spark, sf_dir)))


def _sql_top_per_role() -> str:
    def ranked(col: str) -> str:
        return (f"SELECT trip_date, {col}, n FROM (SELECT *, row_number() OVER (PARTITION BY trip_date "
                f"ORDER BY n DESC, {col} ASC NULLS LAST) AS rk FROM (SELECT CAST(start_time AS DATE) AS trip_date, "
                f"{col}, count(*) AS n FROM trips_clean GROUP BY 1, 2)) WHERE rk = 1")

    return oracle.with_ctes(
        f"""SELECT coalesce(s.trip_date, e.trip_date) AS trip_date,
       s.start_station_id AS top_start_station_id__leaky, s.n AS top_start_station_trips__leaky,
       e.end_station_id AS top_end_station_id__leaky, e.n AS top_end_station_trips__leaky
FROM ({ranked("start_station_id")}) s FULL JOIN ({ranked("end_station_id")}) e ON s.trip_date = e.trip_date""",
        "trips_clean",
    )


def q_top_pair_struct(spark, sf_dir):
    """O2 as a ``min(struct)`` aggregate instead of a ranking window."""
    return aggregate.top_pair(tables.trips_clean(_inputs(spark, sf_dir)), "struct")


def q_pair_counts(spark, sf_dir):
    return aggregate.pair_counts(tables.trips_clean(_inputs(spark, sf_dir)))


def q_calendar(spark, sf_dir):
    """X7-X13 on every trip day (plus the documented Sat+Sun weekend)."""
    days = tables.trips_clean(_inputs(spark, sf_dir)).select(aggregate.trip_day()).distinct()
    return days.select(
        "trip_date",
        *[c.alias(n) for n, c in dates.calendar_columns("trip_date").items()],
        dates.is_weekend("trip_date", "sat_sun").alias("is_sat_or_sun"),
        dates.quarter("trip_date").alias("quarter"),
        dates.month_name("trip_date").alias("month_name"),
        dates.period_start("trip_date", "week").alias("week_start_date"),
        dates.period_start("trip_date", "month").alias("month_start_date"),
    )


def q_calendar_flags(spark, sf_dir):
    """J7 + J8 + A25: holiday and restriction flags per trip day."""
    inp = _inputs(spark, sf_dir)
    days = tables.trips_clean(inp).select(aggregate.trip_day()).distinct()
    days = joins.holiday_flag(days, "trip_date", inp.holidays)
    return joins.restriction_flag(days, "trip_date", inp.restrictions)


def q_json_map(spark, sf_dir):
    """JSON object text -> map<string,string>, then a key lookup."""
    from .operators.staging import parse_json_map

    from .sources import roles

    ev = roles.events(spark, sf_dir)
    m = parse_json_map("props")
    return ev.select(
        "event_id",
        F.size(m).cast("bigint").alias("n_keys"),
        m.getItem("k").alias("k_text"),
    )


def _sql_calendar() -> str:
    return oracle.with_ctes(
        """SELECT trip_date, dayofweek(trip_date) AS day_of_week, dayname(trip_date) AS day_name,
       coalesce(dayofweek(trip_date) IN (6, 7), false) AS is_weekend, month(trip_date) AS month_num,
       year(trip_date) AS year, day(trip_date) AS day_of_month, weekofyear(trip_date) AS week_of_year,
       dayofweek(trip_date) IN (0, 6) AS is_sat_or_sun, quarter(trip_date) AS quarter,
       monthname(trip_date) AS month_name, date_trunc('week', trip_date) AS week_start_date,
       date_trunc('month', trip_date) AS month_start_date
FROM (SELECT DISTINCT CAST(start_time AS DATE) AS trip_date FROM trips_clean)""",
        "trips_clean",
    )


def _sql_calendar_flags() -> str:
    return oracle.with_ctes(
        """SELECT d.trip_date, coalesce(h.holiday_date IS NOT NULL, false) AS is_holiday,
       coalesce(r.restrictions, false) AS has_covid_restrictions
FROM (SELECT DISTINCT CAST(start_time AS DATE) AS trip_date FROM trips_clean) d
LEFT JOIN (SELECT DISTINCT holiday_date FROM holidays) h ON d.trip_date = h.holiday_date
LEFT JOIN restrictions r ON year(d.trip_date) = year(r.report_date) AND month(d.trip_date) = month(r.report_date)""",
        "trips_clean", "holidays", "restrictions",
    )


def registry() -> dict[str, Query]:
    from . import catalog_deep, catalog_more, catalog_staged

    reg = {
        "t01_staged_trips": Query(q_staged_trips, _sql("trips", [])),
        "t07_clean_trips": Query(q_clean_trips, _sql("trips_clean", [])),
        "t08_clean_stations": Query(q_clean_stations, _sql("stations_clean", ["lat", "lon", "nearby_distance"])),
        "t09_clean_weather": Query(q_clean_weather, _sql("wx_clean", WEATHER_DOUBLES)),
        "t10_enriched_trips": Query(
            q_enriched_trips,
            _sql("enriched", [
                "start_station_lat", "start_station_lon", "start_station_nearby_distance",
                "end_station_lat", "end_station_lon", "end_station_nearby_distance",
                "weather_longitude", "weather_latitude", "weather_max_temp_c", "weather_min_temp_c",
                "weather_mean_temp_c", "weather_total_precip_mm",
            ]),
        ),
        "t11_daily_features": Query(q_daily, _sql("daily", DAILY_DOUBLES)),
        "t11_daily_features_fused_struct": Query(q_daily_fused_struct, _sql("daily", DAILY_DOUBLES)),
        "t11_daily_features_join_first": Query(q_daily_join_first, _sql("daily", DAILY_DOUBLES)),
        "t12_weekly_features": Query(q_weekly, _sql("weekly", WEEKLY_DOUBLES)),
        "t11_daily_features_bucketed_windows": Query(q_daily_bucketed, _sql("daily", DAILY_DOUBLES)),
        "t11_daily_features_calendar_lags": Query(
            q_daily_calendar_lags, _sql("daily_calendar_lags", DAILY_DOUBLES)),
        "t12_weekly_features_bucketed_windows": Query(q_weekly_bucketed, _sql("weekly", WEEKLY_DOUBLES)),
        "t13_monthly_features": Query(q_monthly, _sql("monthly", MONTHLY_DOUBLES)),
        "a05_count_distinct": Query(
            q_distinct_counts,
            oracle.with_ctes(
                "SELECT CAST(start_time AS DATE) AS trip_date, count(DISTINCT bike_id) AS unique_bikes__leaky, "
                "count(DISTINCT start_station_id) AS unique_start_stations__leaky, "
                "count(DISTINCT end_station_id) AS unique_end_stations__leaky FROM trips_clean GROUP BY 1",
                "trips_clean",
            ),
        ),
        "a10_percentiles": Query(
            q_percentiles,
            oracle.with_ctes(
                "SELECT CAST(start_time AS DATE) AS trip_date, "
                "round(percentile_cont(0.25) WITHIN GROUP (ORDER BY trip_duration), 6) AS p25_trip_duration__leaky, "
                "round(median(trip_duration), 6) AS median_trip_duration__leaky, "
                "round(percentile_cont(0.75) WITHIN GROUP (ORDER BY trip_duration), 6) AS p75_trip_duration__leaky "
                "FROM trips_clean GROUP BY 1",
                "trips_clean",
            ),
        ),
        "a14_pair_counts": Query(
            q_pair_counts,
            oracle.with_ctes(
                "SELECT CAST(start_time AS DATE) AS trip_date, start_station_id, end_station_id, "
                "count(*) AS trip_count FROM trips_clean GROUP BY 1, 2, 3",
                "trips_clean",
            ),
        ),
        "o02_top_pair": Query(
            q_top_pair,
            oracle.with_ctes(
                """SELECT trip_date, start_station_id AS top_start_station_id__leaky,
       trip_count AS top_start_station_trips__leaky, end_station_id AS top_end_station_id__leaky,
       trip_count AS top_end_station_trips__leaky
FROM (SELECT *, row_number() OVER (PARTITION BY trip_date ORDER BY trip_count DESC,
             start_station_id ASC NULLS LAST, end_station_id ASC NULLS LAST) AS rk
      FROM (SELECT CAST(start_time AS DATE) AS trip_date, start_station_id, end_station_id,
                   count(*) AS trip_count FROM trips_clean GROUP BY 1, 2, 3))
WHERE rk = 1""",
                "trips_clean",
            ),
        ),
        "x07_calendar_functions": Query(q_calendar, _sql_calendar()),
        "j07_j08_calendar_flags": Query(q_calendar_flags, _sql_calendar_flags()),
        "x19_json_map": Query(
            q_json_map,
            "SELECT event_id, CAST(cardinality(CAST(json(props) AS MAP(VARCHAR, JSON))) AS BIGINT) AS n_keys, "
            "json_extract_string(props, '$.k') AS k_text FROM events",
        ),
    }
    reg["a05_count_distinct_fused"] = Query(q_distinct_counts_fused, reg["a05_count_distinct"].sql)
    reg["o02_top_pair_struct"] = Query(q_top_pair_struct, reg["o02_top_pair"].sql)
    reg["o02_top_station_per_role"] = Query(q_top_station_per_role, _sql_top_per_role())
    reg.update(catalog_more.registry())
    reg.update(catalog_staged.registry())
    reg.update(catalog_deep.registry())
    return reg
