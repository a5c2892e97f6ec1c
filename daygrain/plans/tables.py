"""Derived tables T7-T13: the reference's model chain as lazy DataFrames.

Plan shape of the daily table (T11) at scale::

    trips scan (pruned, null filter pushed)
      ├─ histogram (day, user type, duration) ─ shuffle ─ per day ──┐
      ├─ dedupe (day, bike) ─ shuffle ─ count per day ──────────────┤
      └─ partial agg by (day, start, end) ─ shuffle ─ per day ──────┤ join on day (small)
    weather (one row per day, size-checked broadcast) ──────────────┤
    single-partition window over ~thousands of day rows ── calendar flags (broadcast)

The reference joins weather (and stations) to every trip and then picks
the weather per day with ``max``.  When the weather has one row per day and
the station key is unique, that equals aggregating first and joining the
few thousand day rows afterwards, which avoids widening every trip row; the
``auto`` plan checks both keys (cheap: the dimensions are small) and falls
back to the literal join-then-aggregate plan when a key repeats, so the
fan-out semantics of the reference are kept in every case.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import aggregate, cleaning, joins, staging, windows
from ..session import cut_lineage
from ..sources import calendars, roles


@dataclass
class Inputs:
    """Staged inputs."""

    trips: DataFrame
    stations: DataFrame
    weather_primary: DataFrame
    weather_secondary: DataFrame
    holidays: DataFrame
    restrictions: DataFrame
    # True when station ids and weather days are known to be unique; None: tested when needed.
    keyed: bool | None = None
    # The trips with the rows a tolerant read rejects (``staging.stage_trips_marked``): a build keeps and counts them.
    trips_marked: DataFrame | None = None


def role_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Inputs derived from the driver's parquet tables."""
    return Inputs(
        trips=roles.trips(spark, sf_dir),
        stations=roles.stations(spark, sf_dir),
        weather_primary=roles.weather_primary(spark, sf_dir),
        weather_secondary=roles.weather_secondary(spark, sf_dir),
        holidays=staging.stage_holidays(calendars.holiday_seed(spark)),
        restrictions=staging.stage_restrictions(calendars.restriction_seed(spark)),
        keyed=True,  # stations have the supplier key, weather is grouped by day
    )


def written_trips(inp: Inputs) -> Inputs:
    """The same inputs with the staged trips written once as Parquet, where a later model reads them several times.

    For trips that stand in raw text: the daily model's three aggregations
    would each parse and check every field of every row; so they read pruned
    columns of the written table, and the raw files are parsed once.
    """
    return replace(inp, trips=cut_lineage(inp.trips, "table"))


def trips_clean(inp: Inputs) -> DataFrame:
    """T7."""
    return cleaning.clean_trips(inp.trips)


def stations_clean(inp: Inputs) -> DataFrame:
    """T8."""
    return cleaning.clean_stations(inp.stations)


def weather_clean(inp: Inputs) -> DataFrame:
    """T9."""
    return cleaning.clean_weather(inp.weather_primary, inp.weather_secondary)


def enriched_trips(inp: Inputs) -> DataFrame:
    """T10."""
    return joins.enrich_trips(trips_clean(inp), stations_clean(inp), weather_clean(inp))


DAILY_COLUMNS = (
    ["trip_date", "day_of_week", "day_name", "is_weekend", "month_num", "year", "day_of_month", "week_of_year"]
    + aggregate.DAILY_MEASURE_COLUMNS
    + aggregate.WEATHER_DAY_COLUMNS
    + aggregate.TOP_PAIR_COLUMNS
    + windows.daily_spec().names()
    + ["is_holiday", "has_covid_restrictions"]
)


def dimensions_keyed(stations: DataFrame, weather: DataFrame) -> bool:
    """True when no station id (as bigint) and no weather day repeats (one job)."""
    return joins.all_keyed(
        (stations, [F.col("station_id").cast("bigint")]),
        (weather, [F.to_date("date_time")]),
    )


def resolved_plan(plan: str, keyed: bool | None) -> str:
    """``auto`` without a job where the keys are already known."""
    if plan == "auto" and keyed is not None:
        return "aggregate_first" if keyed else "join_first"
    return plan


def daily_base(
    inp: Inputs, *, distinct: str = "shared", top: str = "window", plan: str = "auto"
) -> DataFrame:
    """Per-day measures, weather and busiest pair (before features)."""
    return daily_base_from(
        trips_clean(inp), stations_clean(inp), weather_clean(inp), distinct=distinct, top=top,
        plan=resolved_plan(plan, inp.keyed),
    )


def daily_base_from(
    clean: DataFrame,
    stations: DataFrame,
    wx: DataFrame,
    *,
    distinct: str = "shared",
    top: str = "window",
    plan: str = "auto",
    top_roles: str = "pair",
) -> DataFrame:
    """``daily_base`` from cleaned trips, stations and weather.

    ``distinct="shared"`` reads the trips three times (``daily_shared``, which
    also yields the busiest pair); ``split`` and ``fused`` are the variants of
    ``daily_measures``, with ``top`` choosing the plan of the pair.

    ``top_roles="pair"`` reproduces the reference (both top stations are the
    ends of the busiest pair); ``"per_role"`` ranks starts and ends apart.
    """
    if plan == "auto":
        plan = "aggregate_first" if dimensions_keyed(stations, wx) else "join_first"
    shared = distinct == "shared"
    if plan == "aggregate_first":
        base = aggregate.daily_shared(clean) if shared else aggregate.daily_measures(clean, distinct=distinct)
        if shared and top_roles != "pair":
            base = base.drop(*aggregate.TOP_PAIR_COLUMNS)
        # day rows joined to day rows: no trip-sized side, so no hint needed
        wday = aggregate.weather_by_day(wx)
        base = base.join(wday, base["trip_date"] == wday["_wday"], "left").drop("_wday")
        if shared and top_roles == "pair":
            return base
        best = aggregate.top_pair(clean, top) if top_roles == "pair" else aggregate.top_station_per_role(clean)
    elif plan == "join_first":
        enriched = joins.enrich_trips(clean, stations, wx)
        base = aggregate.daily_measures(
            enriched, distinct="split" if shared else distinct, weather_columns=True, distinct_source=clean
        )
        best = (aggregate.top_pair(enriched, top) if top_roles == "pair"
                else aggregate.top_station_per_role(enriched))
    else:
        raise ValueError(f"unknown plan {plan!r}")
    return base.join(best, "trip_date", "left")


def daily_features(inp: Inputs, **options) -> DataFrame:
    """One row per observed day, 68 columns (see ``daily_features_from``)."""
    options["plan"] = resolved_plan(options.get("plan", "auto"), inp.keyed)
    return daily_features_from(
        trips_clean(inp), stations_clean(inp), weather_clean(inp), inp.holidays, inp.restrictions, **options
    )


def daily_features_from(
    clean: DataFrame,
    stations: DataFrame,
    wx: DataFrame,
    holidays: DataFrame,
    restrictions: DataFrame,
    *,
    weekend: str = "reference",
    distinct: str = "shared",
    top: str = "window",
    plan: str = "auto",
    bucket_rows: int | None = None,
    top_roles: str = "pair",
    densify: bool = False,
) -> DataFrame:
    """T11 from the cleaned tables (T7-T9) and the staged calendars.

    Taking the cleaned tables lets a build continue from their written
    Parquet copies: raw CSV is parsed once, and the three trip-level
    aggregations read pruned columns of a columnar table.
    ``bucket_rows`` spreads the feature windows over buckets of consecutive
    days with a halo (``windows.add_features_bucketed``); by default the
    few thousand day rows are windowed in one partition.
    """
    daily = daily_base_from(clean, stations, wx, distinct=distinct, top=top, plan=plan, top_roles=top_roles)
    daily = daily.withColumns(dates.calendar_columns("trip_date", weekend))
    daily = _with_features(daily, windows.daily_spec(), bucket_rows, "day" if densify else None)
    daily = joins.holiday_flag(daily, "trip_date", holidays)
    daily = joins.restriction_flag(daily, "trip_date", restrictions)
    return daily.select(*DAILY_COLUMNS)


def _with_features(
    df: DataFrame, spec: windows.FeatureSpec, bucket_rows: int | None, calendar_step: str | None = None
) -> DataFrame:
    if calendar_step:
        return windows.add_features_calendar(df, spec, calendar_step, bucket_rows)
    if bucket_rows:
        return windows.add_features_bucketed(df, spec, bucket_rows)
    return windows.add_features(df, spec)


def period_columns(unit: str) -> list[str]:
    """Output columns of the weekly / monthly table, in reference order.

    Fixed values that must equal the reference: the period key, time and
    measure column names; the feature names follow from ``period_spec``.
    """
    key = aggregate.PERIOD_KEYS[unit]
    time = ["year", "week_of_year", "month_num", "days_in_week"] if unit == "week" else [
        "year", "month_num", "month_name", "quarter", "days_in_month"]
    measures = [
        "non_working_day_ratio", "has_covid_restrictions", "total_trips__leaky", "avg_daily_trips__leaky",
        "annual_member_trips__leaky", "casual_member_trips__leaky", "annual_member_ratio__leaky",
        "unique_bikes__leaky", "unique_start_stations__leaky", "unique_end_stations__leaky",
        "avg_trip_duration__leaky", "median_trip_duration__leaky", "min_trip_duration__leaky",
        "max_trip_duration__leaky", "avg_max_temp_c", "avg_min_temp_c", "avg_mean_temp_c", "max_temp_c",
        "min_temp_c", "avg_total_precip_mm", "avg_snow_on_grnd_cm", "max_total_precip_mm",
        "max_snow_on_grnd_cm", "min_total_precip_mm", "min_snow_on_grnd_cm",
    ]
    return [key] + time + measures + windows.period_spec(unit).names()


def period_features(
    daily: DataFrame, unit: str, bucket_rows: int | None = None, densify: bool = False
) -> DataFrame:
    """T12 (``week``) / T13 (``month``) from the daily table.

    ``densify=True`` counts lags in calendar weeks / months (documented
    intent); by default they count rows, as the reference does.
    """
    rolled = aggregate.rollup_period(daily, unit)
    spec = windows.period_spec(unit)
    return _with_features(rolled, spec, bucket_rows, unit if densify else None).select(*period_columns(unit))


def weekly_features(daily: DataFrame) -> DataFrame:
    """56 columns."""
    return period_features(daily, "week")


def monthly_features(daily: DataFrame) -> DataFrame:
    """57 columns."""
    return period_features(daily, "month")
