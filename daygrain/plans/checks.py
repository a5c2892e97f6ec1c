"""The reference's declared column tests, derived by rule, and their report.

Rule (counted from the reference's model contracts): staged seeds and the
three cleaned tables declare every column ``not_null``; the enriched trips
declare the trip and weather columns (station roles may be unmatched); the
grain tables declare every column that is not a lag / rolling / change
feature, except, for days, the standard deviation and the two per-user-type
mean durations (null on one-trip days and days without that user type);
v1 marts declare the key only, v2 marts their non-feature columns; every
mart key and the restriction month are ``unique``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, quality, windows
from ..schemas import CLEAN_STATION_COLUMNS, CLEAN_WEATHER_COLUMNS
from ..sources import sinks
from . import marts, tables

NULLABLE_DAILY = {"stddev_trip_duration__leaky", "avg_annual_member_duration__leaky", "avg_casual_member_duration__leaky"}
TRIP_COLUMNS = [
    "trip_id", "trip_duration", "start_station_id", "start_time", "start_station_name",
    "end_station_id", "end_time", "end_station_name", "bike_id", "user_type",
]


def _feature_names(grain: str) -> set[str]:
    if grain == "daily":
        return set(windows.daily_spec().names())
    return set(windows.period_spec("week" if grain == "weekly" else "month").names())


def declared_tests(model: str) -> tuple[list[str], list[str]]:
    """(not_null columns, unique keys) of a model name of ``marts.Project``."""
    if model in ("stg_trips", "stg_stations", "stg_weather_primary", "stg_weather_secondary"):
        return [], []
    if model == "stg_holidays":
        return ["holiday_name", "date_string", "holiday_date"], []
    if model == "stg_restrictions":
        cols = ["date_string", "report_date", "restrictions", "hospitalizations", "icu_admissions",
                "inhospital_deaths", "ed_visits"]
        return cols, ["report_date"]
    if model == "int_trips_clean":
        return list(TRIP_COLUMNS), []
    if model == "int_stations_clean":
        return list(CLEAN_STATION_COLUMNS), []
    if model == "int_weather_clean":
        return list(CLEAN_WEATHER_COLUMNS), []
    if model == "int_enriched_trips":
        return list(joins.TRIP_KEEP_COLUMNS) + [f"weather_{c}" for c in joins.WEATHER_ROLE_COLUMNS], []
    if model.startswith("int_"):
        grain = model[4:]
        feats = _feature_names(grain)
        skip = NULLABLE_DAILY if grain == "daily" else set()
        return [c for c in marts.grain_columns(grain) if c not in feats and c not in skip], []
    if model.startswith("fct_trips_"):
        _, _, grain, version = model.split("_")
        key = marts.GRAIN_KEYS[grain]
        if version == "v1":
            return [key], [key]
        feats = _feature_names(grain)
        return [c for c in marts.mart_columns(grain, "v2") if c not in feats], [key]
    raise KeyError(model)


def model_report(project: marts.Project, model: str) -> DataFrame:
    """Q1 + Q2 for one model of a project, from its declared tests."""
    not_null, unique = declared_tests(model)
    return quality.quality_report(project.ref(model), model, not_null=not_null, unique=unique)


def project_report(project: marts.Project, models: list[str] | None = None) -> DataFrame:
    """Q1 + Q2 over several models (those that declare tests), as one report."""
    names = [m for m in (models or project.names) if any(declared_tests(m))]
    if not names:
        raise ValueError("none of the selected models declares tests")
    reports = [model_report(project, m) for m in names]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


BUILD_CHECKS, BUILD_DROPS = "build_checks", "build_drops"


def observed_report(spark: SparkSession, project: marts.Project, models: list[str] | None = None) -> DataFrame:
    """Q1 + Q2 of the models that ``project`` has written, as their writes measured them: reads no table."""
    names = [m for m in (models or list(project.observed)) if any(declared_tests(m))]
    missing = [m for m in names if m not in project.observed]
    if missing:
        raise ValueError(f"not written by this project: {missing}")
    # one row per declared check
    rows = [(m, column, check, violations) for m in names for column, check, violations in project.observed[m]]
    return spark.createDataFrame(rows, "table_name string, column_name string, check_name string, violations long")


def drop_report(spark: SparkSession, project: marts.Project) -> DataFrame:
    """Rows that the last write of the staged trips rejected, by reason."""
    return spark.createDataFrame(sorted((project.drops or {}).items()), "reason string, rows long")


def save_observed(spark: SparkSession, project: marts.Project, out_dir: str) -> None:
    """Keep what a build has measured beside its tables; models of earlier builds keep theirs."""
    root = out_dir.rstrip("/")
    if project.observed:
        report = observed_report(spark, project)
        sinks.materialize(report, f"{root}/{BUILD_CHECKS}", ["table_name"], replace="partitions")
    if project.drops is not None:
        sinks.materialize(drop_report(spark, project).coalesce(1), f"{root}/{BUILD_DROPS}")


def saved_report(spark: SparkSession, out_dir: str, models: list[str]) -> DataFrame:
    """The checks that builds below ``out_dir`` have measured for ``models``."""
    schema = "column_name string, check_name string, violations long, table_name string"
    report = spark.read.schema(schema).parquet(f"{out_dir.rstrip('/')}/{BUILD_CHECKS}")
    return report.where(F.col("table_name").isin(models)).select(*quality.REPORT_COLUMNS)


def role_project(spark, sf_dir: str, **options) -> marts.Project:
    return marts.Project(tables.role_inputs(spark, sf_dir), **options)
