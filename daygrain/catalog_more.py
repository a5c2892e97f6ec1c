"""Registered queries, part two: marts, file sources and sinks, quality, modelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import catalog, oracle
from .catalog import Query
from .functions.exprs import round_doubles
from .operators import quality, staging
from .plans import checks, marts, modeling, tables
from .schemas import TRIP_COLUMNS, station_schema
from .session import scratch_path
from .sources import files, roles, sinks

DOUBLES = {"daily": catalog.DAILY_DOUBLES, "weekly": catalog.WEEKLY_DOUBLES, "monthly": catalog.MONTHLY_DOUBLES}


def _grain_table(spark, sf_dir, grain):
    daily = tables.daily_features(tables.role_inputs(spark, sf_dir))
    if grain == "daily":
        return daily
    return tables.period_features(daily, "week" if grain == "weekly" else "month")


def _mart_sql(grain: str, version: str, where: str = "") -> str:
    cols = marts.mart_columns(grain, version)
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in DOUBLES[grain] else c for c in cols)
    return oracle.with_ctes(f"SELECT {sel} FROM {grain} {where}", grain)


def _mart_query(grain: str, version: str) -> Query:
    def run(spark, sf_dir):
        return round_doubles(marts.mart(_grain_table(spark, sf_dir, grain), grain, version))

    return Query(run, _mart_sql(grain, version))


def q_csv_trips(spark, sf_dir):
    """S1 + S8 + F11 + T1: trips rendered as raw CSV in two header layouts, read back.

    Half of the rows go to files whose columns come in reverse order; the
    reader aligns them by header name.
    """
    trips = tables.role_inputs(spark, sf_dir).trips
    root = scratch_path(spark, "raw-trips")
    canonical = [c[0] for c in TRIP_COLUMNS]
    even = F.col("trip_id") % 2 == 0
    files.write_raw_csv(trips.filter(even), f"{root}/ridership-a", TRIP_COLUMNS)
    files.write_raw_csv(trips.filter(~even), f"{root}/ridership-b", TRIP_COLUMNS, canonical[::-1])
    raw = files.read_csv_aligned(spark, f"{root}/ridership-*/*.csv", TRIP_COLUMNS)
    return staging.stage_trips(raw)


def _weather_from_csv(spark, roles_inp: tables.Inputs, root: str):
    """Both weather roles written with the reference's raw headers (degree
    signs included) and read back strictly (any bad row fails the job)."""
    from .schemas import WEATHER_PRIMARY_COLUMNS, WEATHER_SECONDARY_COLUMNS

    paths = roles.render_weather_files(roles_inp, root)
    primary = staging.stage_weather(
        files.read_csv_aligned(spark, paths["weather_primary"], WEATHER_PRIMARY_COLUMNS, bad_rows="fail"))
    secondary = staging.stage_weather(
        files.read_csv_aligned(spark, paths["weather_secondary"], WEATHER_SECONDARY_COLUMNS, bad_rows="fail"),
        secondary=True)
    return primary, secondary


def raw_file_inputs(spark, sf_dir) -> tables.Inputs:
    """Every role rendered in its raw file layout below the shared folder and
    read back through the file sources (the same path as the command line)."""
    from .cli import inputs_from_files

    paths = roles.render_raw_files(spark, tables.role_inputs(spark, sf_dir), scratch_path(spark, "raw"))
    return inputs_from_files(spark, **paths)


def q_daily_from_raw_files(spark, sf_dir):
    """S1-S8 + T1-T11: the whole daily model starting from raw files."""
    return round_doubles(tables.daily_features(tables.written_trips(raw_file_inputs(spark, sf_dir))))


def q_weather_from_csv(spark, sf_dir):
    """S3 + S4 + P3 + P4 + X6 + T9: strict weather CSV reads, merged and filled."""
    primary, secondary = _weather_from_csv(spark, tables.role_inputs(spark, sf_dir), scratch_path(spark, "raw-wx"))
    return round_doubles(tables.cleaning.clean_weather(primary, secondary))


def q_json_stations(spark, sf_dir):
    """S2 + T2 + T8: station records written as JSON lines, read with a declared schema."""
    stations = tables.role_inputs(spark, sf_dir).stations
    path = scratch_path(spark, "stations-json")
    stations.write.mode("overwrite").json(path)
    records = files.read_json_records(spark, path, station_schema())
    return round_doubles(tables.cleaning.clean_stations(staging.stage_stations(records)))


def q_export_roundtrip(spark, sf_dir):
    """S11 + S14: daily v2 mart exported as one header CSV and read back typed."""
    mart = marts.mart(_grain_table(spark, sf_dir, "daily"), "daily", "v2")
    path = scratch_path(spark, "fct_trips_daily_v2")
    sinks.export_csv(mart, path, order_by="trip_date")
    back = sinks.read_exported_csv(spark, path, mart.schema)
    return round_doubles(back)


def q_build_materialize(spark, sf_dir):
    """S9 + S10 + S12 + S13 + F9: build a mart with its parents as Parquet, query it."""
    project = marts.Project(tables.role_inputs(spark, sf_dir))
    out = scratch_path(spark, "models")
    project.build("+fct_trips_weekly_v1", out_dir=out)
    return round_doubles(sinks.read_mart(spark, f"{out}/fct_trips_weekly_v1", "week_start_date", "1998-01-01"))


def q_quality(spark, sf_dir):
    """Q1 + Q2: the declared column tests of the daily table and its v2 mart, over built tables."""
    project = marts.Project(tables.role_inputs(spark, sf_dir))
    models = ["stg_restrictions", "int_daily", "fct_trips_daily_v2"]
    project.build(models, out_dir=scratch_path(spark, "checked"))
    return checks.project_report(project, models)


def _sql_quality() -> str:
    parts = []
    for model, table, cols in (
        ("int_daily", "daily", None),
        ("fct_trips_daily_v2", "daily", None),
        ("stg_restrictions", "restrictions", None),
    ):
        not_null, unique = checks.declared_tests(model)
        for c in not_null:
            parts.append(
                f"SELECT '{model}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
                f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {table}"
            )
        for k in unique:
            parts.append(
                f"SELECT '{model}' AS table_name, '{k}' AS column_name, 'unique' AS check_name, "
                f"CAST(count(*) AS BIGINT) AS violations FROM "
                f"(SELECT {k} FROM {table} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)"
            )
    return oracle.with_ctes("\nUNION ALL\n".join(parts), "daily", "restrictions")


def q_coverage(spark, sf_dir):
    """Q5: observed vs calendar days per month."""
    monthly = _grain_table(spark, sf_dir, "monthly")
    return quality.period_coverage(monthly, "month_start_date", "days_in_month")


def q_importances(spark, sf_dir):
    """M1-M6: forest on the daily v2 mart, chronological split, ranked importances."""
    mart = modeling.written(marts.mart(_grain_table(spark, sf_dir, "daily"), "daily", "v2"))
    feats = modeling.select_features(mart, "trip_date")
    clean = modeling.complete_cases(mart, feats + ["total_trips__leaky"])
    train, test = modeling.chrono_split(clean, "trip_date", 0.8)
    model = modeling.fit_forest(train, feats, trees=100, seed=42)
    score = modeling.r2(model, test, feats)
    ranked = modeling.importances(model, feats, spark)
    return ranked.withColumn("test_r2", F.lit(score))


def registry() -> dict[str, Query]:
    reg: dict[str, Query] = {}
    for i, (grain, version) in enumerate(
        [(g, v) for v in ("v1", "v2") for g in ("daily", "weekly", "monthly")], start=14
    ):
        reg[f"t{i}_fct_trips_{grain}_{version}"] = _mart_query(grain, version)
    reg["s01_csv_trips_aligned"] = Query(q_csv_trips, oracle.with_ctes("SELECT * FROM trips", "trips"))
    reg["s02_json_stations"] = Query(
        q_json_stations,
        oracle.with_ctes(
            "SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon, "
            "round(nearby_distance, 6) AS nearby_distance) FROM stations_clean",
            "stations_clean",
        ),
    )
    reg["s03_s04_weather_csv"] = Query(
        q_weather_from_csv, catalog._sql("wx_clean", catalog.WEATHER_DOUBLES))
    reg["t11_daily_features_from_raw_files"] = Query(
        q_daily_from_raw_files, catalog._sql("daily", catalog.DAILY_DOUBLES))
    reg["s11_export_csv_roundtrip"] = Query(q_export_roundtrip, _mart_sql("daily", "v2"))
    reg["s12_build_materialize_read"] = Query(
        q_build_materialize, _mart_sql("weekly", "v1", "WHERE week_start_date >= TIMESTAMP '1998-01-01'")
    )
    reg["q01_q02_quality_report"] = Query(q_quality, _sql_quality())
    reg["q05_period_coverage"] = Query(
        q_coverage,
        oracle.with_ctes(
            "SELECT month_start_date, days_in_month AS observed_days, "
            "CAST(day(last_day(month_start_date)) AS BIGINT) AS calendar_days, "
            "days_in_month < day(last_day(month_start_date)) AS incomplete FROM monthly",
            "monthly",
        ),
    )
    reg["m06_feature_importances"] = Query(q_importances, None)
    return reg
