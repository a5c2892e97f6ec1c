"""Command line: build models from raw files and run the declared tests.

    python -m daygrain build --trips 'raw/trips/*/*.csv' --stations raw/stations.json \\
        --stations-record-path data.stations --weather-primary 'raw/wx1/*.csv' \\
        --weather-secondary 'raw/wx2/*.csv' --holidays seeds/holidays.csv \\
        --restrictions seeds/restrictions.csv --select +fct_trips_daily_v2 \\
        --out /shared/models --export /shared/exports
    python -m daygrain test ... --select int_daily fct_trips_daily_v2

``build`` materialises the selected models (with ``+``: and their parents)
as Parquet below ``--out``, exports marts as header CSV below ``--export``
and prints the trip rows it dropped, by reason, as its own scan counted them;
``rejects`` counts the trip rows a tolerant build drops, per file and reason
(with ``--built``: those an earlier build has kept aside); ``test`` prints
the declared not-null / unique checks and exits non-zero when any is violated
(with ``--built`` and ``--observed``: as the build measured them).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .operators import staging
from .plans import checks, marts, tables
from .schemas import (HOLIDAY_SEED_DDL, RESTRICTION_SEED_DDL, TRIP_COLUMNS, WEATHER_PRIMARY_COLUMNS,
                      WEATHER_SECONDARY_COLUMNS, station_schema)
from .session import get_session
from .sources import files


def inputs_from_files(
    spark,
    trips: str,
    stations: str,
    weather_primary: str,
    weather_secondary: str,
    holidays: str,
    restrictions: str,
    stations_record_path: str | None = None,
    null_value: str | None = None,
    stations_layout: str | None = None,
) -> tables.Inputs:
    """Staged inputs (T1-T6) from raw files: tolerant trips, strict weather, typed seeds."""
    marked = files.read_csv_marked(spark, trips, TRIP_COLUMNS, null_value=null_value)
    return tables.Inputs(
        trips_marked=staging.stage_trips_marked(marked),
        trips=staging.stage_trips(files.read_csv_aligned(
            spark, trips, TRIP_COLUMNS, bad_rows="drop", null_value=null_value)),
        stations=staging.stage_stations(files.read_json_records(
            spark, stations, station_schema(), record_path=stations_record_path,
            layout=stations_layout, key="station_id")),
        weather_primary=staging.stage_weather(files.read_csv_aligned(
            spark, weather_primary, WEATHER_PRIMARY_COLUMNS, bad_rows="fail")),
        weather_secondary=staging.stage_weather(files.read_csv_aligned(
            spark, weather_secondary, WEATHER_SECONDARY_COLUMNS, bad_rows="fail"),
            secondary=True),
        holidays=staging.stage_holidays(files.load_seed(spark, holidays, HOLIDAY_SEED_DDL)),
        restrictions=staging.stage_restrictions(files.load_seed(spark, restrictions, RESTRICTION_SEED_DDL)),
    )


def _inputs(spark, a: argparse.Namespace) -> tables.Inputs:
    return inputs_from_files(
        spark, a.trips, a.stations, a.weather_primary, a.weather_secondary, a.holidays, a.restrictions,
        stations_record_path=a.stations_record_path, null_value=a.null_value,
        stations_layout=a.stations_layout,
    )


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="daygrain")
    p.add_argument("command", choices=["build", "test", "list", "rejects"])
    for name in ("trips", "stations", "weather-primary", "weather-secondary", "holidays", "restrictions"):
        p.add_argument(f"--{name}")
    p.add_argument("--stations-record-path", default=None, help="e.g. data.stations for a nested document")
    p.add_argument("--null-value", default=None, help="text read as null in trip CSVs, e.g. NULL")
    p.add_argument("--stations-layout", choices=files.JSON_LAYOUTS, default=None,
                   help="array for a top-level array; default: nested with a record path, else lines")
    p.add_argument("--select", nargs="*", default=[])
    p.add_argument("--out", default=None, help="folder for the materialised models (Parquet)")
    p.add_argument("--built", default=None, help="test: folder of an earlier build; its tables are checked as they are")
    p.add_argument("--observed", action="store_true", help="test --built: the checks the build measured; reads no table")
    p.add_argument("--export", default=None, help="folder for the mart CSV exports")
    p.add_argument("--weekend", choices=["reference", "sat_sun"], default="reference")
    p.add_argument("--master", default=None)
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    if a.command == "list":
        print("\n".join(marts.model_names()))
        return 0
    spark = spark or get_session(a.master)
    if a.command == "rejects":
        if a.built:
            kept = spark.read.parquet(f"{a.built.rstrip('/')}/stg_trips").where(F.col("rejected").cast("boolean"))
            report = kept.groupBy(F.col("reject_file").alias("file_path"), F.col("reject_reason").alias("reason"))
            report = report.agg(F.count(F.lit(1)).alias("rows"))
        else:
            report = files.csv_reject_report(spark, a.trips, TRIP_COLUMNS, null_value=a.null_value)
        for r in report.orderBy("file_path", "reason").collect():
            print(f"{r.file_path}\t{r.reason}\t{r.rows}")
        return 0
    if a.command == "test" and a.built and a.observed:
        wanted = a.select or marts.model_names()
        return _print_checks(checks.saved_report(spark, a.built, [w.lstrip("+") for w in wanted]))
    project = marts.Project(_inputs(spark, a), weekend=a.weekend)
    selected = project.select(a.select) if a.select else project.names
    if a.command == "build":
        built = project.build(selected, out_dir=a.out, export_dir=a.export)
        for name, df in built.items():
            print(f"{name}\t{len(df.columns)} columns")
        for reason, rows in sorted((project.drops or {}).items()):
            print(f"dropped\t{reason}\t{rows}")
        if a.out:
            checks.save_observed(spark, project, a.out)
        return 0
    if a.built:
        project.use_built(spark, a.built, selected)
    return _print_checks(checks.project_report(project, selected))


def _print_checks(report) -> int:
    failures = 0
    for r in report.orderBy("table_name", "check_name", "column_name").collect():
        status = "PASS" if r.violations == 0 else "FAIL"
        failures += status == "FAIL"
        print(f"{status}\t{r.table_name}\t{r.check_name}\t{r.column_name}\t{r.violations}")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
