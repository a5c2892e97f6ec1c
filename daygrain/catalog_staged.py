"""Registered queries, part three: staged tables in full, file checks, the modelling split."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import catalog, oracle
from .catalog import Query
from .functions.exprs import round_doubles
from .operators import quality, staging
from .plans import marts, modeling, tables
from .schemas import (
    HOLIDAY_SEED_DDL,
    RESTRICTION_SEED_DDL,
    TRIP_COLUMNS,
    WEATHER_PRIMARY_COLUMNS,
    WEATHER_SECONDARY_COLUMNS,
    assert_schema,
    ddl,
    station_schema,
)
from .session import scratch_path
from .sources import calendars, files, roles

STATIONS_A_FILE = 1000
_WEATHER_DOUBLES = [name for _raw, name, typ, _parse in WEATHER_SECONDARY_COLUMNS if typ == "double"]


def _uris_as_text(stations):
    """The URI map as sorted ``key=value`` text: maps do not compare across engines."""
    entries = F.transform(F.array_sort(F.map_entries("rental_uris")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return round_doubles(stations.withColumn("rental_uris", F.array_join(entries, ";")))


def q_staged_stations(spark, sf_dir):
    """T2 + P2: all 19 station columns, through JSON lines."""
    path = scratch_path(spark, "stations-json")
    roles.stations(spark, sf_dir).write.json(path)
    return _uris_as_text(staging.stage_stations(files.read_json_records(spark, path, station_schema(), key="station_id")))


def q_nested_stations(spark, sf_dir):
    """Station records inside ``data.stations`` of a document per thousand suppliers."""
    path = scratch_path(spark, "stations-nested")
    stations = roles.stations(spark, sf_dir)
    part = F.floor(F.col("station_id").cast("bigint") / STATIONS_A_FILE)
    documents = stations.groupBy(part.alias("part")).agg(F.collect_list(F.struct(*stations.columns)).alias("stations"))
    text = documents.select("part", F.to_json(F.struct(F.struct("stations").alias("data"))).alias("value"))
    text.repartition("part").write.partitionBy("part").text(path)
    records = files.read_json_records(spark, f"{path}/part=*/*.txt", station_schema(), "data.stations", key="station_id")
    return _uris_as_text(staging.stage_stations(records))


def _staged_weather(spark, sf_dir, secondary: bool):
    columns = WEATHER_SECONDARY_COLUMNS if secondary else WEATHER_PRIMARY_COLUMNS
    path = scratch_path(spark, "raw-weather")
    role = roles.weather_secondary if secondary else roles.weather_primary
    files.write_raw_csv(role(spark, sf_dir), path, columns)
    raw = files.read_csv_aligned(spark, f"{path}/*.csv", columns, bad_rows="fail")
    return round_doubles(staging.stage_weather(raw, secondary))


def q_staged_weather_primary(spark, sf_dir):
    """T3 + P3: all 14 columns, through a strict CSV read."""
    return _staged_weather(spark, sf_dir, False)


def q_staged_weather_secondary(spark, sf_dir):
    """T4 + P4: all 31 columns, through a strict CSV read."""
    return _staged_weather(spark, sf_dir, True)


def _seed(spark, seed, columns: str):
    path = scratch_path(spark, "seed")
    seed.coalesce(1).write.option("header", True).csv(path)
    return files.load_seed(spark, path, columns)


def q_staged_holidays(spark, sf_dir):
    """T5 + P5: all columns of the holiday seed, with the trips started on each date."""
    holidays = staging.stage_holidays(_seed(spark, calendars.holiday_seed(spark), HOLIDAY_SEED_DDL))
    days = roles.trips(spark, sf_dir).groupBy(F.to_date("start_time").alias("holiday_date")).agg(F.count(F.lit(1)).alias("n"))
    return holidays.join(days, "holiday_date", "left").withColumn("trips", F.coalesce("n", F.lit(0))).drop("n")


def q_staged_restrictions(spark, sf_dir):
    """T6 + P6 + X4: all columns of the restriction seed, with the trips started in each month."""
    seed = staging.stage_restrictions(_seed(spark, calendars.restriction_seed(spark), RESTRICTION_SEED_DDL))
    month = F.to_date(F.trunc(F.to_date("start_time"), "month")).alias("report_date")
    months = roles.trips(spark, sf_dir).groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    return seed.join(months, "report_date", "left").withColumn("trips", F.coalesce("n", F.lit(0))).drop("n")


def render_trips_with_rejects(spark, sf_dir) -> str:
    """Raw trip files with short rows and durations that are no numbers; returns their glob."""
    trips = roles.trips(spark, sf_dir)
    root = scratch_path(spark, "raw-rejects")
    cut = F.col("trip_id") % 29 == 0
    worded = F.when(F.col("bike_id") % 17 == 0, F.lit("n/a")).otherwise(F.col("trip_duration").cast("string"))
    files.write_raw_csv(trips.filter(~cut).withColumn("trip_duration", worded), f"{root}/ridership-a", TRIP_COLUMNS)
    short = F.concat_ws(",", F.col("trip_id").cast("string"), F.col("start_station_id").cast("string"))
    header = ",".join(c[0] for c in TRIP_COLUMNS)
    short_rows = trips.filter(cut).select(short.alias(header))
    short_rows.write.option("header", True).option("sep", "\u0001").csv(f"{root}/ridership-b")
    return f"{root}/ridership-*/*.csv"


def q_reject_report(spark, sf_dir):
    """what a tolerant read drops, by reason."""
    report = files.csv_reject_report(spark, render_trips_with_rejects(spark, sf_dir), TRIP_COLUMNS)
    return report.groupBy("reason").agg(F.sum("rows").alias("rows"))


def q_orphans(spark, sf_dir):
    """Q3: trips whose end station is not in the station table."""
    inp = tables.role_inputs(spark, sf_dir)
    refs = [("end_station_id", tables.stations_clean(inp), "station_id")]
    return quality.quality_report(tables.trips_clean(inp), "int_trips_clean", refs=refs)


_DECLARED = {
    "stg_trips": ("trips", "trips", ddl(TRIP_COLUMNS)),
    "stg_weather_primary": ("weather_primary", "wx_primary_full", ddl(WEATHER_PRIMARY_COLUMNS)),
    "stg_weather_secondary": ("weather_secondary", "wx_secondary_full", ddl(WEATHER_SECONDARY_COLUMNS)),
}


def q_schema_report(spark, sf_dir):
    """Q4: declared columns and types asserted, with the nulls each column holds."""
    inp = tables.role_inputs(spark, sf_dir)
    out = None
    for model, (attribute, _, declared) in _DECLARED.items():
        df = assert_schema(getattr(inp, attribute), declared)
        types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
        part = quality.null_counts(df, df.columns).select(
            F.lit(model).alias("table_name"), "column_name",
            types[F.col("column_name")].alias("type_name"), F.col("violations").alias("nulls"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def _sql_schema_report() -> str:
    parts = []
    for model, (_, cte, declared) in _DECLARED.items():
        for item in declared.split(", "):
            name, typ = item.replace("`", "").split(" ")
            parts.append(
                f"SELECT '{model}' AS table_name, '{name}' AS column_name, '{typ}' AS type_name, "
                f"CAST(count(*) - count({name}) AS BIGINT) AS nulls FROM {cte}"
            )
    return oracle.with_ctes("\nUNION ALL\n".join(parts), *[cte for _, cte, _ in _DECLARED.values()])


def q_model_split(spark, sf_dir):
    """F10 + M1-M3: complete days of the v2 mart with the side of the split each falls on."""
    mart = modeling.written(marts.mart(tables.daily_features(tables.role_inputs(spark, sf_dir)), "daily", "v2"))
    feats = modeling.select_features(mart, "trip_date")
    clean = modeling.complete_cases(mart, [*feats, "total_trips__leaky"])
    train, test = modeling.chrono_split(clean, "trip_date", 0.8)
    sides = [df.withColumn("side", F.lit(side)) for side, df in (("train", train), ("test", test))]
    return round_doubles(sides[0].unionByName(sides[1]).select("trip_date", "side", "total_trips__leaky", *feats))


def _sql_model_split() -> str:
    cols = marts.mart_columns("daily", "v2")
    feats = [c for c in cols if modeling.LEAKY_SUFFIX not in c and c != "trip_date"]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*feats, "total_trips__leaky"])
    shown = ", ".join(f"round({c}, 6) AS {c}" if c in catalog.DAILY_DOUBLES else c for c in feats)
    return oracle.with_ctes(
        f"SELECT trip_date, CASE WHEN (SELECT count(*) FROM daily e WHERE {complete} "
        f"AND e.trip_date <= d.trip_date) <= (SELECT floor(count(*) * CAST(0.8 AS DOUBLE)) FROM daily WHERE {complete}) "
        f"THEN 'train' ELSE 'test' END AS side, total_trips__leaky, {shown} FROM daily d WHERE {complete}",
        "daily",
    )


def registry() -> dict[str, Query]:
    stations = oracle.with_ctes(
        "SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon) FROM stations_full", "stations_full")
    return {
        "t02_staged_stations": Query(q_staged_stations, stations),
        "s07_nested_stations": Query(q_nested_stations, stations),
        "t03_staged_weather_primary": Query(
            q_staged_weather_primary, catalog._sql("wx_primary_full", _WEATHER_DOUBLES[:5])),
        "t04_staged_weather_secondary": Query(
            q_staged_weather_secondary, catalog._sql("wx_secondary_full", _WEATHER_DOUBLES)),
        "t05_staged_holidays": Query(
            q_staged_holidays,
            oracle.with_ctes(
                "SELECT h.*, (SELECT count(*) FROM trips t WHERE CAST(t.start_time AS DATE) = h.holiday_date) AS trips "
                "FROM holidays h", "holidays", "trips")),
        "t06_staged_restrictions": Query(
            q_staged_restrictions,
            oracle.with_ctes(
                "SELECT r.*, (SELECT count(*) FROM trips t WHERE strftime(t.start_time, '%Y-%m') = "
                "strftime(r.report_date, '%Y-%m')) AS trips FROM restrictions r", "restrictions", "trips")),
        "f11_reject_report": Query(
            q_reject_report,
            oracle.with_ctes(
                "SELECT CASE WHEN trip_id % 29 = 0 THEN 'field_count' ELSE 'type:Trip  Duration' END AS reason, "
                "count(*) AS rows FROM trips WHERE trip_id % 29 = 0 OR bike_id % 17 = 0 GROUP BY 1", "trips")),
        "q03_orphans": Query(
            q_orphans,
            oracle.with_ctes(
                "SELECT 'int_trips_clean' AS table_name, 'end_station_id' AS column_name, 'relationships' AS check_name, "
                "count(*) AS violations FROM trips_clean WHERE end_station_id IS NOT NULL AND end_station_id NOT IN "
                "(SELECT station_id FROM stations_clean)", "trips_clean", "stations_clean")),
        "q04_schema_report": Query(q_schema_report, _sql_schema_report()),
        "f10_m01_m03_split": Query(q_model_split, _sql_model_split()),
    }
