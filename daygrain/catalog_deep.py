"""Registered queries, part four: measures of the build, merged sketches, typed JSON, keyed buckets, partitions, long gaps."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from . import catalog, catalog_more, catalog_staged, oracle
from .catalog import Query
from .functions.exprs import round_doubles
from .operators import aggregate, cleaning, staging, windows
from .plans import checks, marts, modeling, tables
from .schemas import TRIP_COLUMNS, station_schema
from .session import scratch_path
from .sources import files, roles, sinks

STATIONS_A_FILE = 1000


def q_observed_drops(spark, sf_dir):
    """F11 + S1: rows dropped by reason as the build's own scan counted them, as it kept them, and as a second scan reports them."""
    pattern = catalog_staged.render_trips_with_rejects(spark, sf_dir)
    marked = staging.stage_trips_marked(files.read_csv_marked(spark, pattern, TRIP_COLUMNS))
    inputs = replace(tables.role_inputs(spark, sf_dir), trips=staging.good_trips(marked), trips_marked=marked)
    project = marts.Project(inputs)
    project.build(["stg_trips"], out_dir=scratch_path(spark, "observed"))
    observed = checks.drop_report(spark, project).select("reason", F.col("rows").alias("observed"))
    kept = project.rejected.groupBy(F.col("reject_reason").alias("reason")).agg(F.count("reject_row").alias("quarantined"))
    report = files.csv_reject_report(spark, pattern, TRIP_COLUMNS).groupBy("reason").agg(F.sum("rows").alias("reported"))
    good = project.ref("stg_trips").agg(F.count(F.lit(1)).alias("kept_rows"))
    return observed.join(kept, "reason", "full").join(report, "reason", "full").crossJoin(good)


def q_observed_report(spark, sf_dir):
    """Q1 + Q2: the declared tests of a calendar, the daily table and its v2 mart, measured while they are written."""
    project = marts.Project(tables.role_inputs(spark, sf_dir))
    models = ["stg_restrictions", "int_daily", "fct_trips_daily_v2"]
    project.build(models, out_dir=scratch_path(spark, "observed"))
    return checks.observed_report(spark, project, models)


_COUNTS = [name for _, name in aggregate.DISTINCT_COUNTS]


def _period_distinct(trips, counts):
    """Weeks and months in one table: unit, period, the three counts."""
    out = None
    for unit in ("week", "month"):
        part = counts(trips, unit)
        part = part.select(F.lit(unit).alias("unit"), F.col(aggregate.PERIOD_KEYS[unit]).alias("period"), *_COUNTS)
        out = part if out is None else out.unionByName(part)
    return out


def q_period_distinct(spark, sf_dir):
    """A5 over whole weeks and months, exact."""
    return _period_distinct(tables.trips_clean(tables.role_inputs(spark, sf_dir)), aggregate.period_distinct)


def q_period_distinct_sketch(spark, sf_dir):
    """A5 / A19 opt-in approximate: daily sketches stored once and merged, against the exact counts.

    ``within_bound``: no estimate is off by more than five standard errors of
    a sketch (at least one, as small counts are rounded).
    """
    trips = tables.trips_clean(tables.role_inputs(spark, sf_dir))
    stored = sinks.materialize(aggregate.daily_sketches(trips), scratch_path(spark, "sketches"))
    exact = _period_distinct(trips, aggregate.period_distinct)
    merged = _period_distinct(stored, aggregate.merge_sketches).select("unit", "period", *[F.col(c).alias(f"_{c}") for c in _COUNTS])
    error = 5 * aggregate.sketch_error()
    near = F.lit(True)
    for c in _COUNTS:
        near = near & (F.abs(F.col(f"_{c}") - F.col(c)) <= F.greatest(F.lit(1.0), F.lit(error) * F.col(c)))
    return exact.join(merged, ["unit", "period"], "left").select("unit", "period", *_COUNTS, F.coalesce(near, F.lit(False)).alias("within_bound"))


def _sql_period_distinct(extra: str = "") -> str:
    counts = ", ".join(f"count(DISTINCT {c}) AS {name}" for c, name in aggregate.DISTINCT_COUNTS)
    parts = [f"SELECT '{u}' AS unit, CAST(date_trunc('{u}', CAST(start_time AS DATE)) AS TIMESTAMP) AS period, {counts}{extra} FROM trips_clean GROUP BY 2"
             for u in ("week", "month")]
    return oracle.with_ctes("\nUNION ALL\n".join(parts), "trips_clean")


def q_array_stations(spark, sf_dir):
    """Station records as a top-level JSON array, a document per thousand suppliers."""
    path = scratch_path(spark, "stations-array")
    stations = roles.stations(spark, sf_dir)
    part = F.floor(F.col("station_id").cast("bigint") / STATIONS_A_FILE)
    arrays = stations.groupBy(part.alias("part")).agg(F.to_json(F.collect_list(F.struct(*stations.columns))).alias("value"))
    arrays.repartition("part").write.partitionBy("part").text(path)
    records = files.read_json_records(spark, f"{path}/part=*/*.txt", station_schema(), layout="array", key="station_id")
    return round_doubles(tables.cleaning.clean_stations(staging.stage_stations(records)))


def q_json_variant(spark, sf_dir):
    """JSON objects as maps of typed values, read by key and path.

    The objects nest the event's properties, its numbers and its type.
    """
    events = roles.events(spark, sf_dir)
    nested = F.to_json(
        F.struct(
            F.col("value").alias("num"),
            F.col("event_type").alias("kind"),
            F.struct(F.parse_json("props").alias("props"), F.array("user_id", F.col("event_id") % 7).alias("ids")).alias("deep"),
            (F.col("event_id") % 2 == 0).alias("even"),
        )
    )
    values = events.select("event_id", staging.parse_json_variants(nested).alias("m"), staging.parse_json_variants("props").alias("p"))
    m = F.col("m")
    return values.select(
        "event_id",
        staging.json_value(F.col("p"), "k", "$", "bigint").alias("prop"),
        staging.json_value(m, "deep", "$.props.k", "bigint").alias("nested_prop"),
        staging.json_value(m, "deep", "$.ids[1]", "bigint").alias("second_id"),
        F.round(staging.json_value(m, "num", "$", "double"), 6).alias("num"),
        staging.json_value(m, "even", "$", "boolean").alias("even"),
        staging.json_value(m, "deep", "$.none", "string").alias("absent"),
        F.when(staging.json_type(m, "kind") == "STRING", staging.json_value(m, "kind")).alias("kind"),
        F.cardinality("m").cast("bigint").alias("keys"),
    )


_SQL_VARIANT = """
WITH e AS (
  SELECT event_id, props, json_object('num', value, 'kind', event_type, 'even', event_id % 2 = 0,
         'deep', json_object('props', CAST(props AS JSON), 'ids', [user_id, event_id % 7])) AS j FROM events)
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS prop,
       CAST(json_extract(j, '$.deep.props.k') AS BIGINT) AS nested_prop,
       CAST(json_extract(j, '$.deep.ids[1]') AS BIGINT) AS second_id,
       round(CAST(json_extract(j, '$.num') AS DOUBLE), 6) AS num,
       CAST(json_extract(j, '$.even') AS BOOLEAN) AS even,
       json_extract_string(j, '$.deep.none') AS absent,
       json_extract_string(j, '$.kind') AS kind, CAST(len(json_keys(j)) AS BIGINT) AS keys
FROM e
"""

#: Rows of a bucket in the keyed query, and the series that gathers every third station.
BUCKET_ROWS, GATHERED = 2000, 3


def keyed_spec() -> windows.FeatureSpec:
    """Lags, frames and changes of the trips of one station."""
    spec = windows.FeatureSpec("hour_start", "h", ("station",))
    spec.lags("trips", "trips", [1, 2, 24, 168]).rolling("trips", "trips", 24, windows.ALL_STATS)
    return spec.rolling("longest", "longest", 168, ["avg", "max"]).change("trips", "trips", 1, 24)


def station_hours(trips):
    """Trips per station and hour; every third station counts to one, so a third of all rows are one series."""
    station = F.when(F.col("start_station_id") % GATHERED == 0, F.lit(0)).otherwise(F.col("start_station_id"))
    hour = F.date_trunc("hour", "start_time").cast("timestamp_ntz")
    grouped = trips.groupBy(station.cast("bigint").alias("station"), hour.alias("hour_start"))
    return grouped.agg(F.count(F.lit(1)).alias("trips"), F.max("trip_duration").alias("longest"))


def q_keyed_buckets(spark, sf_dir):
    """W2-W17 with a series per station, in buckets with a halo: a hot station is many tasks' work."""
    hours = station_hours(tables.trips_clean(tables.role_inputs(spark, sf_dir)))
    return round_doubles(windows.add_features_bucketed(hours, keyed_spec(), BUCKET_ROWS))


def _sql_keyed_buckets() -> str:
    spec = keyed_spec()
    items = oracle.feature_sql(spec).replace("OVER (", "OVER (PARTITION BY station ")
    doubles = [f.name for f in spec.features if isinstance(f, windows.Change) or getattr(f, "stat", "") in ("avg", "std", "median")]
    shown = ", ".join(f"round({n}, 6) AS {n}" if n in doubles else n for n in spec.names())
    return oracle.with_ctes(
        f"""SELECT station, hour_start, trips, longest, {shown} FROM (SELECT *, {items} FROM (
        SELECT CASE WHEN start_station_id % {GATHERED} = 0 THEN 0 ELSE start_station_id END AS station,
               date_trunc('hour', start_time) AS hour_start, count(*) AS trips, max(trip_duration) AS longest
        FROM trips_clean GROUP BY 1, 2))""",
        "trips_clean",
    )


def q_partition_rebuild(spark, sf_dir):
    """S10 + S13 + F9: the daily mart by year; 1996 rebuilt from its own rows, the other years left; read since a date."""
    project = marts.Project(tables.role_inputs(spark, sf_dir))
    path, layout = scratch_path(spark, "by-year"), {"fct_trips_daily_v2": ["year"]}
    project.build(["fct_trips_daily_v2"], out_dir=path, partition_by=layout)
    table = f"{path}/fct_trips_daily_v2"
    again = project.ref("fct_trips_daily_v2").where("year = 1996").withColumn("total_trips__leaky", -F.col("total_trips__leaky"))
    sinks.materialize(again, table, ["year"], replace="partitions")
    return round_doubles(sinks.read_mart(spark, table, "trip_date", "1995-07-01", year="year").withColumn("year", F.col("year").cast("bigint")))


def _sql_partition_rebuild() -> str:
    cols = marts.mart_columns("daily", "v2")
    shown = {c: f"round({c}, 6) AS {c}" if c in catalog.DAILY_DOUBLES else c for c in cols}
    shown["total_trips__leaky"] = "CASE WHEN year = 1996 THEN -total_trips__leaky ELSE total_trips__leaky END AS total_trips__leaky"
    return oracle.with_ctes(f"SELECT {', '.join(shown.values())} FROM daily WHERE trip_date >= DATE '1995-07-01'", "daily")


def _gappy(inp: tables.Inputs):
    """Both weather feeds without the days 11 to 14 of a month, and without values from the 20th to the 22nd."""
    day = F.dayofmonth("date_time")
    out = []
    for feed in (inp.weather_primary, inp.weather_secondary):
        lost = {c: F.when(~day.between(20, 22), F.col(c)) for c in cleaning.TEMPERATURES}
        out.append(feed.where(~day.between(11, 14)).withColumns(lost))
    return out


def q_weather_all_gaps(spark, sf_dir):
    """W18 + T9, documented intent: continuous daily weather, gaps of any length filled from the nearest known days."""
    return round_doubles(cleaning.clean_weather(*_gappy(tables.role_inputs(spark, sf_dir)), gaps="all"))


def _sql_weather_all_gaps() -> str:
    lost = ", ".join(f"CASE WHEN day(date_time) BETWEEN 20 AND 22 THEN NULL ELSE {c} END AS {c}" for c in cleaning.TEMPERATURES)
    feed = lambda t: f"SELECT * REPLACE ({lost}) FROM {t} WHERE day(date_time) NOT BETWEEN 11 AND 14"
    known = " UNION ALL ".join(
        f"SELECT '{c}' AS c, p.date_time AS d, coalesce(p.{c}, s.{c}) AS v FROM gp p LEFT JOIN gs s USING (date_time) "
        f"WHERE coalesce(p.{c}, s.{c}) IS NOT NULL" for c in cleaning.TEMPERATURES)
    site = ", ".join(f"CASE WHEN p.mean_temp_c IS NULL THEN s.{c} ELSE p.{c} END AS {c}"
                     for c in ("longitude", "latitude", "station_name", "climate_id"))
    value = ", ".join(
        f"coalesce((SELECT v FROM known k WHERE k.c = '{c}' AND k.d = x.d), "
        f"((SELECT arg_max(v, d) FROM known k WHERE k.c = '{c}' AND k.d < x.d) + "
        f"(SELECT arg_min(v, d) FROM known k WHERE k.c = '{c}' AND k.d > x.d)) / 2) AS {c}" for c in cleaning.TEMPERATURES)
    days = "SELECT CAST(unnest(generate_series(min(date_time), max(date_time), INTERVAL 1 DAY)) AS DATE) AS d FROM gp"
    return oracle.with_ctes(
        f"""SELECT round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, station_name, climate_id, d AS date_time,
        CAST(year(d) AS BIGINT) AS year, lpad(CAST(month(d) AS VARCHAR), 2, '0') AS month,
        lpad(CAST(day(d) AS VARCHAR), 2, '0') AS day, {", ".join(f"round({c}, 6) AS {c}" for c in cleaning.TEMPERATURES)},
        round(coalesce(rain, 0), 6) AS total_precip_mm, CAST(coalesce(snow, 0) AS BIGINT) AS snow_on_grnd_cm
        FROM (WITH gp AS ({feed("wx_primary")}), gs AS ({feed("wx_secondary")}), known AS ({known})
        SELECT x.d, {site}, {value}, s.total_precip_mm AS rain, s.snow_on_grnd_cm AS snow
        FROM ({days}) x LEFT JOIN gp p ON p.date_time = x.d
        LEFT JOIN gs s ON s.date_time = p.date_time) filled""",
        "wx_primary", "wx_secondary")


def q_forest_report(spark, sf_dir):
    """M4-M6 + O3: what must hold of the fitted forest, beside the sizes of the split."""
    mart = modeling.written(marts.mart(tables.daily_features(tables.role_inputs(spark, sf_dir)), "daily", "v2"))
    feats = modeling.select_features(mart, "trip_date")
    clean = modeling.complete_cases(mart, [*feats, "total_trips__leaky"])
    train, test = modeling.chrono_split(clean, "trip_date", 0.8)
    model = modeling.fit_forest(train, feats, trees=20, seed=42)
    ranked = modeling.importances(model, feats, spark)
    top = modeling.top_features(ranked, 5)
    score = modeling.r2(model, test, feats)
    weights = ranked.agg(F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total_importance"), F.min("importance").alias("_least"))
    shown = top.agg(F.count(F.lit(1)).alias("top_rows"), F.max("importance").alias("_most"))
    sizes = train.agg(F.count(F.lit(1)).alias("train_rows")).crossJoin(test.agg(F.count(F.lit(1)).alias("test_rows")))
    out = sizes.crossJoin(weights).crossJoin(shown)  # one row each
    return out.select(
        "train_rows", "test_rows", "features", "total_importance", "top_rows",
        ((F.col("_least") >= 0) & (F.col("_most") <= 1)).alias("importances_fit"),
        F.lit(score <= 1.0).alias("r2_fits"),
    )


def _sql_forest_report() -> str:
    feats = [c for c in marts.mart_columns("daily", "v2") if modeling.LEAKY_SUFFIX not in c and c != "trip_date"]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*feats, "total_trips__leaky"])
    return oracle.with_ctes(
        f"""SELECT CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS train_rows, n - CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS test_rows,
        CAST({len(feats)} AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total_importance, CAST(5 AS BIGINT) AS top_rows,
        true AS importances_fit, true AS r2_fits FROM (SELECT count(*) AS n FROM daily WHERE {complete})""",
        "daily",
    )


def registry() -> dict[str, Query]:
    rejects = (
        "SELECT CASE WHEN trip_id % 29 = 0 THEN 'field_count' ELSE 'type:Trip  Duration' END AS reason, count(*) AS observed, "
        "count(*) AS quarantined, count(*) AS reported, (SELECT count(*) FROM trips WHERE trip_id % 29 <> 0 AND bike_id % 17 <> 0) AS kept_rows "
        "FROM trips WHERE trip_id % 29 = 0 OR bike_id % 17 = 0 GROUP BY 1"
    )
    stations = (
        "SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon, "
        "round(nearby_distance, 6) AS nearby_distance) FROM stations_clean"
    )
    return {
        "f11_observed_drops": Query(q_observed_drops, oracle.with_ctes(rejects, "trips")),
        "q01_q02_observed_report": Query(q_observed_report, catalog_more._sql_quality()),
        "a05_period_distinct": Query(q_period_distinct, _sql_period_distinct()),
        "a05_period_distinct_sketch": Query(q_period_distinct_sketch, _sql_period_distinct(", true AS within_bound")),
        "s02_json_array_stations": Query(q_array_stations, oracle.with_ctes(stations, "stations_clean")),
        "x19_json_variant": Query(q_json_variant, _SQL_VARIANT),
        "w02_w17_keyed_buckets": Query(q_keyed_buckets, _sql_keyed_buckets()),
        "s10_f09_partition_rebuild": Query(q_partition_rebuild, _sql_partition_rebuild()),
        "t09_clean_weather_all_gaps": Query(q_weather_all_gaps, _sql_weather_all_gaps()),
        "m04_m06_forest_report": Query(q_forest_report, _sql_forest_report()),
    }
