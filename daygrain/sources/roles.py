"""Role views: the driver's parquet tables seen as the reference's inputs.

The reference reads bike-share trips, a station list, two weather stations
and two calendar seeds.  The test data is a TPC-H-like star schema, so each
input is derived from one table by plain column expressions (the derivations
are our own, listed in SURVEY section 7.3).  Every view is a lazy scan with
a projection: Catalyst prunes the parquet columns a query does not use and
pushes filters into the scan.

The staged shapes (T1-T4) are produced directly, because the parquet
columns are already typed; the raw-file path (CSV/JSON) is exercised by
``sources.files`` and its tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STATION_FIELDS


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _minutes(c: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), c.cast("int"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged trips (T1 shape, 10 columns) from ``lineitem``."""
    li = _read(spark, sf_dir, "lineitem")
    missing = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7)
    duration = F.when(missing, F.lit(None).cast("bigint")).otherwise(
        F.col("l_quantity").cast("bigint") * 60
    )
    start = F.col("l_shipdate") + _minutes(F.col("l_partkey") % 1440)
    end = F.when(missing, start).otherwise(start + _minutes(F.col("l_quantity")))
    start_id = F.col("l_suppkey")
    # Text ids as raw files hold them: padded, non-numeric and the word NULL among them.
    number = (F.col("l_partkey") % 120).cast("string")
    end_id = (
        F.when(F.col("l_partkey") % 211 == 0, F.lit("NULL"))
        .when(F.col("l_partkey") % 223 == 0, F.concat(F.lit("SX"), number))
        .when(F.col("l_partkey") % 7 == 0, F.lpad(number, 5, "0"))
        .otherwise(number)
    )
    return li.select(
        F.col("l_orderkey").alias("trip_id"),
        duration.alias("trip_duration"),
        start_id.alias("start_station_id"),
        start.alias("start_time"),
        F.concat(F.lit("Station "), start_id.cast("string")).alias("start_station_name"),
        end_id.alias("end_station_id"),
        end.alias("end_time"),
        F.concat(F.lit("Station "), end_id).alias("end_station_name"),
        F.col("l_partkey").alias("bike_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("Annual Member"))
        .otherwise(F.lit("Casual Member"))
        .alias("user_type"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged stations (T2 shape, 19 columns) from ``supplier``."""
    s = _read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    n = F.col("s_nationkey")
    cols = {
        "station_id": k.cast("string"),
        "name": F.col("s_name"),
        "physical_configuration": F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(n % 2 == 0, F.lit("REGULAR"))
        .otherwise(F.lit("ELECTRICBIKESTATION")),
        "lat": F.lit(43.6) + k.cast("double") / 10000,
        "lon": F.lit(-79.4) - n.cast("double") / 1000,
        "altitude": F.when(k % 2 == 0, F.lit(None).cast("double")).otherwise(F.lit(0.0)),
        "address": F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.col("s_name"), F.lit(" Street"))
        ),
        "capacity": (n + 10).cast("bigint"),
        "is_charging_station": k % 3 == 0,
        "rental_methods": F.when(k % 6 == 0, F.lit(None).cast("array<string>")).otherwise(
            F.array(F.lit("KEY"), F.lit("CREDITCARD"))
        ),
        "groups": F.array(n.cast("string")),
        "obcn": F.concat(F.lit("416-"), k.cast("string")),
        "short_name": k.cast("string"),
        "nearby_distance": F.lit(500.0),
        "_ride_code_support": F.lit(True),
        "rental_uris": F.when(k % 4 == 0, F.create_map().cast("map<string,string>")).otherwise(
            F.create_map(F.lit("ios"), F.concat(F.lit("app://"), k.cast("string")), F.lit("web"), F.col("s_name"))
        ),
        "post_code": F.lit(None).cast("string"),
        "is_valet_station": F.lit(None).cast("boolean"),
        "cross_street": F.lit(None).cast("string"),
    }
    return s.select(*[cols[name].cast(t).alias(name) for name, t in STATION_FIELDS])


def _daily_weather(orders: DataFrame, station: str, climate_id: int, lon: float, lat: float) -> DataFrame:
    d = F.to_date(F.col("o_orderdate"))
    base = orders.groupBy(d.alias("date_time")).agg(
        F.max("o_custkey").alias("_hi"),
        F.min("o_custkey").alias("_lo"),
        F.sum("o_custkey").alias("_sum"),
        F.count(F.lit(1)).alias("_n"),
    )
    gap = F.dayofmonth("date_time") % 10 == 0
    temp = lambda e: F.when(gap, F.lit(None).cast("double")).otherwise(e)
    return base.select(
        F.lit(lon).alias("longitude"),
        F.lit(lat).alias("latitude"),
        F.lit(station).alias("station_name"),
        F.lit(climate_id).cast("bigint").alias("climate_id"),
        F.col("date_time"),
        F.year("date_time").cast("bigint").alias("year"),
        F.lpad(F.month("date_time").cast("string"), 2, "0").alias("month"),
        F.lpad(F.dayofmonth("date_time").cast("string"), 2, "0").alias("day"),
        F.when(F.dayofmonth("date_time") % 13 == 0, F.lit("†")).alias("data_quality"),
        temp((F.col("_hi") % 350).cast("double") / 10).alias("max_temp_c"),
        F.when(gap, F.lit("M")).alias("max_temp_flag"),
        temp((F.col("_lo") % 200).cast("double") / 10 - 10).alias("min_temp_c"),
        F.when(gap, F.lit("M")).alias("min_temp_flag"),
        temp((F.col("_sum") % 250).cast("double") / 10).alias("mean_temp_c"),
        "_n",
    )


def weather_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged primary weather (T3 shape, 14 columns): orders per day."""
    w = _daily_weather(_read(spark, sf_dir, "orders"), "PRIMARY STATION", 1001, -79.40, 43.67)
    return w.drop("_n")


def weather_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged secondary weather (T4 shape, 31 columns): finished orders per day."""
    orders = _read(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    w = _daily_weather(orders, "SECONDARY STATION", 1002, -79.63, 43.68)
    d = F.col("date_time")
    n, mean = F.col("_n"), F.col("mean_temp_c")
    flag = lambda k, mark: F.when(F.dayofmonth(d) % k == 0, F.lit(mark))
    precip = F.when(F.dayofmonth(d) % 9 == 0, F.lit(None).cast("double")).otherwise(
        (F.col("_n") % 7).cast("double") * 1.5
    )
    snow = F.when(F.month(d).isin(12, 1, 2), F.col("_n") % 5).otherwise(F.lit(0)).cast("bigint")
    return w.select(
        *[c for c in w.columns if c != "_n"],
        flag(10, "M").alias("mean_temp_flag"),
        F.when(mean < 18, 18 - mean).when(mean >= 18, 0.0).alias("heat_deg_days_c"),
        flag(10, "M").alias("heat_deg_days_flag"),
        F.when(mean > 18, mean - 18).when(mean <= 18, 0.0).alias("cool_deg_days_c"),
        flag(10, "M").alias("cool_deg_days_flag"),
        (n % 7).cast("string").alias("total_rain_mm"),
        flag(9, "T").alias("total_rain_flag"),
        F.when(F.month(d).isin(12, 1, 2), (n % 5).cast("string")).alias("total_snow_cm"),
        flag(8, "T").alias("total_snow_flag"),
        precip.alias("total_precip_mm"),
        flag(9, "M").alias("total_precip_flag"),
        snow.alias("snow_on_grnd_cm"),
        flag(12, "E").alias("snow_on_grnd_flag"),
        F.when(n % 3 != 0, (n % 36).cast("string")).alias("dir_of_max_gust_10s_deg"),
        flag(11, "E").alias("dir_of_max_gust_flag"),
        F.when(n % 3 == 0, F.lit("<31")).otherwise((n % 40 + 31).cast("string")).alias("spd_of_max_gust_kmh"),
        flag(11, "E").alias("spd_of_max_gust_flag"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON properties (X19): ``events.props`` holds small JSON objects."""
    return _read(spark, sf_dir, "events")


def render_weather_files(inp, root: str) -> dict[str, str]:
    """Write both weather roles as raw CSV (reference headers); returns globs."""
    from ..schemas import WEATHER_PRIMARY_COLUMNS, WEATHER_SECONDARY_COLUMNS
    from .files import write_raw_csv

    write_raw_csv(inp.weather_primary, f"{root}/wx_primary", WEATHER_PRIMARY_COLUMNS)
    write_raw_csv(inp.weather_secondary, f"{root}/wx_secondary", WEATHER_SECONDARY_COLUMNS)
    return {"weather_primary": f"{root}/wx_primary/*.csv", "weather_secondary": f"{root}/wx_secondary/*.csv"}


def render_raw_files(spark: SparkSession, inp, root: str) -> dict[str, str]:
    """Write staged role inputs in the reference's raw layouts below ``root``.

    Trips go to two folders of header CSV, the second with its columns in
    reverse order; stations to JSON lines; weather to raw CSV; the calendars
    to seed CSVs.  Returns the paths / globs to read them back with.
    """
    from ..schemas import TRIP_COLUMNS
    from .files import write_raw_csv

    canonical = [c[0] for c in TRIP_COLUMNS]
    even = F.col("trip_id") % 2 == 0
    write_raw_csv(inp.trips.filter(even), f"{root}/trips/ridership-a", TRIP_COLUMNS)
    write_raw_csv(inp.trips.filter(~even), f"{root}/trips/ridership-b", TRIP_COLUMNS, canonical[::-1])
    inp.stations.write.mode("overwrite").json(f"{root}/stations")
    paths = render_weather_files(inp, root)
    from . import calendars

    calendars.holiday_seed(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{root}/hol")
    calendars.restriction_seed(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{root}/cov")
    paths.update(
        trips=f"{root}/trips/ridership-*/*.csv",
        stations=f"{root}/stations",
        holidays=f"{root}/hol",
        restrictions=f"{root}/cov",
    )
    return paths
