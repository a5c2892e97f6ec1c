"""Weather fallback merge and single-gap interpolation."""

import datetime as dt

from daygrain.operators import cleaning

P_DDL = ("longitude double, latitude double, station_name string, climate_id bigint, date_time date, "
         "year bigint, month string, day string, max_temp_c double, min_temp_c double, mean_temp_c double")
S_DDL = P_DDL + ", total_precip_mm double, snow_on_grnd_cm bigint"


def d(n):
    return dt.date(2024, 1, n)


def p(n, mx, mn, mean):
    return (-79.4, 43.6, "P", 1, d(n), 2024, "01", f"{n:02d}", mx, mn, mean)


def s(n, mx, mn, mean, precip=1.0, snow=2):
    return (-79.6, 43.7, "S", 2, d(n), 2024, "01", f"{n:02d}", mx, mn, mean, precip, snow)


def test_merge_and_interpolate(spark):
    prim = spark.createDataFrame([
        p(1, None, None, None),  # first day null, no secondary -> stays null
        p(2, 10.0, 0.0, 5.0),  # primary present
        p(3, None, None, None),  # secondary fallback
        p(4, None, None, None),  # both null, single gap -> interpolated
        p(5, 14.0, 4.0, 9.0),
        p(6, None, None, None),  # two-day gap: stays null
        p(7, None, None, None),
        p(8, 20.0, 10.0, 15.0),
        p(9, 30.0, None, None),  # mean null, max present: identity follows secondary
        p(10, None, None, None),  # last day null -> stays null
    ], P_DDL)
    sec = spark.createDataFrame([
        s(2, 99.0, 99.0, 99.0, precip=None, snow=None),
        s(3, 11.0, 1.0, 6.0),
        s(9, 31.0, 2.0, 16.0, precip=3.5, snow=0),
    ], S_DDL)
    out = {r.date_time.day: r for r in cleaning.clean_weather(prim, sec).collect()}
    assert len(out) == 10
    assert out[1].max_temp_c is None and out[1].total_precip_mm == 0.0 and out[1].snow_on_grnd_cm == 0
    assert (out[2].max_temp_c, out[2].station_name, out[2].total_precip_mm) == (10.0, "P", 0.0)
    assert (out[3].max_temp_c, out[3].mean_temp_c, out[3].station_name, out[3].climate_id) == (11.0, 6.0, "S", 2)
    assert out[3].total_precip_mm == 1.0 and out[3].snow_on_grnd_cm == 2
    assert out[4].max_temp_c == (11.0 + 14.0) / 2 and out[4].mean_temp_c == (6.0 + 9.0) / 2
    # identity columns follow the primary mean before interpolation: null mean and
    # no secondary row -> null identity, as in the reference
    assert out[4].station_name is None and out[5].station_name == "P"
    assert out[6].max_temp_c is None and out[7].max_temp_c is None
    assert (out[9].max_temp_c, out[9].min_temp_c, out[9].mean_temp_c) == (30.0, 2.0, 16.0)
    assert (out[9].station_name, out[9].latitude) == ("S", 43.7)
    assert out[10].max_temp_c is None
    assert [f.name for f in cleaning.clean_weather(prim, sec).schema.fields][-2:] == ["total_precip_mm", "snow_on_grnd_cm"]


def test_interpolate_per_series(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("b", 1, 10.0), ("b", 2, None), ("b", 3, None)],
        "k string, t int, x double",
    )
    out = {(r.k, r.t): r.x for r in cleaning.interpolate_single_gaps(df, "t", ["x"], ["k"]).collect()}
    assert out[("a", 2)] == 2.0 and out[("b", 2)] is None


def test_clean_trips_drops_null_duration(spark):
    df = spark.createDataFrame([(1, None), (2, 60)], "trip_id bigint, trip_duration bigint")
    assert [r.trip_id for r in cleaning.clean_trips(df).collect()] == [2]
