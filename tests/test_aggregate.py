"""Daily aggregates, busiest pair, weekend rule, roll-ups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daygrain.functions import dates
from daygrain.operators import aggregate

TRIP_DDL = ("trip_id bigint, trip_duration bigint, start_station_id bigint, start_time timestamp_ntz, "
            "end_station_id string, bike_id bigint, user_type string")


def ts(day, h=8):
    return dt.datetime(2024, 1, day, h, 0)


@pytest.fixture()
def trips(spark):
    rows = [
        # day 1: one trip only -> null stddev, null casual average
        (1, 600, 1, ts(1), "2", 10, "Annual Member"),
        # day 2: only casual trips -> null member average; pair (3,4) x2 wins over (1,2) x2 by tie-break? no:
        (2, 100, 3, ts(2), "4", 11, "Casual Member"),
        (3, 200, 3, ts(2, 9), "4", 11, "Casual Member"),
        (4, 300, 1, ts(2, 10), "2", 12, "Casual Member"),
        (5, 400, 1, ts(2, 11), "2", 13, "Casual Member"),
        (6, 500, 5, ts(2, 12), "6", 13, "Other"),  # user type outside the two values
    ]
    return spark.createDataFrame(rows, TRIP_DDL)


@pytest.mark.parametrize("distinct", ["shared", "split", "fused"])
def test_daily_measures(trips, distinct):
    made = aggregate.daily_shared(trips) if distinct == "shared" else aggregate.daily_measures(trips, distinct=distinct)
    out = {r.trip_date.day: r for r in made.collect()}
    one, two = out[1], out[2]
    assert one.total_trips__leaky == 1 and one.stddev_trip_duration__leaky is None
    assert one.avg_casual_member_duration__leaky is None and one.annual_member_ratio__leaky == 1.0
    assert two.total_trips__leaky == 5 and two.annual_member_trips__leaky == 0
    assert two.casual_member_trips__leaky == 4 and two.avg_annual_member_duration__leaky is None
    assert two.unique_bikes__leaky == 3 and two.unique_start_stations__leaky == 3
    assert two.unique_end_stations__leaky == 3
    assert two.median_trip_duration__leaky == 300.0
    assert two.p25_trip_duration__leaky == 200.0 and two.p75_trip_duration__leaky == 400.0
    assert (two.min_trip_duration__leaky, two.max_trip_duration__leaky) == (100, 500)


@pytest.mark.parametrize("mode", ["window", "struct"])
def test_top_pair_tie_break(trips, mode):
    out = {r.trip_date.day: r for r in aggregate.top_pair(trips, mode).collect()}
    # day 2: (1,2) and (3,4) both have 2 trips; the smaller start id wins
    assert (out[2].top_start_station_id__leaky, out[2].top_end_station_id__leaky) == (1, "2")
    assert out[2].top_start_station_trips__leaky == 2 == out[2].top_end_station_trips__leaky
    assert out[1].top_start_station_id__leaky == 1


def test_top_pair_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, 60, None, ts(1), "2", 1, "Annual Member"), (2, 60, 5, ts(1), "2", 1, "Annual Member")], TRIP_DDL
    )
    for mode in ("window", "struct"):
        r = aggregate.top_pair(df, mode).collect()[0]
        assert r.top_start_station_id__leaky == 5


def test_weekend_rule(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 8)], "d date")
    rows = df.select(
        "d",
        dates.day_of_week("d").alias("dow"),
        dates.day_name("d").alias("name"),
        dates.is_weekend("d").alias("ref"),
        dates.is_weekend("d", "sat_sun").alias("doc"),
    ).collect()
    ref = {r.name for r in rows if r.ref}
    doc = {r.name for r in rows if r.doc}
    assert ref == {"Saturday"} and doc == {"Saturday", "Sunday"}
    assert {r.name: r.dow for r in rows}["Sunday"] == 0


def test_period_start_is_monday_and_ntz(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    r = df.select(dates.period_start("d", "week").alias("w"), dates.period_start("d", "month").alias("m")).collect()[0]
    assert r.w == dt.datetime(2024, 1, 1) and r.m == dt.datetime(2024, 1, 1)
    assert dict(df.select(dates.period_start("d", "week").alias("w")).dtypes)["w"] == "timestamp_ntz"


def test_rollup_is_consistent_with_daily(spark):
    from daygrain.plans import tables

    from .conftest import SF001

    daily = tables.daily_features(tables.role_inputs(spark, SF001))
    weekly = tables.weekly_features(daily)
    a = daily.agg(F.sum("total_trips__leaky")).first()[0]
    b = weekly.agg(F.sum("total_trips__leaky")).first()[0]
    assert a == b
    assert weekly.agg(F.sum("days_in_week")).first()[0] == daily.count()


def test_top_station_per_role(spark):
    rows = [
        (1, 60, 1, ts(3), "9", 1, "Annual Member"),
        (2, 60, 1, ts(3), "8", 2, "Annual Member"),
        (3, 60, 2, ts(3), "7", 3, "Annual Member"),
        (4, 60, 3, ts(3), "7", 4, "Annual Member"),
        (5, 60, 3, ts(3), "7", 5, "Annual Member"),
    ]
    df = spark.createDataFrame(rows, TRIP_DDL)
    r = aggregate.top_station_per_role(df).collect()[0]
    # starts: 1 x2, 3 x2 -> 1 (tie, smaller id); ends: 7 x3
    assert (r.top_start_station_id__leaky, r.top_start_station_trips__leaky) == (1, 2)
    assert (r.top_end_station_id__leaky, r.top_end_station_trips__leaky) == ("7", 3)
    # the reference's pair ranking picks the busiest (start, end) pair instead: (3, 7) x2
    p = aggregate.top_pair(df).collect()[0]
    assert (p.top_start_station_id__leaky, p.top_end_station_id__leaky, p.top_start_station_trips__leaky) == (3, "7", 2)
