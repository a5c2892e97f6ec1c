"""Role joins, fan-out fallback, key casting, size-checked broadcast."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from daygrain.operators import joins
from daygrain.plans import tables

from .conftest import SF001


def test_text_station_key_matches_number(spark):
    facts = spark.createDataFrame([(7000,), (5,)], "start_station_id bigint")
    dim = spark.createDataFrame([("07000", "Seven")], "station_id string, name string")
    out = joins.role_join(facts, dim, F.col("start_station_id"), F.col("station_id").cast("bigint"),
                          "start_station_", ["name"])
    got = {r.start_station_id: r.start_station_name for r in out.collect()}
    assert got == {7000: "Seven", 5: None}


def test_non_numeric_station_id_fails(spark):
    facts = spark.createDataFrame([(1,)], "start_station_id bigint")
    dim = spark.createDataFrame([("abc", "X")], "station_id string, name string")
    with pytest.raises(Exception):
        joins.role_join(facts, dim, F.col("start_station_id"), F.col("station_id").cast("bigint"),
                        "s_", ["name"]).collect()


def test_end_role_compares_text(spark):
    inp = tables.role_inputs(spark, SF001)
    trip = tables.trips_clean(inp).limit(1)
    ids = ["7000", "07000", "NULL", "SX1"]
    trips = trip.drop("end_station_id").crossJoin(spark.createDataFrame([(i,) for i in ids], "end_station_id string"))
    dim = tables.stations_clean(inp).limit(1).withColumn("station_id", F.lit("7000"))
    out = joins.enrich_trips(trips, dim, tables.weather_clean(inp)).collect()
    assert {r.end_station_id: r.end_station_name is not None for r in out} == {i: i == "7000" for i in ids}


def test_duplicate_dimension_key_fans_out(spark):
    facts = spark.createDataFrame([(1,), (2,)], "start_station_id bigint")
    dim = spark.createDataFrame([("1", "A"), ("1", "B")], "station_id string, name string")
    out = joins.role_join(facts, dim, F.col("start_station_id"), F.col("station_id").cast("bigint"), "s_", ["name"])
    assert out.count() == 3
    assert not joins.is_keyed(dim, [F.col("station_id").cast("bigint")])


def test_size_check_decides_broadcast(spark):
    small = spark.range(10)
    assert joins.within_bytes(small, 100) and not joins.within_bytes(small, 50)
    plan = spark.range(100).join(joins.size_checked(small, 100), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    big = spark.range(1000)
    assert joins.size_checked(big, 10) is big


def test_join_first_plan_used_when_stations_repeat(spark):
    inp = tables.role_inputs(spark, SF001)
    dup = inp.stations.unionByName(inp.stations.filter(F.col("station_id") == "3"))
    inp2 = dataclasses.replace(inp, stations=dup, keyed=None)
    assert tables.dimensions_keyed(tables.stations_clean(inp), tables.weather_clean(inp))
    assert not tables.dimensions_keyed(tables.stations_clean(inp2), tables.weather_clean(inp2))
    auto = tables.daily_features(inp2).orderBy("trip_date").collect()
    literal = tables.daily_features(inp2, plan="join_first").orderBy("trip_date").collect()
    agg_first = tables.daily_features(inp2, plan="aggregate_first").orderBy("trip_date").collect()
    assert auto == literal
    # with a repeated station the fan-out changes the counts, so the rewrite would be wrong
    assert sum(r.total_trips__leaky for r in literal) > sum(r.total_trips__leaky for r in agg_first)


def test_calendar_flags(spark):
    days = spark.createDataFrame([(dt.date(1999, 12, 26),), (dt.date(1999, 9, 30),), (dt.date(1999, 10, 1),),
                                  (dt.date(2005, 1, 1),)], "trip_date date")
    inp = tables.role_inputs(spark, SF001)
    out = joins.restriction_flag(joins.holiday_flag(days, "trip_date", inp.holidays), "trip_date", inp.restrictions)
    got = {r.trip_date: (r.is_holiday, r.has_covid_restrictions) for r in out.collect()}
    assert out.count() == 4  # duplicate holiday date does not fan out
    assert got[dt.date(1999, 12, 26)] == (True, False)
    assert got[dt.date(1999, 9, 30)] == (False, True)
    assert got[dt.date(1999, 10, 1)] == (False, False)
    assert got[dt.date(2005, 1, 1)] == (False, False)  # after the calendar ends -> false


def test_small_dimension_with_a_large_estimate_is_broadcast(spark):
    inp = tables.role_inputs(spark, SF001)
    trips, stations, weather = tables.trips_clean(inp), tables.stations_clean(inp), tables.weather_clean(inp)
    one = spark.range(1 << 22).where("id = 1").groupBy("id").count().select("id")
    derived = weather.crossJoin(one).drop("id")
    assert not joins.within_bytes(derived)
    got = joins.enrich_trips(trips, stations, derived)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    want = joins.enrich_trips(trips, stations, weather)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_dimension_is_settled_by_its_rows(spark):
    dim = spark.range(1000).where("id < 10")
    written, small = joins.settled(dim, 200)
    assert small and written.count() == 10
    written, small = joins.settled(dim, 100)
    assert not small and written.count() == 10
    assert joins.settled(dim, 8000) == (dim, True)
