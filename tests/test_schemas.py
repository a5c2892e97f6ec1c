"""Q4: declared schemas of staged and derived tables."""

import pytest

from daygrain.plans import tables
from daygrain.schemas import (CLEAN_STATION_COLUMNS, TRIP_COLUMNS, WEATHER_PRIMARY_COLUMNS,
                              WEATHER_SECONDARY_COLUMNS, assert_schema, ddl)

from .conftest import SF001


def test_staged_roles_match_declared_schemas(spark):
    inp = tables.role_inputs(spark, SF001)
    assert_schema(inp.trips, ddl(TRIP_COLUMNS))
    assert_schema(inp.weather_primary, ddl(WEATHER_PRIMARY_COLUMNS))
    assert_schema(inp.weather_secondary, ddl(WEATHER_SECONDARY_COLUMNS))
    assert tables.stations_clean(inp).columns == CLEAN_STATION_COLUMNS
    assert len(inp.stations.columns) == 19 and len(WEATHER_SECONDARY_COLUMNS) == 31


def test_grain_table_types(spark):
    inp = tables.role_inputs(spark, SF001)
    daily = tables.daily_features(inp)
    types = dict(daily.dtypes)
    assert types["trip_date"] == "date" and types["total_trips__leaky"] == "bigint"
    assert types["median_trip_duration__leaky"] == "double" and types["day_of_week"] == "bigint"
    assert types["top_end_station_id__leaky"] == "string"
    weekly = tables.weekly_features(daily)
    assert dict(weekly.dtypes)["week_start_date"] == "timestamp_ntz"
    assert dict(weekly.dtypes)["total_trips__leaky"] == "bigint"


def test_assert_schema_rejects_drift(spark):
    df = spark.createDataFrame([(1, "a")], "a bigint, b string")
    with pytest.raises(AssertionError):
        assert_schema(df, "a bigint, b bigint")
