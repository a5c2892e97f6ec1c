"""Physical-plan properties that matter at scale."""

from daygrain.operators import aggregate
from daygrain.plans import tables

from .conftest import SF001


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_plan_prunes_and_pushes_down(spark):
    inp = tables.role_inputs(spark, SF001)
    plan = plan_of(tables.daily_features(inp))
    # lineitem is scanned with a pruned schema (no price/discount/tax columns)
    for col in ("l_extendedprice", "l_discount", "l_tax"):
        assert col not in plan
    # no Expand for the distinct counts in the default plan
    assert "Expand" not in plan
    # day-level joins and exact-size calendars (VALUES relations) are broadcast;
    # nothing trip-sized is shuffled for a join
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_fused_plan_expands(spark):
    inp = tables.role_inputs(spark, SF001)
    plan = plan_of(aggregate.daily_measures(tables.trips_clean(inp), distinct="fused"))
    assert "Expand" in plan


def test_top_pair_window_has_partial_group_limit(spark):
    inp = tables.role_inputs(spark, SF001)
    plan = plan_of(aggregate.top_pair(tables.trips_clean(inp), "window"))
    assert "WindowGroupLimit" in plan


def test_mart_v2_prunes_unused_features(spark):
    from daygrain.plans import marts

    inp = tables.role_inputs(spark, SF001)
    mart = marts.mart(tables.daily_features(inp), "daily", "v2")
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    assert "trips_rolling_30d_median" not in plan and "unique_bikes_lag_7d" not in plan


def test_null_filter_reaches_the_scan_of_a_trips_table(spark):
    import dataclasses

    from daygrain.session import scratch_path

    inp = tables.role_inputs(spark, SF001)
    path = scratch_path(spark, "trips")
    inp.trips.write.parquet(path)
    inp2 = dataclasses.replace(inp, trips=spark.read.parquet(path))
    plan = plan_of(tables.daily_features(inp2))
    assert "PushedFilters: [IsNotNull(trip_duration)]" in plan
    assert "ReadSchema: struct<trip_duration:bigint,start_time:timestamp_ntz,user_type:string>" in plan
    # the percentile reads a histogram, never trip rows
    assert all("percentile" not in line for line in plan.splitlines() if "partial_count(1)" in line)


def test_trip_level_aggregations_combine_before_the_shuffle(spark):
    """Skew: every aggregation over trip rows has a partial step ahead of its exchange."""
    inp = tables.role_inputs(spark, SF001)
    plan = tables.daily_features(inp)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "lineitem" in line]
    assert 0 < len(scans) <= 3
    for i in scans:
        # walking up from the scan, the first aggregate comes before the first exchange
        above = lines[:i][::-1]
        first_agg = next(j for j, line in enumerate(above) if "HashAggregate" in line)
        first_exchange = next(j for j, line in enumerate(above) if "Exchange" in line)
        assert first_agg < first_exchange
