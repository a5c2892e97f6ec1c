"""Leak-free window features."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daygrain.operators import windows


@pytest.fixture()
def series(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), (i * 37) % 11 + (0 if i != 5 else -20)) for i in range(40)]
    return spark.createDataFrame(rows, "trip_date date, total_trips__leaky bigint")


def spec():
    s = windows.FeatureSpec("trip_date", "d")
    s.lags("total_trips__leaky", "trips", [1, 7])
    s.rolling("total_trips__leaky", "trips", 7, windows.ALL_STATS)
    s.change("total_trips__leaky", "trips", 1, 2)
    return s


def test_lag_equals_self_join_on_row_number(series):
    out = windows.add_features(series, spec())
    w = Window.orderBy("trip_date")
    numbered = series.withColumn("rn", F.row_number().over(w))
    prev = numbered.select((F.col("rn") + 7).alias("rn"), F.col("total_trips__leaky").alias("prev7"))
    joined = numbered.join(prev, "rn", "left").select("trip_date", "prev7")
    got = {r.trip_date: r.trips_lag_7d for r in out.collect()}
    want = {r.trip_date: r.prev7 for r in joined.collect()}
    assert got == want


def test_rolling_values(series):
    rows = windows.add_features(series, spec()).orderBy("trip_date").collect()
    vals = [r.total_trips__leaky for r in rows]
    import statistics

    for i, r in enumerate(rows):
        frame = vals[max(0, i - 7):i]
        if not frame:
            assert r.trips_rolling_7d_avg is None and r.trips_rolling_7d_median is None
            continue
        assert r.trips_rolling_7d_avg == pytest.approx(sum(frame) / len(frame))
        assert r.trips_rolling_7d_median == pytest.approx(statistics.median(frame))
        assert (r.trips_rolling_7d_min, r.trips_rolling_7d_max) == (min(frame), max(frame))
        if len(frame) > 1:
            assert r.trips_rolling_7d_std == pytest.approx(statistics.stdev(frame))
        else:
            assert r.trips_rolling_7d_std is None
        if i >= 2:
            a, b = vals[i - 1], vals[i - 2]
            assert r.trips_change_1d_vs_2d_pct == (pytest.approx((a - b) / b * 100) if b > 0 else None)


def test_no_feature_reads_the_current_row(series):
    base = windows.add_features(series, spec())
    last = series.agg(F.max("trip_date")).first()[0]
    bumped = series.withColumn(
        "total_trips__leaky",
        F.when(F.col("trip_date") == last, F.lit(10_000)).otherwise(F.col("total_trips__leaky")),
    )
    names = spec().names()
    a = base.filter(F.col("trip_date") == last).select(*names).first()
    b = windows.add_features(bumped, spec()).filter(F.col("trip_date") == last).select(*names).first()
    assert a == b


def test_feature_names_follow_reference_order():
    names = windows.daily_spec().names()
    assert names[:6] == [f"trips_lag_{k}d" for k in (1, 2, 3, 7, 14, 30)]
    assert names[-2:] == ["trips_change_1d_vs_2d_pct", "trips_change_7d_vs_14d_pct"]
    assert len(names) == 32
    assert len(windows.period_spec("week").names()) == 26 == len(windows.period_spec("month").names())
    assert "trips_change_52w_vs_104w_pct" in windows.period_spec("week").names()


def test_partitioned_series(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 10), ("b", 2, 20)],
                               "k string, t int, total_trips__leaky bigint")
    s = windows.FeatureSpec("t", "d", ("k",)).lags("total_trips__leaky", "trips", [1])
    got = {(r.k, r.t): r.trips_lag_1d for r in windows.add_features(df, s).collect()}
    assert got == {("a", 1): None, ("a", 2): 1, ("b", 1): None, ("b", 2): 10}


def test_bucketed_features_equal_global_window(spark):
    day, rows = dt.date(2020, 1, 1), []
    for i in range(400):  # strictly increasing dates with gaps of 1-3 days
        day += dt.timedelta(days=1 + i % 3)
        rows.append((day, (i * 7919) % 97))
    df = spark.createDataFrame(rows, "trip_date date, total_trips__leaky bigint")
    s = windows.daily_spec()
    s = windows.FeatureSpec("trip_date", "d", (), [f for f in s.features if f.source == "total_trips__leaky"])
    want = {r.trip_date: r.asDict() for r in windows.add_features(df, s).collect()}
    got = {r.trip_date: r.asDict() for r in windows.add_features_bucketed(df, s, bucket_rows=45).collect()}
    assert windows.lookback(s) == 30
    assert set(got) == set(want)
    for k, row in want.items():
        assert got[k] == pytest.approx(row), k


def test_global_row_index(spark):
    df = spark.createDataFrame([(dt.date(2020, m, d),) for m in (1, 3, 7) for d in (5, 1, 9)], "d date")
    idx = windows.global_row_index(df, "d", F.trunc("d", "MM"))
    got = [r._idx for r in idx.orderBy("d").collect()]
    assert got == list(range(9))


def test_calendar_lags_count_days_not_rows(spark):
    days = [1, 2, 4, 5, 9]
    df = spark.createDataFrame([(dt.date(2024, 1, d), d * 10) for d in days], "trip_date date, total_trips__leaky bigint")
    s = windows.FeatureSpec("trip_date", "d").lags("total_trips__leaky", "trips", [1, 3])
    s.rolling("total_trips__leaky", "trips", 3, ["avg"])
    got = {r.trip_date.day: r for r in windows.add_features_calendar(df, s, "day").collect()}
    assert sorted(got) == days
    assert got[4].trips_lag_1d is None and got[4].trips_lag_3d == 10  # day 3 missing, day 1 three days back
    assert got[5].trips_lag_1d == 40 and got[9].trips_lag_1d is None
    assert got[5].trips_rolling_3d_avg == pytest.approx((20 + 40) / 2)  # days 2, 3 (missing), 4
    rows = {r.trip_date.day: r for r in windows.add_features(df, s).collect()}
    assert rows[4].trips_lag_1d == 20  # the reference's row lag
