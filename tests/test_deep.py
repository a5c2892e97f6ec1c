"""Merged sketches, typed JSON, keyed buckets, partition rebuilds, long gaps, wide durations, header and layout probes."""

import datetime as dt
import gzip
import math
import os
import statistics
import time

import pytest
from pyspark.sql import functions as F

from daygrain import catalog_deep
from daygrain.operators import aggregate, cleaning, staging, windows
from daygrain.schemas import TRIP_COLUMNS, station_schema
from daygrain.session import scratch_path
from daygrain.sources import files, sinks

from .test_aggregate import TRIP_DDL, ts
from .test_cleaning import P_DDL, S_DDL, p, s
from .test_observed import jobs_of
from .test_sources import HEADER, write

ROW = "1,600,7000,1/2/2024 3:04,A,7001,1/2/2024 3:14,B,55,Annual Member"


# --- S8: headers, S2 / S7: layouts


def test_headers_are_found_by_one_job_whatever_the_files(spark, tmp, monkeypatch):
    opened = []
    monkeypatch.setattr(files, "opening", lambda *a: opened.append(a))
    for n in (3, 300):
        for i in range(n):
            text = f"\n  \n{HEADER}\n{ROW}\n"
            if i % 3:
                write(f"{tmp}/n {n}/{i}.csv", text)
            else:
                os.makedirs(f"{tmp}/n {n}", exist_ok=True)
                with gzip.open(f"{tmp}/n {n}/{i}.csv.gz", "wt") as f:
                    f.write(text)
        write(f"{tmp}/n {n}/empty.csv", "")
        found, jobs = jobs_of(spark, lambda: files.headers_by_file(spark, f"{tmp}/n {n}"))
        assert jobs == 1 and len(found) == n
        assert set(found.values()) == {tuple(c[0] for c in TRIP_COLUMNS)}
        assert files.read_csv_aligned(spark, f"{tmp}/n {n}/*", TRIP_COLUMNS).count() == n
    assert not opened


def test_a_header_is_found_without_reading_the_file(spark, tmp):
    """A task per file, cut nowhere, which stops at the header."""
    with open(f"{tmp}/long.csv", "w") as f:
        f.write("a,b\n")
        f.writelines("1,2\n" for _ in range(4_000_000))
    lines = files.first_lines(files._text_scan(spark, f"{tmp}/long.csv"))
    assert lines.rdd.getNumPartitions() == 1
    assert [r.line for r in lines.collect()] == ["a,b"]


def test_files_of_blank_lines_and_byte_order_marks(spark, tmp):
    write(f"{tmp}/a.csv", "﻿a,b\n1,2\n")
    assert list(files.headers_by_file(spark, f"{tmp}/a.csv").values()) == [("a", "b")]
    write(f"{tmp}/b.csv", "\n \n")
    with pytest.raises(ValueError, match="only blank lines in .*b.csv"):
        files.headers_by_file(spark, f"{tmp}/*.csv")
    os.makedirs(f"{tmp}/none")
    assert files.headers_by_file(spark, f"{tmp}/none") == {}


def test_layout_probe_reads_one_character_of_a_line_of_200_mb(spark, tmp):
    with open(f"{tmp}/one.json", "w") as f:
        f.write("  \n [")
        for _ in range(200):
            f.write("x" * (1 << 20))
    path = files.list_files(spark, f"{tmp}/one.json")[0]
    began = time.time()
    assert files.opening(spark, path) == "["
    assert time.time() - began < 2
    with pytest.raises(ValueError, match="does not open with"):
        files.read_json_records(spark, f"{tmp}/one.json", station_schema(), layout="lines")
    write(f"{tmp}/blank.json", " \n")
    with pytest.raises(ValueError, match="only blank"):
        files.opening(spark, files.list_files(spark, f"{tmp}/blank.json")[0])
    write(f"{tmp}/none.json", "")
    assert files.opening(spark, files.list_files(spark, f"{tmp}/none.json")[0]) is None
    write(f"{tmp}/wide.json", " " * (files.LONGEST_BLANK + 1))
    with pytest.raises(ValueError, match="blank characters at the start"):
        files.opening(spark, files.list_files(spark, f"{tmp}/wide.json")[0])


# --- T11: every bigint


@pytest.mark.parametrize("scale", [10**12, 10**15, (1 << 63) - 1])
def test_daily_measures_of_wide_durations(spark, scale):
    durations = [scale, 5, 7, scale // 2, -scale]
    rows = [(i, x, 1, ts(1, i), "2", 10, "Annual Member") for i, x in enumerate(durations)]
    rows += [(9, 60, 1, ts(2), "2", 10, "Annual Member"), (10, 90, 1, ts(2), "2", 10, "Casual Member")]
    out = {r.trip_date.day: r for r in aggregate.daily_shared(spark.createDataFrame(rows, TRIP_DDL)).collect()}
    wide = out[1]
    assert wide.max_trip_duration__leaky == scale and wide.min_trip_duration__leaky == -scale
    assert wide.avg_trip_duration__leaky == pytest.approx(sum(durations) / 5, rel=1e-12)
    assert wide.stddev_trip_duration__leaky == pytest.approx(statistics.stdev(durations), rel=1e-9)
    assert out[2].stddev_trip_duration__leaky == pytest.approx(math.sqrt(450), rel=1e-12)


def test_deviation_of_near_wide_durations_is_exact(spark):
    """Squares within 38 digits: no cancellation."""
    rows = [(i, 10**12 + i, 1, ts(1, i), "2", 10, "Annual Member") for i in range(3)]
    got = aggregate.daily_shared(spark.createDataFrame(rows, TRIP_DDL)).first()
    assert got.stddev_trip_duration__leaky == 1.0


# --- A5 / A19: sketches


def test_merged_sketches_stay_within_their_error(spark):
    """30,000 bikes over 14 days: merged daily sketches against the exact counts of two weeks."""
    trips = spark.range(200_000).select(
        F.timestamp_add("MINUTE", F.col("id") % (14 * 1440), F.lit(dt.datetime(2024, 1, 1))).cast("timestamp_ntz").alias("start_time"),
        (F.xxhash64("id") % 30_000).alias("bike_id"), (F.col("id") % 90).alias("start_station_id"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 70).cast("string")).alias("end_station_id"),
    )
    exact = {r.week_start_date: r for r in aggregate.period_distinct(trips, "week").collect()}
    stored = sinks.materialize(aggregate.daily_sketches(trips), scratch_path(spark, "sketches"))
    merged = {r.week_start_date: r for r in aggregate.merge_sketches(stored, "week").collect()}
    assert len(exact) == 2 and set(exact) == set(merged)
    for week, row in exact.items():
        assert row.unique_bikes__leaky > 20_000 and row.unique_end_stations__leaky == 56
        assert merged[week].unique_bikes__leaky == pytest.approx(row.unique_bikes__leaky, rel=5 * aggregate.sketch_error())
        assert merged[week].unique_start_stations__leaky == pytest.approx(90, abs=2)
    finer = aggregate.merge_sketches(aggregate.daily_sketches(trips, lg_k=16), "month").first()
    month = aggregate.period_distinct(trips, "month").first()
    assert finer.unique_bikes__leaky == pytest.approx(month.unique_bikes__leaky, rel=5 * aggregate.sketch_error(16))
    plan = aggregate.period_distinct(trips, "week")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_period_distinct_of_nulls_and_nothing(spark):
    rows = [(1, 600, 1, ts(1), None, 10, "x"), (2, 600, None, ts(2), None, 10, "x")]
    got = aggregate.period_distinct(spark.createDataFrame(rows, TRIP_DDL), "week").first()
    assert (got.unique_bikes__leaky, got.unique_start_stations__leaky, got.unique_end_stations__leaky) == (1, 1, 0)
    none = spark.createDataFrame([], TRIP_DDL)
    assert aggregate.period_distinct(none, "month").count() == 0
    assert aggregate.merge_sketches(aggregate.daily_sketches(none), "month").count() == 0


# --- X19: typed values


def test_json_variants_keep_types_and_read_paths(spark):
    texts = ['{"a": 1, "b": {"c": [1, 2.5, "x"]}, "d": null, "e": "1", "f": true}', None, "{bad", "[1]", "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", staging.parse_json_variants("t").alias("m"))
    m = F.col("m")
    got = {r.i: r for r in df.select(
        "i", F.isnull("m").alias("none"), staging.json_value(m, "a", "$", "bigint").alias("a"),
        staging.json_value(m, "b", "$.c[1]", "double").alias("c1"), staging.json_value(m, "b", "$.c[2]", "bigint").alias("worded"),
        staging.json_value(m, "b").alias("text"), staging.json_value(m, "d").alias("d"),
        *[staging.json_type(m, k).alias(f"type_{k}") for k in "adefz"]).collect()}
    assert (got[0].a, got[0].c1, got[0].worded, got[0].d) == (1, 2.5, None, None)
    assert got[0].text == '{"c":[1,2.5,"x"]}'
    assert [got[0][f"type_{k}"] for k in "adefz"] == ["BIGINT", "VOID", "STRING", "BOOLEAN", None]
    assert [got[i].none for i in range(5)] == [False, True, True, True, False]
    assert got[4].a is None and got[1].a is None


def test_json_variants_keep_the_text_of_nested_uris(spark):
    df = spark.createDataFrame([('{"ios": {"uri": "app://1", "v": 2}, "web": "w"}',)], "t string")
    m = staging.parse_json_variants("t")
    row = df.select(staging.json_value(m, "ios", "$.uri").alias("u"), staging.json_value(m, "ios", "$.v", "int").alias("v"),
                    staging.json_value(m, "web").alias("w")).first()
    assert tuple(row) == ("app://1", 2, "w")


# --- W2-W17: keyed buckets


def test_keyed_buckets_equal_the_plain_windows_and_spread_a_hot_series(spark):
    """One of 40 series (and one without a key) holds a third of all rows."""
    hours = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 41 == 0, F.lit(None).cast("int")).otherwise((F.col("id") % 40).cast("int")).cast("bigint").alias("station"),
        F.timestamp_add("HOUR", F.col("id"), F.lit(dt.datetime(2024, 1, 1))).cast("timestamp_ntz").alias("hour_start"),
        (F.xxhash64("id") % 50).alias("trips"), (F.col("id") % 77).alias("longest"))
    spec = catalog_deep.keyed_spec()
    want = {(r.station, r.hour_start): r.asDict() for r in windows.add_features(hours, spec).collect()}
    bucketed = windows.add_features_bucketed(hours, spec, bucket_rows=400)
    got = {(r.station, r.hour_start): r.asDict() for r in bucketed.collect()}
    assert len(got) == 9000 and set(got) == set(want)
    for k, row in want.items():
        assert [got[k][c] for c in spec.names()] == pytest.approx([row[c] for c in spec.names()]), k
    plan = bucketed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(station#" in plan and "_bucket" in plan
    indexed = windows.global_row_index(hours, "hour_start", F.trunc("hour_start", "MM"), ("station",))
    counts = indexed.groupBy("station").agg(F.min("_idx").alias("lo"), F.max("_idx").alias("hi"), F.count("_idx").alias("n")).collect()
    assert all(r.lo == 0 and r.hi == r.n - 1 for r in counts) and max(r.n for r in counts) >= 3000
    with pytest.raises(ValueError, match="lookback"):
        windows.add_features_bucketed(hours, spec, 100)


# --- F9 / S10: partitions


def listing(path):
    out = {}
    for top, _, names in os.walk(path):
        for n in names:
            if n.startswith("part-"):
                out[os.path.relpath(os.path.join(top, n), path)] = os.stat(os.path.join(top, n)).st_mtime_ns
    return out


def test_rebuilding_one_year_leaves_the_others(spark, tmp):
    days = spark.range(900).select(F.date_add(F.lit(dt.date(2021, 1, 1)), F.col("id").cast("int")).alias("trip_date"), F.col("id").alias("n"))
    days = days.select(F.year("trip_date").cast("bigint").alias("year"), "trip_date", "n")
    path = f"{tmp}/by year"
    first = sinks.materialize(days, path, ["year"])
    assert first.columns == days.columns and first.dtypes == days.dtypes
    before = listing(path)
    assert len(before) == 3  # a file per year: rows were gathered
    sinks.materialize(days.where("year = 2022").withColumn("n", -F.col("n")), path, ["year"], replace="partitions")
    after = listing(path)
    same = {k for k in before if "2022" not in k}
    assert {k: after[k] for k in same} == {k: before[k] for k in same} and set(after) != set(before)
    got = sinks.read_mart(spark, path, "trip_date", "2022-06-01", year="year")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and ">= 2022)" in plan
    assert {r.trip_date.year for r in got.collect()} == {2022, 2023}
    assert got.where("year = 2022").agg(F.max("n")).first()[0] < 0 < got.where("year = 2023").agg(F.min("n")).first()[0]
    whole = sinks.materialize(days.where("year = 2023"), path, ["year"])
    assert whole.count() == days.where("year = 2023").count()
    with pytest.raises(ValueError, match="partitions"):
        sinks.materialize(days, path, replace="partitions")


# --- W18: long gaps


def test_gaps_of_any_length_are_filled_from_both_sides(spark):
    prim = spark.createDataFrame([p(1, None, None, None), p(2, 10.0, 0.0, 5.0), p(3, None, 2.0, None), p(4, None, None, None),
                                  p(8, 20.0, 4.0, 9.0), p(9, None, None, None)], P_DDL)
    sec = spark.createDataFrame([s(4, None, 3.0, None)], S_DDL)
    got = {r.date_time.day: r for r in cleaning.clean_weather(prim, sec, gaps="all").collect()}
    assert sorted(got) == list(range(1, 10))  # absent days are there
    assert [got[i].max_temp_c for i in range(1, 10)] == [None, 10.0, 15.0, 15.0, 15.0, 15.0, 15.0, 20.0, None]
    assert [got[i].min_temp_c for i in range(2, 9)] == [0.0, 2.0, 3.0, 3.5, 3.5, 3.5, 4.0]
    assert (got[6].year, got[6].month, got[6].day, got[6].total_precip_mm, got[6].snow_on_grnd_cm) == (2024, "01", "06", 0.0, 0)
    assert got[6].station_name is None and got[4].total_precip_mm == 1.0
    plain = cleaning.clean_weather(prim, sec).collect()
    assert len(plain) == 6 and {r.date_time.day for r in plain if r.max_temp_c is None} == {1, 3, 4, 9}
    with pytest.raises(ValueError, match="gap rule"):
        cleaning.clean_weather(prim, sec, gaps="none")
    assert cleaning.clean_weather(prim.limit(0), sec, gaps="all").count() == 0
