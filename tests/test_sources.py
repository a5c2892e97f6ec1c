"""Raw-file traps of SURVEY 2.9: CSV drift and malformed rows, JSON nesting, seeds."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from daygrain.operators import cleaning, staging
from daygrain.schemas import HOLIDAY_SEED_DDL, RESTRICTION_SEED_DDL, TRIP_COLUMNS, station_schema
from daygrain.sources import files

HEADER = ",".join(c[0] for c in TRIP_COLUMNS)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture()
def trip_files(tmp):
    good = "1,600,7000,1/2/2024 3:04,A,7001,1/2/2024 3:14,B,55,Annual Member"
    rows_a = [
        HEADER,
        good,
        "2,,7000,1/2/2024 5:00,A,7000,1/2/2024 5:00,A,56,Casual Member",  # null duration (kept as null)
        "3,abc,7000,1/2/2024 6:00,A,7001,1/2/2024 6:10,B,57,Annual Member",  # bad cast -> dropped
        "4,600,NULL,1/2/2024 7:00,A,7001,1/2/2024 7:10,B,58,Annual Member",  # NULL text -> dropped by default
        "5,600,7000,1/2/2024 8:00,A",  # short row -> dropped
        "6,600,7000,1/2/2024 9:00,A,7001,1/2/2024 9:10,B,59,Annual Member,extra",  # long row -> dropped
        "7,600,7000,13/45/2024 9:00,A,7001,1/2/2024 9:10,B,60,Annual Member",  # bad time -> dropped
    ]
    write(f"{tmp}/ridership-2024/a.csv", "\n".join(rows_a) + "\n")
    # Second file: same columns, reversed order.
    rev = [c[0] for c in TRIP_COLUMNS][::-1]
    values = "Casual Member,61,D,1/3/2024 10:20,7003,C,12/31/2024 23:59,7002,1200,8".split(",")
    write(f"{tmp}/ridership-2025/b.csv", ",".join(rev) + "\n" + ",".join(values) + "\n")
    return f"{tmp}/ridership-*/*.csv"


def test_csv_drop_bad_rows_and_align_headers(spark, trip_files):
    raw = files.read_csv_aligned(spark, trip_files, TRIP_COLUMNS)
    staged = staging.stage_trips(raw)
    got = {r.trip_id: r for r in staged.collect()}
    assert sorted(got) == [1, 2, 8]
    assert got[1].start_time == dt.datetime(2024, 1, 2, 3, 4)  # unpadded month/day/hour
    assert got[2].trip_duration is None
    # reversed-header file aligned by name, not position
    assert got[8].start_station_id == 7002 and got[8].trip_duration == 1200
    assert got[8].start_time == dt.datetime(2024, 12, 31, 23, 59)
    assert got[8].user_type == "Casual Member"
    # the same count whatever the projection
    assert raw.count() == 3 and raw.select("`Trip Id`").count() == 3


def test_csv_null_text_option(spark, trip_files):
    raw = files.read_csv_aligned(spark, trip_files, TRIP_COLUMNS, null_value="NULL")
    ids = sorted(r.trip_id for r in staging.stage_trips(raw).collect())
    assert ids == [1, 2, 4, 8]


def test_csv_rejected_rows_report(spark, trip_files):
    rejected = files.read_csv_aligned(spark, trip_files, TRIP_COLUMNS, bad_rows="only")
    assert sorted(r["Trip Id"] for r in rejected.collect()) == ["3", "4", "7"]


def test_csv_fail_mode(spark, trip_files):
    raw = files.read_csv_aligned(spark, trip_files, TRIP_COLUMNS, bad_rows="fail")
    with pytest.raises(Exception):
        staging.stage_trips(raw).collect()


def test_csv_missing_column_fails_with_the_file(spark, tmp):
    write(f"{tmp}/x/one.csv", HEADER.replace("Trip  Duration", "Trip Duration") + "\n")
    with pytest.raises(ValueError, match=r"Trip  Duration.*one\.csv"):
        files.read_csv_aligned(spark, f"{tmp}/x/*.csv", TRIP_COLUMNS)


def test_csv_names_match_whatever_their_case_and_blank_lines_are_skipped(spark, tmp):
    write(f"{tmp}/y/one.csv", "\n\n" + HEADER.upper() + "\n1,600,7000,1/2/2024 3:04,A,7001,1/2/2024 3:14,B,55,Annual Member\n")
    write(f"{tmp}/y/none.csv", "")
    got = staging.stage_trips(files.read_csv_aligned(spark, f"{tmp}/y/*.csv", TRIP_COLUMNS)).collect()
    assert [(r.trip_id, r.end_station_id) for r in got] == [(1, "7001")]
    write(f"{tmp}/z/blank.csv", "\n \n")
    with pytest.raises(ValueError, match="blank"):
        files.read_csv_aligned(spark, f"{tmp}/z/*.csv", TRIP_COLUMNS)


def test_text_end_ids_survive_a_tolerant_read(spark, tmp):
    ids = ["NULL", "7001", "07001", "SX1"]
    rows = [f"{i},600,7000,1/2/2024 3:04,A,{e},1/2/2024 3:14,B,55,Annual Member" for i, e in enumerate(ids)]
    write(f"{tmp}/e/a.csv", "\n".join([HEADER, *rows]) + "\n")
    got = staging.stage_trips(files.read_csv_aligned(spark, f"{tmp}/e/*.csv", TRIP_COLUMNS)).orderBy("trip_id").collect()
    assert [r.end_station_id for r in got] == ids


def test_strict_reads_fail_under_any_projection(spark, tmp):
    head = "Date/Time,Max Temp (°C)"
    columns = [("Date/Time", "date_time", "date", None), ("Max Temp (°C)", "max_temp_c", "double", None)]
    for name, bad in (("short", "2024-01-02"), ("type", "2024-01-02,warm")):
        write(f"{tmp}/{name}/a.csv", f"{head}\n2024-01-01,1.5\n{bad}\n")
        raw = files.read_csv_aligned(spark, f"{tmp}/{name}/*.csv", columns, bad_rows="fail")
        with pytest.raises(Exception):
            raw.select("`Date/Time`").collect()


def count_jobs(spark, run):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_the_number_of_files(spark, tmp):
    row = "1,600,7000,1/2/2024 3:04,A,7001,1/2/2024 3:14,B,55,Annual Member"
    jobs = []
    for n in (3, 300):
        for i in range(n):
            write(f"{tmp}/n{n}/{i}.csv", f"{HEADER}\n{row}\n")
        jobs.append(count_jobs(spark, lambda n=n: files.read_csv_aligned(spark, f"{tmp}/n{n}/*.csv", TRIP_COLUMNS)))
    assert jobs[1] <= jobs[0] + 3  # listing many paths is at most one distributed job per read


def test_raw_csv_writer_roundtrip(spark, tmp):
    df = spark.createDataFrame(
        [(1, 60, 3, dt.datetime(2024, 1, 2, 3, 4), "A", 4, dt.datetime(2024, 1, 2, 3, 5), "B", 9, "Annual Member")],
        ", ".join(f"`{c[1]}` {c[2]}" for c in TRIP_COLUMNS),
    )
    files.write_raw_csv(df, f"{tmp}/out", TRIP_COLUMNS)
    back = staging.stage_trips(files.read_csv_aligned(spark, f"{tmp}/out/*.csv", TRIP_COLUMNS))
    assert back.collect() == df.collect()


def station(i, **kw):
    base = {"station_id": str(i), "name": f"S{i}", "physical_configuration": "REGULAR", "lat": 43.6, "lon": -79.4,
            "altitude": None, "address": f"{i} Main", "capacity": 10, "is_charging_station": False,
            "rental_methods": ["KEY"], "groups": [], "obcn": "416", "short_name": str(i),
            "nearby_distance": 500.0, "_ride_code_support": True, "rental_uris": {},
            "post_code": None, "is_valet_station": None, "cross_street": None}
    base.update(kw)
    return base


def test_json_nested_records_and_clean_defaults(spark, tmp):
    recs = [
        station(1, physical_configuration=None, address=None, rental_methods=None),
        station(2, rental_uris={"android": "https://x", "nested": {"a": 1}}),
    ]
    write(f"{tmp}/st.json", json.dumps({"last_updated": 1, "data": {"stations": recs}}, indent=2))
    df = files.read_json_records(spark, f"{tmp}/st.json", station_schema(), record_path="data.stations")
    staged = staging.stage_stations(df)
    assert staged.count() == 2
    uris = {r.station_id: r.rental_uris for r in staged.collect()}
    assert uris["1"] == {} and json.loads(uris["2"]["nested"]) == {"a": 1}
    clean = {r.station_id: r for r in cleaning.clean_stations(staged).collect()}
    assert clean["1"].physical_configuration == "UNKNOWN"
    assert clean["1"].address == "S1"
    assert clean["1"].rental_methods == []
    assert len(cleaning.clean_stations(staged).columns) == 13


def test_json_lines_records(spark, tmp):
    write(f"{tmp}/lines.json", "\n".join(json.dumps(station(i)) for i in range(3)))
    df = files.read_json_records(spark, f"{tmp}/lines.json", station_schema())
    assert sorted(r.station_id for r in df.collect()) == ["0", "1", "2"]


def test_json_layouts_are_declared(spark, tmp):
    write(f"{tmp}/array.json", json.dumps([station(i) for i in range(2)], indent=2))
    write(f"{tmp}/lines.json", "\n".join(json.dumps(station(i)) for i in range(3)))
    write(f"{tmp}/nested.json", json.dumps({"data": {"stations": [station(1)]}}))
    read = lambda f, **kw: files.read_json_records(spark, f"{tmp}/{f}.json", station_schema(), key="station_id", **kw).collect()
    assert [r.station_id for r in read("array", layout="array")] == ["0", "1"]
    for wrong in (("array", {"layout": "lines"}), ("lines", {"layout": "array"}), ("nested", {"layout": "lines"}),
                  ("array", {"record_path": "data.stations"}), ("nested", {"layout": "array"})):
        with pytest.raises(Exception):
            read(wrong[0], **wrong[1])


def test_seeds_parse(spark, tmp):
    write(f"{tmp}/covid.csv", 'dates,hospitalizations,icu_admissions,inhospital_deaths,ed_visits,restrictions\n'
          '"Mar, 2020",867,196,130,"9,420",1\n"Apr, 2020","5,366","1,233","1,460","13,702",0\n')
    write(f"{tmp}/hol.csv", "event,date\nNew Year's Day,01/01/2020\nBoxing Day,26/12/2022\nBoxing Day,26/12/2022\n")
    r = staging.stage_restrictions(files.load_seed(spark, f"{tmp}/covid.csv", RESTRICTION_SEED_DDL)).collect()
    assert r[0].report_date == dt.date(2020, 3, 1) and r[0].restrictions is True and r[0].ed_visits == 9420
    assert r[1].hospitalizations == 5366 and r[1].restrictions is False
    h = staging.stage_holidays(files.load_seed(spark, f"{tmp}/hol.csv", HOLIDAY_SEED_DDL))
    assert h.select("holiday_date").distinct().count() == 2
    assert h.collect()[1].date_string == "26/12/2022"


def test_json_map_parse(spark):
    df = spark.createDataFrame([('{"k": 69, "o": {"x": 1}}',)], "props string")
    row = df.select(staging.parse_json_map("props").alias("m")).collect()[0]
    assert row.m["k"] == "69" and json.loads(row.m["o"]) == {"x": 1}


def test_one_reversed_file_in_a_folder_is_aligned(spark, tmp):
    rev = [c[0] for c in TRIP_COLUMNS][::-1]
    values = "Casual Member,61,D,1/3/2024 10:20,7003,C,12/31/2024 23:59,7002,1200,8"
    write(f"{tmp}/d/a.csv", f"{HEADER}\n1,600,7000,1/2/2024 3:04,A,7001,1/2/2024 3:14,B,55,Annual Member\n")
    write(f"{tmp}/d/b.csv", ",".join(rev) + "\n" + values + "\n")
    assert sorted(r.trip_id for r in staging.stage_trips(files.read_csv_aligned(spark, f"{tmp}/d/*.csv", TRIP_COLUMNS)).collect()) == [1, 8]


def test_csv_reject_report(spark, trip_files):
    rep = files.csv_reject_report(spark, trip_files, TRIP_COLUMNS)
    got = {(r.file_path.rsplit("/", 1)[-1], r.reason): r.rows for r in rep.collect()}
    assert got == {
        ("a.csv", "field_count"): 2,
        ("a.csv", "type:Trip  Duration"): 1,
        ("a.csv", "type:Start Station Id"): 1,
        ("a.csv", "type:Start Time"): 1,
    }
    # kept + rejected = every data row
    kept = files.read_csv_aligned(spark, trip_files, TRIP_COLUMNS).count()
    assert kept + sum(got.values()) == 8


def test_daily_query_from_raw_files_parses_the_trips_once(spark):
    from daygrain import catalog_more

    plan = catalog_more.q_daily_from_raw_files(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "trip_duration" in line]
    assert scans and all("FileScan parquet" in line for line in scans)
    assert "ridership" not in plan
