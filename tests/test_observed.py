"""What a build measures while it writes: dropped rows kept and counted, declared tests without another read."""

import pytest
from pyspark.sql import functions as F

from daygrain import cli
from daygrain.operators import quality, staging
from daygrain.plans import checks, marts, tables
from daygrain.schemas import TRIP_COLUMNS
from daygrain.session import scratch_path
from daygrain.sources import files, roles, sinks

from .conftest import SF001
from .test_sources import trip_files, write  # noqa: F401


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup("observed-probe", "observed-probe")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("observed-probe"))
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup("observed-probe")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_marked_rows_name_reason_file_and_text(spark, trip_files):  # noqa: F811
    marked = staging.stage_trips_marked(files.read_csv_marked(spark, trip_files, TRIP_COLUMNS))
    rows = marked.collect()
    assert len(rows) == 8
    reasons = sorted(r.reject_reason for r in rows if r.rejected)
    assert reasons == ["field_count", "field_count", "type:Start Station Id", "type:Start Time", "type:Trip  Duration"]
    assert set(reasons) <= set(files.reject_reasons(TRIP_COLUMNS))
    short = [r for r in rows if r.reject_row and r.reject_row.startswith("5,600")]
    assert len(short) == 1 and short[0].reject_file.endswith("ridership-2024/a.csv")
    worded = [r for r in rows if r.reject_reason == "type:Trip  Duration"]
    assert '"Trip  Duration":"abc"' in worded[0].reject_row and worded[0].trip_duration is None
    good = staging.good_trips(marked)
    plain = staging.stage_trips(files.read_csv_aligned(spark, trip_files, TRIP_COLUMNS))
    assert good.schema == plain.schema and sorted(map(tuple, good.collect())) == sorted(map(tuple, plain.collect()))
    assert all(r.reject_row is None and r.reject_file is None for r in rows if not r.rejected)


def marked_project(spark, pattern):
    marked = staging.stage_trips_marked(files.read_csv_marked(spark, pattern, TRIP_COLUMNS))
    role = tables.role_inputs(spark, SF001)
    return marts.Project(tables.Inputs(staging.good_trips(marked), role.stations, role.weather_primary,
                                       role.weather_secondary, role.holidays, role.restrictions, trips_marked=marked))


def test_build_counts_and_keeps_what_it_drops(spark, trip_files):  # noqa: F811
    project, out = marked_project(spark, trip_files), scratch_path(spark, "observed")
    built = project.build(["stg_trips", "int_trips_clean"], out_dir=out)
    assert project.drops == {"field_count": 2, "type:Start Station Id": 1, "type:Start Time": 1, "type:Trip  Duration": 1}
    report = files.csv_reject_report(spark, trip_files, TRIP_COLUMNS).groupBy("reason").agg(F.sum("rows").alias("rows"))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, checks.drop_report(spark, project).collect()))
    assert project.rejected.columns == list(files.REJECT_COLUMNS) and project.rejected.count() == 5
    assert sorted(r.trip_id for r in built["stg_trips"].collect()) == [1, 2, 8]
    assert sorted(r.trip_id for r in built["int_trips_clean"].collect()) == [1, 8]
    # later reads of the kept trips skip the folder of the rejected ones
    plan = built["stg_trips"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan
    again = marked_project(spark, trip_files)
    again.use_built(spark, out, ["stg_trips"])
    assert again.ref("stg_trips").count() == 3 and again.rejected.count() == 5


def test_one_scan_of_the_files_writes_good_and_bad(spark, trip_files):  # noqa: F811
    marked = marked_project(spark, trip_files).inputs.trips_marked
    watched, dropped = quality.observe_reasons(marked, "reject_reason", files.reject_reasons(TRIP_COLUMNS))
    _, jobs = jobs_of(spark, lambda: sinks.materialize(watched, scratch_path(spark, "once"), ["rejected"], gather=False))
    assert jobs == 1 and sum(dropped().values()) == 5


def test_a_build_without_rejects(spark, tmp):
    row = "1,600,7000,1/2/2024 3:04,A,7001,1/2/2024 3:14,B,55,Annual Member"
    write(f"{tmp}/ridership-1/a.csv", ",".join(c[0] for c in TRIP_COLUMNS) + f"\n{row}\n")
    project = marked_project(spark, f"{tmp}/ridership-*/*.csv")
    project.build(["stg_trips"], out_dir=scratch_path(spark, "observed"))
    assert project.drops == {} and project.rejected.count() == 0 and project.ref("stg_trips").count() == 1
    assert checks.drop_report(spark, project).count() == 0


def test_observed_checks_equal_the_scanned_report_and_read_nothing(spark):
    project = marts.Project(tables.role_inputs(spark, SF001))
    models = ["stg_holidays", "stg_restrictions", "int_daily", "fct_trips_daily_v1", "fct_trips_daily_v2"]
    project.build(models, out_dir=scratch_path(spark, "observed"))
    scanned = checks.project_report(project, models)
    report, jobs = jobs_of(spark, lambda: checks.observed_report(spark, project, models))
    assert jobs == 0
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, scanned.collect()))
    with pytest.raises(ValueError, match="int_weekly"):
        checks.observed_report(spark, project, ["int_weekly"])


def test_observed_violations(spark):
    rows = [(1, "a"), (1, None), (1, "b"), (2, "c"), (2, None), (3, "d"), (None, "e"), (None, "f")]
    df = spark.createDataFrame(rows, "k int, v string").repartition(3)
    watched, violations = quality.observe_checks(df, ["k", "v"], ["k", ("k", "v")])
    assert watched.columns == ["k", "v"]
    back = sinks.materialize(watched, scratch_path(spark, "watched"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    assert violations() == [("k", "not_null", 2), ("v", "not_null", 2), ("k", "unique", 2), ("k,v", "unique", 0)]
    scanned = quality.quality_report(df, "t", ["k", "v"], ["k", ("k", "v")]).collect()
    assert sorted((r.column_name, r.check_name, r.violations) for r in scanned) == sorted(violations())


def test_checks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, v string")
    watched, violations = quality.observe_checks(df, ["v"], ["k"])
    sinks.materialize(watched, scratch_path(spark, "watched"))
    assert violations() == [("v", "not_null", 0), ("k", "unique", 0)]


def test_command_line_prints_drops_and_reads_saved_checks(spark, tmp, capsys):
    paths = roles.render_raw_files(spark, tables.role_inputs(spark, SF001), f"{tmp}/raw")
    write(f"{tmp}/raw/trips/ridership-c/bad.csv", ",".join(c[0] for c in TRIP_COLUMNS) + "\n1,2\nx,1\n")
    args = []
    for key in ("trips", "stations", "weather_primary", "weather_secondary", "holidays", "restrictions"):
        args += [f"--{key.replace('_', '-')}", paths[key]]
    out = f"{tmp}/models"
    assert cli.main(["build", *args, "--select", "+int_trips_clean", "stg_restrictions", "--out", out], spark=spark) == 0
    assert "dropped\tfield_count\t2" in capsys.readouterr().out
    select = ["--select", "stg_restrictions", "int_trips_clean"]
    scanned = cli.main(["test", *args, "--built", out, *select], spark=spark), capsys.readouterr().out
    saved = cli.main(["test", "--built", out, "--observed", *select], spark=spark), capsys.readouterr().out
    assert saved == scanned and "PASS\tstg_restrictions\tunique\treport_date\t0" in saved[1]
    assert cli.main(["rejects", "--built", out], spark=spark) == 0
    assert "bad.csv\tfield_count\t2" in capsys.readouterr().out
