"""Marts, builder, sinks, quality report, modelling hand-off."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daygrain.operators import quality
from daygrain.plans import checks, marts, modeling, tables
from daygrain.session import scratch_path
from daygrain.sources import sinks

from .conftest import SF001


@pytest.fixture(scope="module")
def project(spark):
    return marts.Project(tables.role_inputs(spark, SF001))


def test_mart_column_counts():
    assert [len(marts.mart_columns(g, "v1")) for g in ("daily", "weekly", "monthly")] == [66, 54, 55]
    assert [len(marts.mart_columns(g, "v2")) for g in ("daily", "weekly", "monthly")] == [17, 13, 14]
    assert [len(marts.grain_columns(g)) for g in ("daily", "weekly", "monthly")] == [68, 56, 57]


def test_selector(project):
    assert project.select("+fct_trips_weekly_v2") == [
        "stg_trips", "int_trips_clean", "stg_stations", "int_stations_clean", "stg_weather_primary",
        "stg_weather_secondary", "int_weather_clean", "stg_holidays", "stg_restrictions", "int_daily",
        "int_weekly", "fct_trips_weekly_v2"]
    assert len(project.names) == 19
    assert project.select("staging") == list(marts.STAGING_MODELS)
    assert project.select("v2") == ["fct_trips_daily_v2", "fct_trips_weekly_v2", "fct_trips_monthly_v2"]
    assert set(project.select("int_")) >= {"int_daily", "int_enriched_trips"}
    with pytest.raises(KeyError):
        project.select("nope")


def test_build_export_and_read_back(spark, project):
    out, exp = scratch_path(spark, "models"), scratch_path(spark, "exports")
    built = project.build("+fct_trips_monthly_v2", out_dir=out, export_dir=exp)
    assert list(built)[-3:] == ["int_daily", "int_monthly", "fct_trips_monthly_v2"]
    mart = built["fct_trips_monthly_v2"]
    back = sinks.read_exported_csv(spark, f"{exp}/fct_trips_monthly_v2", mart.schema)
    assert back.count() == mart.count()
    assert sorted(back.collect()) == sorted(mart.collect())
    recent = sinks.read_mart(spark, f"{out}/fct_trips_monthly_v2", "month_start_date", "2000-01-01")
    keys = [r.month_start_date for r in recent.collect()]
    assert keys == sorted(keys) and keys[0] >= dt.datetime(2000, 1, 1)
    assert "PushedFilters: [IsNotNull(month_start_date), GreaterThanOrEqual" in recent._jdf.queryExecution().executedPlan().toString()


def test_declared_test_counts():
    counts = {m: tuple(len(x) for x in checks.declared_tests(m)) for m in (
        "int_daily", "int_weekly", "int_monthly", "int_enriched_trips", "int_trips_clean",
        "fct_trips_daily_v2", "fct_trips_weekly_v2", "fct_trips_monthly_v2", "fct_trips_daily_v1",
        "stg_restrictions")}
    assert counts == {"int_daily": (33, 0), "int_weekly": (30, 0), "int_monthly": (31, 0),
                      "int_enriched_trips": (21, 0), "int_trips_clean": (10, 0),
                      "fct_trips_daily_v2": (14, 1), "fct_trips_weekly_v2": (11, 1),
                      "fct_trips_monthly_v2": (12, 1), "fct_trips_daily_v1": (1, 1), "stg_restrictions": (7, 1)}


def test_quality_report(spark, project):
    rep = checks.project_report(project, ["int_daily", "fct_trips_daily_v1"])
    rows = {(r.table_name, r.column_name, r.check_name): r.violations for r in rep.collect()}
    assert rows[("fct_trips_daily_v1", "trip_date", "unique")] == 0
    # trip days without a weather row (sparse at sf0.001) are the only violations
    weather = {"max_temp_c", "min_temp_c", "mean_temp_c", "temp_range_c", "total_precip_mm", "snow_on_grnd_cm"}
    assert all(v == 0 for (t, c, k), v in rows.items() if c not in weather)
    assert len({v for (t, c, k), v in rows.items() if c in weather}) == 1


def test_quality_primitives(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "b"), (None, "c"), (None, "d")], "k bigint, v string")
    rep = quality.quality_report(df, "t", not_null=["k", "v"], unique=["k"],
                                 refs=[("k", spark.createDataFrame([(1,)], "id bigint"), "id")])
    got = {(r.column_name, r.check_name): r.violations for r in rep.collect()}
    assert got == {("k", "not_null"): 2, ("v", "not_null"): 1, ("k", "unique"): 1, ("k", "relationships"): 1}


def test_modelling_handoff(spark, project):
    mart = project.ref("fct_trips_daily_v2")
    feats = modeling.select_features(mart, "trip_date")
    assert "trip_date" not in feats and not any("__leaky" in f for f in feats)
    clean = modeling.complete_cases(mart, feats + ["total_trips__leaky"])
    train, test = modeling.chrono_split(clean, "trip_date", 0.8)
    assert train.agg(F.max("trip_date")).first()[0] < test.agg(F.min("trip_date")).first()[0]
    assert train.count() + test.count() == clean.count()
    model = modeling.fit_forest(train, feats, trees=10, seed=42)
    score = modeling.r2(model, test, feats)
    assert -10 < score <= 1
    ranked = modeling.importances(model, feats)
    again = modeling.importances(modeling.fit_forest(train, feats, trees=10, seed=42), feats)
    weights = {r.feature: r.importance for r in ranked.collect()}
    assert abs(sum(weights.values()) - 1) < 1e-9
    assert weights == {r.feature: r.importance for r in again.collect()}
    top = modeling.top_features(ranked, 5).collect()
    assert len(top) == 5 and top[0].importance >= top[-1].importance


def test_command_line_build_and_test(spark, tmp, capsys):
    from daygrain import cli
    from daygrain.sources import roles

    paths = roles.render_raw_files(spark, tables.role_inputs(spark, SF001), f"{tmp}/raw")
    args = []
    for key in ("trips", "stations", "weather_primary", "weather_secondary", "holidays", "restrictions"):
        args += [f"--{key.replace('_', '-')}", paths[key]]
    out, exp = f"{tmp}/models", f"{tmp}/exports"
    assert cli.main(["build", *args, "--select", "+fct_trips_weekly_v2", "--out", out, "--export", exp],
                    spark=spark) == 0
    assert "fct_trips_weekly_v2\t13 columns" in capsys.readouterr().out
    back = spark.read.parquet(f"{out}/fct_trips_weekly_v2")
    assert back.count() == tables.weekly_features(tables.daily_features(tables.role_inputs(spark, SF001))).count()
    assert cli.main(["test", *args, "--select", "fct_trips_weekly_v1"], spark=spark) == 0
    assert "PASS\tfct_trips_weekly_v1\tunique\tweek_start_date\t0" in capsys.readouterr().out
    # Weeks without weather fail a not-null check, over the built table as over the raw files.
    select = ["--select", "fct_trips_weekly_v2"]
    recomputed = cli.main(["test", *args, *select], spark=spark), capsys.readouterr().out
    assert (cli.main(["test", *args, "--built", out, *select], spark=spark), capsys.readouterr().out) == recomputed
    assert recomputed[0] == 1 and "PASS\tfct_trips_weekly_v2\tunique\tweek_start_date\t0" in recomputed[1]
    assert cli.main(["list"]) == 0


def test_daily_model_reads_the_written_clean_tables(spark):
    project = marts.Project(tables.role_inputs(spark, SF001))
    out = scratch_path(spark, "models")
    project.build(["+int_trips_clean", "+int_stations_clean", "+int_weather_clean", "staging"], out_dir=out)
    plan = project.ref("int_daily")._jdf.queryExecution().executedPlan().toString()
    assert "int_trips_clean" in plan and "lineitem" not in plan and "orders.parquet" not in plan
