"""Where each operator id of SURVEY section 2 lives, and what exercises it.

``COVERAGE[id] = (callable path, registered query or test)``.  The test
suite resolves every callable and checks every query name against the
registry; that the query runs the callable is kept by hand.
"""

from __future__ import annotations

F_ = "daygrain.functions"
O_ = "daygrain.operators"
P_ = "daygrain.plans"
S_ = "daygrain.sources"

COVERAGE: dict[str, tuple[str, str]] = {
    # scans, sources, sinks
    "S1": (f"{S_}.files.read_csv_aligned", "s01_csv_trips_aligned"),
    "S2": (f"{S_}.files.read_json_records", "s02_json_array_stations"),
    "S3": (f"{S_}.files.read_csv_aligned", "s03_s04_weather_csv"),
    "S4": (f"{S_}.files.read_csv_aligned", "s03_s04_weather_csv"),
    "S5": (f"{S_}.files.load_seed", "t11_daily_features_from_raw_files"),
    "S6": (f"{S_}.files.load_seed", "t11_daily_features_from_raw_files"),
    "S7": (f"{S_}.files.record_path_schema", "s07_nested_stations"),
    "S8": (f"{S_}.files.headers_by_file", "s01_csv_trips_aligned"),
    "S9": (f"{P_}.marts.Project.ref", "s12_build_materialize_read"),
    "S10": (f"{S_}.sinks.materialize", "s12_build_materialize_read"),
    "S11": (f"{S_}.sinks.export_csv", "s11_export_csv_roundtrip"),
    "S12": (f"{P_}.marts.Project.build", "s12_build_materialize_read"),
    "S13": (f"{S_}.sinks.read_mart", "s10_f09_partition_rebuild"),
    "S14": (f"{S_}.sinks.read_exported_csv", "s11_export_csv_roundtrip"),
    # projections
    "P1": (f"{O_}.staging.stage_trips", "s01_csv_trips_aligned"),
    "P2": (f"{O_}.staging.stage_stations", "t02_staged_stations"),
    "P3": (f"{O_}.staging.stage_weather", "t03_staged_weather_primary"),
    "P4": (f"{O_}.staging.stage_weather", "t04_staged_weather_secondary"),
    "P5": (f"{O_}.staging.stage_holidays", "t05_staged_holidays"),
    "P6": (f"{O_}.staging.stage_restrictions", "t06_staged_restrictions"),
    "P7": (f"{O_}.cleaning.clean_stations", "t08_clean_stations"),
    "P8": (f"{O_}.joins.role_join", "t10_enriched_trips"),
    "P9": (f"{P_}.tables.daily_features", "t11_daily_features"),
    "P10": (f"{P_}.marts.mart_columns", "t14_fct_trips_daily_v1"),
    "P11": (f"{P_}.marts.mart_columns", "t17_fct_trips_daily_v2"),
    "P12": (f"{P_}.tables.daily_base", "t11_daily_features"),
    # filters
    "F1": (f"{O_}.cleaning.clean_trips", "t07_clean_trips"),
    "F2": (f"{O_}.aggregate.top_pair", "o02_top_pair"),
    "F3": (f"{O_}.aggregate.daily_shared", "t11_daily_features"),
    "F4": (f"{F_}.dates.is_weekend", "x07_calendar_functions"),
    "F5": (f"{O_}.cleaning.fallback_merge", "t09_clean_weather"),
    "F6": (f"{O_}.joins.holiday_flag", "j07_j08_calendar_flags"),
    "F7": (f"{F_}.exprs.pct_change", "t11_daily_features"),
    "F8": (f"{O_}.aggregate.rollup_period", "t12_weekly_features"),
    "F9": (f"{S_}.sinks.read_mart", "s10_f09_partition_rebuild"),
    "F10": (f"{P_}.modeling.complete_cases", "f10_m01_m03_split"),
    "F11": (f"{S_}.files.read_csv_marked", "f11_observed_drops"),
    # joins
    "J1": (f"{O_}.cleaning.fallback_merge", "t09_clean_weather"),
    "J2": (f"{O_}.joins.enrich_trips", "t10_enriched_trips"),
    "J3": (f"{O_}.joins.enrich_trips", "t10_enriched_trips"),
    "J4": (f"{O_}.joins.enrich_trips", "t11_daily_features_join_first"),
    "J5": (f"{P_}.tables.daily_base", "t11_daily_features"),
    "J6": (f"{P_}.tables.daily_base", "t11_daily_features"),
    "J7": (f"{O_}.joins.holiday_flag", "j07_j08_calendar_flags"),
    "J8": (f"{O_}.joins.restriction_flag", "j07_j08_calendar_flags"),
    # aggregations
    "A1": (f"{O_}.aggregate.trip_day", "t11_daily_features"),
    "A2": (f"{O_}.aggregate.daily_shared", "t11_daily_features"),
    "A3": (f"{O_}.aggregate.daily_shared", "t11_daily_features"),
    "A4": (f"{F_}.exprs.share", "t11_daily_features"),
    "A5": (f"{O_}.aggregate.distinct_per_day", "a05_count_distinct"),
    "A6": (f"{O_}.aggregate.daily_shared", "t11_daily_features"),
    "A7": (f"{O_}.aggregate.duration_quartiles", "a10_percentiles"),
    "A8": (f"{O_}.aggregate.daily_shared", "t11_daily_features"),
    "A9": (f"{O_}.aggregate.daily_shared", "t11_daily_features"),
    "A10": (f"{O_}.aggregate.duration_quartiles", "a10_percentiles"),
    "A11": (f"{O_}.aggregate.daily_shared", "t11_daily_features"),
    "A12": (f"{O_}.aggregate.weather_by_day", "t11_daily_features"),
    "A13": (f"{O_}.aggregate.weather_by_day", "t11_daily_features_join_first"),
    "A14": (f"{O_}.aggregate.pair_counts", "a14_pair_counts"),
    "A15": (f"{O_}.aggregate.rollup_period", "t12_weekly_features"),
    "A16": (f"{O_}.aggregate.rollup_period", "t13_monthly_features"),
    "A17": (f"{O_}.aggregate.rollup_period", "t12_weekly_features"),
    "A18": (f"{O_}.aggregate.rollup_period", "t13_monthly_features"),
    "A19": (f"{O_}.aggregate.rollup_period", "t12_weekly_features"),
    "A20": (f"{O_}.aggregate.rollup_period", "t13_monthly_features"),
    "A21": (f"{O_}.aggregate.rollup_period", "t12_weekly_features"),
    "A22": (f"{O_}.aggregate.rollup_period", "q05_period_coverage"),
    "A23": (f"{O_}.aggregate.rollup_period", "t18_fct_trips_weekly_v2"),
    "A24": (f"{O_}.aggregate.rollup_period", "t19_fct_trips_monthly_v2"),
    "A25": (f"{O_}.joins.holiday_flag", "j07_j08_calendar_flags"),
    # windows
    "W1": (f"{O_}.aggregate.top_pair", "o02_top_pair"),
    "W2": (f"{O_}.windows.daily_spec", "t11_daily_features"),
    "W3": (f"{O_}.windows.period_spec", "t12_weekly_features"),
    "W4": (f"{O_}.windows.period_spec", "t13_monthly_features"),
    "W5": (f"{O_}.windows.add_features", "t11_daily_features"),
    "W6": (f"{O_}.windows.add_features", "t12_weekly_features"),
    "W7": (f"{O_}.windows.add_features", "t13_monthly_features"),
    "W8": (f"{O_}.windows.add_features", "t11_daily_features"),
    "W9": (f"{O_}.windows.add_features", "t12_weekly_features"),
    "W10": (f"{O_}.windows.add_features", "t13_monthly_features"),
    "W11": (f"{O_}.windows.add_features", "t11_daily_features"),
    "W12": (f"{O_}.windows.daily_spec", "t11_daily_features"),
    "W13": (f"{O_}.windows.add_features", "t12_weekly_features"),
    "W14": (f"{O_}.windows.add_features", "t13_monthly_features"),
    "W15": (f"{O_}.windows.daily_spec", "t11_daily_features"),
    "W16": (f"{O_}.windows.daily_spec", "t11_daily_features"),
    "W17": (f"{O_}.windows.Change", "t12_weekly_features"),
    "W18": (f"{O_}.cleaning.interpolate_single_gaps", "t09_clean_weather"),
    # sort / top-k
    "O1": (f"{S_}.sinks.export_csv", "s11_export_csv_roundtrip"),
    "O2": (f"{O_}.aggregate.top_pair", "o02_top_pair_struct"),
    "O3": (f"{P_}.modeling.top_features", "m04_m06_forest_report"),
    # scalar functions
    "X1": (f"{F_}.dates.parse_trip_time", "s01_csv_trips_aligned"),
    "X2": (f"{F_}.dates.parse_month_year", "t11_daily_features_from_raw_files"),
    "X3": (f"{F_}.dates.parse_day_month_year", "t11_daily_features_from_raw_files"),
    "X4": (f"{F_}.exprs.strip_thousands", "t06_staged_restrictions"),
    "X5": (f"{F_}.dates.to_day", "t11_daily_features"),
    "X6": (f"{O_}.staging.stage_weather", "s03_s04_weather_csv"),
    "X7": (f"{F_}.dates.day_of_week", "x07_calendar_functions"),
    "X8": (f"{F_}.dates.day_name", "x07_calendar_functions"),
    "X9": (f"{F_}.dates.month_name", "x07_calendar_functions"),
    "X10": (f"{F_}.dates.year", "x07_calendar_functions"),
    "X11": (f"{F_}.dates.iso_week", "x07_calendar_functions"),
    "X12": (f"{F_}.dates.quarter", "x07_calendar_functions"),
    "X13": (f"{F_}.dates.period_start", "x07_calendar_functions"),
    "X14": (f"{O_}.cleaning.clean_stations", "t08_clean_stations"),
    "X15": (f"{F_}.exprs.share", "t12_weekly_features"),
    "X16": (f"{F_}.exprs.pct_change", "t13_monthly_features"),
    "X17": (f"{F_}.exprs.empty_string_array", "t08_clean_stations"),
    "X18": (f"{O_}.staging.cast_project", "s01_csv_trips_aligned"),
    "X19": (f"{O_}.staging.parse_json_variants", "x19_json_variant"),
    "X20": (f"{O_}.cleaning.interpolate_single_gaps", "t09_clean_weather"),
    # data quality
    "Q1": (f"{O_}.quality.null_counts", "q01_q02_quality_report"),
    "Q2": (f"{O_}.quality.duplicate_keys", "q01_q02_quality_report"),
    "Q3": (f"{O_}.quality.orphans", "q03_orphans"),
    "Q4": ("daygrain.schemas.assert_schema", "q04_schema_report"),
    "Q5": (f"{O_}.quality.period_coverage", "q05_period_coverage"),
    # modelling hand-off
    "M1": (f"{P_}.modeling.select_features", "f10_m01_m03_split"),
    "M2": (f"{P_}.modeling.complete_cases", "f10_m01_m03_split"),
    "M3": (f"{P_}.modeling.chrono_split", "f10_m01_m03_split"),
    "M4": (f"{P_}.modeling.fit_forest", "m04_m06_forest_report"),
    "M5": (f"{P_}.modeling.r2", "m04_m06_forest_report"),
    "M6": (f"{P_}.modeling.importances", "m04_m06_forest_report"),
    # derived tables
    "T1": (f"{O_}.staging.stage_trips", "t01_staged_trips"),
    "T2": (f"{O_}.staging.stage_stations", "t02_staged_stations"),
    "T3": (f"{O_}.staging.stage_weather", "t03_staged_weather_primary"),
    "T4": (f"{O_}.staging.stage_weather", "t04_staged_weather_secondary"),
    "T5": (f"{O_}.staging.stage_holidays", "t05_staged_holidays"),
    "T6": (f"{O_}.staging.stage_restrictions", "t06_staged_restrictions"),
    "T7": (f"{P_}.tables.trips_clean", "t07_clean_trips"),
    "T8": (f"{P_}.tables.stations_clean", "t08_clean_stations"),
    "T9": (f"{P_}.tables.weather_clean", "t09_clean_weather"),
    "T10": (f"{P_}.tables.enriched_trips", "t10_enriched_trips"),
    "T11": (f"{P_}.tables.daily_features", "t11_daily_features"),
    "T12": (f"{P_}.tables.weekly_features", "t12_weekly_features"),
    "T13": (f"{P_}.tables.monthly_features", "t13_monthly_features"),
    "T14": (f"{P_}.marts.mart", "t14_fct_trips_daily_v1"),
    "T15": (f"{P_}.marts.mart", "t15_fct_trips_weekly_v1"),
    "T16": (f"{P_}.marts.mart", "t16_fct_trips_monthly_v1"),
    "T17": (f"{P_}.marts.mart", "t17_fct_trips_daily_v2"),
    "T18": (f"{P_}.marts.mart", "t18_fct_trips_weekly_v2"),
    "T19": (f"{P_}.marts.mart", "t19_fct_trips_monthly_v2"),
}
