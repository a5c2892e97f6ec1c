"""Marts (T14-T19, P10/P11) and the model registry / builder.

v1 marts are the grain tables without the calendar-flag columns; v2 marts
are short explicit lists.  A mart is a projection of a lazy plan, so
Catalyst prunes every feature (and every input column) the mart does not
select.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, joins, quality, staging
from ..schemas import TRIP_COLUMNS
from ..sources import files, sinks
from . import tables

GRAIN_KEYS = {"daily": "trip_date", "weekly": "week_start_date", "monthly": "month_start_date"}

# Columns of the grain tables that v1 marts leave out.
V1_EXCLUDED = {
    "daily": ["is_holiday", "has_covid_restrictions"],
    "weekly": ["non_working_day_ratio", "has_covid_restrictions"],
    "monthly": ["non_working_day_ratio", "has_covid_restrictions"],
}

# Fixed values that must equal the reference: the v2 mart column lists, in order.
MART_V2 = {
    "daily": [
        "trip_date", "day_of_week", "day_name", "is_weekend", "is_holiday", "has_covid_restrictions",
        "month_num", "year", "day_of_month", "week_of_year", "total_trips__leaky",
        "avg_trip_duration__leaky", "mean_temp_c", "total_precip_mm", "trips_lag_7d",
        "trips_rolling_7d_avg", "annual_member_ratio_lag_7d",
    ],
    "weekly": [
        "week_start_date", "year", "week_of_year", "month_num", "days_in_week", "non_working_day_ratio",
        "has_covid_restrictions", "total_trips__leaky", "avg_trip_duration__leaky", "avg_mean_temp_c",
        "avg_total_precip_mm", "trips_lag_52w", "trips_rolling_4w_avg",
    ],
    "monthly": [
        "month_start_date", "year", "month_num", "month_name", "quarter", "days_in_month",
        "non_working_day_ratio", "has_covid_restrictions", "total_trips__leaky", "avg_trip_duration__leaky",
        "avg_mean_temp_c", "avg_total_precip_mm", "trips_lag_12m", "trips_rolling_3m_avg",
    ],
}


STAGING_MODELS = {
    "stg_trips": "trips",
    "stg_stations": "stations",
    "stg_weather_primary": "weather_primary",
    "stg_weather_secondary": "weather_secondary",
    "stg_holidays": "holidays",
    "stg_restrictions": "restrictions",
}


def model_names() -> list[str]:
    """Every model a ``Project`` can build (19, as in the reference), parents first."""
    names = list(STAGING_MODELS) + [
        "int_trips_clean", "int_stations_clean", "int_weather_clean", "int_enriched_trips",
        "int_daily", "int_weekly", "int_monthly"]
    return names + [f"fct_trips_{g}_{v}" for g in GRAIN_KEYS for v in ("v1", "v2")]


def grain_columns(grain: str) -> list[str]:
    if grain == "daily":
        return list(tables.DAILY_COLUMNS)
    return tables.period_columns("week" if grain == "weekly" else "month")


def mart_columns(grain: str, version: str) -> list[str]:
    if version == "v1":
        return [c for c in grain_columns(grain) if c not in V1_EXCLUDED[grain]]
    if version == "v2":
        return list(MART_V2[grain])
    raise ValueError(f"unknown mart version {version!r}")


def mart(grain_table: DataFrame, grain: str, version: str) -> DataFrame:
    """Project a grain table to a mart."""
    return grain_table.select(*mart_columns(grain, version))


class Project:
    """Named models, resolved lazily with their parents.

    ``ref(name)`` returns the model as a DataFrame (memoised).  ``build``
    materialises the selected models and, with ``out_dir``, writes each one
    as Parquet and continues from the written table (S10), which also cuts
    the lineage between layers the way the reference's table
    materialisation does.  The daily model reads the cleaned models, so a
    build with parents parses raw CSV once and aggregates Parquet.

    The write of a model also measures its declared tests (``observed``), and
    the write of the staged trips, where the inputs have ``trips_marked``,
    counts the rows it rejects by reason (``drops``) and keeps them beside the
    good ones (``rejected``): one scan of the raw files for all of it.
    """

    def __init__(self, inputs: tables.Inputs, **options):
        self.inputs = inputs
        self.observed: dict[str, list[tuple[str, str, int]]] = {}
        self.drops: dict[str, int] | None = None
        self.rejected: DataFrame | None = None
        self.options = options
        self._models: dict[str, DataFrame] = {}
        self._builders: dict[str, tuple[list[str], Callable[[], DataFrame]]] = {
            name: ([], (lambda f=f: getattr(inputs, f))) for name, f in STAGING_MODELS.items()
        }
        ref = self.ref
        self._builders.update({
            "int_trips_clean": (["stg_trips"], lambda: cleaning.clean_trips(ref("stg_trips"))),
            "int_stations_clean": (["stg_stations"], lambda: cleaning.clean_stations(ref("stg_stations"))),
            "int_weather_clean": (
                ["stg_weather_primary", "stg_weather_secondary"],
                lambda: cleaning.clean_weather(ref("stg_weather_primary"), ref("stg_weather_secondary")),
            ),
            "int_enriched_trips": (
                ["int_trips_clean", "int_stations_clean", "int_weather_clean"],
                lambda: joins.enrich_trips(
                    self.ref("int_trips_clean"), self.ref("int_stations_clean"), self.ref("int_weather_clean")
                ),
            ),
            "int_daily": (
                ["int_trips_clean", "int_stations_clean", "int_weather_clean", "stg_holidays", "stg_restrictions"],
                lambda: tables.daily_features_from(
                    ref("int_trips_clean"), ref("int_stations_clean"), ref("int_weather_clean"),
                    ref("stg_holidays"), ref("stg_restrictions"), **options,
                ),
            ),
            "int_weekly": (["int_daily"], lambda: tables.weekly_features(ref("int_daily"))),
            "int_monthly": (["int_daily"], lambda: tables.monthly_features(ref("int_daily"))),
        })
        for grain in GRAIN_KEYS:
            for version in ("v1", "v2"):
                parent = f"int_{grain}"
                self._builders[f"fct_trips_{grain}_{version}"] = (
                    [parent],
                    (lambda p=parent, g=grain, v=version: mart(self.ref(p), g, v)),
                )
        assert list(self._builders) == model_names()

    @property
    def names(self) -> list[str]:
        return list(self._builders)

    def parents(self, name: str) -> list[str]:
        return self._builders[name][0]

    def ref(self, name: str) -> DataFrame:
        if name not in self._models:
            self._models[name] = self._builders[name][1]()
        return self._models[name]

    def use_built(self, spark: SparkSession, out_dir: str, names: Iterable[str]) -> None:
        """Read the models ``names`` from the tables an earlier ``build`` wrote below ``out_dir``."""
        for n in names:
            self._models[n] = self._kept(spark.read.parquet(f"{out_dir.rstrip('/')}/{n}"))

    def _kept(self, written: DataFrame) -> DataFrame:
        """The rows of a written model without those that a tolerant read rejected."""
        if "rejected" not in written.columns:
            return written
        self.rejected = written.where(F.col("rejected").cast("boolean")).select(*files.REJECT_COLUMNS)
        return staging.good_trips(written)

    def _write(self, name: str, df: DataFrame, path: str, partition_by: list[str] | None, replace: str) -> DataFrame:
        from .checks import declared_tests  # which needs the names of the models

        if name == "stg_trips" and self.inputs.trips_marked is not None:
            marked, dropped = quality.observe_reasons(
                self.inputs.trips_marked, "reject_reason", files.reject_reasons(TRIP_COLUMNS))
            written = sinks.materialize(marked, path, ["rejected"], gather=False)
            self.drops = {reason: rows for reason, rows in dropped().items() if rows}
            return self._kept(written)
        watched, violations = quality.observe_checks(df, *declared_tests(name))
        written = sinks.materialize(watched, path, partition_by, replace)
        self.observed[name] = violations()
        return written

    def select(self, selector: str | Iterable[str]) -> list[str]:
        """Model names for a selector: a name, a prefix (``stg``, ``int``, ``fct``), a layer
        (``staging``, ``intermediate``, ``marts``), a version (``v2``), or ``+name`` for a
        model with all its parents."""
        items = [selector] if isinstance(selector, str) else list(selector)
        chosen: list[str] = []

        def add(n: str, with_parents: bool) -> None:
            if with_parents:
                for p in self.parents(n):
                    add(p, True)
            if n not in chosen:
                chosen.append(n)

        layers = {"staging": "stg_", "intermediate": "int_", "marts": "fct_"}
        for item in items:
            with_parents = item.startswith("+")
            key = layers.get(item.lstrip("+"), item.lstrip("+"))
            matches = [n for n in self.names if n == key or n.startswith(key) or n.endswith(f"_{key}")]
            if not matches:
                raise KeyError(f"no model matches {item!r}")
            for n in matches:
                add(n, with_parents)
        return chosen

    def build(
        self,
        selector: str | Iterable[str] = "",
        out_dir: str | None = None,
        export_dir: str | None = None,
        partition_by: dict[str, list[str]] | None = None,
        replace: str = "table",
    ) -> dict[str, DataFrame]:
        """Resolve the selected models; with ``out_dir`` write each and go on from the table.

        ``partition_by`` names the partition columns of models that have some;
        with ``replace="partitions"`` their partitions without new rows stay.
        """
        names = self.select(selector) if selector else self.names
        layout = partition_by or {}
        built: dict[str, DataFrame] = {}
        for n in names:
            df = self.ref(n)
            if out_dir:
                df = self._write(n, df, f"{out_dir.rstrip('/')}/{n}", layout.get(n), replace if n in layout else "table")
                self._models[n] = df
            if export_dir and n.startswith("fct_"):
                grain = n.split("_")[2]
                sinks.export_csv(df, f"{export_dir.rstrip('/')}/{n}", order_by=GRAIN_KEYS[grain])
            built[n] = df
        return built
