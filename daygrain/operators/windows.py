"""Leak-free time-series features (W2-W17) from one declarative spec.

All features read strictly past rows: lags ``k >= 1`` and frames
``ROWS BETWEEN n PRECEDING AND 1 PRECEDING``.  Lags are row-based, like the
reference (a missing day shifts the lag).  Every expression shares one
window ordering, so Catalyst plans a single sort and one ``Window`` node
per frame shape.

Parallelism: with no ``series_keys`` the series is global and the window
runs in one partition.  That is right here because the input has one row
per day / week / month (a few thousand rows whatever the trip volume).
With ``series_keys`` (e.g. one series per station) the window is
partitioned by them and scales out over the series.  For one long global
series, or where one series of many holds much of the rows,
``add_features_bucketed`` splits each series into fixed-size buckets of
consecutive rows and copies the last ``lookback`` rows of each bucket into
the next one (a halo), so every bucket computes its features alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.exprs import pct_change
from ..session import cut_lineage

# Rolling statistics by name.  ``median`` uses ``percentile``: Spark's
# ``median`` aggregate is rejected over an ordered frame.
ROLLING_STATS: dict[str, Callable[[Column], Column]] = {
    "avg": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "median": lambda c: F.percentile(c, 0.5),
}


@dataclass(frozen=True)
class Lag:
    source: str
    k: int
    name: str


@dataclass(frozen=True)
class Rolling:
    source: str
    n: int
    stat: str
    name: str


@dataclass(frozen=True)
class Change:
    """Percent change from lag ``base`` to lag ``recent`` (null unless base > 0)."""

    source: str
    recent: int
    base: int
    name: str


@dataclass
class FeatureSpec:
    order: str
    unit: str  # name suffix: d, w or m
    series_keys: tuple[str, ...] = ()
    features: list = field(default_factory=list)

    def lags(self, source: str, prefix: str, ks: Sequence[int]) -> "FeatureSpec":
        self.features += [Lag(source, k, f"{prefix}_lag_{k}{self.unit}") for k in ks]
        return self

    def rolling(self, source: str, prefix: str, n: int, stats: Sequence[str]) -> "FeatureSpec":
        self.features += [Rolling(source, n, s, f"{prefix}_rolling_{n}{self.unit}_{s}") for s in stats]
        return self

    def change(self, source: str, prefix: str, recent: int, base: int) -> "FeatureSpec":
        u = self.unit
        self.features.append(Change(source, recent, base, f"{prefix}_change_{recent}{u}_vs_{base}{u}_pct"))
        return self

    def names(self) -> list[str]:
        return [f.name for f in self.features]


def _window(spec: FeatureSpec) -> WindowSpec:
    return Window.partitionBy(*spec.series_keys).orderBy(F.col(spec.order).asc_nulls_last())


def feature_columns(spec: FeatureSpec) -> dict[str, Column]:
    w = _window(spec)
    out: dict[str, Column] = {}
    for f in spec.features:
        if isinstance(f, Lag):
            out[f.name] = F.lag(f.source, f.k).over(w)
        elif isinstance(f, Rolling):
            out[f.name] = ROLLING_STATS[f.stat](F.col(f.source)).over(w.rowsBetween(-f.n, -1))
        elif isinstance(f, Change):
            out[f.name] = pct_change(F.lag(f.source, f.recent).over(w), F.lag(f.source, f.base).over(w))
        else:
            raise TypeError(f"unknown feature {f!r}")
    return out


def add_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Append every feature of ``spec`` in one ``withColumns`` call."""
    return df.withColumns(feature_columns(spec))


def densify(df: DataFrame, key: str, step: str) -> DataFrame:
    """Insert the missing periods (``step``: day, week or month) as rows of nulls.

    The calendar is generated from the series' own first and last period
    with one ``sequence`` (bounded by the number of periods, not by the
    data) and left-joined with the observed rows, which keep ``_observed``.
    """
    bounds = df.agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    calendar = bounds.select(
        F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL 1 {step.upper()}"))).alias(key)
    )
    return calendar.join(df.withColumn("_observed", F.lit(True)), key, "left")


def add_features_calendar(df: DataFrame, spec: FeatureSpec, step: str, bucket_rows: int | None = None) -> DataFrame:
    """Documented intent of the lags: count calendar periods, not rows.

    ``lag 7`` of a day is then the value 7 calendar days earlier (null when
    that day has no row) and rolling frames span calendar periods.  The
    reference counts rows (``add_features``), which stays the default.
    """
    if spec.series_keys:
        raise ValueError("calendar densification is defined for one series")
    dense = densify(df, spec.order, step)
    out = add_features_bucketed(dense, spec, bucket_rows) if bucket_rows else add_features(dense, spec)
    return out.filter(F.col("_observed")).drop("_observed").select(*df.columns, *spec.names())


def lookback(spec: FeatureSpec) -> int:
    """Rows before the current one that any feature of ``spec`` reads."""
    reach = [f.k if isinstance(f, Lag) else f.n if isinstance(f, Rolling) else max(f.recent, f.base)
             for f in spec.features]
    return max(reach, default=0)


def global_row_index(df: DataFrame, order: str, coarse: Column, series_keys: Sequence[str] = ()) -> DataFrame:
    """0-based position of every row in ``order`` within its series, without sorting a series in one task.

    ``coarse`` must be non-decreasing in ``order`` (e.g. the month of a
    date).  Rows are numbered inside each coarse group of a series (window
    partitioned by both), and each group's offset is the running count of the
    groups before it: a window over one row per group, joined back.
    """
    ordered = F.col(order).asc_nulls_last()
    groups = [*series_keys, "_cb"]
    tagged = df.withColumn("_cb", coarse)
    local = tagged.withColumn("_rn", F.row_number().over(Window.partitionBy(*groups).orderBy(ordered)))
    sizes = tagged.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    running = Window.partitionBy(*series_keys).orderBy(F.col("_cb").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_offset")
    offsets = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], offset)
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & local[g].eqNullSafe(F.col(f"_g{i}"))
    return local.join(offsets, same, "left").select(*df.columns, (F.col("_offset") + F.col("_rn") - 1).alias("_idx"))


def add_features_bucketed(
    df: DataFrame, spec: FeatureSpec, bucket_rows: int, coarse: Column | None = None
) -> DataFrame:
    """``add_features`` for long series, spread over many tasks.

    The rows of each series are cut into buckets of ``bucket_rows``
    consecutive rows; the last ``lookback(spec)`` rows of every bucket are
    copied into the next bucket, features are computed per series and bucket,
    and the copies are dropped.  So a series that holds a third of all rows is
    as many tasks' work as it has buckets.  Results equal ``add_features`` for
    row-based lags and frames (rows with equal order keys: in any order, as
    there).  ``coarse`` is any expression non-decreasing in the order column
    that splits a series into many groups (default: the month of a
    date/timestamp order column).
    The input is read several times, so it is written to the shared folder first.
    """
    halo = lookback(spec)
    if bucket_rows <= halo:
        raise ValueError("bucket_rows must exceed the feature lookback")
    coarse = F.trunc(F.col(spec.order), "MM") if coarse is None else coarse
    indexed = global_row_index(cut_lineage(df, "table"), spec.order, coarse, spec.series_keys)
    bucket = F.floor(F.col("_idx") / bucket_rows)
    own = indexed.withColumns({"_bucket": bucket, "_copy": F.lit(False)})
    copies = indexed.filter(F.col("_idx") % bucket_rows >= bucket_rows - halo).withColumns(
        {"_bucket": bucket + 1, "_copy": F.lit(True)}
    )
    local_spec = FeatureSpec(spec.order, spec.unit, (*spec.series_keys, "_bucket"), list(spec.features))
    out = add_features(own.unionByName(copies), local_spec)
    return out.filter(~F.col("_copy")).drop("_idx", "_bucket", "_copy")


TRIPS = "total_trips__leaky"
RATIO = "annual_member_ratio__leaky"
DURATION = "avg_trip_duration__leaky"
ALL_STATS = ["avg", "std", "min", "max", "median"]


def daily_spec(series_keys: Sequence[str] = ()) -> FeatureSpec:
    """Daily features in reference column order."""
    s = FeatureSpec("trip_date", "d", tuple(series_keys))
    s.lags(TRIPS, "trips", [1, 2, 3, 7, 14, 30])
    s.rolling(TRIPS, "trips", 7, ALL_STATS).rolling(TRIPS, "trips", 30, ALL_STATS)
    s.lags(RATIO, "annual_member_ratio", [1, 7]).rolling(RATIO, "annual_member_ratio", 7, ["avg"])
    s.lags("annual_member_trips__leaky", "annual_member_trips", [7])
    s.lags("casual_member_trips__leaky", "casual_member_trips", [7])
    s.lags(DURATION, "avg_trip_duration", [1, 7])
    s.rolling(DURATION, "avg_trip_duration", 7, ["avg"]).rolling(DURATION, "avg_trip_duration", 30, ["avg"])
    s.lags("unique_bikes__leaky", "unique_bikes", [1, 7])
    s.lags("unique_start_stations__leaky", "unique_start_stations", [1, 7])
    s.rolling("unique_start_stations__leaky", "unique_start_stations", 30, ["avg"])
    s.change(TRIPS, "trips", 1, 2).change(TRIPS, "trips", 7, 14)
    return s


def period_spec(unit: str, series_keys: Sequence[str] = ()) -> FeatureSpec:
    """Weekly or monthly features in reference column order."""
    if unit == "week":
        s = FeatureSpec("week_start_date", "w", tuple(series_keys))
        lags, frames, changes, short = [1, 2, 4, 12, 52], [4, 12, 52], [(1, 2), (52, 104)], 4
    else:
        s = FeatureSpec("month_start_date", "m", tuple(series_keys))
        lags, frames, changes, short = [1, 2, 3, 6, 12], [3, 6, 12], [(1, 2), (12, 24)], 3
    s.lags(TRIPS, "trips", lags)
    for n in frames:
        s.rolling(TRIPS, "trips", n, ALL_STATS)
    for recent, base in changes:
        s.change(TRIPS, "trips", recent, base)
    s.lags(RATIO, "annual_member_ratio", [1]).rolling(RATIO, "annual_member_ratio", short, ["avg"])
    s.lags(DURATION, "avg_trip_duration", [1]).rolling(DURATION, "avg_trip_duration", short, ["avg"])
    return s
