"""Staging (T1-T6): rename raw headers, cast, parse.

One declarative column map per table drives a single ``select``; the
casts run under ANSI rules, so a value that does not convert fails the
job exactly as the reference engine's cast does.  Tolerant reads drop bad
rows earlier, in ``sources.files``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.exprs import strip_thousands
from ..schemas import STATION_FIELDS, TRIP_COLUMNS, WEATHER_PRIMARY_COLUMNS, WEATHER_SECONDARY_COLUMNS


def _parse(c: Column, typ: str, parse: str | None, tolerant: bool) -> Column:
    if parse == "trip_time":
        fmt = F.lit(dates.TRIP_TIME_FORMAT)
        return F.try_to_timestamp(c, fmt).cast("timestamp_ntz") if tolerant else F.to_timestamp_ntz(c, fmt)
    if typ == "string":
        return c
    return c.try_cast(typ) if tolerant else c.cast(typ)


def typed_column(raw: str, typ: str, parse: str | None = None, tolerant: bool = False) -> Column:
    """Expression turning raw text column ``raw`` into its staged type."""
    return _parse(F.col(f"`{raw}`"), typ, parse, tolerant)


def cast_project(df: DataFrame, columns) -> DataFrame:
    """Raw header -> staged name and type, one select."""
    return df.select(*[typed_column(raw, typ, parse).alias(name) for raw, name, typ, parse in columns])


def stage_trips(raw: DataFrame) -> DataFrame:
    """T1 from a raw trips frame whose columns are the CSV headers."""
    return cast_project(raw, TRIP_COLUMNS)


def stage_trips_marked(marked: DataFrame) -> DataFrame:
    """T1 with the rejected rows kept: the staged columns, ``rejected`` and why (``files.read_csv_marked``).

    Values of rejected rows that do not convert are null here; their text
    stands in ``reject_row``.
    """
    values = [typed_column(raw, typ, parse, tolerant=True).alias(name) for raw, name, typ, parse in TRIP_COLUMNS]
    reason = F.col("reject_reason")
    return marked.select(*values, reason.isNotNull().alias("rejected"), reason, "reject_file", "reject_row")


def good_trips(marked: DataFrame) -> DataFrame:
    """The staged trips of ``stage_trips_marked`` that a tolerant read keeps."""
    return marked.where(~F.col("rejected").cast("boolean")).select(*[name for _raw, name, _typ, _parse in TRIP_COLUMNS])


def stage_weather(raw: DataFrame, secondary: bool = False) -> DataFrame:
    """T3 / T4 from a raw weather frame."""
    return cast_project(raw, WEATHER_SECONDARY_COLUMNS if secondary else WEATHER_PRIMARY_COLUMNS)


def stage_stations(records: DataFrame) -> DataFrame:
    """Cast every station field (arrays and the JSON-valued map included)."""
    return records.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in STATION_FIELDS])


def stage_holidays(seed: DataFrame) -> DataFrame:
    """T5: keep the text date beside the parsed one."""
    return seed.select(
        F.col("event").alias("holiday_name"),
        F.col("date").alias("date_string"),
        dates.parse_day_month_year("date").alias("holiday_date"),
    )


def stage_restrictions(seed: DataFrame) -> DataFrame:
    """Parse the month, 0/1 -> boolean, strip thousands separators."""
    return seed.select(
        F.col("dates").alias("date_string"),
        dates.parse_month_year("dates").alias("report_date"),
        F.col("restrictions").cast("boolean").alias("restrictions"),
        strip_thousands("hospitalizations").alias("hospitalizations"),
        strip_thousands("icu_admissions").alias("icu_admissions"),
        strip_thousands("inhospital_deaths").alias("inhospital_deaths"),
        strip_thousands("ed_visits").alias("ed_visits"),
    )


def parse_json_map(c: Column | str, value_type: str = "string") -> Column:
    """JSON object text -> ``map<string, value_type>``; nested values stay JSON text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, f"map<string,{value_type}>")


def parse_json_variants(c: Column | str) -> Column:
    """JSON object text -> ``map<string, variant>``: every value keeps its JSON type and can be read by path.

    Null for null and for text that is no JSON object.
    """
    return parse_json_map(c, "variant")


def json_value(values: Column, key: str, path: str = "$", typ: str = "string") -> Column:
    """The value under ``key`` of a variant map, at ``path``, as ``typ``.

    Null where the key or the path is absent, where the value is a JSON null,
    and where it does not convert.
    """
    return F.try_variant_get(F.try_element_at(values, F.lit(key)), path, typ)


def json_type(values: Column, key: str) -> Column:
    """The type of the value under ``key``: VOID for a JSON null, null where the key is absent."""
    return F.schema_of_variant(F.try_element_at(values, F.lit(key)))
