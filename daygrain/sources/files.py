"""File sources (S1-S8, F11): CSV globs, JSON records, seed files.

CSV reads never infer types.  Files are read as text with the declared
raw headers, grouped by their actual header line so that files whose
columns come in another order are aligned by *name* (Spark's CSV reader
aligns by position), and unioned by name.  A declared column that is missing
fails with the file named; files without content hold no rows.  Bad rows:

* ``drop``  (the reference's ``ignore_errors``): rows with the wrong number
  of fields are dropped by the parser (``DROPMALFORMED``), rows whose values
  do not convert to the declared types are dropped by a ``try_cast`` filter;
* ``fail``: the first bad row fails the job, whatever columns are used;
* ``only``: return just the rejected (convertible-length) rows, as text, for
  a data-quality report.

``read_csv_marked`` keeps every row with the reason for which a tolerant read
would drop it, so that one scan can write the good rows and the bad ones.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.staging import typed_column

def list_files(spark: SparkSession, pattern: str | Sequence[str]) -> list[str]:
    """Paths matching a glob, from the driver's file listing (no scan of the files)."""
    patterns = [pattern] if isinstance(pattern, str) else list(pattern)
    return sorted(unquote(p) for p in spark.read.text(patterns).inputFiles())


#: Bytes of a line that the header step reads, and blank characters that the layout probe skips.
LONGEST_HEADER = 1 << 20
LONGEST_BLANK = 1 << 16


def _one_file_a_task(spark: SparkSession) -> SparkSession:
    """A session of the same application whose scans give every file, uncut, a task of its own."""
    session = spark.newSession()
    whole = str(1 << 60)
    session.conf.set("spark.sql.files.maxPartitionBytes", whole)
    session.conf.set("spark.sql.files.openCostInBytes", whole)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return session


def _text_scan(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame:
    reader = _one_file_a_task(spark).read.option("mapreduce.input.linerecordreader.line.maxlength", str(LONGEST_HEADER))
    return reader.text([pattern] if isinstance(pattern, str) else list(pattern))


def first_lines(scan: DataFrame) -> DataFrame:
    """(path, line): the first line of every file of a text scan that is not blank, found by one Spark job.

    A task opens one file (compressed ones included), takes lines until one is
    not blank and stops there: neither the driver nor the job reads the files.
    ``line`` is null where all lines are blank; files without content have no
    row.  Lines beyond ``LONGEST_HEADER`` bytes are passed over.
    """

    def take(batches):
        path, line, more = None, None, 0
        for batch in batches:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if line is None and text.strip("\ufeff").strip():
                    line = text.removeprefix("\ufeff")
            more += line is not None
            if more > 4:  # a short file is read to its end, which keeps the worker for the next one
                break
        if path is not None:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([line], pa.string())], names=["path", "line"])

    rows = scan.select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.mapInArrow(take, "path string, line string")


def _plain(path: str) -> str:
    """A path as both the file listing and a scan's metadata name it (``file:///x`` and ``file:/x`` are one file)."""
    return re.sub(r"^(\w+):///", r"\1:/", unquote(path))


def headers_by_file(spark: SparkSession, pattern: str | Sequence[str], sep: str = ",") -> dict[str, tuple[str, ...]]:
    """Header of every file that has content, by path, from one listing and one job whatever the number of files."""
    scan = _text_scan(spark, pattern)
    paths = sorted(unquote(p) for p in scan.inputFiles())
    out = {}
    for r in first_lines(scan).collect() if paths else []:
        if r["line"] is None:
            raise ValueError(f"only blank lines in {unquote(r['path'])}")
        out[_plain(r["path"])] = tuple(next(csv.reader(io.StringIO(r["line"]), delimiter=sep)))
    return {p: out[_plain(p)] for p in paths if _plain(p) in out}


def opening(spark: SparkSession, path: str) -> str | None:
    """The first character of a file that is not blank: reads no more than that (at most ``LONGEST_BLANK`` characters).

    None for a file without content.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        source = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8"), 4096)
        for seen in range(LONGEST_BLANK):
            code = reader.read()
            if code < 0:
                if seen:
                    raise ValueError(f"only blank characters in {path}")
                return None
            if not chr(code).isspace() and code != 0xFEFF:
                return chr(code)
        raise ValueError(f"more than {LONGEST_BLANK} blank characters at the start of {path}")
    finally:
        stream.close()


def _layouts(spark, pattern, columns, sep: str, strict: bool) -> list[tuple[dict[str, str], tuple[str, ...], list[str]]]:
    """Files by header: (declared name -> name in the files, header, paths).

    Names match whatever their case.  A declared column that a file lacks
    fails with the file named; so does an undeclared one when ``strict``.
    """
    wanted = [c[0] for c in columns]
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in headers_by_file(spark, pattern, sep).items():
        groups.setdefault(header, []).append(path)
    out = []
    for header, files in groups.items():
        by_name = {h.casefold(): h for h in header}
        missing = [w for w in wanted if w.casefold() not in by_name]
        if missing:
            raise ValueError(f"columns {missing} are missing in {files[0]}")
        known = {w.casefold() for w in wanted}
        unknown = [h for h in header if h.casefold() not in known]
        if unknown and strict:
            raise ValueError(f"unexpected columns {unknown} in {files[0]}")
        out.append(({w: by_name[w.casefold()] for w in wanted}, header, files))
    if not out:
        raise FileNotFoundError(f"no CSV files match {pattern!r}")
    return out


def _reader(spark, header, sep: str, null_value: str | None, mode: str, extra: Sequence[str] = ()):
    """A CSV reader that counts fields against the whole header, whatever the projection."""
    schema = T.StructType([T.StructField(h, T.StringType(), True) for h in (*header, *extra)])
    reader = (
        spark.read.schema(schema).option("header", True).option("sep", sep)
        .option("columnPruning", "false").option("mode", mode)
    )
    return reader if null_value is None else reader.option("nullValue", null_value)


def _valid(raw: str, typ: str, parse: str | None) -> Column:
    c = F.col(f"`{raw}`")
    if typ == "string":
        return F.lit(True)
    return c.isNull() | typed_column(raw, typ, parse, tolerant=True).isNotNull()


def read_csv_aligned(
    spark: SparkSession,
    pattern: str | Sequence[str],
    columns,
    *,
    bad_rows: str = "drop",
    null_value: str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Raw text columns named by their raw headers.

    ``columns`` is a column map of ``daygrain.schemas`` (raw header, staged
    name, type, parse); the result keeps the raw header names and text
    values, ready for ``operators.staging.cast_project``.
    """
    if bad_rows not in ("drop", "fail", "only"):
        raise ValueError(f"unknown bad-row policy {bad_rows!r}")
    strict = bad_rows == "fail"
    parts = []
    for names, header, files in _layouts(spark, pattern, columns, sep, strict):
        df = _reader(spark, header, sep, null_value, "FAILFAST" if strict else "DROPMALFORMED").csv(files)
        parts.append(df.select(*[F.col(f"`{name}`").alias(w) for w, name in names.items()]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ok = F.lit(True)
    for raw, _name, typ, parse in columns:
        ok = ok & _valid(raw, typ, parse)
    if strict:
        # A filter survives column pruning, so every declared type is checked.
        row = F.to_json(F.struct(*[F.col(f"`{c[0]}`") for c in columns]))
        failed = F.raise_error(F.concat(F.lit("a value does not convert to its declared type: "), row)).cast("boolean")
        return out.filter(F.when(ok, F.lit(True)).otherwise(failed))
    return out.filter(ok) if bad_rows == "drop" else out.filter(~ok)


def read_csv_marked(
    spark: SparkSession,
    pattern: str | Sequence[str],
    columns,
    *,
    null_value: str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Every row of the files, as text named by the raw headers, and why a tolerant read drops it.

    Beside the declared columns: ``reject_reason`` (null for a good row;
    ``field_count`` for rows with too few or too many fields, else
    ``type:<raw header>`` for the first column whose value does not convert to
    its declared type), and for rejected rows ``reject_file`` and
    ``reject_row`` (the row's text; for a bad value, its fields as JSON).
    """
    parts = []
    for names, header, files in _layouts(spark, pattern, columns, sep, strict=False):
        reader = _reader(spark, header, sep, null_value, "PERMISSIVE", ["_corrupt"])
        df = reader.option("columnNameOfCorruptRecord", "_corrupt").csv(files)
        parts.append(df.select(
            F.col("_metadata.file_path").alias("_file"), "_corrupt",
            *[F.col(f"`{name}`").alias(w) for w, name in names.items()],
        ))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit("field_count"))
    for raw, _name, typ, parse in columns:
        reason = reason.when(~_valid(raw, typ, parse), F.lit(f"type:{raw}"))
    fields = [F.col(f"`{c[0]}`") for c in columns]
    marked = rows.select(*fields, "_file", "_corrupt", reason.alias("reject_reason"))
    bad = F.col("reject_reason").isNotNull()
    return marked.select(
        *fields, "reject_reason", F.when(bad, F.col("_file")).alias("reject_file"),
        F.when(bad, F.coalesce("_corrupt", F.to_json(F.struct(*fields)))).alias("reject_row"),
    )


REJECT_COLUMNS = ("reject_reason", "reject_file", "reject_row")


def reject_reasons(columns) -> list[str]:
    """Every reason that ``read_csv_marked`` can give."""
    return ["field_count"] + [f"type:{raw}" for raw, _name, typ, _parse in columns if typ != "string"]


def csv_reject_report(
    spark: SparkSession,
    pattern: str | Sequence[str],
    columns,
    *,
    null_value: str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Rows a tolerant read drops, counted per file and reason (one pass): ``file_path, reason, rows``."""
    rows = read_csv_marked(spark, pattern, columns, null_value=null_value, sep=sep)
    rejected = rows.select(F.col("reject_file").alias("file_path"), F.col("reject_reason").alias("reason"))
    return rejected.filter(F.col("reason").isNotNull()).groupBy("file_path", "reason").agg(F.count(F.lit(1)).alias("rows"))


def write_raw_csv(df: DataFrame, path: str, columns, header_order: Sequence[str] | None = None) -> None:
    """Render a staged table in its raw text layout (inverse of staging).

    Used to exercise the raw-file path on the driver's tables; timestamps
    are written in the reference's trip time format.
    """
    from ..functions.dates import TRIP_TIME_FORMAT

    exprs = {}
    for raw, name, typ, parse in columns:
        c = F.col(name)
        if parse == "trip_time":
            exprs[raw] = F.date_format(c, TRIP_TIME_FORMAT)
        else:
            exprs[raw] = c.cast("string")
    order = list(header_order) if header_order else [c[0] for c in columns]
    df.select(*[exprs[r].alias(r) for r in order]).write.mode("overwrite").option("header", True).csv(path)


def record_path_schema(record_schema: T.StructType, record_path: str) -> T.StructType:
    """Wrapper schema for records nested at ``a.b`` as an array."""
    node: T.DataType = T.ArrayType(record_schema, True)
    for part in reversed(record_path.split(".")):
        node = T.StructType([T.StructField(part, node, True)])
    return node  # type: ignore[return-value]


JSON_LAYOUTS = ("lines", "array", "nested")


def read_json_records(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    record_path: str | None = None,
    layout: str | None = None,
    key: str | None = None,
) -> DataFrame:
    """JSON records with a declared schema and layout.

    ``lines``: one record per line; ``array``: a top-level array, possibly
    over many lines; ``nested``: one document that holds the array at
    ``record_path`` (e.g. ``"data.stations"``), unwrapped with ``inline``.
    Another layout than the declared one raises: malformed text fails the
    read, each file must open with the layout's bracket, and with ``key``
    a record without that field fails.
    """
    layout = layout or ("nested" if record_path else "lines")
    if layout not in JSON_LAYOUTS or (layout == "nested") != bool(record_path):
        raise ValueError(f"layout {layout!r} with record path {record_path!r}")
    bracket = "[" if layout == "array" else "{"
    for file in list_files(spark, path):
        if opening(spark, file) not in (None, bracket):
            raise ValueError(f"{file} does not open with {bracket!r} as the layout {layout!r} does")
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", layout != "lines")
    if layout == "nested":
        df = reader.schema(record_path_schema(schema, record_path)).json(path).selectExpr(f"inline({record_path})")
    else:
        df = reader.schema(schema).json(path)
    if key is None:
        return df
    failed = F.raise_error(F.lit(f"a record without {key}: is the layout {layout!r}?")).cast("boolean")
    return df.filter(F.when(F.col(key).isNotNull(), F.lit(True)).otherwise(failed))


def load_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A small header CSV with declared column types and quoted values."""
    return (
        spark.read.schema(ddl)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )
