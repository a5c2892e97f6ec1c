"""Exact dedup: skew-safe combining, native expressions only.

Texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``.  The
combining runs in three steps, and each groups by the digest *and the whole
normalised text*, so a digest collision can never merge two texts:

1. local: Spark's map-side aggregation folds the copies of a text within one
   scan task into one row;
2. salted: the local rows of a digest are merged in ``salts`` groups (the
   salt is the scan partition's number), so a text that a third of all rows
   repeat meets in ``salts`` tasks, each with a few rows;
3. global: the at most ``salts`` winners of each text are combined.

The winner is the row with the most code points in the original text, ties
to the smallest id.  It is one ``max`` over a decimal that holds both, which
keeps the aggregation in Spark's hash form (no sort by whole texts).

Defined cases: null text counts as empty; null ids come last in a tie and
are reported as null; rows that repeat both id and text share one decision
of ``decisions`` and all count in ``group_size``, while ``kept_rows`` keeps
one row of them; an empty table gives an empty result; extra
columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import numbered

_WHITE_CHARS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
_SPAN = 1 << 64
_LAST = (1 << 63) - 1


def normalised(text: Column) -> Column:
    """``text`` without white space (six plain replaces: faster than a regex or translate)."""
    out = F.coalesce(text, F.lit(""))
    for ch in _WHITE_CHARS:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def _decimal(value: int) -> Column:
    return F.lit(value).cast("decimal(20,0)") if value <= _LAST else F.lit(str(value)).cast("decimal(20,0)")


def _rank(n: Column, doc_id: Column) -> Column:
    """One decimal, larger for longer texts, then for smaller ids."""
    known = F.coalesce(doc_id.cast("long"), F.lit(_LAST))
    return (n.cast("decimal(10,0)") * _decimal(_SPAN) + (_decimal(_LAST) - known.cast("decimal(20,0)"))).cast("decimal(38,0)")


def _rank_id(rank: Column) -> Column:
    got = (_decimal(_LAST) - F.pmod(rank, _decimal(_SPAN).cast("decimal(38,0)"))).cast("long")
    return F.when(got != F.lit(_LAST), got)


def _rank_size(rank: Column) -> Column:
    span = _decimal(_SPAN).cast("decimal(38,0)")
    return ((rank - F.pmod(rank, span)) / _decimal(_SPAN)).cast("long")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32, tag: str | None = None) -> DataFrame:
    """One row per distinct normalised text: digest, check, keep_id, keep_chars, group_size.

    With ``tag``, a number of its own for every row, also keep_tag: that of one
    row with the winner's id and length.
    """
    norm = normalised(F.col(text_col))
    rows = docs.select(
        norm.alias("norm"),
        *([F.col(tag).alias("tag")] if tag else []),
        _rank(F.length(F.coalesce(F.col(text_col), F.lit(""))), F.col(id_col)).alias("rank"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
    ).withColumn("digest", F.sha2("norm", 256))
    one = [F.max_by("tag", "rank").alias("tag")] if tag else []
    salted = rows.groupBy("digest", "norm", "salt").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n"), *one)
    whole = salted.groupBy("digest", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"), *one)
    return whole.select(
        "digest",
        F.xxhash64("norm").alias("check"),
        _rank_id(F.col("rank")).alias("keep_id"),
        _rank_size(F.col("rank")).alias("keep_chars"),
        F.col("group_size").cast("long").alias("group_size"),
        *([F.col("tag").alias("keep_tag")] if tag else []),
    )


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32, carry: list[str] | None = None) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (and ``carry`` columns).

    The way back joins on the digest and an independent 64-bit hash.  A hot
    digest is a skewed join key: adaptive execution splits its side, and the
    other side has one row per text.
    """
    carry = carry or []
    norm = normalised(F.col(text_col))
    rows = docs.select(
        F.struct(F.col(id_col).alias("id"), *carry).alias("row"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
        F.sha2(norm, 256).alias("digest"),
        F.xxhash64(norm).alias("check"),
    )
    won = groups(docs, id_col, text_col, salts)
    kept = F.col("row.id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return rows.join(won, ["digest", "check"]).select(
        F.col("row.id").alias(id_col),
        "keep_id",
        "group_size",
        kept.alias("kept"),
        F.col("digest").alias("text_sha256"),
        *[F.col(f"row.{c}").alias(c) for c in carry],
    )


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """One row of each normalised text, with all its columns: the longest, then the smallest id, then any one."""
    rows = numbered(docs, "__row")
    won = groups(rows, id_col, text_col, salts, tag="__row").select(F.col("keep_tag").alias("__row"))
    return rows.join(won, "__row", "left_semi").select(*docs.columns)


ORACLE = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents),
w AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w
"""
