"""The corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
applies them in order, writing each result as Parquet in the shared folder
and reading it again.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm import bpe, exact_dedup, jaccard, langid, mix
from daygrain.llm.queries import RANKS, cycled_weights, table
from daygrain.llm.text import numbered, write_read


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text gets a language by the model that the operator fits; documents without a language of any kind go.

    Null texts and texts without a letter go (the operator's third output): a
    text stays where no language could be learned, and where the label ``und``
    was learned as a language.  Documents without a label leave with the
    predicted one; labels that are there stay.
    """
    samples = langid.fit(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    found = langid.predict_table(docs, samples, keep=docs.columns, names=("__lang", "__score", "__letters"))
    lang = F.coalesce("lang", "__lang") if samples else F.col("lang")
    return found.where("__letters").withColumn("lang", lang).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each normalised text stays: the longest, then the smallest doc_id, then any one (repeated rows)."""
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays (the smallest doc_id, null last): five-word shingles, Jaccard 0.8.

    Rows are told apart by a number of their own, so those without id, or
    with an id that stands elsewhere too, are decided like any others.
    """
    rows = numbered(docs, "__row")
    groups = jaccard.cluster(rows, id_col="__row", width=5, percent=80, counted=5).select("__row", "component_id")
    linked = write_read(groups.where(F.col("__row") != F.col("component_id")), "near-linked")
    grouped = linked.union(linked.select(F.col("component_id").alias("__row"), "component_id").distinct())
    known = write_read(grouped.join(rows.select("__row", "doc_id"), "__row"), "near-known")
    best = known.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "__row")).alias("best"))
    gone = known.join(best, "component_id").where(F.col("__row") != F.col("best.__row")).select("__row")
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows by the mix: documents it leaves out go, documents it repeats stand as often.

    Every row brings its columns and a number of its own through the mix and
    has its own decision: rows without id, or with an id that stands elsewhere
    too, are mixed like any others.
    """
    own = numbered(docs, "__row")
    rows = own.select("__row", "doc_id", "text", "source", F.struct(*docs.columns).alias("row"))
    taken, _, _ = mix.mix(rows, F.array("source"), cycled_weights, carry=("row",), number_col="__row")
    copies = F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    return taken.where(F.col("taken") > 0).select("row", copies).select("row.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of the ids and of the decoded bytes."""
    outputs = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    return bpe.encode_table(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=("doc_id", "source"), outputs=outputs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe_tokens", encode_tokens),
]

#: The language and near-duplicate stages have no SQL form: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
