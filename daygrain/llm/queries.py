"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, codes, exact_dedup, extraction, jaccard, langid, mix, oddsketch, preferences, secrets, substring, topk, whitening

RANKS = "byte_bpe_50k.tiktoken"
#: op9: weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_extract_text(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    found = extraction.extract_table(pages, extraction.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_preference_pairs(spark, sf_dir):
    """Preference pairs of all conversations, with one shared prompt and masked completions."""
    pairs = preferences.pairs_from_conversations(table(spark, sf_dir, "conversations"))
    return preferences.format_pairs(pairs, keep=["chosen_id", "rejected_id", "kind"])


def op3_bpe_round_trip(spark, sf_dir):
    """Token ids of every document and the bytes they decode to, as digests."""
    docs = table(spark, sf_dir, "documents")
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.encode_table(docs, path, pattern, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op4_jaccard_components(spark, sf_dir):
    """Components of documents whose 3-word shingle sets have Jaccard 0.9 or more."""
    return jaccard.cluster(table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_language_id(spark, sf_dir):
    """Language of every document, learned from the four fifths not held out."""
    docs = table(spark, sf_dir, "documents")
    samples = langid.fit(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    found = langid.predict_table(docs.select("doc_id", "text"), samples)
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_exact_dedup(spark, sf_dir):
    """For every document the copy that stays."""
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark, sf_dir):
    """Words left in every document without the repeated 35-word windows."""
    docs = table(spark, sf_dir, "documents")
    return substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_secret_scan(spark, sf_dir):
    """Spans of secrets in every document."""
    docs = table(spark, sf_dir, "documents")
    return secrets.report(secrets.scan(docs, secrets.train(docs)))


def cycled_weights(sources: list) -> dict:
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}


def op9_mix_sources(spark, sf_dir):
    """Words the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    taken, goal, sizes = mix.mix(docs, F.array("source"), cycled_weights, carry=("source",))
    rows = [(s, int(sizes[s]), float(goal[s])) for s in sizes]
    by_source = spark.createDataFrame(rows, "s string, source_size long, target double")
    out = taken.join(F.broadcast(by_source), F.col("source").cast("string").eqNullSafe(F.col("s")), "left")
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_top_inner_products(spark, sf_dir):
    """The five highest integer inner products of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op11_odd_sketch_components(spark, sf_dir):
    """Components of documents whose 2-word shingle sets have Jaccard 0.8 or more."""
    return oddsketch.cluster(table(spark, sf_dir, "documents"), width=2, percent=80)


def op12_whiten_embeddings(spark, sf_dir):
    """The first 32 whitened components of every embedding; deviation is null where it exceeds 64 bits."""
    vectors = table(spark, sf_dir, "embeddings")
    found = whitening.transform(vectors, whitening.fit(vectors, scale=64, offset=1_000_000), k=32)
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_vector_codes(spark, sf_dir):
    """Product codes of every embedding, with the squared error of each row and label."""
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"), scale=4096, parts=8, entries=16, rounds=6)
    out = codes.with_label_errors(coded).withColumn("codebooks_sha256", F.lit(codes.digest(books)))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def pipeline(spark, sf_dir):
    """The corpus pipeline (all stages, without the files between them)."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_extract_text,
        op2_preference_pairs,
        op3_bpe_round_trip,
        op4_jaccard_components,
        op5_language_id,
        op6_exact_dedup,
        op7_substring_dedup,
        op8_secret_scan,
        op9_mix_sources,
        op10_top_inner_products,
        op11_odd_sketch_components,
        op12_whiten_embeddings,
        op13_vector_codes,
        pipeline,
    )
}

SQL = {"op6_exact_dedup": exact_dedup.ORACLE, "op10_top_inner_products": topk.ORACLE}
