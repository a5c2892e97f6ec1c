"""Secret scans: base patterns, and character Markov models for what they miss.

Main path in SQL expressions only.  ``matches`` finds the spans of a pattern
from two native calls: ``regexp_extract_all`` gives the matches and ``split``
the gaps between them; running lengths give code point positions.

The Markov part has two first-order character models over ``ALPHABET``, one
of random strings and one of ordinary identifiers.  A token of 16 or more
characters is added as a span when its mean log-likelihood ratio per step
exceeds ``threshold`` and it is not made of digits alone (an account number
is not a secret of this kind) nor overlaps a base span.  The models are trained on a
sample of labelled strings: values that the base patterns find are random,
other identifiers are ordinary.  Bound of the sample (parameter):
``sample_docs`` documents, the first in hash order.  The trained table has
``len(ALPHABET) ** 2`` numbers whatever the corpus holds; unseen steps are
smoothed, so without any sample both models are uniform and nothing is added.

Defined cases: null text counts as empty and gets no spans; kinds may overlap
each other; repeated rows are scanned each on their own; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import first_by_hash

# The base kinds in the order they are reported, their patterns
# and the least length (of group 2 for assign, else of the match).
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
TOKEN = "[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = "[A-Za-z][A-Za-z0-9_-]{5,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_K = len(ALPHABET)
_SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda ch: F.instr(F.lit(ALPHABET), ch))


def _steps(token: Column) -> Column:
    """Codes of the steps of a token: (from - 1) * K + to, one-based."""
    codes = _codes(token)
    n = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: (a - 1) * _K + b)


def score(token: Column, table: Column) -> Column:
    """Mean log-likelihood ratio per step, random against ordinary."""
    steps = _steps(token)
    total = F.aggregate(steps, F.lit(0.0), lambda acc, s: acc + F.element_at(table, s))
    return total / F.greatest(F.size(steps), F.lit(1))


def matches(text: Column, found: Column, pattern: str, kind: str, ordinal: int, good, values: Column | None = None) -> Column:
    """Spans of those matches for which ``good(value)`` holds; ``found`` are the whole matches.

    ``values`` are what ``good`` looks at (the matches themselves by default).
    One pass over (gap, match, value) triples keeps the running position.
    """
    values = found if values is None else values
    triples = F.zip_with(F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(g.alias("g"), m.alias("m"))), values, lambda x, v: F.struct(x["g"].alias("g"), x["m"].alias("m"), v.alias("v")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc, x):
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        span = F.array(F.struct(start.alias("start"), F.lit(ordinal).alias("ord"), end.alias("end"), F.lit(kind).alias("kind")))
        keep = x["m"].isNotNull() & good(x["v"])
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(triples, zero, step, lambda acc: acc["spans"])
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(_SPAN))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 8192, smoothing: float = 0.5) -> list[float]:
    """The table of log-likelihood ratios per step, from a bounded sample of labelled strings."""
    h = F.xxhash64(F.lit(8), F.col(id_col))
    first = first_by_hash(docs.select(F.lit(0).alias("grp"), h.alias("h")), sample_docs)
    if not first:
        return [0.0] * (_K * _K)
    sample = docs.where(h <= max(r["h"] for r in first)).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Ordinary identifiers are what remains when the base matches are taken out.
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    values = F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 12)
    random = F.concat(values, F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    kinds = F.array(
        F.struct(F.lit(1).alias("random"), random.alias("tokens")),
        F.struct(F.lit(0).alias("random"), F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0)).alias("tokens")),
    )
    labelled = sample.select(F.explode(kinds).alias("k")).select("k.random", F.explode("k.tokens").alias("token"))
    seen = labelled.groupBy("random", "token").agg(F.count(F.lit(1)).alias("times"))
    steps = seen.select("random", "times", F.explode(_steps(F.col("token"))).alias("step")).groupBy("random", "step").agg(F.sum("times").alias("n"))
    counts = np.full((2, _K, _K), smoothing)
    for r in steps.collect():  # at most 2 * K * K rows
        counts[r["random"], (r["step"] - 1) // _K, (r["step"] - 1) % _K] += r["n"]
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    return (logs[1] - logs[0]).ravel().round(6).tolist()


def scan(docs: DataFrame, table: list[float], id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.4) -> DataFrame:
    """One row per document: id, base (spans by start, then kind), added (spans of the models)."""
    ratios = F.from_json(F.lit(json.dumps(table)), "array<double>")
    text = F.col("text")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    for name, pattern in (("assigns", ASSIGN), ("accesses", ACCESS), ("hexes", HEX), ("tokens", TOKEN)):
        rows = rows.withColumn(name, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    values = F.when(F.size("assigns") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)))
    rows = rows.withColumn("assigned", values)
    always = lambda v: F.lit(True)
    odd = lambda v: v.rlike("[A-Za-z]") & (score(v, ratios) > threshold)
    base = F.array_sort(
        F.concat(
            matches(text, F.col("assigns"), ASSIGN, "assign", 0, lambda v: F.length(v) >= 12, F.col("assigned")),
            matches(text, F.col("accesses"), ACCESS, "access", 1, always),
            matches(text, F.col("hexes"), HEX, "hex", 2, always),
        )
    )
    rows = rows.select("id", base.alias("base"), matches(text, F.col("tokens"), TOKEN, "markov", 3, odd).alias("odd"))
    free = lambda m: ~F.exists("base", lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"]))
    return rows.select(F.col("id").alias(id_col), "base", F.filter("odd", free).alias("added"))


def joined(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans and all spans of ``scan``'s rows."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_col,
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
