"""The corpus pipeline against plain stages, and the entry's guard."""

import base64
import hashlib
import random
import subprocess
import sys
from collections import Counter

import pytest
import public_tokenizers
import tiktoken

import corpus_pipeline
from daygrain.llm import langid, queries
from daygrain.llm.text import numbered, write_read

from . import brute
from .fixtures import documents, frame, sentence


def test_stages_on_the_awkward_table(spark):
    docs = frame(spark, documents())
    names, kept = docs.columns, docs
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        kept = write_read(stage(spark, kept, "/none"), f"test-{name}")
        counts.append(kept.count())
        if name != "bpe_tokens":
            assert kept.columns == names
    assert counts[0] == len(documents()) - 4  # null, empty, white space, no letter
    assert counts[0] > counts[1] > counts[2]
    assert kept.columns == ["doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/none")
        assert docs.count() == 0


def test_pipeline_matches_plain_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    first = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    exact = {i for i, _, _, kept, _ in brute.exact_groups([(r[0], r[1]) for r in first]) if kept}
    second = [r for r in first if r[0] in exact]
    near = brute.jaccard_components({r[0]: r[1] for r in second}, 5, 80)
    third = {r[0]: r for r in second if near[r[0]][1] == r[0]}
    assert len(rows) > len(second) > len(third)

    got = corpus_pipeline.run(spark, sf_dir).collect()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(queries.RANKS), "rb"))}
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words, taken = {}, {}
    for r in third.values():
        words[r[3]] = words.get(r[3], 0) + len(brute.words(r[1]))
    goal = brute.mix_targets(words, queries.cycled_weights(list(words)))
    copies = {}
    for x in got:
        row = third[x.doc_id]
        ids = enc.encode_ordinary(row[1])
        assert x.ids == ids and x.n_tokens == len(ids) and x.decoded_sha256 == hashlib.sha256(row[1].encode()).hexdigest()
        copies[x.doc_id] = copies.get(x.doc_id, 0) + 1
        taken[row[3]] = taken.get(row[3], 0) + len(brute.words(row[1]))
    assert max(copies.values()) <= 2
    for s, target in goal.items():
        assert taken[s] == pytest.approx(target, rel=0.03)


def test_registered_queries_and_guard(spark, tmp_path):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.SQL) <= set(entry.oracle_sql())
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert not any(q.startswith('op') and q[2].isdigit() or q == 'pipeline' for q in e.queries()); assert e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rsplit("/", 1)[0])


def test_oracle_sql_of_native_queries(spark):
    import duckdb

    con = duckdb.connect()
    sf_dir = "/root/testdata/sf0.001"
    for name in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in queries.SQL.items():
        have = queries.QUERIES[name](spark, sf_dir)
        want = con.sql(sql)
        assert sorted(have.columns) == sorted(want.columns)
        order = sorted(have.columns)
        assert sorted(tuple(r[c] for c in order) for r in have.collect()) == sorted(con.sql(f"SELECT {', '.join(order)} FROM ({sql})").fetchall())


def test_language_stage_rejects_only_texts_without_letters(spark):
    docs = frame(spark, documents())
    kept = corpus_pipeline.identify_language(spark, docs, "/none")
    gone = {r.doc_id for r in docs.select("doc_id").subtract(kept.select("doc_id")).collect()}
    assert gone == {90, 91, 92, 98}
    assert langid.UND == "und"


def test_mix_stage_keeps_null_and_shared_ids(spark):
    r = random.Random(8)
    rows = [(None, sentence(r, r.randint(20, 40)), "en", "a") for _ in range(80)]
    rows += [(i % 40, sentence(r, r.randint(20, 40)), "en", s) for s in "bc" for i in range(80)]
    got = corpus_pipeline.mix_sources(spark, frame(spark, rows), "/none")
    assert got.columns == frame(spark, rows).columns
    copies = Counter((x.doc_id, x.text, x.lang, x.source) for x in got.collect())
    assert set(copies) <= set(rows) and max(copies.values()) == 2
    words, taken = Counter(), Counter()
    for row in rows:
        words[row[3]] += len(brute.words(row[1]))
        taken[row[3]] += copies[row] * len(brute.words(row[1]))
    for s, target in brute.mix_targets(dict(words), queries.cycled_weights(list(words))).items():
        assert abs(taken[s] - target) <= 20


@pytest.mark.parametrize("lang", [None, langid.UND])
def test_language_stage_without_labels_and_with_the_label_und(spark, lang):
    docs = frame(spark, [(i, t, lang, s) for i, t, _, s in documents()])
    kept = corpus_pipeline.identify_language(spark, docs, "/none")
    assert kept.count() == docs.count() - 4
    assert {90, 91, 92, 98}.isdisjoint(r.doc_id for r in kept.collect())


def test_duplicate_stages_keep_one_of_repeated_rows_and_shared_ids(spark, tmp_path):
    r = random.Random(9)
    base = [sentence(r, 60) for _ in range(4)]
    near = [t + " edited" for t in base]
    rows = [(1, base[0], "en", "a")] * 3  # a shard loaded three times
    rows += [(None, base[1], "en", "a")] * 2 + [(None, near[1], "en", "a")]
    rows += [(2, base[2], "en", "a"), (5, near[2], "en", "b"), (5, base[3], "en", "b")]  # one id, two texts
    want = [[base[0]], [base[1], near[1]], [base[2]], [base[3]]]

    def check(docs):
        first = write_read(corpus_pipeline.drop_exact_copies(spark, docs, "/none"), "test-exact")
        assert sorted(x.text for x in first.collect()) == sorted({t for _, t, _, _ in rows})
        left = Counter(x.text for x in corpus_pipeline.drop_near_copies(spark, first, "/none").collect())
        assert sum(left.values()) == len(want) and all(sum(left[t] for t in some) == 1 for some in want)

    check(frame(spark, rows))
    path = str(tmp_path / "docs")
    frame(spark, rows).write.parquet(path)
    check(spark.read.parquet(path))
    check(spark.read.parquet(path, path))


def test_numbers_are_their_rows_own(spark, tmp_path):
    path = str(tmp_path / "a b%20c")
    frame(spark, documents()).write.parquet(path)
    plain = spark.read.parquet(path)
    for docs in (plain, spark.read.parquet(path, path), plain.union(plain), plain.limit(0)):
        got = numbered(docs, "no")
        assert got.columns == [*docs.columns, "no"]
        assert got.select("no").distinct().count() == got.count() == docs.count()


def test_language_stage_predicts_with_the_fitted_model(spark):
    r = random.Random(12)
    greek = lambda n: " ".join("".join(r.choice("αβγδεζηθ") for _ in range(5)) for _ in range(n))
    rows = [(i, sentence(r, 30), "en", "a") for i in range(60)] + [(100 + i, greek(30), "el", "a") for i in range(60)]
    rows += [(300, sentence(r, 30), None, "a"), (301, greek(30), None, "a"), (None, greek(30), None, "a"), (302, "12 34", None, "a")]
    rows += [(303, greek(30), "en", "a")]  # a label that is there stays
    docs = frame(spark, rows)
    got = corpus_pipeline.identify_language(spark, docs, "/none")
    assert got.columns == docs.columns
    want = [(i, t, lang or ("el" if set(t) & set("αβγδ") else "en"), s) for i, t, lang, s in rows if i != 302]
    assert Counter((x.doc_id, x.text, x.lang, x.source) for x in got.collect()) == Counter(want)
