"""Exact dedup, n-gram Jaccard join and substring dedup against plain versions."""

import random

import numpy as np
import pytest

from daygrain.llm import components, exact_dedup, jaccard, substring, text

from . import brute
from .fixtures import documents, empty, frame, sentence


def known(rows):
    return [(i, t) for i, t, *_ in rows if i is not None]


@pytest.mark.parametrize("salts", [1, 4])
def test_exact_dedup_matches_brute_force(spark, salts):
    rows = documents()
    got = exact_dedup.decisions(frame(spark, rows), salts=salts).where("doc_id is not null").collect()
    assert sorted(map(tuple, got)) == sorted(brute.exact_groups(known(rows)))


def test_exact_dedup_null_id_and_empty_table(spark):
    rows = [(None, "a b", "en", "s"), (None, "ab", "en", "s"), (3, "a b", "en", "s")]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.decisions(frame(spark, rows)).collect()}
    assert got == {(None, 3, 3, False), (3, 3, 3, True)}
    assert exact_dedup.decisions(empty(spark)).count() == 0
    kept = exact_dedup.kept_rows(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and [r.doc_id for r in kept.collect()] == [3]


def test_exact_dedup_runs_no_python(spark):
    plan = exact_dedup.decisions(frame(spark, documents()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_matches_brute_force(spark, width, percent):
    rows = documents()
    want = brute.jaccard_components(dict(known(rows)), width, percent)
    got = jaccard.cluster(frame(spark, rows), width=width, percent=percent).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert len({c for _, c in want.values()}) < len(want) - 20


@pytest.mark.parametrize("long_list", [1, 16])
def test_jaccard_chains_near_the_threshold(spark, monkeypatch, long_list):
    """Drifting copies: neighbours link, ends do not, and pivots alone would miss links."""
    monkeypatch.setattr(jaccard, "LONG_LIST", long_list)
    r = random.Random(9)
    words = sentence(r, 150).split()
    rows = []
    for i in range(60):
        if i % 2:
            words[r.randrange(150)] = f"w{i}"
        rows.append((i * 37 % 101, " ".join(words), "en", "s"))
    rows += [(200 + i, " ".join(sentence(r, 60).split() + words[:12]), "en", "s") for i in range(30)]
    want = brute.jaccard_components(dict(known(rows)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.cluster(frame(spark, rows)).collect()}
    assert got == want


def test_jaccard_large_groups(spark):
    """Groups of one prefix and size: short texts that can link only when equal, and long ones that link."""
    r = random.Random(12)
    rows = [(i, f"common words here w{i}", "en", "s") for i in range(400)]  # two 3-word shingles each
    tail = sentence(r, 60).split()
    for i in range(200):
        words = list(tail)
        words[r.randrange(60)] = f"v{i}"
        rows.append((1000 + i, " ".join(words), "en", "s"))
    for width, percent in ((3, 90), (5, 80)):
        want = brute.jaccard_components(dict(known(rows)), width, percent)
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.cluster(frame(spark, rows), width=width, percent=percent).collect()}
        assert got == want


def test_jaccard_long_lists_only(spark, monkeypatch):
    """Every list goes through pivots and the second round."""
    monkeypatch.setattr(jaccard, "LONG_LIST", 1)
    rows = documents()
    want = brute.jaccard_components(dict(known(rows)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.cluster(frame(spark, known_rows(rows))).collect()}
    assert got == want


def test_jaccard_order_does_not_change_the_result(spark, monkeypatch):
    rows = documents()
    want = sorted(map(tuple, jaccard.cluster(frame(spark, known_rows(rows))).collect()))
    monkeypatch.setattr(jaccard, "frequent", lambda *a, **k: np.sort(np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64)))
    assert sorted(map(tuple, jaccard.cluster(frame(spark, known_rows(rows))).collect())) == want


def known_rows(rows):
    return [r for r in rows if r[0] is not None]


def test_jaccard_empty_table(spark):
    assert jaccard.cluster(empty(spark)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 230)] + [(5, 5)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 100 for i in range(101, 141)} | {i: 7 for i in range(200, 230)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("spread", [1, 3, 1024])
def test_substring_matches_brute_force(spark, spread):
    rows = documents()
    got = substring.remove_repeats(frame(spark, rows), spread=spread).collect()
    assert len(got) == len(rows)
    have = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got if r.doc_id is not None)
    want = sorted(x for x in brute.repeated_words([(i, t) for i, t, *_ in rows]) if x[0] is not None)
    assert have == want
    assert sum(x[2] for x in want) > 5000


def test_substring_periodic_and_short_texts(spark):
    cycle = " ".join(f"w{i}" for i in range(20))
    rows = [(1, " ".join([cycle] * 5), "en", "s"), (2, "a " * 35, "en", "s"), (3, "a " * 34, "en", "s"), (4, "b " * 36, "en", "s")]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring.remove_repeats(frame(spark, rows)).collect()}
    assert got == {1: (100, 100), 2: (35, 0), 3: (34, 0), 4: (36, 36)}
    assert substring.remove_repeats(empty(spark)).count() == 0


def test_windows_under_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring, "gram_hashes", lambda h, w: np.zeros(max(0, len(h) - w + 1), np.uint64))
    one = b" ".join(b"a%d" % i for i in range(36))
    two = b" ".join(b"a%d" % i for i in range(1, 37))
    marks = substring.repeated_windows([one, two], np.array([1, 1]), 35)
    assert [m.tolist() for m in marks] == [[1, 2], [0, 1]]


def test_bit_filter_has_no_false_negatives(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63, 500)
    df = spark.createDataFrame([(int(v),) for v in values], "h long")
    made = text.bit_filter(df, "h", 16)
    assert made.test(values.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(-(2**63), 2**63, 5000)
    assert made.test(other.view(np.uint64)).mean() < 0.05
    assert not text.bit_filter(df.limit(0), "h", 16).test(values.view(np.uint64)).any()


@pytest.mark.parametrize("k", [1, 7, 500])
def test_first_by_hash_equals_a_plain_sort(spark, k):
    r = random.Random(5)
    rows = [("a", r.getrandbits(64) - (1 << 63), i) for i in range(3000)]
    rows += [("b", 1 << 62, i) for i in range(900)]  # one hash for all: the bound widens
    rows += [("c", -(1 << 63), 0), ("c", (1 << 63) - 1, 1)]
    got = text.first_by_hash(spark.createDataFrame(rows, "grp string, h long, id long").repartition(7), k)
    want = [(g, h, i, n + 1) for x in "abc" for n, (g, h, i) in enumerate(sorted(y for y in rows if y[0] == x)[:k])]
    assert sorted(tuple(x) for x in got) == sorted(want)


def test_first_by_hash_of_nothing(spark):
    assert text.first_by_hash(spark.createDataFrame([], "grp string, h long"), 3) == []
