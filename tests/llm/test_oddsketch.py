"""MinHash near-dedup with odd sketches against plain versions."""

import random

import numpy as np
import pytest

from daygrain.llm import oddsketch, queries

from . import brute
from .fixtures import documents, empty, frame, sentence


def known(rows):
    return [(i, t) for i, t, *_ in rows if i is not None]


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


@pytest.mark.parametrize(("width", "percent"), [(2, 80), (5, 80), (3, 90)])
def test_matches_brute_force(spark, width, percent):
    rows = documents()
    want = brute.jaccard_components(dict(known(rows)), width, percent)
    got = oddsketch.cluster(frame(spark, rows), width=width, percent=percent).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert len({c for _, c in want.values()}) < len(want) - 20


@pytest.mark.parametrize(("long_list", "block"), [(1, 3), (2, 1000), (16, 2048)])
def test_long_lists_lose_no_link(spark, long_list, block):
    """Drifting copies and groups under common keys: the least class alone would miss links."""
    r = random.Random(9)
    words = sentence(r, 150).split()
    rows = []
    for i in range(60):
        if i % 2:
            words[r.randrange(150)] = f"w{i}"
        rows.append((i * 37 % 101, " ".join(words), "en", "s"))
    shared = sentence(r, 80).split()
    for i in range(30):  # pairwise about 0.6, so under common keys, and each with a near copy
        own = sentence(r, 25).split()
        rows.append((200 + i, " ".join(shared + own), "en", "s"))
        rows.append((300 + i, " ".join(shared + own[:-2]), "en", "s"))
    want = brute.jaccard_components(dict(known(rows)), 2, 80)
    got = result(oddsketch.cluster(frame(spark, rows), width=2, long_list=long_list, block=block))
    assert got == want
    assert len({c for _, c in want.values()}) > 20


def test_ids_on_several_texts_and_empty_table(spark):
    r = random.Random(2)
    a, b = sentence(r, 40), sentence(r, 40)
    rows = [(1, a, "en", "s"), (2, a, "en", "s"), (2, b, "en", "s"), (2, b, "en", "s"), (None, a, "en", "s")]
    got = sorted((x.doc_id or 0, x.component_id or 0, x.kept) for x in oddsketch.cluster(frame(spark, rows)).collect())
    assert got == [(0, 0, True), (1, 1, True), (2, 1, False), (2, 2, True), (2, 2, True)]
    assert oddsketch.cluster(empty(spark)).count() == 0


def test_minhashes_equal_a_plain_minimum():
    r = np.random.default_rng(1)
    sets = [np.sort(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 5, 0, 300, 1 << 18, 2)]
    got = oddsketch.minhashes(sets, 6)
    factors, offsets = oddsketch._factors(6)
    for s, row in zip(sets, got, strict=True):
        if len(s):
            assert row.tolist() == [int(((s ^ o) * f).min()) for f, o in zip(factors, offsets, strict=True)]
        else:
            assert set(row.tolist()) == {2**64 - 1}


@pytest.mark.parametrize("target", [0.8, 0.9, 0.97])
def test_odd_sketches_estimate_high_similarities(target):
    r = np.random.default_rng(7)
    errors, above = [], 0
    most = oddsketch.most_differing(128, 80)
    for _ in range(150):
        common = int(600 * target)
        x = r.integers(0, 2**63, 600 * 2 - common).astype(np.uint64)
        a, b = np.sort(x[:600]), np.sort(np.concatenate([x[:common], x[600:]]))
        true = common / len(x)
        sketches = oddsketch.odd_sketches(oddsketch.minhashes([a, b], 128))
        differing = int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())
        errors.append(float(oddsketch.similarity(differing, 128)) - true)
        above += differing > most
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 1.3 * np.sqrt(0.25 * 0.75 / 128)
    assert target < 0.89 or above == 0


def test_bound_of_differing_bits():
    assert oddsketch.most_differing(128, 100) == 0
    assert 80 < oddsketch.most_differing(128, 80) < 130
    assert oddsketch.most_differing(128, 0) == 256


def test_bands_rarely_miss():
    """Pairs at 0.8 and a little above share a key: 2,000 pairs, none missed."""
    r = np.random.default_rng(8)
    sets = []
    for _ in range(2000):
        x = r.integers(0, 2**63, 45).astype(np.uint64)
        sets += [np.sort(x[:40]), np.sort(np.concatenate([x[:36], x[40:]]))]  # 36 of 45
    keys = oddsketch.minhashes(sets, 128).reshape(len(sets), 32, 4)
    same = (keys[0::2] == keys[1::2]).all(axis=2).any(axis=1)
    assert same.all()


def test_query_matches_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert result(queries.op11_odd_sketch_components(spark, sf_dir)) == brute.jaccard_components(docs, 2, 80)


def test_set_sketches_never_differ_in_more_bits_than_sets_in_elements():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 400, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in r.integers(0, 900, 40)]
    bits = oddsketch.set_sketches(sets)
    for a, x in zip(sets, bits, strict=True):
        for b, y in zip(sets, bits, strict=True):
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
