"""Embedding whitening and vector codes against plain versions."""

import math
import random

import numpy as np
import pytest

from daygrain.llm import codes, queries, vectors, whitening

from . import brute

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v double, n long, code string, error long, component int, part int"


def table(spark, rows, partitions=3):
    """(vec_id, embedding, label) and extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, lab, 7, 7.0, 7, "x", 7, 7, 7) for i, v, lab in rows], SCHEMA).repartition(partitions)


def samples(seed=5, count=300, dims=24):
    """Clustered float vectors with repeats, ties, unusable rows and rows without id."""
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.4, (12, dims))
    rows = []
    for i in range(count):
        v = (centres[i % 12] + r.normal(0, 0.05, dims)).astype(np.float32).tolist()
        rows.append((i * 7 % 1009, v, i % 5 if i % 3 else None))
    rows += [(2000, rows[0][1], 1), (2000, rows[0][1], 1), (2001, [0.0] * dims, 2), (2002, [0.0] * dims, 2), (None, rows[5][1], 3)]
    bad = [(3000, None, 1), (3001, [*rows[0][1][:-1], math.nan], 1), (3002, [*rows[0][1][:-1], math.inf], 1), (3003, [None, *rows[0][1][1:]], 1)]
    return rows, bad


def test_covariances_are_exact(spark):
    rows, bad = samples(dims=9)
    model = whitening.fit(table(spark, rows + bad))
    n, _, cov, _ = brute.whitened([v for _, v, _ in rows], 9)
    assert model.n == n
    assert model.covariance.tolist() == [[float(x) for x in line] for line in cov]


def test_covariances_of_wide_entries_are_exact():
    """Squares beyond 64 bits: the same sums in Python integers."""
    r = random.Random(1)
    z = np.array([[r.randrange(-(1 << 45), 1 << 45) for _ in range(4)] for _ in range(50)])
    found = whitening.square_sums(z)
    plain = [sum((int(x[i]) + (int(x[j]) if i != j else 0)) ** 2 for x in z) for i in range(4) for j in range(i, 4)]
    assert found.tolist() == plain


@pytest.mark.parametrize("k", [5, 32])
def test_whitening_matches_brute_force(spark, k):
    rows, bad = samples()
    data = table(spark, rows + bad)
    model = whitening.fit(data)
    got = whitening.transform(data, model, k=k).collect()
    n, deviations, cov, centred = brute.whitened([v for _, v, _ in rows], k)
    k = min(k, 24)
    assert len(got) == len(rows) * k
    assert {(r.vec_id, int(r.deviation)) for r in got} == {(i, d) for (i, _, _), d in zip(rows, deviations, strict=True)}
    v = np.array([[float(x) for x in line] for line in cov])
    values, components = np.linalg.eigh(v)
    values, components = values[::-1], components[:, ::-1]
    want = np.array([[float(x) for x in line] for line in centred]) @ components[:, :k] / np.sqrt(values[:k])
    by_id = {(r.vec_id, r.component): r for r in got}
    for c in range(k):
        plain = want[:, c]
        mine = np.array([by_id[i, c + 1].whitened for i, _, _ in rows])
        assert min(np.abs(mine - plain).max(), np.abs(mine + plain).max()) < 1e-9
        assert abs(by_id[0, c + 1].explained - values[c] / np.trace(v)) < 1e-12
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9


def test_whitening_of_degenerate_tables(spark):
    assert whitening.transform(table(spark, []), whitening.fit(table(spark, []))).count() == 0
    one = table(spark, [(1, [0.5, 0.25], 0)])
    assert whitening.transform(one, whitening.fit(one)).count() == 0
    # a constant and a repeated dimension, a shorter and an empty vector: rank 1 and 2
    flat = table(spark, [(i, [1.0, i / 8, i / 8], 0) for i in range(8)])
    got = whitening.transform(flat, whitening.fit(flat)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1) and got[0].identity_error < 1e-9
    ragged = [(1, [0.5, 1.0], 0), (2, [0.25], 0), (3, [], 0), (4, [2.0, -1.0], 0)]
    got = whitening.transform(table(spark, ragged), whitening.fit(table(spark, ragged))).collect()
    padded = [[*v, 0.0, 0.0][:2] for _, v, _ in ragged]
    assert {(r.vec_id, int(r.deviation)) for r in got} == {(i + 1, d) for i, d in enumerate(brute.whitened(padded, 2)[1])}
    assert len(got) == 8


def test_deviation_beyond_64_bits_is_exact():
    z = np.array([[1 << 20, -(1 << 20)]])
    model = whitening.Whitening(64, 0, 1 << 40, np.zeros(2, np.int64), (3, 5), np.eye(2), np.ones(2), np.eye(2))
    want = (model.n * (1 << 20) - 3) ** 2 + (-model.n * (1 << 20) - 5) ** 2
    assert model.deviations(z).tolist() == [want] and want > 1 << 63
    assert [int(x) for x in vectors.decimals(model.deviations(z)).to_pylist()] == [want]


def test_whitening_query_covers_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op12_whiten_embeddings(spark, sf_dir).toPandas()
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert len(got) == 32 * len(data) and got["identity_error"].max() <= 1e-4
    x = np.floor(64 * np.array([v for _, v in data])).astype(np.int64) + 1_000_000
    deviations = dict(zip([i for i, _ in data], (((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)).tolist(), strict=True))
    assert (got["deviation"] == got["vec_id"].map(deviations)).all()
    assert got.dtypes["deviation"] == "int64" and got.dtypes["n"] == "int64"


@pytest.mark.parametrize(("block", "leaf"), [(64, 4), (2048, 32)])
def test_codes_match_brute_force(spark, block, leaf):
    rows, bad = samples()
    coded, books = codes.compress(table(spark, rows + bad), block=block, leaf=leaf)
    got = codes.with_label_errors(coded).collect()
    want, digest = brute.product_codes(rows)
    assert sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error) for r in got) == sorted((i is None, i or 0, c, e) for i, c, e in want)
    assert codes.digest(books) == digest
    totals: dict = {}
    for (_, _, label), (_, _, e) in zip(rows, want, strict=True):
        totals[label] = totals.get(label, 0) + e
    assert {(r.label, r.label_error) for r in got} == set(totals.items())


def test_codes_of_small_ragged_and_empty_tables(spark):
    coded, books = codes.compress(table(spark, []))
    assert codes.with_label_errors(coded).count() == 0 and len(books) == 8
    rows = [(5, [0.5, 1.0, -0.25], 1), (2, [0.25], None), (3, [], 1), (4, [2.0, -1.0], None), (None, [9.0], 1)]
    coded, books = codes.compress(table(spark, rows))
    want, digest = brute.product_codes(rows)
    assert sorted((r.vec_id or 0, r.code, r.error) for r in coded.collect()) == sorted((i or 0, c, e) for i, c, e in want)
    assert codes.digest(books) == digest


def test_walk_equals_a_plain_scan_and_owns_balls():
    """Integer ties, repeated entries and far clusters: the trees decide as a scan does, most points without one."""
    r = np.random.default_rng(3)
    points = np.concatenate([r.integers(-6, 7, (500, 3)), r.integers(-6, 7, (500, 3)) + 1000, np.zeros((40, 3), np.int64)])
    order, nodes = codes.grow(points, 8)
    assert sorted(order.tolist()) == list(range(len(points)))
    entries = np.array([[0, 0, 0], [0, 0, 0], [1000, 1000, 1000], [2, 0, 0], [-2, 0, 0], [1003, 1000, 1000]])
    sums, counts, owner, compared = codes.walk(nodes, points[order], entries)
    plain = ((points[order][:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert owner.tolist() == plain.tolist()
    assert counts.tolist() == np.bincount(plain, minlength=6).tolist()
    assert sums.tolist() == [points[order][plain == k].sum(axis=0).tolist() for k in range(6)]
    two = codes.walk(nodes, points[order], entries[[0, 2]])
    assert two[3] == 0 and two[1].tolist() == [540, 500]


def test_every_ball_holds_its_points():
    points = np.random.default_rng(4).integers(-4000, 4000, (700, 8))
    order, nodes = codes.grow(points, 16)
    ordered = points[order]
    for x in nodes:
        held = ordered[x["start"] : x["stop"]]
        assert x["sum"].tolist() == held.sum(axis=0).tolist()
        mean = held.mean(axis=0)
        assert np.sqrt(((held - mean) ** 2).sum(axis=1)).max() <= x["radius"] + 1e-6
        if x["left"] >= 0:
            a, b = nodes[x["left"]], nodes[x["right"]]
            assert (a["start"], a["stop"], b["stop"]) == (x["start"], b["start"], x["stop"])
        else:
            assert len(held) <= 16


def test_codes_of_wide_components(spark):
    """Distances beyond 64 bits are compared in Python integers."""
    points = np.array([[1 << 40, 0], [-(1 << 40), 1], [(1 << 40) - 3, 5], [0, 0]])
    order, nodes = codes.grow(points, 2)
    entries = np.array([[1 << 40, 1], [-(1 << 40), 0], [1, 1]])
    owner = codes.walk(nodes, points[order], entries)[2]
    assert dict(zip(order.tolist(), owner.tolist(), strict=True)) == {0: 0, 1: 1, 2: 0, 3: 2}
    with pytest.raises(ValueError, match="62 bits"):
        vectors.scaled(np.array([1e30]), 64)
