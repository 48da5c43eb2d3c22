"""Whitening against numpy on whole tables, and single updates against dense matrices."""

import math

import numpy as np
import pytest

from tests.llm.helpers import collected
from tillmetrics.llm import whitening
from tillmetrics.llm.common import QUERIES, table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, n string, component string, mean double"


def whole_numbers(vectors):
    return np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000


def check(got, ids, vectors):
    """Rows against a plain fit, up to the sign of each component."""
    x = whole_numbers(vectors)
    n, d = x.shape
    centred = x - x.sum(axis=0) / n
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    many = min(8, d)
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, x.sum(axis=0).tolist())) for row in x.tolist()]
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, c) for i in ids for c in range(1, many + 1))
    assert {r.n for r in got} == {n}
    at = {i: k for k, i in enumerate(ids)}
    real = [c for c in range(many) if values[c] > d * 2.3e-16 * values[0]]
    assert all(r.deviation == deviations[at[r.vec_id]] for r in got)
    white = np.full((n, many), np.nan)
    for r in got:
        white[at[r.vec_id], r.component - 1] = math.nan if r.whitened is None else r.whitened
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9, abs_tol=1e-13)
    plain = centred @ basis[:, :many][:, real] / np.sqrt(values[real])
    signs = np.sign((white[:, real] * plain).sum(axis=0))
    assert np.abs(white[:, real] - plain * signs).max() < 1e-7
    assert all(c in real or np.isnan(white[:, c]).all() for c in range(many))
    identity = white[:, real].T @ white[:, real] / n - np.outer(white[:, real].mean(axis=0), white[:, real].mean(axis=0))
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and abs(errors.pop() - np.abs(identity - np.eye(len(real))).max()) < 1e-9


def made(kind):
    rng = np.random.default_rng(3)
    return {
        "plain": rng.normal(size=(300, 12)),
        "few rows": rng.normal(size=(6, 12)),
        "copies": np.repeat(rng.normal(size=(4, 6)), 40, axis=0),
        "flat": rng.normal(size=(100, 6)) * [1, 1, 1, 0, 0, 0],
        "scales": rng.normal(size=(200, 10)) * 10.0 ** np.arange(10),
        "one hot": np.eye(8)[rng.integers(0, 8, 200)],
        "one line": np.outer(rng.normal(size=80), np.ones(5)),
        "one dimension": rng.normal(size=(30, 1)),
    }[kind]


@pytest.mark.parametrize("kind", ["plain", "few rows", "copies", "flat", "scales", "one hot", "one line", "one dimension"])
def test_updates_equal_the_dense_scatter(kind):
    x = whole_numbers(made(kind))
    whole, parts = whitening.Spectrum(x.shape[1]), [whitening.Spectrum(x.shape[1]) for _ in range(3)]
    for k, row in enumerate(x):
        whole.add(row)
        parts[k % 3].add(row)
    for other in parts[1:]:
        parts[0].combine(other)
    twice = whitening.Spectrum(x.shape[1])
    for row, copies in zip(*np.unique(x, axis=0, return_counts=True)):
        twice.add(row, int(copies))
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    for s in (whole, parts[0], twice):
        assert s.n == len(x) and (s.sums == x.sum(axis=0)).all()
        assert np.abs(s.vectors * s.values @ s.vectors.T - scatter).max() <= 1e-12 * np.abs(scatter).max()
        assert np.abs(s.vectors.T @ s.vectors - np.eye(len(s.values))).max() < 1e-12


@pytest.mark.parametrize("kind", ["plain", "copies", "flat", "one dimension"])
def test_whitening_equals_a_plain_fit(spark, kind):
    vectors = made(kind)
    rows = spark.createDataFrame([(k, v.tolist(), 1, "x", "y", 0.5) for k, v in enumerate(vectors)], SCHEMA).repartition(11)
    check(whitening.whiten(rows).collect(), list(range(len(vectors))), vectors)


def test_awkward_vectors(spark):
    good = made("plain")[:40].tolist()
    bad = [None, [], [1.0], [None] * 12, [math.nan] + [0.0] * 11, [math.inf] + [0.0] * 11, [0.0] * 13]
    ids = list(range(39)) + [None]
    rows = [(i, v, 0, None, None, None) for i, v in [*zip(ids, good), *((100 + k, v) for k, v in enumerate(bad))]]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id for r in got} == set(ids) and len(got) == 8 * 40 and {r.n for r in got} == {40}

    twice = spark.createDataFrame([(1, v, 0, None, None, None) for v in good[:3]], SCHEMA)
    assert whitening.whiten(twice).count() == 24
    alone = whitening.whiten(twice.limit(1)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 0, None, None, None)] * 8
    assert collected(whitening.whiten(twice.limit(0))) == []
    assert collected(whitening.whiten(twice.withColumn("embedding", twice.embedding.cast("array<float>")).where("false"))) == []
    large = spark.createDataFrame([(1, [1e6], 0, None, None, None), (2, [-2e6], 0, None, None, None)], SCHEMA)
    assert {r.deviation for r in whitening.whiten(large).collect()} == {None if (3072 * 10**6) ** 2 >= 1 << 63 else (3072 * 10**6) ** 2}


def test_query_equals_a_plain_fit(spark):
    rows = table(spark, SF, "embeddings").collect()
    check(QUERIES["op13_whitening"](spark, SF).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])
