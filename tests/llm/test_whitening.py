"""Whitening: against a dense eigensolver and exact whole numbers, hard spectra, odd rows."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import whitening
from ratecraft.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, scale=256):
    """{(row, component): (n, deviation, |whitened|, explained)} by a dense eigensolver and Python's whole numbers."""
    groups = defaultdict(list)
    for k, (_, v) in enumerate(rows):
        if v and all(c is not None and math.isfinite(c) for c in v):
            groups[len(v)].append((k, tuple(math.floor(scale * c) for c in v)))
    out = {}
    for dims, members in groups.items():
        fit = sorted({x for _, x in members})
        n, sums = len(fit), [sum(x[d] for x in fit) for d in range(dims)]
        centred = np.array([[(n * x[d] - sums[d]) / n for d in range(dims)] for x in fit])
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        for k, x in members:
            apart = [n * x[d] - sums[d] for d in range(dims)]
            for c in range(1, min(4, dims) + 1):
                if values[-c] > 1e-13 * values.sum():
                    w = np.array(apart) / n @ vectors[:, -c] / np.sqrt(values[-c])
                    out[k, c] = (n, sum(a * a for a in apart), abs(w), values[-c] / values.sum())
    return out


def checked(df, rows):
    got = df.collect()
    assert all(r.identity_error <= 1e-9 for r in got)
    key = lambda i, c, n, d, w, e: (repr(i), c, n, d, round(w, 5), round(e, 9))
    want = sorted(key(rows[k][0], c, *v) for (k, c), v in brute(rows).items())
    have = sorted(key(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got)
    assert len(have) == len(want)
    for a, b in zip(have, want, strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=2e-5)


def test_query_as_dense_eigensolver(spark):
    rows = [(r.vec_id, [float(c) for c in r.embedding] if r.embedding is not None and None not in r.embedding else None)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    result = QUERIES["op12_whitening"](spark, SF)
    checked(result, rows)
    # one sign per component for all rows
    by = {c: {r.vec_id: r.whitened for r in result.where(F.col("component") == c).collect()} for c in range(1, 5)}
    assert all(abs(np.mean(list(v.values()))) < 0.5 for v in by.values())


def test_inertia_counts_signs():
    rng = np.random.default_rng(2)
    for dims in (1, 2, 3, 7, 40):
        for kind in range(4):
            values = rng.normal(size=dims) * 10.0 ** rng.integers(-6, 6, dims) if kind else np.zeros(dims)
            q, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
            a = q @ np.diag(values) @ q.T if kind < 3 else np.where(np.eye(dims, dtype=bool), 0, rng.normal(size=(dims, dims)))
            a = (a + a.T) / 2
            true = np.linalg.eigvalsh(a)
            if np.abs(true).min() > 1e-9 * np.abs(true).max() or not true.any():
                assert whitening.inertia(a) == ((true > 0).sum(), (true < 0).sum())


@pytest.mark.parametrize("spectrum", [
    np.geomspace(1, 1e-6, 40), np.ones(40), np.r_[np.ones(20), 1e-3 * np.ones(20)], np.r_[5, 4, 3, np.zeros(37)], np.r_[2.0, np.zeros(39)],
    1 + 1e-6 * np.arange(40), np.r_[1.0, 1 - 1e-12, 0.5 * np.ones(38)], np.r_[1e9, 1, 1e-3, 1e-9 * np.ones(37)], np.zeros(40)])
def test_leading_eigenpairs_of_hard_spectra(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(40, 40)))
    a = q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.leading_eigenpairs(a, 4)
    true = np.linalg.eigvalsh(a)[::-1]
    true = true[true > 1e-13 * max(spectrum.sum(), 1e-300)][:4]
    assert len(values) == len(true) and np.allclose(values, true, rtol=1e-12, atol=1e-13 * spectrum.max())
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert np.abs(a @ vectors - vectors * values).max(initial=0) <= 1e-13 * max(spectrum.max(), 1e-300)


def test_odd_rows(spark):
    nan, inf, rng = float("nan"), float("inf"), np.random.default_rng(4)
    near = [(i, rng.normal(size=3).round(2).tolist()) for i in range(1, 60)]
    rows = [(100, None), (101, []), (102, [nan, 1.0, 1.0]), (103, [None, 1.0, 1.0]), (104, [inf, 0.0, 0.0]), (None, [1.0, -0.0, 1.0]), (105, [1.0, 2.0]),
            (106, [3.0, 1.0]), (7, near[0][1]), (107, [1.0]), (108, [0.5]), *near, *near[:5]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("n", "x", "dims", "component", "i")})
    checked(whitening.whiten(df), rows)
    assert whitening.whiten(df.where("false")).count() == 0
    # one distinct vector has no variance
    assert whitening.whiten(df.where("vec_id = 107")).count() == 0


def test_large_offsets_and_whole_numbers(spark):
    """Centred before multiplying: a small spread far from zero; deviations beyond a long are NULL, not an error."""
    rng = np.random.default_rng(6)
    rows = [(i, (4096.0 + rng.normal(size=5)).tolist()) for i in range(300)]
    checked(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)
    far = [(i, [1e300 * (i % 2), float(i)]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect()
    assert len(got) >= 6 and all(r.deviation is None for r in got)
