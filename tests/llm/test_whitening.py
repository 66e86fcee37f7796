"""Whitening: rank-one updates, combined spectra, and the query against a whole eigendecomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import awkward_vectors
from regua.llm import whitening
from regua.llm.queries import QUERIES


def scatter(x):
    off = x - x.mean(0)
    return off.T @ off


def holds(spectrum, x):
    expected = scatter(x.astype(float))
    size = max(1.0, np.abs(expected).max())
    v = spectrum.vectors
    assert np.abs(v.T @ v - np.eye(len(v))).max() < 1e-12
    assert np.abs(v @ np.diag(spectrum.values) @ v.T - expected).max() < 1e-11 * size
    assert (np.diff(spectrum.values) >= 0).all()


@pytest.mark.parametrize("kind", ["full", "low rank", "constant columns", "equal rows", "one column", "wide scales"])
def test_updates_and_merges_equal_a_whole_decomposition(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 40, (120, 9)).astype(np.int64)
    if kind == "low rank":
        x = rng.integers(-5, 6, (120, 2)) @ rng.integers(-9, 10, (2, 9))
    elif kind == "constant columns":
        x[:, [0, 4]], x[:, 7] = 3, x[:, 8]
    elif kind == "equal rows":
        x[:] = x[0]
    elif kind == "one column":
        x = x[:, :1]
    elif kind == "wide scales":
        x = x * 10 ** np.arange(9)
    parts = []
    for rows in (x[:50], x[50:51], x[51:51], x[51:]):
        parts.append(whitening.Spectrum(x.shape[1]))
        parts[-1].add(rows)
        if len(rows):
            holds(parts[-1], rows)
    whole = whitening.Spectrum(x.shape[1])
    for part in parts:
        whole.merge(part)
    holds(whole, x)
    assert whole.n == 120 and whole.sums == x.sum(0).tolist()


def test_roots_lie_between_poles():
    rng = np.random.default_rng(1)
    for _ in range(50):
        d = np.sort(rng.normal(0, 1, 12)).cumsum()
        d = np.sort(d + np.arange(12) * 1e-3)
        z = rng.normal(0, 1, 12) * 10.0 ** rng.integers(-6, 1, 12)
        rho = 10.0 ** rng.integers(-3, 4)
        roots, gap = whitening.secular_roots(d, z, rho)
        assert (roots >= d).all() and (roots[:-1] <= d[1:]).all() and (gap != 0).all()
        np.testing.assert_allclose(roots, np.linalg.eigvalsh(np.diag(d) + rho * np.outer(z, z)), atol=1e-9 * (1 + rho * z @ z))


def brute(vectors, k=4):
    usable = [
        (v, [math.floor(256 * float(np.float32(c))) for c in e])
        for v, e in vectors
        if e and all(c is not None and math.isfinite(c) for c in e) and len(e) == 6
    ]
    fit = np.array(sorted({tuple(x) for _, x in usable}), float)
    n, s = len(fit), [int(t) for t in fit.sum(0)]
    values, parts = np.linalg.eigh(scatter(fit) / n)
    values, parts = values[::-1], parts[:, ::-1]
    rows = []
    for v, x in usable:
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, s))
        for j in range(k):
            y = (np.array(x) - np.array(s) / n) @ parts[:, j] / math.sqrt(values[j])
            rows.append((v, j + 1, n, deviation, y, values[j] / values.sum()))
    return rows


@pytest.mark.parametrize("rows", [whitening.ROWS, 7])
def test_against_a_whole_decomposition(spark, awkward, rows):
    df = spark.read.parquet(f"{awkward[0]}/embeddings.parquet")
    found = whitening.whiten(df, rows=rows).collect()
    expected = brute(awkward_vectors())
    sign = {j: 1.0 for j in range(1, 5)}
    key = lambda r: (repr(r[0]), r[1], r[3])
    found, expected = sorted(found, key=key), sorted(expected, key=key)
    for ours, theirs in zip(found, expected, strict=True):
        if abs(theirs[4]) > 0.1 and theirs[1] in sign and sign[theirs[1]] == 1.0:
            sign[theirs[1]] = math.copysign(2.0, ours.whitened * theirs[4])
    for ours, theirs in zip(found, expected):
        assert tuple(ours)[:4] == theirs[:4]
        assert ours.whitened == pytest.approx(theirs[4] * sign[theirs[1]] / 2, abs=1e-9)
        assert ours.explained == pytest.approx(theirs[5], rel=1e-9)
        assert ours.identity_error < 1e-9


def test_little_variance(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)
    rows = whitening.whiten(one).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(rows)] == [
        (v, c, 1, 0, None, 0.0, 0.0) for v in (1, 2) for c in (1, 2)
    ]
    line = spark.createDataFrame([(i, [i / 256, -2 * i / 256, 0.0]) for i in range(5)], schema)
    rows = sorted(whitening.whiten(line).collect())
    assert [r.explained for r in rows[:3]] == pytest.approx([1, 0, 0])
    assert [r.whitened is None for r in rows[:3]] == [False, True, True]
    assert all(r.identity_error < 1e-12 for r in rows)
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []


def test_deviations_beyond_a_long():
    x = np.array([[3, 1 << 40], [0, 0]])
    sums = [3, 1 << 40]
    assert whitening._deviations(x, 2, sums) == [None, None]
    assert whitening._deviations(x[:, :1], 2, [3]) == [9, 9]


def test_at_a_tenth(spark):
    df = QUERIES["op11_whitening"](spark, "/root/testdata/sf0.01")
    moments = df.groupBy("component").agg(F.sum("whitened").alias("s"), F.sum(F.col("whitened") ** 2).alias("q"), F.count("*").alias("n"))
    for row in moments.collect():
        assert abs(row.s) < 1e-6 and row.q / row.n == pytest.approx(1, abs=1e-6)
