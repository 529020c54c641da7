from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paygrain.llm import whitening as W

from .conftest import SF


def scatter(a):
    centred = a - a.mean(axis=0)
    return centred.T @ centred


def assert_spectrum(s, a):
    v = scatter(a)
    scale = max(np.abs(np.linalg.eigvalsh(v)).max(), 1e-9 * np.abs(a).max() ** 2)  # rounding is relative to the entries
    assert s.n == len(a) and np.allclose(s.mean, a.mean(axis=0), rtol=1e-10, atol=1e-8 * np.abs(a).max())
    assert np.abs(s.values - np.linalg.eigvalsh(v)).max() <= 1e-10 * scale
    assert np.abs(s.basis.T @ s.basis - np.eye(a.shape[1])).max() < 1e-10
    assert np.abs(s.basis @ np.diag(s.values) @ s.basis.T - v).max() <= 1e-10 * scale


@pytest.mark.parametrize("size", [1, 2, 5, 24, 64])
@pytest.mark.parametrize("shape", ["free", "equal columns", "ties", "all equal", "half zero"])
def test_updates_and_combination(size, shape):
    """Any cut into blocks and parts has the spectrum of all vectors, equal eigenvalues and empty directions included."""
    rng = np.random.default_rng(size)
    for n in (1, 2, 7, 150):
        a = rng.normal(size=(n, size)) * np.exp(2 * rng.normal(size=size)) * 1000
        if shape == "equal columns":
            a[:, size // 2] = a[:, 0]
        elif shape == "ties":
            a = np.round(a / 500)
        elif shape == "all equal":
            a[:] = a[0]
        elif shape == "half zero":
            a[: n // 2] = 0
        whole, left, right = (W.Spectrum.empty(size) for _ in range(3))
        for block in np.split(a, sorted(rng.integers(0, n + 1, 3))):
            whole.add(block)
        left.add(a[: n // 3])
        right.add(a[n // 3 :])
        assert_spectrum(whole, a)
        assert_spectrum(W.Spectrum.unpack(left.combine(right).pack()), a)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1e6), st.floats(1e-6, 1e6)), min_size=1, max_size=30))
def test_secular_roots_interlace(pairs):
    pairs = sorted({round(p, 3): w for p, w in pairs}.items())
    poles, weights = np.array([p for p, _ in pairs]), np.array([w for _, w in pairs])
    base, offset = W.secular_roots(poles, weights)
    roots = poles[base] + offset
    assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all() and roots[-1] <= (poles[-1] + weights.sum()) * (1 + 1e-12)
    expected = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
    assert np.abs(roots - expected).max() <= 1e-9 * max(1.0, np.abs(expected).max())


def brute(rows, components=8):
    """{(key, component): figures} by the contract, with one dense decomposition; rows are (key, vector or None)."""
    kept = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in kept]
    if not kept:
        return []
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    kept = [(k, v) for k, v in kept if len(v) == size]
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [sum(int(n * c - t) ** 2 for c, t in zip(row, s)) for row in x]
    centred = np.array([[float(n * c - t) / n for c, t in zip(row, s)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = int((values > values.sum() * size * 1e-15).sum())
    out = []
    for i, (k, _) in enumerate(kept):
        for j in range(min(count, components)):
            out.append((k, j + 1, n, deviation[i], centred[i] @ vectors[:, j] / np.sqrt(values[j]), values[j] / values.sum()))
    return out


def assert_same(found, expected):
    """Rows of one key are compared as a set ordered by figures; every component may have either sign."""
    by = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))
    found, expected = sorted(found, key=by), sorted(expected, key=by)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    signs = {}
    for f, e in zip(found, expected):
        assert abs(f[5] - e[5]) <= 1e-9 * e[5] and f[6] <= 1e-9
        if abs(e[4]) > 1e-3:
            signs.setdefault(f[1], math.copysign(1, f[4] * e[4]))
            assert abs(f[4] * signs[f[1]] - e[4]) < 1e-8


def rows_of(df):
    return [tuple(r) for r in df.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()]


def test_query_by_brute_force(spark):
    source = spark.read.parquet(f"{SF}/embeddings.parquet")
    expected = brute([(r["vec_id"], r["embedding"]) for r in source.collect()])
    found = rows_of(W.op13_whitening(spark, SF))
    assert len(found) == 8 * source.count()
    assert_same(found, expected)


def test_many_parts_are_combined_in_rounds(spark):
    """Seventy parts: three rounds of eight."""
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*[F.randn(i) * (i + 1) for i in range(5)]).alias("embedding"))
    df = df.repartition(70, "vec_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert_same(rows_of(W.whiten(df)), brute([(r["vec_id"], r["embedding"]) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


MESSY = [
    (1, [1.0, 2.5, -3.0]), (2, [0.5, None, 1.0]), (3, None), (4, [float("nan"), 0.0, 1.0]), (5, [float("inf"), 0.0, 1.0]), (6, []),
    (7, [1.0, 2.0]), (8, [0.25, 0.5, 0.75]), (8, [0.25, 0.5, 0.75]), (None, [-1.0, 4.0, 2.0]), (9, [9.0, -2.0, 0.125]), (10, [3.0, 3.0, 1.0]),
]


def test_messy_rows(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in MESSY], "vec_id long, embedding array<float>, key string, x string")
    assert_same(rows_of(W.whiten(df)), brute(MESSY))


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [2.0, 1.0]), (2, [2.0, 1.0])], schema)).count() == 0


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = [(i, [1.0, -2.0, 0.5, 7.0] if i % 3 == 0 else [math.sin(i), math.cos(i * 3), i % 7 / 7, i % 11 / 5]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(16, "vec_id")
    assert_same(rows_of(W.whiten(df)), brute(rows))


def test_deviations_beyond_a_long_stay_exact():
    w = W.Whitener(3 * 10**9, np.array([10**15, -(10**14)]), np.ones(2), np.eye(2), 1.0)
    x = np.array([[10**6, 5], [333333, -33333]])
    assert w.deviations(x) == [sum((3 * 10**9 * int(c) - int(t)) ** 2 for c, t in zip(row, w.sums)) for row in x]


def test_long_vectors(spark):
    """Vectors of 512 entries: a spectrum of two megabytes a part."""
    rng = np.random.default_rng(3)
    a = rng.normal(size=(700, 512)) * np.linspace(3, 0.1, 512)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(a)], "vec_id long, embedding array<double>")
    assert_same(rows_of(W.whiten(df.repartition(2))), brute(list(enumerate(a.tolist()))))


def test_a_large_deviation_is_null_in_the_query(spark):
    df = spark.range(1).select(F.lit(Decimal(2**63)).cast("decimal(38,0)").alias("deviation"))
    assert df.select(F.expr("try_cast(deviation AS bigint)")).first()[0] is None
