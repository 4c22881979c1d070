"""Whitening against numpy on exact whole numbers, on awkward matrices and rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterflow.llm import whitening

KIND = "vec_id long, embedding array<float>"


def frame(spark, vectors, first: int = 0, kind: str = KIND):
    return spark.createDataFrame([(first + k, v) for k, v in enumerate(vectors)], kind)


def plain(vectors) -> tuple[list[list[int]], np.ndarray, np.ndarray, list[int]]:
    """The fit list, its eigenvalues (falling) and eigenvectors, and its sums, of Python's whole numbers."""
    fit = sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array([[n * x - s for x, s in zip(row, sums)] for row in fit], dtype=float) / n
    _, sigma, right = np.linalg.svd(a, full_matrices=False)
    return fit, sigma**2 / n, right.T, sums


def check(spark, vectors, want: int) -> None:
    fit, values, axes, sums = plain(vectors)
    rows = frame(spark, vectors)
    model = whitening.fit_whitening(rows)
    assert (model.n, model.sums, len(model.eigenvalues)) == (len(fit), sums, want)
    assert np.allclose(model.eigenvalues, values[:want], rtol=1e-7) and math.isclose(model.trace, values.sum(), rel_tol=1e-9)
    assert model.identity_error <= 1e-4
    gaps = [min(abs(values[k] - values[j]) for j in range(len(values)) if j != k) for k in range(want)]
    for k in range(want):
        if gaps[k] > 1e-3 * values[0]:
            assert abs(abs(model.axes[k] @ axes[:, k]) - 1) < 1e-9
    got = {r.vec_id: r for r in whitening.whiten(rows, model).collect()}
    assert len(got) == len(vectors)
    for k, v in enumerate(vectors):
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        deviation = sum((len(fit) * a - s) ** 2 for a, s in zip(x, sums))
        assert got[k].deviation == (deviation if deviation < 2**63 else None)
        centred = np.array([a - s / len(fit) for a, s in zip(x, sums)])
        assert np.allclose(got[k].whitened, [centred @ model.axes[j] / math.sqrt(model.eigenvalues[j]) for j in range(want)], atol=1e-8)


def cloud(seed: int, n: int, d: int) -> np.ndarray:
    r = np.random.default_rng(seed)
    return r.normal(size=(n, d)) @ r.normal(size=(d, d)) * np.geomspace(1, 0.05, d) + r.normal(size=d)


def test_a_plain_cloud_with_repeated_vectors(spark):
    a = cloud(1, 300, 6)
    check(spark, [*a.tolist(), *a[:50].tolist()], 4)


def test_dependent_and_constant_dimensions(spark):
    a = cloud(2, 200, 3).round(2)
    check(spark, np.column_stack([a, a[:, 0], np.full(len(a), 7.0), np.zeros(len(a)), np.floor(a[:, 1] * 256) / 128]).tolist(), 3)


def test_fewer_vectors_than_dimensions(spark):
    check(spark, cloud(3, 3, 20).tolist(), 2)


def test_dimensions_of_very_different_scale(spark):
    a = cloud(4, 150, 4)
    check(spark, (a * np.array([1e6, 1.0, 1.0, 1.0])).tolist(), 4)


def test_nearly_dependent_dimensions(spark):
    r = np.random.default_rng(5)
    a = r.normal(size=(400, 2)) * 4000
    check(spark, np.column_stack([a, a[:, 0] + r.integers(0, 2, 400) / 256]).astype(np.float32).tolist(), 3)


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[0.5, -3.0]] * 5, [[]], [None, [None, 1.0], [math.nan, 0.0], [math.inf, 0.0]]])
def test_tables_without_variance_give_no_components(spark, vectors):
    rows = frame(spark, vectors)
    model = whitening.fit_whitening(rows)
    assert len(model.eigenvalues) == 0 and model.identity_error == 0
    found = whitening.whiten(rows, model).collect()
    assert len(found) == (len(vectors) if vectors and vectors[0] else 0) and all(r.whitened == [] and r.deviation == 0 for r in found)


def test_rows_that_are_left_out_and_clashing_columns(spark):
    good = cloud(6, 60, 3).tolist()
    bad = [None, [], [1.0], [1.0, 2.0], [1.0, None, 2.0], [math.nan, 1.0, 1.0], [1.0, math.inf, 1.0], [1.0, -math.inf, 1.0]]
    rows = frame(spark, good).unionByName(frame(spark, bad, 1000)).unionByName(frame(spark, good[:2], 5)).unionByName(frame(spark, good[:1]).withColumn("vec_id", F.lit(None).cast("long")))
    rows = rows.select("*", *(F.lit("mine").alias(c) for c in ("x", "N", "Deviation", "whitened", "_", "a.b", "my col")))
    model = whitening.fit_whitening(rows)
    assert model.n == 60
    found = whitening.whiten(rows, model).toPandas()
    assert len(found) == 63 and found.vec_id.isna().sum() == 1 and found.vec_id.max() < 1000


def test_entries_beyond_the_longs(spark):
    rows = frame(spark, [[1e30, 1.0], [-1e30, 2.0], [2.0**54, 3.0], [0.0, 4.0]], kind="vec_id long, embedding array<double>")
    model = whitening.fit_whitening(rows)
    assert model.sums[0] == (2**63 - 1) - 2**63 + 2**62 and model.sums[1] == 256 * 10
    assert {r.deviation for r in whitening.whiten(rows, model).collect()} == {None}


def test_query_returns_a_row_of_each_vector_and_component(spark):
    sf = "/root/testdata/sf0.01"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    check(spark, [list(r.embedding) for r in vectors.orderBy("vec_id").select("embedding").collect()], 4)
    got = whitening.op11_shifted_cholesky_qr(spark, sf)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 4 * vectors.count() and got.where("component not between 1 and 4 or identity_error > 1e-4").count() == 0
    moments = got.join(vectors.dropDuplicates(["embedding"]), "vec_id").groupBy("component").agg(F.avg("whitened"), F.avg(F.col("whitened") ** 2)).collect()
    assert all(abs(r[1]) < 1e-9 and abs(r[2] - 1) < 1e-9 for r in moments)
