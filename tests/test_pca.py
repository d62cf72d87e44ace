"""Randomized PCA against a full singular value decomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodwire.operators import pca
from moodwire.plans import models

SCHEMA = "id long, idx array<int>, val array<double>"


def dense(rows, n):
    x = np.zeros((len(rows), n))
    for r, (_, idx, val) in enumerate(rows):
        np.add.at(x[r], idx, val)
    return x


def reference(x, k):
    centred = x - x.mean(axis=0)
    _, s, v = np.linalg.svd(centred, full_matrices=False)
    v = v[:k]
    v = v * np.sign(v[np.arange(k), np.argmax(np.abs(v), axis=1)])[:, None]
    return v, s[:k] ** 2 / len(x)


def test_equals_svd_on_the_corpus(spark, small_dir):
    made = models.java_features(spark, small_dir, 1500).select(F.col("tweet_id").alias("id"), "idx", "val")
    rows = [tuple(r) for r in made.collect()]
    x = dense(rows, 1500)
    v, var = reference(x, 3)
    model = pca.fit(made, 1500, 3)
    assert np.allclose(model.components, v, atol=1e-4) and np.allclose(model.variances, var, rtol=1e-8)
    assert np.allclose(np.array(model.components) @ np.array(model.components).T, np.eye(3), atol=1e-10)
    got = {r.id: r.pca for r in pca.pca_sparse(made, 1500, 3).collect()}
    want = x @ np.array(model.components).T
    assert all(np.allclose(got[rows[r][0]], want[r], atol=1e-8) for r in range(len(rows)))


def test_wider_than_a_dense_covariance(spark):
    """200,000 buckets: the square matrix would be 320 GB."""
    g = np.random.default_rng(3)
    n, hidden = 200_000, g.normal(size=(400, 2)) * [9, 4]
    spots = [g.choice(n, 40, replace=False) for _ in range(2)]
    rows = [(r, [int(i) for s in spots for i in s] + [int(g.integers(n))],
             [float(hidden[r, c]) for c in range(2) for _ in range(40)] + [1.0]) for r in range(400)]
    model = pca.fit(spark.createDataFrame(rows, SCHEMA).repartition(4), n, 2)
    for c in range(2):
        direction = np.zeros(n)
        direction[spots[c]] = 1 / 40**0.5
        assert max(abs(direction @ np.array(v)) for v in model.components) > 0.99
    assert np.isclose(model.variances[0], 40 * hidden[:, 0].var(), rtol=0.05)


@pytest.mark.parametrize("rows", [[], [(1, [0], [2.0])], [(k, [0, 2], [1.0, 2.0]) for k in range(5)], [(1, [], []), (2, [], [])]])
def test_empty_one_row_equal_rows_and_rows_without_features(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    out = pca.pca_sparse(table, 4, 3).collect()
    assert len(out) == len(rows) and all(np.isfinite(r.pca).all() for r in out)
    if rows:
        assert np.allclose(pca.fit(table, 4, 3).variances, 0)
