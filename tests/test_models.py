"""SGD against a numpy loop; AUC against Spark's evaluator; running totals against a window."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from moodwire.operators import features, metrics, sgd
from moodwire.plans import catalog


@pytest.fixture(scope="module")
def tf(spark, small_dir):
    return features.with_java_tf(catalog.tokenized(spark, small_dir), num_features=200).select(
        "tweet_id", "label", "idx", "val").persist()


def numpy_sgd(rows, d, iterations, step, reg, w0=None, tol=0.001):
    w = np.zeros(d) if w0 is None else np.array(w0, dtype=float)
    n = len(rows)
    prev = None
    for i in range(1, iterations + 1):
        g = np.zeros(d)
        for r in rows:
            ix = np.array(r["idx"], dtype=int)
            v = np.array(r["val"])
            m = 1.0 / (1.0 + np.exp(-(w[ix] * v).sum())) - r["label"]
            np.add.at(g, ix, v * m)
        eta = step / np.sqrt(i)
        w = w * (1 - eta * reg) - eta * g / n
        if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
            return w, i
        prev = w
    return w, iterations


@pytest.mark.parametrize("reg", [0.0, 0.01])
def test_sgd_matches_numpy(spark, tf, reg):
    model = sgd.train_sgd(tf, 200, iterations=12, step=1.0, reg_param=reg)
    ref, its = numpy_sgd(tf.collect(), 200, 12, 1.0, reg)
    assert model.iterations == its
    assert np.allclose(model.weights, ref, atol=1e-9)


def test_sgd_does_not_depend_on_partitions_or_touch_the_session(spark, tf, monkeypatch):
    before = dict(spark.conf.getAll)
    a = sgd.train_sgd(tf, 200, iterations=5)
    monkeypatch.setattr(sgd, "PACKED_NNZ", 50)  # many small packed rows
    b = sgd.train_sgd(tf.repartition(13), 200, iterations=5)
    assert np.allclose(a.weights, b.weights, atol=1e-9)
    assert dict(spark.conf.getAll) == before
    assert sgd.train_sgd(tf.limit(0), 200, iterations=5).weights == [0.0] * 200


def test_sgd_warm_start_continues(spark, tf):
    first = sgd.train_sgd(tf, 200, iterations=3)
    again = sgd.train_sgd(tf, 200, iterations=3, initial_weights=first.weights)
    ref, _ = numpy_sgd(tf.collect(), 200, 3, 1.0, 0.0, w0=first.weights)
    assert np.allclose(again.weights, ref, atol=1e-9)


def test_prediction_threshold(spark, tf):
    w = [0.1 * ((j % 7) - 3) for j in range(200)]
    rows = sgd.with_online_prediction(tf, w).select("idx", "val", "prediction").collect()
    for r in rows:
        margin = sum(w[i] * v for i, v in zip(r["idx"], r["val"]))
        assert r["prediction"] == (1.0 if 1 / (1 + np.exp(-margin)) > 0.5 else 0.0)


def scored(spark, small_dir):
    return catalog.labelled(spark, small_dir).select(
        catalog.fixture_score().alias("score"), F.col("label"))


def test_auc_roc_matches_evaluator(spark, small_dir):
    df = scored(spark, small_dir)
    ours = metrics.auc_roc(df).first()["auc_roc"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderROC").evaluate(df)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_auc_pr_matches_evaluator(spark, small_dir):
    df = scored(spark, small_dir)
    ours = metrics.auc_pr(df).first()["auc_pr"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderPR").evaluate(df)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_running_totals_match_window(spark):
    df = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("x"))
    got = {r["k"]: r["cum_x"] for r in metrics.running_totals(df, "k", ["x"], descending=False, partitions=5)
           .collect()}
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["k"]: r["c"] for r in df.select("k", F.sum("x").over(w).alias("c")).collect()}
    assert got == want


def test_idf_matches_ml_idf(spark, tf):
    from pyspark.ml.feature import IDF
    from pyspark.ml.functions import array_to_vector

    ours = features.fit_idf(tf, 200)
    dense = tf.withColumn("v", array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(199)), lambda j: F.coalesce(
        F.element_at(F.map_from_arrays("idx", "val"), j), F.lit(0.0)))))
    theirs = IDF(inputCol="v", outputCol="o").fit(dense).idf.toArray()
    assert np.allclose(ours, theirs, atol=1e-12)


def test_tf_idf_with_many_buckets_keeps_rows_without_features(spark):
    d = spark.createDataFrame([(1, [0, 99_999], [2.0, 1.0]), (2, [], [])], "tweet_id long, idx array<int>, val array<double>")
    idf = [float(i) for i in range(100_000)]
    got = {r.tweet_id: r.val for r in features.with_tf_idf(d, idf).collect()}
    assert got == {1: [0.0, 99_999.0], 2: []}


def test_gradient_frame_matches_numpy(spark, tf):
    w = [0.01 * ((j % 11) - 5) for j in range(200)]
    got = np.zeros(200)
    for r in sgd.gradient(tf, w).collect():
        got[r["j"]] = r["g"]
    want = np.zeros(200)
    for r in tf.collect():
        ix = np.array(r["idx"], dtype=int)
        v = np.array(r["val"])
        m = 1.0 / (1.0 + np.exp(-(np.array(w)[ix] * v).sum())) - r["label"]
        np.add.at(want, ix, v * m)
    assert np.allclose(got, want, atol=1e-9)


def test_descent_makes_no_broadcast_per_step(spark, monkeypatch):
    """The weights go with the tasks of a step; a broadcast each step took a seventh of its time."""
    from pyspark import SparkContext

    from moodwire.operators import sgd

    made = []
    plain = SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: made.append(1) or plain(self, value))
    rows = spark.createDataFrame([(1.0, [0, 2], [1.0, 2.0]), (0.0, [1], [1.0])], "label double, idx array<int>, val array<double>")
    model = sgd.train_sgd(rows, 3, iterations=4, tol=0.0)
    assert model.iterations == 4 and model.weights[0] > 0 > model.weights[1] and not made
