"""An empty corpus through every trainer, metric and stream: schema kept, NULL metrics, no model version."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from moodwire.operators import corpus, features, metrics, pca, sgd, train
from moodwire.plans import catalog, models
from moodwire.streaming import evaluation, online


@pytest.fixture(scope="module")
def empty(spark, small_dir):
    return models.split_corpus(spark, small_dir).limit(0)


def test_features_and_idf(empty):
    tf = features.with_java_tf(empty, num_features=5)
    assert tf.count() == 0 and features.doc_frequency(tf).count() == 0
    assert features.fit_idf(tf, 5) == [0.0] * 5  # ln((0 + 1) / (0 + 1))
    assert features.with_tf_idf(tf, [0.0] * 5).count() == 0


def test_batch_trainers(spark, empty):
    assert train.batch_cv(empty) is None and train.cv_summary(None) == []
    assert train.default_pipeline(empty) is None
    vectors = features.hashing_tf(5).transform(empty)
    assert train.lr_cv_grid(vectors) is None
    scored = train.predict_batch(None, empty)
    assert scored.count() == 0 and scored.columns == ["tweet_id", "tweet", "prediction", "score"]


def test_sgd_and_pca(spark, empty):
    tf = features.with_java_tf(empty, num_features=5)
    model = sgd.train_sgd(tf, 5, iterations=3, initial_weights=[1.0] * 5)
    assert (model.rows, model.iterations, model.weights) == (0, 0, [1.0] * 5)
    assert pca.fit(tf, 5).components == [] and pca.pca_sparse(tf, 5).count() == 0
    dense = spark.createDataFrame([], "id long, v array<double>").select(array_to_vector("v").alias("features"))
    assert train.pca(dense).count() == 0


def test_metrics(spark, empty):
    scored = empty.select("label", F.lit(0.5).alias("score"), F.lit(1.0).alias("prediction"))
    assert metrics.auc_roc(scored).first()[0] is None and metrics.auc_pr(scored).first()[0] is None
    assert metrics.accuracy(scored).first().asDict() == {"accuracy": None, "n": 0}
    assert metrics.balanced_accuracy(scored).first()[0] is None
    assert [tuple(r) for r in metrics.precision_recall(scored).collect()] == [(None, None, None)]
    row = metrics.statistics_row(scored, "batch", "m", 0).first()
    assert (row["area_under_roc"], row["accuracy"], row["n"]) == (None, None, 0)
    assert corpus.majority_baseline(empty).first()[0] is None
    assert corpus.sentiment_summary(scored.withColumn("model", F.lit("m"))).count() == 0
    assert metrics.latest_statistics(spark.createDataFrame([], evaluation.STATISTICS_SCHEMA)).count() == 0


def test_streams(spark, small_dir):
    labelled = online.labelled_stream(catalog.tables.tweets(spark, small_dir)).limit(0)
    trainer = online.OnlineTrainer(spark, num_features=5, iterations=2)
    trainer.process(labelled, 0)
    assert trainer.versions().count() == 0 and trainer.latest().count() == 0 and trainer.statistics().count() == 0
    labelled = online.labelled_stream(catalog.tables.tweets(spark.newSession(), small_dir)).limit(0)  # as a stream's batches
    collector = online.CorpusCollector(spark, target=4)
    assert collector.corpus().count() == 0 and collector.progress().count() == 0
    collector._process(labelled, 0)
    assert collector.corpus().count() == 0 and collector.progress().count() == 0 and not collector.state.full
