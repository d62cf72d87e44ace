"""Evaluation by the clock, mergeable counts, the statistics feed."""

import time

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from moodwire.operators import metrics
from moodwire.session import work_path
from moodwire.streaming import evaluation


@pytest.fixture(scope="module")
def scored(spark):
    rows = [((k * 37 % 101) / 100, float(k * k % 7 < 3), k % 4) for k in range(600)]
    return spark.createDataFrame(rows, "score double, label double, batch_id long")


def test_merged_counts_equal_scoring_anew(spark, scored):
    counts = evaluation.ScoreCounts(spark)
    assert counts.statistics(1).collect()[0].asDict() == {"area_under_roc": None, "accuracy": None, "n": 0}
    for upto in range(4):
        counts.add(scored.filter(F.col("batch_id") == upto), 1)
        counts.add(scored.filter(F.col("batch_id") == upto), 1)  # a replay replaces
        assert counts.counted_upto(1) == upto and counts.counted_upto(2) == -1
        all_rows = scored.filter(F.col("batch_id") <= upto)
        got = counts.statistics(1).first()
        ml = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(all_rows)
        assert got["area_under_roc"] == pytest.approx(ml) == pytest.approx(metrics.auc_roc(all_rows).first()[0])
        hits = all_rows.withColumn("prediction", (F.col("score") > 0.5).cast("double"))
        assert got["accuracy"] == pytest.approx(metrics.accuracy(hits).first()["accuracy"]) and got["n"] == all_rows.count()


def weights_at(spark, path, version, w):
    evaluation.put(spark.createDataFrame([([float(x) for x in w], version)], evaluation.WEIGHTS_SCHEMA), path, "version")


def holdout_at(spark, path, batch_id, rows):
    made = spark.createDataFrame([(y, i, v, batch_id) for y, i, v in rows], evaluation.FEATURES_SCHEMA)
    evaluation.put(made, path, "batch_id")


ROWS = [(1.0, [0], [2.0]), (0.0, [1], [1.0]), (1.0, [1], [3.0]), (0.0, [0, 1], [1.0, 1.0])]


def test_the_clock_evaluates_without_new_tweets(spark):
    weights, holdout = work_path(spark, "t-weights"), work_path(spark, "t-holdout")
    evaluator = evaluation.PeriodicEvaluator(spark, weights, holdout, seconds=1)
    assert evaluator.evaluate(0) is False  # no weights yet: no row
    weights_at(spark, weights, 0, [1.0, -1.0])
    assert evaluator.evaluate(0) is True  # no hold-out yet: a row without values
    assert evaluator.statistics().first().asDict()["n"] == 0
    holdout_at(spark, holdout, 0, ROWS)
    query = evaluator.start()
    try:
        deadline = time.monotonic() + 90

        def seen(version):
            return evaluator.statistics().filter((F.col("model_version") == version) & (F.col("n") > 0)).count()

        while seen(0) < 2 and query.isActive and time.monotonic() < deadline:
            query.awaitTermination(0.2)
        weights_at(spark, weights, 1, [-1.0, 1.0])
        while seen(1) < 1 and query.isActive and time.monotonic() < deadline:
            query.awaitTermination(0.2)
    finally:
        evaluator.stop(query)
    assert seen(0) >= 2 and seen(1) >= 1
    rows = evaluator.statistics().filter("n > 0").collect()
    assert {(r.model_version, r.accuracy) for r in rows} == {(0, 0.75), (1, 0.5)}


def test_a_tick_scores_only_new_holdout_batches(spark, monkeypatch):
    weights, holdout = work_path(spark, "t-weights"), work_path(spark, "t-holdout")
    weights_at(spark, weights, 3, [1.0, -1.0])
    evaluator = evaluation.PeriodicEvaluator(spark, weights, holdout)
    added, real = [], evaluator.counts.add
    monkeypatch.setattr(evaluator.counts, "add", lambda scored, version: (added.append(scored.count()), real(scored, version)))
    for tick, rows in enumerate([ROWS, ROWS[:3], None, ROWS[3:]]):
        if rows:
            holdout_at(spark, holdout, tick, rows)
        evaluator.evaluate(tick)
    assert added == [4, 3, 1]
    assert [r.n for r in evaluator.statistics().orderBy("evaluation").collect()] == [4, 7, 7, 8]


def stats(spark, *rows):
    return spark.createDataFrame([(t, v, "m", a, a, 10, None, e) for t, v, a, e in rows], evaluation.STATISTICS_SCHEMA)


def test_late_subscriber_gets_the_latest_batch_row_then_each_new_one_once(spark):
    path, folder = work_path(spark, "t-stats"), work_path(spark, "t-feed")
    evaluation.put(stats(spark, ("batch", 0, 0.5, 0), ("batch", 1, 0.6, 1), ("online", 0, 0.55, 2)), path, "evaluation")
    feed = evaluation.StatisticsFeed(spark, path, folder)
    feed.run()
    sent = lambda: sorted((r.trainer, r.model_version, r.evaluation) for r in feed.delivered().collect())
    assert sent() == [("batch", 1, 1)]
    evaluation.put(stats(spark, ("online", 1, 0.57, 3), ("batch", 2, 0.7, 4)), path, "evaluation")
    again = evaluation.StatisticsFeed(spark, path, folder)  # opened anew: goes on
    again.run()
    assert sent() == [("batch", 1, 1), ("batch", 2, 4), ("online", 1, 3)]
    evaluation.put(stats(spark, ("batch", 2, 0.7, 4), ("online", 0, 0.55, 2)), path, "evaluation")  # replayed rows, new files
    evaluation.put(stats(spark, ("online", 1, 0.58, 5)), path, "evaluation")  # the same version evaluated again
    again.run()
    assert sent() == [("batch", 1, 1), ("batch", 2, 4), ("online", 1, 3), ("online", 1, 5)]
    assert '"model_version":2' in feed.delivered().filter("evaluation = 4").first()["message"]


def test_subscriber_of_an_empty_table(spark):
    path = work_path(spark, "t-stats")
    feed = evaluation.StatisticsFeed(spark, path)
    feed.subscribe()
    assert feed.delivered().count() == 0
    evaluation.put(stats(spark, ("online", 0, 0.5, 0)), path, "evaluation")
    feed.run()
    assert [r.model_version for r in feed.delivered().collect()] == [0]


def test_statistics_stay_readable_while_a_tick_replaces_its_row(spark):
    weights, holdout = work_path(spark, "t-weights"), work_path(spark, "t-holdout")
    evaluator = evaluation.PeriodicEvaluator(spark, weights, holdout)
    assert evaluator.statistics().collect() == [] and evaluator.statistics().schema.simpleString() == "struct<" + evaluation.STATISTICS_SCHEMA.replace("long", "bigint").replace(", ", ",").replace(" ", ":") + ">"
    weights_at(spark, weights, 0, [1.0, -1.0])
    holdout_at(spark, holdout, 0, ROWS)
    evaluator.evaluate(0)
    seen = evaluator.statistics()
    expected = spark.read.schema(evaluation.STATISTICS_SCHEMA).parquet(evaluator.statistics_path).collect()
    evaluator.evaluate(0)  # a replay: the row is written anew, in another file
    assert seen.collect() == expected and len(expected) == 1
