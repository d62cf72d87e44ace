"""Work is spread by where rows lie, and what is kept of them is small."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodwire.operators import features, pca, sgd, train
from moodwire.plans import catalog, models
from moodwire.sources import tables
from moodwire.streaming import online


def test_rows_of_few_row_groups_are_dealt_to_all_cores(spark):
    """More splits than cores, whose rows all lie in one: the empty splits do not count."""
    cores = spark.sparkContext.defaultParallelism
    splits = spark.sparkContext.parallelize(range(2 * cores), 2 * cores)
    many = spark.createDataFrame(splits.flatMap(lambda i: [(j,) for j in range(2000)] if i == 0 else []), "doc_id long")
    spread = tables.balance_partitions(many)
    rows = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) >= cores and sum(rows) == 2000 and max(rows) <= 4 * sum(rows) / len(rows)


def test_even_rows_stay_where_they_are(spark):
    even = spark.range(0, 8000, 1, 8 * spark.sparkContext.defaultParallelism)
    assert tables.balance_partitions(even) is even


def test_packed_rows_are_kept_small():
    row = {"y": np.array([1.0, 0.0]).tobytes(), "lengths": np.array([2, 0], np.int32).tobytes(),
           "idx": np.array([5, 2999], np.int32).tobytes(), "val": np.array([1.0, 3.0]).tobytes()}
    y, lengths, idx, val = sgd._arrays(row)
    assert (y.dtype, idx.dtype, val.dtype) == (np.uint8, np.uint16, np.uint8)
    assert y.tolist() == [1, 0] and idx.tolist() == [5, 2999] and val.tolist() == [1, 3] and lengths.tolist() == [2, 0]
    wide = sgd._arrays(row | {"idx": np.array([5, 70000], np.int32).tobytes(), "val": np.array([0.1, 3.0]).tobytes()})
    assert wide[2].dtype == np.int32 and wide[3].tolist() == [0.1, 3.0]
    assert sgd._row_sums(np.array([1.0, 2, 3, 4]), np.array([0, 2, 0, 2, 0], np.int32)).tolist() == [0, 3, 0, 7, 0]


def test_partial_results_are_one_per_core(spark):
    """Partial gradients and products have the size of the model: their number must not grow with the input."""
    cores = spark.sparkContext.defaultParallelism
    assert sgd.per_core(spark.sparkContext.parallelize(range(100), 5 * cores)).getNumPartitions() == cores
    rows = spark.range(0, 60, 1, 5 * cores).select(
        F.array((F.col("id") % 3).cast("int")).alias("idx"), F.array(F.lit(1.0)).alias("val"))
    assert pca.fit(rows, 4, 2, max_passes=2).rows == 60


def test_tokens_and_texts_are_not_kept(spark, small_dir):
    models.forget()
    kept = models.sparse_features(spark, small_dir)
    assert not models.split_corpus(spark, small_dir).is_cached and not models.java_features(spark, small_dir).is_cached
    assert kept.is_cached and set(kept.columns) == {"tweet_id", "label", "split", "features"}
    models.forget()


def test_tasks_of_the_text_chain_hold_a_bounded_number_of_rows(spark):
    """Even splits of many rows are dealt where a bound is given, few rows to a task per core."""
    cores = spark.sparkContext.defaultParallelism
    even = spark.range(0, 16_000 * cores, 1, cores)
    assert tables.balance_partitions(even) is even
    spread = tables.balance_partitions(even, 1000)
    rows = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 16_000 * cores and len(rows) == 16 * cores and max(rows) <= 1100
    assert tables.balance_partitions(spark.range(0, 10, 1, 1), 1000).rdd.getNumPartitions() == cores


def test_a_step_of_descent_is_one_stage(spark):
    """Short partial gradients are added by the driver: no second stage per step. Long ones are added by executors."""
    assert sgd.tree_depth(12, 1500) == 1 and sgd.tree_depth(1000, 1 << 18) == 2
    rows = spark.range(0, 400, 1, 8).select((F.col("id") % 2).cast("double").alias("label"),
                                            F.array((F.col("id") % 3).cast("int")).alias("idx"), F.array(F.lit(1.0)).alias("val"))
    sc = spark.sparkContext
    sc.setJobGroup("descent", "steps")
    sgd.train_sgd(rows, 3, iterations=4, tol=0.0)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    assert max(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("descent")) == 1


def test_a_step_over_few_rows_has_few_tasks(spark, monkeypatch):
    """Rows of many partitions that one task can hold are gathered for the steps; with more rows there is a task per core."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 400, 1, 4 * cores).select((F.col("id") % 2).cast("double").alias("label"),
                                                    F.array((F.col("id") % 3).cast("int")).alias("idx"), F.array(F.lit(1.0)).alias("val"))
    sc = spark.sparkContext

    def tasks(group, weights=[]):
        sc.setJobGroup(group, "steps")
        weights.append(sgd.train_sgd(rows, 3, iterations=6, tol=0.0).weights)
        sc.setLocalProperty("spark.jobGroup.id", None)
        tracker = sc.statusTracker()
        jobs = sorted(tracker.getJobIdsForGroup(group))
        return tracker.getStageInfo(tracker.getJobInfo(jobs[-1]).stageIds[-1]).numTasks, weights

    assert tasks("few")[0] == 1
    monkeypatch.setattr(sgd, "TASK_BYTES", 1)
    most, (gathered, apart) = tasks("many")
    assert most == cores and np.allclose(gathered, apart, rtol=0, atol=1e-12)


def test_scaled_counts_train_as_their_products(spark):
    """Counts and a factor per bucket give the weights of the products, and are kept in a byte each. Rows without
    buckets count, too."""
    rows = spark.createDataFrame([(float(k % 2), [k % 5, 5 + k % 3], [1.0 + k % 4, 2.0]) for k in range(60)] + [(1.0, [], []), (0.0, None, None)],
                                 "label double, idx array<int>, val array<double>")
    scale = [0.1 + 0.37 * j for j in range(8)]
    plain = sgd.train_sgd(features.with_tf_idf(rows, scale), 8, iterations=7, tol=0.0)
    scaled = sgd.train_sgd(rows, 8, iterations=7, tol=0.0, scale=scale)
    assert scaled.rows == plain.rows == 62 and scaled.weights == plain.weights


def test_the_trainer_reads_texts_without_buckets(spark):
    """A null text has no buckets: the values of the rows beside it stay with theirs."""
    texts = [(1.0, "good day :)"), (0.0, None), (0.0, "bad day :("), (1.0, "")]
    batch = spark.createDataFrame(texts, "label double, text string").coalesce(1)
    idf = [0.5 + 0.01 * j for j in range(50)]
    trainer = online.OnlineTrainer(spark, num_features=50, iterations=5, idf=idf)
    trainer.process(batch, 0)
    made = features.with_tf_idf(features.with_text_java_tf(batch, num_features=50), idf)
    expected = sgd.train_sgd(made.select("label", "idx", "val"), 50, iterations=5)
    row = trainer.latest().first()
    assert np.allclose(row["weights"], expected.weights, rtol=0, atol=1e-12) and row["rows"] == 4


def test_the_holdout_goes_through_the_text_chain_once(spark, small_dir, monkeypatch):
    """Its evaluations and the statistics of the latest model read the features that the trainer keeps."""
    models.forget()
    models.online_trainer(spark, small_dir)
    monkeypatch.setattr(features, "with_text_java_tf", lambda *a, **k: (_ for _ in ()).throw(AssertionError("chain once more")))
    assert models.q_online_statistics(spark, small_dir).count() == 1
    models.forget()


def test_rows_of_a_micro_batch_in_one_file_are_dealt(spark):
    one = spark.range(0, 1000, 1, 1)
    rows = [r["count"] for r in online.spread(one).groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) == spark.sparkContext.defaultParallelism and sum(rows) == 1000


def test_rows_of_a_descent_do_not_fill_an_executors_memory(spark, monkeypatch):
    """A packed row has a few MB however many rows a batch has, and many of them are kept on disk."""
    rows = spark.range(0, 2000, 1, 1).select((F.col("id") % 2).cast("double").alias("label"), F.sequence(F.lit(0), F.lit(299)).alias("idx"),
                                             F.array_repeat(F.lit(1.0), 300).alias("val"))
    packed = rows.mapInArrow(sgd._pack_batches("label", "idx", "val"), sgd.PACKED_SCHEMA)
    sizes = [r[0] for r in packed.select(F.length("val") + F.length("idx")).collect()]
    assert sum(sizes) == 12 * 600_000 and max(sizes) < 4 << 20
    levels, plain = [], sgd.gathered
    monkeypatch.setattr(sgd, "TASK_BYTES", 1)
    monkeypatch.setattr(sgd, "gathered", lambda data, size: levels.append(data.getStorageLevel()) or plain(data, size))
    assert sgd.train_sgd(rows, 300, iterations=2).rows == 2000
    assert levels[0].useDisk and not levels[0].useMemory


def test_the_grid_search_keeps_no_copies_of_folds(spark, monkeypatch):
    """The areas and the model of ``CrossValidator``, which keeps both sides of each fold; so are its refusals."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.tuning import ParamGridBuilder
    from pyspark.sql import DataFrame

    made = [(k, float(k * 7 % 3 == 0), Vectors.sparse(4, [k % 4], [1.0 + k % 5])) for k in range(90)]
    rows = spark.createDataFrame(made, ["tweet_id", "label", "features"]).persist()
    lr = LogisticRegression()
    theirs = train._cross_validate(train.with_folds(rows, 3), lr, ParamGridBuilder().addGrid(lr.maxIter, [0, 1]).build(), 3, 1)
    kept = []
    for name in ("persist", "cache"):
        monkeypatch.setattr(DataFrame, name, lambda self, *a: kept.append(self) or self)
        monkeypatch.setattr(type(rows), name, lambda self, *a: kept.append(self) or self)
    ours = train.lr_cv_grid(rows)
    monkeypatch.undo()
    assert not kept and ours.avgMetrics == list(theirs.avgMetrics) and ours.settings == [(-1, -1.0, 0), (-1, -1.0, 1)]
    assert ours.bestModel.coefficients.toArray().tolist() == theirs.bestModel.coefficients.toArray().tolist()
    rows.unpersist()
    with pytest.raises(ValueError, match="is empty"):
        train.lr_cv_grid(rows.filter("tweet_id = 1"))
    with pytest.raises(ValueError, match="have no fold"):
        train.lr_cv_grid(rows.withColumn("tweet_id", F.when(F.col("tweet_id") > 3, F.col("tweet_id"))))


def test_tasks_of_the_term_counts_hold_few_texts(spark, tmp_path):
    """The worker of a task holds all forms of its texts at once, beside the heap of its executor."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, 6_000 * cores, 1, cores).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("en").alias("lang")).write.parquet(
        str(tmp_path / "documents.parquet"))
    for made in (catalog.java_tf(spark, str(tmp_path)), models.java_features(spark, str(tmp_path))):
        rows = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(rows) == 6_000 * cores and max(rows) <= 2_200
