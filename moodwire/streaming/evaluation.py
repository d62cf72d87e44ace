"""Evaluation of streamed models by the clock, in mergeable pieces, and the feed of its results.

* ``ScoreCounts``: counts of positives and negatives per score, one table partition per (version, hold-out
  batch). Counts add up, so the exact area, accuracy and size over any number of batches come from the
  stored counts: a new hold-out batch is scored once, and nothing is scored again.
* ``PeriodicEvaluator``: a query of its own on a clock source evaluates the latest weights every few seconds,
  whether or not tweets arrive; one statistics row per tick.
* ``StatisticsFeed``: a subscriber's stream over the statistics table. One that comes late first gets
  the latest row of the batch trainer, then each new row once.

All state is in tables, partitioned by what a replay would write again.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.functions import rules
from moodwire.operators import metrics, sgd
from moodwire.session import work_path

WEIGHTS_SCHEMA = "weights array<double>, version long"
FEATURES_SCHEMA = "label double, idx array<int>, val array<double>, batch_id long"
COUNTS_SCHEMA = "score double, pos long, neg long, version long, batch_id long"
STATISTICS_SCHEMA = ("trainer string, model_version long, model string, area_under_roc double, accuracy double, n long, "
                     "ts timestamp, evaluation long")


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty if nothing was written there yet; any other failure raises."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def put(df: DataFrame, path: str, *by: str) -> None:
    """Write ``df`` in place of the partitions it holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


class ScoreCounts:
    """Mergeable evaluation of model versions over hold-out batches.

    ``add`` stores a scored batch as (score, positives, negatives); adding the same batch again replaces it.
    ``statistics`` merges all batches of a version: exact area under ROC, accuracy at ``threshold`` and size.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, threshold: float = 0.5):
        self.spark, self.path, self.threshold = spark, path or work_path(spark, "score-counts"), threshold

    def table(self) -> DataFrame:
        return table_or_empty(self.spark, self.path, COUNTS_SCHEMA)

    def add(self, scored: DataFrame, version: int, score_col: str = "score", label_col: str = "label") -> None:
        """``scored`` holds a ``batch_id`` column; its batches are counted for ``version``."""
        per = scored.groupBy("batch_id", F.col(score_col).cast("double").alias("score")).agg(
            F.sum(F.when(F.col(label_col) > 0.5, 1).otherwise(0)).cast("long").alias("pos"),
            F.sum(F.when(F.col(label_col) > 0.5, 0).otherwise(1)).cast("long").alias("neg"))
        put(per.withColumn("version", F.lit(version).cast("long")), self.path, "version", "batch_id")

    def counted_upto(self, version: int) -> int:
        """The last hold-out batch counted for ``version``, -1 for none (reads partition names)."""
        last = self.table().filter(F.col("version") == version).agg(F.max("batch_id")).first()[0]
        return -1 if last is None else last

    def merged(self, version: int) -> DataFrame:
        return self.table().filter(F.col("version") == version).groupBy("score").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))

    def statistics(self, version: int) -> DataFrame:
        """One row (area_under_roc, accuracy, n); NULL, NULL, 0 where nothing was counted."""
        counts = self.merged(version)
        hit = F.when(F.col("score") > self.threshold, F.col("pos")).otherwise(F.col("neg"))
        total = counts.agg(F.sum(hit).alias("hit"), F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0)).alias("n"))
        return metrics.auc_of_counts(counts).crossJoin(total).select(  # one row each
            F.col("auc_roc").alias("area_under_roc"), F.when(F.col("n") > 0, F.col("hit") / F.col("n")).alias("accuracy"), "n")


class PeriodicEvaluator:
    """Evaluates the latest version in the weights table every ``seconds``, in a query of its own.

    The hold-out is a table of features (label, idx, val) by ``batch_id``, to which batches may be added at any time.
    A tick scores the batches that the latest version has not been counted on; a second tick on the same
    version and hold-out scores nothing and reports the same counts again.
    """

    def __init__(self, spark: SparkSession, weights_path: str, holdout_path: str, statistics_path: str | None = None,
                 counts: ScoreCounts | None = None, checkpoint: str | None = None, seconds: float = rules.STATISTICS_SECONDS):
        self.spark = spark
        self.weights_path, self.holdout_path = weights_path, holdout_path
        self.statistics_path = statistics_path or work_path(spark, "statistics")
        self.counts = counts or ScoreCounts(spark)
        self.checkpoint = checkpoint or work_path(spark, "evaluator-ckpt")
        self.seconds = seconds
        self._tick, self._stopped = threading.Lock(), False

    def evaluate(self, evaluation: int) -> bool:
        """One evaluation of the latest version; False if there are no weights yet."""
        row = table_or_empty(self.spark, self.weights_path, WEIGHTS_SCHEMA).orderBy(F.col("version").desc()).first()
        if row is None:
            return False
        version = row["version"]
        fresh = table_or_empty(self.spark, self.holdout_path, FEATURES_SCHEMA).filter(
            F.col("batch_id") > self.counts.counted_upto(version))  # a filter on partitions
        if not fresh.isEmpty():
            scored = sgd.with_online_prediction(fresh, row["weights"]).withColumnRenamed("probability", "score")
            self.counts.add(scored, version)
        stats = self.counts.statistics(version).select(
            F.lit("online").alias("trainer"), F.lit(version).cast("long").alias("model_version"),
            F.lit(f"sgd(version={version})").alias("model"), "area_under_roc", "accuracy", "n",
            F.current_timestamp().alias("ts"), F.lit(evaluation).cast("long").alias("evaluation"))
        put(stats, self.statistics_path, "evaluation")
        return True

    def _on_tick(self, _: DataFrame, batch_id: int) -> None:
        with self._tick:
            if not self._stopped:
                self.evaluate(batch_id)

    def start(self):
        """The running query; end it with ``stop(query)``."""
        self._stopped = False
        ticks = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        return (ticks.writeStream.foreachBatch(self._on_tick).option("checkpointLocation", self.checkpoint)
                .trigger(processingTime=f"{self.seconds} seconds").start())

    def stop(self, query) -> None:
        """Stop between two evaluations; raises what the query failed with."""
        with self._tick:
            self._stopped = True
        query.stop()
        if query.exception() is not None:
            raise query.exception()

    def statistics(self) -> DataFrame:
        """The rows so far, one per evaluation, read between two ticks: a tick replaces the files of an evaluation that is
        there already, and a plan made before it would still look for them."""
        with self._tick:
            rows = table_or_empty(self.spark, self.statistics_path, STATISTICS_SCHEMA).toArrow()
        return self.spark.createDataFrame(rows, STATISTICS_SCHEMA)


class StatisticsFeed:
    """A subscription to a statistics table.

    Subscribing notes which rows exist and delivers the latest one of the batch trainer; the stream then
    delivers every row that is not among them, once, even if its file is written again. Delivered rows
    are a table by delivery (-1: the row on subscription), with the message as JSON. A subscription
    that is opened again on its folder goes on where it stopped.
    """

    KEY = ["trainer", "model_version", "evaluation"]

    def __init__(self, spark: SparkSession, statistics_path: str, folder: str | None = None, schema: str = STATISTICS_SCHEMA):
        self.spark, self.path, self.schema = spark, statistics_path, schema
        self.folder = (folder or work_path(spark, "feed")).rstrip("/")
        self.columns = spark.createDataFrame([], schema).columns

    def _deliver(self, rows: DataFrame, delivery: int) -> None:
        message = rows.select(*self.columns, F.to_json(F.struct(*self.columns)).alias("message"),
                              F.lit(delivery).cast("long").alias("delivery"))
        put(message, f"{self.folder}/delivered", "delivery")

    def delivered(self) -> DataFrame:
        return table_or_empty(self.spark, f"{self.folder}/delivered", f"{self.schema}, message string, delivery long")

    def subscribe(self) -> None:
        before = table_or_empty(self.spark, f"{self.folder}/before", f"{self.schema}, noted boolean")
        if not before.isEmpty():
            return
        existing = table_or_empty(self.spark, self.path, self.schema)
        none = self.spark.createDataFrame([tuple([None] * len(self.columns) + [False])], f"{self.schema}, noted boolean")
        # one marker row, so that an empty table counts as noted, too
        existing.withColumn("noted", F.lit(True)).unionByName(none).write.mode("overwrite").parquet(f"{self.folder}/before")
        noted = self.spark.read.schema(f"{self.schema}, noted boolean").parquet(f"{self.folder}/before").filter("noted")
        latest = metrics.latest_statistics(noted.filter(F.col("trainer") == "batch").select(*self.columns))
        self._deliver(latest, -1)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        before = self.spark.read.schema(f"{self.schema}, noted boolean").parquet(f"{self.folder}/before").select(*self.KEY)
        sent = self.delivered().filter((F.col("delivery") >= 0) & (F.col("delivery") < batch_id)).select(*self.KEY)
        new = batch.dropDuplicates(self.KEY).join(before.unionByName(sent), self.KEY, "left_anti")
        self._deliver(new, batch_id)

    def run(self, available_now: bool = True):
        """Subscribe (the first time) and deliver what is new: all there is (``available_now``), or until stopped."""
        self.subscribe()
        stream = self.spark.readStream.schema(self.schema).option("ignoreMissingFiles", True).parquet(self.path)
        writer = stream.writeStream.foreachBatch(self._process).option("checkpointLocation", f"{self.folder}/checkpoint")
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")
        query = writer.start()
        if available_now:
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()
        return query
