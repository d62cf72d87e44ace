"""Structured Streaming jobs: class-capped corpus collection and online SGD training.

Both are ``readStream -> filter -> label -> foreachBatch``. State lives in
tables under the shared checkpoint folder, never in driver memory:

* the corpus table, partitioned by ``batch_id``; a replayed batch overwrites
  its own partition, so the sink is idempotent;
* the weights table, one row per ``version`` (= batch id); a replayed batch
  recomputes from version ``batch_id - 1``, so a restart after a lost
  executor or driver gives the same weights.

Only per-batch class counts (two numbers) and the weight vector (its length
is the bucket count) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from moodwire.functions import rules
from moodwire.operators import corpus, features, sgd
from moodwire.session import work_path

STATUS_SCHEMA = "tweet_id long, ts timestamp, text string, lang string, is_retweet boolean"


def land_in_order(df: DataFrame, staging: str, path: str, ranges: int) -> Iterator[int]:
    """Lay a status table out as a replayable source, one range of ``ts`` after another.

    One parallel pass writes the table to ``staging``, partitioned by range; then each range is
    copied to ``path`` by as many tasks as it has files, and its number is yielded. A stream that is
    run after each yield takes one range as one micro-batch, in arrival order, read in parallel.
    """
    spark = df.sparkSession
    bounds = df.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if bounds["lo"] is None:
        return
    lo, hi = bounds["lo"], bounds["hi"]
    span = (hi - lo).total_seconds() + 1.0
    pos = (F.unix_micros("ts") - F.lit(int(lo.timestamp() * 1_000_000))) / 1e6
    part = F.least(F.floor(pos * ranges / span), F.lit(ranges - 1)).cast("int")
    df.withColumn("__range", part).write.partitionBy("__range").parquet(staging)
    staged = spark.read.schema(f"{STATUS_SCHEMA}, __range int").parquet(staging)
    for i in range(ranges):
        staged.filter(F.col("__range") == i).drop("__range").write.mode("append").parquet(path)
        yield i


def status_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The landed files as a stream; by default a micro-batch takes all that have arrived."""
    reader = spark.readStream.schema(STATUS_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def labelled_stream(stream: DataFrame) -> DataFrame:
    """Tracked terms, English originals, distant label (the same plan as the batch corpus)."""
    return corpus.with_distant_label(corpus.english_originals(corpus.tracked(stream)))


def spread(labelled: DataFrame) -> DataFrame:
    """The rows of a micro-batch dealt to all cores before the text chain: what arrived in one file, or lies in one
    row group of it, would be cleaned and hashed by one task."""
    return labelled.repartition(labelled.sparkSession.sparkContext.defaultParallelism)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table at ``path``; None if nothing was written there yet. Any other failure to read raises:
    taken for an empty table it would start the caps or the weights anew."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# ----------------------------------------------------------------------------- corpus collection

def committed(query) -> int:
    """The last micro-batch that the query has committed, -1 for none. (A progress report follows the commit
    of its batch; one without a commit is a trigger that found no data, its batch is still to come.)"""
    last = query.lastProgress
    if last is None:
        return -1
    return last["batchId"] if "commitOffsets" in last["durationMs"] else last["batchId"] - 1


@dataclass
class CollectorState:
    filled_by: int | None = None  # the batch that filled both classes
    processed: list[int] = field(default_factory=list)

    @property
    def full(self) -> bool:
        return self.filled_by is not None


PROGRESS_SCHEMA = "pos long, neg long, positives long, negatives long, batch_id long"


class CorpusCollector:
    """Collect a class-balanced corpus from a status stream: per batch, append rows of a
    class while it is below ``target // 2`` (exact cap, arrival order), stop once both are full.

    One job runs over the rows of a batch: it writes them, and the class counts are observed as they are
    written. A one-row progress table holds the running totals per batch, so the corpus is never read
    again; a replayed batch starts from the totals before it and overwrites its own rows.
    """

    def __init__(self, spark: SparkSession, corpus_path: str | None = None, checkpoint: str | None = None,
                 target: int = rules.CORPUS_TARGET, progress_path: str | None = None):
        self.spark = spark
        self.corpus_path = corpus_path or work_path(spark, "corpus")
        self.progress_path = progress_path or f"{self.corpus_path.rstrip('/')}-progress"
        self.checkpoint = checkpoint or work_path(spark, "corpus-ckpt")
        self.half = target // 2
        self.state = CollectorState()
        self._last: tuple[int, dict[float, int]] | None = None  # (batch, totals after it) of this run

    def totals_before(self, batch_id: int) -> dict[float, int]:
        """Rows of each class that the batches before ``batch_id`` have collected."""
        if self._last is not None and self._last[0] < batch_id:
            return self._last[1]
        table = _table(self.spark, self.progress_path, PROGRESS_SCHEMA)
        row = None if table is None else (table.filter(F.col("batch_id") < batch_id)
                                          .orderBy(F.col("batch_id").desc()).first())
        return {1.0: row["positives"], 0.0: row["negatives"]} if row else {1.0: 0, 0.0: 0}

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch. It is observed in its own session (a stream clones one): a session that has
        observed something cannot score with ml models fitted in it later (their summaries hold the session)."""
        self.state.processed.append(batch_id)
        have = self.totals_before(batch_id)
        room = {lab: max(self.half - have[lab], 0) for lab in (0.0, 1.0)}
        if room[0.0] == 0 and room[1.0] == 0:
            return  # full before this batch
        first = corpus.first_per_class(batch, max(room.values()), rank="__r")
        capped = (first.filter(((F.col("label") == 1.0) & (F.col("__r") <= room[1.0]))
                               | ((F.col("label") == 0.0) & (F.col("__r") <= room[0.0])))
                  .drop("__r").withColumn("batch_id", F.lit(batch_id).cast("long")))
        seen = Observation()
        count = lambda lab: F.count(F.when(F.col("label") == lab, 1))
        (capped.observe(seen, count(1.0).alias("pos"), count(0.0).alias("neg"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.corpus_path))
        new = seen.get
        after = {1.0: have[1.0] + new["pos"], 0.0: have[0.0] + new["neg"]}
        row = self.spark.createDataFrame([(new["pos"], new["neg"], after[1.0], after[0.0], batch_id)], PROGRESS_SCHEMA)
        (row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(self.progress_path))
        self._last = (batch_id, after)
        if min(after.values()) >= self.half:
            self.state.filled_by = batch_id

    def run(self, stream: DataFrame, available_now: bool = True, timeout: float | None = None) -> DataFrame:
        """Run until both classes are full, the input is exhausted (``available_now``) or
        ``timeout`` seconds have passed (1-second micro-batches otherwise).

        The stop is graceful: the batch that filled the classes is committed first, so a query started again on
        the same checkpoint goes on behind it. A corpus that is full already starts no query.
        """
        import time

        if min(self.totals_before(1 << 62).values()) >= self.half:
            return self.corpus()
        writer = (labelled_stream(stream).writeStream.foreachBatch(self._process)
                  .option("checkpointLocation", self.checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")
        query = writer.start()
        deadline = None if timeout is None else time.monotonic() + timeout
        while query.isActive:
            if self.state.full and committed(query) >= self.state.filled_by:
                query.stop()  # the session stays
            elif deadline is not None and time.monotonic() >= deadline:
                query.stop()
            else:
                query.awaitTermination(0.05)
        if query.exception() is not None:
            raise query.exception()
        return self.corpus()

    def corpus(self) -> DataFrame:
        """The collected rows; empty if none were."""
        table = _table(self.spark, self.corpus_path, f"{STATUS_SCHEMA}, label double, batch_id long")
        return self.spark.createDataFrame([], f"{STATUS_SCHEMA}, label double, batch_id long") if table is None else table

    def progress(self) -> DataFrame:
        """Per batch that collected something: positives and negatives collected so far."""
        table = _table(self.spark, self.progress_path, PROGRESS_SCHEMA)
        if table is None:
            table = self.spark.createDataFrame([], PROGRESS_SCHEMA)
        return table.filter(F.col("pos") + F.col("neg") > 0).select("batch_id", "positives", "negatives")


# ----------------------------------------------------------------------------- online training

class OnlineTrainer:
    """Streaming logistic regression: each micro-batch runs SGD from the previous
    version's weights and writes the next version."""

    def __init__(self, spark: SparkSession, weights_path: str | None = None, checkpoint: str | None = None,
                 num_features: int = rules.ONLINE_FEATURES, iterations: int = rules.SGD_ITERATIONS,
                 step: float = rules.SGD_STEP, reg_param: float = 0.0, idf: list[float] | None = None,
                 holdout: DataFrame | None = None, evaluate_every: int = 1, statistics_path: str | None = None,
                 evaluate_seconds: float | None = None, score_idf: list[float] | None = None):
        self.spark = spark
        self.weights_path = weights_path or work_path(spark, "weights")
        self.checkpoint = checkpoint or work_path(spark, "weights-ckpt")
        # periodic evaluation: every k-th version is scored on ``holdout`` (labelled tweets with
        # a ``text`` column) and one statistics row is appended
        self.holdout = holdout
        self._holdout_features: DataFrame | None = None
        self.evaluate_every = max(1, evaluate_every)
        self.evaluate_seconds = evaluate_seconds  # if given, evaluations go by the clock instead
        self._evaluated_at = float("-inf")
        # features to score on; the original trained on term frequencies and scored on TF-IDF
        self.score_idf = score_idf if score_idf is not None else idf
        self.statistics_path = statistics_path or work_path(spark, "statistics")
        self.num_features = num_features
        self.iterations = iterations
        self.step = step
        self.reg_param = reg_param
        self.idf = idf  # None: train on term frequencies, as the stream did

    def weights_before(self, version: int) -> list[float]:
        table = _table(self.spark, self.weights_path, "weights array<double>, version long")
        rows = [] if table is None else (table.filter(F.col("version") < version)
                                         .orderBy(F.col("version").desc()).limit(1).collect())
        return list(rows[0]["weights"]) if rows else [0.0] * self.num_features

    def features(self, batch: DataFrame, idf: list[float] | None) -> DataFrame:
        tf = features.with_text_java_tf(batch, num_features=self.num_features)
        return features.with_tf_idf(tf, idf) if idf is not None else tf

    def _evaluation_due(self, batch_id: int) -> bool:
        import time

        if self.evaluate_seconds is None:
            return batch_id % self.evaluate_every == 0
        if time.monotonic() - self._evaluated_at < self.evaluate_seconds:
            return False
        self._evaluated_at = time.monotonic()
        return True

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Train on one micro-batch from version ``batch_id - 1`` and write version ``batch_id``."""
        start = self.weights_before(batch_id)
        # counts; the IDF is applied as a step reads them. A text that is null has no buckets, so it has no counts either
        data = self.features(spread(batch), None).select("label", "idx", F.when(F.col("idx").isNotNull(), F.col("val")).alias("val"))
        model = sgd.train_sgd(data, self.num_features, self.iterations, self.step, self.reg_param, start, scale=self.idf)
        if model.rows == 0:
            return  # empty batch: no new version
        row = sgd.weights_frame(self.spark, model, batch_id).withColumn("rows", F.lit(model.rows).cast("long"))
        (row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("version").parquet(self.weights_path))
        if self.holdout is not None and self._evaluation_due(batch_id):
            self.evaluate(model.weights, batch_id)

    def holdout_features(self) -> DataFrame:
        """The hold-out as it is scored (label, idx, val): tokenized once, kept for the later versions."""
        if self._holdout_features is None:
            self._holdout_features = self.features(self.holdout, self.score_idf).select("label", "idx", "val").persist()
        return self._holdout_features

    def evaluate(self, weights: list[float], version: int) -> None:
        """Score the hold-out with ``weights`` and write the statistics row of ``version``
        (idempotent: a replay overwrites its own row)."""
        from moodwire.operators import metrics

        scored = sgd.with_online_prediction(self.holdout_features(), weights).withColumnRenamed(
            "probability", "score")
        stats = metrics.statistics_row(scored, "online", f"sgd(version={version})", version)
        (stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("model_version").parquet(self.statistics_path))

    def statistics(self) -> DataFrame:
        schema = ("trainer string, model string, area_under_roc double, accuracy double, n long, ts timestamp, "
                  "model_version long")
        table = _table(self.spark, self.statistics_path, schema)
        return self.spark.createDataFrame([], schema) if table is None else table

    def run(self, stream: DataFrame, available_now: bool = True):
        writer = (labelled_stream(stream).writeStream.foreachBatch(self.process)
                  .option("checkpointLocation", self.checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")
        query = writer.start()
        if available_now:
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()
        return query

    def versions(self) -> DataFrame:
        """All versions; no rows before the first batch that held any."""
        schema = "weights array<double>, intercept double, iterations int, converged boolean, rows long, version long"
        table = _table(self.spark, self.weights_path, schema)
        return self.spark.createDataFrame([], schema) if table is None else table

    def latest(self) -> DataFrame:
        v = self.versions()
        return v.orderBy(F.col("version").desc()).limit(1)
