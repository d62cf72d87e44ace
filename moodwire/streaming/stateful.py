"""Online training with the model in the state store.

``online.OnlineTrainer`` keeps versions in a table and spreads the descent of a micro-batch over the
cluster, a job per step. Here the model is the state of a streaming operator, so that weights and
source offsets are committed together: a query that is killed at any point goes on from the last committed
micro-batch, and what it writes again is what it wrote before.

The features are computed and packed where the rows lie; the packed rows of a model meet its state in one
task, which runs the whole descent (no jobs per step). The size of a micro-batch is therefore bounded by the
source (``maxFilesPerTrigger`` or ``maxBytesPerTrigger``), as for any one-second stream; larger batches are
``OnlineTrainer``'s. Models with different keys train in parallel, each on its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from moodwire.functions import rules
from moodwire.operators import features, sgd
from moodwire.session import work_path
from moodwire.streaming.evaluation import put, table_or_empty
from moodwire.streaming.online import labelled_stream, spread

VERSIONS = "model string, weights array<double>, iterations int, converged boolean, rows long, version long"
STATE = "weights binary, version long"


class StatefulTrainer:
    """Logistic regression by descent on each micro-batch, from the weights of the one before.

    ``model`` names the model a row trains (a Column over the labelled tweets; by default all train one).
    A model's versions count the micro-batches that held rows of it, from 0.
    """

    def __init__(self, spark: SparkSession, weights_path: str | None = None, checkpoint: str | None = None,
                 num_features: int = rules.ONLINE_FEATURES, iterations: int = rules.SGD_ITERATIONS, step: float = rules.SGD_STEP,
                 reg_param: float = 0.0, idf: list[float] | None = None, model: Column | None = None):
        self.spark = spark
        self.weights_path = weights_path or work_path(spark, "state-weights")
        self.checkpoint = checkpoint or work_path(spark, "state-ckpt")
        self.num_features, self.iterations, self.step, self.reg_param = num_features, iterations, step, reg_param
        self.idf = idf
        self.model = F.lit("online") if model is None else model

    def versions_stream(self, labelled: DataFrame) -> DataFrame:
        """Labelled tweets -> a row per model and micro-batch: the next version."""
        tf = features.with_text_java_tf(spread(labelled), num_features=self.num_features)
        made = features.with_tf_idf(tf, self.idf) if self.idf is not None else tf
        rows = made.select(self.model.cast("string").alias("model"), "label", "idx", "val")

        def pack(batches):
            import pyarrow as pa
            import pyarrow.compute as pc

            def of(batch, name):
                for out in sgd._pack_batches("label", "idx", "val")([batch]):
                    yield out.append_column("model", pa.array([name] * out.num_rows, pa.string()))

            for batch in batches:
                models = batch.column("model")
                for name in models.unique():
                    yield from of(batch.filter(models.is_null() if name.as_py() is None else pc.equal(models, name)), name.as_py())

        def advance(key: tuple, frames: Iterator, state: GroupState):
            import numpy as np
            import pandas as pd

            packed = [sgd._arrays(row) for frame in frames for row in frame.to_dict("records")]
            weights, version = state.get if state.exists else (np.zeros(self_features).tobytes(), -1)
            model = sgd.descend(packed, np.frombuffer(weights, np.float64), iterations, step, reg_param)
            state.update((np.asarray(model.weights).tobytes(), version + 1))
            yield pd.DataFrame([(key[0], model.weights, model.iterations, model.converged, model.rows, version + 1)],
                               columns=["model", "weights", "iterations", "converged", "rows", "version"])

        self_features, iterations, step, reg_param = self.num_features, self.iterations, self.step, self.reg_param
        return (rows.mapInArrow(pack, f"{sgd.PACKED_SCHEMA}, model string").groupBy("model")
                .applyInPandasWithState(advance, VERSIONS, STATE, "append", GroupStateTimeout.NoTimeout))

    def _store(self, batch: DataFrame, batch_id: int) -> None:
        put(batch, self.weights_path, "model", "version")

    def run(self, stream: DataFrame, available_now: bool = True):
        writer = (self.versions_stream(labelled_stream(stream)).writeStream.foreachBatch(self._store).outputMode("append")
                  .option("checkpointLocation", self.checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")
        query = writer.start()
        if available_now:
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()
        return query

    def versions(self) -> DataFrame:
        return table_or_empty(self.spark, self.weights_path, VERSIONS)
