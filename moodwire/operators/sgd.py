"""Logistic regression by full-batch gradient descent on (idx, val) features.

The update rule of the streaming/SGD logistic regression this reproduces:
``w <- w * (1 - eta_i * reg) - eta_i * mean((sigmoid(w.x) - y) x)``,
``eta_i = step / sqrt(i)``, i = 1..iterations, no intercept, stop once
``||w_i - w_{i-1}|| < tol * max(||w_i||, 1)``.

Each iteration is one Spark job over the cached data: every task reduces
its rows with numpy to one partial gradient, and those are added in a tree
over the executors. The driver holds only vectors whose length is the bucket
count (a parameter), never the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwire.functions import rules
from moodwire.operators.features import double_array_literal


@dataclass
class SgdModel:
    weights: list[float]
    intercept: float = 0.0
    iterations: int = 0
    converged: bool = False
    rows: int = 0


def margin(idx: Column, val: Column, weights: Column) -> Column:
    """w.x for a sparse (idx, val) row against a dense weight array."""
    return F.aggregate(F.zip_with(idx, val, lambda i, v: v * F.element_at(weights, i + 1)), F.lit(0.0),
                       lambda a, b: a + b)


PACKED_NNZ = 250_000  # non-zeros of a packed row, about: 3 MB, of which an executor makes several copies per task
PACKED_SCHEMA = "n int, y binary, lengths binary, idx binary, val binary"


def _pack_batches(label_col: str, idx_col: str, val_col: str):
    """mapInArrow body: each Arrow batch of rows becomes one row of flat buffers
    (labels, row lengths, indices, values), so later passes read them without
    converting arrays element by element."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for whole in batches:
            size = 0 if whole.num_rows == 0 else -(-len(whole.column(idx_col).flatten()) // PACKED_NNZ)
            step = max(1, whole.num_rows // max(1, size))  # rows of a packed row: bounded buffers
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                c = batch.column(idx_col)
                lengths = c.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
                idx = c.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                val = batch.column(val_col).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                y = batch.column(label_col).to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.num_rows], pa.int32())] +
                    [pa.array([a.tobytes()], pa.binary()) for a in (y, lengths, idx, val)],
                    names=["n", "y", "lengths", "idx", "val"])

    return run


def _gradient_packed(weights):
    """mapInArrow body over packed rows: the summed gradient of the task's rows as (j, g)."""
    import numpy as np
    import pyarrow as pa

    w = np.asarray(weights, dtype=np.float64)

    def run(batches):
        total = np.zeros(len(w), dtype=np.float64)
        for batch in batches:
            cols = [batch.column(k) for k in ("y", "lengths", "idx", "val")]
            for r in range(batch.num_rows):
                y = np.frombuffer(cols[0][r].as_buffer(), dtype=np.float64)
                lengths = np.frombuffer(cols[1][r].as_buffer(), dtype=np.int32)
                flat_i = np.frombuffer(cols[2][r].as_buffer(), dtype=np.int32)
                flat_v = np.frombuffer(cols[3][r].as_buffer(), dtype=np.float64)
                rows = np.repeat(np.arange(len(y)), lengths)
                margins = np.bincount(rows, weights=w[flat_i] * flat_v, minlength=len(y))
                with np.errstate(over="ignore"):  # exp overflow -> inf -> probability 0, as intended
                    mult = 1.0 / (1.0 + np.exp(-margins)) - y
                total += np.bincount(flat_i, weights=flat_v * mult[rows], minlength=len(w))
        nz = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(nz.astype(np.int32)), pa.array(total[nz])], names=["j", "g"])

    return run


def gradient(data: DataFrame, weights: list[float], label_col: str = "label", idx_col: str = "idx",
             val_col: str = "val") -> DataFrame:
    """(j, g): summed logistic-loss gradient per bucket over all rows of ``data``.

    Each task packs its rows, reduces them with numpy and emits at most
    ``num_features`` partial sums; Spark adds them per bucket (partial
    aggregation, then one small shuffle).
    """
    packed = data.mapInArrow(_pack_batches(label_col, idx_col, val_col), PACKED_SCHEMA)
    partial = packed.mapInArrow(_gradient_packed(list(weights)), "j int, g double")
    return partial.groupBy("j").agg(F.sum("g").alias("g"))


def _smallest(values, *kinds):
    """The same numbers in the first of the types that holds them all: counts are kept in a byte or two."""
    import numpy as np

    for kind in kinds:
        with np.errstate(invalid="ignore", over="ignore"):
            small = values.astype(kind)
        if np.array_equal(small, values):
            return small
    return values


def _arrays(row):
    """A packed row as numpy arrays (labels, row lengths, indices, values), as small as they can be kept."""
    import numpy as np

    y, val = (_smallest(np.frombuffer(row[k], np.float64), np.uint8, np.uint16, np.float32) for k in ("y", "val"))
    return y, np.frombuffer(row["lengths"], np.int32), _smallest(np.frombuffer(row["idx"], np.int32), np.uint16), val


def _row_sums(weighted, lengths):
    """Sums over consecutive runs of the given lengths (0 for none)."""
    import numpy as np

    out = np.zeros(len(lengths))
    some = np.flatnonzero(lengths)
    if len(some):
        out[some] = np.add.reduceat(weighted, (np.cumsum(lengths, dtype=np.int64) - lengths)[some])
    return out


def _add_gradient(total, w, parts, scale=None):
    """Adds the logistic-loss gradient of packed rows (``_arrays`` of each) to ``total``; ``scale``: what the values of
    each bucket are multiplied by."""
    import numpy as np

    for y, lengths, idx, val in parts:
        at = idx.astype(np.intp)
        if scale is not None:
            val = val * scale[at]
        margins = _row_sums(w[at] * val, lengths)
        with np.errstate(over="ignore"):  # exp overflow -> inf -> probability 0, as intended
            mult = 1.0 / (1.0 + np.exp(-margins)) - y
        total += np.bincount(at, weights=val * np.repeat(mult, lengths), minlength=len(w))
    return total


def _partial_gradient(w, scale, parts):
    """A task's share of a step: one partial gradient."""
    import numpy as np

    yield _add_gradient(np.zeros(len(w)), w, parts, scale)


def _held(parts):
    """Rows of a partition of packed rows, and the bytes of their arrays."""
    rows = size = 0
    for arrays in parts:
        rows, size = rows + len(arrays[1]), size + sum(a.nbytes for a in arrays)
    yield rows, size


def descend(packed: list, weights, iterations: int, step: float, reg_param: float = 0.0, tol: float = rules.SGD_CONVERGENCE_TOL) -> SgdModel:
    """The same descent inside one task, over packed rows that it holds (``_arrays`` of each): for micro-batches of a
    bounded size, which two hundred Spark jobs would take longer to schedule than to compute."""
    import numpy as np

    w = np.asarray(weights, dtype=np.float64)
    n = sum(len(lengths) for _, lengths, *_ in packed)
    model, prev = SgdModel(weights=w.tolist(), rows=n), None
    for i in range(1, iterations + 1 if n else 1):
        grad = _add_gradient(np.zeros(len(w)), w, packed)
        eta = step / math.sqrt(i)
        w = w * (1.0 - eta * reg_param) - eta * grad / n
        model.iterations = i
        if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
            model.converged = True
            break
        prev = w
    model.weights = w.tolist()
    return model


def per_core(data):
    """The partitions of a kept RDD in at most one group per core: as many partial results are added up."""
    return data.coalesce(max(1, data.context.defaultParallelism)) if data.getNumPartitions() else data


TASK_BYTES = 4 << 20  # packed rows of a task of a step, about: fewer take less time than another task does


def gathered(data, size: int):
    """A kept RDD of ``size`` bytes of packed rows as the tasks of a step read it: one per core, or groups of about
    ``TASK_BYTES`` where those are fewer. A step over few rows is mostly the start of its tasks. Small groups are
    kept anew, so that each lies where its task runs; many rows are not kept twice."""
    groups = -(-size // TASK_BYTES)
    if groups >= min(data.getNumPartitions(), data.context.defaultParallelism):
        return per_core(data)
    grouped = data.coalesce(groups).persist(StorageLevel.MEMORY_AND_DISK)
    grouped.count()
    return grouped


DRIVER_BYTES = 8 << 20  # partial gradients of a step that the driver may add up itself


def tree_depth(partial_results: int, num_features: int) -> int:
    """1 (the driver adds the partial gradients) while they are small, else 2 (executors add them first): a tree over
    executors costs a second stage per step, which for short vectors is half of the step's time."""
    return 1 if partial_results * num_features * 8 <= DRIVER_BYTES else 2


def train_sgd(df: DataFrame, num_features: int = rules.ONLINE_FEATURES, iterations: int = rules.SGD_ITERATIONS,
              step: float = rules.SGD_STEP, reg_param: float = 0.0, initial_weights: list[float] | None = None,
              tol: float = rules.SGD_CONVERGENCE_TOL, label_col: str = "label", idx_col: str = "idx",
              val_col: str = "val", scale: list[float] | None = None) -> SgdModel:
    """Full-batch gradient descent, one Spark job per iteration over packed, cached data.

    ``scale`` (one number per bucket, such as an IDF vector) multiplies the values as they are read: term counts are
    kept in a byte each, products in eight, and the kept rows go through the Python workers in every step.

    The input is evaluated once: packed as flat buffers where it lies, then kept on the executors' disks, or in memory in
    as few groups as pay. (Many rows in memory fill the heap of an executor, beside which its Python workers need room.) Every iteration
    sends the weights with its tasks (Spark broadcasts a function of more than 1 MB by itself), each task
    returns one partial gradient, and the partial gradients are added by the driver while all of them are at most ``DRIVER_BYTES``, else in a tree over the executors; so the
    driver gets little whatever the number of tasks. (The packed buffers are opaque to SQL, so the loop is the one place
    that works on partitions directly: it saves planning a query two hundred times.)
    """
    import numpy as np

    w = np.asarray(initial_weights if initial_weights is not None else [0.0] * num_features, dtype=np.float64)
    if len(w) != num_features:
        raise ValueError(f"initial weights have {len(w)} entries, expected {num_features}")
    packed = df.select(label_col, idx_col, val_col).mapInArrow(_pack_batches(label_col, idx_col, val_col), PACKED_SCHEMA)
    tasks = data = packed.rdd.map(_arrays).persist(StorageLevel.DISK_ONLY)  # in memory only where it is little: ``gathered``
    factors = None if scale is None else np.asarray(scale, dtype=np.float64)
    try:
        held = data.mapPartitions(_held).collect()
        n = sum(rows for rows, _ in held)
        model = SgdModel(weights=w.tolist(), rows=n)
        if n:
            tasks = gathered(data, sum(size for _, size in held))
            if tasks.is_cached:
                data.unpersist()
        depth = tree_depth(tasks.getNumPartitions(), num_features)
        prev = None
        for i in range(1, iterations + 1 if n else 1):
            # the weights travel with the function: a broadcast per step costs more
            grad = tasks.mapPartitions(partial(_partial_gradient, w, factors)).treeReduce(np.add, depth)
            eta = step / math.sqrt(i)
            w = w * (1.0 - eta * reg_param) - eta * grad / n
            model.iterations = i
            if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
                model.converged = True
                break
            prev = w
        model.weights = w.tolist()
        return model
    finally:
        data.unpersist()
        if tasks.is_cached:
            tasks.unpersist()


def with_online_prediction(df: DataFrame, weights: list[float], intercept: float = 0.0, idx_col: str = "idx",
                           val_col: str = "val", threshold: float | None = 0.5) -> DataFrame:
    """Score with a weight vector: probability, and the class ``probability > threshold``."""
    w = double_array_literal(weights)
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-(margin(F.col(idx_col), F.col(val_col), w) + F.lit(intercept))))
    out = df.withColumn("probability", prob)
    if threshold is None:
        return out.withColumn("prediction", F.col("probability"))
    return out.withColumn("prediction", F.when(F.col("probability") > threshold, 1.0).otherwise(0.0))


def weights_frame(spark, model: SgdModel, version: int = 0) -> DataFrame:
    """The model as a one-row table (version, weights, intercept, iterations)."""
    return spark.createDataFrame(
        [(int(version), [float(x) for x in model.weights], float(model.intercept), int(model.iterations),
          bool(model.converged))],
        "version long, weights array<double>, intercept double, iterations int, converged boolean")
