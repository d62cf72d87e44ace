"""Principal components of wide sparse rows by randomized subspace iteration.

``pyspark.ml`` PCA builds the full covariance matrix on the driver: a square of the number of buckets, at
most 65,535 of them. Here the covariance is never formed. A basis of ``k + oversample`` directions is sent to
the tasks; each multiplies its rows with it and back (C Q = A'(A Q) / m - mean (mean' Q)), the products are
added in a tree over the executors, and the driver orthonormalizes one tall thin matrix. The basis
turns towards the leading components by the ratio of the eigenvalues per pass; the passes end when the
leading ones no longer turn. Memory anywhere is ``num_features * (k + oversample)`` numbers and one packed buffer.

Like ``pyspark.ml``, rows are centred to find the components but projected as they are. Signs are fixed: the
largest entry of a component (in size, the first of equal ones) is positive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwire.operators import sgd
from moodwire.operators.features import double_array_literal


@dataclass
class PcaModel:
    components: list  # k vectors of num_features numbers, orthonormal
    variances: list[float]  # of the rows along them, descending (population variance)
    mean: list[float]
    rows: int
    passes: int

    def project(self, idx: Column, val: Column) -> Column:
        """The coordinates of a sparse row, as an array of k numbers."""
        return F.array(*[sgd.margin(idx, val, double_array_literal(list(c))) for c in self.components])


def _add(a, b):
    return tuple(x + y for x, y in zip(a, b))


def fit(df: DataFrame, num_features: int, k: int = 3, oversample: int = 10, max_passes: int = 200, tol: float = 1e-10,
        seed: int = 7, idx_col: str = "idx", val_col: str = "val") -> PcaModel:
    """The first ``k`` principal components of (idx, val) rows. An empty table gives no components."""
    import numpy as np

    label = "__no_label"
    packed = (df.select(F.lit(0.0).alias(label), F.col(idx_col).alias("idx"), F.col(val_col).alias("val"))
              .mapInArrow(sgd._pack_batches(label, "idx", "val"), sgd.PACKED_SCHEMA))
    data = packed.rdd.map(sgd._arrays).persist(StorageLevel.MEMORY_AND_DISK)
    context = df.sparkSession.sparkContext
    tasks = sgd.per_core(data)  # a partial product has the size of the basis: one per core, whatever the input
    width = min(k + oversample, num_features)
    k = min(k, num_features)
    try:
        def moments(parts):
            total = np.zeros(num_features)
            for _, _, idx, val in parts:
                total += np.bincount(idx, weights=val, minlength=num_features)
            yield total

        m = int(data.map(lambda p: len(p[1])).sum())  # packs and keeps the rows, a task per partition
        if m == 0:
            return PcaModel([], [], [0.0] * num_features, 0, 0)
        mean = tasks.mapPartitions(moments).treeReduce(np.add) / m

        def times_covariance(q):
            shared = context.broadcast(np.ascontiguousarray(q.T))

            def partial(parts, shared=shared):
                basis = shared.value
                out = np.zeros_like(basis)
                for _, lengths, idx, val in parts:
                    at = idx.astype(np.intp)
                    for j in range(basis.shape[0]):  # a direction at a time: buffers of the size of the non-zeros
                        along = sgd._row_sums(basis[j][at] * val, lengths)
                        out[j] += np.bincount(at, weights=val * np.repeat(along, lengths), minlength=num_features)
                yield (out,)

            product = tasks.mapPartitions(partial).treeReduce(_add)[0].T
            shared.unpersist()
            return product / m - np.outer(mean, mean @ q)

        basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(num_features, width)))
        leading = None
        for passes in range(1, max_passes + 1):
            image = times_covariance(basis)
            values, turn = np.linalg.eigh(basis.T @ image)  # Rayleigh-Ritz within the basis
            order = np.argsort(values)[::-1]
            variances, found = np.maximum(values[order][:k], 0.0), (basis @ turn[:, order])[:, :k]
            settled = leading is not None and all(
                v <= 1e-12 * max(variances[0], 1e-300) or 1 - abs(a @ b) < tol for v, a, b in zip(variances, found.T, leading.T))
            leading = found
            if settled:
                break
            basis, _ = np.linalg.qr(image)
        signs = np.sign(leading[np.argmax(np.abs(leading), axis=0), np.arange(k)])
        return PcaModel([c.tolist() for c in (leading * np.where(signs == 0, 1, signs)).T], variances.tolist(), mean.tolist(), m, passes)
    finally:
        data.unpersist()


def pca_sparse(df: DataFrame, num_features: int, k: int = 3, out: str = "pca", idx_col: str = "idx", val_col: str = "val") -> DataFrame:
    """``df`` with the coordinates of each row along the first ``k`` components (an empty table stays empty)."""
    model = fit(df, num_features, k, idx_col=idx_col, val_col=val_col)
    if not model.components:
        return df.withColumn(out, F.array().cast("array<double>"))
    return df.withColumn(out, model.project(F.col(idx_col), F.col(val_col)))
