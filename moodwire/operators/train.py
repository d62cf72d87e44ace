"""Batch trainers built on ``pyspark.ml``: cross-validated pipeline and scoring."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.functions import rules
from moodwire.functions.tokens import DEFAULT_CHAIN, TextChain
from moodwire.operators import corpus
from moodwire.operators.features import TokenTransformer


def with_folds(data: DataFrame, folds: int, id_col: str = "tweet_id", out: str = "fold") -> DataFrame:
    """Add the fold of each row, 0 to ``folds - 1``, by a stable hash of its id: the same on every run and cluster."""
    return data.withColumn(out, corpus.split_bucket(F.col(id_col), folds).cast("int"))


@dataclass
class TunedModel:
    """A cross-validated grid: (num_features, reg_param, max_iter) per point, mean area per point, and the best
    point refitted on all rows."""

    settings: list[tuple[int, float, int]]
    avgMetrics: list[float]
    bestModel: object


def _cross_validate(data: DataFrame, lr: LogisticRegression, grid: list, folds: int, parallelism: int):
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds,
                        foldCol="fold", parallelism=parallelism)
    return cv.fit(data)


def batch_cv(data: DataFrame, features=rules.BATCH_GRID_FEATURES, regs=rules.BATCH_GRID_REG,
             folds: int = rules.BATCH_FOLDS, max_iter: int = rules.BATCH_MAX_ITER, parallelism: int | None = None,
             id_col: str = "tweet_id") -> TunedModel | None:
    """HashingTF + LogisticRegression tuned by k-fold CV on area under ROC; folds by the hash of the id.

    ``data`` has an id, ``tokens`` and ``label``. The tokens are hashed once per bucket count and kept as
    vectors; the grid's fits read those. The best model is a pipeline that takes tokens. None for an empty table.
    """
    hashers = {n: HashingTF(inputCol="tokens", outputCol=f"tf_{n}", numFeatures=n) for n in features}
    rows = with_folds(data.select(id_col, "tokens", "label"), folds, id_col)
    for hasher in hashers.values():
        rows = hasher.transform(rows)
    cached = rows.drop(id_col, "tokens").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if cached.isEmpty():
            return None
        lr = LogisticRegression(maxIter=max_iter)
        grid = ParamGridBuilder().addGrid(lr.featuresCol, [f"tf_{n}" for n in features]).addGrid(lr.regParam, list(regs)).build()
        # the grid's fits are independent small jobs: run them side by side, at most one per core
        if parallelism is None:
            parallelism = max(1, min(len(grid), data.sparkSession.sparkContext.defaultParallelism))
        found = _cross_validate(cached, lr, grid, folds, parallelism)
        settings = [(int(point[lr.featuresCol].removeprefix("tf_")), float(point[lr.regParam]), max_iter) for point in grid]
        best = found.bestModel
        hasher = hashers[int(best.getFeaturesCol().removeprefix("tf_"))]
        return TunedModel(settings, list(found.avgMetrics), PipelineModel([hasher, best]))
    finally:
        cached.unpersist()


def cv_summary(model: TunedModel | None) -> list[tuple]:
    """(num_features, reg_param, max_iter, avg_auc) per grid point, and which one is best."""
    if model is None:
        return []
    best = model.avgMetrics.index(max(model.avgMetrics))  # of ties the first, as the refit takes
    return [(*point, float(metric), k == best) for k, (point, metric) in enumerate(zip(model.settings, model.avgMetrics))]


def _check_folds(sizes: dict, folds: int) -> None:
    """What ``CrossValidator`` refuses: rows without a fold, and folds without rows on either side."""
    if None in sizes:
        raise ValueError(f"rows without an id have no fold: {sizes[None]}")
    for k in range(folds):
        if not sizes.keys() - {k}:
            raise ValueError(f"The training data at fold {k} is empty.")
        if k not in sizes:
            raise ValueError(f"The validation data at fold {k} is empty.")


def lr_cv_grid(data: DataFrame, max_iters=(0, 1), folds: int = 3, id_col: str = "tweet_id") -> TunedModel | None:
    """LogisticRegression on a ``features`` column, grid on maxIter, 3 folds. None for an empty table.

    What ``CrossValidator`` does, one fit after another, but the folds are read from the kept rows: it would keep a copy
    of both sides of a fold beside them.
    """
    lr = LogisticRegression()
    grid = ParamGridBuilder().addGrid(lr.maxIter, list(max_iters)).build()
    rows = with_folds(data, folds, id_col).select("features", "label", "fold")
    if not data.is_cached:  # a second copy of kept rows would double the memory
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
        if not sizes:
            return None
        _check_folds(sizes, folds)
        areas, evaluator = [[] for _ in grid], BinaryClassificationEvaluator()
        for k in range(folds):
            others, own = rows.filter(F.col("fold") != k), rows.filter(F.col("fold") == k)
            for point, found in zip(grid, areas):
                found.append(evaluator.evaluate(lr.fit(others, point).transform(own, point)))
        mean = [float(a) for a in np.mean(areas, axis=1)]
        return TunedModel([(-1, -1.0, int(m)) for m in max_iters], mean, lr.fit(rows, grid[int(np.argmax(mean))]))
    finally:
        if not data.is_cached:
            rows.unpersist()


def fold_scores(data: DataFrame, max_iter: int, folds: int = 3, id_col: str = "tweet_id") -> DataFrame:
    """What cross validation sees: every row (id, fold, label) scored by the model of the other folds."""
    rows = with_folds(data, folds, id_col)
    parts = []
    for k in range(folds):
        model = LogisticRegression(maxIter=max_iter).fit(rows.filter(F.col("fold") != k))
        parts.append(model.transform(rows.filter(F.col("fold") == k)).select(
            id_col, "fold", "label", vector_to_array("probability").getItem(1).alias("score")))
    return functools.reduce(DataFrame.unionByName, parts)


def predict_batch(model, tweets: DataFrame, keep=("tweet_id",)) -> DataFrame:
    """(tweet, prediction, probability of the positive class), plus the ``keep`` columns
    present in the input; stays distributed. Without a model (trained on an empty corpus) no rows."""
    extra = [c for c in keep if c in tweets.columns]
    if model is None:
        none = F.lit(None).cast("double")
        return tweets.select(*extra, "tweet", none.alias("prediction"), none.alias("score")).limit(0)
    out = model.transform(tweets)
    return out.select(*extra, F.col("tweet"), F.col("prediction"),
                      vector_to_array(F.col("probability")).getItem(1).alias("score"))


def default_pipeline(data: DataFrame) -> PipelineModel | None:
    """Pipeline(HashingTF, LogisticRegression) with default parameters. None for an empty table."""
    if data.isEmpty():
        return None
    hasher = HashingTF(inputCol="tokens", outputCol="features")
    kept = hasher.transform(data).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:  # the rows are hashed once; the passes of the fit read the vectors
        return PipelineModel([hasher, LogisticRegression().fit(kept)])
    finally:
        kept.unpersist()


def save_model(model: PipelineModel, folder: str, version: int) -> None:
    """Save a fitted pipeline as ``version`` under ``folder``; the row in the versions table comes
    last, so a reader never finds a half-written model."""
    path = f"{folder}/models/{version}"
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(int(version), path)], "version long, path string").coalesce(1).write.mode("append").parquet(
        f"{folder}/versions")


def raw_text_model(model: PipelineModel, chain: TextChain = DEFAULT_CHAIN, text_col: str = "tweet") -> PipelineModel:
    """A fitted pipeline on tokens, preceded by the text chain: it takes raw text, also after saving and loading."""
    return PipelineModel([TokenTransformer(chain, text_col, "tokens"), *model.stages])


def load_latest(spark: SparkSession, folder: str) -> tuple[int, PipelineModel]:
    """(version, model) of the highest saved version."""
    row = spark.read.parquet(f"{folder}/versions").orderBy(F.col("version").desc()).first()
    return row["version"], PipelineModel.load(row["path"])


def pca(df: DataFrame, k: int = 3, input_col: str = "features") -> DataFrame:
    """Dense rows of moderate width; wide sparse ones: ``operators.pca``. An empty table stays empty."""
    if df.isEmpty():
        return df.withColumn("pca", F.col(input_col))
    model = PCA(k=k, inputCol=input_col, outputCol="pca").fit(df)
    return model.transform(df)
