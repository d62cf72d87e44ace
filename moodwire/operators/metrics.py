"""Model metrics as DataFrame jobs: AUC of ROC and PR, accuracy, precision/recall.

The areas need, for each distinct score, how many positives and negatives
score higher: a running sum in score order. A window without a partition key
would pull every distinct score into one task, so the running sum is
distributed instead (``running_totals``): range-partition the per-score
counts, total each partition, prefix-sum the few partition totals, and add
each partition's offset to a window that runs inside the partition only.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodwire.session import checkpoint_dir


ROWS_PER_RANGE = 1_000_000


def score_counts(scored: DataFrame, score_col: str = "score", label_col: str = "label") -> DataFrame:
    """(score, pos, neg): one row per distinct score, partial aggregation first."""
    return scored.groupBy(F.col(score_col).cast("double").alias("score")).agg(
        F.sum(F.when(F.col(label_col) > 0.5, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label_col) > 0.5, 0).otherwise(1)).cast("long").alias("neg"))


def running_totals(df: DataFrame, order_col: str, cols: list[str], descending: bool = True,
                   partitions: int | None = None) -> DataFrame:
    """Add ``cum_<c>``: the sum of ``c`` over all rows up to and including this one
    in ``order_col`` order (keys must be distinct). Distributed prefix sum."""
    spark = df.sparkSession
    df = df.persist(StorageLevel.MEMORY_AND_DISK)  # the upstream runs once: the count and the ranges read this
    n = partitions or max(1, -(-df.count() // ROWS_PER_RANGE))
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    checkpoint_dir(spark)
    # reliable checkpoint: partition ids stay fixed even if an executor is lost and work is redone
    ranged = df.repartitionByRange(n, order).withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    df.unpersist()
    totals = ranged.groupBy("__pid").agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}")
                                       for c in cols])
    inside = Window.partitionBy("__pid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # offsets has one row per partition: its size is bounded by the partition count
    out = ranged.join(F.broadcast(offsets), "__pid")
    for c in cols:
        out = out.withColumn(f"cum_{c}", F.col(f"__o_{c}") + F.sum(c).over(inside))
    return out.drop("__pid", *[f"__o_{c}" for c in cols])


def _safe_div(a, b):
    return F.when(b != 0, a / b)


def auc_roc(scored: DataFrame, score_col: str = "score", label_col: str = "label") -> DataFrame:
    """Area under ROC (trapezoids; tied scores count half), one row ``auc_roc``."""
    return auc_of_counts(score_counts(scored, score_col, label_col))


def auc_of_counts(counts: DataFrame) -> DataFrame:
    """``auc_roc`` from (score, pos, neg), one row per score; counts of batches may be added up before."""
    cum = running_totals(counts, "score", ["pos"])
    per_score = cum.select((F.col("neg") * (F.col("cum_pos") - F.col("pos") * 0.5)).alias("area"),
                           "pos", "neg")
    agg = per_score.agg(F.sum("area").alias("area"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(_safe_div(F.col("area"), F.col("p") * F.col("n")).alias("auc_roc"))


def auc_pr(scored: DataFrame, score_col: str = "score", label_col: str = "label") -> DataFrame:
    """Area under the precision-recall curve as Spark's binary metrics define it:
    points from the highest score down, first point (0, precision at the top),
    trapezoids over recall."""
    cum = running_totals(score_counts(scored, score_col, label_col), "score", ["pos", "neg"])
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    prec = tp / (tp + fp)
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    prev = F.when(tp0 + fp0 == 0, prec).otherwise(tp0 / (tp0 + fp0))
    per_score = cum.select((F.col("pos") * (prec + prev) / 2).alias("area"), "pos")
    agg = per_score.agg(F.sum("area").alias("area"), F.sum("pos").alias("p"))
    return agg.select(_safe_div(F.col("area"), F.col("p")).alias("auc_pr"))


def accuracy(scored: DataFrame, prediction_col: str = "prediction", label_col: str = "label") -> DataFrame:
    return scored.agg(F.avg((F.col(label_col) == F.col(prediction_col)).cast("double")).alias("accuracy"),
                      F.count(F.lit(1)).alias("n"))


def balanced_accuracy(scored: DataFrame, prediction_col: str = "prediction", label_col: str = "label") -> DataFrame:
    pos = F.col(label_col) > 0.5
    hit = F.col(label_col) == F.col(prediction_col)
    agg = scored.agg(F.sum(F.when(pos & hit, 1).otherwise(0)).alias("tp"), F.sum(F.when(pos, 1).otherwise(0)).alias("p"),
                     F.sum(F.when(~pos & hit, 1).otherwise(0)).alias("tn"),
                     F.sum(F.when(~pos, 1).otherwise(0)).alias("n"))
    return agg.select(((_safe_div(F.col("tp"), F.col("p")) + _safe_div(F.col("tn"), F.col("n"))) / 2)
                      .alias("balanced_accuracy"))


def precision_recall(scored: DataFrame, prediction_col: str = "prediction", label_col: str = "label") -> DataFrame:
    """Per class: precision and recall, from one confusion-matrix pass; plus an
    overall row (class NULL) whose precision and recall both equal accuracy."""
    cm = scored.groupBy(F.col(label_col).cast("double").alias("label"),
                        F.col(prediction_col).cast("double").alias("prediction")).agg(F.count(F.lit(1)).alias("c"))
    checkpoint_dir(scored.sparkSession)
    cm = cm.checkpoint(eager=True)  # classes x classes rows; read five times below
    classes = cm.select(F.col("label").alias("class")).union(cm.select(F.col("prediction").alias("class"))).distinct()
    tp = cm.filter(F.col("label") == F.col("prediction")).select(F.col("label").alias("class"), F.col("c").alias("tp"))
    actual = cm.groupBy(F.col("label").alias("class")).agg(F.sum("c").alias("actual"))
    predicted = cm.groupBy(F.col("prediction").alias("class")).agg(F.sum("c").alias("predicted"))
    per = (classes.join(tp, "class", "left").join(actual, "class", "left").join(predicted, "class", "left")
           .select("class", F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("actual", F.lit(0)).alias("actual"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted")))
    per = per.select("class", _safe_div(F.col("tp"), F.col("predicted")).cast("double").alias("precision"),
                     _safe_div(F.col("tp"), F.col("actual")).cast("double").alias("recall"))
    overall = cm.agg((F.sum(F.when(F.col("label") == F.col("prediction"), F.col("c")).otherwise(0)) / F.sum("c"))
                     .alias("a")).select(F.lit(None).cast("double").alias("class"), F.col("a").alias("precision"),
                                         F.col("a").alias("recall"))
    return per.unionByName(overall)


def statistics_row(scored: DataFrame, trainer: str, model: str, version: int, score_col: str = "score",
                   prediction_col: str = "prediction", label_col: str = "label") -> DataFrame:
    """One statistics row (trainer, model_version, model, area_under_roc, accuracy, n, ts)."""
    data = scored.select(score_col, prediction_col, label_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        auc = auc_roc(data, score_col, label_col).collect()[0]["auc_roc"]
        acc = accuracy(data, prediction_col, label_col).collect()[0]
    finally:
        data.unpersist()
    spark = scored.sparkSession
    return spark.createDataFrame(
        [(trainer, int(version), model, auc, acc["accuracy"], int(acc["n"]))],
        "trainer string, model_version long, model string, area_under_roc double, accuracy double, n long",
    ).withColumn("ts", F.current_timestamp())


def latest_statistics(stats: DataFrame) -> DataFrame:
    """Latest row per trainer (highest model_version)."""
    cols = [c for c in stats.columns if c != "trainer"]
    latest = stats.groupBy("trainer").agg(F.max_by(F.struct(*cols), F.col("model_version")).alias("s"))
    return latest.select("trainer", *[F.col(f"s.{c}").alias(c) for c in cols])


def accuracy_history(stats: DataFrame) -> DataFrame:
    """Per trainer, evaluations in order of arrival, accuracy in percent with two decimals."""
    w = Window.partitionBy("trainer").orderBy("model_version")
    return stats.select("trainer", "model_version", F.row_number().over(w).alias("point"),
                        (F.floor(F.col("accuracy") * 10000 + 0.5) / 100).alias("accuracy_percent"))
