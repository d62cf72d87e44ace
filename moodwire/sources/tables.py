"""Readers of the given tables and the tweet-shaped views derived from them.

All readers are lazy ``spark.read.parquet`` scans; Catalyst prunes columns
and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# ---------------------------------------------------------------------------
# Tails planted on each document to form a tweet (index doc_id mod 8).
# The given tables hold no emoticon or http link, so without them every
# distant label would be 0.0. Only a tail is appended; the text stays whole.
# ---------------------------------------------------------------------------
PLANTED_TAILS: list[str] = [
    " :)",
    " :(",
    " :-) @user_42",
    " sooooo baaad http://t.co/x1",
    " u don't &lt;3 it ;)",
    " ❤ super_cool",
    " haha. cannot wait",
    "",
]
STREAM_START = "2026-01-01 00:00:00"  # ts of tweet 0; tweet k arrives k seconds later


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPLIT_SHARE = 4  # tasks per scan partition of a large table whose rows lie unevenly
ROWS_PER_TASK = 2_000  # rows of a task that runs the text chain, about: its Python worker holds all forms of their texts at once


def balance_partitions(df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Spread rows over all cores before CPU-heavy row-local work.

    A scan yields one task per file split, but all rows of a parquet row group go to the split that holds its
    middle: a text table of a few large row groups would run the whole text chain on a few cores, however
    many splits it has. So the splits that hold rows count, not all (their rows are counted from the footers). With
    fewer of them than the cluster's default parallelism, or one of twice the mean, rows are dealt round-robin.
    With ``rows_per_task`` they are also dealt where a split holds more than that, to tasks of about so many: a
    split grows with its table up to the size of a file block, and the longest task of the text chain with it.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits < target and rows_per_task is None:
        return df.repartition(target)
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("split")).count().collect()]
    most = max(rows, default=0)
    if len(rows) >= target and most * len(rows) <= 2 * sum(rows) and (rows_per_task is None or most <= rows_per_task):
        return df
    tasks = max(target, SPLIT_SHARE * splits) if splits >= target else target
    return df.repartition(tasks if rows_per_task is None else max(tasks, -(-sum(rows) // rows_per_task)))


def tweets_from(documents: DataFrame) -> DataFrame:
    """``documents`` as a status table: (tweet_id, ts, text, lang, is_retweet)."""
    tail = F.element_at(F.array(*[F.lit(t) for t in PLANTED_TAILS]),
                        (F.pmod(F.col("doc_id"), F.lit(len(PLANTED_TAILS))) + 1).cast("int"))
    return documents.select(
        F.col("doc_id").alias("tweet_id"),
        (F.to_timestamp(F.lit(STREAM_START)) + F.make_dt_interval(secs=F.col("doc_id"))).alias("ts"),
        F.concat(F.col("text"), tail).alias("text"),
        F.col("lang"),
        (F.pmod(F.col("doc_id"), F.lit(5)) == 0).alias("is_retweet"),
    )


def tweets(spark: SparkSession, sf_dir: str, rows_per_task: int | None = None) -> DataFrame:
    return balance_partitions(tweets_from(table(spark, sf_dir, "documents")), rows_per_task)
