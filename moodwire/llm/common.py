"""Helpers shared by the operators: document reading, written tables, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.session import work_path
from moodwire.sources.tables import table

SPACE = r"[\x20\x09-\x0D]+"  # fixed value: the white space of the contracts, as a Java pattern
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared checkpoint folder: lineage ends there,
    so a lost executor costs a re-read and iterations do not grow the plan. A pre-aggregated side
    that is written first also lets adaptive execution split the other side's hot keys in a join."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(prefix: str) -> str:
    """A column name that no caller's table has."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def utf8_sha256(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(a, b) edges between orderable ids -> (node, comp): comp is the smallest id of the component.

    Rounds of: smallest neighbour label per node, then one pointer jump (label of the label), so the
    rounds grow with the logarithm of the longest chain. All state is in written tables; nothing but
    one count per round reaches the driver. Per-node minima are pre-aggregated map-side, and a hub's
    rows meet only in joins that adaptive execution splits.
    """
    e = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = written(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("comp")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        hooked = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("up"))
        # the jump: the label's own label (the label is a node of the same component)
        over = labels.select(F.col("node").alias("up"), F.col("comp").alias("jump"))
        nxt = written(hooked.join(over, "up").select("node", F.least("up", "jump").alias("comp"),
                                                     (F.least("up", "jump") != F.col("comp")).alias("moved")),
                      f"{name}-{step}")
        moved = nxt.where("moved").limit(1).count()
        labels = nxt.select("node", "comp")
        if not moved:
            return labels
