"""The corpus pipeline: quality rules, exact dedup, near-duplicate join, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as parquet and read
again as the next stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.llm import exact_dedup, jaccard_join, packing, quality, queries, secret_scan
from moodwire.llm.common import documents, fresh, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that fail the base rules or lie outside their group's estimate go."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of equal texts the smallest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of connected near-duplicates the smallest doc_id stays."""
    return jaccard_join.drop_near_duplicates(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: every document stays; secrets are replaced by a mark and n_chars follows."""
    base, spans = fresh("base"), fresh("spans")
    found = secret_scan.secret_spans(docs, base_col=base, spans_col=spans)
    clean = F.size(spans) == 0
    text = secret_scan.redacted(F.col("text"), F.col(spans))
    marked = found.withColumn("text", F.when(clean, F.col("text")).otherwise(text))
    return marked.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: pieces of the documents in sequences of at most 4,096 tokens."""
    return packing.pack(docs, queries.tokenizer_path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near duplicates", near_stage),
    ("secret scan", secret_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # outlier estimates, the randomness battery and tokenization have no SQL form; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
