"""Hashed term-frequency and TF-IDF features.

Two encodings of a sparse feature vector:

* ``VectorUDT`` from ``pyspark.ml.feature.HashingTF`` (Murmur3 index), used by
  the ML pipeline (batch trainer);
* two parallel arrays ``idx array<int>`` / ``val array<double>`` (sorted by
  index) with the Java ``String.hashCode`` index the older Spark hashing
  used. It is plain SQL, so DuckDB can check it, and the SGD trainer and
  the online scorer consume it directly.

The IDF vector has one entry per bucket, so its size is bounded by
``num_features`` whatever the corpus size; it is computed with one partial
aggregation and applied as one literal array.
"""

from __future__ import annotations

import json

from pyspark.ml import Transformer
from pyspark.ml.feature import HashingTF
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwire.functions import batches, rules
from moodwire.functions.tokens import DEFAULT_CHAIN, TextChain
from moodwire.operators import corpus


def java_hash(token: Column) -> Column:
    """Java ``String.hashCode`` of a token, as a signed int; null of null."""
    return F.arrow_udf(batches.java_hash, "int")(token)


def term_index(token: Column, num_features: int) -> Column:
    return F.pmod(java_hash(token), F.lit(num_features))


def with_java_tf(df: DataFrame, tokens_col: str = "tokens", num_features: int = rules.ONLINE_FEATURES,
                 idx: str = "idx", val: str = "val") -> DataFrame:
    """Term counts per bucket as sorted (idx, val) arrays; row-local, no shuffle.

    Tokens are hashed and counted batch by batch in Arrow tasks, a distinct token of a piece once.
    """
    return _with_counts(df, F.col(tokens_col), num_features, idx, val)


def with_text_java_tf(df: DataFrame, text_col: str = "text", chain: TextChain = DEFAULT_CHAIN,
                      num_features: int = rules.ONLINE_FEATURES) -> DataFrame:
    """``with_java_tf`` of a text's tokens, for rows whose tokens are not needed: they are hashed without being
    written out, batch by batch in the Arrow tasks that find them."""
    hashes = chain.hashes_of(F.col("__normalized"))
    if hashes is None:
        return with_java_tf(corpus.with_tokens(df, text_col, "__tokens", chain), "__tokens", num_features).drop("__tokens")
    staged = df.withColumn("__normalized", chain.normalize(F.col(text_col)))
    return _with_counts(staged, hashes, num_features, "idx", "val").drop("__normalized")


def _with_counts(df: DataFrame, tokens: Column, num_features: int, idx: str, val: str) -> DataFrame:
    made = f"__{idx}_counts"
    counts = F.arrow_udf(lambda tokens: batches.term_counts(tokens, num_features), "idx array<int>, val array<double>")
    return (df.withColumn(made, counts(tokens))
            .withColumn(idx, F.col(made)["idx"])
            .withColumn(val, F.coalesce(F.col(made)["val"], F.array(F.lit(None).cast("double"))))
            .drop(made))


def doc_frequency(df: DataFrame, idx_col: str = "idx") -> DataFrame:
    """Number of rows that contain each bucket: (idx, df). Partial aggregation
    first, so at most ``num_features`` rows per map partition are shuffled.

    The outer explode is deliberate: from a plain one Catalyst infers ``size(idx) > 0`` and pushes
    that filter below the projections, which writes the whole text chain out inside it, again and again.
    """
    return (df.select(F.explode_outer(F.col(idx_col)).alias("idx")).where(F.col("idx").isNotNull())
            .groupBy("idx").agg(F.count(F.lit(1)).alias("df")))


def fit_idf(df: DataFrame, num_features: int, idx_col: str = "idx") -> list[float]:
    """The IDF vector (length ``num_features``; unseen buckets get ln(m + 1)).

    One pass: per bucket, the rows that contain it, and how many rows start
    there (each row counts once at its first bucket, rows without any at a
    NULL bucket), which sums to m. Collects at most ``num_features + 1`` rows:
    bounded by the parameter, not the data.
    """
    import math

    exploded = df.select(F.posexplode_outer(F.col(idx_col)).alias("pos", "idx"))
    stats = exploded.groupBy("idx").agg(
        F.count("pos").alias("df"),
        F.sum(F.when(F.col("pos").isNull() | (F.col("pos") == 0), 1).otherwise(0)).alias("firsts")).collect()
    m = sum(r["firsts"] for r in stats)
    out = [math.log(m + 1.0)] * num_features
    for r in stats:
        if r["idx"] is not None:
            out[r["idx"]] = math.log((m + 1.0) / (r["df"] + 1.0))
    return out


def double_array_literal(values: list[float]) -> Column:
    """One ``array<double>`` literal holding ``values``.

    Built on the JVM from a single byte buffer, so the plan carries one Literal
    node whatever the length (no N-element expression to analyze); falls back
    to SQL text where the JVM is not reachable (Spark Connect).
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    try:
        import numpy as np
        from pyspark.sql.classic.column import Column as ClassicColumn

        jvm = spark._jvm
        buf = bytearray(np.asarray(values, dtype=">f8").tobytes())
        arr = spark.sparkContext._gateway.new_array(jvm.double, len(values))
        jvm.java.nio.ByteBuffer.wrap(buf).asDoubleBuffer().get(arr)
        return ClassicColumn(jvm.org.apache.spark.sql.functions.lit(arr))
    except (ImportError, AttributeError):  # no py4j gateway: plain SQL literal
        body = ", ".join(f"{float(v)!r}D" for v in values)
        return F.expr(f"array({body})")


def with_tf_idf(df: DataFrame, idf: list[float], idx_col: str = "idx", val_col: str = "val",
                out: str = "val") -> DataFrame:
    """Scale term counts by the IDF vector, row-local for any number of buckets: the vector rides in
    the plan as one literal, its length is a parameter. Rows without features keep empty arrays."""
    weights = double_array_literal(idf)
    return df.withColumn(out, F.zip_with(F.col(idx_col), F.col(val_col),
                                         lambda i, v: v * F.element_at(weights, i + 1)))


class TokenTransformer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A text chain as a stage of an ml ``Pipeline``: adds the chain's token array.

    The chain is a parameter (its description as JSON), so a pipeline that holds this stage can be
    saved, loaded elsewhere, and given raw text.
    """

    chain = Param(Params._dummy(), "chain", "description of the text chain (JSON)", TypeConverters.toString)

    def __init__(self, chain: TextChain = DEFAULT_CHAIN, input_col: str = "text", output_col: str = "tokens"):
        super().__init__()
        self._own = chain  # of a chain that cannot be described, saving raises, using does not
        self._set(inputCol=input_col, outputCol=output_col)

    def text_chain(self) -> TextChain:
        return TextChain.from_description(json.loads(self.getOrDefault(self.chain))) if self.isSet(self.chain) else self._own

    def write(self):
        self._set(chain=json.dumps(self.text_chain().describe()))
        return super().write()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return corpus.with_tokens(dataset, self.getInputCol(), self.getOutputCol(), self.text_chain())


def hashing_tf(num_features: int = rules.ONLINE_FEATURES, input_col: str = "tokens",
               output_col: str = "features") -> HashingTF:
    return HashingTF(numFeatures=num_features, inputCol=input_col, outputCol=output_col)
