"""Corpus operators: labelling, filters, caps, splits and summaries.

All are DataFrame -> DataFrame. Aggregates use Spark's partial (map-side)
aggregation, so a hot key costs one row per map partition in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwire.functions import rules, text
from moodwire.functions.tokens import DEFAULT_CHAIN, TextChain


def english_originals(df: DataFrame) -> DataFrame:
    """Language ``en`` and not a retweet."""
    return df.filter((F.col("lang") == "en") & ~F.col("is_retweet"))


def tracked(df: DataFrame, terms=rules.TRACKED_TERMS) -> DataFrame:
    """Statuses that contain any tracked term (the stream's filter)."""
    return df.filter(text.contains_any(F.col("text"), terms))


def with_distant_label(df: DataFrame, text_col: str = "text", out: str = "label",
                       drop_ambiguous: bool = False, strip_label_terms: bool = False) -> DataFrame:
    """Label 1.0 when a positive emoticon occurs, else 0.0.

    ``drop_ambiguous`` drops texts with no emoticon (neutral) or with both kinds
    (mixed) instead of labelling them 0.0 / 1.0. ``strip_label_terms`` removes the
    labelling emoticons from the text afterwards, so they cannot leak into features.
    """
    t = F.col(text_col)
    out_df = df.withColumn(out, text.distant_label(t))
    if drop_ambiguous:
        out_df = out_df.filter(text.is_positive(t) != text.is_negative(t))
    if strip_label_terms:
        stripped = t
        for term in rules.TRACKED_TERMS:
            stripped = F.replace(stripped, F.lit(term), F.lit(""))
        out_df = out_df.withColumn(text_col, stripped)
    return out_df


def with_tokens(df: DataFrame, text_col: str = "text", out: str = "tokens",
                chain: TextChain = DEFAULT_CHAIN) -> DataFrame:
    """Add the token array of the chain.

    The normalized text is projected first and referenced by every tokenizer,
    so Catalyst keeps it as one computed column instead of inlining it into
    each tokenizer (and each lambda).
    """
    tmp = f"__{out}_normalized"
    staged = df.withColumn(tmp, chain.normalize(F.col(text_col)))
    return staged.withColumn(out, chain.tokens_of(F.col(tmp))).drop(tmp)


def polarity_code(label_col: Column) -> Column:
    """Sentiment140-style polarity code: "4" positive, "0" negative, "2" neither."""
    return F.when(text.is_positive(label_col), F.lit("4")).when(text.is_negative(label_col), F.lit("0")).otherwise(
        F.lit("2"))


def recode_label(code: Column) -> Column:
    """"0" -> 0.0, "4" -> 1.0, anything else NULL (the row is then dropped)."""
    return F.when(code == "0", F.lit(0.0)).when(code == "4", F.lit(1.0))


def label_recode(df: DataFrame, code_col: str = "polarity", out: str = "label") -> DataFrame:
    return df.withColumn(out, recode_label(F.col(code_col))).filter(F.col(out).isNotNull())


def class_split(df: DataFrame, label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(label_col) == 1.0), df.filter(F.col(label_col) == 0.0)


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


CAP_SALTS = 32


def first_per_class(df: DataFrame, most: int, label_col: str = "label", order_cols=("ts", "tweet_id"),
                    rank: str = "__rank") -> DataFrame:
    """The first ``most`` rows of each class in arrival order, with their rank.

    Ranks are taken within (class, salt) first, where ``row_number() <= k`` is planned as a window
    group limit (each task keeps k rows per class and salt before the shuffle); the ranks over a
    whole class then see at most ``CAP_SALTS * most`` rows, however large the class or the cluster.
    """
    order = [F.col(c) for c in order_cols]
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(CAP_SALTS)))
    some = (salted.withColumn(rank, F.row_number().over(Window.partitionBy(label_col, "__salt").orderBy(*order)))
            .filter(F.col(rank) <= most))
    return (some.withColumn(rank, F.row_number().over(Window.partitionBy(label_col).orderBy(*order)))
            .filter(F.col(rank) <= most).drop("__salt"))


def balanced_cap(df: DataFrame, target: int = rules.CORPUS_TARGET, label_col: str = "label",
                 order_cols=("ts", "tweet_id")) -> DataFrame:
    """Keep the first ``target // 2`` rows of each class in arrival order."""
    return first_per_class(df, target // 2, label_col, order_cols).drop("__rank")


def split_bucket(id_col: Column, buckets: int = 100) -> Column:
    """A stable hash bucket of an id, equal in every engine (first 32 bits of md5)."""
    h = F.conv(F.substring(F.md5(id_col.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def hash_split(df: DataFrame, id_col: str = "tweet_id", train_percent: int = 80) -> DataFrame:
    """Reproducible train/test split by a hash of the id (no shuffle)."""
    return df.withColumn("split", F.when(split_bucket(F.col(id_col)) < train_percent, F.lit("train"))
                         .otherwise(F.lit("test")))


def label_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy("split", label_col).agg(F.count(F.lit(1)).alias("n"))


def majority_baseline(df: DataFrame, label_col: str = "label") -> DataFrame:
    m = F.avg(F.col(label_col))
    return df.agg(F.greatest(m, 1 - m).alias("baseline"))


def js_round2_percent(ratio: Column) -> Column:
    """Percent with two decimals, halves rounded up (``Math.round(r*10000)/100``)."""
    return F.floor(ratio * 10000 + 0.5) / 100


def sentiment_summary(scored: DataFrame, model_col: str = "model", prediction_col: str = "prediction",
                      threshold: float = rules.DISPLAY_THRESHOLD) -> DataFrame:
    """Per model: negatives (< threshold), positives, majority sentiment (tie -> positive) and its
    share in percent. One aggregate pass."""
    neg = F.sum(F.when(F.col(prediction_col) < threshold, 1).otherwise(0)).cast("long")
    pos = F.sum(F.when(F.col(prediction_col) < threshold, 0).otherwise(1)).cast("long")
    agg = scored.groupBy(model_col).agg(neg.alias("negative"), pos.alias("positive"))
    total = F.col("negative") + F.col("positive")
    is_neg = F.col("negative") > F.col("positive")
    return agg.select(
        model_col, "negative", "positive",
        F.when(is_neg, F.lit("negative")).otherwise(F.lit("positive")).alias("sentiment"),
        js_round2_percent(F.when(is_neg, F.col("negative")).otherwise(F.col("positive")) / total).alias("percent"),
    )


def search(df: DataFrame, keyword: str, limit: int = rules.SEARCH_LIMIT) -> DataFrame:
    """Keyword search: English originals containing the keyword, newest first, at most ``limit``.

    ``orderBy(...).limit(k)`` is planned as TakeOrderedAndProject: each
    partition keeps its own top k, so only k rows per partition move. The ``coalesce`` (of one partition) keeps what is
    selected of the hits behind the limit: Catalyst moves projections before it, and the text chain would run over
    every row that holds the keyword, and all of those be sorted.
    """
    hits = english_originals(df).filter(F.lower(F.col("text")).contains(keyword.lower()))
    return hits.orderBy(F.col("ts").desc(), F.col("tweet_id").asc()).limit(limit).coalesce(1)
