"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads whole tables (or frames Spark derives from them); nothing is cut
to a subset. Keys with a DuckDB twin in ``moodwire.plans.oracle`` are checked
value for value; the others (models, vectors, streams) by rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.functions import rules, stem, text, tokens
from moodwire.operators import corpus, features, metrics
from moodwire.session import checkpoint_dir
from moodwire.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

SEARCH_KEYWORD = "haha"
STAT_VERSIONS = 20  # evaluations per trainer in the statistics fixture
STREAM_BATCH = 50  # tweets per micro-batch when a stream is replayed in batch
CAP_TARGET = 60  # corpus target of the cap queries: small enough to bite at every scale


def _tweets(spark, sf):
    return tables.tweets(spark, sf)


def labelled(spark, sf):
    """The distant-labelled tweet corpus: (tweet_id, ts, text, lang, is_retweet, label)."""
    return corpus.with_distant_label(_tweets(spark, sf))


def fixture_score(id_col="tweet_id"):
    """A score both engines compute exactly, for metric checks."""
    return (F.pmod(F.col(id_col) * 37, F.lit(101)) / 100.0).cast("double")


# ----------------------------------------------------------------------------- sources and predicates

def q_stream_filter(spark, sf):
    return corpus.english_originals(_tweets(spark, sf)).select("tweet_id", "text")


def q_stream_tracked(spark, sf):
    return corpus.tracked(_tweets(spark, sf)).select("tweet_id", "lang", "is_retweet")


def q_distant_label(spark, sf):
    return labelled(spark, sf).select("tweet_id", "label")


def q_sentiment_flags(spark, sf):
    t = F.col("text")
    return _tweets(spark, sf).select("tweet_id", text.is_positive(t).alias("is_positive"),
                                     text.is_negative(t).alias("is_negative"), text.is_neutral(t).alias("is_neutral"))


def q_label_recode(spark, sf):
    coded = _tweets(spark, sf).select("tweet_id", corpus.polarity_code(F.col("text")).alias("polarity"))
    return corpus.label_recode(coded).select("tweet_id", "label")


def q_class_split(spark, sf):
    positives, negatives = corpus.class_split(labelled(spark, sf))
    return positives.select("tweet_id", F.lit("positive").alias("class")).unionByName(
        negatives.select("tweet_id", F.lit("negative").alias("class")))


def q_corpus_union(spark, sf):
    positives, negatives = corpus.class_split(labelled(spark, sf))
    return positives.select("tweet_id", "label").unionByName(negatives.select("tweet_id", "label"))


def q_sentiment_decision(spark, sf):
    scored = _tweets(spark, sf).select("tweet_id", fixture_score().alias("prediction"))
    return scored.select("tweet_id", "prediction", text.sentiment_decision(F.col("prediction")).alias("decision"))


def q_keyword_search(spark, sf):
    return corpus.search(_tweets(spark, sf), SEARCH_KEYWORD).select("tweet_id", "text")


def q_corpus_count(spark, sf):
    return labelled(spark, sf).agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------------------- aggregates, caps, splits

def q_class_counts(spark, sf):
    return corpus.class_counts(labelled(spark, sf))


def q_hash_split(spark, sf):
    return corpus.hash_split(_tweets(spark, sf)).select("tweet_id", "split")


def q_label_distribution(spark, sf):
    return corpus.label_distribution(corpus.hash_split(labelled(spark, sf)))


def q_majority_baseline(spark, sf):
    test = corpus.hash_split(labelled(spark, sf)).filter(F.col("split") == "test")
    return corpus.majority_baseline(test)


def streamed_corpus(spark, sf):
    """Tracked, English, original statuses with their distant label (the stream's corpus)."""
    return corpus.with_distant_label(corpus.english_originals(corpus.tracked(_tweets(spark, sf))))


def q_balanced_cap(spark, sf):
    return corpus.balanced_cap(streamed_corpus(spark, sf), CAP_TARGET).select("tweet_id", "label")


def q_corpus_progress(spark, sf):
    """Per micro-batch of arrival: positives and negatives collected so far (each capped
    at half the target), up to the batch in which both classes are full."""
    half = CAP_TARGET // 2
    per_batch = (streamed_corpus(spark, sf)
                 .withColumn("batch_id", F.floor(F.col("tweet_id") / STREAM_BATCH).cast("long"))
                 .groupBy("batch_id")
                 .agg(F.sum(F.col("label").cast("long")).alias("pos"),
                      F.sum((1 - F.col("label")).cast("long")).alias("neg")))
    cum = metrics.running_totals(per_batch, "batch_id", ["pos", "neg"], descending=False)
    # a batch is processed while, before it, at least one class was still below the cap
    before_full = ((F.col("cum_pos") - F.col("pos")) >= half) & ((F.col("cum_neg") - F.col("neg")) >= half)
    return cum.filter(~before_full).select(
        "batch_id", F.least(F.col("cum_pos"), F.lit(half)).alias("positives"),
        F.least(F.col("cum_neg"), F.lit(half)).alias("negatives"))


def fixture_scored(spark, sf):
    """Two scorers over the labelled tweets: 'batch' = fixture score, 'online' = a 0/1 rule."""
    lab = labelled(spark, sf)
    batch = lab.select(F.lit("batch").alias("model"), "tweet_id", fixture_score().alias("prediction"), "label")
    online = lab.select(F.lit("online").alias("model"), "tweet_id",
                        F.when(text.is_negative(F.col("text")), 0.0).otherwise(1.0).alias("prediction"), "label")
    return batch.unionByName(online)


def q_sentiment_summary(spark, sf):
    return corpus.sentiment_summary(fixture_scored(spark, sf))


# ----------------------------------------------------------------------------- text operators

def _text_op(fn):
    def q(spark, sf):
        return _tweets(spark, sf).select("tweet_id", fn(F.col("text")).alias("normalized"))
    return q


q_normalize_sentiment = _text_op(text.normalize_sentiment)
q_normalize_shortforms = _text_op(text.normalize_shortforms)
q_normalize_noise = _text_op(text.normalize_noise)
q_normalize_noise_https = _text_op(text.normalize_noise_https)


def q_stem_vocabulary(spark, sf):
    words = _tweets(spark, sf).select(F.explode(F.split(F.lower(F.col("text")), " ")).alias("word")).distinct()
    return words.select("word", F.element_at(stem.stem_words(F.array(F.col("word"))), 1).alias("stem"))


def _tokenizer_op(fn):
    def q(spark, sf):
        return _tweets(spark, sf).select("tweet_id", fn(F.col("text")).alias("tokens"))
    return q


q_tokens_unigram = _tokenizer_op(tokens.unigrams)
q_tokens_bigram = _tokenizer_op(tokens.bigrams)
q_tokens_trigram = _tokenizer_op(tokens.trigrams)
q_tokens_whitespace = _tokenizer_op(tokens.whitespace_unigrams)


def q_distant_label_strict(spark, sf):
    """Labels without neutral or mixed texts, emoticons stripped from the text."""
    strict = corpus.with_distant_label(_tweets(spark, sf), drop_ambiguous=True, strip_label_terms=True)
    return strict.select("tweet_id", "label", "text")


def tokenized(spark, sf):
    dealt = tables.tweets(spark, sf, tables.ROWS_PER_TASK)
    return corpus.with_tokens(corpus.with_distant_label(dealt))


def q_default_tokens(spark, sf):
    return tokenized(spark, sf).select("tweet_id", "tokens")


# An example user dictionary for the custom chain (any mapping works).
CUSTOM_DICTIONARY = {"colour": "color"}
CUSTOM_CHAIN = tokens.TextChain(normalizers=[text.DictionaryRule(CUSTOM_DICTIONARY)], stemmer=None,
                                tokenizers=[tokens.unigrams])


def q_custom_chain(spark, sf):
    return corpus.with_tokens(_tweets(spark, sf), chain=CUSTOM_CHAIN).select("tweet_id", "tokens")


def q_vocabulary(spark, sf):
    """(token, term_frequency, doc_frequency) in one shuffle: every occurrence counts
    towards tf, every distinct token of a tweet towards df; partial aggregation
    collapses hot tokens before the shuffle."""
    t = tokenized(spark, sf)
    marks = F.concat(
        F.transform(F.col("tokens"), lambda x: F.struct(x.alias("token"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
        F.transform(F.array_distinct(F.col("tokens")),
                    lambda x: F.struct(x.alias("token"), F.lit(0).alias("tf"), F.lit(1).alias("df"))))
    return (t.select(F.explode(marks).alias("m"))
            .groupBy(F.col("m.token").alias("token"))
            .agg(F.sum("m.tf").cast("long").alias("term_frequency"), F.sum("m.df").cast("long").alias("doc_frequency")))


# ----------------------------------------------------------------------------- features

def java_tf(spark, sf, num_features=rules.ONLINE_FEATURES):
    dealt = tables.tweets(spark, sf, tables.ROWS_PER_TASK)
    return features.with_text_java_tf(corpus.with_distant_label(dealt), num_features=num_features)


def q_hashing_tf_java(spark, sf):
    return java_tf(spark, sf).select("tweet_id", "idx", "val")


def q_doc_frequency(spark, sf):
    return features.doc_frequency(java_tf(spark, sf))


def checkpointed_tf(spark, sf):
    """Term frequencies written once to the shared checkpoint folder: the IDF fit
    and the transform then read them instead of running the text chain twice."""
    checkpoint_dir(spark)
    return java_tf(spark, sf).select("tweet_id", "idx", "val").checkpoint(eager=True)


def q_tf_idf(spark, sf):
    tf = checkpointed_tf(spark, sf)
    idf = features.fit_idf(tf, rules.ONLINE_FEATURES)
    out = features.with_tf_idf(tf, idf)
    return out.select("tweet_id", "idx", F.transform("val", lambda v: F.round(v, 9)).alias("val"))


def q_hashing_tf_totals(spark, sf):
    """Term totals of the ml vectors: every token counts in some bucket."""
    from pyspark.ml.functions import vector_to_array

    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).cast("long")
    return features.hashing_tf().transform(tokenized(spark, sf)).select("tweet_id", total.alias("total"))


def q_hashing_tf(spark, sf):
    return features.hashing_tf().transform(tokenized(spark, sf)).select("tweet_id", "features")


# ----------------------------------------------------------------------------- metrics on fixture scores

def _batch_fixture(spark, sf):
    return fixture_scored(spark, sf).filter(F.col("model") == "batch").withColumnRenamed("prediction", "score")


def q_auc_roc(spark, sf):
    return metrics.auc_roc(_batch_fixture(spark, sf)).select(F.round("auc_roc", 9).alias("auc_roc"))


def q_auc_pr(spark, sf):
    return metrics.auc_pr(_batch_fixture(spark, sf)).select(F.round("auc_pr", 9).alias("auc_pr"))


def _hard_fixture(spark, sf):
    return fixture_scored(spark, sf).filter(F.col("model") == "online")


def q_accuracy(spark, sf):
    return metrics.accuracy(_hard_fixture(spark, sf))


def q_precision_recall(spark, sf):
    return metrics.precision_recall(_hard_fixture(spark, sf))


def fixture_statistics(spark, sf):
    """Statistics table of the fixture scorers: one evaluation per (trainer, version),
    each version scoring its own share of the labelled tweets."""
    scored = fixture_scored(spark, sf).withColumn(
        "hard", F.when(F.col("prediction") < 0.5, 0.0).otherwise(1.0))
    return (scored.withColumn("model_version", F.pmod(F.col("tweet_id"), F.lit(STAT_VERSIONS)).cast("long"))
            .groupBy(F.col("model").alias("trainer"), "model_version")
            .agg(F.avg((F.col("hard") == F.col("label")).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n")))


def q_latest_statistics(spark, sf):
    return metrics.latest_statistics(fixture_statistics(spark, sf))


def q_accuracy_history(spark, sf):
    return metrics.accuracy_history(fixture_statistics(spark, sf))


def q_predict_online(spark, sf):
    """Online scoring with fixed weights (w_j = ((7 j) mod 13 - 6) / 10) over TF-IDF features."""
    tf = checkpointed_tf(spark, sf)
    idf = features.fit_idf(tf, rules.ONLINE_FEATURES)
    feats = features.with_tf_idf(tf, idf)
    weights = [((7 * j) % 13 - 6) / 10.0 for j in range(rules.ONLINE_FEATURES)]
    from moodwire.operators.sgd import with_online_prediction
    return with_online_prediction(feats, weights).select("tweet_id", "prediction")


QUERIES: dict[str, Query] = {
    "stream_filter": q_stream_filter,
    "stream_tracked": q_stream_tracked,
    "distant_label": q_distant_label,
    "sentiment_flags": q_sentiment_flags,
    "label_recode": q_label_recode,
    "class_split": q_class_split,
    "corpus_union": q_corpus_union,
    "sentiment_decision": q_sentiment_decision,
    "keyword_search": q_keyword_search,
    "corpus_count": q_corpus_count,
    "class_counts": q_class_counts,
    "hash_split": q_hash_split,
    "label_distribution": q_label_distribution,
    "majority_baseline": q_majority_baseline,
    "balanced_cap": q_balanced_cap,
    "corpus_progress": q_corpus_progress,
    "sentiment_summary": q_sentiment_summary,
    "normalize_sentiment": q_normalize_sentiment,
    "normalize_shortforms": q_normalize_shortforms,
    "normalize_noise": q_normalize_noise,
    "normalize_noise_https": q_normalize_noise_https,
    "tokens_whitespace": q_tokens_whitespace,
    "distant_label_strict": q_distant_label_strict,
    "stem_vocabulary": q_stem_vocabulary,
    "tokens_unigram": q_tokens_unigram,
    "tokens_bigram": q_tokens_bigram,
    "tokens_trigram": q_tokens_trigram,
    "default_tokens": q_default_tokens,
    "custom_chain": q_custom_chain,
    "vocabulary": q_vocabulary,
    "hashing_tf_java": q_hashing_tf_java,
    "doc_frequency": q_doc_frequency,
    "tf_idf": q_tf_idf,
    "hashing_tf": q_hashing_tf,
    "hashing_tf_totals": q_hashing_tf_totals,
    "auc_roc": q_auc_roc,
    "auc_pr": q_auc_pr,
    "accuracy": q_accuracy,
    "precision_recall": q_precision_recall,
    "latest_statistics": q_latest_statistics,
    "accuracy_history": q_accuracy_history,
    "predict_online": q_predict_online,
}


def all_queries() -> dict[str, Query]:
    from moodwire.plans import models
    out = dict(QUERIES)
    out.update(models.QUERIES)
    return out
