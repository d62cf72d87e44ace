"""Registered queries that train, score, stream or write: checked by rows.

Trained models and stream runs are kept per (application, data folder) so the
queries that read one result (scores, statistics, versions) share a single fit.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.functions import rules
from moodwire.operators import corpus, features, metrics, pca, sgd, train
from moodwire.plans import catalog
from moodwire.session import work_path
from moodwire.sources import files, tables
from moodwire.streaming import evaluation, online

NOTEBOOK_FEATURES = 3000  # buckets of the exploratory notebook
WIDE_FEATURES = 1 << 18
NOTEBOOK_REG = 0.01  # default regularization of the SGD trainer it called
STREAM_RANGES = 4  # ranges of arrival, each replayed as one micro-batch

_memo: dict[tuple, object] = {}


def _key(spark: SparkSession, sf: str, what: str) -> tuple:
    return spark.sparkContext.applicationId, sf, what


def _once(spark, sf, what, fn):
    k = _key(spark, sf, what)
    if k not in _memo:
        _memo[k] = fn()
    return _memo[k]


def forget() -> None:
    """Drop the remembered models and release the tables they keep cached."""
    for value in _memo.values():
        if isinstance(value, DataFrame):
            value.unpersist()
    _memo.clear()


def split_corpus(spark, sf) -> DataFrame:
    """Tokenized, labelled tweets with a stable train/test split. Texts and tokens are not kept: whoever reads rows
    more than once keeps what it makes of them (vectors, buckets), which is far smaller."""
    return corpus.hash_split(catalog.tokenized(spark, sf)).select(
        "tweet_id", F.col("text").alias("tweet"), "tokens", "label", "split")


def _train(spark, sf):
    return split_corpus(spark, sf).filter(F.col("split") == "train")


def _test(spark, sf):
    return split_corpus(spark, sf).filter(F.col("split") == "test")


# ----------------------------------------------------------------------------- batch pipeline

def batch_model(spark, sf):
    return _once(spark, sf, "batch_cv", lambda: train.batch_cv(_train(spark, sf)))


def q_train_batch(spark, sf):
    rows = train.cv_summary(batch_model(spark, sf))
    return spark.createDataFrame(rows, "num_features int, reg_param double, max_iter int, avg_auc double, best boolean")


def q_predict_batch(spark, sf):
    return train.predict_batch(batch_model(spark, sf).bestModel, _test(spark, sf))


def q_predict_batch_untrained(spark, sf):
    """Batch scoring by a pipeline of no iterations: every held-out tweet gets the share of positives
    in the training rows as its score, and the class that follows."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression

    kept = features.hashing_tf(10).transform(_train(spark, sf)).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    fitted = LogisticRegression(maxIter=0).fit(kept)
    kept.unpersist()
    model = PipelineModel([features.hashing_tf(10), fitted])
    return train.predict_batch(model, _test(spark, sf)).select("tweet_id", "prediction", F.round("score", 9).alias("score"))


def q_default_pipeline(spark, sf):
    """The untuned pipeline: class and score per held-out tweet."""
    model = _once(spark, sf, "default_pipeline", lambda: train.default_pipeline(_train(spark, sf)))
    return train.predict_batch(model, _test(spark, sf)).select("tweet_id", "prediction", "score")


def q_batch_latest_model(spark, sf):
    """Two versions of the batch model saved with their text chain, the latest loaded and given raw text:
    per held-out tweet its version, and whether it predicts what the model in memory does of the tokens."""
    folder, best = work_path(spark, "batch-models"), batch_model(spark, sf).bestModel
    for version in (0, 1):
        train.save_model(train.raw_text_model(best), folder, version)
    version, loaded = train.load_latest(spark, folder)
    again = train.predict_batch(loaded, _test(spark, sf).drop("tokens")).select("tweet_id", F.col("score").alias("loaded"))
    first = train.predict_batch(best, _test(spark, sf)).select("tweet_id", "score")
    return first.join(again, "tweet_id").select("tweet_id", F.lit(version).cast("long").alias("version"),
                                                (F.col("score") == F.col("loaded")).alias("same"))


def q_batch_statistics(spark, sf):
    model = batch_model(spark, sf).bestModel
    scored = train.predict_batch(model, _test(spark, sf), keep=("tweet_id", "label"))
    row = metrics.statistics_row(scored, "batch", "logistic regression", 0)
    return row.drop("ts")  # a time stamp would make the row unrepeatable


def q_batch_statistics_fixed(spark, sf):
    """The statistics row of a scored hold-out, on the fixture score."""
    scored = corpus.hash_split(catalog.labelled(spark, sf)).filter(F.col("split") == "test").select(
        "label", catalog.fixture_score().alias("score")).withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    row = metrics.statistics_row(scored, "batch", "fixture", 3)
    return row.select("trainer", "model_version", "model", F.round("area_under_roc", 9).alias("area_under_roc"),
                      F.round("accuracy", 9).alias("accuracy"), "n")


# ----------------------------------------------------------------------------- SGD (notebook)

def java_features(spark, sf, num_features=NOTEBOOK_FEATURES):
    made = features.with_text_java_tf(split_corpus(spark, sf), "tweet", num_features=num_features)
    return made.select("tweet_id", "label", "split", "idx", "val")


def sgd_model(spark, sf):
    def fit():
        data = java_features(spark, sf).filter(F.col("split") == "train")
        return sgd.train_sgd(data, NOTEBOOK_FEATURES, rules.SGD_ITERATIONS, rules.SGD_STEP, NOTEBOOK_REG)
    return _once(spark, sf, "sgd", fit)


def first_steps(spark, sf, steps: int, initial=None) -> DataFrame:
    """Weights (bucket, weight) after a few steps over all labelled tweets."""
    data = catalog.java_tf(spark, sf).select("label", "idx", "val")
    model = sgd.train_sgd(data, rules.ONLINE_FEATURES, steps, rules.SGD_STEP, NOTEBOOK_REG, initial)
    return spark.createDataFrame([(j, round(float(w), 6)) for j, w in enumerate(model.weights)], "bucket int, weight double")


def q_sgd_three_steps(spark, sf):
    return first_steps(spark, sf, 3)


def q_sgd_warm_start_steps(spark, sf):
    """Two steps from given weights (w_j = ((7 j) mod 13 - 6) / 100)."""
    return first_steps(spark, sf, 2, [((7 * j) % 13 - 6) / 100 for j in range(rules.ONLINE_FEATURES)])


def q_train_sgd(spark, sf):
    return sgd.weights_frame(spark, sgd_model(spark, sf))


def sparse_features(spark, sf) -> DataFrame:
    """Sparse ml vectors of the whole corpus, kept: the grid search and the warm start share one index."""
    def build():
        made = features.hashing_tf(NOTEBOOK_FEATURES).transform(split_corpus(spark, sf))
        return made.select("tweet_id", "label", "split", "features").persist(StorageLevel.MEMORY_AND_DISK)
    return _once(spark, sf, "sparse_features", build)


def sparse_arrays(spark, sf, split: str) -> DataFrame:
    """Labels of a split and its vectors as (idx, val) arrays."""
    parts = F.unwrap_udt("features")
    return sparse_features(spark, sf).filter(F.col("split") == split).select(
        "label", parts["indices"].alias("idx"), parts["values"].alias("val"))


def cv_grid_model(spark, sf):
    """Cross-validated over the whole corpus."""
    return _once(spark, sf, "cv_grid", lambda: train.lr_cv_grid(sparse_features(spark, sf)))


def q_train_cv_grid(spark, sf):
    rows = train.cv_summary(cv_grid_model(spark, sf))
    return spark.createDataFrame(rows, "num_features int, reg_param double, max_iter int, avg_auc double, best boolean")


def q_cv_fold_constants(spark, sf):
    """Grid point maxIter = 0 of the cross validation: per fold its rows, the constant score (the share of
    positives in the other folds) and its area under ROC."""
    scored = train.fold_scores(sparse_features(spark, sf), 0)
    areas = []
    for k in range(3):
        areas.append(metrics.auc_roc(scored.filter(F.col("fold") == k)).select(F.lit(k).alias("fold"), F.col("auc_roc").alias("auc")))
    auc = areas[0].unionByName(areas[1]).unionByName(areas[2])
    per = scored.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("score"), 9).alias("low"), F.round(F.max("score"), 9).alias("high"))
    return per.join(auc, "fold")


def warm_start_model(spark, sf):
    def fit():
        start = [float(x) for x in cv_grid_model(spark, sf).bestModel.coefficients.toArray()]
        data = sparse_arrays(spark, sf, "train")
        return sgd.train_sgd(data, NOTEBOOK_FEATURES, rules.SGD_ITERATIONS, rules.SGD_STEP, NOTEBOOK_REG,
                             initial_weights=start)
    return _once(spark, sf, "warm_start", fit)


def q_train_warm_start(spark, sf):
    return sgd.weights_frame(spark, warm_start_model(spark, sf))


def evaluated(spark, test: DataFrame, weights: list[float]) -> DataFrame:
    """One row: AUC of ROC from hard predictions and from the probability, AUC of PR, accuracy, the
    majority baseline, precision and recall of the positive class."""
    scored = sgd.with_online_prediction(test, weights).select("label", "probability", "prediction").persist()
    positive = metrics.precision_recall(scored).filter("class = 1.0").first()
    values = {
        "auc_roc": metrics.auc_roc(scored.withColumnRenamed("prediction", "score")).first()[0],
        "auc_roc_probability": metrics.auc_roc(scored.withColumnRenamed("probability", "score")).first()[0],
        "auc_pr": metrics.auc_pr(scored.withColumnRenamed("prediction", "score")).first()[0],
        "accuracy": metrics.accuracy(scored).first()["accuracy"],
        "baseline": corpus.majority_baseline(scored).first()[0],
        "precision": positive["precision"] if positive else None,
        "recall": positive["recall"] if positive else None,
    }
    scored.unpersist()
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} double" for k in values))


def q_warm_start_statistics(spark, sf):
    """Hold-out evaluation of the warm-started model."""
    test = sparse_arrays(spark, sf, "test")
    return evaluated(spark, test, warm_start_model(spark, sf).weights)


def q_sgd_statistics(spark, sf):
    """Hold-out evaluation of the SGD model."""
    return evaluated(spark, java_features(spark, sf).filter(F.col("split") == "test"), sgd_model(spark, sf).weights)


# ----------------------------------------------------------------------------- streams

def replayed(spark, sf, run) -> None:
    """Land the status table range by range and call ``run(stream)`` after each."""
    path = work_path(spark, "status")
    for _ in online.land_in_order(tables.tweets(spark, sf), work_path(spark, "status-staging"), path, STREAM_RANGES):
        run(online.status_stream(spark, path))


def corpus_idf(spark, sf):
    def build():
        tf = features.with_text_java_tf(_train(spark, sf), "tweet")
        return features.fit_idf(tf, rules.ONLINE_FEATURES)
    return _once(spark, sf, "corpus_idf", build)


def online_trainer(spark, sf):
    def run():
        holdout = _test(spark, sf).select(F.col("tweet").alias("text"), "label")
        trainer = online.OnlineTrainer(spark, idf=corpus_idf(spark, sf), holdout=holdout, evaluate_every=1)
        replayed(spark, sf, trainer.run)
        return trainer
    return _once(spark, sf, "online_trainer", run)


def q_train_online(spark, sf):
    return online_trainer(spark, sf).versions().select("version", "iterations", "converged", "rows")


def q_model_versions(spark, sf):
    return online_trainer(spark, sf).versions().select(F.col("version").cast("long"), "rows",
                                                       F.size("weights").alias("num_weights"))


def stateful_trainer(spark, sf):
    def run():
        from moodwire.streaming import stateful

        trainer = stateful.StatefulTrainer(spark, idf=corpus_idf(spark, sf))
        replayed(spark, sf, trainer.run)
        return trainer
    return _once(spark, sf, "stateful_trainer", run)


def q_model_versions_state(spark, sf):
    """Versions of the model that lives in the state store."""
    return stateful_trainer(spark, sf).versions().select("version", "rows", F.size("weights").alias("num_weights"))


def q_statistics_counts(spark, sf):
    """What the periodic evaluation wrote: versions and rows scored."""
    return online_trainer(spark, sf).statistics().select("trainer", F.col("model_version").cast("long"), "n")


def q_latest_model(spark, sf):
    return online_trainer(spark, sf).latest().select("version", "weights", "intercept")


def q_statistics_feed(spark, sf):
    """The statistics table the online trainer appended to, latest row per trainer."""
    return metrics.latest_statistics(online_trainer(spark, sf).statistics().drop("ts"))


def q_online_accuracy_history(spark, sf):
    return metrics.accuracy_history(online_trainer(spark, sf).statistics())


def latest_weights(spark, sf) -> list[float]:
    row = online_trainer(spark, sf).latest().collect()[0]
    return list(row["weights"])


def online_scored(spark, sf, frame: DataFrame) -> DataFrame:
    tf = features.with_text_java_tf(frame, "tweet")
    feats = features.with_tf_idf(tf, corpus_idf(spark, sf))
    return sgd.with_online_prediction(feats, latest_weights(spark, sf))


def q_online_statistics(spark, sf):
    # the hold-out as the trainer's evaluations score it: its texts go through the chain once
    feats = online_trainer(spark, sf).holdout_features()
    scored = sgd.with_online_prediction(feats, latest_weights(spark, sf)).select("label", "probability", "prediction").persist()
    auc = metrics.auc_roc(scored.withColumnRenamed("probability", "score")).first()[0]
    hard = metrics.balanced_accuracy(scored).first()[0]
    acc = metrics.accuracy(scored).first()
    scored.unpersist()
    return spark.createDataFrame([("online", auc, hard, acc["accuracy"], acc["n"])],
                                 "trainer string, auc_roc double, balanced_accuracy double, accuracy double, n long")


def fixed_weights() -> list[float]:
    """w_j = ((7 j) mod 13 - 6) / 1024: margins over term counts are exact in binary, whatever the order of the sum."""
    return [((7 * j) % 13 - 6) / 1024 for j in range(rules.ONLINE_FEATURES)]


HOLDOUT_BATCHES = 3


def fixed_evaluation(spark, sf):
    """Evaluations of fixed weights by the clock: the hold-out arrives in ``HOLDOUT_BATCHES`` batches, two
    ticks of the same version and hold-out at the end. Gives the evaluator."""
    def run():
        weights, holdout = work_path(spark, "fixed-weights"), work_path(spark, "holdout")
        spark.createDataFrame([(fixed_weights(), 7)], evaluation.WEIGHTS_SCHEMA).write.partitionBy("version").parquet(weights)
        test = features.with_text_java_tf(_test(spark, sf), "tweet")
        batches = test.select("label", "idx", "val", F.pmod("tweet_id", F.lit(HOLDOUT_BATCHES)).cast("long").alias("batch_id"))
        staged = work_path(spark, "holdout-staged")
        batches.write.partitionBy("batch_id").parquet(staged)
        staged = spark.read.schema(evaluation.FEATURES_SCHEMA).parquet(staged)
        evaluator = evaluation.PeriodicEvaluator(spark, weights, holdout)
        for k in range(HOLDOUT_BATCHES):
            staged.filter(F.col("batch_id") == k).write.mode("append").partitionBy("batch_id").parquet(holdout)
            evaluator.evaluate(k)
        evaluator.evaluate(HOLDOUT_BATCHES)
        return evaluator
    return _once(spark, sf, "fixed_evaluation", run)


def q_evaluation_increments(spark, sf):
    """What each tick reported: area, accuracy and size over the hold-out batches that had arrived."""
    return fixed_evaluation(spark, sf).statistics().select(
        "evaluation", "model_version", F.round("area_under_roc", 9).alias("area_under_roc"), F.round("accuracy", 9).alias("accuracy"), "n")


def q_evaluation_by_clock(spark, sf):
    """Two evaluations of one version by a running clock query, without any tweet arriving."""
    import time

    done = fixed_evaluation(spark, sf)
    clock = evaluation.PeriodicEvaluator(spark, done.weights_path, done.holdout_path, counts=done.counts, seconds=1)
    query = clock.start()
    try:
        while query.isActive and clock.statistics().count() < 2:
            query.awaitTermination(0.2)
    finally:
        clock.stop(query)
    first = clock.statistics().orderBy("evaluation").limit(2)
    return first.select("model_version", F.round("area_under_roc", 9).alias("area_under_roc"),
                        F.round("accuracy", 9).alias("accuracy"), "n")


FEED_SCHEMA = "trainer string, model_version long, accuracy double, n long, evaluation long"


def q_statistics_live_feed(spark, sf):
    """A subscriber that comes when half of the fixture's evaluations exist: what it is sent, and whether on
    subscription. The other half arrives in two parts; the feed runs after each, and once more without news."""
    path = work_path(spark, "fixture-statistics")
    rows = catalog.fixture_statistics(spark, sf).select(
        "trainer", "model_version", "accuracy", "n", F.col("model_version").alias("evaluation"))
    half, quarter = catalog.STAT_VERSIONS // 2, catalog.STAT_VERSIONS // 4
    rows = rows.persist()
    feed = evaluation.StatisticsFeed(spark, path, schema=FEED_SCHEMA)
    for low, high in ((0, half), (half, half + quarter), (half + quarter, catalog.STAT_VERSIONS)):
        part = rows.filter((F.col("model_version") >= low) & (F.col("model_version") < high))
        part.write.mode("append").partitionBy("evaluation").parquet(path)
        feed.run()
    evaluation.put(part, path, "evaluation")  # the same rows in new files
    feed.run()
    rows.unpersist()
    return feed.delivered().select("trainer", "model_version", F.round("accuracy", 9).alias("accuracy"), "n",
                                   (F.col("delivery") < 0).alias("on_subscription"))


def stream_collector(spark, sf):
    def run():
        collector = online.CorpusCollector(spark, target=catalog.CAP_TARGET)
        replayed(spark, sf, lambda stream: None if collector.state.full else collector.run(stream))
        return collector
    return _once(spark, sf, "collector", run)


def q_stream_corpus(spark, sf):
    return stream_collector(spark, sf).corpus().select("tweet_id", "label", F.col("batch_id").cast("long"))


def q_stream_progress(spark, sf):
    return stream_collector(spark, sf).progress()


# ----------------------------------------------------------------------------- files

def csv_corpus_path(spark, sf):
    def build():
        return files.write_sentiment_csv(tables.tweets(spark, sf), work_path(spark, "csv-corpus"))
    return _once(spark, sf, "csv_corpus", build)


def q_corpus_csv(spark, sf):
    """The corpus from CSV files whose quoted texts hold their line feeds as they are."""
    return files.read_sentiment_csv(spark, csv_corpus_path(spark, sf))


def q_corpus_csv_escaped(spark, sf):
    """The same from files of one line per text, by the plain line reader."""
    path = files.write_sentiment_csv(tables.tweets(spark, sf), work_path(spark, "csv-escaped"), escape=True)
    return files.read_sentiment_csv(spark, path, escaped=True, quoted_lines=False)


def q_corpus_build(spark, sf, source: str = "file"):
    """The corpus from either source, same columns: (text, label)."""
    if source == "stream":
        return stream_collector(spark, sf).corpus().select("text", "label")
    return files.read_sentiment_csv(spark, csv_corpus_path(spark, sf))


def q_corpus_build_stream(spark, sf):
    return q_corpus_build(spark, sf, "stream")


def q_corpus_dump(spark, sf):
    path = work_path(spark, "corpus-dump")
    files.dump_corpus(catalog.tokenized(spark, sf), path)
    return spark.read.parquet(path)


# ----------------------------------------------------------------------------- scoring by keyword

def search_hits(spark, sf):
    return corpus.search(tables.tweets(spark, sf), catalog.SEARCH_KEYWORD).select(
        "tweet_id", F.col("text").alias("tweet"))


def q_tweet_features(spark, sf):
    tf = features.with_text_java_tf(search_hits(spark, sf), "tweet")
    out = features.with_tf_idf(tf, corpus_idf(spark, sf))
    return out.select("tweet_id", "idx", F.transform("val", lambda v: F.round(v, 9)).alias("val"))


def classify_with(tweets: DataFrame, predictors: dict) -> DataFrame:
    """Score the same tweets with several predictors, long format (model, tweet_id, tweet, prediction).

    A predictor is any function ``DataFrame(tweet_id, tweet, tokens) -> DataFrame`` with
    ``tweet_id`` and ``prediction`` columns.
    """
    parts = [fn(tweets).select(F.lit(name).alias("model"), "tweet_id", "prediction").join(
        tweets.select("tweet_id", "tweet"), "tweet_id") for name, fn in predictors.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("model", "tweet_id", "tweet", "prediction")


def predictors(spark, sf) -> dict:
    return {
        "batch": lambda df: train.predict_batch(batch_model(spark, sf).bestModel, df),
        "online": lambda df: online_scored(spark, sf, df),
    }


def classify(spark, sf) -> DataFrame:
    """Both models on the keyword's tweets."""
    def build():  # at most SEARCH_LIMIT rows, read by each predictor: search once
        return corpus.with_tokens(search_hits(spark, sf), text_col="tweet").persist()
    return classify_with(_once(spark, sf, "search_hits", build), predictors(spark, sf))


def q_classify_keyword(spark, sf):
    return classify(spark, sf)


def fixed_classification(spark, sf) -> DataFrame:
    """The keyword's tweets by two given predictors: the fixture score above one half, and fixed weights on term counts."""
    hits = corpus.with_tokens(search_hits(spark, sf), text_col="tweet")

    def by_weights(df):
        return sgd.with_online_prediction(features.with_java_tf(df, num_features=rules.ONLINE_FEATURES), fixed_weights())

    return classify_with(hits, {
        "batch": lambda df: df.withColumn("prediction", (catalog.fixture_score() > 0.5).cast("double")), "online": by_weights})


def q_classify_fixed(spark, sf):
    return fixed_classification(spark, sf)


def q_classify_fixed_json(spark, sf):
    return classification_json(fixed_classification(spark, sf))


def classification_json(classified: DataFrame) -> DataFrame:
    """The answer of a classification request, one JSON object: per model its tweets in the order of their ids.
    At most SEARCH_LIMIT tweets per model, so one row holds them."""
    pairs = classified.select("model", F.struct("tweet_id", "tweet", F.col("prediction").cast("string").alias("sentiment")).alias("t"))
    answer = lambda model: F.transform(
        F.sort_array(F.collect_list(F.when(F.col("model") == model, F.col("t")))),
        lambda t: F.struct(t["tweet"].alias("tweet"), t["sentiment"].alias("sentiment")))
    both = pairs.groupBy().agg(answer("batch").alias("batchModelResult"), answer("online").alias("onlineModelResult"))
    return both.select(F.to_json(F.struct("batchModelResult", "onlineModelResult")).alias("json"))


def q_classification_json(spark, sf):
    return classification_json(classify(spark, sf))


def q_classify_summary(spark, sf):
    return corpus.sentiment_summary(classify(spark, sf))


def q_flagship(spark, sf):
    """Tweets -> distant labels -> default tokens -> HashingTF + LogisticRegression (one
    setting of the batch grid) fitted on the train split -> test split scored -> sentiment
    summary per model."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression

    data, hasher = split_corpus(spark, sf), features.hashing_tf(1000)
    kept = hasher.transform(data.filter(F.col("split") == "train")).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    model = PipelineModel([hasher, LogisticRegression(maxIter=rules.BATCH_MAX_ITER, regParam=0.01).fit(kept)])
    kept.unpersist()
    scored = train.predict_batch(model, data.filter(F.col("split") == "test")).withColumn("model", F.lit("batch"))
    return corpus.sentiment_summary(scored)


def q_pca(spark, sf):
    emb = tables.table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return train.pca(emb, 3).select("vec_id", vector_to_array("pca").alias("pca"))


def q_pca_tweets(spark, sf):
    """Three principal components of the tweets' hashed term frequencies."""
    made = _once(spark, sf, "pca_features", lambda: java_features(spark, sf, rules.ONLINE_FEATURES).select(
        "tweet_id", "idx", "val").persist(StorageLevel.MEMORY_AND_DISK))
    return pca.pca_sparse(made, rules.ONLINE_FEATURES, 3).select("tweet_id", "pca")


def q_pca_wide(spark, sf):
    """The same over 2^18 buckets, far beyond a square matrix: variance along each component."""
    from pyspark.sql import Row

    model = pca.fit(java_features(spark, sf, WIDE_FEATURES), WIDE_FEATURES, 3)
    return spark.createDataFrame([Row(component=j, variance=float(v)) for j, v in enumerate(model.variances)],
                                 "component int, variance double")


QUERIES = {
    "train_batch": q_train_batch,
    "predict_batch": q_predict_batch,
    "predict_batch_untrained": q_predict_batch_untrained,
    "batch_statistics_fixed": q_batch_statistics_fixed,
    "classify_fixed": q_classify_fixed,
    "classify_fixed_json": q_classify_fixed_json,
    "default_pipeline": q_default_pipeline,
    "batch_latest_model": q_batch_latest_model,
    "sgd_three_steps": q_sgd_three_steps,
    "sgd_warm_start_steps": q_sgd_warm_start_steps,
    "statistics_counts": q_statistics_counts,
    "batch_statistics": q_batch_statistics,
    "train_sgd": q_train_sgd,
    "train_cv_grid": q_train_cv_grid,
    "cv_fold_constants": q_cv_fold_constants,
    "train_warm_start": q_train_warm_start,
    "warm_start_statistics": q_warm_start_statistics,
    "sgd_statistics": q_sgd_statistics,
    "train_online": q_train_online,
    "model_versions": q_model_versions,
    "model_versions_state": q_model_versions_state,
    "latest_model": q_latest_model,
    "online_statistics": q_online_statistics,
    "statistics_feed": q_statistics_feed,
    "online_accuracy_history": q_online_accuracy_history,
    "evaluation_increments": q_evaluation_increments,
    "evaluation_by_clock": q_evaluation_by_clock,
    "statistics_live_feed": q_statistics_live_feed,
    "stream_corpus": q_stream_corpus,
    "stream_progress": q_stream_progress,
    "corpus_csv": q_corpus_csv,
    "corpus_csv_escaped": q_corpus_csv_escaped,
    "corpus_build": q_corpus_build,
    "corpus_build_stream": q_corpus_build_stream,
    "corpus_dump": q_corpus_dump,
    "tweet_features": q_tweet_features,
    "classify_keyword": q_classify_keyword,
    "classification_json": q_classification_json,
    "classify_summary": q_classify_summary,
    "pca": q_pca,
    "pca_tweets": q_pca_tweets,
    "pca_wide": q_pca_wide,
    "flagship": q_flagship,
}
