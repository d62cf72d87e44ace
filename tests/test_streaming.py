"""Streams against the same plan in batch, restart idempotency, the entry contract."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from moodwire.plans import catalog
from moodwire.session import work_path
from moodwire.sources import tables
from moodwire.streaming import online


def landed(spark, small_dir, ranges):
    """The source folder, once after each range of arrival has landed in it."""
    path = work_path(spark, "t-status")
    for _ in online.land_in_order(tables.tweets(spark, small_dir), work_path(spark, "t-staging"), path, ranges):
        yield path


def test_landed_ranges_are_whole_and_in_order(spark, small_dir):
    table, seen = tables.tweets(spark, small_dir), []
    for path in landed(spark, small_dir, 4):
        now = {r.tweet_id for r in spark.read.parquet(path).select("tweet_id").collect()}
        new = sorted(now - set(seen))
        assert not seen or not new or new[0] > max(seen)
        seen += new
    assert len(seen) == table.count()


def test_unreadable_state_raises_instead_of_starting_anew(spark, tmp_path):
    """A missing table means nothing was collected; a broken one must not pass for that."""
    collector = online.CorpusCollector(spark, corpus_path=str(tmp_path / "none"))
    assert collector.totals_before(3) == {0.0: 0, 1.0: 0}
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    trainer = online.OnlineTrainer(spark, weights_path=str(broken), num_features=10)
    with pytest.raises(Exception):
        trainer.weights_before(1)


def test_stream_corpus_equals_batch_cap(spark, small_dir):
    collector = online.CorpusCollector(spark, target=40)
    for path in landed(spark, small_dir, 3):
        if not collector.state.full:
            got = collector.run(online.status_stream(spark, path))
    batch = catalog.corpus.balanced_cap(catalog.streamed_corpus(spark, small_dir), target=40)
    assert sorted(r.tweet_id for r in got.collect()) == sorted(r.tweet_id for r in batch.collect())
    prog = collector.progress().orderBy("batch_id").collect()
    assert prog[-1]["positives"] <= 20 and prog[-1]["negatives"] <= 20


def test_online_trainer_versions_and_replay(spark, small_dir):
    trainer = online.OnlineTrainer(spark, num_features=100, iterations=4)
    for path in landed(spark, small_dir, 2):
        trainer.run(online.status_stream(spark, path))
    assert [v["version"] for v in trainer.versions().orderBy("version").collect()] == [0, 1]

    # a replayed batch starts again from the previous version, so it writes the same weights
    labelled = online.labelled_stream(tables.tweets(spark, small_dir))
    first, second = labelled.filter(F.col("tweet_id") % 2 == 0), labelled.filter(F.col("tweet_id") % 2 == 1)
    fresh = online.OnlineTrainer(spark, num_features=100, iterations=4)
    fresh.process(first, 0)
    fresh.process(second, 1)
    w1 = fresh.versions().filter("version = 1").first()["weights"]
    fresh.process(second, 1)
    assert np.allclose(fresh.versions().filter("version = 1").first()["weights"], w1, atol=1e-12)
    assert fresh.weights_before(1) == fresh.versions().filter("version = 0").first()["weights"]


def test_entry_runs(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) >= 1
    assert set(rows[0].asDict()) == {"model", "negative", "positive", "sentiment", "percent"}


def test_collector_with_processing_time_trigger_stops_when_full(spark, small_dir):
    *_, path = landed(spark, small_dir, 3)
    collector = online.CorpusCollector(spark, target=20)
    got = collector.run(online.status_stream(spark, path), available_now=False, timeout=120)
    assert collector.state.full
    counts = {r["label"]: r["count"] for r in got.groupBy("label").count().collect()}
    assert counts == {0.0: 10, 1.0: 10}


def commits(path):
    return sorted(int(f.name) for f in (path / "commits").iterdir() if f.name.isdigit())


@pytest.mark.parametrize("available_now", [True, False])
def test_stop_follows_the_commit_and_nothing_is_replayed(spark, small_dir, tmp_path, available_now):
    *_, path = landed(spark, small_dir, 4)
    where = {"corpus_path": str(tmp_path / "corpus"), "checkpoint": str(tmp_path / "ckpt"), "target": 20}
    first = online.CorpusCollector(spark, **where)
    first.run(online.status_stream(spark, path, files_per_trigger=1), available_now, timeout=120)
    filled = first.state.filled_by
    assert first.state.full and filled in commits(tmp_path / "ckpt")
    rows = sorted(r.tweet_id for r in first.corpus().collect())

    # full: no query starts; with room again, the next run goes on behind the committed batch
    again = online.CorpusCollector(spark, **where)
    again.run(online.status_stream(spark, path, files_per_trigger=1))
    assert again.state.processed == [] and sorted(r.tweet_id for r in again.corpus().collect()) == rows
    more = online.CorpusCollector(spark, **{**where, "target": 24})
    more.run(online.status_stream(spark, path, files_per_trigger=1))
    assert more.state.processed and min(more.state.processed) > filled
    assert set(rows) < {r.tweet_id for r in more.corpus().collect()}


def test_progress_is_observed_and_replay_gives_the_same_totals(spark, small_dir):
    labelled = online.labelled_stream(tables.tweets(spark.newSession(), small_dir))  # as a stream's batches
    parts = [labelled.filter(F.col("tweet_id") % 3 == k) for k in range(3)]
    collector = online.CorpusCollector(spark, target=60)
    for k, part in enumerate(parts):
        collector._process(part, k)
    rows = collector.progress().orderBy("batch_id").collect()
    for r in rows:
        upto = collector.corpus().filter(F.col("batch_id") <= r.batch_id)
        assert (upto.filter("label = 1.0").count(), upto.filter("label = 0.0").count()) == (r.positives, r.negatives)
    replay = online.CorpusCollector(spark, corpus_path=collector.corpus_path, target=60)
    replay._process(parts[1], 1)  # after a restart: nothing is known but the tables
    assert replay.progress().orderBy("batch_id").collect() == rows
    replay._process(labelled.limit(0), 3)
    assert replay.progress().orderBy("batch_id").collect() == rows


def test_evaluation_by_the_clock_and_mixed_features(spark, small_dir):
    table = tables.tweets(spark, small_dir)
    labelled = online.labelled_stream(table)
    trainer = online.OnlineTrainer(spark, num_features=50, iterations=2, holdout=labelled, evaluate_seconds=3600,
                                   score_idf=[float(i) for i in range(50)])
    trainer.process(labelled, 0)
    trainer.process(labelled, 1)
    assert [r.model_version for r in trainer.statistics().collect()] == [0]  # the second is not due yet
    plain = trainer.features(labelled, None).orderBy("tweet_id").first()
    mixed = trainer.features(labelled, trainer.score_idf).orderBy("tweet_id").first()
    assert np.allclose(mixed.val, [v * i for i, v in zip(plain.idx, plain.val)])


def test_token_transformer_in_a_pipeline(spark, small_dir):
    from pyspark.ml import Pipeline

    from moodwire.operators import corpus, features

    table = catalog.labelled(spark, small_dir)
    model = Pipeline(stages=[features.TokenTransformer(), features.hashing_tf(20)]).fit(table)
    got = model.transform(table).select("tweet_id", "tokens")
    want = corpus.with_tokens(table).select("tweet_id", "tokens")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_model_in_the_state_store_survives_a_kill_before_the_commit(spark, small_dir, tmp_path):
    from moodwire.streaming import stateful

    table = online.OnlineTrainer(spark, num_features=100, iterations=4)
    where = {"weights_path": str(tmp_path / "weights"), "checkpoint": str(tmp_path / "ckpt"), "num_features": 100, "iterations": 4}
    for path in landed(spark, small_dir, 3):
        table.run(online.status_stream(spark, path))
        stateful.StatefulTrainer(spark, **where).run(online.status_stream(spark, path))

    def versions(t):
        return {r.version: (r.rows, np.array(r.weights)) for r in t.versions().collect()}

    def same(a, b):
        return a.keys() == b.keys() and all(a[v][0] == b[v][0] and np.allclose(a[v][1], b[v][1], atol=1e-12) for v in a)

    want = versions(table)
    assert same(versions(stateful.StatefulTrainer(spark, **where)), want)
    # killed after the last version was written, before its batch was committed
    last = commits(tmp_path / "ckpt")[-1]
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "ckpt" / "commits" / name).unlink(missing_ok=True)
    again = stateful.StatefulTrainer(spark, **where)
    again.run(online.status_stream(spark, path))
    assert last in commits(tmp_path / "ckpt") and same(versions(again), want)


def test_models_with_their_own_state(spark, small_dir):
    from moodwire.streaming import stateful

    *_, path = landed(spark, small_dir, 2)
    trainer = stateful.StatefulTrainer(spark, num_features=50, iterations=3, model=(F.col("tweet_id") % 2).cast("string"))
    trainer.run(online.status_stream(spark, path))
    labelled = online.labelled_stream(tables.tweets(spark, small_dir))
    got = {r.model: r for r in trainer.versions().collect()}
    assert set(got) == {"0", "1"} and all(r.version == 0 for r in got.values())
    for name, r in got.items():
        plain = online.OnlineTrainer(spark, num_features=50, iterations=3)
        plain.process(labelled.filter(F.col("tweet_id") % 2 == int(name)), 0)
        assert np.allclose(plain.versions().first()["weights"], r.weights, atol=1e-12)


def test_saved_pipeline_takes_raw_text(spark, small_dir, tmp_path):
    from functools import partial

    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression

    from moodwire.functions import stem, text, tokens
    from moodwire.operators import features

    table = catalog.labelled(spark, small_dir)
    chain = tokens.TextChain([text.DictionaryRule({"haha": "laugh"}), text.normalize_noise], stem.stem_text,
                             [tokens.unigrams, partial(tokens.ngrams, n=3)])
    for k, c in enumerate((tokens.DEFAULT_CHAIN, chain)):
        model = Pipeline(stages=[features.TokenTransformer(c), features.hashing_tf(50), LogisticRegression(maxIter=3)]).fit(table)
        model.write().overwrite().save(str(tmp_path / str(k)))
        loaded = PipelineModel.load(str(tmp_path / str(k)))
        cols = ["tweet_id", "tokens", "prediction"]
        got, want = (m.transform(table).select(*cols) for m in (loaded, model))
        assert got.exceptAll(want).count() == 0 and got.count() == table.count()
    with pytest.raises(ValueError, match="cannot be described"):
        features.TokenTransformer(tokens.TextChain(tokenizers=[lambda c: F.split(c, " ")])).write()
