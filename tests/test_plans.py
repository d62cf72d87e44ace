"""Physical plans have the shape the design relies on at scale."""

import re

import pytest

import __spark_entry__ as entry_module
from moodwire.plans import catalog


def plan(spark, small_dir, key):
    df = entry_module.queries()[key](spark, small_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    p = plan(spark, small_dir, "stream_filter")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)" in scan or "EqualTo(lang,en)" in scan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in scan  # n_chars, source pruned


def test_cap_limits_each_class_before_the_shuffle(spark, small_dir):
    lines = plan(spark, small_dir, "balanced_cap").splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    shuffle = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line][0]
    assert any(", Partial" in lines[i] and i > shuffle for i in limits)  # below the shuffle: map side
    assert any(", Final" in lines[i] and i < shuffle for i in limits)


def test_search_is_a_top_k(spark, small_dir):
    assert "TakeOrderedAndProject(limit=100" in plan(spark, small_dir, "keyword_search")


@pytest.mark.parametrize("key", ["vocabulary", "doc_frequency", "class_counts"])
def test_aggregations_combine_before_the_shuffle(spark, small_dir, key):
    p = plan(spark, small_dir, key)
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", p)


@pytest.mark.parametrize("key", ["default_tokens", "hashing_tf_java", "normalize_noise", "tokens_bigram"])
def test_text_work_is_row_local(spark, small_dir, key):
    p = plan(spark, small_dir, key)
    exchanges = [line for line in p.splitlines() if "Exchange" in line]
    # at most the round-robin spread of a scan with fewer splits than cores, never a keyed shuffle
    assert all("RoundRobinPartitioning" in line for line in exchanges), exchanges


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_filters_do_not_repeat_the_text_chain(spark, small_dir, key):
    """No filter of an optimized plan holds the text chain written out again and again."""
    optimized = entry_module.queries()[key](spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    longest = max((len(line) for line in optimized.splitlines() if re.match(r"[\s:+-]*Filter ", line)), default=0)
    assert longest < 20_000 and len(optimized) < 200_000


def test_tf_idf_applies_the_vector_without_a_shuffle(spark, small_dir):
    p = plan(spark, small_dir, "tf_idf")
    assert "Exchange" not in p  # reads the checkpointed term frequencies, scales them row by row


def test_cap_is_exact_under_heavy_skew(spark):
    from pyspark.sql import functions as F

    from moodwire.operators import corpus

    n = 200_000  # 99% of the rows in one class
    df = spark.range(n).select(F.col("id").alias("tweet_id"), F.col("id").alias("ts"),
                               F.when(F.col("id") % 100 == 0, 0.0).otherwise(1.0).alias("label")).repartition(16)
    capped = corpus.balanced_cap(df, target=500)
    got = {r["label"]: (r["c"], r["hi"]) for r in capped.groupBy("label").agg(
        F.count(F.lit(1)).alias("c"), F.max("tweet_id").alias("hi")).collect()}
    assert got[1.0] == (250, 252)  # the first 250 positives in arrival order: ids 1-99, 101-199, 201-252
    assert got[0.0] == (250, 24900)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and ", Partial" in plan


def test_text_chain_runs_on_the_hits_alone(spark, small_dir):
    """The search keeps its top rows first: the chain stands above the limit in the plan, nothing is sorted as a whole."""
    from moodwire.operators import corpus, features
    from moodwire.plans import models

    hits = models.search_hits(spark, small_dir)
    for made in (features.with_text_java_tf(hits, "tweet").select("idx"), corpus.with_tokens(hits, "tweet").select("tokens")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("TakeOrderedAndProject") == 1 and "rangepartitioning" not in plan
        assert plan.rindex("ArrowEvalPython") < plan.index("TakeOrderedAndProject")
