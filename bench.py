"""Benchmark of the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
(default 8) and prints one JSON line. Each query is run to completion through
the ``noop`` sink (the whole plan executes, nothing is collected) and starts cold:
remembered models and cached tables are dropped before it, so its time holds
everything it needs. $BENCH_RUNS (default 1) runs each query that often and
gives the median. One scan of the documents warms up the JVM.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "default_tokens",  # emoticons, short forms, noise, Porter stemmer, unigrams + bigrams
    "vocabulary",  # token term and document frequency (one shuffle)
    "hashing_tf_java",  # Java-hash term frequencies
    "tf_idf",  # IDF fit + TF-IDF
    "stem_vocabulary",  # distinct words and their stems
    "balanced_cap",  # class-balanced corpus (window group limit)
    "corpus_progress",  # distributed running totals per micro-batch
    "stream_corpus",  # Structured Streaming: status files -> foreachBatch class-capped collection
    "auc_roc",  # area under ROC (distributed prefix sums)
    "precision_recall",
    "train_batch",  # 2-fold CV of Pipeline(HashingTF, LogisticRegression), 6 settings
    "predict_batch",
    "train_sgd",  # SGD logistic regression, up to 200 iterations
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from moodwire.session import local_session
    from moodwire.plans import catalog, models

    spark = local_session(cpus, app="moodwire-bench", shuffle_partitions=max(8, int(cpus)))
    queries = catalog.all_queries()
    spark.read.parquet(f"{sf_dir}/documents.parquet").write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            models.forget()
            spark.catalog.clearCache()
            t0 = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        times[name] = round(statistics.median(runs), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
