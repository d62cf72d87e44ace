"""The pipeline against plain Python, stage by stage, on the whole small tables."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq

import corpus_pipeline
from moodwire.llm import quality, tokens
from test_dedup import join_by_hand
from test_rows import counts_by_hand, mcd_distances, spans_by_hand

SMALL = "/root/testdata/sf0.001"


def good_by_hand(rows):
    """Indices that pass operator 10; at this scale no source of a language has rows enough for an estimate
    of its own: languages have one, rare ones are held to the estimate over all languages."""
    vectors, passed = {}, []
    for k, r in enumerate(rows):
        n, chars, symbols, lines, repeats = counts_by_hand(r["text"])
        if n < 50 or 100 * repeats > 50 * n:
            continue
        passed.append(k)
        vectors[k] = [round(v * quality.UNIT) for v in (
            np.log(chars / n), np.log1p(100 * symbols / chars), np.log1p(100 * lines / n), repeats / n)]
    assert max(Counter((r["lang"], r["source"]) for r in rows).values()) < quality.LEAST <= len(passed)
    distances = lambda group: dict(zip(group, mcd_distances([vectors[k] for k in group])))
    over_all, kept = distances(passed), set()
    for lang in {r["lang"] for r in rows}:
        group = [k for k in passed if rows[k]["lang"] == lang]
        found = over_all if len(group) < quality.LEAST else distances(group)
        kept |= {k for k in group if found[k] <= quality.CUTOFF}
    return sorted(kept)


def redacted_by_hand(text):
    spans = [tuple(map(int, s.split(":")[1:])) for s in spans_by_hand(text).split(",") if s]
    out, at, end = [], 0, 0
    for a, b in spans:
        if a >= end:
            out += [text[at:a], "[SECRET]"]
        end = at = max(end, b)
    return "".join(out) + text[at:]


def test_pipeline_by_hand(spark):
    rows = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    rows = [rows[k] for k in good_by_hand(rows)]
    seen = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        seen.setdefault(re.sub("[\x20\x09-\x0D]+", " ", r["text"]), r)
    rows = list(seen.values())
    heads = {c for _, c, _ in join_by_hand([(r["doc_id"], r["text"]) for r in rows])}
    rows = [r for r in rows if r["doc_id"] in heads]
    lib, want, tokens_of = tokens.library(public_tokenizers.path("word_bpe_49k.json")), Counter(), 0
    for r in rows:
        ids = lib.encode(redacted_by_hand(r["text"]), add_special_tokens=False).ids + [2]
        tokens_of += len(ids)
        for start in range(0, len(ids), 4096):
            piece = ids[start : start + 4096]
            want[r["doc_id"], start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids)] += 1
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = {r.sequence_id for r in got}
    assert tokens_of > 0.95 * 4096 * (len(sequences) - 1)


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.schema == docs.schema or out.dtypes == docs.dtypes
        empty = stage(spark, docs.limit(0), SMALL)
        assert empty.dtypes == docs.dtypes and empty.count() == 0
    assert corpus_pipeline.packing_stage(spark, docs.limit(0), SMALL).count() == 0
    assert corpus_pipeline.secret_stage(spark, docs, SMALL).count() == docs.count()


def test_quality_stage_judges_rare_languages(spark):
    """The languages of the small table with too few rows are held to the estimate over all languages."""
    rows = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    langs, vectors = [], {}
    for r in rows:
        n, chars, symbols, lines, repeats = counts_by_hand(r["text"])
        if n >= 50 and 100 * repeats <= 50 * n:
            langs.append(r["lang"])
            vectors[r["doc_id"]] = [round(v * quality.UNIT) for v in (
                np.log(chars / n), np.log1p(100 * symbols / chars), np.log1p(100 * lines / n), repeats / n)]
    sizes, ids = Counter(langs), list(vectors)
    over_all = dict(zip(ids, mcd_distances([vectors[i] for i in ids])))
    want = {i for i, g in zip(ids, langs) if sizes[g] < quality.LEAST and over_all[i] <= quality.CUTOFF}
    rare = [g for g, n in sizes.items() if n < quality.LEAST]
    got = corpus_pipeline.quality_stage(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL)
    assert {r.doc_id for r in got.select("doc_id", "lang").collect() if r.lang in rare} == want
    assert 0 < len(want) < sum(sizes[g] for g in rare)
