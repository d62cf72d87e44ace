"""Tokenizers against a small Python model of Java's split / trim / \\W semantics."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodwire.functions import tokens


def java_split(s, pattern):
    parts = re.split(pattern, s)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_trim(s):
    i, j = 0, len(s)
    while i < j and s[i] <= " ":
        i += 1
    while j > i and s[j - 1] <= " ":
        j -= 1
    return s[i:j]


def unigram(s):
    return [re.sub(r"\W+", "", t, flags=re.ASCII) for t in java_split(s, " ")]


def ngram(s, n):
    out = []
    for sentence in java_split(s, r"\."):
        toks = unigram(java_trim(sentence))
        for i in range(max(len(toks) - n + 1, 1)):
            out.append(" ".join(toks[i:i + n]))
    return out


texts = st.lists(st.text(alphabet="ab .!\t\né", max_size=14), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None)
@given(texts)
def test_tokenizers_match_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "text string")
    rows = df.select("text", tokens.unigrams(F.col("text")).alias("u"), tokens.bigrams(F.col("text")).alias("b"),
                     tokens.trigrams(F.col("text")).alias("t")).collect()
    for r in rows:
        assert r.u == unigram(r.text), r.text
        assert r.b == ngram(r.text, 2), r.text
        assert r.t == ngram(r.text, 3), r.text
