"""Golden values of normalizers, stemmer, tokenizers and chains.

Fixed values: inputs and results that any equivalent implementation must reproduce.
"""

import pytest
from pyspark.sql import functions as F

from moodwire.functions import stem, text, tokens
from moodwire.plans import catalog


def one(spark, fn, value):
    df = spark.createDataFrame([(value,)], "text string")
    return df.select(fn(F.col("text")).alias("o")).first()["o"]


@pytest.mark.parametrize("inp,expected", [
    ("cool and suuuuper cuuute", "cool and suuper cuute"),
    ("@alice42 @Bob_Smith asked @carol to change his username",
     "username username asked username to change his username"),
    ("http://bit.ly/1NJl0Xu is short for http://www.example.com/", "url is short for url"),
    ("lorem-ipsum dolor_sit amet", "lorem ipsum dolor sit amet"),
])
def test_noise(spark, inp, expected):
    assert one(spark, text.normalize_noise, inp) == expected


@pytest.mark.parametrize("inp,expected", [
    ("i &lt;3 scala so much :)", "i good scala so much good"),
    ("i ❤ scala so much \U0001F604", "i good scala so much good"),
])
def test_emoticons(spark, inp, expected):
    assert one(spark, text.normalize_sentiment, inp) == expected


def test_short_forms(spark):
    got = one(spark, text.normalize_shortforms,
              "i didn't know that u haven't fixed that issue yet. haha. you're fired!")
    assert got == "i did not know that you have not fixed that issue yet. ha. you are fired!"


def test_stemmer_golden(spark):
    assert one(spark, stem.stem_text, "the boy cars are different colors") == "the boi car ar differ color"


@pytest.mark.parametrize("word,expected", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("cats", "cat"), ("feed", "feed"),
    ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"),
    ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"),
    ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"), ("filing", "file"),
    ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("generalization", "gener"),
    ("oscillators", "oscil"), ("yes", "ye"), ("as", "as"), ("ay", "ay"), ("", ""),
])
def test_porter_words(spark, word, expected):
    df = spark.createDataFrame([(word,)], "w string")
    assert df.select(F.element_at(stem.stem_words(F.array("w")), 1)).first()[0] == expected


SENTENCE = "i love my kindle2. the 2 is fantastic."


def test_unigram(spark):
    assert one(spark, tokens.unigrams, SENTENCE) == ["i", "love", "my", "kindle2", "the", "2", "is", "fantastic"]


def test_ngram1_equals_unigrams_here(spark):
    assert one(spark, lambda c: tokens.ngrams(c, 1), SENTENCE) == one(spark, tokens.unigrams, SENTENCE)


def test_bigram(spark):
    assert one(spark, tokens.bigrams, SENTENCE) == ["i love", "love my", "my kindle2", "the 2", "2 is",
                                                    "is fantastic"]


def test_trigram(spark):
    assert one(spark, tokens.trigrams, SENTENCE) == ["i love my", "love my kindle2", "the 2 is", "2 is fantastic"]


@pytest.mark.parametrize("inp,uni,bi", [
    ("wow. it is", ["wow", "it", "is"], ["wow", "it is"]),
    ("a..b", ["ab"], ["a", "", "b"]),
    ("...", [""], []),
    ("", [""], [""]),
    ("a  b ", ["a", "", "b"], ["a ", " b"]),
    ("   ", [], [""]),
])
def test_edges(spark, inp, uni, bi):
    assert one(spark, tokens.unigrams, inp) == uni
    assert one(spark, tokens.bigrams, inp) == bi


def test_default_chain(spark):
    assert one(spark, tokens.default_tokens, "foobar :) @someone") == [
        "foobar", "good", "usernam", "foobar good", "good usernam"]


def test_custom_chain(spark):
    assert one(spark, catalog.CUSTOM_CHAIN, "hello colour universe") == ["hello", "color", "universe"]


def test_distant_label_and_flags(spark):
    df = spark.createDataFrame([("great :)",), ("bad :(",), ("meh",), ("both :) :(",)], "text string")
    rows = df.select(text.distant_label(F.col("text")), text.is_neutral(F.col("text"))).collect()
    assert [r[0] for r in rows] == [1.0, 0.0, 0.0, 1.0]
    assert [r[1] for r in rows] == [False, False, True, False]
