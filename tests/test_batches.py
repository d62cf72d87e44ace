"""Word-level work of a batch: once per distinct word, in bounded pieces, equal to plain Python."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodwire.functions import batches, stem, text, tokens
from moodwire.operators import corpus, features


def test_a_distinct_word_is_stemmed_once(monkeypatch):
    seen = []
    monkeypatch.setattr(stem, "stem_word", lambda w: seen.append(w) or w)
    assert stem._stem_texts(pa.array(["cars  cars boy", None, "", "cars "])).to_pylist() == ["cars  cars boy", None, "", "cars"]
    assert sorted(seen) == ["", "boy", "cars"]


def test_lists_with_nulls_blanks_and_slices():
    texts = pa.array(["x", "a-b  c ", "  ", None, "", "é1 .b"]).slice(1)
    assert batches.unigrams(texts).to_pylist() == [["ab", "", "c"], [], None, [""], ["1", "b"]]
    assert batches.ngrams(pa.array(["q", "a b c. d", "..", None, "", "a..b"]).slice(1), 2).to_pylist() == [
        ["a b", "b c", "d"], [], None, [""], ["a", "", "b"]]
    assert batches.ngrams(pa.array(["a b c d"]), 3).to_pylist() == [["a b c", "b c d"]]


def test_java_hashes():
    def java(s):
        h = 0
        for c in s:
            h = (31 * h + ord(c)) & 0xFFFFFFFF
        return h - (1 << 32) if h >> 31 else h

    words = ["", "a", "polygenelubricants", "user name" * 40, "é𝒳日", "", "z"]
    assert batches.java_hashes(pa.array(words)).tolist() == [java(w) for w in words]
    assert batches.java_hashes(pa.array(words[:4]).slice(1)).tolist() == [java(w) for w in words[1:4]]
    assert batches.java_hashes(pa.array([], pa.string())).tolist() == []


@pytest.mark.parametrize("piece", [1, 3, 1000])
def test_term_counts_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(batches, "PIECE", piece)
    got = batches.term_counts(pa.array([["b", "a", "b"], [], None, ["c", None, "k"], ["a"]]), 10).to_pylist()
    assert got == [{"idx": [7, 8], "val": [1.0, 2.0]}, {"idx": [], "val": []}, None, {"idx": [7, 9], "val": [1.0, 1.0]},
                   {"idx": [7], "val": [1.0]}]


def test_short_forms_are_searched_as_literals(spark):
    """The pattern given to Java starts with its word (a literal search), and boundaries decide as before."""
    assert text._searchable(r"\bdon't\b").startswith("don't") and text._searchable(r"@\S+") == r"@\S+"
    said = "u u're hahaha haha_ haha don't-can't éu cannot"
    made = spark.createDataFrame([(said,)], "t string").select(text.normalize_shortforms(F.col("t")))
    plain = F.lower(F.col("t"))
    for pattern, value in text.rules.SHORT_FORMS:
        plain = F.regexp_replace(plain, pattern, value)
    assert made.first()[0] == spark.createDataFrame([(said,)], "t string").select(plain).first()[0]


def test_chain_runs_in_batches_of_rows(spark):
    """Words are not mapped one by one by interpreted lambdas: the chain's plan holds none."""
    df = spark.createDataFrame([("the boy's cars :)",)], "t string").select(tokens.default_tokens("t"))
    assert "lambdafunction" not in df._jdf.queryExecution().toString()
    assert df.first()[0] == ["the", "boy", "car", "good", "the boy", "boy car", "car good"]


def test_tokenizers_of_a_chain_are_joined_in_one_task_function(spark):
    """Equal to the arrays joined by Spark, nulls and slices too; the text is normalized and stemmed in one pass."""
    texts = pa.array(["q", "the cars. a-b", None, "", "  ", "..", "é1 .b"])
    want = [None if u is None else u + g for u, g in zip(batches.unigrams(texts).to_pylist(), batches.ngrams(texts, 2).to_pylist())]
    assert batches.joined([batches.unigrams(texts), batches.ngrams(texts, 2)]).to_pylist() == want
    part = texts.slice(1, 4)
    assert batches.joined([batches.unigrams(texts).slice(1, 4), batches.ngrams(part, 2)]).to_pylist() == want[1:5]
    assert batches.joined([batches.unigrams(texts.slice(0, 0)), batches.ngrams(texts.slice(0, 0), 2)]).to_pylist() == []
    plan = spark.createDataFrame([("a b",)], "t string").select(
        tokens.default_tokens("t").alias("made"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_stem_texts(") == 1 and "concat(" not in plan


def test_hashes_without_tokens_are_the_tokens_hashes(spark):
    """Word hashes put together give every n-gram's hash, also of short and empty sentences, nulls and slices."""
    texts = pa.array(["q", "the cars are. a-b", None, "", "  ", "..", "é1 .b", "a..b c d e. _x " + "long" * 30]).slice(1)
    for form, n in ((batches.unigrams, ()), (batches.ngrams, (2,)), (batches.ngrams, (3,))):
        tokens_of = form(texts, *n)
        want = [None if t is None else batches.java_hashes(pa.array(t, pa.string())).tolist() for t in tokens_of.to_pylist()]
        assert form(texts, *n, hashes=True).to_pylist() == want
        assert batches.term_counts(form(texts, *n, hashes=True), 50).equals(batches.term_counts(tokens_of, 50))
    df = spark.createDataFrame([(1, "The boys' cars :) didn't go. Go"), (2, None), (3, ""), (4, " . ")], "id int, text string")
    got = features.with_text_java_tf(df).select("id", "idx", "val").collect()
    assert got == features.with_java_tf(corpus.with_tokens(df)).select("id", "idx", "val").collect()
    own = tokens.TextChain([text.normalize_noise], None, [tokens.whitespace_unigrams])
    assert features.with_text_java_tf(df, chain=own).select("id", "idx", "val").collect() == features.with_java_tf(
        corpus.with_tokens(df, chain=own)).select("id", "idx", "val").collect()
    plan = features.with_text_java_tf(df).select("idx", "val")._jdf.queryExecution().executedPlan().toString()
    assert "array<string>" not in plan


ODD_TEXTS = ["u don't, can't: you're hahaha haha.", "éu uè ú éu ́u _u u_ ü u", "cannot u’s won't‍u", "x\U0001d400u u\U0001d400",
             "u\U000e0100 \U000e0100u á́u ́́u 1́u _́u", "sooooo aaa---bbb___ aabbb éééé ..... zzzzz\nzz", "@ @a@b @ x\ty @@@ a@\x0bb",
             "http://x http:// http://http://a\nb https://c", "", " ", "-_-", "don't'u'don't uu u u", "u힣u u٠ ٠u Ⅰu", "haha" * 3, "you're're u're"]


def test_rules_in_arrow_tasks_equal_java_patterns(spark):
    """Patterns of simple form leave the JVM: word boundaries, classes and runs as Java's patterns have them."""
    from pyspark.sql import functions as F

    from moodwire.functions import batches, rules, text

    df = spark.createDataFrame([(k, t) for k, t in enumerate([*ODD_TEXTS, None])], "k int, t string")
    for rule in (text.normalize_shortforms, text.normalize_noise):
        assert all(batches.text_change(*pair) for pair in rule.pairs)
        java = F.lower("t")
        for pattern, replacement in rule.pairs:
            java = F.regexp_replace(java, pattern, replacement)
        for k, got, want in df.select("k", rule("t"), java).collect():
            assert got == want, k
    assert batches.text_change(r"https?:\/\/\S+", "url") is None and batches.text_change(r"\ba\b", "$0") is None


def test_text_chain_makes_lower_case_once(spark):
    """Between two rules nothing is done in the JVM: one Python node for the whole chain."""
    from moodwire.operators import features

    df = spark.createDataFrame([(1, "A B :) don't")], "k int, text string")
    plan = features.with_text_java_tf(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan


def test_repeated_words_are_stemmed_once_per_worker():
    from moodwire.functions import stem

    stem.stem_word.cache_clear()
    assert [stem.stem_word(w) for w in ("running", "running", "flies")] == ["run", "run", "fli"]
    assert stem.stem_word.cache_info().misses == 2


def test_words_that_no_step_looks_at_are_not_stemmed(monkeypatch):
    """Endings of every step, markers, marks and letters beyond ASCII: the stems of all words are those of ``stem_word``,
    which is asked for the few that a step may change."""
    tails = sorted(stem.TAILS2 | stem.TAILS3 | stem.TAILS4) + ["s", "ss", "ed", "ing", "eed", "y", "ll", "e", stem.REMOVED, stem.SHORT, "", ",", "\u00e9", "\u65e5"]
    words = [None, "", "a", "Y", "Yes", "yes", "\u00e9s"] + [head + tail for head in ("b", "tr", "hop", "generat", "Yrel", "yon", "\u00e9t\u00e9") for tail in tails]
    array = pa.array(words)
    expected = [None if w is None else stem.stem_word(w) for w in words]
    assert stem._stem_distinct(array).to_pylist() == expected
    assert stem._stem_distinct(array.slice(5, 40)).to_pylist() == expected[5:45]
    assert stem._stem_distinct(array.slice(0, 0)).to_pylist() == []
    asked = []
    monkeypatch.setattr(stem, "stem_word", lambda w: asked.append(w) or w)
    stem._stem_distinct(pa.array(["haus.", "hand", "hoch", "rather,", "Yak", "zu"]))
    assert asked == ["hand", "Yak", "zu"]


def test_pieces_of_a_batch_give_what_the_whole_gives(monkeypatch):
    """The text chain takes a batch some texts at a time; no piece holds more than its bytes, or one text."""
    texts = pa.array(["Cars, cars running. boys", None, "", " ", ".", "a" * 90, "sooo baaad day.  two  words ", "ende é. x"] * 5)
    steps = [lambda t: batches.replace_all(t, [("a", "b"), ("é", "e")]), stem._stem_texts,
             lambda t: batches.joined([batches.unigrams(t), batches.ngrams(t, 2)]),
             lambda t: batches.joined([batches.unigrams(t, hashes=True), batches.ngrams(t, 2, hashes=True)])]
    whole = [step(texts) for step in steps]
    monkeypatch.setattr(batches, "PIECE_BYTES", 64)
    for step, expected in zip(steps, whole):
        sizes = []
        got = batches.in_pieces(texts.slice(3), lambda some: sizes.append((len(some), sum(len(t.encode()) for t in some.to_pylist() if t))) or step(some))
        assert got.to_pylist() == expected.to_pylist()[3:] and got.type == expected.type
        assert len(sizes) > 5 and all(held <= 64 or rows == 1 for rows, held in sizes)
        assert batches.in_pieces(texts.slice(0, 0), step).to_pylist() == []
