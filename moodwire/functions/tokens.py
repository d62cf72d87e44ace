"""Tokenizers and the default text chain, as Spark column expressions.

Semantics reproduced (Java ``String.split`` / ``trim`` / ``\\W`` rules):

* words are separated by one space; trailing empty words are dropped, inner
  and leading ones kept; ``\\W+`` (ASCII) is deleted inside each word, so a
  punctuation-only word becomes ``""`` and stays;
* n-grams are built per sentence (text split on ``.``, trailing empty
  sentences dropped, each sentence trimmed of characters <= U+0020); a
  sentence shorter than ``n`` gives one shorter n-gram, an empty one ``""``.

Words are split, cleaned and windowed batch by batch in Arrow tasks (``functions.batches``).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwire.functions import batches
from moodwire.functions import stem as _stem
from moodwire.functions import text as _text

_NON_WORD = r"\W+"


def _clean_words(words: Column) -> Column:
    return F.transform(words, lambda t: F.regexp_replace(t, _NON_WORD, ""))


def unigrams(text: Column) -> Column:
    """Split on one space and delete non-word characters in each token."""
    return F.arrow_udf(lambda texts: batches.unigrams(texts), "array<string>")(text)


def whitespace_unigrams(text: Column) -> Column:
    """Option: split on any run of whitespace (newlines and tabs separate words too)."""
    trimmed = F.regexp_replace(text, r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        _clean_words(F.split(trimmed, r"[ \t\n\x0B\f\r]+")))


def ngrams(text: Column, n: int) -> Column:
    """n-grams within each sentence, joined by one space, all sentences flattened."""
    return F.arrow_udf(lambda texts: batches.ngrams(texts, n), "array<string>")(text)


def bigrams(text: Column) -> Column:
    return ngrams(text, 2)


def trigrams(text: Column) -> Column:
    return ngrams(text, 3)


# what a tokenizer does to an Arrow batch, for chains that join several in one task function
unigrams.of_batch = batches.unigrams
bigrams.of_batch = partial(batches.ngrams, n=2)
trigrams.of_batch = partial(batches.ngrams, n=3)


class TextChain:
    """A user-composed chain: normalizers (``Column -> Column`` on text), an
    optional stemmer (``Column -> Column`` on text; ``None`` = identity) and
    tokenizers whose arrays are concatenated in order."""

    def __init__(self, normalizers: Sequence[Callable[[Column], Column]] = (),
                 stemmer: Callable[[Column], Column] | None = None,
                 tokenizers: Sequence[Callable[[Column], Column]] = (unigrams,)):
        self.normalizers = list(normalizers)
        self.stemmer = stemmer
        self.tokenizers = list(tokenizers)

    def normalize(self, text: Column | str) -> Column:
        c = F.col(text) if isinstance(text, str) else text
        out, lowered = c, False
        for fn in self.normalizers:
            if isinstance(fn, _text.DictionaryRule):
                out, lowered = fn(out, lowered), fn.leaves_lower(lowered)
            else:
                out, lowered = fn(out), False
        return self.stemmer(out) if self.stemmer is not None else out

    def __call__(self, text: Column | str) -> Column:
        return self.tokens_of(self.normalize(text))

    def tokens_of(self, normalized: Column) -> Column:
        forms = [getattr(tok, "of_batch", None) for tok in self.tokenizers]
        if len(forms) > 1 and all(forms):  # the text is normalized once for all, the lists stay in Arrow
            return F.arrow_udf(lambda texts: batches.in_pieces(texts, lambda some: batches.joined([form(some) for form in forms])), "array<string>")(normalized)
        arrays = [tok(normalized) for tok in self.tokenizers]
        return arrays[0] if len(arrays) == 1 else F.concat(*arrays)

    def hashes_of(self, normalized: Column) -> Column | None:
        """The Java hashes of the tokens, as ``array<int>``, without the tokens; None for a chain with a tokenizer
        that is not one of this module's."""
        forms = [getattr(tok, "of_batch", None) for tok in self.tokenizers]
        if not all(forms):
            return None
        return F.arrow_udf(lambda texts: batches.in_pieces(texts, lambda some: batches.joined([form(some, hashes=True) for form in forms])), "array<int>")(normalized)

    def describe(self) -> dict:
        """The chain as plain data (for JSON): dictionaries in full, functions by module and name,
        ``functools.partial`` with its keywords. Lambdas and closures cannot be described and raise."""
        return {"normalizers": [_described(f) for f in self.normalizers],
                "stemmer": None if self.stemmer is None else _described(self.stemmer),
                "tokenizers": [_described(f) for f in self.tokenizers]}

    @classmethod
    def from_description(cls, description: dict) -> TextChain:
        stemmer = description["stemmer"]
        return cls([_named(d) for d in description["normalizers"]], None if stemmer is None else _named(stemmer),
                   [_named(d) for d in description["tokenizers"]])


def _described(part: Callable[[Column], Column]) -> dict:
    if isinstance(part, _text.DictionaryRule):
        return {"dictionary": [list(p) for p in part.pairs], "literal": part.literal, "lowercase": part.lowercase}
    if isinstance(part, partial) and not part.args:
        return _described(part.func) | {"keywords": part.keywords}
    name = f"{getattr(part, '__module__', None)}:{getattr(part, '__qualname__', '<>')}"
    if "<" in name or _imported(name) is not part:
        raise ValueError(f"{part!r} cannot be described: use a function of a module, or functools.partial of one with keywords")
    return {"function": name}


def _imported(name: str) -> Callable[[Column], Column] | None:
    module, _, path = name.partition(":")
    return reduce(lambda o, a: getattr(o, a, None), path.split("."), importlib.import_module(module))


def _named(description: dict) -> Callable[[Column], Column]:
    if "dictionary" in description:
        return _text.DictionaryRule([tuple(p) for p in description["dictionary"]], description["literal"], description["lowercase"])
    found = _imported(description["function"])
    return partial(found, **description["keywords"]) if "keywords" in description else found


DEFAULT_CHAIN = TextChain(
    normalizers=[_text.normalize_sentiment, _text.normalize_shortforms, _text.normalize_noise],
    stemmer=_stem.stem_text,
    tokenizers=[unigrams, bigrams],
)


def default_tokens(text: Column | str) -> Column:
    """Emoticons -> short forms -> noise -> stem -> unigrams ++ bigrams."""
    return DEFAULT_CHAIN(text)
