"""Text normalizers as Spark column expressions.

Every function maps ``Column -> Column`` and is a narrow, row-local projection: no shuffle.
Predicates and general regular expressions are JVM-side string functions. Literal dictionaries, and patterns of
the simple forms that ``batches.text_change`` knows, are replaced batch by batch in Arrow tasks, where a key that a
text does not hold costs next to nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwire.functions import batches, rules

ColumnFn = Callable[[Column], Column]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _searchable(pattern: str) -> str:
    """An equal pattern that Java finds faster, of one that is a bare word between word boundaries: it starts
    with the word, which is searched for as a literal, and looks at the boundary before it afterwards."""
    word = re.fullmatch(r"\\b([A-Za-z0-9'_ ]+)\\b", pattern)
    return rf"{word[1]}(?<=\b{word[1]})\b" if word else pattern


class DictionaryRule:
    """A normalizer: lower-case, then apply ``(pattern, replacement)`` pairs in order.

    ``literal=True`` replaces substrings (like ``String.replace``); otherwise the
    pattern is a Java regular expression and ``$1`` refers to a group.
    """

    def __init__(self, mapping: Mapping[str, str] | Iterable[tuple[str, str]], literal: bool = True,
                 lowercase: bool = True):
        self.pairs = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
        self.literal = literal
        self.lowercase = lowercase

    def __call__(self, c: Column | str, lowered: bool = False) -> Column:
        """``lowered``: the text is in lower case already."""
        out = _col(c)
        if self.lowercase and not lowered:
            out = F.lower(out)
        pairs = list(self.pairs)
        if self.literal:
            return F.arrow_udf(lambda texts: batches.in_pieces(texts, lambda some: batches.replace_all(some, pairs)), "string")(out)
        if all(batches.text_change(*pair) for pair in pairs):
            return F.arrow_udf(lambda texts: batches.in_pieces(texts, lambda some: batches.change_all(some, pairs)), "string")(out)
        for pattern, replacement in pairs:
            out = F.regexp_replace(out, _searchable(pattern), replacement)
        return out

    def leaves_lower(self, lowered: bool = False) -> bool:
        """Whether what it gives is in lower case, so that the next rule need not make it so: lower case once more
        between two rules would take the rows out of the Python worker and back."""
        return (self.lowercase or lowered) and all(value == value.lower() for _, value in self.pairs)


normalize_sentiment = DictionaryRule(rules.EMOTICONS, literal=True)
normalize_shortforms = DictionaryRule(rules.SHORT_FORMS, literal=False)
normalize_noise = DictionaryRule(rules.NOISE, literal=False)
# option: also treat https:// links as URLs (the default rule only knows http://)
normalize_noise_https = DictionaryRule(
    [(p, r) if p != r"http:\/\/\S+" else (r"https?:\/\/\S+", r) for p, r in rules.NOISE], literal=False)


def contains_any(c: Column | str, terms: Iterable[str]) -> Column:
    """True when any literal term occurs in the text (codegen'd ``contains`` chain)."""
    col = _col(c)
    return reduce(lambda a, b: a | b, [col.contains(t) for t in terms])


def is_positive(c: Column | str) -> Column:
    return contains_any(c, rules.POSITIVE_TERMS)


def is_negative(c: Column | str) -> Column:
    return contains_any(c, rules.NEGATIVE_TERMS)


def is_neutral(c: Column | str) -> Column:
    return ~is_positive(c) & ~is_negative(c)


def distant_label(c: Column | str) -> Column:
    """1.0 when a positive emoticon occurs, else 0.0 (neutral and negative alike)."""
    return F.when(is_positive(c), F.lit(1.0)).otherwise(F.lit(0.0))


def sentiment_decision(prediction: Column | str, threshold: float = rules.DISPLAY_THRESHOLD) -> Column:
    return F.when(_col(prediction) < threshold, F.lit("negative")).otherwise(F.lit("positive"))
