"""English Porter stemmer over columns of words and texts.

Spark ships no stemmer. A word's stem depends on the word alone, so a batch of rows is split into words and each
distinct word is stemmed once (``functions.batches``); everything is row-local, no shuffle.

Markers carried between steps (characters that do not occur in text): ``\\x01`` "ed/ing was removed" (step 1b),
``\\x03`` "word shorter than 3, leave it alone"; a leading ``y`` is upper-cased so the measure regexes read
it as a consonant, and restored at the end.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwire.functions import batches, rules

REMOVED = "\x01"
SHORT = "\x03"


def _regex(pattern: str) -> re.Pattern:
    return re.compile(pattern.replace(r"\z", r"\Z"))  # the very end, in Java and in Python


M_GT0, M_EQ1, M_GT1, HAS_VOWEL, CVC_M1 = map(
    _regex, (rules.M_GT0, rules.M_EQ1, rules.M_GT1, rules.HAS_VOWEL, rules.CVC_M1))


def _step0(w: str) -> str:
    if len(w) < 3:
        return w + SHORT
    return "Y" + w[1:] if w.startswith("y") else w


def _step1a(w: str) -> str:
    if w.endswith(("sses", "ies")):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _step1b_remove(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if M_GT0.search(w[:-3]) else w
    if w.endswith("ed") and HAS_VOWEL.search(w[:-2]):
        return w[:-2] + REMOVED
    if w.endswith("ing") and HAS_VOWEL.search(w[:-3]):
        return w[:-3] + REMOVED
    return w


def _step1b_tidy(w: str) -> str:
    if not w.endswith(REMOVED):
        return w
    s = w[:-1]
    if s.endswith(("at", "bl", "iz")):
        return s + "e"
    if len(s) >= 2 and s[-1] == s[-2] and s[-1] not in "aeiouy":
        return s if s[-1] in "lsz" else s[:-1]
    return s + "e" if CVC_M1.search(s) else s


def _step1c(w: str) -> str:
    return w[:-1] + "i" if w.endswith("y") and HAS_VOWEL.search(w[:-1]) else w


def _replace_table(w: str, table: list[tuple[str, str]]) -> str:
    for suffix, repl in table:
        if w.endswith(suffix):
            stem = w[:-len(suffix)]
            return stem + repl if M_GT0.search(stem) else w
    return w


def _step2(w: str) -> str:
    return _replace_table(w, rules.PORTER_STEP2) if w[-2:] in TAILS2 else w


def _step3(w: str) -> str:
    return _replace_table(w, rules.PORTER_STEP3) if w[-2:] in TAILS3 else w


def _step4(w: str) -> str:
    if w[-2:] not in TAILS4:
        return w
    for suffix in rules.PORTER_STEP4:
        if w.endswith(("sion", "tion") if suffix == "ion" else suffix):
            stem = w[:-len(suffix)]
            return stem if M_GT1.search(stem) else w
    return w


def _step5a(w: str) -> str:
    s = w[:-1]
    drop = w.endswith("e") and (M_GT1.search(s) or (M_EQ1.search(s) and not CVC_M1.search(s)))
    return s if drop else w


def _step5b_restore(w: str) -> str:
    if w.endswith(SHORT):
        return w[:-1]
    if w.endswith("ll") and M_GT1.search(w):
        w = w[:-1]
    return "y" + w[1:] if w.startswith("Y") else w


# a suffix table is read only for words whose last two letters end some suffix of it
TAILS2, TAILS3 = ({suf[-2:] for suf, _ in table} for table in (rules.PORTER_STEP2, rules.PORTER_STEP3))
TAILS4 = {suf[-2:] for suf in rules.PORTER_STEP4}


REMEMBERED = 1 << 18  # stems kept per Python worker, those asked for lately: some 60 MB


@functools.lru_cache(REMEMBERED)
def stem_word(w: str) -> str:
    """The steps in order; one that looks at a certain last letter is left out for words without it."""
    if len(w) < 3:
        return w  # as marked by step 0 and left alone
    w = _step0(w)
    if w[-1] == "s":
        w = _step1a(w)
    if w[-1:] in ("d", "g"):
        w = _step1b_remove(w)
    if w[-1:] == REMOVED:
        w = _step1b_tidy(w)
    if w[-1:] == "y":
        w = _step1c(w)
    w = _step4(_step3(_step2(w)))
    if w[-1:] == "e":
        w = _step5a(w)
    return _step5b_restore(w)


def _may_change() -> np.ndarray:
    """By the last two bytes of a word (the last one times 256 and the one before it): whether some step looks at it."""
    table = np.zeros((256, 256), bool)
    table[[ord(c) for c in ("s", "d", "g", "y", "e", REMOVED, SHORT)]] = True  # steps 1 and 5, and the markers
    for tail in TAILS2 | TAILS3 | TAILS4 | {"ll"}:
        table[ord(tail[1]), ord(tail[0])] = True
    return table.ravel()


MAY_CHANGE = _may_change()


def _stem_distinct(words):
    """Stems of an array of words; longer ones whose ending no step looks at (and that no ``Y`` begins) stay as they are.
    All endings are ASCII, so the last two bytes tell."""
    import pyarrow as pa
    import pyarrow.compute as pc

    there = pc.fill_null(words, "")
    lengths = pc.binary_length(there).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    text = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), there), "")[0].as_buffer(), np.uint8)
    long = lengths > 2
    last = ends[long] - 1
    look = ~long
    if len(last):
        look[long] = MAY_CHANGE[text[last].astype(np.intp) * 256 + text[last - 1]] | (text[last + 1 - lengths[long]] == ord("Y"))
    some = pa.array(look)
    return pc.replace_with_mask(words, some, pa.array([None if w is None else stem_word(w) for w in words.filter(some).to_pylist()], pa.string()))


def _stem_lists(words):
    return batches.lists(words.offsets, batches.by_distinct(words.values, _stem_distinct), words)


def _stem_texts(texts):
    return batches.in_pieces(texts, lambda some: batches.map_words(some, _stem_distinct))


def stem_words(words: Column) -> Column:
    """Porter-stem every element of an ``array<string>`` column."""
    return F.arrow_udf(_stem_lists, "array<string>")(words)


def stem_text(text: Column) -> Column:
    """Stem each space-separated word of a text and join with one space.

    Splitting on one space drops trailing empty words (so trailing spaces go)
    and keeps inner and leading ones, as ``String.split(" ")`` does.
    """
    return F.arrow_udf(_stem_texts, "string")(text)
