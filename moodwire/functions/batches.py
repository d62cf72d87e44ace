"""Arrow forms of the word-level work: the small functions that run inside tasks.

Each takes the Arrow array of a batch and gives one of equal length, so Spark partitions the rows and the rest
of a query stays column expressions. Work per word is done once per distinct word of a batch
(``by_distinct``); arrays are cut into pieces of about ``PIECE`` values where buffers would grow with the batch.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 500_000  # values whose buffers are held at once, about
PIECE_BYTES = 2 << 20  # bytes of text that the steps of the text chain take at once, about
JAVA_TRIM = "".join(map(chr, range(33)))  # what Java's trim removes


def by_distinct(values: pa.Array, fn: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``fn`` of an array of strings, given the distinct ones only."""
    coded = values.dictionary_encode()
    return fn(coded.dictionary).take(coded.indices)


def in_pieces(texts: pa.Array, fn: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``fn`` of an array of strings, given about ``PIECE_BYTES`` of them at a time: what it makes on the way is many
    times its input. What the allocator keeps goes back to the system, as idle workers stay beside their executor."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    made, row = [], 0
    while row < len(texts):
        upto = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + PIECE_BYTES, "right")))
        made.append(fn(texts.slice(row, upto - row)))
        row = upto
    whole = pa.concat_arrays(made) if len(made) > 1 else made[0] if made else fn(texts)
    del made
    pa.default_memory_pool().release_unused()
    return whole


def lists(offsets, values: pa.Array, like: pa.Array) -> pa.Array:
    """Lists over ``values``, null where ``like`` is."""
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), values, mask=mask)


def without(offsets, values: pa.Array, blank: pa.Array):
    """The lists emptied where ``blank`` is true: (offsets, values)."""
    drop = pc.fill_null(blank, False).to_numpy(zero_copy_only=False)
    offsets = np.asarray(offsets)
    if not drop.any():
        return offsets, values
    lengths = np.diff(offsets)
    kept = values.slice(offsets[0], offsets[-1] - offsets[0]).filter(pa.array(np.repeat(~drop, lengths)))
    return np.concatenate([[0], np.cumsum(np.where(drop, 0, lengths))]), kept


def replace_all(texts: pa.Array, pairs: list[tuple[str, str]]) -> pa.Array:
    """The literal replacements, one after another; most keys are in few texts."""
    def one(text):
        for key, value in pairs:
            if key and key in text:
                text = text.replace(key, value)
        return text

    return pa.array([None if t is None else one(t) for t in texts.to_pylist()], pa.string())


JAVA_SPACE = " \t\n\x0b\f\r"  # what \s is in a Java pattern


def _letter_or_digit(ch: str) -> bool:
    kind = unicodedata.category(ch)
    return kind[0] == "L" or kind == "Nd"


def _word_before(text: str, end: int) -> bool:
    """Whether Java's \\b takes the character before ``end`` for one of a word: a letter, a digit, an underscore, or
    a mark on a letter or digit (of the first plane, as Java walks back by halves of pairs)."""
    if end == 0:
        return False
    at = end - 1
    ch = text[at]
    if ch.isascii():
        return ch.isalnum() or ch == "_"
    if unicodedata.category(ch) != "Mn":
        return _letter_or_digit(ch)
    while at >= 0 and unicodedata.category(text[at]) == "Mn" and ord(text[at]) < 0x10000:
        at -= 1
    return at >= 0 and ord(text[at]) < 0x10000 and _letter_or_digit(text[at])


def _word_after(text: str, at: int) -> bool:
    """The same of the character at ``at``, which follows an ASCII one."""
    if at == len(text):
        return False
    ch = text[at]
    if ch.isascii():
        return ch.isalnum() or ch == "_"
    return text[at - 1].isalnum() if unicodedata.category(ch) == "Mn" else _letter_or_digit(ch)


def _word(word: str, replacement: str) -> Callable[[str], str]:
    """The word replaced where no word character stands beside it; it begins and ends with one."""
    size = len(word)

    def change(text: str) -> str:
        at = text.find(word)
        if at < 0:
            return text
        parts, done = [], 0
        while at >= 0:
            end = at + size
            if not _word_before(text, at) and not _word_after(text, end):
                parts += [text[done:at], replacement]
                done = end
                at = text.find(word, end)
            else:
                at = text.find(word, at + 1)
        return "".join([*parts, text[done:]]) if done else text

    return change


def _headed(head: str, replacement: str) -> Callable[[str], str]:
    """A literal and the characters up to white space (one at least) replaced."""
    found = re.compile(f"{re.escape(head)}[^{JAVA_SPACE}]+")
    return lambda text: found.sub(replacement, text) if head in text else text


def _one_of(characters: str, replacement: str) -> Callable[[str], str]:
    def change(text: str) -> str:
        for ch in characters:
            text = text.replace(ch, replacement)
        return text

    return change


_RUN = re.compile(r"([a-z])\1\1+")


def _runs(text: str) -> str:
    """A letter three times or more becomes two; most texts have none, which is seen from their bytes."""
    codes = np.frombuffer(text.encode(), np.uint8)
    same = codes[1:] == codes[:-1]
    third = codes[2:][same[1:] & same[:-1]]
    return _RUN.sub(r"\1\1", text) if ((third >= 97) & (third <= 122)).any() else text


def text_change(pattern: str, replacement: str) -> Callable[[str], str] | None:
    """A Java pattern and its replacement as a function of a text, for the forms that mean the same here: a bare word
    between word boundaries, a literal and what follows it up to white space, a set of marks, and a letter three
    times or more. None for any other."""
    if pattern == r"([a-z])\1\1+" and replacement == "$1$1":
        return _runs
    if "$" in replacement or "\\" in replacement:
        return None
    if word := re.fullmatch(r"\\b([A-Za-z0-9_](?:[A-Za-z0-9'_ ]*[A-Za-z0-9_])?)\\b", pattern):
        return _word(word[1], replacement)
    if head := re.fullmatch(r"((?:[A-Za-z0-9@:#]|\\/)+)\\S\+", pattern):
        return _headed(head[1].replace("\\/", "/"), replacement)
    if (marks := re.fullmatch(r"\[([-_])([-_])\]", pattern)) and not set(replacement) & set("-_"):
        return _one_of(marks[1] + marks[2], replacement)
    return None


def change_all(texts: pa.Array, pairs: list[tuple[str, str]]) -> pa.Array:
    """The changes of ``text_change``, one after another; most patterns are in few texts."""
    changes = [text_change(*pair) for pair in pairs]

    def one(text):
        for change in changes:
            text = change(text)
        return text

    return pa.array([None if t is None else one(t) for t in texts.to_pylist()], pa.string())


def map_words(texts: pa.Array, fn: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """Words (separated by one space, trailing empty ones dropped) mapped and joined by one space."""
    words = pc.split_pattern(pc.ascii_rtrim(texts, characters=" "), " ")
    return pc.binary_join(lists(words.offsets, by_distinct(words.values, fn), words), " ")


def clean(words: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(words, r"\W+", "")


def hashed(words: pa.Array) -> pa.Array:
    return pa.array(java_hashes(words))


def unigrams(texts: pa.Array, hashes: bool = False) -> pa.Array:
    """Words separated by one space, non-word characters deleted; none of a text of spaces alone. With ``hashes``
    their Java hashes, of each distinct word of the batch once."""
    bare = pc.ascii_rtrim(texts, characters=" ")
    words = pc.split_pattern(bare, " ")
    blank = pc.and_(pc.equal(bare, ""), pc.not_equal(texts, ""))
    made = by_distinct(words.values, (lambda distinct: hashed(clean(distinct))) if hashes else clean)
    return lists(*without(words.offsets, made, blank), texts)


def ngrams(texts: pa.Array, n: int, hashes: bool = False) -> pa.Array:
    """n-grams within each sentence, joined by one space; none of a text of stops alone. With ``hashes`` their Java
    hashes, put together from those of the words: no n-gram is written out."""
    bare = pc.ascii_rtrim(texts, characters=".")
    sentences = pc.split_pattern(bare, ".")
    words = pc.split_pattern(pc.ascii_trim(sentences.values, characters=JAVA_TRIM), " ")
    at = np.asarray(words.offsets, np.int64)
    windows = np.maximum(np.diff(at) - (n - 1), 1)
    first = np.concatenate([[0], np.cumsum(windows)])  # the first window of each sentence
    start = np.repeat(at[:-1] - first[:-1], windows) + np.arange(first[-1])
    end = np.repeat(at[1:], windows)
    if hashes:
        grams = pa.array(_gram_hashes(words.values, start, end, n))
    else:
        cleaned = by_distinct(words.values, clean)
        parts = [cleaned.take(pa.array(start + k, mask=start + k >= end)) for k in range(n)]
        grams = pc.binary_join_element_wise(*parts, " ", null_handling="skip")
    blank = pc.and_(pc.equal(bare, ""), pc.not_equal(texts, ""))
    return lists(*without(first[np.asarray(sentences.offsets)], grams, blank), texts)


def _gram_hashes(words: pa.Array, start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """hash(a + " " + b) = (31 hash(a) + 32) 31^|b| + hash(b), modulo 2^32; words from ``end`` on are not there."""
    coded = words.dictionary_encode()
    cleaned, code = clean(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
    length = pc.binary_length(cleaned).to_numpy(zero_copy_only=False)  # cleaned words are ASCII
    powers = np.multiply.accumulate(np.concatenate([[1], np.full(length.max(initial=0), 31)]), dtype=np.uint32)
    one, power = java_hashes(cleaned).view(np.uint32)[code], powers[length][code]
    made = one[start]
    for k in range(1, n):
        there = np.flatnonzero(start + k < end)
        at = start[there] + k
        made[there] = (made[there] * np.uint32(31) + np.uint32(32)) * power[at] + one[at]
    return made.view(np.int32)


def joined(parts: list[pa.Array]) -> pa.Array:
    """The lists of several arrays row by row, one after another; null where one of them is."""
    at = [np.asarray(p.offsets, np.int64) for p in parts]
    base = np.cumsum([0, *[len(p.values) for p in parts]])[:-1]
    starts = np.stack([a[:-1] + b for a, b in zip(at, base)], axis=1).ravel()
    lengths = np.stack([np.diff(a) for a in at], axis=1).ravel()
    ends = np.cumsum(lengths)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)
    values = pa.concat_arrays([p.values for p in parts]).take(pa.array(source))
    none = functools.reduce(pc.or_, [p.is_null() for p in parts])
    offsets = np.concatenate([[0], ends[len(parts) - 1 :: len(parts)]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=none if pc.any(none).as_py() else None)


def java_hashes(strings: pa.Array) -> np.ndarray:
    """Java ``String.hashCode`` of each string (over code points), as signed 32-bit numbers.

    Modulo 2^32, where 31 has an inverse: one running sum over the characters of all strings, each divided by 31 per
    position, gives every string's polynomial as a difference, times the power at its end.
    """
    bounds = np.concatenate([[0], np.cumsum(pc.binary_length(strings).to_numpy(zero_copy_only=False).astype(np.int64))])
    codes = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings), "")[0].as_buffer(), np.uint8)
    if (codes >= 128).any():
        bounds = np.concatenate([[0], np.cumsum(pc.utf8_length(strings).to_numpy(zero_copy_only=False).astype(np.int64))])
        codes = np.frombuffer(codes.tobytes().decode().encode("utf-32-le"), np.uint32)
    inverse = pow(31, -1, 1 << 32)
    up, down = (np.multiply.accumulate(np.concatenate([[1], np.full(len(codes), f)]), dtype=np.uint32) for f in (31, inverse))
    sums = np.concatenate([np.zeros(1, np.uint32), np.cumsum(codes * down[:-1], dtype=np.uint32)])
    return ((sums[bounds[1:]] - sums[bounds[:-1]]) * up[bounds[1:]] * np.uint32(inverse)).view(np.int32)


def java_hash(strings: pa.Array) -> pa.Array:
    none = strings.is_null().to_numpy(zero_copy_only=False)
    return pa.array(java_hashes(pc.fill_null(strings, "")), mask=none)


def term_counts(tokens: pa.Array, num_features: int) -> pa.Array:
    """Per list of tokens, or of their hashes, its buckets, ascending, and how many tokens fall into each:
    structs (idx, val), null for a null list. A null token falls into none."""
    at = np.asarray(tokens.offsets, np.int64)
    made, row = [], 0
    while row < len(tokens):
        upto = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
        made.append(_term_counts(tokens.slice(row, upto - row), num_features))
        row = upto
    kind = pa.struct([("idx", pa.list_(pa.int32())), ("val", pa.list_(pa.float64()))])
    return pa.concat_arrays(made) if made else pa.array([], kind)


def _term_counts(tokens: pa.Array, num_features: int) -> pa.Array:
    at = np.asarray(tokens.offsets, np.int64)
    rows = np.repeat(np.arange(len(tokens)), np.diff(at))
    words = tokens.values.slice(at[0], at[-1] - at[0])
    if words.null_count:
        rows, words = rows[words.is_valid().to_numpy(zero_copy_only=False)], words.drop_null()
    codes = words.to_numpy(zero_copy_only=False) if pa.types.is_integer(words.type) else java_hashes(words)
    keys = np.sort(rows * num_features + np.mod(codes.astype(np.int64), num_features))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(keys))).astype(np.float64)
    keys = keys[new]
    offsets = np.searchsorted(keys, np.arange(len(tokens) + 1) * num_features)
    none = tokens.is_null()
    return pa.StructArray.from_arrays(
        [lists(offsets, pa.array((keys % num_features).astype(np.int32)), tokens), lists(offsets, pa.array(counts), tokens)],
        ["idx", "val"], mask=none if tokens.null_count else None)
