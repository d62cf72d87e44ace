"""Library tokenization of whole texts inside tasks, shared by token counts and packing.

A segment is what stands between single spaces; a single line feed between other characters starts one
as well. Both vocabularies begin a new pre-token there, so a text's ids are the concatenation of its
segments' ids, and these can be remembered. Where the vocabulary keeps white space, texts with two
white-space characters in a row (where that does not hold) go to the library whole. Segments of ASCII
marks and Latin letters are cut into pre-tokens here, and those are remembered on a second level (in the same
memory where white space only separates): words are far fewer than words with their marks. The memories are bounded in bytes and drop what was not
asked for lately; what they hold never changes a result.
"""

from __future__ import annotations

import re
import sys
import types

SEGMENT_BYTES = 64 << 20  # remembered segments per Python worker
WORD_BYTES = 96 << 20  # remembered pre-tokens per Python worker
LONGEST = 64  # characters; longer segments and pre-tokens are not remembered

# Letters whose class, lower case and normal form are the same in every Unicode version: ASCII, Latin-1
# and Latin Extended-A but for the dotted I and the long s.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u017e"
RUN = re.compile(r"\s\s|^\s|\s\Z")
PLAIN = re.compile(rf"[!-~\n{LETTERS}]+")  # pre-tokens are told apart without further Unicode classes

WORD = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+")  # one pre-token, which lower case leaves as it is

# The two vocabularies' pre-token patterns, for plain segments.
PRETOKENS = {
    " ": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\n",
    "": rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+",
}


class Memory:
    """Answers by string in two generations of at most half of ``limit`` bytes each: when the young
    one is full it becomes the old one, and what is asked for again moves back."""

    ENTRY = 110  # bytes of a dictionary entry beside its key and value

    def __init__(self, limit: int):
        self.half, self.size = limit // 2, 0
        self.young: dict = {}
        self.old: dict = {}

    def keep(self, key: str, value, value_bytes: int):
        if len(key) > LONGEST:
            return
        cost = sys.getsizeof(key) + value_bytes + self.ENTRY
        if self.size + cost > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[key] = value
        self.size += cost

    def keep_all(self, answers: dict):
        """``keep`` of many answers that are bytes."""
        young, size, half, sizeof = self.young, self.size, self.half, sys.getsizeof
        for key, value in answers.items():
            if len(key) <= LONGEST:
                cost = sizeof(key) + sizeof(value) + self.ENTRY
                if size + cost > half:
                    self.old, self.young, size = young, {}, 0
                    young = self.young
                young[key] = value
                size += cost
        self.size = size


def byte_alphabet() -> dict[int, str]:
    """The alphabet of byte-level vocabularies: printable bytes stand for themselves, the others for
    the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_ALPHABET = byte_alphabet()


def in_alphabet(word: str) -> str:
    """A pre-token's UTF-8 bytes in the byte alphabet."""
    if word.isascii():
        return word.replace(" ", _ALPHABET[32]).replace("\n", _ALPHABET[10])
    return "".join([_ALPHABET[b] for b in word.encode()])


def cut(text: str, prefix: str) -> list[str] | None:
    """Segments of a text; None where it has to be taken whole. With a prefix the first segment
    has none, nor has one that starts with a line feed."""
    if not prefix:  # white space only separates
        return text.replace("\n", " ").split(" ")
    return None if RUN.search(text) else text.replace("\n", " \n").split(" ")


def worker_state(key, make):
    """``make()`` once per Python worker: task closures are pickled by value, so a plain module
    global would start anew with every task."""
    store = sys.modules.setdefault("moodwire_llm_worker", types.ModuleType("moodwire_llm_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def library(path: str):
    """The tokenizer of a file, without truncation, padding and threads of its own."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class SegmentEncoder:
    """``ids(text)``: the library's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, leading_space: bool):
        self.tokenizer, self.prefix = library(path), " " if leading_space else ""
        self.between = "\t" if leading_space else " "  # neither in a plain segment nor remembered
        self.pattern = re.compile(f"{PRETOKENS[self.prefix]}|{self.between}")
        if self.prefix:
            self.seen, self.words = Memory(SEGMENT_BYTES), Memory(WORD_BYTES)
        else:  # a pre-token in lower case is a segment with the same ids: one memory, no word in it twice
            self.seen = self.words = Memory(SEGMENT_BYTES + WORD_BYTES)

    def whole(self, text: str) -> bytes:
        import numpy as np

        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def segments(self, text: str) -> list[bytes]:
        if not text:
            return []
        pieces = cut(text, self.prefix)
        if pieces is None:
            return [self.whole(text)]
        head = [self.whole(pieces.pop(0))] if self.prefix else []
        found = list(map(self.seen.young.get, pieces))
        if None in found:
            new = self._learn({p for p, v in zip(pieces, found) if v is None})
            found = [new[p] if v is None else v for p, v in zip(pieces, found)]
        return head + found

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Segments that the young generation lacks: from the old one; plain ones by their
        pre-tokens; the others by the whole library."""
        import numpy as np

        old, new, plain, rest = self.seen.old, {}, [], []
        is_plain, single = PLAIN.fullmatch, None if self.prefix else WORD.fullmatch
        for p in pieces:
            v = old.get(p)
            if v is not None:
                new[p] = v
            elif single and single(p):
                new[p] = self._word(p)
            elif is_plain(p) and "<|" not in p:
                plain.append(p)
            else:
                rest.append(p)
        if plain:
            new.update(zip(plain, self._plain(plain)))
        full = [p if p.startswith("\n") else self.prefix + p for p in rest]
        encoded = self.tokenizer.encode_batch_fast(full, add_special_tokens=False) if rest else []
        new.update((p, np.asarray(e.ids, "<u4").tobytes()) for p, e in zip(rest, encoded))
        self.seen.keep_all(new)
        return new

    def _word(self, word: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(in_alphabet(word))])

    def _plain(self, pieces: list[str]) -> list[bytes]:
        """Plain segments by their pre-tokens, all cut in one go: ``between`` stands between two segments."""
        words, prefix, between = self.words, self.prefix, self.between
        if prefix:
            text = between.join([p if p[:1] == "\n" else prefix + p for p in pieces])
        else:
            text = between.join(pieces).lower()
        cut_words = self.pattern.findall(text)
        found = list(map(words.young.get, cut_words))
        if None in found:
            old, new = words.old, {between: None}
            for w in {w for w, v in zip(cut_words, found) if v is None} - {between}:
                v = old.get(w)
                new[w] = self._word(w) if v is None else v
            found = [new[w] if v is None else v for w, v in zip(cut_words, found)]
            del new[between]
            words.keep_all(new)
        out, start = [], 0
        while len(out) < len(pieces) - 1:
            end = found.index(None, start)
            out.append(b"".join(found[start:end]))
            start = end + 1
        out.append(b"".join(found[start:]))
        return out

    def ids(self, text: str) -> bytes:
        return b"".join(self.segments(text))


def encoder(path: str, leading_space: bool) -> SegmentEncoder:
    return worker_state(("segments", path, leading_space), lambda: SegmentEncoder(path, leading_space))
