"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a pre-token exactly one vocabulary entry can be the last token of its encoding.
Candidates are the entries that end at the prefix, found by an automaton with suffix links (all
matches at a position, longest first); the one is right whose pair with the last token of the shorter
prefix is compatible, that is: no merge crosses their border before the merges inside the two tokens
have hidden the border's symbols. Back-pointers give the ids. Pre-token borders and the byte alphabet
come from the vocabulary file's own pre-tokenizer; merges are never replayed.

Row-local: no shuffle; memory is one Arrow batch plus bounded memories.

Nulls and empty texts give no ids (hash of the empty string); repeated rows give repeated rows; an
empty table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

import re
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from moodwire.llm import tokens

PAIRS = 400_000  # compatibility answers remembered per Python worker, in two generations
SEGMENT_BYTES = 256 << 20  # remembered segments per Python worker, pre-tokens after a space among them
WORD_BYTES = 8 << 20  # remembered pre-tokens without a space per Python worker
BLOCK = 1 << 18  # ids written out at a time
NEVER = 1 << 60


class Spelling:
    """A string of bytes per id, laid out for many ids at once."""

    def __init__(self, strings: dict[int, bytes]):
        import numpy as np

        in_order = [strings.get(t, b"") for t in range(max(strings) + 1)]
        self.data = np.frombuffer(b"".join(in_order), np.uint8)
        self.length = np.array(list(map(len, in_order)), np.int64)
        self.start = np.cumsum(self.length) - self.length

    def join(self, ids) -> bytes:
        """The strings of an array of ids, one after the other."""
        import numpy as np

        out = []
        for a in range(0, len(ids), BLOCK):
            part = ids[a : a + BLOCK]
            length = self.length[part]
            ends = np.cumsum(length)
            at = np.arange(ends[-1]) + np.repeat(self.start[part] - ends + length, length)
            out.append(self.data[at].tobytes())
        return b"".join(out)


class PrefixBpe:
    def __init__(self, path: str):
        import json

        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pre = tokens.library(path).pre_tokenizer
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(merges)}
        made = {vocab[a + b]: (vocab[a], vocab[b], r) for r, (a, b) in enumerate(merges)}
        self.right, self.left = {}, {}
        for word, t in vocab.items():
            self.right[t] = self._spine(t, made, 1)
            self.left[t] = self._spine(t, made, 0)
        byte_of = {c: b for b, c in tokens.byte_alphabet().items()}
        self.text = {t: bytes(byte_of[c] for c in w) for w, t in vocab.items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.text.update((i, c.encode()) for c, i in self.special.items())
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.fits: dict[int, bool] = {}  # by both ids, 20 bits each
        self.old_fits: dict[int, bool] = {}
        self.spelled = Spelling(self.text)
        self.decimals = Spelling({t: b"%d," % t for t in self.text})
        self.plain, self.one = re.compile(tokens.PRETOKENS[" "]), re.compile(f"[{tokens.LETTERS}]+")
        self.seen, self.words = tokens.Memory(SEGMENT_BYTES), tokens.Memory(WORD_BYTES)
        self.found = ahocorasick.Automaton()
        for w, t in vocab.items():
            if t in made or len(w) == 1:  # entries that no merge makes are never a result
                self.found.add_word(w, (t, len(w)))
        self.found.make_automaton()

    @staticmethod
    def _spine(t: int, made: dict, side: int) -> list[tuple[int, int]]:
        """The symbols at one border of a token, outermost first, each with the rank of the merge
        that hides it inside the next larger one."""
        out, hidden = [], NEVER
        while True:
            out.append((t, hidden))
            if t not in made:
                return out
            hidden, t = made[t][2], made[t][side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether a and b stay two tokens when their bytes stand side by side."""
        for u, u_hidden in self.right[a]:
            for v, v_hidden in self.left[b]:
                r = self.rank.get((u, v))
                # equal ranks merge from the left: a's own merge first, b's own merge last
                if r is not None and r < u_hidden and r <= v_hidden:
                    return False
        return True

    def pretoken(self, word: str) -> list[int]:
        """ids of one pre-token, given in the byte alphabet."""
        n, fits = len(word), self.fits
        last, size = [-1] * (n + 1), [0] * (n + 1)
        for end, (t, length) in self.found.iter(word):
            i = end + 1
            if last[i] < 0:
                before = last[i - length]
                if i != length:
                    if before < 0:
                        continue
                    pair = before << 20 | t
                    good = fits.get(pair)
                    if good is None:
                        good = self.old_fits.get(pair)
                        if good is None:
                            good = self.compatible(before, t)
                        if len(fits) >= PAIRS // 2:
                            self.old_fits, fits = fits, {}
                            self.fits = fits
                        fits[pair] = good
                    if not good:
                        continue
                last[i], size[i] = t, length
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        """ids of a text, special strings as their own id."""
        out = []
        for k, part in enumerate(self.split.split(text) if self.split else [text]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                for word, _ in self.pre.pre_tokenize_str(part):
                    out += self.pretoken(word)
        return out

    def segment(self, piece: str) -> bytes:
        """Packed ids of a segment after a space, or of one that starts with a line feed."""
        value = self.seen.old.get(piece)
        if value is None:
            if self.one.fullmatch(piece):
                return self.word(self.seen, piece, " ")
            if tokens.PLAIN.fullmatch(piece) and "<|" not in piece:
                parts, known = [], True
                for w in self.plain.findall(piece if piece[0] == "\n" else " " + piece):
                    memory, key, space = (self.seen, w[1:], " ") if w[0] == " " else (self.words, w, "")
                    part = memory.young.get(key) or memory.old.get(key)
                    if part is None:
                        part, known = self.word(memory, key, space), False
                    parts.append(part)
                value = b"".join(parts)
                if not known:  # not worth remembering yet
                    return value
            else:
                value = packed(self.encode(piece if piece[0] == "\n" else " " + piece))
        self.seen.keep(piece, value, 33 + len(value))
        return value

    def word(self, memory: tokens.Memory, key: str, space: str) -> bytes:
        """Packed ids of one plain pre-token, remembered without its space."""
        value = packed(self.pretoken(tokens.in_alphabet(space + key)))
        memory.keep(key, value, 33 + len(value))
        return value

    def ids(self, text: str):
        """A text's ids as an array; they are the concatenation of its segments' (see ``tokens``)."""
        import numpy as np

        pieces = tokens.cut(text, " ")
        if not text or pieces is None:
            return np.array(self.encode(text), np.uint32)
        out = [packed(self.encode(pieces.pop(0)))]
        found = list(map(self.seen.young.get, pieces))
        if None in found:
            for k, v in enumerate(found):
                if v is None:
                    found[k] = self.seen.young.get(pieces[k]) or self.segment(pieces[k])
        return np.frombuffer(b"".join(out + found), np.uint32)

    def document(self, text: str) -> list[tuple[str, bytes]]:
        """[(decimal ids joined by commas, decoded bytes)] of a text; nothing of an empty one."""
        ids = self.ids(text)
        return [(self.decimals.join(ids)[:-1].decode(), self.spelled.join(ids))] if len(ids) else []

    def decode(self, ids) -> str:
        """The text of an array of ids."""
        return self.spelled.join(ids).decode("utf-8", "replace")


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   digests: bool = False) -> DataFrame:
    """(id, ids array<int>, decoded string) per row of ``docs``; with ``digests`` (id, n_tokens,
    ids_sha256, decoded_sha256) instead."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        bpe = tokens.worker_state(("prefix-bpe", tokenizer_path), lambda: PrefixBpe(tokenizer_path))
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            cols = [[], [], []]
            for value in batch.column(1):
                ids = bpe.ids(value.as_py() or "")
                decoded = bpe.decode(ids)
                if digests:
                    row = (len(ids), sha(bpe.decimals.join(ids)[:-1]), sha(decoded.encode()))
                else:
                    row = (0, ids, decoded)
                for c, v in zip(cols, row):
                    c.append(v)
            out = ([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())] if digests
                   else [pa.array(cols[1], pa.list_(pa.int32())), pa.array(cols[2], pa.string())])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], names=names)

    rows = docs.select(id_col, text_col)
    fields = ([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
               T.StructField("decoded_sha256", T.StringType())] if digests
              else [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    schema = T.StructType([rows.schema[id_col], *fields])
    names = schema.names
    return rows.mapInArrow(run, schema)
