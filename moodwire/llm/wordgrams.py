"""Word hashes and window names of whole texts, vectorised over the texts of an Arrow batch.

Words are runs of bytes other than 0x20 and 0x09 to 0x0D. A word's 64-bit hash is a polynomial over
fixed random numbers of its bytes. Window names are built level by level: the name of 2L words comes
from the names of its two halves; a length between two levels takes two overlapping windows.
"""

from __future__ import annotations

import numpy as np

SEED = 20_240_607
_RANDOM = np.random.default_rng(SEED)
BYTES = _RANDOM.integers(1, 2**64, 256, np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def mixed(x):
    """A fixed permutation of 64-bit integers that spreads every bit over all."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]):
    """(hashes of all words in order, first word of each text and one past the last, word starts and
    ends as byte positions in the joined texts, joined texts)."""
    joined = b"\n".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    inside = ~SPACES[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    length = end - begin
    first = np.concatenate(([0], np.cumsum(length)))
    letters = data[inside]
    if len(length):
        powers = np.cumprod(np.full(int(length.max()), BASE, np.uint64))
        at = np.arange(len(letters)) - np.repeat(first[:-1], length)
        terms = BYTES[letters] * powers[at]
        hashes = mixed(np.add.reduceat(terms, first[:-1]) ^ length.astype(np.uint64))
    else:
        hashes = np.empty(0, np.uint64)
    text_at = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(begin, text_at)
    return hashes, bounds, begin, end, joined


def doubled(names, length: int):
    """Names of all windows of ``length`` words of a word-hash array (texts are told apart by the
    caller: a window that leaves its text must be dropped)."""
    size = 1
    while size * 2 <= length:
        names = mixed(names[:-size] * BASE + names[size:]) if len(names) > size else names[:0]
        size *= 2
    rest = length - size
    if rest:
        names = mixed(names[:-rest] * BASE + mixed(names[rest:])) if len(names) > rest else names[:0]
    return names


def in_blocks(values, most: int = 4 << 20):
    """Lists of (index, bytes) with at most about ``most`` bytes each."""
    block, held = [], 0
    for k, v in enumerate(values):
        if block and held + len(v) > most:
            yield block
            block, held = [], 0
        block.append((k, v))
        held += len(v)
    if block:
        yield block
