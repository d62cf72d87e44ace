"""Prefix trie against a plain walk over every prefix."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from moodwire.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, key string, n int"


def by_hand(rows):
    """(conv_id, turn, role, text) rows -> the contract's rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c in own:
        own[c] = [t[2:] for t in sorted(own[c], key=lambda t: t[:2])]
    nodes = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, len(path) == d))
    kids, leaves, saved = {}, {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + (len(nodes[p]) - 1) * words
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
            leaves[p[:-1]] = leaves.get(p[:-1], 0) + leaves[p]
            saved[p[:-1]] = saved.get(p[:-1], 0) + saved[p]
    least = {p: min(c for c, _ in m) for p, m in nodes.items()}
    sha = lambda m: hashlib.sha256(",".join(str(c) for c in sorted(c for c, e in m if e)).encode()).hexdigest()
    return sorted((least[p], len(p), least[p[:-1]] if p else -1, len(m), kids.get(p, 0), leaves[p], saved[p], sha(m))
                  for p, m in nodes.items())


def run(spark, rows, **kw):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = prefix_trie.prefix_trie(table, **kw).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in got)


def conversations(seed, n, longest):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a b", "c", "", None, " \t x  y z\n"]))
                 for t in range(rnd.randint(1, longest))]
    return rows


@pytest.mark.parametrize("kw", [{}, {"single": 1, "block": 1}, {"single": 2, "block": 3}, {"single": 3, "block": 100}])
def test_trie_by_hand(spark, kw):
    rows = conversations(3, 90, 6) + [(200, t, "u", "same words here") for t in range(30)]
    rows += [(c, t, "u", "same words here") for c in (220, 240, 261, 301) for t in range(28)]  # long, almost equal
    assert run(spark, rows, **kw) == by_hand(rows)


def test_trie_edge_rows(spark):
    rows = [(7, None, "u", "null turn first"), (7, 1, None, None), (7, 2, "", ""), (None, 1, "u", "no conversation"),
            (41, 1, "u", "x"), (45, 3, "u", "y " * 5000), (-3, 1, "u", "z"), (60, 1, "u", "q"), (60, 2, "u", "q"),
            (10**17, 5, "u", "far"), (10**17 + 300, 5, "u", "far")]
    assert run(spark, rows) == by_hand(rows)
    assert run(spark, []) == []


def test_trie_turns_with_equal_numbers_have_one_order(spark):
    rows = [(100, 1, "u", x) for x in "abcabc"] + [(100, None, "u", "n"), (100, None, "u", "m")]
    first = run(spark, rows)
    assert first == run(spark, rows[::-1]) and len(first) == 9


def test_trie_hot_conversation_in_pieces(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(0, 30000, 20) for t in range(3)]
    assert run(spark, rows) == by_hand(rows)


def test_trie_query(spark, small_dir):
    table = spark.read.parquet(f"{small_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    got = queries.QUERIES["op11_prefix_trie"](spark, small_dir)
    assert got.count() == len(by_hand(rows))
    assert got.agg(F.sum("saved_tokens")).first()[0] == sum(r[6] for r in by_hand(rows))
