"""Vector codes against comparing every part with every entry."""

import hashlib
import math

import numpy as np
import pytest

from moodwire.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, id int, code string"


def by_hand(rows, parts=8, entries=16, rounds=6):
    """(vec_id, vector, label) rows -> the contract's rows, in Python integers."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    step = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * step:(p + 1) * step]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    seeds = sorted((k for k in kept if k[0] is not None), key=lambda k: k[:2])[:entries]
    books = [[cut(v, p) for _, v, _ in seeds] for p in range(parts)]
    near = lambda v, p: min(range(len(books[p])), key=lambda e: (d2(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(near(v, p), []).append(cut(v, p))
            for e, vs in own.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, per = [], {}
    for i, v, lab in kept:
        code = [near(v, p) for p in range(parts)]
        error = sum(d2(cut(v, p), books[p][e]) for p, e in enumerate(code))
        per[lab] = per.get(lab, 0) + error
        out.append((i, "".join(f"{e:02x}" for e in code), error, lab))
    return sorted(((i, c, e, per[lab], sha) for i, c, e, lab in out), key=repr)


def run(spark, rows, **kw):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = vector_codes.vector_codes(table, **kw).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=repr)


def vectors(n, width, seed=1, spread=1.0):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(7, width))
    return [(int(i), [float(x) for x in centres[i % 7] + spread * g.normal(size=width)], None if i % 5 == 0 else int(i % 3)) for i in range(n)]


@pytest.mark.parametrize("block,leaf", [(64, 4), (4096, 96), (50, 1)])
def test_codes_by_hand(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    monkeypatch.setattr(vector_codes.Tree.__init__, "__defaults__", (leaf,))
    rows = vectors(400, 16, spread=0.3)
    rows += [(1000 + i, rows[3][1], 1) for i in range(150)]  # many copies of one vector
    rows += [(2000 + i, [round(x) / 4 for x in rows[i][1]], None) for i in range(60)]  # ties
    assert run(spark, rows) == by_hand(rows)


def test_codes_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 8) + [(90, None, 1), (91, [1.0] * 7 + [nan], 1), (92, [1.0] * 7 + [None], 1), (93, [-inf] + [0.0] * 7, 1),
                             (None, [0.5] * 8, 2), (5, [0.25] * 8, 2), (5, [0.25] * 8, 2)]
    assert run(spark, rows) == by_hand(rows)
    more = rows + [(94, [], 1), (95, [1.0] * 16, 1), (96, [1.0] * 3, 1)]  # no vectors of this table's width
    assert run(spark, more) == by_hand(rows)
    assert run(spark, []) == [] and run(spark, rows[40:44]) == []
    few = rows[:3]
    assert run(spark, few) == by_hand(few)


def test_codes_of_far_components(spark):
    rows = [(i, [1000.0 * i, -3e4 * (i % 3)] + [0.001 * i] * 6, 1) for i in range(30)]
    assert run(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_tree_prunes_and_is_exact(spread):
    x = vector_codes.to_int(np.array([v for _, v, _ in vectors(3000, 8, 2, spread)]))
    tree = vector_codes.restored(x, vector_codes.compact(vector_codes.Tree(x)))
    book = x[:7].copy()  # one of each cluster
    want = np.argmin(vector_codes.squared(x[:, None] - book[None]), axis=1)
    assert (tree.nearest(book) == want).all()
    sums, counts = tree.totals(book)
    assert (counts == np.bincount(want, minlength=7)).all()
    assert all((sums[e] == x[want == e].sum(axis=0)).all() for e in range(7))
    owned = [b for b, rows, _ in tree.owned(book) if rows is None]
    if spread < 0.1:
        assert sum(tree.count[b] for b in owned) > 0.5 * len(x)  # most points are owned as balls


def test_codes_query(spark, small_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    got = queries.QUERIES["op13_vector_codes"](spark, small_dir).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=repr) == by_hand(rows)
