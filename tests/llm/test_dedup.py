import hashlib
import re

from pyspark.sql import functions as F
import pytest

from moodwire.llm import exact_dedup, jaccard_join, substring_dedup
from moodwire.llm.common import written

WORD = "[^\x20\x09-\x0D]+"
NONE = 2**63 - 1


def order(i):
    return NONE if i is None else i


# ----------------------------------------------------------------------------- exact

def exact_by_hand(rows):
    norm = [(i, re.sub("[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out, stayed = [], set()
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        keep = min([j for j in ids if j is not None], default=None)
        kept = i == keep and t not in stayed
        if kept:
            stayed.add(t)
        out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a  b"), (2, "a b"), (3, None), (4, ""), (5, " "), (5, "xx" * 50), (5, "xx" * 50), (6, "xx" * 50),
        (7, "xx" * 49 + "xy"), (None, "a\tb"), (None, "z"), (5, "q"), (5, "a b"), (8, "é" * 33), (9, "é" * 33)]


@pytest.mark.parametrize("options", [{}, {"block": 4}, {"block": 7},
                                     {"block": 4, "hashed": lambda c: F.pmod(F.xxhash64(c), F.lit(3))}])
def test_exact_dedup_by_hand(frame, options):
    """Small blocks give many levels; three hash values make almost every block collide."""
    got = exact_dedup.exact_dedup(frame(ROWS), **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == exact_by_hand(ROWS)


def test_exact_dedup_long_text_and_empty_table(frame):
    rows = [(1, "ab " * 100_000), (2, "ab  " * 100_000), (3, "ab " * 99_999 + "ac ")]
    got = exact_dedup.exact_dedup(frame(rows)).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got) == [(1, 1, True), (2, 1, False), (3, 3, True)]
    assert exact_dedup.exact_dedup(frame(rows).limit(0)).collect() == []
    assert exact_dedup.drop_duplicates(frame(rows).limit(0)).collect() == []


def test_drop_duplicates_keeps_columns(frame):
    d = frame(ROWS)
    got = exact_dedup.drop_duplicates(d)
    assert got.columns == d.columns
    want = {(i, h) for i, _, _, kept, h in exact_by_hand(ROWS) if kept}
    assert {(r.doc_id, hashlib.sha256(re.sub("[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in got.collect()} == want
    assert got.count() == len(want)


# ----------------------------------------------------------------------------- substring

def substring_by_hand(rows, window):
    texts = [(order(i), (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in texts:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((None if i == NONE else i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(rnd):
    words = [f"w{i}" for i in range(400)]
    shared = [[rnd.choice(words) for _ in range(rnd.randint(8, 70))] for _ in range(6)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rnd.randint(0, 6)):
            w += rnd.choice(shared) if rnd.random() < 0.5 else [rnd.choice(words) for _ in range(rnd.randint(1, 25))]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(w)))
    for _ in range(40):
        w = rows[rnd.randrange(120)][1].split()
        if w and rnd.random() < 0.6:
            w[rnd.randrange(len(w))] = "zz"
        rows.append((200 + rnd.randrange(60), "\t".join(w)))
    return rows + [(None, rows[5][1]), (None, rows[6][1] + " q"), (None, None), (7, rows[7][1]), (7, rows[8][1]),
                   (900, "a " * 300), (901, "a " * 100)]


@pytest.mark.parametrize("window,frequent", [(10, 1000), (10, 3), (13, 0), (50, 1000)])
def test_substring_by_hand(frame, rnd, window, frequent):
    """``frequent`` sends windows down the way for rare keys, for frequent keys, or both."""
    rows = passages(rnd)
    got = substring_dedup.substring_digest(frame(rows), window=window, frequent=frequent)
    want = substring_by_hand(rows, window)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str) == want
    assert sum(r[2] for r in want) > 500


def test_substring_texts_and_empty_table(frame):
    rows = [(1, "a b c d e f"), (2, "x a b c d y"), (3, None)]
    got = {r.doc_id: (r.n_removed, r.kept) for r in substring_dedup.repeats(frame(rows), window=4, whole=True).collect()}
    assert got[2] == (4, "x y") and got[1][0] == 0 and got[3][0] == 0
    assert substring_dedup.substring_digest(frame(rows).limit(0)).collect() == []


def test_substring_rows_without_id_meet_only_their_own_words(frame, monkeypatch):
    """200 texts without id share a passage: 200 candidates are written, not 200 x 200."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(None, f"{passage} x{i} y{i}") for i in range(200)] + [(1, passage)]
    sizes = {}

    def counted(df, name):
        out = written(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(substring_dedup, "written", counted)
    got = substring_dedup.substring_digest(frame(rows), window=10).collect()
    want = substring_by_hand(rows, 10)
    assert sorted((tuple(r) for r in got), key=str) == want and sum(r[2] for r in want) == 200 * 30
    assert sizes["candidates"] == 201


# ----------------------------------------------------------------------------- Jaccard join

def join_by_hand(rows):
    sets = []
    for _, t in rows:
        w = re.findall(WORD, t or "")
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), NONE), order(d))
    return sorted([(d, None if least[find(i)] == NONE else least[find(i)], links[i]) for i, (d, _) in enumerate(rows)], key=str)


def near_copies(rnd):
    words = [f"w{i}" for i in range(300)]
    rows = [(i, "  ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 4, 5, 6, 10, 40, 80, 150])))) for i in range(60)]
    for i in range(240):
        w = rows[rnd.randrange(len(rows))][1].split()
        for _ in range(rnd.randint(0, 3)):
            if w:
                w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((1000 - i, rnd.choice([" ", "\n"]).join(w)))
    return rows + [(None, rows[5][1]), (None, rows[9][1]), (None, None), (7, rows[7][1]), (7, rows[20][1])]


@pytest.mark.parametrize("chunk,partners", [(1024, 8), (8, 8), (8, 2), (3, 1)])
def test_jaccard_join_by_hand(frame, rnd, monkeypatch, chunk, partners):
    """Small chunks and few partners cut components over many task groups."""
    monkeypatch.setattr(jaccard_join, "PARTNERS", partners)
    rows = near_copies(rnd)
    got = jaccard_join.jaccard_join(frame(rows), chunk=chunk).select("doc_id", "class_id", "n_links")
    assert sorted(map(tuple, got.collect()), key=str) == join_by_hand(rows)


def test_rows_of_a_large_group_of_near_copies_stay_in_proportion(frame, monkeypatch):
    """What is written of a dense group doubles with it, although its pairs grow fourfold."""
    words, sizes = [f"w{i}" for i in range(200)], {}

    def counted(df, name):
        out = written(df, name)
        sizes[name] = out.count() if not name.startswith("linked-") or name[7:].isdigit() else (
            out.count(), out.where("node != root").count()) if "root" in out.columns else out.count()
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    found = []
    for m in (300, 600):
        rows = [(i, " ".join(words[:i % 190] + [f"x{i}"] + words[i % 190 + 1:])) for i in range(m)]
        got = jaccard_join.jaccard_join(frame(rows), chunk=50).collect()
        assert {r.class_id for r in got} == {0} and {r.n_links for r in got} == {m - 1}
        found.append((sizes["linked-within"][0] + sizes["linked-across"][0], sizes["linked-within"][1] + sizes["linked-across"][1]))
    (rows1, edges1), (rows2, edges2) = found
    assert edges1 <= 300 + 36 and edges2 <= 600 + 144  # a tree per chunk, an edge per pair of chunks
    assert rows2 <= 600 * 4


def test_drop_near_duplicates(frame, rnd):
    d = frame(near_copies(rnd)[:150])
    got = jaccard_join.drop_near_duplicates(d)
    joined = jaccard_join.jaccard_join(d).collect()
    assert got.columns == d.columns
    assert got.count() == sum(r.head for r in joined)
    assert {r.doc_id for r in got.collect()} == {r.class_id for r in joined}
    assert jaccard_join.drop_near_duplicates(d.limit(0)).collect() == []


def test_needed_matches_is_a_posterior_bound():
    need = jaccard_join.needed(252, 18, 0.8, 1e-7)
    assert list(need) == list(range(18, 253, 18))
    assert all(0 <= need[n] <= 0.8 * n for n in need)
    assert need[252] > need[126] > need[36]
