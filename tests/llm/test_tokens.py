import hashlib
import zlib

import public_tokenizers
import pytest

from moodwire.llm import bpe, packing, token_counts, tokens

PIECES = ["a", "b", "the", " ", "  ", "\n", " \n", "\t", "'s", "1", "23", "<|endoftext|>", "<|endof", "é", "ß", "漢字", "😀",
          "Σ", "#", "##", "...", " ", " ", "\x1c", "\x85", "İ", "<|startoftext|>", "aaaa", "AKIA", "é"]


def texts(rnd, n=300, most=40):
    made = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, most))) for _ in range(n)]
    return made + ["", "a" * 3000, " " * 500, "\n" * 99 + "x", "x y" * 300]


@pytest.mark.parametrize("name,space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_segments_equal_the_library(rnd, name, space):
    import numpy as np

    path = public_tokenizers.path(name)
    enc, lib = tokens.SegmentEncoder(path, space), tokens.library(path)
    for t in texts(rnd):
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("limit", [0, 1500, 20_000])
def test_memories_that_overflow_change_nothing(rnd, monkeypatch, limit):
    import numpy as np

    monkeypatch.setattr(bpe, "PAIRS", 8)
    words = ["straße", "Élan,", "d'été", "x1", "don't", "naïve.", "ſ", "İstanbul", "ĳs", "'ſ", "a\nb", "漢", "Čeština;", "<|endoftext|>y"]
    made = texts(rnd, 60) + [" ".join(rnd.choices(words, k=30)) for _ in range(40)]
    for name, space in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = public_tokenizers.path(name)
        enc, lib = tokens.SegmentEncoder(path, space), tokens.library(path)
        enc.seen, enc.words = tokens.Memory(limit), tokens.Memory(limit)
        for t in made:
            assert np.frombuffer(enc.ids(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t
        assert enc.seen.size <= max(limit // 2, 400) and enc.words.size <= max(limit // 2, 400)
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, lib = bpe.PrefixBpe(path), tokens.library(path)
    own.seen, own.words = tokens.Memory(limit), tokens.Memory(limit)
    for t in made:
        ids = lib.encode(t, add_special_tokens=False).ids
        parts = own.document(t)
        assert ",".join(p[0] for p in parts) == ",".join(map(str, ids)), t
        assert b"".join(p[1] for p in parts).decode("utf-8", "replace") == lib.decode(ids, skip_special_tokens=False)
    assert len(own.fits) <= 8 and len(own.old_fits) <= 8


def test_chunked_count_equals_the_library(rnd):
    lib = tokens.library(public_tokenizers.path("byte_bpe_50k.json"))
    for t in texts(rnd, 30, 2000):
        for chunk, overlap in ((256, 128), (300, 130), (1000, 200)):
            assert token_counts.chunked_count(t, lib, chunk, overlap) == len(lib.encode(t, add_special_tokens=False).ids), t


def test_prefix_bpe_equals_the_library(rnd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, lib = bpe.PrefixBpe(path), tokens.library(path)
    for t in texts(rnd):
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids, t
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_token_counts_and_round_trip_rows(frame, rnd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = tokens.library(path)
    rows = list(enumerate(texts(rnd, 40))) + [(None, "x"), (3, "again"), (3, "again"), (50, None)]
    d = frame(rows)
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len((t or "").encode()), len(ids), len(ids) > 20, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    counts = token_counts.token_counts(d, path, limit=20, chunk=256, overlap=128).collect()
    assert sorted(map(tuple, counts), key=str) == sorted([w[:4] for w in want], key=str)
    trip = bpe.bpe_round_trip(d, path, digests=True).collect()
    assert sorted(map(tuple, trip), key=str) == sorted([(w[0], w[2], *w[4:]) for w in want], key=str)
    real = bpe.bpe_round_trip(d.where("doc_id = 3"), path).first()
    assert real.decoded == rows[3][1] or real.decoded == "again"
    assert token_counts.token_counts(d.limit(0), path, 20).collect() == []
    assert bpe.bpe_round_trip(d.limit(0), path).collect() == []


def test_pack_histogram_places_every_length_once(rnd):
    from collections import Counter

    for _ in range(20):
        counts = {rnd.randint(1, 64): rnd.randint(1, 500) for _ in range(rnd.randint(1, 40))}
        patterns = packing.pack_histogram(counts, 64)
        placed = Counter()
        for packs, runs in patterns:
            assert packs > 0 and sum(a * b for a, b in runs) <= 64
            for a, b in runs:
                placed[a] += packs * b
        assert placed == Counter(counts)
        assert len(patterns) <= 2 * 64


def test_packing_by_hand(frame, rnd):
    import numpy as np

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = tokens.library(path)
    rows = list(enumerate(texts(rnd, 60))) + [(None, "x"), (3, "again"), (3, "again"), (90, None)]
    got = packing.pack(frame(rows).repartition(4), path, end_id=2, max_tokens=64).collect()
    whole = {}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), 64):
            piece = ids[start : start + 64]
            key = (i, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids))
            whole[key] = whole.get(key, 0) + 1
    found = {}
    for r in got:
        found[tuple(r)[:5]] = found.get(tuple(r)[:5], 0) + 1
    assert found == whole
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(r.length for r in got) > 0.9 * 64 * (len(sequences) - 1)
    assert packing.pack(frame(rows).limit(0), path, 2).collect() == []


def test_words_and_segments_share_a_memory_where_space_separates():
    """Plain words are kept once and cut in one go with the others; the ids are the library's."""
    import numpy as np

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, enc = tokens.library(path), tokens.SegmentEncoder(path, False)
    assert enc.seen is enc.words
    for text in ("the lion, the lion's DEN. été ÉTÉ! a\tb x1y22 |<|pad|>| den", "the", "", "  lion\n\nlion. 3,14"):
        for _ in range(2):  # learned, then remembered
            assert np.frombuffer(enc.ids(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    assert sum(w == "lion" for w in enc.seen.young) == 1
