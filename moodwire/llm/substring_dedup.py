"""Substring dedup: repeated windows of words, found level by level.

A window of ``window`` words that starts in a text and also in a text with a smaller id is a repeat;
every word it covers goes. Windows are judged on the input.

1. Half level. Texts with the same words are one class; only its smallest id goes on (every window of
   the others repeats in it). Of the half-length windows of a text those that are least, by hash, among
   the half-length windows of some full window are its seeds (about one word in 13), so each full
   window holds a seed that depends on its own words alone. Seeds that only one class has are dropped.
2. Full level. Around the surviving seeds alone, half windows are extended to full ones, each named by
   the names of its two halves (128 bits). A window is a repeat where its least id is smaller.
3. Longer windows cannot remove more words, so the doubling ends here; what survives is removed.

Where the data goes: seeds move twice (counted with partial aggregation, then joined back to their
places), texts once, to meet their seeds; windows around seeds once. A window that may be frequent
(its seed has n > ``FREQUENT`` places) is dealt over sqrt(n) salts by id: a row above the least id of
its salt is a repeat already, and only the least rows, one per salt, meet under the key again. So a
passage that a third of all texts share never meets in one task, and no window is joined to anything.
Tasks hold one Arrow batch, texts in blocks of some MB.

Rows are known by id and class of their words wherever they are joined, so rows that share an id, or
have none, meet only rows of the same words.

Null texts have no words. Null ids order last and are never smaller than one another; repeated rows
are judged alike; texts shorter than a window keep all words; an empty table gives no rows; further
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwire.llm import wordgrams
from moodwire.llm.common import written

WINDOW = 50
FREQUENT = 1_000  # places of a seed
LAST = 2**63 - 1


def _order(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST))


def _read(batch, at: int = 1):
    return [(v.as_py() or "").encode() for v in batch.column(at)]


def _class(words: list[bytes]) -> tuple[bytes, int]:
    """Digest of a text's words, and its first eight bytes as a signed integer."""
    import hashlib

    digest = hashlib.sha256(b" ".join(words)).digest()
    return digest, int.from_bytes(digest[:8], "little", signed=True)


def keyed(docs: DataFrame) -> DataFrame:
    """(o, text, c) per row of (o, text): c is the class of the words."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            c = pa.array([_class(_split(text))[1] for text in _read(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), c], names=["o", "text", "c"])

    return docs.mapInArrow(run, "o long, text string, c long")


def _split(text: bytes) -> list[bytes]:
    return text.split()  # bytes are split at 0x20 and 0x09 to 0x0D


def classes(docs: DataFrame) -> DataFrame:
    """(o, n_words, sha, c) per row of (o, text)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, sha, c = [], [], []
            for text in _read(batch):
                words = _split(text)
                digest, short = _class(words)
                n.append(len(words))
                sha.append(digest)
                c.append(short)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
                                              pa.array(c, pa.int64())], names=["o", "n_words", "sha", "c"])

    return docs.mapInArrow(run, "o long, n_words long, sha binary, c long")


def _seeds_of(names, window: int):
    """Seed of every full window of one text, given the names of its half windows: the leftmost least."""
    import numpy as np

    reach = window // 2 + 1  # half windows in a full one
    if len(names) < reach:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(names, reach)
    out = np.empty(len(views), np.int64)
    for a in range(0, len(views), 1 << 16):
        out[a : a + (1 << 16)] = views[a : a + (1 << 16)].argmin(axis=1)
    return out + np.arange(len(views))


def seeds(docs: DataFrame, window: int) -> DataFrame:
    """(g, o, c, p): name and place of every seed."""
    half = (window + 1) // 2  # two halves of an odd window share its middle word

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            order, texts = batch.column(0).to_numpy(), _read(batch)
            for block in wordgrams.in_blocks(texts):
                hashes, bounds, *_ = wordgrams.word_hashes([t for _, t in block])
                names = wordgrams.doubled(hashes, half)
                g, o, c, p = [], [], [], []
                for (k, text), a, b in zip(block, bounds[:-1], bounds[1:]):
                    if b - a < window:
                        continue
                    own = names[a : b - half + 1]
                    at = np.unique(_seeds_of(own, window))
                    g.append(own[at])
                    p.append(at)
                    o.append(np.full(len(at), order[k]))
                    c.append(np.full(len(at), _class(_split(text))[1]))
                if g:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(g).view(np.int64)), pa.array(np.concatenate(o)), pa.array(np.concatenate(c)),
                         pa.array(np.concatenate(p).astype(np.int32))], names=["g", "o", "c", "p"])

    return docs.mapInArrow(run, "g long, o long, c long, p int")


def windows(candidates: DataFrame, window: int, frequent: int) -> DataFrame:
    """(k1, k2, salt, salts, o, c, s): the full windows around the seeds of (o, text, c, ps), with ps
    the seeds' places and how often each seed occurs: names of both halves, the salt of the id among
    the window's salts, and the place."""
    half = (window + 1) // 2  # two halves of an odd window share its middle word
    shift = window - half
    names_out = ["k1", "k2", "salt", "salts", "o", "c", "s"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            order, texts, own_class = batch.column(0).to_numpy(), _read(batch), batch.column(2).to_numpy()
            spread = wordgrams.mixed(order.astype(np.uint64))
            for block in wordgrams.in_blocks(texts):
                hashes, bounds, *_ = wordgrams.word_hashes([t for _, t in block])
                names = wordgrams.doubled(hashes, half)
                out = [[] for _ in names_out]
                for (k, text), a, b in zip(block, bounds[:-1], bounds[1:]):
                    if b - a < window or _class(_split(text))[1] != own_class[k]:
                        continue  # another text under the same id
                    own = names[a : b - half + 1]
                    seed = _seeds_of(own, window)
                    places = batch.column(3)[k].values
                    times = np.zeros(len(own), np.int64)
                    times[places.field(0).to_numpy()] = places.field(1).to_numpy()
                    n = times[seed]
                    s = np.flatnonzero(n)
                    salts = np.where(n[s] > frequent, np.ceil(np.sqrt(n[s])), 1).astype(np.int32)
                    for c, v in zip(out, (own[s].view(np.int64), own[s + shift].view(np.int64),
                                          (spread[k] % salts.astype(np.uint64)).astype(np.int32), salts,
                                          np.full(len(s), order[k]), np.full(len(s), own_class[k]), s.astype(np.int32))):
                        c.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names_out)

    return candidates.mapInArrow(run, "k1 long, k2 long, salt int, salts int, o long, c long, s int")


def kept_words(marked: DataFrame, window: int, whole: bool) -> DataFrame:
    """(o, c, n_removed, kept) of (o, text, c, starts): kept is the text of the words that stay, or its
    digest."""

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = [[] for _ in range(4)]
            for k, text in enumerate(_read(batch)):
                words, own = _split(text), batch.column(2)[k].as_py()
                if _class(words)[1] != own:
                    continue
                cover = np.zeros(len(words) + 1, np.int64)
                starts = np.unique(batch.column(3)[k].values.to_numpy())
                cover[starts] += 1
                cover[starts + window] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                kept = b" ".join([w for w, x in zip(words, gone.tolist()) if not x])
                for c, v in zip(rows, (batch.column(0)[k].as_py(), own, int(gone.sum()),
                                       kept.decode() if whole else hashlib.sha256(kept).hexdigest())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
                                              pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.string())],
                                             names=["o", "c", "n_removed", "kept"])

    return marked.mapInArrow(run, "o long, c long, n_removed long, kept string")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
            whole: bool = False, frequent: int = FREQUENT) -> DataFrame:
    """(id, n_words, n_removed, kept) per row; kept is the remaining words joined by spaces (``whole``)
    or the SHA-256 of that."""
    rows = docs.select(_order(id_col).alias("o"), F.col(text_col).alias("text"))
    info = written(classes(rows), "classes")
    first = written(info.groupBy("sha").agg(F.min("o").alias("first")), "first")
    ranked = written(info.join(first, "sha").select("o", "n_words", "sha", "c", (F.col("o") > F.col("first")).alias("copy")), "ranked")

    places = seeds(rows, window)
    shared = written(places.groupBy("g").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("n"))
                     .where("low < high").select("g", "n"), "seeds")
    found = places.join(shared, "g").groupBy("o", "c").agg(F.collect_set(F.struct("p", "n")).alias("ps"))
    heads = ranked.where(~F.col("copy")).select("o", "c").distinct()
    candidates = written(keyed(rows).join(found.join(heads, ["o", "c"]), ["o", "c"]).select("o", "text", "c", "ps"), "candidates")

    key = ["k1", "k2"]
    full = windows(candidates, window, frequent).withColumn("least", F.min("o").over(Window.partitionBy(*key, "salt")))
    sure = full.where("o > least")
    open_ = (full.where("o = least and salts > 1")  # one id per salt
             .withColumn("least", F.min("o").over(Window.partitionBy(*key))).where("o > least"))
    gone = sure.unionByName(open_).groupBy("o", "c").agg(F.collect_set("s").alias("starts"))
    cut = kept_words(candidates.select("o", "text", "c").join(gone, ["o", "c"]).select("o", "text", "c", "starts"), window, whole)
    cut = cut.dropDuplicates(["o", "c"])  # rows that repeat id and text

    emptied = F.col("copy") & (F.col("n_words") >= window)
    untouched = F.lower(F.hex("sha")) if not whole else F.lit(None).cast("string")
    nothing = F.lit("") if whole else F.sha2(F.lit(""), 256)
    out = ranked.join(cut, ["o", "c"], "left").select(
        F.when(F.col("o") != LAST, F.col("o")).cast(docs.schema[id_col].dataType).alias(id_col), "n_words",
        F.when(emptied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(emptied, nothing).otherwise(F.coalesce("kept", untouched)).alias("kept"))
    return out


def substring_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     frequent: int = FREQUENT) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256)."""
    return repeats(docs, id_col, text_col, window, frequent=frequent).withColumnRenamed("kept", "kept_sha256")
