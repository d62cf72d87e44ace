"""Packing token sequences: shortest pack first over the histogram of lengths.

1. Row-local: each text is tokenized once and cut into pieces of at most ``max_tokens`` ids; a piece
   carries its length, checksum, task number and its rank among the task's pieces of that length.
2. The histogram (one count per length, at most ``max_tokens`` rows) is the only thing the driver sees.
   Lengths are placed longest first, each on the packs with the most room left ("shortest" packs);
   packs with the same content are one pattern with a count, so the work and the size of the plan
   depend on ``max_tokens``, not on the number of documents.
3. Patterns are joined back by rank: the r-th piece of a length takes the r-th slot of that length.
   Global ranks are task ranks plus the counts of earlier tasks (a window over per-task counts, not
   over pieces), so a length that a third of all pieces share needs no common task.

A null text counts as empty (one piece: the end token alone); repeated rows are packed each on their
own; an empty table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.llm import tokens
from moodwire.llm.common import written

MAX_TOKENS = 4_096


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of packs, [(length, copies), ...]) that hold every counted length once.

    A pattern's packs share their room left; the lists are keyed by that room. Every step either ends
    a length (at most one pattern splits) or moves a whole pattern, so there are at most two patterns
    for each length.
    """
    by_room: dict[int, list] = {}
    most = 0  # no pattern has more room than this

    def put(room, packs, runs):
        nonlocal most
        by_room.setdefault(room, []).append((packs, runs))
        most = max(most, room)

    def grown(runs, length, copies=1):
        if runs and runs[-1][0] == length:
            return [*runs[:-1], (length, runs[-1][1] + copies)]
        return [*runs, (length, copies)]

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            while most and not by_room.get(most):
                most -= 1
            if most < length:  # no pack has room: open packs, each filled before the next
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    put(capacity - each * length, full, [(length, each)])
                if rest:
                    put(capacity - rest * length, 1, [(length, rest)])
                break
            packs, runs = by_room[most].pop()
            room, used = most, min(packs, left)
            if used < packs:
                by_room[room].append((packs - used, runs))
            put(room - length, used, grown(runs, length))
            left -= used
    return [p for room in sorted(by_room) for p in by_room[room]]


def slot_table(patterns: list[tuple[int, list[tuple[int, int]]]]):
    """Arrays sorted by (length, first rank): each row gives ``count * copies`` ranks of a length to
    the packs of one pattern."""
    import numpy as np

    taken: dict[int, int] = {}
    rows, base = [], 0
    for packs, runs in patterns:
        offset = 0
        for length, copies in runs:
            rows.append((length, taken.get(length, 0), copies, base, offset))
            taken[length] = taken.get(length, 0) + packs * copies
            offset += length * copies
        base += packs
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, max_tokens: int = MAX_TOKENS, id_col: str = "doc_id",
           text_col: str = "text", leading_space: bool = False) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, task, task_rank)."""

    def cut(batches):
        import zlib
        from collections import Counter

        import pyarrow as pa
        from pyspark import TaskContext

        enc = tokens.encoder(tokenizer_path, leading_space)
        end, task, ranks = end_id.to_bytes(4, "little"), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            source, cols = [], [[] for _ in range(6)]
            for k, value in enumerate(batch.column(1)):
                ids = enc.ids(value.as_py() or "") + end
                n = len(ids) // 4
                for start in range(0, n, max_tokens):
                    piece = ids[4 * start : 4 * (start + max_tokens)]
                    length = len(piece) // 4
                    source.append(k)
                    for c, v in zip(cols, (start, length, zlib.crc32(piece), n, task, ranks[length])):
                        c.append(v)
                    ranks[length] += 1
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source, pa.int64())),
                                              *[pa.array(c, pa.int64()) for c in cols]], names=schema.names)

    rows = docs.select(id_col, text_col)
    schema = T.StructType([rows.schema[id_col], *[T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "task", "task_rank")]])
    return rows.mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, max_tokens: int = MAX_TOKENS, id_col: str = "doc_id",
         text_col: str = "text", leading_space: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece."""
    cut = written(pieces(docs, tokenizer_path, end_id, max_tokens, id_col, text_col, leading_space), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # bounded: one row per length, at most max_tokens rows
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = slot_table(pack_histogram(histogram, max_tokens))
    shared = docs.sparkSession.sparkContext.broadcast(slots)  # at most 2 * max_tokens patterns

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = cut.join(first, ["length", "task"]).select(
        id_col, "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("task_rank")).alias("rank"))

    def place(batches):
        import numpy as np
        import pyarrow as pa

        table = shared.value
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            row = np.empty(len(length), np.int64)
            for one in np.unique(length):
                lo, hi = np.searchsorted(table[:, 0], one), np.searchsorted(table[:, 0], one, side="right")
                at = length == one
                row[at] = lo + np.searchsorted(table[lo:hi, 1], rank[at], side="right") - 1
            within, copies = rank - table[row, 1], table[row, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(table[row, 3] + within // copies),
                 pa.array(table[row, 4] + length * (within % copies))], names=schema.names)

    schema = T.StructType([*ranked.schema.fields[:5], T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)
