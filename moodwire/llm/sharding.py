"""Shards by histogram sort: splitters found by counting, one exchange.

Rows are ordered by (key, id). The key is an integer: the size class of the row's group (equal texts),
largest first, then a hash of the text, so a group stays together and the groups that could make a
border uneven lie where few borders fall. Splitters are probes refined in rounds: each round counts
the bytes below every probe over all rows (sums per interval between probes, pre-aggregated in the
tasks) and keeps for each splitter the interval that holds its target, until the count is within
``TOLERANCE`` of it. Where one group is wider than that, the same search goes on over the ids inside
the group, so a group that a third of all bytes belong to is dealt to as many shards as it needs; a
border that can pass beside the group within ``WHOLE`` of its target leaves it in one shard.

Then rows go once to fine ranges of the order (the shard borders among the range borders), each sorted
in its task; a row's slot is its place in the range plus the rows of the shard's earlier ranges.

The driver holds probes and one sum per probe: their number depends on the number of shards. Texts are
read once, row-locally; only (id, size, checksum, hash) rows move.

Null texts have size 1 and the checksum of no bytes. Null ids order first, repeated rows each take a
slot; an empty table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwire.llm.common import text_or_empty, written

TOLERANCE = 1e-4  # of a shard's share
WHOLE = 1e-2  # of a shard's share: a border this close to its target goes beside a group, not into it
PROBES = 64  # per open splitter and round
CLASSES = 6  # bits of the key for the size class
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, size, text_crc32, text_key): sizes in bytes plus 1, and two hashes of the text."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"))


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``: 63 minus the binary logarithm of the group's bytes, then hash bits."""
    groups = written(rows.groupBy("hash").agg(F.sum("size").alias("bytes")), "groups")
    size_class = 63 - F.floor(F.log2("bytes")).cast("bigint")
    key = F.shiftleft(size_class, 63 - CLASSES) + F.shiftrightunsigned(F.col("hash"), CLASSES + 1)
    return rows.join(groups, "hash").select("id", "size", "text_crc32", key.alias("key"))


def _interval(value: Column, probes: list[int]) -> Column:
    """How many probes are at most the value, by binary search written as nested conditions."""
    def tree(lo, hi):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < probes[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(probes))


def _below(rows: DataFrame, col: str, probes: list[int]) -> list[int]:
    """Exact bytes of rows whose value is below each probe (bounded: one row per probe)."""
    sums = rows.groupBy(_interval(F.col(col), probes).alias("k")).agg(F.sum("size").alias("s")).collect()
    by = {r["k"]: r["s"] for r in sums}
    out, run = [], 0
    for k in range(len(probes)):
        run += by.get(k, 0)
        out.append(run)
    return out


def _search(rows: DataFrame, col: str, targets: list[float], slack: float, base: int, lowest: int, highest: int) -> list[tuple[int, int, int]]:
    """For each target: (value, bytes below it, bytes below value + 1), where the value is either
    within ``slack`` of the target or the one whose rows hold it."""
    open_, found = {t: (lowest, base, highest, None) for t in targets}, {}
    while open_:
        probes = sorted({lo + (hi - lo) * k // (PROBES + 1) for lo, _, hi, _ in open_.values() for k in range(1, PROBES + 1)}
                        - {lo for lo, *_ in open_.values()}
                        | {lo + 1 for lo, _, hi, _ in open_.values() if hi - lo <= PROBES + 1 and lo + 1 < hi})
        below = [base + b for b in _below(rows, col, probes)] if probes else []
        still = {}
        for t, (lo, lo_bytes, hi, hi_bytes) in open_.items():
            for p, b in zip(probes, below):
                if lo < p <= hi:
                    if b <= t:
                        lo, lo_bytes = p, b
                    else:
                        hi, hi_bytes = min((hi, hi_bytes), (p, b), key=lambda x: x[0])
            if t - lo_bytes <= slack:
                found[t] = (lo, lo_bytes, None)
            elif hi_bytes is not None and hi_bytes - t <= slack:
                found[t] = (hi, hi_bytes, None)
            elif hi - lo <= 1:
                found[t] = (lo, lo_bytes, hi_bytes)
            else:
                still[t] = (lo, lo_bytes, hi, hi_bytes)
        open_ = still
    return [found[t] for t in targets]


def splitters(rows: DataFrame, shards: int) -> list[tuple[int, int | None]]:
    """Borders (key, id): a row is beyond a border when (key, id) is not below it; without an id the
    border lies before the key's first row."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    slack = TOLERANCE * total / shards
    out = []
    targets = [total * k / shards for k in range(1, shards)]
    for t, (key, below, upto) in zip(targets, _search(rows, "key", targets, slack, 0, LOWEST, HIGHEST)):
        if upto is None:
            out.append((key, None))
            continue
        if min(t - below, upto - t) <= WHOLE * total / shards:
            out.append((key if t - below <= upto - t else key + 1, None))
            continue
        # the key's own rows hold the target: go on over their ids (rows of one key only)
        group = rows.where(F.col("key") == key).select(F.coalesce("id", F.lit(LOWEST)).alias("id"), "size")
        ends = group.agg(F.min("id"), F.max("id")).first()
        (at, under, after), = _search(group, "id", [t], slack, below, ends[0], ends[1] + 1)
        if after is not None and after - t < t - under:  # the nearer side of the last row
            at += 1
        out.append((key, at if at > ends[0] else None) if at <= ends[1] else (key + 1, None))
    return sorted(out, key=lambda b: (b[0], LOWEST if b[1] is None else b[1]))


def _beyond(border: tuple[int, int | None]) -> Column:
    key, at = border
    if at is None:
        return F.col("key") >= key
    return (F.col("key") > key) | ((F.col("key") == key) & (F.coalesce("id", F.lit(LOWEST)) >= at))


def shard_rows(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot), one row per row of ``docs``; shards hold near equal bytes."""
    rows = written(keyed(written(measured(docs, id_col, text_col), "measured")), "keyed")
    borders = splitters(rows, shards)
    shard = sum((_beyond(b).cast("int") for b in borders), F.lit(0))
    # one exchange: ranges of (shard, key, id); a range ends inside any group, so ids spread hot keys
    order = ["shard", "key", "id", "text_crc32"]
    spread = (rows.withColumn("shard", shard).repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("at", F.monotonically_increasing_id()))
    placed = written(spread.select("id", "size", "text_crc32", "shard", F.shiftright("at", 33).alias("range"),
                                   F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "placed")
    held = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("shard", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"))
    return placed.join(starts, ["shard", "range"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("start") + F.col("at")).alias("slot"))


def sharding_digest(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    found = shard_rows(docs, shards, id_col, text_col)
    return found.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
