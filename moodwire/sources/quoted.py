"""CSV files whose quoted fields hold line feeds, read by many tasks.

A reader that starts in the middle of a file cannot tell whether a line feed ends a record or stands
inside quotes; Spark's ``multiLine`` therefore gives a whole file to one task. Here every split is read
as lines, and one number per split settles the question: a line feed ends a record exactly if the number of
quotes before it is even (a doubled quote counts two).

1. Quotes are counted per split (one aggregation, one row per split).
2. A running sum over the splits of a file, in order, says which splits start inside quotes.
3. Every split is cut into records where the running parity of its own lines is even. What remains at
   its two ends, the rest of a record that began in an earlier split and the start of one that does
   not end in it, are fragments, at most two a split; they are put together by a small grouping.

The lines themselves never move: the state of a split reaches them by a broadcast join up to
``BROADCAST_SPLITS`` splits (about 10 MB), beyond that by a shuffle on (file, split).

Fields are parsed by Spark's own CSV parser (``from_csv``). As RFC 4180 asks, quotes must stand around a
whole field and be doubled inside it. A file with an odd number of quotes raises, or with
``strict=False`` ends in one record from the last open quote to its end, as a serial reader has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodwire.session import work_path

BROADCAST_SPLITS = 100_000
COMPLETE, HEAD, TAIL = 0, 1, 2  # a record; the end of one begun earlier; the start of one that ends later

_RECORD = "file string, split long, kind int, text string"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line) of every line of the files, in the order of the scan."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line"))


def split_states(lines: DataFrame) -> DataFrame:
    """(file, split, quotes, inside): whether the split starts inside quotes. One row per split with lines."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    per = lines.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


def _cut(batches):
    """mapInArrow body: lines in order, with their split's state -> records and fragments."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = ["file", "split", "kind", "text"]
    at, odd, began, open_lines = None, 0, False, []

    def made(files, splits, kinds, texts):
        return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(splits, pa.int64()),
                                           pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], names=names)

    def rest():
        """What a split leaves open at its end."""
        if at is not None and open_lines:
            yield made([at[0]], [at[1]], [TAIL if began else HEAD], ["\n".join(open_lines)])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        files, splits, lines, inside = (batch.column(k) for k in range(4))
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
        split_of = splits.to_numpy(zero_copy_only=False)
        changed = np.flatnonzero((split_of[1:] != split_of[:-1])
                                 | pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False)) + 1
        for a, b in zip([0, *changed], [*changed, n]):
            here = (files[a].as_py(), int(split_of[a]))
            if here != at:
                yield from rest()
                at, odd, open_lines = here, int(inside[a].as_py()), []
                began = not odd
            parity = (odd + np.cumsum(quotes[a:b])) % 2
            ends = np.flatnonzero(parity == 0)  # lines that end a record
            texts, kinds, start = [], [], 0
            values = lines.slice(a, b - a).to_pylist()
            for e in ends:
                if e == start and not open_lines:
                    texts.append(values[e])
                else:
                    texts.append("\n".join([*open_lines, *values[start:e + 1]]))
                    open_lines = []
                kinds.append(COMPLETE if began else HEAD)
                began, start = True, e + 1
            open_lines += values[start:]
            odd = int(parity[-1])
            if texts:
                yield made([here[0]] * len(texts), [here[1]] * len(texts), kinds, texts)
    yield from rest()


def quoted_records(spark: SparkSession, path: str, strict: bool = True, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """(file, record): the records of CSV files as text, line feeds inside quotes kept."""
    lines = split_lines(spark, path)
    kept = work_path(spark, "csv-splits")
    split_states(lines).write.parquet(kept)  # one row per split: read by both passes below
    states = spark.read.schema("file string, split long, quotes long, inside boolean").parquet(kept)
    if strict:
        odd = states.groupBy("file").agg((F.sum("quotes") % 2).alias("odd")).where("odd = 1").select("file").first()
        if odd is not None:
            raise ValueError(f"{odd['file']} holds an odd number of quotes: a quoted field is not closed")
    states = states.select("file", "split", "inside")
    if states.count() <= broadcast_splits:
        known = lines.join(F.broadcast(states), ["file", "split"])
    else:  # the order of a split's lines goes with them
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        known = numbered.join(states.hint("merge"), ["file", "split"]).sortWithinPartitions("file", "split", "at")
    cut = known.select("file", "split", "line", "inside").mapInArrow(_cut, _RECORD)
    whole = cut.where(F.col("kind") == COMPLETE).select("file", F.col("text").alias("record"))
    pieces_path = work_path(spark, "csv-fragments")
    cut.where(F.col("kind") != COMPLETE).write.parquet(pieces_path)
    pieces = spark.read.schema(_RECORD).parquet(pieces_path)
    # a tail opens a record, the heads after it (of splits that lie within it, and of the one it ends in) complete it
    order = Window.partitionBy("file").orderBy("split", "kind")
    owner = pieces.select("file", "split", "kind").withColumn("owner", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
    parts = pieces.join(owner, ["file", "split", "kind"])
    spanning = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("split", "kind", "text"))).alias("parts"))
    return whole.unionByName(spanning.select("file", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("record")))


def read_quoted_csv(spark: SparkSession, path: str, schema: str, strict: bool = True,
                    broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """The records of CSV files under ``schema``, equal to ``spark.read.csv`` with ``multiLine`` and doubled quotes,
    read by as many tasks as the files have splits. Empty lines between records are skipped."""
    records = quoted_records(spark, path, strict, broadcast_splits)
    record = F.regexp_replace("record", "\r\\z", "")  # of files whose records end with both characters
    parsed = F.from_csv(record, schema, {"escape": '"', "multiLine": "true", "lineSep": "\n", "mode": "PERMISSIVE"})
    return records.where(~F.col("record").isin("", "\r")).select(parsed.alias("r")).select("r.*")
