"""Exact dedup by deterministic block naming, with DataFrame operators only.

A normalised text is cut into blocks of ``block`` characters. Distinct blocks are sorted and numbered;
then adjacent pairs of numbers are sorted and numbered, and so on, until each text has one number.
Two texts have the same number at the same level exactly when they are equal: numbers stand for
contents, not for hashes.

Where the data goes: block contents cross the network once, pre-aggregated, in the pass that proves
which block hashes stand for one content. A block is then known by (hash, rank of its content among
the contents of that hash); the rank is 0 unless hashes collide, and only colliding blocks are sorted
by content again. Everything after that moves rows of a few numbers. A block or text that a third of
all rows share is one row per map task in the sorts and meets the numbers in joins that adaptive
execution splits. The driver sees one number: the largest count of blocks (for the number of levels).

A null text counts as empty. Rows are told apart by (id, text), so repeated rows and repeated or null
ids are allowed: of equal texts the smallest id stays, of repeated rows with that id one. An empty
table gives no rows. ``exact_dedup`` reads two columns; ``drop_duplicates`` keeps all columns as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwire.llm.common import SPACE, fresh, text_or_empty, utf8_sha256, written

BLOCK = 4_096


def normalised(text_col: str) -> Column:
    return F.regexp_replace(text_or_empty(text_col), SPACE, " ")


def numbered(keys: DataFrame, name: str) -> DataFrame:
    """Each distinct row of ``keys`` with an integer, in sort order."""
    return written(keys.distinct().orderBy(*keys.columns).withColumn("name", F.monotonically_increasing_id()), name)


def _blocks(docs: DataFrame, id_col: str, text_col: str, block: int, hashed) -> DataFrame:
    """One row per block: (id, sha, n, i, block, h)."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
    cut = rows.select("id", F.unhex(utf8_sha256(F.col("norm"))).alias("sha"),
                      F.when(F.col("norm") == "", F.array(F.lit("")))
                      .otherwise(F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))).alias("parts"))
    out = cut.select("id", "sha", F.size("parts").alias("n"), F.posexplode("parts").alias("i", "block"))
    return out.withColumn("h", hashed(F.col("block")))


def _ranks(blocks: DataFrame) -> DataFrame | None:
    """(h, block, rank) for the hashes that stand for several contents; None if there are none."""
    several = written(blocks.groupBy("h", "block").agg(F.count(F.lit(1)).alias("c"))
                      .groupBy("h").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("h"), "collided")
    if several.limit(1).count() == 0:
        return None
    # a hash holds as many contents as collide on it: few
    return (blocks.join(several, "h").select("h", "block").distinct()
            .withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("block")) - 1))


def identities(docs: DataFrame, id_col: str, text_col: str, block: int = BLOCK, hashed=F.xxhash64) -> DataFrame:
    """(id, sha, copies, level, name) per distinct (id, text): equal (level, name) means equal texts."""
    blocks = _blocks(docs, id_col, text_col, block, hashed)
    ranks = _ranks(blocks)
    if ranks is None:
        known = blocks.select("id", "sha", "n", "i", "h", F.lit(0).alias("rank"))
    else:
        known = blocks.join(ranks, ["h", "block"], "left").select(
            "id", "sha", "n", "i", "h", F.coalesce("rank", F.lit(0)).alias("rank"))
    level0 = written(known.groupBy("id", "sha", "n", "i", "h", "rank").agg(F.count(F.lit(1)).alias("copies")), "blocks")
    names = numbered(level0.select("h", "rank"), "names-0")
    rest = level0.join(names, ["h", "rank"]).select("id", "sha", "copies", "n", "i", "name")
    rest = written(rest, "level-0")
    most = rest.agg(F.max("n")).first()[0] or 0
    done, level = rest.where("n = 1"), 0
    out = done.select("id", "sha", "copies", F.lit(0).alias("level"), "name")
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        even = F.col("i") % 2 == 0
        pairs = (rest.where("n > 1").groupBy("id", "sha", "copies", F.expr("(n + 1) div 2").alias("n"), F.expr("i div 2").alias("i"))
                 .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")))
        pairs = written(pairs, f"pairs-{level}")
        names = numbered(pairs.select("a", "b"), f"names-{level}")
        rest = written(pairs.join(names, ["a", "b"]).select("id", "sha", "copies", "n", "i", "name"), f"level-{level}")
        out = out.unionByName(rest.where("n = 1").select("id", "sha", "copies", F.lit(level).alias("level"), "name"))
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                hashed=F.xxhash64) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``."""
    found = identities(docs, id_col, text_col, block, hashed)
    groups = found.groupBy("level", "name").agg(F.min("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    joined = found.join(groups, ["level", "name"])
    each = joined.select("id", "keep_id", "group_size", "sha",
                         F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return each.select(F.col("id").alias(id_col), "keep_id", "group_size",
                       (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                       F.lower(F.hex("sha")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged."""
    key, order = fresh("key"), fresh("order")
    stay = (exact_dedup(docs, id_col, text_col, block).where("kept")
            .select(F.concat_ws(":", "text_sha256", F.col(id_col).cast("string")).alias(key)))
    keyed = docs.withColumn(key, F.concat_ws(":", utf8_sha256(normalised(text_col)), F.col(id_col).cast("string")))
    once = Window.partitionBy(key).orderBy(order)  # rows that repeat both id and text: the join has them together
    return (keyed.join(stay, key, "left_semi").withColumn(order, F.xxhash64(*docs.columns))
            .withColumn(order, F.row_number().over(once)).where(F.col(order) == 1).drop(key, order))
