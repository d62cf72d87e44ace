"""Prefix trie of conversations by truncation peeling.

Every conversation is a path of turns; conversations with the same first d turns share the node of
depth d. The peel descends from the greatest depth: the conversations that end at a depth are merged
with the nodes that survive from below, equal paths are grouped (which discovers the node and sums up
its subtree in the same pass), the last turn is stripped, and what is left is grouped again one
turn higher.

A turn is known by 128 bits of the hash of its role and text, a path by the chain of these, so texts
are read once and never cross the network. Paths are cut into segments: the first ``SINGLE`` depths are peeled one turn at
a time; below them ``BLOCK`` turns are stripped per round (two aggregations a round whatever its
width), so a conversation of thousands of turns costs thousands / ``BLOCK`` rounds. Nothing holds
more than one segment of a conversation at a time: the chain is computed by a stream over sorted
turns. Every grouping is pre-aggregated map-side, so a first turn (or a whole conversation) that a third
of the rows share arrives as one row per map task. The conversations that end in a node are hashed
in order from pieces of ``PIECE`` neighbouring ids; a hot node streams its pieces through one hash.

Nulls: a null role or text is empty, null turns come first; rows without a conversation id belong to
no conversation and are left out. Turns with equal numbers are ordered by the hash of role and text,
repeated rows count as turns of their own. Empty and very long texts are turns like others. An empty
table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwire.llm.common import SPACE, text_or_empty, written

SINGLE = 8  # depths (the root's included) that are peeled one turn at a time
BLOCK = 32  # turns stripped per round below them
PIECE = 256  # neighbouring conversation ids hashed as one string
SHARED = 20  # a group of this many ids shares the first turns of its least id
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"

SEGMENT = "block int, conv long, depth int, keys array<binary>, words array<long>, ended boolean"


def word_count(text: Column) -> Column:
    """Words of the contracts' white space, without building them one by one."""
    spread = F.regexp_replace(text, SPACE, " ")
    inner = F.trim(spread)
    return F.when(inner == "", F.lit(0)).otherwise(
        F.length(inner) - F.length(F.replace(inner, F.lit(" "), F.lit(""))) + 1).cast("long")


def turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, turn's name, words of its text)."""
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    name = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), name.alias("name"),
        word_count(text).alias("words"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """(conv, part, at, name, words): the first h turns of the group's least id (part 0), then the own ones
    after the first h (part 1); one row of part -1 per conversation stands for the root."""
    within = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "name")
    ranked = written(rows.withColumn("at", F.row_number().over(within)).drop("turn"), "trie-turns")
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(4))
    convs = ranked.where("at = 1").select("conv", taken.alias("h"), (F.col("conv") - F.col("conv") % SHARED).alias("base"))
    heads = ranked.where((F.col("at") <= 3) & (F.col("conv") % SHARED == 0)).select(
        F.col("conv").alias("base"), "at", "name", "words")
    first = convs.join(heads, "base").where("at <= h").select("conv", F.lit(0).alias("part"), "at", "name", "words")
    own = ranked.where(F.col("at") > taken).select("conv", F.lit(1).alias("part"), "at", "name", "words")
    root = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).alias("at"), F.unhex(F.lit("")).alias("name"),
                        F.lit(0).cast("long").alias("words"))
    return root.unionByName(first).unionByName(own)


def segments(rows: DataFrame, single: int, block: int) -> DataFrame:
    """The paths in segments: keys of the depths ``single + (k - 1) * block`` and on (block 0: 0 to
    ``single - 1``), with the key above them in front where there is one."""

    def chain(batches):
        import hashlib

        import pyarrow as pa

        types = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.bool_()]
        names = ["block", "conv", "depth", "keys", "words", "ended"]
        conv, key, depth, k, keys, words = None, b"", 0, 0, [], []
        out = []

        def close(ended):
            out.append((k, conv, depth, keys, words, ended))

        def flush():
            cols = list(zip(*out)) if out else [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for batch in batches:
            for c, part, name, n in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if part == -1:
                    if conv is not None:
                        close(True)
                    conv, key, depth, k, keys, words = c, b"", 0, 0, [], []
                else:
                    depth += 1
                    if depth == single + k * block:
                        depth -= 1
                        close(False)
                        depth += 1
                        k, keys, words = k + 1, [key], []
                key = hashlib.blake2b(key + name, digest_size=16).digest()
                keys.append(key)
                words.append(n)
                if len(out) >= 4096:
                    yield flush()
        if conv is not None:
            close(True)
        yield flush()

    order = ["conv", "part", "at"]
    # repartition: the three kinds of rows of a conversation meet in one task and are streamed in order
    return rows.repartition("conv").sortWithinPartitions(*order).select(*order, "name", "words").mapInArrow(chain, SEGMENT)


def totals() -> list[Column]:
    return [F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved"))]


def ended_rows(parts: DataFrame) -> DataFrame:
    """Conversations that end here, as subtrees of one member each."""
    none = F.lit(0).cast("long")
    return parts.where("ended").select("keys", "words", "conv", F.lit(1).cast("long").alias("n"), none.alias("kids"),
                                       none.alias("leaves"), none.alias("saved"))


def node_columns(key: Column, parent: Column, depth: Column) -> list:
    return [key.alias("key"), parent.alias("parent"), depth.cast("long").alias("depth"), "conv", "n", "kids", "leaves", "saved"]


def peel_block(live: DataFrame, low: int) -> DataFrame:
    """Nodes of one block below depth ``low`` from its live rows (keys: the one above, then the block's own)."""
    at = F.sequence(F.lit(1), F.size("words"))
    spread = live.select("*", F.explode(at).alias("i"))
    last = F.col("i") == F.size("words")
    nodes = (spread.select(F.slice("keys", 1, F.col("i") + 1).alias("path"), F.element_at("words", F.col("i")).alias("w"), "conv", "n",
                           F.when(last, F.col("kids")).otherwise(0).alias("kids"), "leaves", "saved",
                           (~last | (F.col("kids") > 0)).alias("inner"))
             .groupBy("path", "w").agg(*totals(), F.max("inner").alias("inner")))
    value = nodes.withColumn("own_saved", (F.col("n") - 1) * F.col("w")).withColumn("own_leaf", F.when(F.col("inner"), 0).otherwise(1))
    # each node adds to those above it in the block, and to itself
    up = value.select("*", F.explode(F.sequence(F.lit(2), F.size("path"))).alias("j"))
    self = F.col("j") == F.size("path")
    mine = lambda c: F.max(F.when(F.col("self"), F.col(c)))
    return (up.select("*", F.element_at("path", F.col("j")).alias("key"), F.element_at("path", F.col("j") - 1).alias("parent"),
                      self.alias("self"), (F.col("j") == F.size("path") - 1).alias("child"))
            .groupBy("key", "parent", "j")
            .agg(mine("conv").alias("conv"), mine("n").alias("n"),
                 (mine("kids") + F.sum(F.col("child").cast("long"))).alias("kids"),
                 (mine("leaves") + F.sum("own_leaf")).alias("leaves"), (mine("saved") + F.sum("own_saved")).alias("saved"))
            .select(*node_columns(F.col("key"), F.col("parent"), F.col("j") - 1 + low)))


def survivors(nodes: DataFrame) -> DataFrame:
    """The parents of ``nodes`` with what lies below them."""
    return nodes.groupBy(F.col("parent").alias("key")).agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"))


def prefix_nodes(parts: DataFrame, single: int = SINGLE, block: int = BLOCK) -> DataFrame:
    """(key, parent, depth, conv, n, kids, leaves, saved) per node, from written segments."""
    spark = parts.sparkSession
    top = parts.agg(F.max("block")).first()[0]
    if top is None:
        return spark.createDataFrame([], "key binary, parent binary, depth long, conv long, n long, kids long, leaves long, saved long")
    found, live = [], None
    for k in range(top, -1, -1):
        here = parts.where(F.col("block") == k)
        rows = ended_rows(here)
        if live is not None:  # the nodes that survive from below, with the path of their least member
            paths = here.where(~F.col("ended")).select("conv", "keys", "words")
            rows = rows.unionByName(live.drop("key").join(paths, "conv"))
        if k:
            low = single + (k - 1) * block - 1
            nodes = written(peel_block(rows, low), "trie-block")
            found.append(nodes)
            live = survivors(nodes.where(F.col("depth") == low + 1))
            continue
        rest = written(rows, "trie-live")
        for d in range(single - 1, -1, -1):  # one turn at a time
            level = rest.where(F.size("keys") == d + 1).drop("key")
            if live is not None and d < single - 1:
                level = level.unionByName(live)
            grouped = level.groupBy("keys", "words").agg(*totals())
            w = F.element_at("words", -1)
            level = written(grouped.withColumn("leaves", F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("long"))
                            .withColumn("saved", F.col("saved") + (F.col("n") - 1) * w), "trie-level")
            parent = F.try_element_at("keys", F.lit(-2))
            found.append(level.select(*node_columns(F.element_at("keys", -1), parent, F.lit(d))))
            live = level.select(F.slice("keys", 1, d).alias("keys"), F.slice("words", 1, d).alias("words"), "conv", "n",
                                F.lit(1).cast("long").alias("kids"), "leaves", "saved")
    out = found[0]
    for nodes in found[1:]:
        out = out.unionByName(nodes)
    return out


def ends(parts: DataFrame, piece: int = PIECE) -> DataFrame:
    """(key, ends_sha256) of the nodes in which conversations end: their ids in order, hashed as a stream."""
    own = parts.where("ended").select(F.element_at("keys", -1).alias("key"), "conv", F.floor(F.col("conv") / piece).alias("at"))
    pieces = own.groupBy("key", "at").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches):
        import hashlib

        import pyarrow as pa

        key, sha = None, None
        for batch in batches:
            keys, shas = [], []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k == key:
                    sha.update(b"," + ids.encode())
                    continue
                if key is not None:
                    keys.append(key)
                    shas.append(sha.hexdigest())
                key, sha = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])

    return pieces.repartition("key").sortWithinPartitions("key", "at").mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", single: int = SINGLE, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (words that sharing the nodes of the subtree saves), ends_sha256, and node_key, parent_key."""
    rows = rebuilt(turns(conversations, conv_col, turn_col, role_col, text_col))
    parts = written(segments(rows, single, block), "trie-segments")
    nodes = written(prefix_nodes(parts, single, block), "trie-nodes")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    done = written(ends(parts), "trie-ends")
    return (nodes.join(above, "parent", "left").join(done, "key", "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
                    F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
                    F.lower(F.hex("key")).alias("node_key"), F.lower(F.hex("parent")).alias("parent_key")))
