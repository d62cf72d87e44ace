"""Product codes of vectors, with metric trees (anchors hierarchy) over the parts.

Vectors become integers, floor(scale * x), and are cut into equal consecutive parts. The rows are dealt
into blocks of ``BLOCK`` vectors. For every block and part a metric tree is built once by the anchors
hierarchy, from the middle out: about sqrt(n) anchors, each the farthest point of the widest anchor so far,
take over the points that are nearer to them (a point nearer to its owner than half the distance between
two anchors needs no test); anchors with many points are divided the same way; upwards, the two balls whose common
ball is the smallest are merged, until one is left. Each ball holds its centre, radius, point count and sum.

In a round every part's codebook goes to the tasks. A ball inherits its parent's candidate entries and drops
those that cannot own any of its points; when one entry is left, the ball is wholly owned and adds its cached
sum and count; at a leaf the points are compared with the remaining candidates. Distances are exact
integers; a candidate is dropped only beyond a margin over the rounding of the bound, so that the result,
ties to the lower index included, is that of comparing every part with every entry.

One written table of blocks (a row: about ``BLOCK`` raw vectors and their trees, so memory is bounded);
per round the tasks return one sum per part, entry and component, and the driver gets
parts * entries * part width numbers. Equal vectors, however many, are points of radius 0. Results do not depend
on how rows fall into blocks.

Rows are dropped when the vector is null, holds a null or non-finite component, or has another width
than the kept vector of the smallest id (an empty vector, or a width that the number of parts does not
divide, counts as no vector). Null ids and labels are kept (null ids never start a codebook). The starting
entries are the vectors of the ``entries`` smallest ids, equal ids in the order of their vectors; fewer rows make
fewer entries. An empty table gives no rows; further columns are not read. Integers beyond 2^24
in size are computed without bounds on their size; an error beyond a long raises.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.llm.common import fresh, written

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
BLOCK = 4096  # vectors of one block
LEAF = 96  # points of a ball that is not divided further
SAFE = 1 << 24  # integers up to this size are computed in 64 bits
SLACK = 1 + 1e-9


# ----------------------------------------------------------------------------- one block, inside a task

def to_int(values):
    """floor(SCALE * x) as 64-bit integers, or as Python integers where these could overflow."""
    import numpy as np

    scaled = np.floor(values.astype(np.float64) * SCALE) if values.size else values.astype(np.float64)
    if values.size == 0 or (np.isfinite(scaled).all() and np.abs(scaled).max() <= SAFE):
        return scaled.astype(np.int64)
    import math
    from fractions import Fraction

    exact = [math.floor(Fraction(float(x)) * SCALE) for x in values.ravel()]
    return np.array(exact, dtype=object).reshape(values.shape)


def squared(x):
    return (x * x).sum(axis=-1)


class Tree:
    """Balls over the rows of ``x``: ``order`` lists the rows, ball b holds ``order[begin[b]:end[b]]``;
    ``kids[b]`` is empty for a leaf. The root is the last ball."""

    def __init__(self, x, leaf: int = LEAF):
        self.x, self.leaf = x, leaf
        self.centre, self.radius2, self.count, self.sums, self.kids, self.rows = [], [], [], [], [], []
        import numpy as np

        root = self._divide(np.arange(len(x)))
        self.root = root

    # -- building
    def _ball(self, rows, kids) -> int:
        x = self.x[rows]
        total = x.sum(axis=0)
        centre = total // len(rows)
        self.centre.append(centre)
        self.radius2.append(squared(x - centre).max())
        self.count.append(len(rows))
        self.sums.append(total)
        self.kids.append(kids)
        self.rows.append(rows)
        return len(self.count) - 1

    def _divide(self, rows) -> int:
        """The ball of ``rows``: a leaf, or the top of a hierarchy over their anchors."""
        if len(rows) <= self.leaf:
            return self._ball(rows, [])
        groups = self._anchors(rows)
        if len(groups) == 1:  # equal points
            return self._ball(rows, [])
        return self._merge([self._divide(g) for g in groups])

    def _anchors(self, rows) -> list:
        """The rows by anchor: every row belongs to its nearest anchor (of equal ones the earlier)."""
        import numpy as np

        x = self.x[rows]
        d = squared(x - x[0])
        at, own = [x[0]], [np.argsort(-d, kind="stable")]  # rows of an anchor, farthest first
        far = [d[own[0]]]
        for _ in range(int(len(rows) ** 0.5)):
            widest = max(range(len(at)), key=lambda a: far[a][0] if len(far[a]) else -1)
            if not len(far[widest]) or far[widest][0] == 0:
                break
            new = x[own[widest][0]]
            between = squared(np.array(at) - new)
            taken, taken_d = [], []
            for a in range(len(at)):
                # rows nearer to their anchor than half way to the new one stay without a test
                if not len(far[a]) or 4 * far[a][0] <= between[a]:
                    continue
                tested = int(np.searchsorted(-far[a], -(between[a] // 4), side="left"))
                candidates = own[a][:tested]
                to_new = squared(x[candidates] - new)
                moved = to_new < far[a][:tested]
                if moved.any():
                    taken.append(candidates[moved])
                    taken_d.append(to_new[moved])
                    own[a] = np.concatenate([candidates[~moved], own[a][tested:]])
                    far[a] = np.concatenate([far[a][:tested][~moved], far[a][tested:]])
            ids, ds = np.concatenate(taken), np.concatenate(taken_d)
            by = np.argsort(-ds, kind="stable")
            at.append(new)
            own.append(ids[by])
            far.append(ds[by])
        return [rows[o] for o in own if len(o)]

    def _merge(self, balls: list) -> int:
        """Agglomeration: the pair with the smallest common ball first."""
        import numpy as np

        centre = np.array([self.centre[b] for b in balls], dtype=np.float64)
        radius = np.sqrt(np.array([self.radius2[b] for b in balls], dtype=np.float64))
        n = len(balls)
        cost = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(-1)) + radius[:, None] + radius[None]
        cost = np.maximum(cost / 2, np.maximum(radius[:, None], radius[None]))
        np.fill_diagonal(cost, np.inf)
        alive, ids = np.ones(n, bool), list(balls)
        for _ in range(n - 1):
            i, j = sorted(divmod(int(np.argmin(cost)), n))
            made = self._ball(np.concatenate([self.rows[ids[i]], self.rows[ids[j]]]), [ids[i], ids[j]])
            ids[i], alive[j] = made, False
            cost[j], cost[:, j] = np.inf, np.inf
            centre[i], radius[i] = self.centre[made].astype(np.float64), float(self.radius2[made]) ** 0.5
            row = np.sqrt(((centre - centre[i]) ** 2).sum(-1)) + radius + radius[i]
            row = np.where(alive, np.maximum(row / 2, np.maximum(radius, radius[i])), np.inf)
            row[i] = np.inf
            cost[i], cost[:, i] = row, row
        return ids[int(np.flatnonzero(alive)[0])]

    # -- a round
    def owned(self, codebook):
        """Pairs of (ball or rows, entry): balls wholly owned by one entry, and the rows of leaves by entry."""
        import numpy as np

        k = len(codebook)
        apart = np.sqrt(squared(codebook[:, None] - codebook[None]).astype(np.float64))
        todo = [(self.root, np.arange(k))]
        while todo:
            ball, candidates = todo.pop()
            if len(candidates) > 1:
                d = squared(codebook[candidates] - self.centre[ball])
                best = int(np.argmin(d))  # of equal ones the lower index
                reach = 2 * float(self.radius2[ball]) ** 0.5 * apart[candidates[best], candidates] * SLACK
                # over the ball, an entry stays at least this much farther away than the best one
                lead = (d - d[best]).astype(np.float64)
                keep = lead <= reach
                if self.radius2[ball] == 0:  # all points lie on the centre
                    keep[:] = False
                keep[best] = True
                candidates = candidates[keep]
            if len(candidates) == 1:
                yield ball, None, int(candidates[0])
            elif self.kids[ball]:
                todo += [(b, candidates) for b in self.kids[ball]]
            else:
                rows = self.rows[ball]
                d = squared(self.x[rows][:, None] - codebook[candidates][None])
                nearest = candidates[np.argmin(d, axis=1)]
                for entry in np.unique(nearest):
                    yield None, rows[nearest == entry], int(entry)

    def totals(self, codebook):
        """(sum, count) per entry over all rows."""
        import numpy as np

        sums = np.zeros(codebook.shape, dtype=self.x.dtype)
        counts = np.zeros(len(codebook), dtype=np.int64)
        for ball, rows, entry in self.owned(codebook):
            sums[entry] += self.sums[ball] if rows is None else self.x[rows].sum(axis=0)
            counts[entry] += self.count[ball] if rows is None else len(rows)
        return sums, counts

    def nearest(self, codebook):
        """The entry of every row."""
        import numpy as np

        out = np.zeros(len(self.x), dtype=np.int64)
        for ball, rows, entry in self.owned(codebook):
            out[self.rows[ball] if rows is None else rows] = entry
        return out

    # -- storage: the balls without the points (integers again from the raw vectors)
    def state(self):
        return self.root, self.centre, self.radius2, self.count, self.sums, self.kids, self.rows

    @classmethod
    def of(cls, x, state):
        tree = cls.__new__(cls)
        tree.x = x
        tree.root, tree.centre, tree.radius2, tree.count, tree.sums, tree.kids, tree.rows = state
        return tree


def compact(tree: Tree) -> tuple:
    """A tree's state with one order of the rows in place of a list per ball."""
    import numpy as np

    order, begin, end = [], {}, {}
    at, todo = 0, [(tree.root, False)]
    while todo:
        ball, done = todo.pop()
        if done:
            end[ball] = at
            continue
        begin[ball] = at
        todo.append((ball, True))
        if tree.kids[ball]:
            todo += [(b, False) for b in reversed(tree.kids[ball])]
        else:
            order.append(tree.rows[ball])
            at += len(tree.rows[ball])
    return (tree.root, np.array(tree.centre), np.array(tree.radius2), tree.count, np.array(tree.sums), tree.kids,
            np.concatenate(order).astype(np.uint16 if at <= 65536 else np.int64), [(begin[b], end[b]) for b in range(len(tree.count))])


def restored(x, state: tuple) -> Tree:
    root, centre, radius2, count, sums, kids, order, spans = state
    return Tree.of(x, (root, centre, radius2, count, sums, kids, [order[a:b] for a, b in spans]))


# ----------------------------------------------------------------------------- Spark

def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component; of a width that can be cut."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def blocks(rows: DataFrame, parts: int) -> DataFrame:
    """(n, ids, labels, vectors, trees) per block of (id, label, vector) rows, all as bytes."""

    def build(batches):
        import pickle

        import numpy as np
        import pyarrow as pa

        def block(ids, labels, raw):
            x = to_int(raw)
            step = x.shape[1] // parts
            trees = [compact(Tree(np.ascontiguousarray(x[:, p * step:(p + 1) * step]))) for p in range(parts)]
            held = [pa.array([pickle.dumps(v, protocol=5)], pa.binary()) for v in (ids, labels, raw, trees)]
            return pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int32()), *held], names=["n", "ids", "labels", "vectors", "trees"])

        ids, labels, raw, have = [], [], [], 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            for a in range(0, n, BLOCK):
                b = min(n, a + BLOCK)
                ids.append(batch.column(0).slice(a, b - a))
                labels.append(batch.column(1).slice(a, b - a))
                raw.append(values[a:b])
                have += b - a
                if have >= BLOCK:
                    yield block(pa.concat_arrays(ids), pa.concat_arrays(labels), np.concatenate(raw))
                    ids, labels, raw, have = [], [], [], 0
        if have:
            yield block(pa.concat_arrays(ids), pa.concat_arrays(labels), np.concatenate(raw))

    return rows.mapInArrow(build, "n int, ids binary, labels binary, vectors binary, trees binary")


def opened(batch, r: int, parts: int):
    """(vectors as integers by part, trees) of row ``r`` of a batch of blocks."""
    import pickle

    import numpy as np

    x = to_int(pickle.loads(batch.column("vectors")[r].as_py()))
    step = x.shape[1] // parts
    cut = [np.ascontiguousarray(x[:, p * step:(p + 1) * step]) for p in range(parts)]
    return cut, [restored(c, s) for c, s in zip(cut, pickle.loads(batch.column("trees")[r].as_py()))]


def round_totals(table: DataFrame, codebooks: list) -> dict:
    """One round over all blocks: (part, entry) -> [sums by position, count]."""
    parts = len(codebooks)

    def add(batches):
        import pyarrow as pa

        sums = counts = None
        for batch in batches:
            for r in range(batch.num_rows):
                found = [t.totals(c) for t, c in zip(opened(batch, r, parts)[1], codebooks)]
                sums = [s.astype(object) for s, _ in found] if sums is None else [a + s for a, (s, _) in zip(sums, found)]
                counts = [c for _, c in found] if counts is None else [a + c for a, (_, c) in zip(counts, found)]
        if sums is None:
            return
        flat = [(p, e, j, str(v), int(counts[p][e])) for p in range(parts) for e in range(len(codebooks[p])) if counts[p][e]
                for j, v in enumerate(sums[p][e])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*flat)], names=["part", "entry", "position", "total", "n"])

    schema = "part long, entry long, position long, total string, n long"
    summed = (table.select("vectors", "trees").mapInArrow(add, schema).groupBy("part", "entry", "position")
              .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    return {(r.part, r.entry, r.position): (int(r.total), r.n) for r in summed}


def train(rows: DataFrame, table: DataFrame, parts: int, entries: int, rounds: int) -> list:
    """The final codebooks: per part an integer array (entry, position)."""
    import numpy as np

    first = rows.where(F.col("id").isNotNull()).orderBy("id", "vector").limit(entries).collect()  # ``entries`` rows
    start = to_int(np.array([r.vector for r in first], dtype=np.float64))
    step = start.shape[1] // parts if len(first) else 0
    codebooks = [np.ascontiguousarray(start[:, p * step:(p + 1) * step]) for p in range(parts)]
    for _ in range(rounds):
        for (p, e, j), (total, n) in round_totals(table, codebooks).items():
            value = total // n  # Python's floor
            if abs(value) > SAFE and codebooks[p].dtype != object:
                codebooks[p] = codebooks[p].astype(object)
            codebooks[p][e, j] = value
    return codebooks


def coded(table: DataFrame, codebooks: list, id_type: T.DataType, label_type: T.DataType) -> DataFrame:
    """(id, label, code, error) of all rows under the final codebooks."""
    parts = len(codebooks)

    def assign(batches):
        import pickle

        import numpy as np
        import pyarrow as pa

        digits = np.array([f"{e:02x}" for e in range(len(codebooks[0]))], dtype=object)
        for batch in batches:
            for r in range(batch.num_rows):
                ids, labels = (pickle.loads(batch.column(c)[r].as_py()) for c in ("ids", "labels"))
                code, error = "", 0
                for x, tree, book in zip(*opened(batch, r, parts), codebooks):
                    near = tree.nearest(book)
                    code = code + digits[near]
                    error = error + squared(x - book[near])
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(list(code), pa.string()), pa.array([int(e) for e in error], pa.int64())],
                                                 names=["id", "label", "code", "error"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("label", label_type),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return table.select("ids", "labels", "vectors", "trees").mapInArrow(assign, schema)


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) per kept row."""
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).where(
        usable(F.col(vector_col)) & (F.size(vector_col) % parts == 0))
    id_type, label_type = kept.schema["id"].dataType, kept.schema["label"].dataType
    least = kept.orderBy(F.col("id").asc_nulls_last(), "vector").select(F.size("vector").alias("n")).first()
    if least is None:
        return spark.createDataFrame([], T.StructType([
            T.StructField(id_col, id_type), T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
            T.StructField("label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())]))
    kept = kept.where(F.size("vector") == least["n"])
    table = written(blocks(kept, parts), "vector-blocks")
    codebooks = train(kept, table, parts, entries, rounds)
    if not len(codebooks[0]):
        raise ValueError("no row with an id: the codebooks have no starting entries")
    sha = hashlib.sha256(",".join(str(int(v)) for book in codebooks for v in book.ravel()).encode()).hexdigest()
    codes = written(coded(table, codebooks, id_type, label_type), "vector-codes")
    per = written(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-labels")
    other = fresh("label")
    return (codes.join(per.withColumnRenamed("label", other), F.col("label").eqNullSafe(F.col(other)))
            .select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256")))
