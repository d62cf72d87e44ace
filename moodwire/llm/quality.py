"""Quality rules with DataFrame operators only: base counts, then robust multivariate outliers.

Base counts are row-local. The verdict on the rest is a minimum-covariance-determinant estimate per
(language, source): the mean and covariance of the ``COVER`` share of a group's texts with the smallest
determinant, reached by concentration steps (estimate from the subset, distances of all rows, the
nearest rows are the next subset) from coordinate-wise medians. A group whose determinant no longer
falls is settled and leaves the steps; they go on until every group is. That ends, because each step
lowers the determinant of all groups still in it by a least factor, and the floors bound it below.
A text is rejected when its Mahalanobis distance to its group's estimate is beyond ``CUTOFF``, the
chi-squared quantile that a clean text of normal statistics passes with probability ``TAIL``.

Where the data goes: texts are read once, per-row statistics (four integers) are written, and each
step is one pre-aggregated group-by over them and one join with the estimates, a table with a row per
group that Spark broadcasts only if its written size allows. Medians and the subset's radius come from
counts per (group, bin), never from the rows of a group, so a source with a third of all rows adds no
long task. Statistics are integers, so the sums do not depend on how rows are dealt out.

Null texts have no words (base_failed); null language or source is a group of its own; groups with
fewer than ``LEAST`` rows take their language's estimate, and languages with fewer the estimate over
all languages. Only a table with fewer than ``LEAST`` rows that pass the base rules has no estimate at
all: its rows keep the base verdict. Repeated rows are counted and returned each; an empty table gives
no rows.
"""

from __future__ import annotations

import functools
import logging
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwire.llm.common import SPACE, fresh, text_or_empty, written

SYMBOLS = "#*$%&|<>"  # fixed value: the contract's symbols
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent
COVER = 0.75
LEAST = 100  # rows of a group for an estimate of its own
UNIT = 1_000  # a transformed statistic of 1.0 as an integer
TAIL = 1e-9  # clean texts rejected, if statistics are normal: about one in a corpus of a billion


def chi_squared_quantile(tail: float) -> float:
    """x with P(X > x) = tail for four degrees of freedom, where P(X > x) = exp(-x / 2) (1 + x / 2)."""
    x = 0.0
    for _ in range(100):
        x = 2 * (math.log1p(x / 2) - math.log(tail))
    return x


CUTOFF = chi_squared_quantile(TAIL)  # squared distance, about 47.9
STEPS = 20  # concentration steps after which, and after each such number more, groups not settled are logged
DIMS = ("x1", "x2", "x3", "x4")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda's argument is not expanded in place."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the same text.

    The windows, each followed by its position, are sorted; equal windows become neighbours. The
    positions of windows with an equal neighbour are sorted again, and each covers what the next one
    leaves uncovered of its three words.
    """
    gap = "\t"  # in no word, so everything that sorts between two equal windows is equal to them

    def window(w):
        return lambda i: F.concat(F.element_at(w, i), F.lit(" "), F.element_at(w, i + 1), F.lit(" "), F.element_at(w, i + 2))

    def positions(tagged):
        keys = F.transform(tagged, lambda s: F.substring_index(s, gap, 1))
        return _bound(keys, lambda k: F.filter(
            F.transform(tagged, lambda s, j: F.when(
                ((j > 0) & (F.get(k, j - 1) == F.get(k, j))) | (F.get(k, j + 1) == F.get(k, j)),
                F.substring_index(s, gap, -1).cast("int"))), lambda p: p.isNotNull()))

    def covered(p):
        return F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
            F.lit(0).cast("bigint"), lambda a, b: a + b)

    def count(w):
        starts = F.sequence(F.lit(1), F.size(w) - 2)
        made = F.transform(starts, window(w))
        return _bound(made, lambda m: F.when(F.size(F.array_distinct(m)) == F.size(m), F.lit(0).cast("bigint")).otherwise(
            _bound(F.sort_array(F.transform(m, lambda s, i: F.concat(s, F.lit(gap), i.cast("string")))),
                   lambda t: _bound(F.sort_array(positions(t)), covered))))

    return _bound(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("bigint")).otherwise(count(w)))


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = fresh("t")
    words = F.filter(F.split(F.col(t), SPACE), lambda w: w != "")
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    rest = [c for c in docs.columns if c != text_col]
    d = docs.select(*rest, text_or_empty(text_col).alias(t))
    return d.select(
        *rest,
        _bound(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n"),
                                         F.aggregate(w, F.lit(0).cast("bigint"), lambda a, b: a + F.length(b)).alias("chars"),
                                         repeated_words(w).alias("repeats"))).alias("w"),
        (F.length(t) - F.length(F.translate(F.col(t), SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
    ).select(*rest, F.col("w.n").alias("n_words"), F.col("w.chars").alias("word_chars"), "n_symbols", "n_dup_lines",
             F.col("w.repeats").alias("n_repeat_words"))


# --------------------------------------------------------------------------- robust outliers

# Least standard deviations, by statistic: differences below them mean nothing. x4 ends at 0.5 in rows that
# pass the base rules, so its floor leaves room for ten of them.
FLOORS = {"x1": 0.1, "x2": 0.1, "x3": 0.25, "x4": 0.05}
CONSISTENT = 1.485  # covariance of the central 75 % of a four-dimensional normal, to the whole
BINS = 16  # distance bins per e-fold


def with_statistics(counted: DataFrame) -> DataFrame:
    """base_failed, the transformed statistics as integers, and the group keys."""
    n = F.greatest("n_words", F.lit(1))
    chars = F.greatest("word_chars", F.lit(1))
    values = {
        "x1": F.log(chars / n),  # mean word length
        "x2": F.log1p(100 * F.col("n_symbols") / chars),
        "x3": F.log1p(100 * F.col("n_dup_lines") / n),
        "x4": F.col("n_repeat_words") / n,
    }
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumns({"base_failed": failed} | {k: F.round(v * UNIT).cast("bigint") for k, v in values.items()})


def _key(col: str | None) -> Column:
    return F.lit("") if col is None else F.coalesce(F.concat(F.lit("="), F.col(col)), F.lit("null"))


def _at_share(counts: DataFrame, by: list[str], value: str, share: float) -> DataFrame:
    """Per group of ``by``: the first value at which the running count reaches the share."""
    w = Window.partitionBy(*by)
    run = F.sum("c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    marked = counts.withColumn("run", run).withColumn("all", F.sum("c").over(w))
    return marked.where(F.col("run") >= share * F.col("all")).groupBy(*by).agg(F.min(value).alias(value))


def _inverse_root(frame: DataFrame) -> DataFrame:
    """Columns r_ij of the inverse Cholesky factor and logdet, from covariance columns v_ij (i >= j)."""
    d = range(len(DIMS))
    for i in d:
        for j in range(i + 1):
            rest = F.col(f"v{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            frame = frame.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    for i in d:
        frame = frame.withColumn(f"r{i}{i}", 1 / F.col(f"l{i}{i}"))
        for j in range(i):
            s = sum((F.col(f"l{i}{k}") * F.col(f"r{k}{j}") for k in range(j, i)), F.lit(0.0))
            frame = frame.withColumn(f"r{i}{j}", -s / F.col(f"l{i}{i}"))
    logdet = sum((2 * F.log(f"l{i}{i}") for i in d), F.lit(0.0))
    return frame.withColumn("logdet", logdet).select(
        "gl", "gs", "n", "logdet", *[f"m{i}" for i in d], *[f"r{i}{j}" for i in d for j in range(i + 1)])


def _distance(prefix: str = "") -> Column:
    """Squared Mahalanobis distance of x1.. to the joined estimate."""
    c = lambda name: F.col(prefix + name)
    parts = [sum(((F.col(DIMS[j]) / UNIT - c(f"m{j}")) * c(f"r{i}{j}") for j in range(i + 1)), F.lit(0.0))
             for i in range(len(DIMS))]
    return sum((p * p for p in parts), F.lit(0.0))


def robust_estimates(stats: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Per (gl, gs): mean m_i and inverse root r_ij of the minimum-determinant subset; gs is empty for
    a whole language, both are for all languages. Only rows that pass the base rules are estimated from."""
    d = range(len(DIMS))
    rows = stats.where(~F.col("base_failed")).select(_key(lang_col).alias("gl"), _key(source_col).alias("own"), *DIMS)
    levels = [F.struct(F.col(a).alias("gl") if a else F.lit("").alias("gl"), F.col(b).alias("gs") if b else F.lit("").alias("gs"))
              for a, b in (("gl", "own"), ("gl", ""), ("", ""))]
    rows = written(rows.select(F.explode(F.array_distinct(F.array(*levels))).alias("g"), *DIMS).select("g.*", *DIMS), "mcd-rows")
    sizes = rows.groupBy("gl", "gs").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST)

    values = rows.select("gl", "gs", F.explode(F.array(*[F.struct(F.lit(k).alias("dim"), F.col(x).alias("x"))
                                                         for k, x in enumerate(DIMS)])).alias("s"))
    counts = written(values.groupBy("gl", "gs", "s.dim", "s.x").agg(F.count(F.lit(1)).alias("c")), "mcd-values")
    by = ["gl", "gs", "dim"]
    mid = _at_share(counts, by, "x", 0.5)
    spread = (_at_share(counts, by, "x", 0.75).withColumnRenamed("x", "hi")
              .join(_at_share(counts, by, "x", 0.25).withColumnRenamed("x", "lo"), by))
    start = mid.join(spread, by).groupBy("gl", "gs").agg(
        *[F.max(F.when(F.col("dim") == k, F.col("x") / UNIT)).alias(f"m{k}") for k in d],
        *[F.max(F.when(F.col("dim") == k, (F.col("hi") - F.col("lo")) / UNIT / 1.349)).alias(f"s{k}") for k in d])
    diagonal = {f"v{i}{j}": F.pow(f"s{i}", F.lit(2)) + FLOORS[DIMS[i]] ** 2 if i == j else F.lit(0.0) for i in d for j in range(i + 1)}
    estimate = written(_inverse_root(start.join(sizes, ["gl", "gs"]).withColumns(diagonal)), "mcd-0")

    settled, step = [], 0
    while True:
        step += 1
        near = rows.join(estimate, ["gl", "gs"]).withColumn("bin", F.floor(BINS * F.log1p(_distance())).cast("int"))
        sums = {"c": F.count(F.lit(1))} | {f"a{i}": F.sum(F.col(DIMS[i])) for i in d} | {
            f"b{i}{j}": F.sum((F.col(DIMS[i]) * F.col(DIMS[j])).cast("double")) for i in d for j in range(i + 1)}
        bins = near.groupBy("gl", "gs", "n", "bin").agg(*[v.alias(k) for k, v in sums.items()])
        below = Window.partitionBy("gl", "gs").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        running = bins.select("gl", "gs", "n", "bin", *[F.sum(k).over(below).alias(k) for k in sums])
        reach = running.where(F.col("c") >= COVER * F.col("n"))
        first = reach.groupBy("gl", "gs", "n").agg(F.min_by(F.struct(*sums), "bin").alias("s")).select("gl", "gs", "n", "s.*")
        moments = first.withColumns({f"m{i}": F.col(f"a{i}") / F.col("c") / UNIT for i in d})
        moments = moments.withColumns({
            f"v{i}{j}": CONSISTENT * F.greatest(F.col(f"b{i}{j}") / F.col("c") / UNIT**2 - F.col(f"m{i}") ** 2, F.lit(0.0)) + FLOORS[DIMS[i]] ** 2
            if i == j else CONSISTENT * (F.col(f"b{i}{j}") / F.col("c") / UNIT**2 - F.col(f"m{i}") * F.col(f"m{j}"))
            for i in d for j in range(i + 1)})
        before = estimate.select("gl", "gs", F.col("logdet").alias("last"))
        nxt = written(_inverse_root(moments).join(before, ["gl", "gs"]), f"mcd-{step}")
        # the start is no subset's estimate, so the first step settles none
        falls = F.lit(step == 1) | (F.col("logdet") < F.col("last") - 1e-3)
        estimate = nxt.where(falls).drop("last")
        moving = estimate.count() if step % STEPS == 0 else estimate.limit(1).count()
        if step > 1:
            settled.append(nxt.where(~falls).drop("last"))
        if not moving:
            break
        if step % STEPS == 0:
            logging.getLogger(__name__).warning("%d groups not settled after %d steps", moving, step)
    return written(functools.reduce(DataFrame.unionByName, settled, estimate), "mcd")


def with_verdict(stats: DataFrame, estimates: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """``stats`` with distance (null without an estimate) and kept."""
    gl, gs = fresh("gl"), fresh("gs")
    cols = [c for c in estimates.columns if c not in ("gl", "gs")]
    out, found = stats.withColumns({gl: _key(lang_col), gs: _key(source_col)}), []
    # by group, by language, and the one row for all: a join on the level's own keys
    for on, level in (((gl, gs), "gs != ''"), ((gl,), "gl != '' and gs = ''"), ((), "gl = '' and gs = ''")):
        name = fresh("e")
        e = estimates.where(level).select(
            F.col("gl").alias(f"{name}_gl"), F.col("gs").alias(f"{name}_gs"), *[F.col(c).alias(f"{name}{c}") for c in cols])
        same = [F.col(c) == F.col(name + end) for c, end in zip(on, ("_gl", "_gs"))]
        out = out.join(F.broadcast(e) if not on else e, same or F.lit(True), "left")
        found.append(_distance(name))
    out = out.withColumn("distance", F.coalesce(*found))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return out.withColumn("kept", kept).select(*stats.columns, "distance", "kept")


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source") -> DataFrame:
    """(id, base counts, base_failed, distance, kept), one row per row of ``docs``."""
    light = docs.select(F.col(id_col), F.col(text_col), F.col(lang_col), F.col(source_col))
    stats = written(with_statistics(base_counts(light, text_col)), "quality")
    judged = with_verdict(stats, robust_estimates(stats, lang_col, source_col), lang_col, source_col)
    return judged.select(id_col, *BASE, "base_failed", "distance", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged. Texts stay where they are: statistics are
    row-local, and only the estimates are joined in."""
    whole, t, g, s = fresh("row"), "text", "lang", "source"
    rows = docs.select(F.struct(*docs.columns).alias(whole), F.col(text_col).alias(t), F.col(lang_col).alias(g),
                       F.col(source_col).alias(s))
    counted = with_statistics(base_counts(rows, t))
    estimates = robust_estimates(written(counted.drop(whole), "quality"), g, s)
    return with_verdict(counted, estimates, g, s).where("kept").select(f"{whole}.*")
