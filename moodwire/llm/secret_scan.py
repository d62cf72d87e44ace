"""Secret scan with DataFrame functions only: fixed patterns, and a randomness battery for the rest.

Base spans come from three patterns. Further candidates are unbroken runs of 20 or more characters of
the usual encodings. For each, the encoding is inferred (hex, base32, base64) and its codes are put
to three tests:

* chi-squared uniformity over the encoding's alphabet, read both ways: the p-value is that of a
  string with a written language's uneven letters (a noncentral law whose offset grows with the
  length) looking this even; strings that are more even than chance allows (counters) are out;
* a runs test about the middle of the alphabet;
* lag-one serial correlation of the codes; candidates that fail either are out.

Runs without two kinds of characters (paths, snake_case or hyphenated words, long plain words) are not
put to the tests. A document's tested candidates alone are judged together by Benjamini and Hochberg's
step-up rule, with weights in proportion to length: short strings, where evenness proves little, need
smaller p-values. So what was never tested costs a secret beside it nothing.

Everything is row-local: one scan, no shuffle, no Python; a text's spans are built in blocks, so many
matches in one text do not cost their square. Null texts count as empty and have no spans; repeated
rows give repeated rows; an empty table gives no rows. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwire.llm.common import fresh, text_or_empty

# The contract's patterns, kinds in their order, and least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 or more characters
HEX = r"[0-9a-f]{24,}"  # [0-9a-f]+ of 24 or more characters
LEAST_VALUE = 6

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"  # right after "=", too: settings and addresses; padding ends a run
RATE = 0.05  # false-discovery rate
REJECT = 2.576  # two-sided 1 % point of the runs and serial tests
TOO_EVEN = -3.09  # 0.1 % point of the chi-squared test's lower side
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HEXES = "0123456789abcdef"
UNEVEN = {"hex": 0.5, "base32": 0.9, "base64": 0.9}  # least offset per character of text-like strings
BLOCK = 256
SPAN = "array<struct<start:bigint,kind_order:int,end:bigint,kind:string>>"
PLACE = "array<struct<start:bigint,end:bigint>>"


def _bound(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _walk(steps: Column, offset: Column) -> Column:
    """Places of consecutive (gap, size) steps from an offset on."""
    start = F.struct(offset.alias("at"), F.expr(f"cast(array() as {PLACE})").alias("out"))

    def add(acc, x):
        at = acc["at"] + x["gap"]
        return F.struct((at + x["size"]).alias("at"),
                        F.concat(acc["out"], F.array(F.struct(at.alias("start"), (at + x["size"]).alias("end")))).alias("out"))

    return F.aggregate(steps, start, add)["out"]


def _places(text: Column, pattern: str) -> Column:
    """Start and end of every leftmost match: lengths of what lies between and of the matches, summed
    up block by block."""
    zero = F.lit(0).cast("bigint")
    steps = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(F.length(gap).cast("bigint").alias("gap"),
                                    F.coalesce(F.length(match), F.lit(0)).cast("bigint").alias("size")))

    def blocks(s):
        return F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(s) - 2) / BLOCK).cast("int")),
                           lambda b: F.slice(F.slice(s, F.lit(1), F.size(s) - 1), b * BLOCK + 1, F.lit(BLOCK)))

    def joined(bs):
        sums = F.transform(bs, lambda b: F.aggregate(b, zero, lambda a, x: a + x["gap"] + x["size"]))
        offsets = F.aggregate(sums, F.array(zero), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.flatten(F.zip_with(bs, F.slice(offsets, F.lit(1), F.size(bs)), _walk))

    # a step per match and one for the tail, which has no match
    return F.when(text.rlike(pattern), _bound(steps, lambda s: _bound(blocks(s), joined))).otherwise(
        F.expr(f"cast(array() as {PLACE})"))


def _spans(places: Column, kind: str, order: int) -> Column:
    return F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(order).alias("kind_order"),
                                                  p["end"].alias("end"), F.lit(kind).alias("kind")))


def base_spans(text: Column) -> Column:
    """Array of (start, kind_order, end, kind), by start, then kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.zip_with(_places(text, ASSIGN), F.when(text.rlike(ASSIGN), values).otherwise(F.array().cast("array<string>")),
                        lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.length(v).alias("n")))
    return F.sort_array(F.concat(
        _spans(F.filter(assign, lambda p: p["n"] >= LEAST_VALUE), "assign", 0),
        _spans(_places(text, ACCESS), "access", 1), _spans(_places(text, HEX), "hex", 2)))


def normal_cdf(z: Column) -> Column:
    """A logistic form of the normal distribution, right to 2e-4."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def _battery(alphabet: str, uneven: float):
    """p-value (1 where a test of randomness fails) of a string over an alphabet."""
    size = float(len(alphabet))

    def p_value(codes):
        n = F.size(codes).cast("double")
        squares = F.aggregate(F.transform(F.array_distinct(codes), lambda c: F.pow(F.size(F.filter(codes, lambda d: d == c)).cast("double"), F.lit(2.0))),
                              F.lit(0.0), lambda a, x: a + x)
        chi = squares * size / n - n
        fair = (chi - (size - 1)) / F.sqrt(F.lit(2 * (size - 1)))
        text_like = (chi - (size - 1) - n * uneven) / F.sqrt(2 * (size - 1) + 4 * n * uneven)
        pairs = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                           lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        half = size / 2 - 0.5
        high = F.size(F.filter(codes, lambda c: c > half)).cast("double")
        runs = 1.0 + F.size(F.filter(pairs, lambda x: (x["a"] > half) != (x["b"] > half)))
        both = 2 * high * (n - high)
        mean_runs = both / n + 1
        sd_runs = F.sqrt(F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(1e-9)))
        variance = (size * size - 1) / 12
        serial = F.aggregate(F.transform(pairs, lambda x: (x["a"] - half) * (x["b"] - half)), F.lit(0.0), lambda a, x: a + x) / variance / F.sqrt(n)
        even = (fair > TOO_EVEN) & (F.abs((runs - mean_runs) / sd_runs) < REJECT) & (F.abs(serial) < REJECT)
        return F.when(even, normal_cdf(text_like)).otherwise(F.lit(1.0))

    return lambda word: _bound(F.transform(F.split(word, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double")), p_value)


def _mixed(w: Column) -> Column:
    return w.rlike("[0-9]") & w.rlike("[A-Za-z]") | w.rlike("[a-z]") & w.rlike("[A-Z]")


def random_spans(text: Column, base: Column) -> Column:
    """Spans the battery finds, none of which overlaps a base span."""
    found = F.zip_with(_places(text, CANDIDATE),
                       F.when(text.rlike(CANDIDATE), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
                       .otherwise(F.array().cast("array<string>")),
                       lambda p, w: F.struct(p["start"].alias("start"), p["end"].alias("end"), w.alias("word")))

    def judged(x):
        w = x["word"]
        plain, b64 = F.lower(F.replace(w, F.lit("-"), F.lit(""))), F.translate(w, "-_", "+/")
        p = (F.when(w.rlike("^([0-9a-f-]+|[0-9A-F-]+)$"), _bound(plain, _battery(HEXES, UNEVEN["hex"])))
             .when(w.rlike("^[A-Z2-7]+$"), _bound(w, _battery(BASE32, UNEVEN["base32"])))
             .otherwise(_bound(b64, _battery(BASE64, UNEVEN["base64"]))))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), p.alias("p"), F.length(w).cast("double").alias("n"))

    def discovered(xs):
        mean = F.aggregate(xs, F.lit(0.0), lambda a, x: a + x["n"]) / F.size(xs)
        weighted = _bound(mean, lambda m: F.transform(xs, lambda x: F.struct(
            (x["p"] * m / x["n"]).alias("p"), x["start"].alias("start"), x["end"].alias("end"))))

        def step_up(ws):
            passed = F.transform(F.sort_array(ws), lambda x, k: F.when(x["p"] <= RATE * (k + 1) / F.size(ws), x["p"]))
            return _bound(F.array_max(passed), lambda limit: F.filter(ws, lambda x: x["p"] <= F.coalesce(limit, F.lit(-1.0))))

        return _bound(weighted, step_up)

    free = F.filter(found, lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])))
    tested = F.filter(free, lambda x: _mixed(x["word"]))
    kept = _bound(F.transform(tested, judged), lambda xs: F.when(F.size(xs) > 0, discovered(xs)))
    return F.coalesce(_spans(kept, "random", 3), F.expr(f"cast(array() as {SPAN})"))


def secret_spans(docs: DataFrame, text_col: str = "text", base_col: str = "base_spans", spans_col: str = "spans") -> DataFrame:
    """``docs`` with two arrays of (start, kind_order, end, kind): the base spans, and all spans."""
    t = fresh("t")
    with_base = docs.withColumn(t, text_or_empty(text_col)).withColumn(base_col, base_spans(F.col(t)))
    more = with_base.withColumn(spans_col, F.sort_array(F.concat(F.col(base_col), random_spans(F.col(t), F.col(base_col)))))
    return more.drop(t)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (overlapping ones together) replaced by a mark."""
    out = f"cast(array() as {PLACE})"

    def merge(acc, x):
        last = F.element_at(acc, -1)
        one = F.array(F.struct(x["start"].alias("start"), x["end"].alias("end")))
        joined = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end")))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > x["start"]),
                      F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), joined)).otherwise(F.concat(acc, one))

    def cut(ms):
        before = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.element_at(ms, F.greatest(k, F.lit(1)))["end"]).cast("int")
        parts = F.transform(ms, lambda m, k: F.concat(
            F.substring(text, before(k) + 1, m["start"].cast("int") - before(k)), F.lit(mark)))
        end = F.element_at(ms, -1)["end"].cast("int")
        return F.concat(F.array_join(parts, ""), F.substring(text, end + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(_bound(F.aggregate(spans, F.expr(out), merge), cut))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the secrets of its texts replaced; all columns and rows stay."""
    base, spans = fresh("base"), fresh("spans")
    found = secret_spans(docs, text_col, base, spans)
    return found.withColumn(text_col, F.when(F.size(spans) > 0, redacted(F.col(text_col), F.col(spans)))
                            .otherwise(F.col(text_col))).select(*docs.columns)


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans), one row per row of ``docs``."""
    found = secret_spans(docs.select(id_col, text_col), text_col, "b", "a")
    count = lambda k: F.size(F.filter("b", lambda x: x["kind_order"] == k)).cast("bigint")
    return found.select(id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(listed(F.col("b")), 256).alias("base_sha256"), listed(F.col("a")).alias("spans"))
