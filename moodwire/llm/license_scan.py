"""License scan by ordered signature rules.

Hundreds of regular expressions over the words of a text (``license_rules``). A keyword automaton
reads each text once and says which rules can match at all; most texts hold no keyword and try none. Where
a keyword occurs, its rules run over the whole text. Overlapping detections are resolved by rank
(priority, then length, then the order of the rules): a detection that lies within the interval of a higher one is
suppressed. One pass over the detections in rank order against the outline of those kept does that in
n log n, however many a text holds. Detections of the base phrases always stay.

Row-local: no shuffle; memory is one Arrow batch plus the words of one text.

Nulls and empty texts give no words, no detections, empty labels and score 0; repeated rows give
repeated rows; an empty table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

import bisect
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.llm import license_rules, tokens

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # fixed value: the contract's words
UPPER = {c: c + 32 for c in range(65, 91)}


def suppressed(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of (start, end, rule, priority) those that no higher ranked one contains, in text order."""
    ranked = sorted(found, key=lambda f: (-f[3], f[0] - f[1], f[2], f[0]))
    starts, ends, kept = [], [], []  # the outline: starts and ends both ascending
    for f in ranked:
        at = bisect.bisect_right(starts, f[0])
        if at and ends[at - 1] >= f[1]:
            continue
        kept.append(f)
        low = bisect.bisect_left(starts, f[0])
        high = bisect.bisect_right(ends, f[1], lo=low)  # those inside the new one leave the outline
        starts[low:high], ends[low:high] = [f[0]], [f[1]]
    return sorted(kept)


class Scanner:
    def __init__(self):
        import ahocorasick

        self.rules = license_rules.rules()
        self.patterns: dict[int, re.Pattern] = {}
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            by_keyword.setdefault(r.keyword, []).append(i)
        self.keywords = ahocorasick.Automaton()
        for word, ids in by_keyword.items():
            self.keywords.add_word(word, (word, ids))
        self.keywords.make_automaton()

    def detections(self, line: str) -> list[tuple[int, int, int]]:
        """(start, end, rule) in characters of the joined words, all matches of all rules, base rules first."""
        ready = sorted({i for _, ids in {v[0]: v for _, v in self.keywords.iter(line)}.values() for i in ids})
        out = []
        for i in ready:
            pattern = self.patterns.get(i)
            if pattern is None:
                pattern = self.patterns[i] = license_rules.compiled(self.rules[i])
            out += [(m.start(), m.end(), i) for m in pattern.finditer(line)]
        return out

    def scan(self, text: str) -> tuple:
        """(n_words, base places as (first word, rule), kept detections as (first word, word after, rule))."""
        words = WORD.findall(text.translate(UPPER))
        line = f" {' '.join(words)} "
        found = self.detections(line)
        if not found:
            return len(words), [], []
        starts, at = [], 1
        for w in words:
            starts.append(at)
            at += len(w) + 1
        spans = [(bisect.bisect_left(starts, a), bisect.bisect_left(starts, b), i) for a, b, i in found]
        base = [(a, i) for a, _, i in spans if self.rules[i].base]
        kept = suppressed([(a, b, i, self.rules[i].priority) for a, b, i in spans])
        return len(words), base, [(a, b, i) for a, b, i, _ in kept]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, base array<struct<first_word, label>>, found array<struct<first_word, n_words, label, priority>>,
    score) per row; the score is the highest priority found, over 100."""

    def run(batches):
        import pyarrow as pa

        scanner = tokens.worker_state("license-scanner", Scanner)
        rules = scanner.rules
        base_type = pa.list_(pa.struct([("first_word", pa.int64()), ("label", pa.string())]))
        found_type = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()),
                                         ("priority", pa.int32())]))
        for batch in batches:
            n, bases, founds, scores = [], [], [], []
            for value in batch.column(1):
                count, base, kept = scanner.scan(value.as_py() or "")
                n.append(count)
                bases.append([{"first_word": a, "label": rules[i].label} for a, i in base])
                founds.append([{"first_word": a, "n_words": b - a, "label": rules[i].label, "priority": rules[i].priority}
                               for a, b, i in kept])
                scores.append(max([f["priority"] for f in founds[-1]], default=0) / 100)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(bases, base_type), pa.array(founds, found_type),
                 pa.array(scores, pa.float64())], names=[id_col, "n_words", "base", "found", "score"])

    rows = docs.select(id_col, text_col)
    place = "array<struct<first_word: bigint, label: string>>"
    span = "array<struct<first_word: bigint, n_words: bigint, label: string, priority: int>>"
    schema = T.StructType([rows.schema[id_col], *T._parse_datatype_string(
        f"n_words bigint, base {place}, found {span}, score double").fields])
    return rows.mapInArrow(run, schema)


def license_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    scanned = license_scan(docs, id_col, text_col)
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base = F.col("base.label")
    return scanned.select(id_col, "n_words", F.size("base").cast("long").alias("n_base"),
                          F.array_min("base.first_word").alias("first_word"), F.array_max("base.first_word").alias("last_word"),
                          names(base).alias("base_labels"), names(F.concat(base, F.col("found.label"))).alias("labels"), "score")
