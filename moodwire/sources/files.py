"""File sources and sinks: the labelled CSV corpus and the token dump.

The CSV follows the six-column layout of the public Sentiment140 files:
polarity, id, date, query, user, text; polarity "0" negative, "2" neutral,
"4" positive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.operators import corpus
from moodwire.sources import quoted

CSV_SCHEMA = "polarity string, id long, date string, query string, user string, text string"


def escape_lines(text: Column) -> Column:
    """Backslashes, line feeds and carriage returns as two characters: one text, one line."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_lines(text: Column) -> Column:
    """``escape_lines`` undone, from left to right: escaped backslashes first cut the text into pieces, so
    none of them can be taken for the start of another escape; no character serves as a mark."""
    pieces = F.split(text, r"\\\\")
    plain = F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


def write_sentiment_csv(tweets: DataFrame, path: str, escape: bool = False) -> str:
    """Write a status table as a quoted six-column CSV corpus. Texts stand as they are, line feeds inside
    their quotes; with ``escape`` a text is one line (``escape_lines``), for readers that need that."""
    held = escape_lines(F.col("text")) if escape else F.col("text")
    out = tweets.select(corpus.polarity_code(F.col("text")).alias("polarity"), F.col("tweet_id").alias("id"),
                        F.date_format("ts", "EEE MMM dd HH:mm:ss 'UTC' yyyy").alias("date"),
                        F.lit("NO_QUERY").alias("query"), F.concat(F.lit("user"), F.col("tweet_id")).alias("user"),
                        held.alias("text"))
    out.write.mode("overwrite").option("quoteAll", True).option("escape", '"').csv(path)
    return path


def read_sentiment_csv(spark: SparkSession, path: str, naive: bool = False, escaped: bool = False,
                       quoted_lines: bool = True) -> DataFrame:
    """(text, label) of a labelled CSV corpus; rows whose polarity is not 0 or 4 are dropped.

    Texts are taken as they stand, and line feeds inside quotes are part of them; large files are read by
    many tasks all the same (``quoted.read_quoted_csv``). ``quoted_lines=False`` saves its two further scans
    for files that hold a line per record; ``escaped=True`` undoes ``escape_lines`` (files of our own writer).
    ``naive=True`` reproduces a plain comma split (quotes kept, text cut at its first comma) for comparison.
    """
    if naive:
        parts = F.transform(F.split(F.col("value"), ","), lambda x: F.trim(x))
        raw = spark.read.text(path).select(F.element_at(parts, 1).alias("code"),
                                           F.element_at(parts, 6).alias("text"))
        return (raw.select("text", F.when(F.col("code") == '"0"', 0.0).when(F.col("code") == '"4"', 1.0).alias("label"))
                .filter(F.col("label").isNotNull()))
    if quoted_lines:
        df = quoted.read_quoted_csv(spark, path, CSV_SCHEMA)
    else:
        df = spark.read.schema(CSV_SCHEMA).option("escape", '"').option("mode", "PERMISSIVE").csv(path)
    if escaped:
        df = df.withColumn("text", unescape_lines(F.col("text")))
    return corpus.label_recode(df).select("text", "label")


def dump_corpus(tokenized: DataFrame, path: str) -> str:
    """Write (tokens, label) as parquet, for offline exploration."""
    tokenized.select("tokens", "label").write.mode("overwrite").parquet(path)
    return path


def small_to_pandas(df: DataFrame, max_rows: int = 100_000):
    """``toPandas`` for results that are small by construction (aggregates, metrics).

    Counts first and refuses a frame above ``max_rows``: corpora stay distributed.
    """
    n = df.count()
    if n > max_rows:
        raise ValueError(f"{n} rows is more than max_rows={max_rows}; aggregate before collecting")
    return df.toPandas()
