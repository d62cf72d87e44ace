"""File sources: the quote-aware CSV reader against the naive comma split; the size-checked collect."""

import pytest
from pyspark.sql import functions as F

from moodwire.session import work_path
from moodwire.sources import files, quoted, tables


def test_csv_round_trip_and_naive_mode(spark, small_dir):
    tw = tables.tweets(spark, small_dir)
    path = files.write_sentiment_csv(tw, work_path(spark, "t-csv"))
    exact = files.read_sentiment_csv(spark, path)
    labelled_rows = tw.filter(F.col("text").contains(":)") | F.col("text").contains(":(")
                              | F.col("text").contains(":-)") | F.col("text").contains(";)")
                              | F.col("text").contains(";-)") | F.col("text").contains(":-(")).count()
    assert exact.count() == labelled_rows
    assert exact.join(tw.select("text"), "text").count() == labelled_rows  # whole texts survive quoting
    naive = files.read_sentiment_csv(spark, files.write_sentiment_csv(tw, work_path(spark, "t-csv"), escape=True), naive=True)
    # the naive split keeps quotes and cuts each text at its first comma
    assert naive.filter(F.col("text").startswith('"')).count() > 0


def test_csv_naive_split_gives_code_and_cut_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"4","1","d","q","u","fine, thanks"\n"2","2","d","q","u","neither"\n"0","3","d","q","u","bad"\n')
    got = {(r.text, r.label) for r in files.read_sentiment_csv(spark, str(tmp_path), naive=True).collect()}
    assert got == {('"fine', 1.0), ('"bad"', 0.0)}
    exact = {(r.text, r.label) for r in files.read_sentiment_csv(spark, str(tmp_path)).collect()}
    assert exact == {("fine, thanks", 1.0), ("bad", 0.0)}


def test_escaped_lines_round_trip(spark):
    texts = ["a\nb", "a\\nb", "\\", "\\\\n", "\r\n", "plain", "", "\\r\\\n", "nul\0\\\0n", "\\\\\\n\n\\"]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    lines = d.select("text", files.escape_lines(F.col("text")).alias("e")).collect()
    assert all("\n" not in r.e and "\r" not in r.e for r in lines)
    back = d.select("text", files.unescape_lines(files.escape_lines(F.col("text"))).alias("b")).collect()
    assert all(r.text == r.b for r in back)


def test_texts_are_taken_as_they_stand(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"4","1","d","q","u","C:\\new\\runs"\n"0","2","d","q","u","two\nlines, ""quoted"""\n')
    got = {(r.text, r.label) for r in files.read_sentiment_csv(spark, str(tmp_path)).collect()}
    assert got == {("C:\\new\\runs", 1.0), ('two\nlines, "quoted"', 0.0)}


# ----------------------------------------------------------------------------- line feeds in quotes, many splits

WIDE = "a string, b string, c int"


def csv_text(rnd, n, end="\n"):
    quoted = lambda v: '"' + v.replace('"', '""') + '"'
    pieces = ["x", "\n", '"', ",", "\n\n", "\r\n", "wörter ", "long " * 30, " ", '"",\n"']
    rows = []
    for k in range(n):
        text = "".join(rnd.choices(pieces, k=rnd.randint(0, 12)))
        rows.append(f"{quoted(text)},{'plain' if k % 3 else ''},{k}{end}")
    return "".join(rows)


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("broadcast_splits", [100_000, 0])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_by_many_tasks_equals_multi_line(spark, tmp_path, small_splits, broadcast_splits, end):
    import csv
    import random

    rnd = random.Random(len(end))
    for name, n in (("one.csv", 300), ("two.csv", 40), ("none.csv", 0)):
        (tmp_path / name).write_bytes(csv_text(rnd, n, end).encode())
    # one record over many splits, and a last line without an end
    (tmp_path / "long.csv").write_bytes(('"' + "many\nlines\n" * 800 + '",p,1' + end + '"last",q,2').encode())
    assert quoted.split_states(quoted.split_lines(spark, str(tmp_path))).count() > 40
    got = quoted.read_quoted_csv(spark, str(tmp_path), WIDE, broadcast_splits=broadcast_splits)
    rows = sorted(((r.a, r.b, r.c) for r in got.collect()), key=repr)
    want = []
    for name in ("one.csv", "two.csv", "long.csv"):
        with open(tmp_path / name, newline="", encoding="utf-8") as f:
            want += [(a, b, int(c)) for a, b, c in csv.reader(f)]
    assert sorted(((a or "", b or "", c) for a, b, c in rows), key=repr) == sorted(want, key=repr)
    if end == "\n":  # Spark's serial reader, a task per file
        serial = spark.read.schema(WIDE).option("multiLine", True).option("lineSep", "\n").option("escape", '"').csv(str(tmp_path))
        assert sorted(((r.a, r.b, r.c) for r in serial.collect()), key=repr) == rows


def test_open_quote_raises_or_takes_the_rest(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"x",y,1\n"open,\n2\n3\n')
    with pytest.raises(ValueError, match="odd number of quotes"):
        quoted.read_quoted_csv(spark, str(tmp_path), WIDE)
    records = [r.record for r in quoted.quoted_records(spark, str(tmp_path), strict=False).collect()]
    assert sorted(records) == ['"open,\n2\n3', '"x",y,1']


def test_small_to_pandas_refuses_large(spark):
    df = spark.range(10)
    assert len(files.small_to_pandas(df, max_rows=10)) == 10
    with pytest.raises(ValueError):
        files.small_to_pandas(df, max_rows=9)
