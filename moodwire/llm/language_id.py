"""Language identification by error-correcting output codes.

Each language has a binary codeword; one linear classifier per bit, over hashed character n-grams of
the text, predicts that bit. A text gets the language whose codeword loses least, every bit weighted
by how well its classifier did in training; when the margin to the next codeword is small the result
is flagged as ambiguous.

The classifiers are fitted on a bounded sample of the labelled rows (``SAMPLE`` per language, chosen
by a hash of the text, so that the choice does not depend on how rows are dealt out); predictions read
every row and its whole text, row-locally, with the weights broadcast (bounded by ``FEATURES``).

Text alone decides. Null texts and texts without a letter give ``und`` and score 0; without labelled
rows every text does. Repeated rows are predicted each; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 400  # labelled texts per language that the classifiers are fitted on
SALTS = 32  # parts of a language that are ranked apart
FEATURES = 1 << 15
EPOCHS = 120
AMBIGUOUS = 0.2  # margin between the best two languages' scores
UNKNOWN = "und"


def codewords(languages: list[str]):
    """A matrix of +1 and -1, a row per language. Up to seven languages get the exhaustive code (every
    split of the languages once), more get the rows of the next larger binary Hadamard-like code."""
    import numpy as np

    k = len(languages)
    if k <= 7:
        columns = [(1, *bits) for bits in product((1, -1), repeat=k - 1) if -1 in bits]
        return np.array(columns, np.float32).reshape(-1, k).T
    size = 1
    while size < 2 * k:
        size *= 2
    rows = np.arange(size)
    code = np.array([[1 if bin(i & j).count("1") % 2 == 0 else -1 for j in rows] for i in rows], np.float32)
    code = code[1 : k + 1]
    return code[:, np.abs(code.sum(axis=0)) < k]  # bits that all languages share tell nothing


def grams(data, features: int):
    """Hashed 1-, 2- and 3-byte grams ending at each byte of lower-cased text (uint8 array): three
    index arrays of the data's length."""
    import numpy as np

    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    # digits and ASCII marks carry no language: all of them are one sign
    sign = ((lower < 97) | (lower > 122)) & (lower < 128)
    lower[sign] = 32
    two, three = lower.copy(), lower.copy()
    two[1:] += lower[:-1] << 8
    three[1:] += lower[:-1] << 8
    three[2:] += lower[:-2] << 16
    shift = 32 - (features.bit_length() - 1)
    mixed = [(x * np.uint32(2654435761) + np.uint32(c)) * np.uint32(2246822519) >> np.uint32(shift)
             for x, c in ((lower, 1), (two, 0x9E37), (three, 0x85EB))]
    return [m.astype(np.intp) for m in mixed]


def vector(text: str, features: int):
    """(indices, values): square roots of a text's gram counts, of length 1. Long texts are counted in
    blocks, each with the two bytes before it."""
    import numpy as np

    data, counts = np.frombuffer(text.encode(), np.uint8), np.zeros(features, np.float32)
    for a in range(0, len(data), 1 << 20):
        lo = max(0, a - 2)
        for g in grams(data[lo : a + (1 << 20)], features):
            counts += np.bincount(g[a - lo :], minlength=features)
    used = np.flatnonzero(counts)
    x = np.sqrt(counts[used])
    return used, x / max(float(np.linalg.norm(x)), 1e-9)


def fit(samples: list[tuple[list[int], list[float], str]], features: int = FEATURES) -> dict:
    """From (indices, values, language) vectors: weights per bit (logistic regression by full-batch gradient steps) and bit reliabilities."""
    import numpy as np

    languages = sorted({lang for *_, lang in samples})
    if len(languages) < 2:
        return {"languages": languages, "code": np.ones((len(languages), 1), np.float32),
                "weights": np.zeros((features, 1), np.float32), "bias": np.full(1, 20.0, np.float32), "trust": np.ones(1)}
    code = codewords(languages)
    x = np.zeros((len(samples), features), np.float32)
    for row, (at, values, _) in zip(x, samples):
        row[at] = values
    used = np.flatnonzero(x.any(axis=0))
    x = x[:, used]
    y = code[[languages.index(lang) for *_, lang in samples]]
    bits = y.shape[1]
    w, b = np.zeros((x.shape[1], bits), np.float32), np.zeros(bits, np.float32)
    v, vb, rate = np.zeros_like(w), np.zeros_like(b), 40.0
    for _ in range(EPOCHS):
        g = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(x)
        v = 0.9 * v + x.T @ g + 1e-6 * w
        vb = 0.9 * vb + g.sum(axis=0)
        w -= rate * v
        b -= rate * 0.1 * vb
    wrong = ((x @ w + b) * y <= 0).mean(axis=0)
    trust = np.log((1 - wrong + 1e-3) / (wrong + 1e-3))
    weights = np.zeros((features, bits), np.float32)
    weights[used] = w
    return {"languages": languages, "code": code, "weights": weights, "bias": b, "trust": trust / trust.sum()}


def decode(margins, model):
    """(language, score, ambiguous) of one text's bit margins: logistic loss against each codeword,
    weighted by the bits' reliability; the score is the share of the best among all languages."""
    import numpy as np

    loss = (np.log1p(np.exp(-np.clip(model["code"] * margins, -30, 30))) * model["trust"]).sum(axis=1)
    share = np.exp(-(loss - loss.min()) * 4)
    share /= share.sum()
    order = np.argsort(-share, kind="stable")
    second = share[order[1]] if len(order) > 1 else 0.0
    return model["languages"][order[0]], float(share[order[0]]), bool(share[order[0]] - second < AMBIGUOUS)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def training_sample(labelled: DataFrame, text_col: str, lang_col: str, per_language: int = SAMPLE,
                    features: int = FEATURES) -> list[tuple[list[int], list[float], str]]:
    """Gram vectors of at most ``per_language`` distinct texts of each language, by the order of their
    hash. What reaches the driver is bounded: ``features`` numbers for each of them."""
    d = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    # ranked per language and salt first, so that however many rows a language has, at most SALTS * per_language meet
    salted = Window.partitionBy("lang", "salt").orderBy("h")
    first = Window.partitionBy("lang").orderBy("h")
    chosen = (d.select("lang", "h").distinct().withColumn("salt", F.pmod("h", F.lit(SALTS)))
              .withColumn("r", F.row_number().over(salted)).where(F.col("r") <= per_language)
              .withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_language).select("lang", "h"))
    texts = d.join(chosen, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            made = [vector(t.as_py(), features) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([m[0].tolist() for m in made], pa.list_(pa.int32())),
                 pa.array([m[1].tolist() for m in made], pa.list_(pa.float32()))], names=["lang", "h", "at", "x"])

    rows = texts.select("lang", "h", "text").mapInArrow(count, "lang string, h long, at array<int>, x array<float>").collect()
    return [(r["at"], r["x"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["h"]))]


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x bits floats
    features = len(model["weights"])

    def run(batches):
        import pyarrow as pa

        m = shared.value
        w = m["weights"]
        for batch in batches:
            cols = [[], [], []]
            for value in batch.column(1):
                text = value.as_py()
                if text is None or not m["languages"] or not has_letter(text):
                    row = (UNKNOWN, 0.0, True)
                else:
                    used, x = vector(text, features)
                    row = decode(x @ w[used] + m["bias"], m)
                for c, v in zip(cols, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()),
                                              pa.array(cols[2], pa.bool_())], names=schema.names)

    rows = docs.select(id_col, text_col)
    schema = T.StructType([rows.schema[id_col], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, ambiguous): fitted on the rows that are not held out."""
    model = fit(training_sample(docs.where(~held_out(id_col)), text_col, lang_col))
    return predict(docs, model, id_col, text_col).select(
        id_col, held_out(id_col).alias("held_out"), "lang_pred", "score", "ambiguous")
