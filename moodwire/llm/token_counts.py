"""Token counts per document, with overlap resynchronisation for huge texts.

A text of at most ``chunk`` characters is counted at once. A longer one is encoded in overlapping
chunks with offsets; two neighbours are spliced at the last pre-token start that both agree on.
That boundary is proven: the left chunk starts at a true boundary, and a pre-token of it that ends
``MARGIN`` characters before its end cannot be changed by what follows (the pattern looks one
character ahead, the special strings are shorter than the margin); from a true boundary on, the ids
depend on the rest of the text alone. Where no common start exists (one unbroken run longer than the
overlap) the overlap is doubled, and past the chunk the chunk itself.

Row-local: no shuffle; memory is one Arrow batch plus a bounded memory of segments.

Nulls and empty texts count 0 bytes and 0 tokens; repeated rows give repeated rows; an empty table
gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from moodwire.llm import tokens

CHUNK = 65_536  # characters encoded at once
OVERLAP = 2_048
MARGIN = 64


def starts(encoding, base: int) -> tuple[list[int], list[int]]:
    """Absolute pre-token starts of an encoding, and the index of the first token of each."""
    at, index, last = [], [], object()
    for k, (word, (a, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word is None or word != last:
            at.append(base + a)
            index.append(k)
        last = word
    return at, index


def chunked_count(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, encoded in chunks of at most about ``chunk`` characters."""
    encode = lambda a, b: tokenizer.encode(text[a:b], add_special_tokens=False)
    total, begin, size = 0, 0, max(chunk, 4 * MARGIN)
    end = min(len(text), begin + size)
    left = encode(begin, end)
    skip = 0  # tokens of ``left`` that an earlier splice has counted
    at, index = starts(left, begin)
    while end < len(text):
        wide = max(overlap, 2 * MARGIN)
        while True:
            b = end - wide
            if b <= begin:  # one run fills the chunk: take a longer chunk from the last true boundary
                size *= 2
                end = min(len(text), begin + size)
                left = encode(begin, end)
                skip, (at, index) = 0, starts(left, begin)
                break
            stop = min(len(text), b + size)
            right = encode(b, stop)
            r_at, r_index = starts(right, b)
            known = dict(zip(r_at[1:], r_index[1:]))  # the first start is the cut itself
            common = next((k for k in range(len(at) - 1, -1, -1) if at[k] <= end - MARGIN and at[k] in known), None)
            if common is not None and index[common] > skip:
                total += index[common] - skip
                begin, end, left, skip = at[common], stop, right, known[at[common]]
                keep = [k for k, i in enumerate(r_index) if i >= skip]
                at, index = [r_at[k] for k in keep], [r_index[k] for k in keep]
                size = chunk if size == chunk else max(chunk, size // 2)
                break
            wide *= 2
    return total + len(left.ids) - skip


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP, leading_space: bool = True) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row of ``docs``; ids as the tokenizers library gives them."""

    def count(batches):
        import pyarrow as pa

        enc = tokens.encoder(tokenizer_path, leading_space)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(sum(map(len, enc.segments(text))) // 4 if len(text) <= chunk
                                else chunked_count(text, enc.tokenizer, chunk, overlap))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(id_col, text_col)
    schema = T.StructType([rows.schema[id_col], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return rows.mapInArrow(count, schema)
