"""Chunks of a fixed number of sub-word tokens, cut out of the text at token borders."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from askloom.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE

CHUNK = "array<struct<text:string,start:int,end:int,n_tokens:int>>"


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The tokenizer of a file; a Python worker reads it once and keeps it for all its tasks."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # The names of special tokens in a text are ordinary text.
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def token_spans(offsets: list[tuple[int, int]], size: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, end, tokens) in characters of windows of ``size`` tokens that start every ``size - overlap``.

    The last window may be short but holds a token that no earlier one has. A character
    whose tokens fall into two windows is in both.
    """
    step, n = size - overlap, len(offsets)
    out = []
    for first in range(0, max(n - overlap, min(n, 1)), step):
        window = offsets[first: first + size]
        out.append((window[0][0], max(end for _, end in window), len(window)))
    return out


def chunk_subwords(
    docs: DataFrame,
    text_col: str,
    tokenizer_file: str,
    *,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    out: str = "chunk",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """All columns of ``docs`` (or those of ``keep``) plus ``chunk_no``, the chunk, ``chunk_id`` (its md5), ``start``, ``end`` and ``n_tokens``.

    A chunk is a piece of the text as it stands, from the first character of its first token to the
    last of its last: nothing is lower-cased or normalised, as joining token strings would do. Texts without
    a token give no chunk. ``tokenizer_file`` is read on the executors (a path that all of them have). Python
    sees the text column only.
    """
    if not 0 <= overlap < size:
        raise ValueError(f"overlap must be in [0, size), got size={size} overlap={overlap}")

    @pandas_udf(CHUNK)
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = load_tokenizer(tokenizer_file)

        def chunks(text: str | None) -> list[tuple]:
            offsets = tokenizer.encode(text or "", add_special_tokens=False).offsets
            return [(text[a:b], a, b, n) for a, b, n in token_spans(offsets, size, overlap)]

        for batch in batches:
            yield batch.map(chunks)

    # Marked so that the filter Spark derives from the explode does not tokenize a second time.
    cut = docs.where(F.length(text_col) > 0).withColumn("_chunks", pieces.asNondeterministic()(F.col(text_col)))
    kept = list(docs.columns if keep is None else keep)
    return cut.select(*kept, F.posexplode("_chunks").alias("chunk_no", "_c")).select(
        *kept, "chunk_no", F.col("_c.text").alias(out), F.md5("_c.text").alias("chunk_id"),
        "_c.start", "_c.end", "_c.n_tokens",
    )
