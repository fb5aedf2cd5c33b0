"""Split texts into overlapping chunks with content-derived ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from askloom.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE
from askloom.functions.text import token_windows, whitespace_tokens

Tokenizer = Callable[[str], list[str]]


def _explode_chunks(df: DataFrame, chunks, columns: list[str], out: str) -> DataFrame:
    return (
        df.select(*columns, F.posexplode(chunks).alias("chunk_no", out))
        .withColumn("chunk_id", F.md5(F.col(out)))
    )


def chunk_tokens(
    docs: DataFrame,
    text_col: str,
    *,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    tokenizer: Callable[[], Tokenizer] | None = None,
    joiner: str = " ",
    out: str = "chunk",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """All columns of ``docs`` (or those of ``keep``) plus ``chunk_no``, the chunk text and ``chunk_id`` (its md5).

    Without a tokenizer everything stays in JVM expressions and no row moves.
    ``tokenizer`` is a factory, called once per task; the function it returns
    gives the pieces of one text. Null or empty text yields no chunk. A table of chunks that keeps
    the text itself repeats it for each of its chunks; ``keep`` leaves it out.
    """
    kept = list(docs.columns if keep is None else keep)
    text = F.col(text_col)
    if tokenizer is None:
        tokens = whitespace_tokens(text)
    else:
        @pandas_udf("array<string>")
        def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tokenize = tokenizer()
            for batch in batches:
                yield batch.map(lambda t: list(tokenize(t)))

        tokens = pieces.asNondeterministic()(text)
    # The token array is its own column so that it is built once per text, not per window.
    tokenized = docs.where(F.length(text) > 0).withColumn("_tokens", tokens)
    if tokenizer is not None:
        tokenized = tokenized.where(F.size("_tokens") > 0)
    windows = token_windows(F.col("_tokens"), size, overlap, joiner)
    return _explode_chunks(tokenized, windows, kept, out)


def pack_pieces(lengths: list[int], size: int, overlap: int) -> list[tuple[int, int]]:
    """Greedy packing of consecutive pieces into ranges ``[start, end)``.

    A range takes pieces while their lengths sum to at most ``size`` (one piece may
    be longer on its own). The next range starts with the longest tail of the last
    one that is at most ``overlap`` long and leaves room for the next piece.
    """
    before = [0]
    for length in lengths:
        before.append(before[-1] + length)
    ranges, start, end, n = [], 0, 0, len(lengths)
    while end < n:
        end = max(end, start) + 1
        while end < n and before[end + 1] - before[start] <= size:
            end += 1
        ranges.append((start, end))
        if end < n:
            start += 1
            while start < end and (
                before[end] - before[start] > overlap or before[end + 1] - before[start] > size
            ):
                start += 1
    return ranges


def chunk_separator(
    docs: DataFrame,
    text_col: str,
    *,
    sep: str = "\n",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    tokenizer: Callable[[], Tokenizer] | None = None,
    out: str = "chunk",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Like :func:`chunk_tokens`, but cuts only at ``sep``.

    The pieces between separators are packed up to ``size`` tokens; a piece that is
    longer stays whole. Packing depends on all earlier pieces of the same text, so it
    runs in an Arrow UDF that sees the text column only.
    """
    if not 0 <= overlap < size:
        raise ValueError(f"overlap must be in [0, size), got size={size} overlap={overlap}")

    @pandas_udf("array<string>")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenize = str.split if tokenizer is None else tokenizer()

        def chunks(text: str) -> list[str]:
            pieces = [p for p in text.split(sep) if p]
            spans = pack_pieces([len(tokenize(p)) for p in pieces], size, overlap)
            texts = (sep.join(pieces[a:b]).strip() for a, b in spans)
            return [t for t in texts if t]

        for batch in batches:
            yield batch.map(chunks)

    kept = list(docs.columns if keep is None else keep)
    # Marked so that the filter Spark derives from the explode does not pack a second time.
    once = packed.asNondeterministic()(F.col(text_col))
    packs = docs.where(F.length(text_col) > 0).withColumn("_chunks", once)
    return _explode_chunks(packs, F.col("_chunks"), kept, out)
