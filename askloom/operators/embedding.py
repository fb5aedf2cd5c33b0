"""Vectors for a text column: hashing TF-IDF, a user function, or a fitted Spark ML pipeline."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

TextEmbedder = Callable[[list[str]], np.ndarray]

#: Words whose bucket a task remembers.
HELD_WORDS = 1_000_000


class Buckets:
    """Counts the words of texts (lower case, between ASCII white space) by hashed bucket."""

    def __init__(self, dim: int):
        self.dim, self.known = dim, {}

    def of(self, word: str) -> int:
        if word not in self.known:
            if len(self.known) >= HELD_WORDS:
                self.known.clear()
            # The first 32 bits of the md5, as other engines can also compute them.
            self.known[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dim
        return self.known[word]

    def count(self, text: str) -> np.ndarray:
        words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text.lower()) if w]
        return np.bincount([self.of(w) for w in words], minlength=self.dim)


class HashedTfIdf:
    """An embedder: term counts by bucket, weighted by the rarity of the bucket, scaled to length one.

    A text without words is the zero vector.
    """

    def __init__(self, idf: np.ndarray):
        self.idf = idf

    def __call__(self) -> TextEmbedder:
        buckets = Buckets(len(self.idf))

        def vectors(texts: list[str]) -> np.ndarray:
            if not texts:
                return np.zeros((0, len(self.idf)))
            weighted = np.stack([buckets.count(t) for t in texts]) * self.idf
            norms = np.linalg.norm(weighted, axis=1)
            return weighted / np.where(norms > 0, norms, 1)[:, None]

        return vectors


def fit_embedder(df: DataFrame, text_col: str, *, dim: int = 256) -> HashedTfIdf:
    """The rarity of each of ``dim`` buckets, ``ln((texts + 1) / (texts with the bucket + 1))``.

    One pass in which every task keeps ``dim`` counters and hands on these; applying it is narrow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, inside, n = Buckets(dim), np.zeros(dim, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                inside += buckets.count(text.as_py()) > 0
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, dim), pa.int32()), pa.array([n, *inside], pa.int64())], names=["bucket", "n"]
        )

    texts = df.where(F.col(text_col).isNotNull()).select(text_col)
    # One row per bucket.
    rows = texts.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = {r["bucket"]: r["n"] for r in rows}
    inside = np.array([found.get(b, 0) for b in range(dim)])
    return HashedTfIdf(np.log((found.get(-1, 0) + 1) / (inside + 1)))


def embed(
    df: DataFrame,
    text_col: str,
    *,
    embedder: PipelineModel | Callable[[], TextEmbedder] | None = None,
    out: str = "embedding",
) -> DataFrame:
    """``df`` plus a vector column (null where the text is null).

    ``embedder`` is a factory called once per task whose function turns a list of texts into a
    matrix, such as that of :func:`fit_embedder`, or a fitted ML pipeline from text to vector.
    None fits hashing TF-IDF on ``df`` itself.
    """
    if embedder is None:
        embedder = fit_embedder(df, text_col)
    if isinstance(embedder, PipelineModel):
        # Null texts are embedded as '' (the ML stages reject null) and set back to null.
        shadow, last = embedder.stages[0].getInputCol(), embedder.stages[-1].getOutputCol()
        names = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(df.columns)]
        source = df.select(*names, F.coalesce(F.col(text_col), F.lit("")).alias(shadow))
        texts = F.col(f"_keep_{df.columns.index(text_col)}")
        vector = vector_to_array(last, "float32")
        return embedder.transform(source).select(
            *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(df.columns)],
            F.when(texts.isNotNull(), vector).alias(out),
        )

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = embedder()
        for batch in batches:
            known = batch.notna()
            rows = iter(np.asarray(model(batch[known].tolist()), dtype=np.float32))
            yield pd.Series([next(rows) if k else None for k in known])

    # A model may be costly: never evaluate it a second time for a filter on its result.
    return df.withColumn(out, vectors.asNondeterministic()(F.col(text_col)))
