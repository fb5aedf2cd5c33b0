"""What the neighbour searches share: keyed vectors, usable rows, ranks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

DIGITS = 9  # scores equal to this many digits tie and are ordered by key


def keyed(df: DataFrame, key: str, vec: str, name: str) -> DataFrame:
    """Key and vector. Whether a vector is usable is seen where it is used: a filter here
    would make Spark compute vectors that come from a model twice."""
    return df.select(
        F.col(key).alias(name), F.col(vec).cast("array<float>").alias("vec")
    ).where(F.col(name).isNotNull())


def key_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def usable(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows whose vector has a direction, and these vectors scaled to length one."""
    lengths = pc.fill_null(pc.list_value_length(table["vec"]), 0)
    table = table.filter(pc.greater(lengths, 0))
    if not table.num_rows:
        return table, np.zeros((0, 0))
    column = table["vec"].combine_chunks()
    if len(pc.unique(pc.list_value_length(column))) > 1:
        raise ValueError("vectors differ in length")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    vectors = values.reshape(table.num_rows, -1)
    norms = np.linalg.norm(vectors, axis=1)
    known = (norms > 0) & np.isfinite(norms)
    if not known.all():
        table, vectors, norms = table.filter(pa.array(known)), vectors[known], norms[known]
    return table, vectors / norms[:, None]


def rank_hits(hits: DataFrame, k: int, by: str = "query_key", key: str = "index_key") -> DataFrame:
    """Rank per query by score, then key; keep the first k."""
    w = Window.partitionBy(by).orderBy(F.desc("score"), key)
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
