"""Keep a vector table in step with a growing folder of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from askloom.operators.keys import first_per_key
from askloom.plans.index import Embedder, build_chunks, build_index


def sync_index_stream(
    docs: DataFrame,
    index_dir: str,
    checkpoint_dir: str,
    *,
    text_col: str,
    uri_col: str,
    category_col: str,
    embedder: Embedder,
    **chunking,
) -> StreamingQuery:
    """Chunk and embed what is new in the stream ``docs``, then stop.

    Every micro-batch writes its own folder ``batch=<id>``, and a batch that runs again
    overwrites that folder only, so the work per batch grows with the batch and not with the
    index. Readers settle repeated chunk ids (:func:`read_index`).
    """
    if embedder is None:
        raise ValueError("a stream needs an embedder fitted beforehand")

    def write(batch: DataFrame, batch_id: int) -> None:
        chunks = build_chunks(batch, text_col, **chunking)
        build_index(
            chunks, uri_col=uri_col, category_col=category_col, embedder=embedder
        ).write.mode("overwrite").parquet(f"{index_dir}/batch={batch_id}")

    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def read_index(spark: SparkSession, index_dir: str) -> DataFrame:
    """One row per chunk id over all batches; of equal chunks the smallest document stays."""
    written = spark.read.parquet(index_dir)
    return first_per_key(
        written, ["chunk_id"], [F.col("doc_uri"), F.col("category"), F.col("batch")]
    ).drop("batch")


def compact_index(spark: SparkSession, index_dir: str, target_dir: str) -> None:
    """Write the settled index as the single batch of a new folder."""
    read_index(spark, index_dir).write.mode("errorifexists").parquet(f"{target_dir}/batch=-1")
