"""A vector table that follows a log of document changes: inserts, edits and deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from askloom.operators.embedding import embed
from askloom.operators.keys import first_per_key, small_side
from askloom.plans.index import Embedder, build_chunks
from askloom.session import cut
from askloom.sources.versions import (
    Version, create_version, read_version, replace_partitions, touched_prefixes, version_of,
)

DELETE = "delete"
#: One row per chunk of a document, and one without a chunk id that says how far the document is.
KEPT = ["doc_uri", "doc_version", "deleted", "chunk_id", "chunk_no", "category", "content", "embedding"]


def follow_changes(
    changes: DataFrame,
    path: str,
    checkpoint_dir: str,
    *,
    text_col: str,
    uri_col: str = "doc_uri",
    category_col: str = "category",
    version_col: str = "version",
    op_col: str = "op",
    embedder: Embedder,
    prefix_chars: int = 2,
    **chunking,
) -> StreamingQuery:
    """Apply what is new in the stream ``changes`` to the index at ``path``, then stop.

    A change is the state of a document from ``version_col`` on; ``op_col`` is ``delete`` for a removal
    and anything else for a new state. The highest version of a document wins, in whatever order changes
    arrive; of equal versions the delete, then the least text. Deleted documents leave a marker
    behind, so that an older change that comes late does not bring them back.

    Every micro-batch is merged at write time: only the partitions (by the hash of the document)
    that its documents fall into are rewritten, in one new version. A batch that runs again finds
    its versions there already and changes nothing.
    """
    if embedder is None:
        raise ValueError("a stream needs an embedder fitted beforehand")

    def merge(batch: DataFrame, batch_id: int) -> None:
        log = batch.select(
            F.col(uri_col).cast("string").alias("doc_uri"), F.col(version_col).cast("bigint").alias("doc_version"),
            F.coalesce(F.col(op_col) == DELETE, F.lit(False)).alias("deleted"),
            F.col(category_col).alias("category"), F.col(text_col).alias("_text"),
        ).where(F.col("doc_uri").isNotNull() & F.col("doc_version").isNotNull())
        apply_changes_batch(log, path, embedder=embedder, prefix_chars=prefix_chars, **chunking)

    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def apply_changes_batch(
    log: DataFrame, path: str, *, embedder: Embedder, prefix_chars: int = 2, **chunking
) -> Version | None:
    """The index after the changes ``doc_uri, doc_version, deleted, category, _text``."""
    spark = log.sparkSession
    now = version_of(spark, path)
    last = first_per_key(log, ["doc_uri"], [F.desc("doc_version"), F.desc("deleted"), F.col("_text"), F.col("category")])
    if now is not None:
        last = cut(last)
        touched = touched_prefixes(last, now)
        before = read_version(spark, now, touched)
        known = before.where("chunk_id IS NULL").select("doc_uri", F.col("doc_version").alias("_known"))
        last = last.join(known, "doc_uri", "left").where(
            F.col("_known").isNull() | (F.col("doc_version") > F.col("_known"))
        ).drop("_known")
    fresh = cut(last)
    if fresh.isEmpty():
        return now
    nothing = {"chunk_id": "string", "chunk_no": "int", "content": "string", "embedding": "array<float>"}
    markers = fresh.drop("_text").withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    chunks = build_chunks(fresh.where("NOT deleted"), "_text", out="content", **chunking)
    rows = embed(chunks, "content", embedder=embedder).select(*KEPT).unionByName(markers.select(*KEPT))
    if now is None:
        return create_version(rows, path, key="doc_uri", prefix_chars=prefix_chars)
    touched = touched_prefixes(fresh, now)
    others = read_version(spark, now, touched).join(small_side(fresh.select("doc_uri")), "doc_uri", "left_anti")
    return replace_partitions(rows, now, touched, kept=others)


def followed_index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row per chunk id, as of a version; of equal chunks the one of the smallest document stays."""
    found = version_of(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no index at {path}")
    chunks = read_version(spark, found).where("chunk_id IS NOT NULL")
    return first_per_key(chunks, ["chunk_id"], [F.col("doc_uri"), F.col("category"), F.col("chunk_no")]).select(
        "chunk_id", "doc_uri", "category", "content", "embedding"
    )


def document_states(spark: SparkSession, path: str) -> DataFrame:
    """``doc_uri, doc_version, deleted`` of every document that was ever named in the log."""
    return read_version(spark, version_of(spark, path)).where("chunk_id IS NULL").select(
        "doc_uri", "doc_version", "deleted"
    )
