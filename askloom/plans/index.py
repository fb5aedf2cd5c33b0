"""Chunk tables and the vector table kept in step with them.

The vector table has the columns ``chunk_id, doc_uri, category, content, embedding`` and
one row per chunk id; of equal chunks the one of the smallest document stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from askloom.operators.chunking import chunk_separator, chunk_tokens
from askloom.operators.diff import apply_changes, snapshot_diff
from askloom.operators.embedding import TextEmbedder, embed
from askloom.operators.keys import first_per_key, small_side
from askloom.session import cut, stage
from askloom.sources.versions import (
    Version, create_version, read_version, replace_partitions, touched_prefixes, version_of,
)

Embedder = PipelineModel | Callable[[], TextEmbedder] | None
INDEXED = ["doc_uri", "category", "content"]


def build_chunks(docs: DataFrame, text_col: str, *, sep: str | None = None, **kwargs) -> DataFrame:
    """The chunk table; ``sep`` chooses cutting at a separator instead of at any token."""
    if sep is None:
        return chunk_tokens(docs, text_col, **kwargs)
    return chunk_separator(docs, text_col, sep=sep, **kwargs)


#: Marks of ids (a number each) up to which they go to every task.
COPIED_MARKS = 1_000_000


def unique_chunks(
    chunks: DataFrame, *, id_col: str, uri_col: str, category_col: str, text_col: str, in_place: bool = False
) -> DataFrame:
    """One row per chunk id, under the names of the vector table.

    With ``in_place`` ids are counted first, and only texts of ids that come more than once are shuffled. The
    chunk table is then read three times.
    """
    renamed = chunks.select(
        F.col(id_col).alias("chunk_id"),
        F.col(uri_col).alias("doc_uri"),
        F.col(category_col).alias("category"),
        F.col(text_col).alias("content"),
    )
    order = [F.col("doc_uri"), F.col("category")]
    if not in_place:
        return first_per_key(renamed, ["chunk_id"], order)
    # Ids that share a mark by chance only come together as well.
    marked = renamed.withColumn("_mark", F.xxhash64("chunk_id"))
    copied = marked.groupBy("_mark").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_mark")
    copied = stage(copied, "copied")
    few = small_side(copied, COPIED_MARKS)
    if few is copied:
        return first_per_key(renamed, ["chunk_id"], order)
    alone, several = (marked.join(few, "_mark", how).drop("_mark") for how in ("left_anti", "left_semi"))
    return alone.unionByName(first_per_key(several, ["chunk_id"], order))


def build_index(
    chunks: DataFrame,
    *,
    id_col: str = "chunk_id",
    uri_col: str = "doc_uri",
    category_col: str = "category",
    text_col: str = "chunk",
    embedder: Embedder = None,
) -> DataFrame:
    """The vector table of a chunk table. Equal chunks are embedded once."""
    rows = unique_chunks(
        chunks, id_col=id_col, uri_col=uri_col, category_col=category_col, text_col=text_col
    )
    return embed(rows, "content", embedder=embedder)


def vector_rows(
    chunks: DataFrame,
    *,
    embedder: Embedder,
    id_col: str = "chunk_id",
    uri_col: str = "doc_uri",
    category_col: str = "category",
    text_col: str = "chunk",
) -> DataFrame:
    """:func:`build_index` without ``content``, for one search over all chunks.

    Vectors are made where the chunks lie and shuffled instead of the texts, so equal chunks are embedded
    more than once. The search finds the texts of its hits among the chunks (``texts`` of ``retrieve``).
    """
    if embedder is None:
        raise ValueError("give an embedder fitted beforehand")
    rows = chunks.select(
        F.col(id_col).alias("chunk_id"), F.col(uri_col).alias("doc_uri"), F.col(category_col).alias("category"),
        F.col(text_col).alias("_text"),
    )
    made = embed(rows, "_text", embedder=embedder).drop("_text")
    return first_per_key(made, ["chunk_id"], [F.col("doc_uri"), F.col("category")])


def sync_index(
    index: DataFrame,
    chunks: DataFrame,
    *,
    embedder: Embedder,
    id_col: str = "chunk_id",
    uri_col: str = "doc_uri",
    category_col: str = "category",
    text_col: str = "chunk",
) -> DataFrame:
    """The vector table after taking over the present chunk table.

    Only new and changed chunks are embedded; chunks that are gone leave the index.
    """
    rows = unique_chunks(
        chunks, id_col=id_col, uri_col=uri_col, category_col=category_col, text_col=text_col
    )
    changes = snapshot_diff(index.drop("embedding"), rows, key="chunk_id", compare=INDEXED)
    # Holds model output and is read twice: written once.
    changes = cut(embed(changes, "content", embedder=embedder))
    return apply_changes(index, changes, key="chunk_id")


# --- the stored index ------------------------------------------------------------------

STORED = ["chunk_id", *INDEXED, "digest", "embedding"]


def _digest() -> Column:
    """One short value of what is compared of a row ``doc_uri, category, _text``, the text by its md5."""
    return F.sha2(F.to_json(F.struct("doc_uri", "category", "_text"), {"ignoreNullFields": "false"}), 256)


def create_or_sync_index(
    spark: SparkSession,
    chunks: DataFrame,
    path: str,
    *,
    embedder: Embedder,
    id_col: str = "chunk_id",
    uri_col: str = "doc_uri",
    category_col: str = "category",
    text_col: str = "chunk",
    prefix_chars: int = 2,
) -> Version:
    """Bring the stored index at ``path`` to the state of the chunk table; the first time, create it.

    A sync compares ids and digests, takes and embeds the texts of new and changed chunks only, and rewrites only
    the partitions these fall into. Readers keep the version they opened; without a change
    there is no new version. ``prefix_chars`` hex characters of the key give the partitions.
    """
    rows = chunks.select(
        F.col(id_col).alias("chunk_id"), F.col(uri_col).alias("doc_uri"), F.col(category_col).alias("category"),
        F.col(text_col).alias("content"),
    )
    order = [F.col("doc_uri"), F.col("category")]
    now = version_of(spark, path)
    if now is None:
        made = first_per_key(rows, ["chunk_id"], order).withColumn("_text", F.md5("content")).withColumn("digest", _digest())
        made = embed(made, "content", embedder=embedder).select(*STORED)
        return create_version(made, path, key="chunk_id", prefix_chars=prefix_chars)
    # Ids and digests settle what has changed; texts are then taken from the chunk table for these rows only.
    narrow = first_per_key(rows.select("chunk_id", "doc_uri", "category", F.md5("content").alias("_text")), ["chunk_id"], order)
    narrow = narrow.withColumn("digest", _digest()).drop("_text")
    before = read_version(spark, now).select("chunk_id", "digest")
    changed = stage(snapshot_diff(before, narrow, key="chunk_id", compare=["digest"]), "changed")
    # Few changes go to the chunks; many are joined by id.
    new = small_side(changed.where("op <> 'delete'").select(
        "chunk_id", "op", "digest", F.col("doc_uri").alias("_uri"), F.col("category").alias("_category")
    ))
    same = F.col("doc_uri").eqNullSafe(F.col("_uri")) & F.col("category").eqNullSafe(F.col("_category"))
    texts = rows.join(new, "chunk_id").where(same).dropDuplicates(["chunk_id"])
    made = embed(texts.select("chunk_id", "op", *INDEXED, "digest"), "content", embedder=embedder)
    gone = changed.where("op = 'delete'").select(
        "chunk_id", "op", *[F.lit(None).cast(made.schema[c].dataType).alias(c) for c in made.columns[2:]]
    )
    # Holds model output and is read twice: written once.
    changes = stage(made.unionByName(gone), "changes")
    touched = touched_prefixes(changes, now)
    if not touched:
        return now
    kept = read_version(spark, now, touched).join(small_side(changes.select("chunk_id")), "chunk_id", "left_anti")
    after = changes.where("op <> 'delete'").select(*STORED)
    return replace_partitions(after, now, touched, kept=kept)


def stored_index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The index as of a version, the current one by default, in the layout of :func:`build_index`."""
    found = version_of(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no index at {path}")
    return read_version(spark, found).drop("digest")
