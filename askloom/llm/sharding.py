"""Sharding along a Hilbert curve over metadata, in SQL functions only.

Size, source and language are quantised, the curve orders the rows, and the order is cut into
runs. Rows of a shard then lie close in every dimension, so the minimum and maximum that a file
keeps for each column let a reader skip most files for a filter on any of them. Law ``rows``: shard
sizes differ by at most one row. Equal texts stand next to each other; a group larger than a
shard runs on into the next.

Defined cases: a null text has no bytes and no checksum bits (crc32 of the empty text); null source
or language is the cell 0; repeated rows take neighbouring slots; an empty table gives no rows;
fewer rows than shards leave shards empty. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from askloom.llm.hilbert import hilbert_column
from askloom.operators.keys import row_index

SHARDS = 40
BITS = 6
OVERHEAD = 16


def _hashed(column: str) -> Column:
    """A string's cell: 0 for null, else 1 to 63 by hash."""
    return F.coalesce(F.pmod(F.xxhash64(F.col(column)), F.lit((1 << BITS) - 1)) + 1, F.lit(0)) * F.col(
        column
    ).isNotNull().cast("int")


def size_cell(size: Column) -> Column:
    """Four cells per doubling: sizes from 16 bytes to a terabyte fall into different cells."""
    return F.least(F.floor((F.log2(size) - 4) * 1.75), F.lit((1 << BITS) - 1)).cast("int")


def shard_documents(docs: DataFrame, *, shards: int = SHARDS, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, hilbert, law, shard, slot, grown_shard`` for every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        id_col, (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), _hashed("source").alias("_source"),
        _hashed("lang").alias("_lang"),
    )
    keyed = rows.select(
        id_col, "size", "text_crc32",
        hilbert_column([F.col("_source"), F.col("_lang"), size_cell(F.col("size"))], BITS).alias("hilbert"),
    )
    ranked = row_index(keyed, ["hilbert", "size", "text_crc32", id_col], out="_rank")
    total = ranked.count()
    # The first rank of shard s is ceil(s * total / shards).
    return (
        ranked.withColumn("shard", F.expr(f"cast((_rank * {shards}L) div {max(total, 1)}L as int)"))
        .select(
            id_col, "size", "text_crc32", "hilbert", F.lit("rows").alias("law"), "shard",
            (F.col("_rank") - F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(docs: DataFrame, path: str, *, shards: int = SHARDS, id_col: str = "doc_id") -> None:
    """Write the rows, one folder per shard, each sorted along the curve."""
    placed = shard_documents(docs, shards=shards, id_col=id_col).select(id_col, "hilbert", "shard")
    placed = placed.dropDuplicates([id_col])
    (
        docs.join(placed, id_col).repartitionByRange("shard", "hilbert", id_col).sortWithinPartitions("shard", "hilbert", id_col)
        .write.partitionBy("shard").parquet(path)
    )
