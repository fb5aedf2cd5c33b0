"""Row-level changes between two snapshots of a keyed table, and applying them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _digest(columns: Sequence[str]):
    """One short value per row, so that old rows travel as 64 bytes and not as texts."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def snapshot_diff(
    old: DataFrame, new: DataFrame, *, key: str, compare: Sequence[str] | None = None
) -> DataFrame:
    """``key``, ``op`` (insert, update or delete) and the new values of every changed row.

    ``key`` is unique on both sides. Unchanged rows are left out; the values of a deleted
    row are null. ``compare`` defaults to all columns but the key.
    """
    values = [c for c in new.columns if c != key]
    compare = list(compare) if compare is not None else values
    before = old.select(key, _digest(compare).alias("_old"))
    after = new.withColumn("_new", _digest(compare))
    op = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return (
        before.join(after, key, "full")
        .withColumn("op", op)
        .where(F.col("op").isNotNull())
        .select(key, "op", *values)
    )


def apply_changes(table: DataFrame, changes: DataFrame, *, key: str) -> DataFrame:
    """``table`` after the inserts, updates and deletes of :func:`snapshot_diff`.

    ``changes`` is read twice; cut it first if it is costly.
    """
    values = [c for c in table.columns if c != key]
    changed = changes.where(F.col("op") != "insert").select(
        key, F.col("op").alias("_op"), *[F.col(c).alias(f"_new_{c}") for c in values]
    )
    # A left join: few changes are broadcast by Spark itself, and the table stays in place.
    kept = table.join(changed, key, "left").where(
        F.col("_op").isNull() | (F.col("_op") != "delete")
    )
    picked = {
        c: F.when(F.col("_op").isNull(), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c)
        for c in values
    }
    added = changes.where(F.col("op") == "insert").select(*table.columns)
    return kept.select(
        *[F.col(key) if c == key else picked[c] for c in table.columns]
    ).unionByName(added)
