"""One row per key, global row numbers, and joins that stand a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from askloom.session import cut, stage

#: Null keys match nothing: each row goes its own way.
NULL_WAYS = 1 << 30


#: Rows of a few short columns that may be broadcast.
SMALL_ROWS = 200_000


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """The written table ``df`` with a broadcast hint if it has at most ``rows`` rows; else Spark shuffles both sides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    ``row_number() = 1`` lets Spark keep at most one row per key and map task before
    the shuffle, so a key that holds a third of the table is no hot spot.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup_latest(
    df: DataFrame,
    keys: Sequence[Column | str],
    *,
    ts: str = "timestamp",
    granularity: str | None = None,
    tie: Sequence[Column] = (),
) -> DataFrame:
    """The newest row of each key, or of each key and hour with ``granularity="hour"``."""
    supported = ["hour"]
    if granularity is not None and granularity not in supported:
        raise ValueError(
            f"granularity must be one of {supported} or None, but got {granularity}"
        )
    bucket = [F.date_trunc(granularity, F.col(ts))] if granularity else []
    return first_per_key(df, [*keys, *bucket], [F.desc(ts), *tie])


def row_index(df: DataFrame, order: Sequence[str], *, out: str = "row_index") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the global order of ``order``.

    Rows are range-partitioned and sorted where they lie; each partition counts its own
    rows and adds the number of rows before it. No task ever sees the whole table. The
    sorted rows are written once, as the counts and the numbers must agree.
    ``order`` has to be unique for the numbers to be reproducible.
    """
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_local", local),
        "placed",
    )
    # One row per partition of the sort: bounded by spark.sql.shuffle.partitions.
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + F.col("_local"))
        .drop("_part", "_local", "_before")
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    spread_by: Sequence[str] = (),
    hot_rows: int = 1_000_000,
    max_hot: int | None = None,
) -> DataFrame:
    """Equi-join whose ``left`` side may hold a very frequent key.

    The keys of ``left`` are counted first (only the key columns are read). Without a key of
    more than ``hot_rows`` rows this is the plain join. Otherwise the rows of such keys are
    spread over several shuffle keys, as many as follow from their count, and only their ``right``
    rows are repeated. The heavy keys stay a table, joined without a hint; ``max_hot`` confines it
    to the heaviest. The result is always that of the plain join. ``how`` is inner, left, left_semi or left_anti.

    Rows of a hot key are spread by the hash of ``spread_by`` (by default all columns that
    can be hashed) and not at random, so a task that runs again places them as before.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    on = list(on)
    heavy = (
        left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
    )
    if max_hot is not None:
        heavy = heavy.orderBy(F.desc("_n"), *on).limit(max_hot)
    hot = cut(heavy.withColumn("_ways", F.ceil(F.col("_n") / hot_rows).cast("int")).drop("_n"))
    if hot.isEmpty():
        return left.join(right, on, how)
    by = list(spread_by) or [
        f.name for f in left.schema if "map<" not in f.dataType.simpleString()
    ]
    missing = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
    ways = F.when(missing, F.lit(NULL_WAYS)).otherwise(F.coalesce("_ways", F.lit(1)))
    spread = F.pmod(F.xxhash64(*by), ways).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ways"), F.lit(1)) - 1))
    salted = left.join(hot, on, "left").withColumn("_salt", spread).drop("_ways")
    repeated = right.join(hot, on, "left").withColumn("_salt", copies).drop("_ways")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def look_up(hits: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The written rows ``hits`` with the columns of ``table`` under the same key.

    Few hits go to the table, whose columns (whole texts, say) are then not shuffled. Many are counted and
    joined: a key may be hit very often.
    """
    small = small_side(hits)
    if small is not hits:
        return table.join(small, key).select(*hits.columns, *[c for c in table.columns if c != key])
    return skew_join(hits, table, [key])
