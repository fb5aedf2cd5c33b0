"""Streaming forms of the log jobs.

``unpack_payloads`` needs no counterpart here: it is stateless and takes a stream as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedup_latest_stream(
    df: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "timestamp",
    lateness: str = "1 hour",
    tie: Sequence[Column] = (),
) -> DataFrame:
    """The newest row of each key and hour, given out once the hour is closed.

    Unlike the batch form, rows later than ``lateness`` are dropped, and hours still open
    stay in state. ``ts`` has to be a timestamp with time zone semantics.
    """
    rows = F.struct(*df.columns)
    return (
        df.withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 hour").alias("_hour"), *keys)
        .agg(F.max_by(rows, F.struct(ts, *tie)).alias("_row"))
        .select("_row.*")
    )


def use_rocksdb_state(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB, outside the heap of the executors.

    Only changes are written to the checkpoint, so a commit costs what a batch changes.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def latest_of_hour_stream(
    df: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "timestamp",
    carry: Sequence[str] = (),
    lateness: str = "1 hour",
) -> DataFrame:
    """The time of the newest row of each key and hour, with its ``carry`` columns, once the hour is closed.

    The same rows as :func:`dedup_latest_stream` names, but the state of a key and hour is its newest time and
    the carried values (an id, say) and no whole row, kept in RocksDB until the watermark passes the end of the hour.
    A batch hands on one row per key, hour and map task. Ties go to the larger carried values, nulls
    are the smallest. Returns ``keys``, ``<ts>`` in microseconds as ``us``, and ``carry``, which hold numbers, texts or
    booleans. Needs :func:`use_rocksdb_state`.
    """
    newest = F.max(F.struct(F.unix_micros(ts).alias("us"), *carry)).alias("_newest")
    hours = df.withWatermark(ts, lateness).groupBy(F.window(ts, "1 hour").alias("_hour"), *keys).agg(newest)
    return hours.select(*keys, "_newest.*")


def state_report(query: StreamingQuery) -> list[dict]:
    """Per micro-batch: rows in state, bytes of state per row, rows dropped as late, as the stream reported them."""
    out = []
    for progress in query.recentProgress:
        for op in progress["stateOperators"]:
            rows = op["numRowsTotal"]
            held = op["customMetrics"].get("rocksdbSstFileSize", 0) or op["memoryUsedBytes"]
            out.append({
                "batch": progress["batchId"], "rows": rows, "bytes": held, "bytes_per_row": held / rows if rows else 0.0,
                "dropped": op["numRowsDroppedByWatermark"],
            })
    return out
