"""Registration of queries and the few frames that several of them start from."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from askloom.session import BATCH_BYTES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL if it has one."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # Timestamps are compared as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def scratch_schema(spark: SparkSession) -> Iterator[str]:
    """A schema of its own for queries that write tables; dropped with all of them."""
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name}")
    try:
        yield name
    finally:
        spark.sql(f"DROP SCHEMA {name} CASCADE")
