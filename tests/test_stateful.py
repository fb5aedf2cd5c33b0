"""The stream that keeps the newest time of each key and hour in state, closed by timers."""

import pytest
from pyspark.sql import functions as F

from askloom.session import scratch_path
from askloom.streaming.logs import latest_of_hour_stream, state_report, use_rocksdb_state

SCHEMA = "k string, t string, id long, flag boolean"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(PROVIDER)
    use_rocksdb_state(spark)
    yield
    spark.conf.set(PROVIDER, before)


def run(spark, source, out, state, rows, carry=("id",)):
    if rows:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source).withColumn("timestamp", F.to_timestamp("t"))
    latest = latest_of_hour_stream(stream, ["k"], carry=list(carry), lateness="1 hour")
    query = latest.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    query.awaitTermination()
    found = [(r.k, r.id) for r in spark.read.schema(latest.schema).parquet(out).collect()]
    return sorted(found, key=str), state_report(query)


def test_hours_close_and_late_rows_are_dropped(spark, rocksdb):
    source, out, state = (scratch_path(spark, n) for n in ("events", "latest", "state"))
    day = "2024-01-01 "
    got, _ = run(spark, source, out, state, [
        ("a", day + "10:10:00", 1, None), ("a", day + "10:50:00", 2, None), ("a", day + "10:20:00", 3, None),
        ("b", day + "11:05:00", 4, None), (None, day + "10:00:00", 5, None),
    ])
    assert got == []
    got, report = run(spark, source, out, state, [("a", day + "12:30:00", 6, None)])
    assert got == [("a", 2), (None, 5)]
    # Hours 11 and 12 are held: one value each, and no rows of closed hours.
    assert report[-1]["rows"] > 0 and report[-1]["bytes_per_row"] > 0
    # Row 7 belongs to a closed hour, row 8 to an open one: it comes after the highest time less the lateness.
    got, _ = run(spark, source, out, state, [("a", day + "10:59:00", 7, None), ("b", day + "11:50:00", 8, None)])
    assert got == [("a", 2), (None, 5)]
    got, report = run(spark, source, out, state, [("c", day + "15:00:00", 9, None)])
    assert got == [("a", 2), ("a", 6), ("b", 8), (None, 5)]


def test_ties_and_nulls(spark, rocksdb):
    source, out, state = (scratch_path(spark, n) for n in ("events", "latest", "state"))
    at = "2024-01-01 10:00:00"
    rows = [("a", at, 1, True), ("a", at, 3, None), ("a", at, 2, True), ("b", at, None, None), ("b", at, 0, False),
            ("c", at, 5, None), ("c", at, 5, False), ("z", "2024-01-01 14:00:00", 0, None)]
    run(spark, source, out, state, rows, carry=("id", "flag"))
    got, _ = run(spark, source, out, state, [("z", "2024-01-01 14:00:01", 0, None)], carry=("id", "flag"))
    assert got == [("a", 3), ("b", 0), ("c", 5)]
    flags = {r.k: r.flag for r in spark.read.parquet(out).collect()}
    assert flags["c"] is False and flags["b"] is False and flags["a"] is None
