import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from askloom.operators.diff import apply_changes, snapshot_diff
from askloom.plans.index import build_chunks, build_index, sync_index
from askloom.session import scratch_path
from askloom.streaming.logs import dedup_latest_stream
from askloom.streaming.sync import compact_index, read_index, sync_index_stream

DOCS = "doc_uri string, category string, text string"


def lengths():
    return lambda texts: np.array([[len(t)] for t in texts])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_diff_of_known_rows(spark):
    schema = "k int, a string, b array<int>"
    old = spark.createDataFrame([(1, "x", [1]), (2, "y", None), (3, None, [3])], schema)
    new = spark.createDataFrame([(1, "x", [1]), (2, "y", [2]), (4, "z", [4])], schema)
    diff = snapshot_diff(old, new, key="k")
    assert rows(diff) == [(2, "update", "y", [2]), (3, "delete", None, None), (4, "insert", "z", [4])]
    assert rows(apply_changes(old, diff, key="k")) == rows(new)
    assert snapshot_diff(old, new, key="k", compare=["a"]).where("op = 'update'").count() == 0


def test_null_and_text_null_differ(spark):
    old = spark.createDataFrame([(1, None)], "k int, a string")
    new = spark.createDataFrame([(1, "null")], "k int, a string")
    assert snapshot_diff(old, new, key="k").first().op == "update"


def test_applying_a_diff_gives_the_new_table(spark):
    table = st.dictionaries(st.integers(0, 20), st.sampled_from([None, "a", "b"]), max_size=15)

    @settings(max_examples=8, deadline=None)
    @given(table, table)
    def check(a, b):
        old = spark.createDataFrame(list(a.items()), "k int, v string")
        new = spark.createDataFrame(list(b.items()), "k int, v string")
        assert rows(apply_changes(old, snapshot_diff(old, new, key="k"), key="k")) == rows(new)

    check()


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOCS)


def test_sync_index(spark):
    before = docs(spark, ("d1", "a", "one two"), ("d2", "a", "same"), ("d3", "b", "gone"))
    after = docs(spark, ("d1", "z", "one two"), ("d0", "b", "same"), ("d2", "a", "same"), ("d4", "c", "new text"))
    index = build_index(build_chunks(before, "text"), embedder=lengths)
    synced = sync_index(index, build_chunks(after, "text"), embedder=lengths)
    assert rows(synced) == rows(build_index(build_chunks(after, "text"), embedder=lengths))
    assert rows(synced.select("doc_uri", "content", "category")) == [
        ("d0", "same", "b"), ("d1", "one two", "z"), ("d4", "new text", "c")
    ]
    again = sync_index(synced, build_chunks(after, "text"), embedder=lengths)
    assert rows(again) == rows(synced)


def run(spark, source, index, state):
    stream = spark.readStream.schema(DOCS).parquet(source)
    sync_index_stream(
        stream, index, state, text_col="text", uri_col="doc_uri", category_col="category",
        embedder=lengths,
    ).awaitTermination()


def test_stream_sync(spark):
    source, index, state = (scratch_path(spark, n) for n in ("docs", "index", "state"))
    first = docs(spark, ("d5", "a", "same"), ("d6", "a", "one"))
    first.write.parquet(source)
    run(spark, source, index, state)
    assert read_index(spark, index).count() == 2
    second = docs(spark, ("d1", "b", "same"), ("d7", "a", "two words"))
    second.write.mode("append").parquet(source)
    run(spark, source, index, state)
    whole = build_index(build_chunks(first.union(second), "text"), embedder=lengths)
    assert rows(read_index(spark, index).select(*whole.columns)) == rows(whole)
    run(spark, source, index, state)  # nothing new
    assert read_index(spark, index).count() == 3
    target = scratch_path(spark, "compact")
    compact_index(spark, index, target)
    assert rows(read_index(spark, target)) == rows(read_index(spark, index))


def test_a_replayed_batch_changes_nothing(spark):
    source, index, state = (scratch_path(spark, n) for n in ("docs", "index", "state"))
    docs(spark, ("d1", "a", "x"), ("d2", "a", "y z")).write.parquet(source)
    run(spark, source, index, state)
    before = rows(read_index(spark, index))
    run(spark, source, index, scratch_path(spark, "state"))  # as if the commit had been lost
    assert rows(read_index(spark, index)) == before


def test_stream_needs_an_embedder(spark):
    with pytest.raises(ValueError):
        sync_index_stream(None, "", "", text_col="", uri_col="", category_col="", embedder=None)


def test_late_rows_and_open_hours(spark):
    source, out, state = (scratch_path(spark, n) for n in ("events", "latest", "state"))
    schema = "k string, t string, v int"

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source).withColumn("timestamp", F.to_timestamp("t"))
        latest = dedup_latest_stream(stream, ["k"], lateness="1 hour").drop("timestamp")
        latest.writeStream.format("parquet").option("checkpointLocation", state).trigger(
            availableNow=True).start(out).awaitTermination()
        return sorted(r.v for r in spark.read.schema(schema).parquet(out).collect())

    assert arrive(("a", "2024-01-01 10:10:00", 1), ("a", "2024-01-01 10:50:00", 2),
                  ("b", "2024-01-01 11:05:00", 3)) == []
    assert arrive(("a", "2024-01-01 12:30:00", 4)) == [2]
    # The hour of row 5 is closed by now, that of row 6 is not.
    assert arrive(("a", "2024-01-01 10:59:00", 5), ("b", "2024-01-01 11:50:00", 6)) == [2]
    assert arrive(("c", "2024-01-01 15:00:00", 7)) == [2, 4, 6]
