"""Tables in versions, the stored index on top of them, and the index that follows a change log."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from askloom.plans.index import build_chunks, build_index, create_or_sync_index, stored_index
from askloom.session import scratch_path
from askloom.sources import versions
from askloom.sources.versions import (
    VersionConflict, create_version, drop_versions, read_version, replace_partitions, touched_prefixes, version_numbers,
    version_of,
)
from askloom.streaming.changes import apply_changes_batch, document_states, follow_changes, followed_index

ROWS = "k string, v int"
DOCS = "doc_uri string, category string, text string"


def lengths():
    return lambda texts: np.array([[len(t)] for t in texts])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_create_replace_read(spark):
    path = scratch_path(spark, "table")
    first = spark.createDataFrame([(f"k{i}", i) for i in range(200)] + [(None, -1)], ROWS)
    v1 = create_version(first, path, key="k", prefix_chars=1)
    assert v1.number == 1 and len(v1.folders) == 16 and rows(read_version(spark, v1)) == rows(first)
    with pytest.raises(VersionConflict):
        create_version(first, path, key="k")
    change = spark.createDataFrame([("k7", 0), (None, 0)], ROWS)
    touched = touched_prefixes(change, v1)
    v2 = replace_partitions(read_version(spark, v1, touched).withColumn("v", F.col("v") + 1000), v1, touched)
    assert {p for p in v2.folders if v2.folders[p] != v1.folders[p]} == set(touched)
    mark = versions.key_prefix(F.col("k"), 1).isin(touched)
    assert rows(read_version(spark, v2)) == rows(first.withColumn("v", F.when(mark, F.col("v") + 1000).otherwise(F.col("v"))))
    # The old version reads as before; the newest is the default.
    assert rows(read_version(spark, version_of(spark, path, 1))) == rows(first)
    assert version_of(spark, path) == v2
    # A partition may become empty, and all of them.
    v3 = replace_partitions(read_version(spark, v2).limit(0), v2, list(v2.folders))
    assert v3.folders == {} and read_version(spark, v3).schema == v1.schema and read_version(spark, v3).count() == 0


def test_only_one_of_two_writers_wins(spark):
    path = scratch_path(spark, "table")
    base = create_version(spark.createDataFrame([("a", 1), ("b", 2)], ROWS), path, key="k")
    one, two = (spark.createDataFrame([("a", v)], ROWS) for v in (10, 20))
    touched = touched_prefixes(one, base)
    after = replace_partitions(one, base, touched)
    with pytest.raises(VersionConflict):
        replace_partitions(two, base, touched)
    assert version_of(spark, path) == after and rows(read_version(spark, after)) == [("a", 10), ("b", 2)]


def test_a_writer_that_dies_changes_nothing(spark, monkeypatch):
    path = scratch_path(spark, "table")
    base = create_version(spark.createDataFrame([("a", 1)], ROWS), path, key="k")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", dies)
        with pytest.raises(RuntimeError):
            replace_partitions(spark.createDataFrame([("a", 2)], ROWS), base, touched_prefixes(read_version(spark, base), base))
    assert version_of(spark, path) == base and rows(read_version(spark, base)) == [("a", 1)]
    after = replace_partitions(spark.createDataFrame([("a", 3)], ROWS), base, list(base.folders))
    assert after.number == 2 and rows(read_version(spark, after)) == [("a", 3)]


def test_wrong_rows_are_refused(spark):
    path = scratch_path(spark, "table")
    base = create_version(spark.createDataFrame([("a", 1), ("b", 2)], ROWS), path, key="k", prefix_chars=1)
    with pytest.raises(ValueError):
        replace_partitions(spark.createDataFrame([("a",)], "k string"), base, list(base.folders))
    with pytest.raises(ValueError):
        replace_partitions(spark.createDataFrame([("b", 5)], ROWS), base, touched_prefixes(spark.createDataFrame([("a", 1)], ROWS), base))
    assert version_of(spark, path) == base


def test_old_versions_are_dropped(spark):
    path = scratch_path(spark, "table")
    now = create_version(spark.createDataFrame([("a", 1), ("b", 2)], ROWS), path, key="k")
    for v in (10, 20, 30):
        change = spark.createDataFrame([("a", v)], ROWS)
        now = replace_partitions(change, now, touched_prefixes(change, now))
    gone = drop_versions(spark, path, keep=2)
    # The folder of version 1 stays: it still holds the partition of b.
    assert len(gone) == 1 and gone[0].startswith("2-") and version_numbers(spark, path) == [3, 4]
    assert rows(read_version(spark, version_of(spark, path, 3))) == [("a", 20), ("b", 2)]
    assert rows(read_version(spark, now)) == [("a", 30), ("b", 2)]
    with pytest.raises(ValueError):
        drop_versions(spark, path, keep=0)
    assert version_of(spark, scratch_path(spark, "none")) is None


def docs(spark, *found):
    return spark.createDataFrame(list(found), DOCS)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_create_or_sync_index(spark):
    path = scratch_path(spark, "index")
    states = [
        docs(spark, ("d1", "a", "one two"), ("d2", "a", "same"), ("d3", "b", "gone")),
        docs(spark, ("d1", "z", "one two"), ("d0", "b", "same"), ("d2", "a", "same"), ("d4", "c", "new text")),
        docs(spark, ("d4", "c", "new text")),
    ]
    for n, state in enumerate(states, 1):
        version = create_or_sync_index(spark, build_chunks(state, "text"), path, embedder=lengths)
        assert version.number == n
        want = build_index(build_chunks(state, "text"), embedder=lengths)
        assert rows(stored_index(spark, path).select(*want.columns)) == rows(want)
    for n, state in enumerate(states, 1):
        want = build_index(build_chunks(state, "text"), embedder=lengths)
        assert rows(stored_index(spark, path, n).select(*want.columns)) == rows(want)
    before = files(path)
    again = create_or_sync_index(spark, build_chunks(states[-1], "text"), path, embedder=lengths)
    assert again.number == 3 and files(path) == before
    with pytest.raises(FileNotFoundError):
        stored_index(spark, scratch_path(spark, "none"))


def test_a_sync_rewrites_and_embeds_only_what_changed(spark):
    path, calls = scratch_path(spark, "index"), spark.sparkContext.accumulator(0)

    def counted():
        def vectors(texts):
            calls.add(len(texts))
            return np.array([[len(t)] for t in texts])

        return vectors

    many = docs(spark, *((f"d{i}", "a", f"text number {i}") for i in range(300)))
    one = create_or_sync_index(spark, build_chunks(many, "text"), path, embedder=counted)
    before, calls.value = files(path), 0
    edited = many.withColumn("text", F.when(F.col("doc_uri") == "d5", "edited").otherwise(F.col("text")))
    two = create_or_sync_index(spark, build_chunks(edited, "text"), path, embedder=counted)
    changed = {p for p in one.folders.keys() | two.folders.keys() if one.folders.get(p) != two.folders.get(p)}
    assert 1 <= len(changed) <= 2 and before < files(path) and calls.value == 1
    assert stored_index(spark, path).count() == 300


LOG = "doc_uri string, doc_version long, deleted boolean, category string, _text string"


def apply(spark, path, *found):
    return apply_changes_batch(spark.createDataFrame(list(found), LOG), path, embedder=lengths)


def contents(spark, path):
    return sorted((r.doc_uri, r.category, r.content) for r in followed_index(spark, path).collect())


def test_changes_in_any_order(spark):
    path = scratch_path(spark, "index")
    apply(spark, path, ("a", 1, False, "x", "same"), ("b", 1, False, "y", "same"), ("c", 5, False, "x", "late"), ("c", 2, False, "x", "early"))
    assert contents(spark, path) == [("a", "x", "same"), ("c", "x", "late")]
    # The chunk that a and b share stays with b; an older change of c is ignored.
    apply(spark, path, ("a", 2, True, None, None), ("c", 3, True, None, None))
    assert contents(spark, path) == [("b", "y", "same"), ("c", "x", "late")]
    # Nothing older brings a back; the same version again changes nothing.
    assert apply(spark, path, ("a", 1, False, "x", "back"), ("b", 1, False, "z", "other")).number == 2
    apply(spark, path, ("a", 3, False, "w", "back"), ("b", 2, False, "y", ""), ("n", 1, False, "y", None))
    assert contents(spark, path) == [("a", "w", "back"), ("c", "x", "late")]
    assert rows(document_states(spark, path)) == [("a", 3, False), ("b", 2, False), ("c", 5, False), ("n", 1, False)]
    # At equal versions the delete wins.
    apply(spark, path, ("q", 1, False, "x", "q"), ("q", 1, True, None, None), ("q", 1, False, "x", "q"))
    assert ("q", 1, True) in rows(document_states(spark, path)) and len(contents(spark, path)) == 2


def test_stream_of_changes_and_replay(spark):
    source, path, state = (scratch_path(spark, n) for n in ("log", "index", "state"))
    schema = "doc_uri string, version long, op string, category string, text string"

    def run(checkpoint, *found):
        if found:
            spark.createDataFrame(list(found), schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        follow_changes(stream, path, checkpoint, text_col="text", embedder=lengths, size=2, overlap=0).awaitTermination()
        return contents(spark, path)

    first = run(state, ("a", 1, "insert", "x", "one two three"), ("b", 1, None, "x", "gone"), (None, 1, "insert", "x", "no id"))
    assert first == [("a", "x", "one two"), ("a", "x", "three"), ("b", "x", "gone")]
    second = run(state, ("a", 2, "update", "z", "one two four"), ("b", 2, "delete", None, None))
    assert second == [("a", "z", "four"), ("a", "z", "one two")]
    number = version_of(spark, path).number
    assert run(state) == second and run(scratch_path(spark, "state")) == second  # nothing new; all of it again
    assert version_of(spark, path).number == number
    assert [(r.doc_uri, r.content) for r in followed_index(spark, path, 1).where("doc_uri = 'b'").collect()] == [("b", "gone")]
    with pytest.raises(ValueError):
        follow_changes(None, "", "", text_col="", embedder=None)
