"""Queries over tables of their own: folders of files, conversations with several answers."""

from pyspark.sql import functions as F

from askloom.session import scratch_path
from askloom.workload import QUERIES


def test_streams_read_a_table_that_is_a_folder_or_a_file(spark):
    sf = scratch_path(spark, "tables")
    docs = spark.createDataFrame([(i, f"text {i}", "en", "web") for i in range(6)], "doc_id long, text string, lang string, source string")
    docs.repartition(3).write.parquet(f"{sf}/documents.parquet")
    assert QUERIES["sync_index_stream"](spark, sf).count() == 6
    assert QUERIES["sync_index_stream"](spark, "/root/testdata/sf0.001").count() > 0
    events = spark.createDataFrame(
        [(i, i % 2, "click", f"2024-01-01 0{i}:00:00", 1.0) for i in range(8)],
        "event_id long, user_id long, event_type string, ts string, value double",
    )
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).repartition(3).write.parquet(f"{sf}/events.parquet")
    # Hours end an hour before the last event.
    assert QUERIES["dedup_latest_stream"](spark, sf).count() == 6


def test_every_answer_is_a_request_with_all_turns_before_it(spark):
    sf = scratch_path(spark, "tables")
    turns = [(1, t, "assistant" if t % 2 else "user", f"said {t}") for t in range(10)]
    turns += [(2, 0, "user", "hi"), (2, 1, "assistant", None), (10, 1, "assistant", "failed")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{sf}/conversations.parquet")
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    got = {r.request_id: r for r in QUERIES["request_log_flat"](spark, sf).collect()}
    assert {k: r.n_messages for k, r in got.items()} == {**{f"c1-{t}": t for t in (1, 3, 5, 7, 9)}, "c2-1": 1}
    assert got["c1-9"].roles == ",".join(r for c, _, r, _ in turns[:9]) and got["c2-1"].answer_md5 is None
    assert {r.request_id: r.last_input for r in QUERIES["last_input"](spark, sf).collect()}["c1-7"] == "said 6"
    assert {r.request_id: r.n_messages for r in QUERIES["chat_history"](spark, sf).collect()}["c1-7"] == 6
    ready = {r.request_id for r in QUERIES["review_ready"](spark, sf).collect()}
    waiting = {r.request_id for r in QUERIES["review_waiting"](spark, sf).collect()}
    assert ready == set(got) and waiting == {*(f"c1-{t}" for t in (0, 2, 4, 6, 8)), "c2-0", "c10-1"}
    assert {r.kind: r.n for r in QUERIES["payload_kinds"](spark, sf).collect()} == {"request": 6, "assessment": 3}


def test_texts_are_not_shuffled_for_a_search(spark):
    from askloom.operators.embedding import fit_embedder
    from askloom.operators.knn import knn_join
    from askloom.plans.answering import retrieve
    from askloom.plans.index import build_index, vector_rows

    rows = [(f"c{i % 30}", i, "web", f"word{i % 30} word{i % 30 % 7}") for i in range(40)]
    chunks = spark.createDataFrame(rows, "chunk_id string, doc_uri long, category string, chunk string").repartition(4)
    embedder = fit_embedder(chunks, "chunk")
    asked = build_index(chunks, embedder=embedder).select(F.col("chunk_id").alias("request_id"), "embedding")
    names = ["request_id", "chunk_id", "category", "doc_uri", "content", "score", "rank"]
    plain = retrieve(asked, build_index(chunks, embedder=embedder)).select(names)
    index = vector_rows(chunks, embedder=embedder)
    found = retrieve(asked, index, texts=chunks.select("chunk_id", F.col("chunk").alias("content"))).select(names)
    assert sorted(found.collect()) == sorted(plain.collect()) and found.count() > 30
    assert "content" not in index.columns
    # A few hits go to the index: its texts stay where they are.
    table = build_index(chunks, embedder=embedder).repartition("category")
    plan = knn_join(
        asked, table, query_key="request_id", query_vec="embedding", index_key="chunk_id", index_vec="embedding", index_cols=["content"],
    )._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_batches_for_python_are_bounded(spark):
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "100m")
    QUERIES["chunk_subwords"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8m"


def test_the_hourly_stream_stays_in_the_jvm(spark):
    from askloom.streaming.logs import latest_of_hour_stream

    stream = spark.readStream.format("rate").load().selectExpr("value AS id", "timestamp", "'a' AS k")
    plan = latest_of_hour_stream(stream, ["k"], carry=["id"])._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Aggregate" in plan
