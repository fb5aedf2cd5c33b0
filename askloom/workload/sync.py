"""Incremental queries: snapshots, index synchronisation and the streaming forms."""

import numpy as np
from pyspark.sql import functions as F

from askloom.operators.diff import apply_changes, snapshot_diff
from askloom.operators.payloads import unpack_payloads
from askloom.plans.index import build_chunks, build_index, create_or_sync_index, stored_index, sync_index
from askloom.session import cut, scratch_path
from askloom.sources.versions import version_of
from askloom.streaming.changes import document_states, follow_changes, followed_index
from askloom.streaming.logs import dedup_latest_stream, latest_of_hour_stream, use_rocksdb_state
from askloom.streaming.sync import read_index, sync_index_stream
from askloom.workload.chunks import UNIQUE, chunks_sql
from askloom.workload.logs import ASSESSMENTS, LOG_OUT, _flat, payload_log
from askloom.workload.registry import load, query


def _snapshots(spark, sf):
    """The documents, and the same table with all numbers moved up by ten."""
    old = load(spark, sf, "documents").select("doc_id", "lang", "source")
    return old, old.withColumn("doc_id", F.col("doc_id") + 10)


@query("snapshot_diff", """
    WITH new AS (SELECT doc_id + 10 AS doc_id, lang, source FROM documents)
    SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
      CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END
        AS op, n.lang, n.source
    FROM documents o FULL JOIN new n ON o.doc_id = n.doc_id
    WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.lang <> n.lang OR o.source <> n.source""")
def q_snapshot_diff(spark, sf):
    old, new = _snapshots(spark, sf)
    return snapshot_diff(old, new, key="doc_id")


@query("apply_changes", "SELECT doc_id + 10 AS doc_id, lang, source FROM documents")
def q_apply_changes(spark, sf):
    old, new = _snapshots(spark, sf)
    return apply_changes(old, snapshot_diff(old, new, key="doc_id"), key="doc_id")


def size_vectors():
    """Offline stand-in for an embedding model: characters and blanks of the text."""
    return lambda texts: np.array([[len(t), t.count(" ")] for t in texts], dtype=np.float32)


COLUMNS = ["chunk_id", "doc_uri", "category"]


def _vectors_out(index):
    return index.select(
        *COLUMNS, F.col("embedding")[0].cast("bigint").alias("n_chars"),
        F.col("embedding")[1].cast("bigint").alias("n_blanks"),
    )


VECTORS = """length(content) AS n_chars,
      length(content) - length(replace(content, ' ', '')) AS n_blanks"""


@query("sync_index", f"""
    WITH sources AS (
      SELECT 'd' || doc_id AS uri, CASE WHEN lang = 'en' THEN lang ELSE source END AS category, text
      FROM documents
      UNION ALL SELECT 'b' || item_id, 'benchmark', text FROM benchmark),
    {chunks_sql("sources", "uri", "text", 300, 100, ", category").replace("WITH", "", 1)},
    uniq AS (
      SELECT chunk_id, uri AS doc_uri, category, chunk AS content FROM (
        SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY uri, category, chunk_no) AS rn
        FROM chunks) WHERE rn = 1)
    SELECT chunk_id, doc_uri, category, {VECTORS} FROM uniq""")
def q_sync_index(spark, sf):
    """From documents and pages to documents and benchmark texts, some of a new category."""
    docs = load(spark, sf, "documents")
    uri = F.concat(F.lit("d"), "doc_id").alias("doc_uri")
    category = F.when(F.col("lang") == "en", F.col("lang")).otherwise(F.col("source"))
    pages = load(spark, sf, "pages").select(
        F.concat(F.lit("p"), "page_id"), F.lit("pages"), "html"
    )
    texts = load(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), "item_id"), F.lit("benchmark"), "text"
    )
    before = docs.select(uri, F.col("source").alias("category"), "text").union(pages)
    now = docs.select(uri, category.alias("category"), "text").union(texts)
    index = cut(build_index(build_chunks(before, "text"), embedder=size_vectors))
    return _vectors_out(sync_index(index, build_chunks(now, "text"), embedder=size_vectors))


def _index_sql(version: int, docs: str) -> str:
    """``SELECT`` of the index rows of a document set ``uri, category, text`` under a version number."""
    return f"""
    SELECT CAST({version} AS INT) AS version, chunk_id, doc_uri, category, {VECTORS} FROM (
      {chunks_sql(docs, "uri", "text", 300, 100, ", category")}
      SELECT chunk_id, uri AS doc_uri, category, chunk AS content FROM (
        SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY uri, category, chunk_no) AS rn
        FROM chunks) WHERE rn = 1)"""


BEFORE = "(SELECT 'd' || doc_id AS uri, source AS category, text FROM documents)"
AFTER = """(
      SELECT 'd' || doc_id AS uri, CASE WHEN doc_id % 50 = 1 THEN 'moved' ELSE source END AS category,
        CASE WHEN doc_id % 50 = 2 THEN 'Edited. ' || text ELSE text END AS text
      FROM documents WHERE doc_id % 50 <> 3
      UNION ALL SELECT 'b' || item_id, 'benchmark', text FROM benchmark)"""


@query("index_create_sync", " UNION ALL ".join(_index_sql(v, d) for v, d in [(1, BEFORE), (2, AFTER)]))
def q_index_create_sync(spark, sf):
    """Create the stored index, change documents, sync, sync again; both versions as they read then."""
    docs = load(spark, sf, "documents")
    uri = F.concat(F.lit("d"), "doc_id").alias("doc_uri")
    before = docs.select(uri, F.col("source").alias("category"), "text")
    nth = F.col("doc_id") % 50
    after = docs.where(nth != 3).select(
        uri, F.when(nth == 1, "moved").otherwise(F.col("source")).alias("category"),
        F.when(nth == 2, F.concat(F.lit("Edited. "), "text")).otherwise(F.col("text")).alias("text"),
    ).union(load(spark, sf, "benchmark").select(F.concat(F.lit("b"), "item_id"), F.lit("benchmark"), "text"))
    path = scratch_path(spark, "stored-index")
    for state in (before, after, after):
        create_or_sync_index(spark, build_chunks(state, "text"), path, embedder=size_vectors)
    versions = [
        stored_index(spark, path, n).withColumn("version", F.lit(n)) for n in range(1, version_of(spark, path).number + 1)
    ]
    both = versions[0]
    for later in versions[1:]:
        both = both.unionByName(later)
    return both.select(
        "version", *COLUMNS, F.col("embedding")[0].cast("bigint").alias("n_chars"),
        F.col("embedding")[1].cast("bigint").alias("n_blanks"),
    )


def change_log(spark, sf):
    """Three batches: all documents; edits, deletes and a change that comes too late; some come back."""
    docs = load(spark, sf, "documents")
    n = F.col("doc_id")

    def batch(rows, number, version, op="upsert", text=F.col("text"), category=F.col("source")):
        return rows.select(
            F.lit(number).alias("batch"), F.concat(F.lit("d"), n).alias("doc_uri"), F.lit(version).cast("bigint").alias("version"),
            F.lit(op).alias("op"), category.alias("category"), text.alias("text"),
        )

    parts = [
        batch(docs, 0, 1),
        batch(docs.where(n % 7 == 3), 1, 2, text=F.concat(F.lit("New: "), "text"), category=F.col("lang")),
        batch(docs.where(n % 7 == 3), 1, 3, text=F.concat(F.lit("Newer: "), "text"), category=F.col("lang")),
        batch(docs.where(n % 11 == 5), 1, 4, "delete", text=F.lit(None).cast("string")),
        batch(docs.where(n % 13 == 1), 1, 0, text=F.lit("too late")),
        batch(docs.where(n % 22 == 5), 2, 5, text=F.concat(F.lit("Back: "), "text")),
        batch(docs.where(n % 11 == 5), 2, 2, text=F.lit("older than the delete")),
    ]
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    return log


def _follow(spark, sf):
    """Run the log through the stream, one batch after the other."""
    arrived, path, state = (scratch_path(spark, n) for n in ("changes", "followed-index", "state"))
    log = change_log(spark, sf)
    for number in range(3):
        log.where(F.col("batch") == number).drop("batch").write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(log.drop("batch").schema).parquet(arrived)
        follow_changes(stream, path, state, text_col="text", embedder=size_vectors).awaitTermination()
    return path


STATES = """(
      SELECT 'd' || doc_id AS uri, doc_id,
        CASE WHEN doc_id % 22 = 5 THEN 5 WHEN doc_id % 11 = 5 THEN 4 WHEN doc_id % 7 = 3 THEN 3 ELSE 1 END AS version,
        doc_id % 11 = 5 AND doc_id % 22 <> 5 AS deleted,
        CASE WHEN doc_id % 11 <> 5 AND doc_id % 7 = 3 THEN lang ELSE source END AS category,
        CASE WHEN doc_id % 22 = 5 THEN 'Back: ' WHEN doc_id % 7 = 3 THEN 'Newer: ' ELSE '' END || text AS text
      FROM documents)"""


@query("index_change_stream", f"""
    SELECT * EXCLUDE version FROM ({_index_sql(1, f"(SELECT * FROM {STATES} WHERE NOT deleted)")})""")
def q_index_change_stream(spark, sf):
    return _vectors_out(followed_index(spark, _follow(spark, sf)))


@query("index_change_states", f"SELECT uri AS doc_uri, CAST(version AS BIGINT) AS doc_version, deleted FROM {STATES}")
def q_index_change_states(spark, sf):
    return document_states(spark, _follow(spark, sf))


def table_stream(spark, sf, table):
    """A table as a stream of its files, be it one file or a folder of them; a plain path has to be a folder, a pattern may match either."""
    return spark.readStream.schema(load(spark, sf, table).schema).parquet(f"{sf}/{table}.parque[t]")


@query("sync_index_stream", UNIQUE + f"""
    SELECT chunk_id, doc_uri, category, {VECTORS} FROM uniq""")
def q_sync_index_stream(spark, sf):
    docs = table_stream(spark, sf, "documents")
    target, state = scratch_path(spark, "index"), scratch_path(spark, "state")
    sync_index_stream(
        docs, target, state, text_col="text", uri_col="doc_id", category_col="source",
        embedder=size_vectors,
    ).awaitTermination()
    return _vectors_out(read_index(spark, target))


def _run_to_files(spark, stream, name):
    """Run a stream over what is there now and read back what it wrote."""
    target, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(
        availableNow=True
    ).start(target).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


@query("unpack_stream", ASSESSMENTS + LOG_OUT + "log")
def q_unpack_stream(spark, sf):
    arrived = scratch_path(spark, "payloads")
    log = payload_log(spark, sf)
    log.write.parquet(arrived)
    stream = spark.readStream.schema(log.schema).parquet(arrived)
    return _flat(_run_to_files(spark, unpack_payloads(stream).assessment_log, "assessments"))


@query("dedup_latest_stream", """
    WITH closed AS (
      SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
      FROM events
      WHERE epoch_ms(date_trunc('hour', ts)) + 3600000
        <= (SELECT epoch_ms(max(ts)) - 3600000 FROM events))
    SELECT event_id, user_id, event_type, epoch_us(ts) AS us, value FROM closed WHERE rn = 1""")
def q_dedup_latest_stream(spark, sf):
    stream = table_stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    latest = dedup_latest_stream(
        stream, ["user_id", "event_type"], ts="ts", lateness="1 hour", tie=[F.col("event_id")]
    )
    out = _run_to_files(spark, latest, "latest")
    return out.select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("us"), "value")


@query("latest_of_hour_stream", """
    WITH placed AS (
      SELECT event_id, user_id, event_type, ts, date_trunc('hour', ts) AS h, event_id % 10 = 7 AS late FROM events),
    marks AS (
      SELECT epoch_ms(max(ts)) - 3600000 AS all_rows, epoch_ms(max(ts) FILTER (NOT late)) - 3600000 AS first_rows FROM placed),
    taken AS (
      -- Late rows count as far as their hour was open when they came.
      SELECT * FROM placed, marks WHERE NOT late OR epoch_ms(h) + 3600000 > first_rows),
    best AS (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type, h ORDER BY ts DESC, event_id DESC) AS rn
      FROM taken WHERE epoch_ms(h) + 3600000 <= all_rows)
    SELECT user_id, event_type, event_id, epoch_us(ts) AS us FROM best WHERE rn = 1""")
def q_latest_of_hour_stream(spark, sf):
    """A tenth of the events comes a batch later than the rest, most of it too late."""
    use_rocksdb_state(spark)
    events = load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.col("event_id") % 10 == 7
    arrived, target, state = (scratch_path(spark, n) for n in ("events", "latest", "state"))
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(events.schema).parquet(arrived)
        latest = latest_of_hour_stream(stream, ["user_id", "event_type"], ts="ts", carry=["event_id"])
        latest.writeStream.format("parquet").option("checkpointLocation", state).trigger(
            availableNow=True
        ).start(target).awaitTermination()
    return spark.read.schema(latest.schema).parquet(target)
