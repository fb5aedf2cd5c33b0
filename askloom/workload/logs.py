"""Payload log queries. Payloads are made from the conversations and labels tables."""

from pyspark.sql import DataFrame, functions as F

from askloom.functions.messages import chat_history, last_message, trace_bounds
from askloom.operators.keys import dedup_latest
from askloom.operators.payloads import dedup_assessments, pending_reviews, unpack_payloads
from askloom.plans.logs import write_logs
from askloom.session import cut
from askloom.workload.registry import load, query, scratch_schema

EPOCH_MS = 1704067200000  # 2024-01-01 UTC


def request_payloads(spark, sf) -> DataFrame:
    """One payload per answer of the assistant, whose request holds all turns before it.

    A payload is one text, so a conversation comes together whole.
    """
    turns = load(spark, sf, "conversations")
    message = F.struct(F.col("turn").alias("said"), "role", F.col("text").alias("content"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("said"))
    answers = F.expr("filter(said, m -> m.role = 'assistant')")
    grouped = whole.withColumn("own", F.explode(answers)).select(
        "conv_id", F.col("own.said").alias("turn"), F.col("own.content").alias("answer"),
        F.expr("filter(said, m -> m.said < own.said)").alias("said"),
    )
    ms = F.lit(EPOCH_MS) + F.col("conv_id") * 60000 + F.col("turn") * 1001
    at = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    later = F.date_format(F.timestamp_millis(ms + 250), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    step = F.struct(
        F.lit("s0").alias("step_id"), F.lit("generate").alias("name"), F.lit("LLM").alias("type"),
        at.alias("start_timestamp"), later.alias("end_timestamp"),
        F.struct(F.lit("p").alias("prompt"), F.col("answer").alias("generated_text"))
        .alias("text_generation"),
    )
    messages = F.transform("said", lambda m: F.struct(m["role"].alias("role"),
                                                      m["content"].alias("content")))
    conversation = F.struct(F.concat(F.lit("conv-"), "conv_id").alias("conversation_id"))
    return grouped.select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("request_id"),
        F.when(F.col("conv_id") % 10 == 0, "500").otherwise("200").alias("status_code"),
        ms.alias("timestamp_ms"),
        F.to_json(F.struct(messages.alias("messages"), conversation.alias("options")))
        .alias("request"),
        F.to_json(
            F.struct(
                F.array(F.struct(F.struct(F.lit("assistant").alias("role"),
                                          F.col("answer").alias("content")).alias("message")))
                .alias("choices"),
                F.struct(F.struct(F.lit("v1").alias("app_version_id"),
                                  F.lit(False).alias("is_truncated"),
                                  F.array(step).alias("steps")).alias("trace")).alias("output"),
            )
        ).alias("response"),
    )


def assessment_payloads(spark, sf) -> DataFrame:
    """Three payloads per label, the later ones correcting the first; some of them malformed."""
    labels = load(spark, sf, "labels").withColumn("n", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    doc = F.col("doc_id")
    good = (F.col("quality") == 1) == (F.col("n") != 1)
    rating = F.create_map(
        F.lit("answer_good"),
        F.struct(good.alias("value"), F.concat(F.lit("no "), "n").alias("rationale")),
        F.lit("harmful"),
        F.struct((F.col("toxic") == 1).alias("value"), F.lit(None).cast("string").alias("rationale")),
    )
    text = F.array(
        F.struct(
            F.lit("s1").alias("step_id"), rating.alias("ratings"),
            F.concat(F.lit("try "), "n").alias("free_text_comment"),
            F.lit("better").alias("suggested_output"),
        )
    )
    found = F.transform(
        F.sequence(F.lit(0), F.col("quality")),
        lambda p: F.struct(
            p.alias("position"), F.lit("s0").alias("step_id"), rating.alias("ratings"),
            F.lit(None).cast("string").alias("free_text_comment"),
        ),
    )
    record = F.struct(
        F.concat(F.lit("d"), doc).alias("request_id"), F.lit("s1").alias("step_id"),
        F.struct(
            F.lit("human").alias("type"),
            F.when(doc % 5 != 0, F.concat(F.lit("u"), doc % 7)).alias("id"),
            F.create_map(F.lit("team"), F.lit("a")).alias("tags"),
        ).alias("source"),
        F.when(doc % 4 != 1, text).alias("text_assessments"),
        F.when(doc % 3 != 1, found).alias("retrieval_assessments"),
    )
    request = (
        F.when(doc % 11 == 0, F.lit("not json"))
        .when(doc % 9 == 0, F.lit('{"dataframe_records":[]}'))
        .otherwise(F.to_json(F.struct(F.array(record).alias("dataframe_records"))))
    )
    # The first two fall into one hour, the third into the next.
    ms = F.lit(EPOCH_MS) + doc * 3600000 + F.col("n") * 1700000
    return labels.select(
        F.concat(F.lit("a"), doc, F.lit("-"), "n").alias("request_id"),
        F.lit("200").alias("status_code"), ms.alias("timestamp_ms"), request.alias("request"),
        F.lit('{"choices":null,"result":"ok"}').alias("response"),
    )


def payload_log(spark, sf) -> DataFrame:
    return request_payloads(spark, sf).unionByName(assessment_payloads(spark, sf))


REQUESTS = f"""
    WITH req AS (
      SELECT 'c' || conv_id || '-' || turn AS request_id, conv_id, turn, text AS answer,
        {EPOCH_MS} + conv_id * 60000 + turn * 1001 AS ms
      FROM conversations WHERE role = 'assistant' AND conv_id % 10 <> 0),
    msg AS (
      SELECT r.request_id, r.turn, c.turn AS said, c.role, c.text
      FROM req r JOIN conversations c ON c.conv_id = r.conv_id AND c.turn < r.turn)"""


@query("request_log_flat", REQUESTS + """,
    agg AS (
      SELECT request_id, count(*) AS n_messages, string_agg(role, ',' ORDER BY said) AS roles,
        arg_max(text, said) AS last_input FROM msg GROUP BY request_id)
    SELECT r.request_id, 'conv-' || r.conv_id AS conversation_id, r.ms,
      coalesce(a.n_messages, 0) AS n_messages, coalesce(a.roles, '') AS roles,
      md5(a.last_input) AS last_input_md5, md5(r.answer) AS answer_md5,
      'v1' AS app_version_id, md5(r.answer) AS generated_md5, 1 AS n_choices
    FROM req r LEFT JOIN agg a USING (request_id)""")
def q_request_log_flat(spark, sf):
    log = unpack_payloads(payload_log(spark, sf)).request_log
    return log.select(
        "request.request_id", "request.conversation_id",
        F.unix_millis("request.timestamp").alias("ms"),
        F.size("request.messages").cast("bigint").alias("n_messages"),
        F.array_join(F.col("request.messages")["role"], ",").alias("roles"),
        F.md5("request.last_input").alias("last_input_md5"),
        F.md5(F.col("output.choices")[0]["message"]["content"]).alias("answer_md5"),
        "trace.app_version_id",
        F.md5(F.col("trace.steps")[0]["text_generation"]["generated_text"]).alias("generated_md5"),
        F.size("output.choices").alias("n_choices"),
    )


@query("last_input", REQUESTS + """
    SELECT r.request_id, arg_max(m.text, m.said) AS last_input
    FROM req r LEFT JOIN msg m USING (request_id) GROUP BY r.request_id""")
def q_last_input(spark, sf):
    log = unpack_payloads(payload_log(spark, sf)).request_log
    return log.select("request.request_id", last_message(F.col("request.messages")).alias("last_input"))


@query("chat_history", REQUESTS + """,
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY said DESC) AS back FROM msg)
    SELECT r.request_id, count(m.text) AS n_messages,
      coalesce(md5(string_agg(m.text, chr(10) ORDER BY m.said)), md5('')) AS history_md5
    FROM req r LEFT JOIN numbered m ON m.request_id = r.request_id AND m.back > 1
    GROUP BY r.request_id""")
def q_chat_history(spark, sf):
    log = unpack_payloads(payload_log(spark, sf)).request_log
    history = chat_history(F.col("request.messages"))
    return log.select(
        "request.request_id", F.size(history).cast("bigint").alias("n_messages"),
        F.md5(F.array_join(history["content"], "\n")).alias("history_md5"),
    )


@query("trace_bounds", REQUESTS + """
    SELECT request_id, ms AS start_ms, ms + 250 AS end_ms FROM req""")
def q_trace_bounds(spark, sf):
    log = unpack_payloads(payload_log(spark, sf)).request_log
    bounds = log.select("request.request_id", trace_bounds(F.col("trace.steps")).alias("b"))
    return bounds.select(
        "request_id", F.unix_millis("b.start_timestamp").alias("start_ms"),
        F.unix_millis("b.end_timestamp").alias("end_ms"),
    )


@query("payload_kinds", """
    SELECT 'request' AS kind, count(*) AS n FROM conversations
      WHERE role = 'assistant' AND conv_id % 10 <> 0
    UNION ALL
    SELECT 'assessment', 3 * count(*) FROM labels""")
def q_payload_kinds(spark, sf):
    from askloom.operators.payloads import parse_payloads

    parsed = parse_payloads(payload_log(spark, sf))
    kind = F.when(F.col("choices").isNotNull(), "request").otherwise("assessment")
    return parsed.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


ASSESSMENTS = f"""
    WITH sent AS (
      SELECT doc_id, quality, toxic, n, {EPOCH_MS} + doc_id * 3600000 + n * 1700000 AS ms,
        'd' || doc_id AS request_id,
        CASE WHEN doc_id % 5 <> 0 THEN 'u' || (doc_id % 7) END AS reviewer,
        (quality = 1) = (n <> 1) AS good
      FROM labels, range(3) AS r(n)
      WHERE doc_id % 11 <> 0 AND doc_id % 9 <> 0),
    log AS (
      SELECT request_id, 's1' AS step_id, reviewer, ms, CAST(NULL AS INT) AS position, 'text' AS kind,
        good, toxic = 1 AS harmful, n, 'try ' || n AS comment
      FROM sent WHERE doc_id % 4 <> 1
      UNION ALL
      SELECT request_id, 's0', reviewer, ms, CAST(p AS INT), 'retrieval', good, toxic = 1, n, NULL
      FROM sent, range(2) AS q(p) WHERE doc_id % 3 <> 1 AND p <= quality)"""
LOG_OUT = """
    SELECT request_id, step_id, reviewer, ms, position, kind, good, harmful,
      'no ' || n AS rationale, comment FROM """


def _flat(log: DataFrame) -> DataFrame:
    text = F.col("text_assessment").isNotNull()
    ratings = F.coalesce("text_assessment.ratings", "retrieval_assessment.ratings")
    return log.select(
        "request_id", "step_id", F.col("source.id").alias("reviewer"),
        F.unix_millis("timestamp").alias("ms"), "retrieval_assessment.position",
        F.when(text, "text").otherwise("retrieval").alias("kind"),
        ratings["answer_good"]["bool_value"].alias("good"),
        ratings["harmful"]["bool_value"].alias("harmful"),
        ratings["answer_good"]["rationale"].alias("rationale"),
        F.coalesce("text_assessment.free_text_comment", "retrieval_assessment.free_text_comment")
        .alias("comment"),
    )


@query("assessment_unpack", ASSESSMENTS + LOG_OUT + "log")
def q_assessment_unpack(spark, sf):
    return _flat(unpack_payloads(payload_log(spark, sf)).assessment_log)


@query("assessment_dedup_hour", ASSESSMENTS + """,
    best AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (
          PARTITION BY request_id, step_id, reviewer, position, kind, ms // 3600000
          ORDER BY ms DESC) AS rn
        FROM log) WHERE rn = 1)""" + LOG_OUT + "best")
def q_assessment_dedup_hour(spark, sf):
    return _flat(dedup_assessments(unpack_payloads(payload_log(spark, sf)).assessment_log, "hour"))


@query("assessment_dedup_all", ASSESSMENTS + """,
    best AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (
          PARTITION BY request_id, step_id, reviewer, position, kind ORDER BY ms DESC) AS rn
        FROM log) WHERE rn = 1)""" + LOG_OUT + "best")
def q_assessment_dedup_all(spark, sf):
    return _flat(dedup_assessments(unpack_payloads(payload_log(spark, sf)).assessment_log))


@query("payload_rejects", f"""
    SELECT 'a' || doc_id || '-' || n AS request_id, {EPOCH_MS} + doc_id * 3600000 + n * 1700000 AS ms
    FROM labels, range(3) AS r(n)
    WHERE doc_id % 11 = 0 OR doc_id % 9 = 0 OR (doc_id % 4 = 1 AND doc_id % 3 = 1)""")
def q_payload_rejects(spark, sf):
    rejects = unpack_payloads(payload_log(spark, sf)).rejects
    return rejects.select("request_id", F.unix_millis("timestamp").alias("ms"))


def _reviews(spark, sf):
    """Ask for a review of every turn: those of users and of failed requests are not logged."""
    asked = load(spark, sf, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("request_id")
    )
    return pending_reviews(asked, unpack_payloads(payload_log(spark, sf)).request_log)


@query("review_ready", REQUESTS + "SELECT request_id FROM req")
def q_review_ready(spark, sf):
    return _reviews(spark, sf)[0]


@query("review_waiting", REQUESTS + """
    SELECT 'c' || conv_id || '-' || turn AS request_id FROM conversations
    EXCEPT SELECT request_id FROM req""")
def q_review_waiting(spark, sf):
    return _reviews(spark, sf)[1]


BEST_OF_HOUR = """,
    best AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (
          PARTITION BY request_id, step_id, reviewer, position, kind, ms // 3600000
          ORDER BY ms DESC) AS rn
        FROM log) WHERE rn = 1)"""


@query("write_logs_tables", REQUESTS + "," + ASSESSMENTS.replace("WITH", "", 1) + BEST_OF_HOUR + f"""
    SELECT 'request' AS kind, request_id, ms, md5(answer) AS detail FROM req
    UNION ALL SELECT 'assessment', request_id, ms, comment FROM best
    UNION ALL SELECT 'reject', 'a' || doc_id || '-' || n, {EPOCH_MS} + doc_id * 3600000 + n * 1700000,
      CASE WHEN doc_id % 11 = 0 THEN 'not json' WHEN doc_id % 9 = 0 THEN '{{"dataframe_records":[]}}' END
    FROM labels, range(3) AS r(n)
    WHERE doc_id % 11 = 0 OR doc_id % 9 = 0 OR (doc_id % 4 = 1 AND doc_id % 3 = 1)""")
def q_write_logs_tables(spark, sf):
    """The three tables of the log job, written twice, read back and dropped."""
    payloads = payload_log(spark, sf)
    with scratch_schema(spark) as schema:
        requests, assessments, rejects = (f"{schema}.{t}" for t in ("requests", "assessments", "rejects"))
        for _ in range(2):
            write_logs(payloads, requests, assessments, rejects)
        ms = F.unix_millis("timestamp").alias("ms")
        comment = F.coalesce("text_assessment.free_text_comment", "retrieval_assessment.free_text_comment")
        sent = F.col("request")
        kinds = [
            ("request", spark.table(requests).select(
                "request.request_id", F.unix_millis("request.timestamp").alias("ms"),
                F.md5(F.col("output.choices")[0]["message"]["content"]).alias("detail"))),
            ("assessment", spark.table(assessments).select("request_id", ms, comment.alias("detail"))),
            ("reject", spark.table(rejects).select(
                "request_id", ms, F.when((sent == "not json") | sent.endswith("[]}"), sent).alias("detail"))),
        ]
        first, *rest = [df.select(F.lit(kind).alias("kind"), "*") for kind, df in kinds]
        for df in rest:
            first = first.unionByName(df)
        return cut(first)


def events(spark, sf):
    return load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


EVENTS_OUT = """
    SELECT event_id, user_id, event_type, epoch_us(ts) AS us, value FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1"""


def _events_out(df):
    return df.select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("us"), "value")


@query("dedup_latest_hour", EVENTS_OUT.format(keys="user_id, event_type, date_trunc('hour', ts)"))
def q_dedup_latest_hour(spark, sf):
    return _events_out(dedup_latest(
        events(spark, sf), ["user_id", "event_type"], ts="ts", granularity="hour",
        tie=[F.desc("event_id")],
    ))


@query("dedup_latest_all", EVENTS_OUT.format(keys="user_id, event_type"))
def q_dedup_latest_all(spark, sf):
    return _events_out(dedup_latest(
        events(spark, sf), ["user_id", "event_type"], ts="ts", tie=[F.desc("event_id")]
    ))


@query("json_props", """
    SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n,
      round(sum(value), 2) AS total
    FROM events GROUP BY event_type, k""")
def q_json_props(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    return load(spark, sf, "events").groupBy("event_type", k.alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )
