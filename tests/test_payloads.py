import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from askloom import schemas
from askloom.operators.payloads import dedup_assessments, parse_payloads, pending_reviews, unpack_payloads
from askloom.plans.logs import write_logs
from askloom.session import scratch_path

PAYLOAD = "acme_request_id string, status_code string, timestamp_ms long, request string, response string"
HOUR = 3_600_000


def at(ms):
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)


def request(rid, messages, choices, ms=1500, status="200", conversation="c1", trace=None):
    return (
        rid, status, ms,
        json.dumps({"messages": messages, "acme_options": {"conversation_id": conversation}}),
        json.dumps({"choices": choices, "acme_output": {"trace": trace}}),
    )


def record(rid="r1", reviewer="u1", text=None, retrieval=None):
    return {
        "request_id": rid, "step_id": "top",
        "source": {"type": "human", "id": reviewer, "tags": {"a": "b"}},
        "text_assessments": text, "retrieval_assessments": retrieval,
    }


def text(value=True, step="s1"):
    return {
        "step_id": step, "ratings": {"answer_good": {"value": value, "rationale": "ok"}},
        "free_text_comment": None, "suggested_output": "better",
    }


def retrieval(position=0, step="s0"):
    return {"position": position, "step_id": step, "ratings": {}, "free_text_comment": "hm"}


def review(records, ms=1000, rid="a", response='{"result":"ok"}'):
    body = records if isinstance(records, str) else json.dumps({"dataframe_records": records})
    return (rid, "200", ms, body, response)


def logs(spark, *rows):
    return unpack_payloads(spark.createDataFrame(list(rows), PAYLOAD), vendor="acme_")


USER = {"role": "user", "content": "hello"}
CHOICE = {"message": {"role": "assistant", "content": "hi"}}


def test_request_log(spark):
    trace = {
        "app_version_id": "v1", "start_timestamp": "2024-01-01T00:00:00.5Z", "is_truncated": False,
        "steps": [{
            "step_id": "s0", "name": "r", "type": "RETRIEVAL",
            "retrieval": {"query_text": "q", "chunks": [
                {"chunk_id": "c", "doc_uri": "d", "content": "t"}]},
        }],
    }
    log = logs(spark, request("r1", [{"role": "system", "content": "be nice"}, USER], [CHOICE],
                              ms=1_700_000_000_123, trace=trace)).request_log
    row = log.first().asDict(recursive=True)
    assert row["request"] == {
        "request_id": "r1", "conversation_id": "c1", "timestamp": at(1_700_000_000_123),
        "messages": [{"role": "system", "content": "be nice"}, USER], "last_input": "hello",
    }
    assert row["output"] == {"choices": [CHOICE]}
    assert row["trace"]["app_version_id"] == "v1" and row["trace"]["end_timestamp"] is None
    assert row["trace"]["start_timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert row["trace"]["steps"][0]["retrieval"]["chunks"] == [
        {"chunk_id": "c", "doc_uri": "d", "content": "t"}
    ]
    assert row["trace"]["steps"][0]["text_generation"] is None


def test_schemas_are_the_documented_ones(spark):
    out = logs(spark, request("r1", [USER], [CHOICE]))
    for df, ddl in [(out.request_log, schemas.REQUEST_LOG), (out.assessment_log, schemas.ASSESSMENT_LOG)]:
        want = schemas.table(ddl)
        assert [f.name for f in df.schema] == [f.name for f in want]
        for got, field in zip(df.schema, want):
            assert got.dataType.simpleString() == field.dataType.simpleString()


def test_edge_requests(spark):
    out = logs(
        spark,
        request("failed", [USER], [CHOICE], status="500"),
        request("no messages", [], [CHOICE]),
        request("no choices", [USER], []),
        request("null choices", [USER], None),
        ("broken response", "200", 1, json.dumps({"messages": [USER]}), "not json"),
        ("nothing", "200", 1, None, None),
    )
    got = {r.request.request_id: r for r in out.request_log.collect()}
    assert set(got) == {"no messages", "no choices"}
    assert got["no messages"].request.last_input is None
    assert got["no choices"].output.choices == []
    assert {r.request_id for r in out.rejects.collect()} == {
        "null choices", "broken response", "nothing"
    }
    assert out.assessment_log.count() == 0


def test_integer_status_codes(spark):
    df = spark.createDataFrame([request("r", [USER], [CHOICE])], PAYLOAD)
    ints = df.withColumn("status_code", df.status_code.cast("int"))
    assert unpack_payloads(ints, vendor="acme_").request_log.count() == 1


def test_assessments(spark):
    out = logs(
        spark,
        review([record(text=[text(), text(False, "s2")], retrieval=[retrieval(1)])], ms=2000),
        review([record("r2", None, text=[text()])]),
        review([record("r3", retrieval=[retrieval(0), retrieval(1)])]),
        review([record("r4")], rid="neither"), review([], rid="empty"), review("oops", rid="bad"),
    )
    rows = [r.asDict(recursive=True) for r in out.assessment_log.collect()]
    assert sorted((r["request_id"], r["step_id"]) for r in rows) == [
        ("r1", "s0"), ("r1", "s1"), ("r1", "s2"), ("r2", "s1"), ("r3", "s0"), ("r3", "s0")
    ]
    one = next(r for r in rows if r["step_id"] == "s2")
    assert one["timestamp"] == at(2000)
    assert one["source"] == {"type": "human", "id": "u1", "tags": {"a": "b"}}
    assert one["retrieval_assessment"] is None
    assert one["text_assessment"] == {
        "step_id": "s2", "free_text_comment": None, "suggested_output": "better",
        "ratings": {"answer_good": {"bool_value": False, "double_value": None, "rationale": "ok"}},
    }
    other = next(r for r in rows if r["request_id"] == "r1" and r["step_id"] == "s0")
    assert other["text_assessment"] is None
    assert other["retrieval_assessment"] == {
        "position": 1, "step_id": "s0", "ratings": {}, "free_text_comment": "hm"
    }
    assert {r.request_id for r in out.rejects.collect()} == {"neither", "empty", "bad"}


def dedup(spark, *rows, granularity="hour", strict=True):
    log = dedup_assessments(logs(spark, *rows).assessment_log, granularity, strict=strict)
    return sorted(
        (r.timestamp, r.source.id, r.retrieval_assessment.position if r.retrieval_assessment else "text")
        for r in log.collect()
    )


def test_dedup_within_and_across_hours(spark):
    rows = [review([record(text=[text()])], ms=ms) for ms in (1000, 2000, HOUR + 5)]
    assert dedup(spark, *rows) == [(at(2000), "u1", "text"), (at(HOUR + 5), "u1", "text")]
    assert dedup(spark, *rows, granularity=None) == [(at(HOUR + 5), "u1", "text")]


def test_dedup_keys(spark):
    rows = [
        review([record(retrieval=[retrieval(0), retrieval(1)])], ms=1000),
        review([record(retrieval=[retrieval(1)])], ms=1500),
        review([record(reviewer="u2", retrieval=[retrieval(1)])], ms=1200),
    ]
    assert dedup(spark, *rows) == [
        (at(1000), "u1", 0), (at(1200), "u2", 1), (at(1500), "u1", 1)
    ]


def test_dedup_keeps_text_and_unplaced_retrieval_apart(spark):
    row = review([record(text=[text(step="s")], retrieval=[retrieval(None, "s")])])
    log = logs(spark, row).assessment_log
    assert dedup_assessments(log).count() == 2
    assert dedup_assessments(log, strict=False).count() == 1


def test_dedup_ties_are_settled_by_content(spark):
    rows = [review([record(text=[text(v)])], ms=1000) for v in (True, False)]
    for order in (rows, rows[::-1]):
        log = dedup_assessments(logs(spark, *order).assessment_log, "hour")
        assert log.first().text_assessment.ratings["answer_good"].bool_value is False


def test_dedup_granularity(spark):
    with pytest.raises(ValueError, match="granularity must be one of"):
        dedup_assessments(logs(spark).assessment_log, "minute")


def test_pending_reviews(spark):
    log = logs(spark, request("r1", [USER], [CHOICE]), request("r2", [USER], [CHOICE])).request_log
    ids = spark.createDataFrame([("r1",), ("r1",), ("r9",)], "request_id string")
    ready, waiting = pending_reviews(ids, log)
    assert [r.request_id for r in ready.collect()] == ["r1"]
    assert [r.request_id for r in waiting.collect()] == ["r9"]


def test_write_logs(spark):
    df = spark.createDataFrame(
        [request("r1", [USER], [CHOICE]), review([record(text=[text()])]),
         review([record(text=[text()])], ms=1001)], PAYLOAD,
    )
    spark.sql("CREATE SCHEMA IF NOT EXISTS logs_db")
    for _ in range(2):
        write_logs(df, "logs_db.requests", "logs_db.assessments", vendor="acme_")
    assert spark.table("logs_db.requests").count() == 1
    assert spark.table("logs_db.assessments").count() == 1


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_staged_payloads_are_parsed_once(spark):
    rows = [request("r1", [USER], [CHOICE]), review([record(text=[text()])]), review("oops", rid="bad")]
    df = spark.createDataFrame(rows, PAYLOAD)
    parsed = parse_payloads(df, "acme_")
    assert plan(parsed).count("parseJson(") == 2
    path = scratch_path(spark, "stage")
    staged = unpack_payloads(df, "acme_", stage=path)
    lazy = unpack_payloads(df, "acme_")
    for one, two, kind in zip(staged, lazy, ("request", "assessment", "reject")):
        assert "parseJson" not in plan(one) and "from_json" not in plan(one)
        files = one.select(F.input_file_name().alias("f")).distinct().collect()
        assert files and all(f"kind={kind}" in r.f for r in files)
        assert [r.asDict(recursive=True) for r in one.collect()] == [r.asDict(recursive=True) for r in two.collect()]
    kept = spark.read.parquet(path).where("request IS NOT NULL").select("kind").distinct().collect()
    assert [r.kind for r in kept] == ["reject"]


def test_parts_of_other_types_and_odd_texts(spark):
    body = json.dumps({"messages": "hello", "acme_options": {"conversation_id": 7}})
    out = logs(
        spark,
        ("odd", "200", 1, body, json.dumps({"choices": "text"})),
        ("list", "200", 1, "[1, 2]", "[]"), ("number", "200", 1, "3", "null"), ("cut", "200", 1, '{"a":', '{"choices": ['),
        ("twice", "200", 1, '{"messages": [], "messages": []}', json.dumps({"choices": []})),
    )
    got = {r.request.request_id: r for r in out.request_log.collect()}
    assert set(got) == {"odd", "twice"}
    assert got["odd"].request.messages is None and got["odd"].request.conversation_id == "7" and got["odd"].output.choices is None
    rejected = {r.request_id: (r.request, r.response) for r in out.rejects.collect()}
    assert set(rejected) == {"list", "number", "cut"} and rejected["cut"] == ('{"a":', '{"choices": [')


def test_write_logs_with_rejects(spark):
    rows = [request("r1", [USER], [CHOICE]), review([record(text=[text()])]), review("oops", rid="bad"), review([], rid="empty")]
    spark.sql("CREATE SCHEMA IF NOT EXISTS logs_db")
    for _ in range(2):
        write_logs(spark.createDataFrame(rows, PAYLOAD), "logs_db.q", "logs_db.a", "logs_db.r", vendor="acme_")
    assert sorted(r.request_id for r in spark.read.table("logs_db.r").collect()) == ["bad", "empty"]
    assert spark.read.table("logs_db.q").count() == spark.read.table("logs_db.a").count() == 1
