"""The payload queries take every answer of a conversation, with all turns before it."""

import json

from askloom.workload import QUERIES
from askloom.workload.logs import request_payloads


def conversations(spark, path):
    """Conversation 1 has three answers, 2 has one that is null, 10 only failed requests."""
    rows = [(1, t, "assistant" if t % 2 else "user", f"text {t}") for t in range(6)]
    rows += [(2, 0, "user", "a"), (2, 1, "assistant", None), (10, 0, "user", "a"), (10, 1, "assistant", "b")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{path}/conversations.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_every_answer_is_a_request(spark, tmp_path):
    sf = conversations(spark, tmp_path)
    sent = {r["request_id"]: json.loads(r["request"])["messages"] for r in request_payloads(spark, sf).collect()}
    assert {k: len(m) for k, m in sent.items()} == {"c1-1": 1, "c1-3": 3, "c1-5": 5, "c2-1": 1, "c10-1": 1}
    good = {"c1-1", "c1-3", "c1-5", "c2-1"}
    got = {name: QUERIES[name](spark, sf).collect() for name in
           ("last_input", "chat_history", "trace_bounds", "review_ready", "payload_kinds")}
    for name in ("last_input", "chat_history", "trace_bounds", "review_ready"):
        assert sorted(r["request_id"] for r in got[name]) == sorted(good)
    assert dict(map(tuple, got["payload_kinds"])) == {"request": 4, "assessment": 3}
    assert dict(map(tuple, got["last_input"])) == {"c1-1": "text 0", "c1-3": "text 2", "c1-5": "text 4", "c2-1": "a"}
    assert {r["request_id"]: r["n_messages"] for r in got["chat_history"]} == {"c1-1": 0, "c1-3": 2, "c1-5": 4, "c2-1": 0}
