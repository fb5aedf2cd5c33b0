from math import log2

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row, functions as F

from askloom.fixed_values import METRICS
from askloom.operators.metrics import (
    expected_by_category, judged_precision, mark_relevant, ranked_metrics, response_metrics,
    retrieval_metrics,
)
from askloom.operators.reports import (
    avg_metrics_by_run, compare_systems, eval_report, json_rows, mean_score, metrics_long, report_rows,
)
from askloom.plans.evaluation import build_eval_set, judged_answers
from askloom.workload.evaluation import evaluation_tables

CHUNKS = "array<struct<chunk_id:string,doc_uri:string,content:string>>"
SCHEMA = f"id int, expected_retrieval_context {CHUNKS}, retrieval_context {CHUNKS}"


def chunks(ids):
    return None if ids is None else [(i, "d", "t") for i in ids]


def measure(spark, cases):
    rows = [(n, chunks(e), chunks(r)) for n, (e, r) in enumerate(cases)]
    out = retrieval_metrics(spark.createDataFrame(rows, SCHEMA)).collect()
    return [r.asDict() for r in sorted(out, key=lambda r: r.id)]


def test_known_values(spark):
    a, b, c, d = measure(spark, [
        (["x", "y"], ["n", "x", "x", "y"]),
        (None, ["x"]),
        (["x"], None),
        (["x", "x"], ["x"]),
    ])
    assert a["ground_truth_precision_at_1"] == 0 and a["ground_truth_recall_at_1"] == 0
    assert a["ground_truth_precision_at_3"] == pytest.approx(2 / 3)
    assert a["ground_truth_recall_at_3"] == 1
    assert a["ground_truth_ndcg_at_3"] == pytest.approx(
        (1 / log2(3) + 1 / log2(4)) / (1 + 1 / log2(3)))
    assert b["ground_truth_precision_at_1"] == 0
    assert b["ground_truth_recall_at_1"] is None and b["ground_truth_ndcg_at_1"] is None
    assert c["ground_truth_recall_at_10"] == 0 and c["ground_truth_ndcg_at_10"] == 0
    assert d["ground_truth_recall_at_1"] == 1 and d["ground_truth_precision_at_10"] == 0.1


def test_bounds_and_monotony(spark):
    ids = st.lists(st.sampled_from("abcdefghijklmn"), max_size=14)

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(ids, ids), min_size=30, max_size=40))
    def check(cases):
        for (expected, retrieved), m in zip(cases, measure(spark, cases)):
            recall = [m[f"ground_truth_recall_at_{k}"] for k in (1, 3, 5, 10)]
            if expected:
                assert recall == sorted(recall) and all(0 <= r <= 1 for r in recall)
                assert all(0 <= m[f"ground_truth_ndcg_at_{k}"] <= 1 + 1e-12 for k in (1, 3, 5, 10))
                first = list(dict.fromkeys(retrieved))[:5]
                hits = len(set(first) & set(expected))
                assert m["ground_truth_precision_at_5"] == pytest.approx(hits / 5)
            else:
                assert set(recall) == {None}

    check()


def test_category_form_equals_listing_the_category(spark):
    """The counted form gives what per-row lists of expected chunks would give."""
    index = spark.createDataFrame([(f"c{i}", "ab"[i % 2]) for i in range(9)], "chunk_id string, category string")
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, "none")], "query_key int, query_category string")
    ranked = {1: ["c1", "c0", "c2"], 2: ["c3", "c5", "c7"], 3: ["c0", "c1", "c2"]}
    hits = spark.createDataFrame(
        [(q, c, r + 1) for q, cs in ranked.items() for r, c in enumerate(cs)],
        "query_key int, chunk_id string, rank int",
    ).join(index, "chunk_id").join(expected_by_category(asked, index), "query_key")
    got = {r.query_key: r.asDict() for r in ranked_metrics(mark_relevant(hits)).collect()}
    members = {c: [r.chunk_id for r in index.collect() if r.category == c] for c in "ab"}
    want = measure(spark, [(members["a"], ranked[1]), (members["b"], ranked[2]), ([], ranked[3])])
    for q, w in zip((1, 2, 3), want):
        for name, value in w.items():
            if name.startswith("ground"):
                assert got[q][name] == (value if value is None else pytest.approx(value)), (q, name)


def test_judged_precision(spark):
    df = spark.createDataFrame(
        [(1, [True, False, None, True]), (2, []), (3, None), (4, [True, False, True])], "id int, positional_ratings array<boolean>"
    )
    got = {r.id: r for r in judged_precision(df).collect()}
    assert got[1].llm_judged_precision_at_1 == 1
    assert got[1].llm_judged_precision_at_3 is None and got[1].llm_judged_precision_at_5 is None
    assert got[2].llm_judged_precision_at_10 == 0 and got[3].llm_judged_precision_at_10 is None
    assert got[4].llm_judged_precision_at_3 == pytest.approx(2 / 3)
    assert got[4].llm_judged_precision_at_5 == pytest.approx(2 / 5)


def test_questions_without_hits(spark):
    hits = spark.createDataFrame([(1, 1, True, 2)], "query_key int, rank int, relevant boolean, n_expected int")
    asked = spark.createDataFrame([(1, 2), (2, 1), (3, 0)], "query_key int, n_expected int")
    got = {
        r.query_key: (r.ground_truth_precision_at_1, r.ground_truth_recall_at_1, r.ground_truth_ndcg_at_1)
        for r in ranked_metrics(hits, asked).collect()
    }
    assert got == {1: (1.0, 0.5, 1.0), 2: (0.0, 0.0, 0.0), 3: (0.0, None, None)}
    assert ranked_metrics(hits).count() == 1


def test_rows_without_an_answer_are_not_judged(spark):
    eval_set = spark.createDataFrame(
        [(i, "q", chunks(["c1"])) for i in ("a", "b", "c", "d")],
        f"request_id string, request string, expected_retrieval_context {CHUNKS}",
    )
    answers = spark.createDataFrame(
        [("a", "fine", chunks(["c1"])), ("b", None, chunks(["c1"])), ("d", "broken", chunks(["c1"]))],
        f"request_id string, response string, retrieval_context {CHUNKS}",
    )

    def strict():
        def ask(prompts):
            if any("broken" in p for p in prompts):
                raise ValueError("no verdict")
            return ["yes"] * len(prompts)

        return ask

    judged = judged_answers(eval_set, answers, strict, run="r", app_version="1")
    got = {r.request_id: r for r in judged.collect()}
    assert set(got) == {"a", "b", "c", "d"}
    assert got["a"].ratings.harmful is True and got["a"].llm_judged_precision_at_1 == 1
    for i in "bcd":
        assert got[i].ratings.harmful is None and got[i].llm_judged_precision_at_1 is None
    assert got["d"].judge_error == "ValueError: no verdict"
    assert got["a"].judge_error is None and got["b"].judge_error is None


def test_response_metrics(spark):
    df = spark.createDataFrame(
        [(1, " a  b\nc ", "a  b\nc"), (2, "  ", "x"), (3, None, None), (4, "a", None),
         (5, "\n", "\n"), (6, "\tfoo bar\n", "foo bar"), (7, None, "x")],
        "id int, response string, expected_response string",
    )
    got = {r.id: (r.token_count, r.exact_match) for r in response_metrics(df).collect()}
    assert got == {
        1: (3, True), 2: (0, False), 3: (None, None), 4: (1, None),
        5: (0, True), 6: (2, False), 7: (None, False),
    }


def test_averages(spark):
    df = spark.createDataFrame(
        [Row(run_url=r, m=Row(x=x, y=y)) for r, x, y in [("a", 1, True), ("a", 2, False), ("b", None, True)]],
        "run_url string, m struct<x:int,y:boolean>",
    )
    got = {r.run_url: (r.x, r.y) for r in avg_metrics_by_run(df, names=["m.x", "m.y"]).collect()}
    assert got == {"a": (1.5, 0.5), "b": (None, 1.0)}
    one = avg_metrics_by_run(df, names=["m.x"], run="a' OR 'a'='a")
    assert one.count() == 0
    long = metrics_long(avg_metrics_by_run(df, names=["m.x", "m.y"]))
    assert {tuple(r) for r in long.collect()} == {("a", "x", 1.5), ("a", "y", 0.5), ("b", "y", 1.0)}
    with pytest.raises(ValueError):
        avg_metrics_by_run(df, names=["m.x", "n.x"])


def test_all_metric_names_are_made(spark):
    metrics, _ = evaluation_tables(spark, "/root/testdata/sf0.001")
    made = {f"{s}.{f.name}" for s in ("response_metrics", "retrieval_metrics") for f in metrics.schema[s].dataType}
    assert made == set(METRICS) and len(METRICS) == 23


def test_report(spark):
    metrics, assessments = evaluation_tables(spark, "/root/testdata/sf0.001")
    report = eval_report(metrics, assessments.where("app_version = 'en'"))
    assert report.count() == metrics.count() and len(report.columns) == 13
    texts = report_rows(report)
    assert {f.dataType.simpleString() for f in texts.schema} == {"string"}
    assert texts.where(F.greatest(*[F.col(c).isNull() for c in texts.columns])).count() == 0
    left = texts.where("app_version <> 'en'").select("judge_harmful").distinct().collect()
    assert [r[0] for r in left] == ["null"]


def test_json_rows(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json_rows(df).first().json == '{"a":1}'
    assert json_rows(df, keep_nulls=True).first().json == '{"a":1,"b":null}'


def test_comparison(spark):
    df = spark.createDataFrame(
        [("raw", 1), ("raw", 2), ("second", 2), ("tuned", 3), ("zero", 0)], "system string, score int"
    )
    got = {r.against: r.improvement_pct for r in compare_systems(mean_score(df), "tuned").collect()}
    assert got == {"raw": 100.0, "second": 50.0, "zero": None}
    assert mean_score(df.where("system = 'none'")).count() == 0


def test_eval_set(spark):
    chunks = spark.createDataFrame([("c1", 7, "t1"), ("c2", 8, "t2")], "chunk_id string, doc_uri int, content string")
    asked = spark.createDataFrame([("c1", "q?"), ("c2", None), ("c9", "lost")], "chunk_id string, question string")
    got = [r.asDict(recursive=True) for r in build_eval_set(asked, chunks).collect()]
    assert got == [{
        "request_id": "synthetic_c1", "request": "q?",
        "expected_retrieval_context": [{"chunk_id": "c1", "doc_uri": "7", "content": "t1"}],
    }]
