"""What the physical plans must and must not hold."""

import pytest

from askloom.operators.chunking import chunk_tokens
from askloom.workload import QUERIES
from askloom.workload.registry import load

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunking_stays_in_the_jvm_and_moves_nothing(spark):
    text = plan(chunk_tokens(load(spark, SF, "documents"), "text").select("doc_id", "chunk_id"))
    assert "Python" not in text and "Exchange" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


@pytest.mark.parametrize("name", ["chunk_separator", "generated_questions", "judge_score"])
def test_python_runs_once_per_row(spark, name):
    assert plan(QUERIES[name](spark, SF)).count("ArrowEvalPython [") == 1


@pytest.mark.parametrize(
    "name", ["dedup_latest_hour", "assessment_dedup_all", "index_rows"]
)
def test_dedup_prunes_before_its_shuffle(spark, name):
    assert plan(QUERIES[name](spark, SF)).count("WindowGroupLimit") == 2


def test_unpacking_needs_no_shuffle(spark):
    from askloom.operators.payloads import unpack_payloads

    schema = "request_id string, status_code string, timestamp_ms long, request string, response string"
    for df in unpack_payloads(spark.createDataFrame([], schema)):
        assert "Exchange" not in plan(df) and "Python" not in plan(df)


def test_vectors_are_made_once(spark):
    """A neighbour join must not make Spark embed a text for a filter and again for its use."""
    from askloom.operators.embedding import embed, fit_embedder
    from askloom.operators.vectors import keyed
    from askloom.workload.retrieval import letter_counts

    docs = load(spark, SF, "documents")
    own = plan(keyed(embed(docs, "text", embedder=letter_counts), "doc_id", "embedding", "k"))
    assert own.count("ArrowEvalPython [") == 1
    fitted = embed(docs, "text", embedder=fit_embedder(docs, "text"))
    assert plan(keyed(fitted, "doc_id", "embedding", "k")).count("ArrowEvalPython [") == 1


def test_texts_of_single_chunks_are_not_shuffled(spark):
    """The rows are those of the plain way, with ids that come twice or are null; only these are brought together."""
    from askloom.plans.index import unique_chunks

    rows = [(f"c{i % 9}" if i % 5 else None, i, f"s{i % 2}", f"text {i % 9}") for i in range(12)] + [("c1", 0, "s0", "text 1")]
    chunks = spark.createDataFrame(rows, "id string, doc long, source string, chunk string")
    names = dict(id_col="id", uri_col="doc", category_col="source", text_col="chunk")
    plain, kept = unique_chunks(chunks, **names), unique_chunks(chunks, in_place=True, **names)
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect())) and kept.columns == plain.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_documents_are_not_shuffled_for_few_labels(spark):
    from askloom.session import scratch_path
    from askloom.workload.evaluation import evaluation_rows

    sf = scratch_path(spark, "tables")
    docs = [(i, f"text {i}", "en", "web", 6) for i in range(9)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(4)], "doc_id long, quality long, toxic long").write.parquet(f"{sf}/labels.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = evaluation_rows(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
