"""The stages in a row, and every query with SQL against it."""

import pytest
from compare import compare, connect

import corpus_pipeline
from askloom.llm import decontamination, pii, queries  # noqa: F401
from askloom.llm.registry import ORACLE, QUERIES, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_with_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF).cache())
    assert all(k.dtypes == docs.dtypes for k in kept)
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and 0 < len(ids[-1]) < len(ids[0])
    hits = decontamination.find_overlaps(kept[3], table(spark, SF, "benchmark"))
    assert hits.where("n_hit > 0").count() == 0
    assert not any(pii.base_spans(r["text"] or "") for r in kept[4].collect())
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in pieces} == ids[-1]


def test_stages_judge_rows_with_null_and_repeated_ids(spark, tmp_path):
    bad = "too short"
    good = [" ".join(f"w{k}x{i * i % 97}y{i}" for i in range(60)) for k in range(3)]
    rows = [(None, good[0]), (None, bad), (1, good[1]), (1, bad), (2, good[2]), (2, good[2]), (3, good[2])]
    data = [(i, t, "en", "s", len(t)) for i, t in rows]
    docs = spark.createDataFrame(data, table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, SF, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = lambda d: sorted(((r["doc_id"], r["text"]) for r in d.collect()), key=str)
    clean = corpus_pipeline.quality(spark, docs, SF)
    assert texts(clean) == sorted([r for r in rows if r[1] != bad], key=str)
    unique = corpus_pipeline.near_duplicates(spark, clean, SF)
    assert texts(unique) == sorted([(None, good[0]), (1, good[1]), (2, good[2])], key=str)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == {None, 1, 2}
