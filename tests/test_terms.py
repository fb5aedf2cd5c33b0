"""Text search by postings against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from askloom.operators import terms
from askloom.operators.embedding import Buckets, embed, fit_embedder
from askloom.operators.terms import UNIT, read_term_index, search_terms, term_index, write_term_index


def words(t):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", (t or "").lower()) if w]


def brute(texts, questions, k):
    texts = [(key, Counter(words(t))) for key, t in texts if key is not None]
    inside = Counter(w for _, c in texts for w in c)

    def vector(counts, idf):
        raw = {w: (1 + math.log(n)) * idf(w) for w, n in counts.items() if w in inside}
        raw = {w: x for w, x in raw.items() if x > 0}
        length = math.sqrt(sum(x * x for x in raw.values()))
        return {w: math.floor(x * UNIT / length + 0.5) for w, x in raw.items()}

    held = [(key, vector(c, lambda w: 1)) for key, c in texts]
    out = {}
    for q, t in questions:
        asked = vector(Counter(words(t)), lambda w: math.log((len(texts) + 1) / (inside[w] + 1)))
        scores = [(-sum(x * v[w] for w, x in asked.items() if w in v), key) for key, v in held if asked.keys() & v.keys()]
        out[q] = [(key, r) for r, (_, key) in enumerate(sorted(scores)[:k], 1)]
    return {(q, key, r) for q, hits in out.items() for key, r in hits}


def corpus(seed=0, n=150):
    draw = random.Random(seed)
    rare = [f"w{i}" for i in range(120)]
    # "the" is in nearly all texts, "of" in half of them.
    texts = [
        " ".join(["the"] * (draw.random() < 0.95) + ["Of"] * (draw.random() < 0.5) + draw.choices(rare, k=draw.randint(0, 6)))
        for _ in range(n)
    ]
    texts += ["the of the of", "OF\t\n the", "", " ", None, texts[0], texts[0], "w1 " * 500]
    return list(enumerate(texts))


QUESTIONS = [(1, "the w1 w2"), (2, "of THE"), (3, "w5 of"), (4, ""), (5, None), (6, "unknown words"), (7, "w7 w8 w9 w10 the of of"), (8, "w119")]


def frames(spark, texts):
    return (
        spark.createDataFrame(texts, "id long, t string").repartition(3),
        spark.createDataFrame(QUESTIONS, "q long, ask string"),
    )


def found(hits):
    return {(r["query_key"], r["index_key"], r["rank"]) for r in hits.collect()}


@pytest.mark.parametrize("held", [500_000, 5])
@pytest.mark.parametrize("k", [1, 4, 300])
def test_scan_finds_the_best(spark, monkeypatch, held, k):
    monkeypatch.setattr(terms, "HELD_HITS", held)
    texts, questions = frames(spark, corpus())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        hits = search_terms(questions, term_index(texts, "id", "t"), k=k, query_key="q", text="ask")
        assert found(hits) == brute(corpus(), QUESTIONS, k)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


@pytest.mark.parametrize("limit", [1000, 60, 10, 0])
@pytest.mark.parametrize("k", [1, 4, 300])
def test_join_finds_the_best(spark, monkeypatch, limit, k):
    monkeypatch.setattr(terms, "SCAN_QUESTIONS", 0)
    texts, questions = frames(spark, corpus())
    index = term_index(texts, "id", "t", common_share=0.0, common_least=limit)
    hits = search_terms(questions, index, k=k, query_key="q", text="ask")
    assert found(hits) == brute(corpus(), QUESTIONS, k)


def test_scores_are_cosines_and_columns_are_kept(spark):
    texts, questions = frames(spark, [(1, "a b"), (2, "a c"), (3, "d"), (4, "a b")])
    index = term_index(texts, "id", "t")
    asked = questions.sparkSession.createDataFrame([(9, "b a", "x")], "q long, ask string, extra string")
    hits = search_terms(asked, index, k=2, query_key="q", text="ask", query_cols=["extra"]).orderBy("rank").collect()
    assert [(r["index_key"], r["extra"]) for r in hits] == [(1, "x"), (4, "x")]
    a, b = math.log(5 / 4), math.log(5 / 3)
    assert abs(hits[0]["score"] - (a + b) / math.sqrt(2) / math.hypot(a, b)) < 1e-5


def test_a_large_questions_side_is_not_broadcast(spark, monkeypatch):
    texts, questions = frames(spark, corpus())
    index = term_index(texts, "id", "t", common_share=0.0, common_least=60)
    monkeypatch.setattr(terms, "SMALL_ROWS", 3)
    assert found(search_terms(questions, index, query_key="q", text="ask")) == brute(corpus(), QUESTIONS, 3)


def test_no_texts_and_no_questions(spark):
    texts, questions = frames(spark, corpus())
    assert search_terms(questions, term_index(texts.limit(0), "id", "t"), query_key="q", text="ask").collect() == []
    assert search_terms(questions.limit(0), term_index(texts, "id", "t"), query_key="q", text="ask").collect() == []


def test_stored_index_is_not_shuffled(spark):
    texts, questions = frames(spark, corpus())
    index = term_index(texts, "id", "t", common_share=0.0, common_least=60)
    write_term_index(index, "held_texts", buckets=4)
    stored = read_term_index(spark, "held_texts")
    assert found(search_terms(questions, stored, query_key="q", text="ask")) == brute(corpus(), QUESTIONS, 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = questions.selectExpr("q AS query_key", "ask AS term").repartition("query_key")
        plan = asked.join(stored.postings, "term")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(term") == 1 and "SortMergeJoin" in plan
    for part in ("postings", "terms", "settings"):
        spark.sql(f"DROP TABLE held_texts_{part}")


def test_hashed_vectors_by_hand(spark):
    texts = ["a b b", "A\tc", None, "", "x y z a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    dim, buckets = 16, Buckets(16)
    inside = defaultdict(set)
    for i, t in enumerate(texts):
        for w in words(t):
            inside[buckets.of(w)].add(i)
    got = {r["id"]: r["embedding"] for r in embed(df, "t", embedder=fit_embedder(df, "t", dim=dim)).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
            continue
        v = np.zeros(dim)
        for w in words(t):
            v[buckets.of(w)] += math.log(5 / (len(inside[buckets.of(w)]) + 1))
        assert np.allclose(got[i], v / (np.linalg.norm(v) or 1), atol=1e-6)


def test_many_questions_are_scanned_for_in_blocks(spark, monkeypatch):
    texts, questions = frames(spark, corpus())
    monkeypatch.setattr(terms, "BLOCK_TERMS", 4)
    monkeypatch.setattr(terms, "SCAN_QUESTIONS", 3)
    monkeypatch.setattr(terms, "DENSE_SHARE", 0.4)
    monkeypatch.setattr(terms, "_joined", None)
    assert found(search_terms(questions, term_index(texts, "id", "t"), k=4, query_key="q", text="ask")) == brute(corpus(), QUESTIONS, 4)


def test_postings_hold_no_keys_and_ties_go_to_the_smaller_key(spark, monkeypatch):
    """A posting names its text by a number, whatever the length of the keys; ties beyond k are settled by the key."""
    texts = spark.createDataFrame([(f"{'k' * 32}{i}", "same words" if i else "other") for i in range(9, -1, -1)], "id string, t string")
    index = term_index(texts.repartition(4), "id", "t")
    assert dict(index.postings.dtypes) == {"term": "string", "number": "bigint", "weight": "bigint"}
    asked = spark.createDataFrame([(1, "same")], "q long, ask string")
    monkeypatch.setattr(terms, "SCAN_QUESTIONS", 0)
    hits = search_terms(asked, index, k=2, query_key="q", text="ask").orderBy("rank").collect()
    assert [h["index_key"][-1] for h in hits] == ["1", "2"]


@pytest.mark.parametrize("share", [0, 0.1, 2])
def test_a_scan_is_the_same_whatever_is_multiplied_together(monkeypatch, share):
    """Questions in small groups and several clusters, texts in small lots, terms as a matrix or scattered."""
    for name, value in {"GROUP_QUESTIONS": 2, "CLUSTERS": 3, "SCAN_NUMBERS": 60, "SCORES": 8, "DENSE_SHARE": share}.items():
        monkeypatch.setattr(terms, name, value)
    asked = [(q, w, 1 + (q * 7 + i) % 5) for q in range(9) for i, w in enumerate("abcdefgh"[q % 4: q % 4 + 4])]
    texts = [(f"k{t:03}", {w: 1 + (t * i) % 11 for i, w in enumerate("zabcdefg"[t % 5: t % 5 + 3])}) for t in range(90)]
    columns = [pa.array(c) for c in zip(*asked)]
    block = terms.question_block(pa.table(dict(zip(("query_key", "term", "q"), columns))))
    assert sum(g.n for g in block.groups) == 9 and max(g.n for g in block.groups) == 2
    scan = terms.Scan(block, 4)
    for at in range(0, 90, 13):
        part = texts[at: at + 13]
        scan.add(pa.array([k for k, _ in part]), pa.array([list(v) for _, v in part]), pa.array([list(v.values()) for _, v in part]))
    got = {(block.names[q], key, s) for best in scan.best() for q, key, s in zip(*(best[c].to_pylist() for c in ("q", "key", "score")))}
    want = set()
    for q in range(9):
        vector = {w: x for n, w, x in asked if n == q}
        scores = [(-sum(x * vector.get(w, 0) for w, x in v.items()), k) for k, v in texts]
        want |= {(q, k, -s) for s, k in sorted(scores)[:4] if s}
    assert got == want


def test_thousands_of_questions_are_one_block(spark):
    """The texts are read once for them, not once for every 5,000."""
    asked = spark.range(6_000).selectExpr("id AS query_key", "concat('w', id % 120) AS term", "1000000L AS q")
    texts, _ = frames(spark, corpus())
    found = terms._scan(asked, term_index(texts, "id", "t").vectors, 1)
    assert "scanned-" not in "".join(found.inputFiles()) and found.select("query_key").distinct().count() > 5_000


def test_a_written_index_needs_no_vectors(spark):
    """Postings come from the texts in one pass; blank texts count, and every text has its key once."""
    texts, questions = frames(spark, corpus())
    index = term_index(texts, "id", "t", common_share=0.0, common_least=10)
    write_term_index(index, "plain_texts", buckets=2)
    assert "vectors" not in vars(index)
    stored = read_term_index(spark, "plain_texts")
    assert stored.n_texts == len(corpus()) == stored.keys.select("key").distinct().count() == stored.keys.count()
    assert found(search_terms(questions, stored, k=4, query_key="q", text="ask")) == brute(corpus(), QUESTIONS, 4)
    for part in ("postings", "terms", "keys", "settings"):
        spark.sql(f"DROP TABLE plain_texts_{part}")


def test_pairs_of_open_questions_are_not_shuffled(spark):
    """Questions that their rare terms do not settle: what is shuffled are postings, once for all questions."""
    texts = spark.createDataFrame([(i, f"the of a {i % 7}") for i in range(50)], "id long, t string")
    questions = spark.createDataFrame([(q, "the a 3") for q in range(40)], "q long, ask string")
    index = term_index(texts, "id", "t", common_share=0.0, common_least=5)
    asked = terms.question_weights(questions, "q", "ask", index)
    _, restored = terms._restored(asked, index)
    plan = restored._jdf.queryExecution().optimizedPlan().toString()
    assert "query_key" not in plan
    assert restored.selectExpr("sum(size(terms))").first()[0] <= 50
    assert found(search_terms(questions, index, k=2, query_key="q", text="ask")) == {(q, i, r) for q in range(40) for i, r in ((3, 1), (10, 2))}
