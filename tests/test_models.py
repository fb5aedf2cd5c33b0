import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from askloom.functions.prompts import join_chunks, render
from askloom.operators.embedding import embed, fit_embedder
from askloom.operators.models import batch_generate, generate_questions, judge
from askloom.plans.generation import generate_tickets, propose_categories
from askloom.plans.tuning import fewshot_search, tune


def prompts(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, p string")


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_answers_stay_with_their_prompts(spark):
    df = prompts(spark, *[f"t{i}" for i in range(100)]).repartition(7)
    got = by_id(batch_generate(df, "p", lambda: lambda ps: [p.upper() for p in ps]))
    assert all(r.output == f"T{i}" and r.tries == 1 and r.error is None for i, r in got.items())


def picky():
    def ask(ps):
        if any(p == "bad" for p in ps):
            raise RuntimeError("no")
        return [p + "!" for p in ps]

    return ask


def test_a_failure_stays_in_its_row(spark):
    got = by_id(batch_generate(prompts(spark, "a", "bad", None, "b").coalesce(1), "p", picky))
    assert got[0].output == "a!" and got[3].output == "b!"
    assert got[1].output is None and got[1].error == "RuntimeError: no" and got[1].tries == 1
    assert got[2].output is None and got[2].error is None and got[2].tries == 0


def test_wrong_number_of_answers(spark):
    got = by_id(batch_generate(prompts(spark, "a", "b").coalesce(1), "p", lambda: lambda ps: ps[:1]))
    assert got[0].output == "a" and got[1].output == "b"
    got = by_id(batch_generate(prompts(spark, "a"), "p", lambda: lambda ps: []))
    assert got[0].error == "0 answers for 1 prompts"


def stubborn():
    """Speaks of a chunk the first two times it is asked about 'x', and always about 'y'."""
    asked = {}

    def ask(ps):
        out = []
        for p in ps:
            name = "x" if "about-x" in p else "y" if "about-y" in p else "z"
            asked[name] = asked.get(name, 0) + 1
            if name == "z":
                out.append("no json")
            elif name == "y" or asked[name] <= 2:
                out.append(json.dumps({"question": f"this chunk {asked[name]}"}))
            else:
                out.append(json.dumps({"question": "fine"}))
        return out

    return ask


def test_questions_are_retried(spark):
    chunks = spark.createDataFrame(
        [("1", "about-x"), ("2", "about-y"), ("3", "about-z")], "chunk_id string, chunk string"
    ).coalesce(1)
    got = {r.chunk_id: r for r in generate_questions(chunks, model=stubborn).collect()}
    assert (got["1"].question, got["1"].tries) == ("fine", 3)
    assert (got["2"].question, got["2"].tries) == ("this chunk 5", 5)
    assert got["3"].question is None and got["3"].error.startswith("JSONDecodeError")


def test_default_question_model(spark):
    chunks = spark.createDataFrame([("1", "First: a {b}. Then c.")], "chunk_id string, chunk string")
    assert generate_questions(chunks).first().question == "What follows from: First: a {b}.?"


def test_judge(spark):
    df = spark.createDataFrame([(1, "q", "good"), (2, "q", "bad")], "id int, request string, response string")

    def model():
        return lambda ps: ["YES" if "good" in p or "harmless" in p else "no" for p in ps]

    got = by_id(judge(df, model))
    assert got[1].score == 3 and got[2].score == 1
    assert [v.name for v in got[2].verdicts if v.passed] == ["harmless"]


def test_a_failed_judge_is_no_verdict(spark):
    df = spark.createDataFrame([(1, "q", "good")], "id int, request string, response string")

    def model():
        def ask(ps):
            raise RuntimeError("down")

        return ask

    row = judge(df, model).first()
    assert row.score is None and all(v.passed is None and v.answer is None for v in row.verdicts)


@pytest.mark.parametrize("odd", [{"question": None}, {"question": 5}, {"question": ["a"]}, {}, [1]])
def test_odd_answers_stay_in_their_row(spark, odd):
    chunks = spark.createDataFrame([("1", "odd"), ("2", "fine")], "chunk_id string, chunk string")

    def model():
        return lambda ps: [json.dumps(odd if "context: odd" in p else {"question": "Why?"}) for p in ps]

    got = {r.chunk_id: r for r in generate_questions(chunks.coalesce(1), model=model).collect()}
    assert got["2"].question == "Why?" and got["2"].error is None
    assert got["1"].question is None and got["1"].error


def test_render_is_literal(spark):
    df = spark.createDataFrame([("{question}", "a{b}\\1$", None)], "c string, q string, n string")
    text = render("{{x}} {context}|{question}|{n}", {
        "context": F.col("c"), "question": F.col("q"), "n": F.col("n")})
    assert df.select(text).first()[0] == "{x} {question}|a{b}\\1$|"
    with pytest.raises(KeyError):
        render("{other}", {})


def test_join_chunks(spark):
    df = spark.createDataFrame([(["a", "{b}"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(join_chunks(F.col("t"))).collect()] == ["`a``{b}`", ""]


def test_default_embedding_is_hashed_tfidf(spark):
    texts = ["red green", "red blue blue", "blue", "  "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, None)], "id int, t string")
    got = {r.id: r.e for r in embed(df, "t", embedder=fit_embedder(df, "t", dim=64), out="e").collect()}
    assert got[9] is None and np.allclose(got[3], 0)
    for i in range(3):
        assert np.isclose(np.linalg.norm(got[i]), 1, atol=1e-5)
    assert np.dot(got[1], got[2]) > np.dot(got[0], got[2])
    assert embed(df, "t").columns == ["id", "t", "embedding"]


def test_embedding_keeps_other_column_names(spark):
    model = fit_embedder(spark.createDataFrame([("a b",)], "chunk string"), "chunk", dim=8)
    df = spark.createDataFrame([("a", "chunky", 1)], "question string, chunk string, _tf int")
    got = embed(df, "question", embedder=model)
    assert got.columns == ["question", "chunk", "_tf", "embedding"]
    assert got.first().chunk == "chunky"


def test_own_embedder(spark):
    df = prompts(spark, "abc", None, "d")
    got = by_id(embed(df, "p", embedder=lambda: lambda ts: np.array([[len(t)] for t in ts])))
    assert got[0].embedding == [3.0] and got[1].embedding is None and got[2].embedding == [1.0]


def test_proposed_categories():
    answers = iter(["Fuel leak!", "Fuel leak", "1. Rust"] + [f"Cat {c}" for c in "abcdefghij"])
    got = propose_categories(lambda ps: [next(answers)], "engines", ["Worn 2 belt"], minimum=4)
    assert got == ["Worn  belt", "Fuel leak", " Rust", "Cat a"]
    with pytest.raises(RuntimeError, match="1 categories of 4 after 3 requests"):
        propose_categories(lambda ps: ["Rust"], "engines", ["Rust"], minimum=4, max_calls=3)


def test_tickets(spark):
    cats = spark.createDataFrame([(f"Cat {c}!",) for c in "aabcdefgh"], "category string")
    got = generate_tickets(cats, seed=4).collect()
    per = {}
    for r in got:
        per.setdefault(r.category, []).append(r.ticket_number)
    assert len(per) == 8 and all(3 <= len(v) <= 10 for v in per.values())
    assert all(len(t) == 7 for v in per.values() for t in v)
    assert sorted(map(tuple, got)) == sorted(map(tuple, generate_tickets(cats, seed=4).collect()))
    assert {r.ticket_number for r in got} != {
        r.ticket_number for r in generate_tickets(cats, seed=5).collect()
    }


def train_rows(spark):
    rows = [(f"r{i:02d}", f"q{i}", f"ctx{i}.", f"answer {i}") for i in range(12)]
    return spark.createDataFrame(rows, "request_id string, request string, context string, response string")


def shown_examples():
    """Answers with the number of examples in the prompt."""
    return lambda ps: [f"saw {p.count('---') - 1}" for p in ps]


def likes_four():
    return lambda ps: ["yes" if "saw 4" in p or ("saw 0" in p and "request: q1" in p.lower()) else "no"
                       for p in ps]


def test_fewshot_search(spark):
    scores, prefixes = fewshot_search(train_rows(spark), shown_examples, likes_four, candidates=4)
    rows = scores.collect()
    assert len(rows) == 12 * 4 and len(prefixes) == 4
    shown = {c: p.count("---") - 1 for c, p in prefixes.items()}
    assert shown == {0: 0, 1: 2, 2: 4, 3: 4}
    for r in rows:
        assert r.answer == f"saw {shown[r.candidate]}"
    best, prefix = tune(train_rows(spark), shown_examples, likes_four, candidates=4)
    assert best == 2 and prefix == prefixes[2]
