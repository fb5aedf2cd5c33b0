"""Held-out comparison, reasoning before the response, and saved programs."""

import json
import math

import pytest

from askloom.operators.reports import compare_pairs, compare_systems
from askloom.plans.comparison import (
    System, compare_held_out, read_program, read_programs, score_systems, write_program, write_programs,
)
from askloom.plans.tuning import Program, answer_with, demo_prefix, tune_program
from askloom.session import scratch_path
from askloom.sources.tables import read_demos

DEMO = {"augmented": True, "request": 'a "quoted"\nrequest', "context": "é; c", "rationale": None, "response": "r {x}"}
OTHER = {"augmented": False, "request": "r2", "context": None, "rationale": "because", "response": "s"}


def yes_to_long():
    return lambda prompts: ["Yes" if "good" in p.split("Response To Assess: ")[1].split("\n")[0] else "No" for p in prompts]


def test_programs_round_trip(spark, tmp_path):
    path = scratch_path(spark, "programs")
    write_program(spark, Program([DEMO, OTHER]), path, "one two")
    assert read_program(spark, path, "one two") == Program([DEMO, OTHER])
    assert read_program(spark, path, "none").demos == []
    # The same layout as a program saved elsewhere.
    assert [r.asDict() for r in read_demos(spark, path).collect()] == [DEMO, OTHER]
    file = next(f for f in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect())
    saved = json.loads(bytes(file.content))["program"]
    assert saved["lm"] is None and saved["train"] == [] and saved["signature_prefix"] == "Response:"
    assert saved["demos"][0]["rationale"] is None and saved["extended_signature_instructions"]


def test_many_programs(spark):
    fields = "program string, position int, augmented boolean, request string, context string, rationale string, response string"
    rows = [(f"p{i % 3}", 9 - i, True, f"q{i}", "c", None, "r") for i in range(9)]
    path = scratch_path(spark, "programs")
    write_programs(spark.createDataFrame(rows, fields), path)
    got = read_programs(spark, path).collect()
    for p in ("p0", "p1", "p2"):
        mine = sorted((r.position, r.request) for r in got if r.program == p)
        assert mine == [(n, q) for n, q in enumerate(q for _, q in sorted((r[1], r[3]) for r in rows if r[0] == p))]


def test_reasoning_is_cut_off(spark):
    answers = ["I think.\nSo it is.\nResponse: yes\nmore", "no mark", "\nResponse:", "Response: at once", "a\nResponse: b\nResponse: c", None]
    df = spark.createDataFrame([(i, "q", "c", "p") for i in range(6)], "id int, request string, context string, prefix string")
    got = answer_with(df.coalesce(1).sort("id"), "prefix", lambda: lambda ps: answers[: len(ps)], "out", reasons=True)
    found = {r.id: (r.out_rationale, r.out) for r in got.collect()}
    assert found[0] == ("I think.\nSo it is.", "yes\nmore") and found[1] == (None, "no mark") and found[2] == ("", "")
    assert found[3] == (None, "Response: at once") and found[4] == ("a\nResponse: b", "c") and found[5] == (None, None)


def test_prefix_shows_the_reasoning():
    shown = demo_prefix([OTHER], reasons=True)
    assert "Reasoning: because\nResponse: s" in shown and "Reasoning" not in demo_prefix([OTHER])
    assert Program([OTHER], reasons=False).prefix() == demo_prefix([OTHER])


def test_systems_share_their_contexts(spark):
    test = spark.createDataFrame([(f"t{i}", f"request {i}") for i in range(4)], "request_id string, request string")
    hits = spark.createDataFrame(
        [("t0", "c1", "first", 1), ("t0", "c2", "second", 2), ("t1", "c1", "first", 1)],
        "request_id string, chunk_id string, content string, rank int",
    )
    seen = lambda: lambda ps: [f"r\nResponse: {'good' if 'first' in p else 'poor'} {len(p)}" for p in ps]
    plain = lambda: lambda ps: ["good" if "second" in p else "poor" for p in ps]
    program = Program([OTHER])
    systems = {"a": System(seen), "b": System(plain, reasons=False), "c": System(seen, program)}
    scores, pairs = compare_held_out(test, hits, systems, yes_to_long, best="c")
    got = {(r.request_id, r.system): r for r in scores.collect()}
    assert len(got) == 12 and got["t0", "a"].score == got["t1", "c"].score == 3 and got["t2", "a"].score == 0
    assert got["t0", "b"].score == 3 and got["t1", "b"].score == 0 and got["t0", "b"].rationale is None
    assert got["t0", "a"].rationale == "r"
    longer = int(got["t0", "c"].response.split()[1]) - int(got["t0", "a"].response.split()[1])
    assert longer == len(program.prefix()) - len(demo_prefix([]))
    found = {r.against: r for r in pairs.collect()}
    assert (found["b"].pairs, found["b"].wins, found["b"].losses, found["b"].ties) == (4, 1, 0, 3)
    assert found["a"].improvement_pct == 0 and found["b"].improvement_pct == 100


def test_pairs_without_scores(spark):
    rows = [("1", "best", 3), ("1", "x", 1), ("2", "best", None), ("2", "x", 2), ("3", "x", 2), ("4", "best", 1), ("4", "x", 2), ("5", "best", 2)]
    scores = spark.createDataFrame(rows, "request_id string, system string, score int")
    (r,) = compare_pairs(scores, "best").collect()
    assert (r.against, r.pairs, r.unpaired, r.wins, r.losses, r.ties) == ("x", 2, 2, 1, 1, 0)
    assert r.mean_gain == 0.5 and abs(r.improvement_pct - 100 * (2 - 1.5) / 1.5) < 1e-9
    assert abs(r.gain_error - math.sqrt(4.5) / math.sqrt(2)) < 1e-9
    assert compare_pairs(scores.limit(0), "best").collect() == []
    means = spark.createDataFrame([("a", 2.0), ("b", 0.0), ("best", 3.0)], "system string, mean_score double")
    assert {(r.against, r.improvement_pct) for r in compare_systems(means, "best").collect()} == {("a", 50.0), ("b", None)}
    assert all(r.improvement_pct is None for r in compare_systems(means, "nobody").collect())


def test_a_tuned_program_keeps_the_teachers_reasoning(spark):
    train = spark.createDataFrame(
        [(f"t{i}", f"request {i}", "ctx", f"labelled {i}") for i in range(6)],
        "request_id string, request string, context string, response string",
    )
    # The student does well only when it is shown a generated example.
    student = lambda: lambda ps: ["so\nResponse: " + ("good" if "deep thought" in p else "poor") for p in ps]
    teacher = lambda: lambda ps: ["deep thought\nResponse: good" for _ in ps]
    program = tune_program(train, student, yes_to_long, teacher=teacher, candidates=4)
    generated = [d for d in program.demos if d["augmented"]]
    assert program.reasons and generated and all(d["rationale"] == "deep thought" and d["response"] == "good" for d in generated)
    assert all(d["rationale"] is None and d["response"].startswith("labelled") for d in program.demos if not d["augmented"])
    path = scratch_path(spark, "programs")
    write_program(spark, program, path)
    again = read_program(spark, path)
    assert again.prefix() == program.prefix()
    rows = train.drop("response")
    scores = score_systems(rows, {"tuned": System(student, again), "raw": System(student)}, yes_to_long)
    assert {(r.system, r.score) for r in scores.collect()} == {("tuned", 3), ("raw", 0)}


@pytest.mark.parametrize("judge", [lambda: lambda ps: 1 / 0])
def test_a_failed_judge_gives_no_pairs(spark, judge):
    rows = spark.createDataFrame([("1", "q", "c")], "request_id string, request string, context string")
    plain = lambda: lambda ps: ["x"] * len(ps)
    scores = score_systems(rows, {"a": System(plain), "b": System(plain)}, judge)
    assert all(r.score is None and r.judge_error for r in scores.collect())
    (r,) = compare_pairs(scores, "a").collect()
    assert (r.pairs, r.unpaired, r.improvement_pct) == (0, 1, None)
