"""Held-out comparison of systems that share one retrieval, and saved prompt programs."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from askloom import schemas
from askloom.fixed_values import RESPOND_INSTRUCTIONS
from askloom.operators.models import Model, judge
from askloom.operators.reports import compare_pairs
from askloom.plans.answering import format_context
from askloom.plans.tuning import Program, answer_with, demo_prefix
from askloom.session import cut, stage

RESPONSE_PREFIX = "Response:"
DEMO_FIELDS = ["augmented", "request", "context", "rationale", "response"]


class System(NamedTuple):
    """A model and the program that it is asked with; without a program it gets the bare task."""

    model: Callable[[], Model]
    program: Program | None = None
    reasons: bool = True


# --- saved programs --------------------------------------------------------------------

def write_programs(demos: DataFrame, path: str, *, instructions: str = RESPOND_INSTRUCTIONS) -> None:
    """One JSON file per program below ``path/name=<program>``, in the layout that :func:`read_demos` reads.

    ``demos`` has ``program``, ``position`` and the fields of an example. A program is a handful of examples.
    """
    example = F.struct("position", F.struct(*DEMO_FIELDS).alias("demo"))
    saved = demos.groupBy("program").agg(F.array_sort(F.collect_list(example)).alias("d"))
    body = F.struct(
        F.lit(None).cast("string").alias("lm"), F.array().cast("array<string>").alias("traces"),
        F.array().cast("array<string>").alias("train"), F.transform("d", lambda d: d["demo"]).alias("demos"),
        *[F.lit(v).alias(f"{k}signature_{n}") for k in ("", "extended_")
          for n, v in (("instructions", instructions), ("prefix", RESPONSE_PREFIX))],
    )
    text = F.to_json(F.struct(body.alias("program")), {"ignoreNullFields": "false"})
    saved.select(F.col("program").alias("name"), text.alias("value")).repartition("name").write.mode(
        "overwrite"
    ).partitionBy("name").text(path)


def read_programs(spark: SparkSession, path: str) -> DataFrame:
    """``program, position`` and the fields of each example of all programs below ``path``."""
    saved = spark.read.schema("value string, name string").text(path, wholetext=True)
    demos = saved.select(F.col("name").alias("program"), F.from_json("value", schemas.table(schemas.PROGRAM))["program"]["demos"].alias("demos"))
    return demos.select("program", F.posexplode("demos").alias("position", "d")).select("program", "position", "d.*")


def write_program(spark: SparkSession, program: Program, path: str, name: str = "tuned") -> None:
    rows = [(name, i, *(d.get(f) for f in DEMO_FIELDS)) for i, d in enumerate(program.demos)]
    fields = "program string, position int, augmented boolean, request string, context string, rationale string, response string"
    write_programs(spark.createDataFrame(rows, fields), path, instructions=program.instructions)


def read_program(spark: SparkSession, path: str, name: str = "tuned", *, reasons: bool = True) -> Program:
    """A saved program, ready to be asked with. It is a handful of examples."""
    rows = read_programs(spark, path).where(F.col("program") == name).orderBy("position").collect()
    return Program([{f: r[f] for f in DEMO_FIELDS} for r in rows], reasons=reasons)


# --- comparison ------------------------------------------------------------------------

def with_contexts(test: DataFrame, hits: DataFrame, *, id_col: str = "request_id", text_col: str = "content") -> DataFrame:
    """The test rows with the texts of their hits as ``context``, retrieved once and written."""
    contexts = format_context(hits, by=id_col, text_col=text_col)
    joined = test.drop("context").join(contexts, id_col, "left")
    return stage(joined.withColumn("context", F.coalesce("context", F.lit(""))), "contexts")


def score_systems(
    rows: DataFrame, systems: dict[str, System], judge_model: Callable[[], Model], *, id_col: str = "request_id",
) -> DataFrame:
    """``request_id, system, response, rationale, score, judge_error`` of every system on every row.

    ``rows`` has an id, ``request`` and ``context`` (:func:`with_contexts`), the same for all systems, so what
    differs is the model and its program alone. Answers and verdicts are written: no model is asked twice.
    """
    answered = None
    for name, (model, program, reasons) in systems.items():
        reasons = program.reasons if program is not None else reasons
        prefix = demo_prefix([]) if program is None else program.prefix()
        asked = rows.select(id_col, "request", "context", F.lit(name).alias("system"), F.lit(prefix).alias("_prefix"))
        got = answer_with(asked, "_prefix", model, "response", reasons=reasons).drop("_prefix")
        if not reasons:
            got = got.withColumn("response_rationale", F.lit(None).cast("string"))
        answered = got if answered is None else answered.unionByName(got)
    judged = judge(answered, judge_model)
    return cut(judged.select(
        id_col, "system", "response", F.col("response_rationale").alias("rationale"), "score", "judge_error"
    ))


def compare_held_out(
    test: DataFrame, hits: DataFrame, systems: dict[str, System], judge_model: Callable[[], Model], *, best: str,
    id_col: str = "request_id", text_col: str = "content",
) -> tuple[DataFrame, DataFrame]:
    """(scores, comparison): every system on the test rows with the same retrieved texts, and ``best`` against each other."""
    scores = score_systems(with_contexts(test, hits, id_col=id_col, text_col=text_col), systems, judge_model, id_col=id_col)
    return scores, compare_pairs(scores, best, id_col=id_col)
