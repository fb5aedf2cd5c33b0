"""Run a text model over a prompt column.

A model is a factory: called once per task, it returns a function from a list of prompts
to a list of answers. Only the prompts travel to Python; failures stay in the row.
Concurrency is the number of partitions: pass ``concurrency`` to set it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from askloom.fixed_values import (
    FORBIDDEN_QUESTION_WORD,
    JUDGE_QUESTIONS,
    QUESTION_RETRIES,
    QUESTION_TEMPLATE,
)
from askloom.functions.prompts import render
from askloom.functions.text import says_yes

Model = Callable[[list[str]], list[str]]


def _ask_each(model: Model, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(answer, error) per prompt; a failing batch is asked again one by one."""
    try:
        answers = list(model(prompts))
        if len(answers) == len(prompts):
            return [(a, None) for a in answers]
        failure = f"{len(answers)} answers for {len(prompts)} prompts"
    except Exception as e:  # noqa: BLE001 - a model may raise anything
        failure = f"{type(e).__name__}: {e}"
    if len(prompts) == 1:
        return [(None, failure)]
    return [_ask_each(model, [p])[0] for p in prompts]


def _model_column(
    prompts: Column,
    model: Callable[[], Model],
    max_tries: int,
    reject: Callable[[str], bool] | None,
    parse: Callable[[str], str] | None,
) -> Column:
    @F.pandas_udf("output string, tries int, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ask = model()
        for batch in batches:
            prompts = batch.tolist()
            rows: list[tuple] = [(None, 0, None)] * len(prompts)
            todo = [i for i, p in enumerate(prompts) if p is not None]
            for turn in range(1, max_tries + 1):
                again = []
                answers = _ask_each(ask, [prompts[i] for i in todo]) if todo else []
                for i, (answer, error) in zip(todo, answers):
                    refused = False
                    if error is None:
                        try:
                            answer = answer if parse is None else parse(answer)
                            if not isinstance(answer, str):
                                raise TypeError(f"an answer is a string, not {type(answer).__name__}")
                            refused = reject is not None and reject(answer)
                        except Exception as e:  # noqa: BLE001
                            answer, error = None, f"{type(e).__name__}: {e}"
                    rows[i] = (answer, turn, error)
                    if refused:
                        again.append(i)
                todo = again
            yield pd.DataFrame(rows, columns=["output", "tries", "error"])

    # A model may be costly or random: never evaluate it twice for one row.
    return run.asNondeterministic()(prompts)


def batch_generate(
    df: DataFrame,
    prompt_col: str,
    model: Callable[[], Model],
    *,
    out: str = "output",
    max_tries: int = 1,
    reject: Callable[[str], bool] | None = None,
    parse: Callable[[str], str] | None = None,
    concurrency: int | None = None,
) -> DataFrame:
    """``df`` plus the answer, the number of ``tries`` and an ``error`` text.

    An answer for which ``reject`` is true is asked for again, up to ``max_tries`` times; the
    last one is kept. An error ends the row. A null prompt is not asked (0 tries).
    """
    if concurrency:
        df = df.repartition(concurrency)
    kept = [c for c in df.columns]
    asked = df.withColumn("_run", _model_column(F.col(prompt_col), model, max_tries, reject, parse))
    return asked.select(*kept, F.col("_run.output").alias(out), "_run.tries", "_run.error")


def sentence_question() -> Model:
    """Offline stand-in for a question model: asks about the first sentence of the context."""
    start, end = "context: ", "\n\n    Please return"

    def ask(prompts: list[str]) -> list[str]:
        answers = []
        for prompt in prompts:
            context = prompt.split(start, 1)[-1].rsplit(end, 1)[0]
            head, dot, _ = context.partition(".")
            answers.append(json.dumps({"question": f"What follows from: {head}{dot}?"}))
        return answers

    return ask


def _question_of(answer: str) -> str:
    return json.loads(answer)["question"]


def generate_questions(
    chunks: DataFrame,
    *,
    id_col: str = "chunk_id",
    text_col: str = "chunk",
    n: int | None = None,
    model: Callable[[], Model] = sentence_question,
    max_tries: int = 1 + QUESTION_RETRIES,
    concurrency: int | None = None,
) -> DataFrame:
    """One question per chunk: ``id_col``, ``question``, ``tries``, ``error``.

    Questions that speak of a "chunk" are asked for again; the last one is kept. All
    chunks are asked about; ``n`` takes the first n by id.
    """
    if n is not None:
        chunks = sample_first(chunks, n, [id_col])
    prompts = chunks.select(
        id_col, render(QUESTION_TEMPLATE, {"context": F.col(text_col)}).alias("_prompt")
    )
    return batch_generate(
        prompts, "_prompt", model, out="question", max_tries=max_tries,
        reject=lambda q: FORBIDDEN_QUESTION_WORD in q, parse=_question_of,
        concurrency=concurrency,
    ).drop("_prompt")


def sample_first(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def _verdict(answer: object, error: str | None) -> dict[str, str | None]:
    if error is None and answer is not None and not isinstance(answer, str):
        error = f"TypeError: an answer is a string, not {type(answer).__name__}"
    return {"answer": answer if error is None else None, "error": error}


def first_error(answers: str) -> Column:
    """The first error among a row's answers; null without any."""
    failed = F.filter(F.col(answers), lambda a: a["error"].isNotNull())
    return F.try_element_at(failed, F.lit(1))["error"]


def answer_each(prompts: Column, model: Callable[[], Model]) -> Column:
    """``answer`` and ``error`` for each of a row's array of prompts, in order.

    A null prompt is not asked and has neither. A failure, or an answer that is no string, is an error.
    """

    @F.pandas_udf("array<struct<answer:string,error:string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ask = model()
        for batch in batches:
            flat = [p for row in batch for p in row if p is not None]
            got = iter(_ask_each(ask, flat) if flat else [])
            yield pd.Series(
                [[_verdict(*((None, None) if p is None else next(got))) for p in row] for row in batch],
                index=batch.index,
            )

    return run.asNondeterministic()(prompts)


JUDGE_TEMPLATE = (
    "Assess the quality of a response along the specified dimension. Answer Yes or No.\n\n"
    "Request: {request}\nResponse To Assess: {response}\nAssessment Question: {question}\n"
    "Assessment Answer:"
)


def judge(
    df: DataFrame,
    model: Callable[[], Model],
    *,
    request_col: str = "request",
    response_col: str = "response",
    questions: dict[str, str] = JUDGE_QUESTIONS,
    template: str = JUDGE_TEMPLATE,
) -> DataFrame:
    """``df`` plus ``verdicts`` (question name, answer, passed) and ``score``, the passes.

    A question that the judge failed on has no ``passed``, and its row no ``score`` but a ``judge_error``.
    All questions about a row are asked in one task, so nothing is shuffled.
    """
    names = list(questions)
    prompts = F.array(
        *[
            render(
                template,
                {
                    "request": F.col(request_col),
                    "response": F.col(response_col),
                    "question": F.lit(questions[name]),
                },
            )
            for name in names
        ]
    )

    asked = df.withColumn("_answers", answer_each(prompts, model))
    verdict = "array<struct<name:string,answer:string,passed:boolean>>"
    verdicts = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.col("_answers")[i]["answer"].alias("answer"),
                says_yes(F.col("_answers")[i]["answer"]).alias("passed"),
            )
            for i, name in enumerate(names)
        ]
    ).cast(verdict)
    return asked.withColumn("verdicts", verdicts).withColumn(
        "score", F.when(
            ~F.exists("verdicts", lambda v: v["passed"].isNull()),
            F.size(F.filter("verdicts", lambda v: v["passed"])),
        )
    ).withColumn("judge_error", first_error("_answers")).drop("_answers")
