"""Golden set, train/test split and the search for good few-shot examples."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from askloom.fixed_values import (
    MAX_GENERATED_DEMOS,
    MAX_LABELLED_DEMOS,
    RESPOND_INSTRUCTIONS,
    SPLIT_FOLDS,
)
from askloom.functions.prompts import render
from askloom.operators.keys import row_index
from askloom.operators.models import Model, batch_generate, judge
from askloom.operators.reports import best_candidate
from askloom.session import cut


class Program(NamedTuple):
    """A prompt program: examples as dicts of the saved layout, and whether the model reasons first."""

    demos: list[dict]
    instructions: str = RESPOND_INSTRUCTIONS
    reasons: bool = True

    def prefix(self) -> str:
        return demo_prefix(self.demos, reasons=self.reasons)


GOLDEN_FLAG = "response_metrics.llm_judged_relevant_to_question_and_context"


def golden_set(metrics: DataFrame, *, id_col: str = "request_id", flag: str = GOLDEN_FLAG) -> DataFrame:
    """Rows judged relevant: id, request, response and the retrieved texts as one string."""
    context = F.concat_ws("; ", F.transform("retrieval_context", lambda c: c["content"]))
    return metrics.where(F.col(flag).cast("int") == 1).select(
        id_col, "request", "response", context.alias("context")
    )


def golden_split(
    metrics: DataFrame, *, id_col: str = "request_id", folds: int = SPLIT_FOLDS,
    flag: str = GOLDEN_FLAG,
) -> DataFrame:
    """The golden set plus ``split``: in id order, every last of ``folds`` rows is for testing."""
    numbered = row_index(golden_set(metrics, id_col=id_col, flag=flag), [id_col], out="_i")
    return numbered.withColumn(
        "split", F.when(F.col("_i") % folds < folds - 1, "train").otherwise("test")
    ).drop("_i")


DEMO_TEMPLATE = "Request: {request}\nContext: {context}\nResponse: {response}\n\n---\n\n"
TASK_TEMPLATE = "Request: {request}\nContext: {context}\nResponse:"
# With a reasoning step the model writes how it gets to the response before the response itself.
REASONED_DEMO_TEMPLATE = (
    "Request: {request}\nContext: {context}\nReasoning: {rationale}\nResponse: {response}\n\n---\n\n"
)
REASONED_TASK_TEMPLATE = "Request: {request}\nContext: {context}\nReasoning:"
RESPONSE_MARK = "\nResponse:"


def demo_prefix(demos: list[dict], *, reasons: bool = False) -> str:
    """Instructions and examples that go before the task of a prompt."""
    template = REASONED_DEMO_TEMPLATE if reasons else DEMO_TEMPLATE
    shown = "".join(
        template.format(**{k: d.get(k) or "" for k in ("request", "context", "rationale", "response")})
        for d in demos
    )
    return f"{RESPOND_INSTRUCTIONS}\n\n---\n\n{shown}"


def answer_with(
    df: DataFrame, prefix_col: str, model: Callable[[], Model], out: str, *, reasons: bool = False
) -> DataFrame:
    """Ask for a response to (request, context) after the prefix of the row.

    With ``reasons`` the answer is cut at the last line that starts with ``Response:``; what stands before
    it goes to ``<out>_rationale``, and an answer without such a line is all response.
    """
    template = REASONED_TASK_TEMPLATE if reasons else TASK_TEMPLATE
    task = render(template, {"request": F.col("request"), "context": F.col("context")})
    prompts = df.withColumn("_prompt", F.concat(F.col(prefix_col), task))
    answered = batch_generate(prompts, "_prompt", model, out=out).drop("_prompt", "tries", "error")
    if not reasons:
        return answered
    marked = F.instr(F.col(out), RESPONSE_MARK) > 0
    return answered.withColumns({
        f"{out}_rationale": F.when(marked, F.trim(F.regexp_extract(out, "(?s)^(.*)\nResponse:", 1))),
        out: F.when(marked, F.trim(F.substring_index(out, RESPONSE_MARK, -1))).otherwise(F.col(out)),
    })


def _sample_demos(
    pool: DataFrame, candidates: list[int], most: int, id_col: str, salt: str
) -> dict[int, list[dict]]:
    """Up to ``most`` rows per candidate in the order of a seeded hash; a few rows in all."""
    order = F.md5(F.concat_ws("#", F.lit(salt), F.col("candidate"), F.col(id_col)))
    w = Window.partitionBy("candidate").orderBy(order, id_col)
    rows = (
        pool.withColumn("candidate", F.explode(F.array(*[F.lit(c) for c in candidates])))
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= most)
        .orderBy("candidate", "_rn")
        .select("candidate", "augmented", "request", "context", "rationale", "response")
        .collect()
    )
    chosen: dict[int, list[dict]] = {c: [] for c in candidates}
    for row in rows:
        chosen[row["candidate"]].append(row.asDict())
    return chosen


def fewshot_search(
    train: DataFrame,
    model: Callable[[], Model],
    judge_model: Callable[[], Model],
    *,
    teacher: Callable[[], Model] | None = None,
    candidates: int = 8,
    max_generated: int = MAX_GENERATED_DEMOS,
    max_labelled: int = MAX_LABELLED_DEMOS,
    accept: int = 3,
    id_col: str = "request_id",
    reasons: bool = False,
) -> tuple[DataFrame, dict[int, str]]:
    """(scores, prefixes): the judge score of every training row under every candidate prompt.

    ``train`` has an id, request, context and response. Candidate 0 shows no example, candidate 1
    labelled rows only, the others also rows whose answer by the teacher reached the score
    ``accept``; each candidate draws its examples by its own seeded hash. Every training row is
    repeated once per candidate (a handful), which is all the growth there is. The best one is
    ``best_candidate(scores)``; its prompt prefix is in ``prefixes``. With ``reasons`` the models
    reason before they respond, and generated examples show the teacher's reasoning.
    """
    scores, demos = search_demos(
        train, model, judge_model, teacher=teacher, candidates=candidates, max_generated=max_generated,
        max_labelled=max_labelled, accept=accept, id_col=id_col, reasons=reasons,
    )
    return scores, {c: demo_prefix(d, reasons=reasons) for c, d in demos.items()}


def search_demos(
    train: DataFrame,
    model: Callable[[], Model],
    judge_model: Callable[[], Model],
    *,
    teacher: Callable[[], Model] | None,
    candidates: int,
    max_generated: int,
    max_labelled: int,
    accept: int,
    id_col: str,
    reasons: bool,
) -> tuple[DataFrame, dict[int, list[dict]]]:
    """:func:`fewshot_search` with the examples themselves instead of the prompt prefixes."""
    bare = demo_prefix([])
    taught = answer_with(
        train.withColumn("_prefix", F.lit(bare)), "_prefix", teacher or model, "_taught", reasons=reasons
    )
    if not reasons:
        taught = taught.withColumn("_taught_rationale", F.lit(None).cast("string"))
    good = (
        judge(taught, judge_model, response_col="_taught")
        .where(F.col("score") >= accept)
        .select(
            id_col, "request", "context", F.col("_taught").alias("response"),
            F.col("_taught_rationale").alias("rationale"), F.lit(True).alias("augmented"),
        )
    )
    good = cut(good)  # model output: asked for once
    pool = train.withColumns({"rationale": F.lit(None).cast("string"), "augmented": F.lit(False)})
    labelled = _sample_demos(pool, list(range(1, candidates)), max_labelled, id_col, "labelled")
    generated = _sample_demos(good, list(range(2, candidates)), max_generated, id_col, "generated")
    demos = {c: generated.get(c, []) + labelled.get(c, []) for c in range(candidates)}
    # A few prompts: the number of candidates and examples is fixed by the arguments.
    table = F.array(
        *[F.struct(F.lit(c).alias("candidate"), F.lit(demo_prefix(d, reasons=reasons)).alias("prefix"))
          for c, d in demos.items()]
    )
    trials = train.withColumn("_c", F.explode(table)).select(
        id_col, "request", "context", F.col("_c.candidate").alias("candidate"),
        F.col("_c.prefix").alias("_prefix"),
    )
    answered = answer_with(trials, "_prefix", model, "answer", reasons=reasons).drop("_prefix")
    scores = judge(answered, judge_model, response_col="answer").select(
        id_col, "candidate", "answer", "score"
    )
    return cut(scores), demos


def tune(train: DataFrame, model, judge_model, **options) -> tuple[int, str]:
    """Number and prompt prefix of the best candidate."""
    scores, prefixes = fewshot_search(train, model, judge_model, **options)
    best = best_candidate(scores).first()["candidate"]
    return best, prefixes[best]


def tune_program(
    train: DataFrame, model, judge_model, *, reasons: bool = True, teacher=None, candidates: int = 8,
    max_generated: int = MAX_GENERATED_DEMOS, max_labelled: int = MAX_LABELLED_DEMOS, accept: int = 3,
    id_col: str = "request_id",
) -> Program:
    """The best candidate as a program to save and to use again."""
    scores, demos = search_demos(
        train, model, judge_model, teacher=teacher, candidates=candidates, max_generated=max_generated,
        max_labelled=max_labelled, accept=accept, id_col=id_col, reasons=reasons,
    )
    best = best_candidate(scores).first()["candidate"]
    kept = [{k: d[k] for k in ("augmented", "request", "context", "rationale", "response")} for d in demos[best]]
    return Program(kept, RESPOND_INSTRUCTIONS, reasons)
