"""From questions to answers: retrieve, render the prompt, ask the model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from askloom.fixed_values import CHAT_TEMPLATE, CHUNK_TEMPLATE, TOP_K
from askloom.functions.messages import last_message
from askloom.functions.prompts import join_chunks, render
from askloom.operators.embedding import embed
from askloom.operators.keys import look_up, small_side
from askloom.operators.knn import ann_join, knn_join
from askloom.operators.models import Model, batch_generate
from askloom.plans.index import Embedder
from askloom.session import cut, stage


def retrieve(
    questions: DataFrame,
    index: DataFrame,
    *,
    k: int = TOP_K,
    id_col: str = "request_id",
    vec_col: str = "embedding",
    columns: tuple[str, ...] = ("category", "doc_uri", "content"),
    exact: bool = True,
    texts: DataFrame | None = None,
    **search,
) -> DataFrame:
    """(id, chunk_id, columns..., score, rank) of the k nearest chunks of each question.

    ``texts`` (chunk_id and columns that follow from it, equal chunks any number of times) gives the columns that the
    index does not hold. Such an index is narrow, and written once: it is counted, searched and looked up.
    """
    join = knn_join if exact else ann_join
    held = [c for c in columns if texts is None or c in index.columns]
    if texts is not None:
        index = stage(index.select("chunk_id", "embedding", *held), "index")
    hits = join(
        questions, index, k=k, query_key=id_col, query_vec=vec_col,
        index_key="chunk_id", index_vec="embedding", index_cols=held, **search,
    ).withColumnsRenamed({"query_key": id_col, "index_key": "chunk_id"})
    if len(held) == len(columns):
        return hits
    found = with_texts(hits, texts, [c for c in columns if c not in held])
    return found.select(id_col, "chunk_id", *columns, "score", "rank")


def with_texts(hits: DataFrame, texts: DataFrame, columns: list[str]) -> DataFrame:
    """``hits`` with columns of ``texts`` by chunk_id; the texts of few hits are found where they lie."""
    hits = cut(hits)
    ids = small_side(hits.select("chunk_id").distinct())
    wanted = texts.select("chunk_id", *columns).join(ids, "chunk_id", "left_semi")
    return look_up(hits, wanted.dropDuplicates(["chunk_id"]), "chunk_id")


def format_context(
    hits: DataFrame,
    *,
    by: str = "request_id",
    text_col: str = "content",
    template: str = CHUNK_TEMPLATE,
    with_chunks: bool = False,
) -> DataFrame:
    """The texts of each question's hits (k at most) in rank order as one ``context``."""
    if "doc_uri" not in hits.columns:
        hits = hits.withColumn("doc_uri", F.lit(None))
    chunk = F.struct(
        "rank",
        F.col("chunk_id").cast("string").alias("chunk_id"),
        F.col("doc_uri").cast("string").alias("doc_uri"),
        F.col(text_col).alias("content"),
    )
    grouped = hits.groupBy(by).agg(F.array_sort(F.collect_list(chunk)).alias("_ranked"))
    columns = [F.col(by), join_chunks(F.col("_ranked")["content"], template).alias("context")]
    if with_chunks:
        columns.append(
            F.transform("_ranked", lambda c: c.dropFields("rank")).alias("retrieval_context")
        )
    return grouped.select(*columns)


def render_prompt(
    df: DataFrame, template: str, variables: dict[str, str], *, out: str = "prompt"
) -> DataFrame:
    """``df`` plus the filled template; ``variables`` maps placeholders to columns."""
    return df.withColumn(out, render(template, {k: F.col(v) for k, v in variables.items()}))


def prompts_for(
    questions: DataFrame,
    index: DataFrame,
    *,
    k: int = TOP_K,
    template: str = CHAT_TEMPLATE,
    id_col: str = "request_id",
    question_col: str = "question",
    messages_col: str | None = None,
    embedder: Embedder = None,
    exact: bool = True,
    **search,
) -> DataFrame:
    """Each question with its context, its retrieved chunks and the rendered prompt.

    The question is a text column or the newest entry of a message column. A question
    vector may be given as ``embedding``; otherwise ``embedder`` makes it.
    """
    if messages_col is not None:
        questions = questions.withColumn(question_col, last_message(F.col(messages_col)))
    if "embedding" not in questions.columns:
        if embedder is None:
            raise ValueError("give question vectors or the embedder of the index")
        questions = embed(questions, question_col, embedder=embedder)
    hits = retrieve(questions, index, k=k, id_col=id_col, exact=exact, **search)
    context = format_context(hits, by=id_col, with_chunks=True)
    asked = (
        questions.drop("embedding").join(context, id_col, "left")
        .withColumn("context", F.coalesce("context", F.lit("")))
    )
    return render_prompt(asked, template, {"context": "context", "question": question_col})


def answer_questions(
    questions: DataFrame,
    index: DataFrame,
    model: Callable[[], Model],
    *,
    concurrency: int | None = None,
    out: str = "response",
    **options,
) -> DataFrame:
    """:func:`prompts_for` plus the model's answer, ``tries`` and ``error``."""
    prompts = prompts_for(questions, index, **options)
    return batch_generate(prompts, "prompt", model, out=out, concurrency=concurrency)
