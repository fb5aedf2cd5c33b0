"""Questions, evaluation sets, metrics and judges."""

import json
from hashlib import md5

from pyspark.sql import functions as F

from askloom.fixed_values import JUDGE_QUESTIONS, METRIC_KS, QUESTION_TEMPLATE
from askloom.functions.prompts import render
from askloom.functions.text import is_clean_question
from askloom.operators.keys import small_side
from askloom.operators.knn import knn_join
from askloom.operators.metrics import (
    expected_by_category, judged_precision, mark_relevant, ranked_metrics, response_metrics,
    retrieval_metrics,
)
from askloom.operators.models import JUDGE_TEMPLATE, generate_questions, judge, sample_first
from askloom.plans.answering import answer_questions
from askloom.plans.evaluation import (
    ASSESSMENT_QUESTIONS, ASSESSMENT_TEMPLATE, ASSESSMENTS, PER_CHUNK, build_eval_set, judged_answers, split_judged,
)
from askloom.workload.chunks import UNIQUE, doc_chunks, doc_index_rows
from askloom.workload.registry import load, query
from askloom.workload.retrieval import (
    RETRIEVED, VEC, chunk_texts, digest_of_prompt, digest_sql, ranked_sql, vector_index, vector_questions,
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- questions -------------------------------------------------------------------------

def _question_prompt_sql(content: str) -> str:
    before, after = QUESTION_TEMPLATE.replace("{{", "{").replace("}}", "}").split("{context}")
    return f"{quoted(before)} || {content} || {quoted(after)}"


@query("question_prompts", UNIQUE + f"""
    SELECT chunk_id, md5({_question_prompt_sql("content")}) AS prompt_md5 FROM uniq""")
def q_question_prompts(spark, sf):
    prompt = render(QUESTION_TEMPLATE, {"context": F.col("content")})
    return doc_index_rows(spark, sf).select("chunk_id", F.md5(prompt).alias("prompt_md5"))


def digest_question():
    """Offline stand-in for a question model: its question depends on every character of the chunk."""
    start, end = QUESTION_TEMPLATE.replace("{{", "{").replace("}}", "}").split("{context}")

    def ask(prompts):
        answers = []
        for p in prompts:
            context = p[len(start): len(p) - len(end)]
            part = " of this chunk" if "chunk" in context else ""
            answers.append(json.dumps(
                {"question": f"What do the {len(context)} characters{part} under {md5(context.encode()).hexdigest()} say?"}
            ))
        return answers

    return ask


QUESTIONS = UNIQUE + """,
    asked AS (
      SELECT chunk_id, doc_uri, content, 'What do the ' || length(content) || ' characters'
        || CASE WHEN contains(content, 'chunk') THEN ' of this chunk' ELSE '' END
        || ' under ' || md5(content) || ' say?' AS question FROM uniq)"""


@query("generated_questions", QUESTIONS + """
    SELECT chunk_id, question, CASE WHEN contains(question, 'chunk') THEN 5 ELSE 1 END AS tries,
      CAST(NULL AS VARCHAR) AS error
    FROM asked""")
def q_generated_questions(spark, sf):
    asked = generate_questions(doc_index_rows(spark, sf), text_col="content", model=digest_question)
    return asked.select("chunk_id", "question", "tries", "error")


@query("sample_first", UNIQUE + """
    SELECT chunk_id, doc_uri FROM uniq ORDER BY chunk_id LIMIT 20""")
def q_sample_first(spark, sf):
    return sample_first(doc_index_rows(spark, sf).select("chunk_id", "doc_uri"), 20, ["chunk_id"])


@query("sampled_questions", QUESTIONS + """
    SELECT chunk_id, question FROM asked ORDER BY chunk_id LIMIT 20""")
def q_sampled_questions(spark, sf):
    return generate_questions(
        doc_index_rows(spark, sf), text_col="content", n=20, model=digest_question
    ).select("chunk_id", "question")


@query("eval_set", QUESTIONS + """
    SELECT 'synthetic_' || chunk_id AS request_id, md5(question) AS request_md5, chunk_id,
      CAST(doc_uri AS VARCHAR) AS doc_uri, md5(content) AS content_md5, 1 AS n_expected
    FROM asked""")
def q_eval_set(spark, sf):
    chunks = doc_index_rows(spark, sf)
    built = build_eval_set(generate_questions(chunks, text_col="content", model=digest_question), chunks)
    first = F.col("expected_retrieval_context")[0]
    return built.select(
        "request_id", F.md5("request").alias("request_md5"), first["chunk_id"].alias("chunk_id"),
        first["doc_uri"].alias("doc_uri"), F.md5(first["content"]).alias("content_md5"),
        F.size("expected_retrieval_context").alias("n_expected"),
    )


@query("question_check", """
    SELECT role, count(*) FILTER (WHERE NOT contains(text, 'chunk')) AS clean, count(*) AS n
    FROM conversations GROUP BY role""")
def q_question_check(spark, sf):
    return load(spark, sf, "conversations").groupBy("role").agg(
        F.count_if(is_clean_question(F.col("text"))).alias("clean"), F.count(F.lit(1)).alias("n")
    )


# --- retrieval metrics -----------------------------------------------------------------

def metrics_sql(n: str) -> str:
    """Select list from ``h<k>`` hits and ``g<k>`` gains with ``n`` relevant ids."""
    out = []
    for k in METRIC_KS:
        ideal = f"list_sum(list_transform(range(1, least({n}, {k}) + 1), lambda r: 1 / log2(r + 1)))"
        out += [
            f"h{k} / {k} AS ground_truth_precision_at_{k}",
            f"h{k} / nullif({n}, 0) AS ground_truth_recall_at_{k}",
            f"g{k} / {ideal} AS ground_truth_ndcg_at_{k}",
        ]
    return ", ".join(out)


def sums_sql(relevant: str) -> str:
    """Aggregates ``h<k>`` and ``g<k>`` over rows with a ``rank``."""
    return ", ".join(
        f"count(*) FILTER (WHERE rank <= {k} AND {relevant}) AS h{k}, "
        f"sum(CASE WHEN rank <= {k} AND {relevant} THEN 1 / log2(rank + 1) ELSE 0 END) AS g{k}"
        for k in METRIC_KS
    )


TRUTH = [f"ground_truth_{m}_at_{k}" for k in METRIC_KS for m in ("precision", "recall", "ndcg")]
ROUNDED = ", ".join(f"round({n}, 6) AS {n}" for n in TRUTH)


def rounded_metrics(df, *keys):
    return df.select(*keys, *[F.round(n, 6).alias(n) for n in TRUTH])


@query("retrieval_metrics_label", "WITH" + ranked_sql(10) + f""",
    sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
    judged AS (
      SELECT q, n, {sums_sql("a.label = b.label")}
      FROM hits JOIN embeddings a ON a.vec_id = q JOIN embeddings b ON b.vec_id = i
      JOIN sizes s ON s.label = a.label GROUP BY q, n),
    scored AS (SELECT q AS query_key, {metrics_sql("n")} FROM judged)
    SELECT query_key, {ROUNDED} FROM scored""")
def q_retrieval_metrics_label(spark, sf):
    """Every vector of the same label counts as expected: a whole category as context."""
    e = load(spark, sf, "embeddings")
    hits = knn_join(e, e, k=10, index_cols=["label"], **VEC)
    asked = expected_by_category(
        e.select(F.col("vec_id").alias("query_key"), F.col("label").alias("query_category")), e,
        category="label",
    )
    marked = mark_relevant(hits.join(asked, "query_key"), category="label")
    return rounded_metrics(ranked_metrics(marked, asked), "query_key")


ABOUT = "What does this say: "
#: Labels (three numbers each) up to which they go to the documents, whose texts are then not shuffled.
LABELS = 1_000_000
REQUEST = f"'{ABOUT}' || text"


def evaluation_rows(spark, sf):
    """One evaluated request per label, with contexts made from the document number."""
    labels = small_side(load(spark, sf, "labels"), LABELS)
    rows = labels.join(load(spark, sf, "documents"), "doc_id")
    doc, good = F.col("doc_id"), F.col("quality") == 1

    def chunk(number):
        return F.struct(
            F.concat(F.lit("c"), number).alias("chunk_id"),
            F.concat(F.lit("doc-"), doc).alias("doc_uri"),
            F.concat(F.lit("text "), number).alias("content"),
        )

    expected = F.slice(
        F.array(*[chunk(doc + i) for i in range(3)]), F.lit(1), (doc % 4).cast("int")
    )
    ten = F.sequence(F.lit(0), F.lit(9))
    retrieved = F.transform(ten, lambda i: chunk(doc + (i * i + doc) % 12))
    ratings = F.struct(
        (F.col("toxic") == 1).alias("harmful"),
        good.alias("faithful_to_context"),
        (good & (F.col("toxic") == 0)).alias("relevant_to_question_and_context"),
        (F.col("n_chars") > 500).alias("relevant_to_question"),
        good.alias("answer_good"),
    )
    return rows.select(
        F.concat(F.lit("r"), doc).alias("request_id"),
        F.concat(F.lit("run-"), "source").alias("run_url"),
        F.col("lang").alias("app_version"),
        F.concat(F.lit(ABOUT), "text").alias("request"),
        F.when(good, F.col("text")).alias("expected_response"),
        F.concat("text", F.lit(" ")).alias("response"),
        expected.alias("expected_retrieval_context"),
        retrieved.alias("retrieval_context"),
        ratings.alias("ratings"),
        F.transform(ten, lambda i: (doc + i) % 3 == 0).alias("positional_ratings"),
    )


def evaluation_tables(spark, sf):
    """(metrics, assessments) in the layouts an evaluation run leaves behind."""
    return split_judged(
        judged_precision(retrieval_metrics(response_metrics(evaluation_rows(spark, sf))))
    )


EVALUATED = f"""
    WITH base AS (SELECT * FROM labels JOIN documents USING (doc_id)),
    got AS (
      SELECT doc_id, ofs, row_number() OVER (PARTITION BY doc_id ORDER BY first) AS rank
      FROM (
        SELECT doc_id, (i * i + doc_id) % 12 AS ofs, min(i) AS first
        FROM base, range(10) AS r(i) GROUP BY ALL)),
    sums AS (SELECT doc_id, {sums_sql("ofs < least(doc_id % 4, 3)")} FROM got GROUP BY doc_id),
    truth AS (SELECT doc_id, {metrics_sql("least(doc_id % 4, 3)")} FROM sums),
    judged AS (
      SELECT doc_id, {", ".join(
        f"sum(CASE WHEN (doc_id + i) % 3 = 0 AND i < {k} THEN 1 ELSE 0 END) / {k} "
        f"AS llm_judged_precision_at_{k}" for k in METRIC_KS)}
      FROM base, range(10) AS r(i) GROUP BY doc_id),
    response AS (
      SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS token_count,
        CASE WHEN quality = 1 THEN TRUE END AS exact_match, toxic = 1 AS llm_judged_harmful,
        quality = 1 AS llm_judged_faithful_to_context,
        quality = 1 AND toxic = 0 AS llm_judged_relevant_to_question_and_context,
        n_chars > 500 AS llm_judged_relevant_to_question, quality = 1 AS llm_judged_answer_good
      FROM base)"""


@query("retrieval_metrics", EVALUATED + f"""
    SELECT 'r' || doc_id AS request_id, {ROUNDED} FROM truth""")
def q_retrieval_metrics(spark, sf):
    return rounded_metrics(retrieval_metrics(evaluation_rows(spark, sf)), "request_id")


@query("judged_precision", EVALUATED + f"""
    SELECT 'r' || doc_id AS request_id, {", ".join(
      f"round(llm_judged_precision_at_{k}, 6) AS llm_judged_precision_at_{k}" for k in METRIC_KS)}
    FROM judged""")
def q_judged_precision(spark, sf):
    return judged_precision(evaluation_rows(spark, sf)).select(
        "request_id",
        *[F.round(f"llm_judged_precision_at_{k}", 6).alias(f"llm_judged_precision_at_{k}")
          for k in METRIC_KS],
    )


@query("response_metrics", EVALUATED + """
    SELECT 'r' || doc_id AS request_id, CAST(token_count AS INT) AS token_count, exact_match
    FROM response""")
def q_response_metrics(spark, sf):
    return response_metrics(evaluation_rows(spark, sf)).select(
        "request_id", "token_count", "exact_match"
    )


# --- judges ----------------------------------------------------------------------------

def parity_judge():
    """Offline stand-in for a judge: yes to prompts of even length."""
    return lambda prompts: ["Yes, it does." if len(p) % 2 == 0 else "No." for p in prompts]


def _judge_prompt_length(question: str) -> str:
    fixed = len(JUDGE_TEMPLATE.format(request="", response="", question=question))
    return f"({fixed} + length(request) + length(response))"


JUDGED = f"""
    WITH rows AS (
      SELECT doc_id, {REQUEST} AS request, text || ' ' AS response
      FROM labels JOIN documents USING (doc_id))""" + ",\n    verdicts AS (SELECT doc_id, " + ", ".join(
        f"{_judge_prompt_length(q)} % 2 = 0 AS {name}" for name, q in JUDGE_QUESTIONS.items()
    ) + " FROM rows)"


@query("judge_score", JUDGED + """
    SELECT 'r' || doc_id AS request_id, harmless, specific, value_add,
      CAST(harmless AS INT) + CAST(specific AS INT) + CAST(value_add AS INT) AS score
    FROM verdicts""")
def q_judge_score(spark, sf):
    rows = evaluation_rows(spark, sf).select("request_id", "request", "response")
    return judge(rows, parity_judge).select(
        "request_id",
        *[F.col("verdicts")[i]["passed"].alias(name) for i, name in enumerate(JUDGE_QUESTIONS)],
        "score",
    )


def _assessment_sql(question: str, context: str) -> str:
    """Whether the judge says yes: the parity of the length of its prompt."""
    fixed = len(ASSESSMENT_TEMPLATE.format(question=question, request="", context="", response=""))
    return f"({fixed} + length(question) + length({context}) + length(response)) % 2 = 0"


OF_RESPONSE = [a for a in ASSESSMENTS if a != PER_CHUNK]


@query("evaluate_run", RETRIEVED + f""",
    answered AS (SELECT request_id, question, {digest_sql()} AS response FROM asked),
    own AS (SELECT 'q' || doc_id AS request_id, chunk_id AS expected FROM chunks WHERE chunk_no = 0),
    judged AS (
      SELECT a.request_id, count(o.expected) > 0 AS known, {sums_sql("f.chunk_id = o.expected")}
      FROM answered a LEFT JOIN own o USING (request_id) LEFT JOIN found f USING (request_id) GROUP BY a.request_id),
    scored AS (
      SELECT request_id, known, {metrics_sql("(CASE WHEN known THEN 1 ELSE 0 END)")} FROM judged),
    wholes AS (
      SELECT a.request_id, question, response, coalesce(string_agg(content, chr(10) ORDER BY rank), '') AS whole,
        string_agg(CASE WHEN {_assessment_sql(ASSESSMENT_QUESTIONS[PER_CHUNK], "content")} THEN 'y' ELSE 'n' END, ''
          ORDER BY rank) AS chunk_verdicts
      FROM answered a LEFT JOIN found f USING (request_id) GROUP BY ALL)
    SELECT request_id, CAST(len(list_filter(string_split_regex(response, '\\s+'), lambda x: x <> '')) AS INT) AS token_count,
      {", ".join(f"{_assessment_sql(ASSESSMENT_QUESTIONS[a], 'whole')} AS {a}" for a in OF_RESPONSE)},
      CASE WHEN whole = '' AND chunk_verdicts = 'n' THEN '' ELSE chunk_verdicts END AS chunk_verdicts, {ROUNDED}
    FROM wholes JOIN scored USING (request_id)""")
def q_evaluate_run(spark, sf):
    """Retrieve, answer, judge and score; each question expects the first chunk of its document."""
    index, questions = vector_index(spark, sf), vector_questions(spark, sf)
    first = doc_chunks(spark, sf).where("chunk_no = 0").select(
        F.concat(F.lit("q"), "doc_id").alias("request_id"),
        F.array(F.struct(
            "chunk_id", F.lit(None).cast("string").alias("doc_uri"), F.lit(None).cast("string").alias("content"),
        )).alias("expected_retrieval_context"),
    )
    eval_set = questions.select("request_id", F.col("question").alias("request")).join(first, "request_id", "left")
    judged = judged_answers(
        eval_set, answer_questions(questions, index, digest_of_prompt, texts=chunk_texts(spark, sf)), parity_judge,
        run="run-1", app_version="1",
    )
    letters = F.transform("positional_ratings", lambda r: F.when(r, "y").otherwise("n"))
    return rounded_metrics(
        judged, "request_id", "token_count", *[F.col(f"ratings.{a}").alias(a) for a in OF_RESPONSE],
        F.array_join(letters, "").alias("chunk_verdicts"),
    )
