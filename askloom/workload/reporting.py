"""Run summaries, reports, golden set, comparisons and the few-shot search."""

from hashlib import md5

from pyspark.sql import Window, functions as F

from askloom.fixed_values import METRICS
from askloom.operators.models import judge, sample_first
from askloom.operators.reports import (
    JUDGED, avg_metrics_by_run, best_candidate, compare_systems, eval_report, json_rows,
    mean_score, report_rows,
)
from askloom.operators.terms import search_terms, term_index
from askloom.plans.answering import with_texts
from askloom.plans.comparison import (
    System, compare_held_out, read_program, read_programs, write_program, write_programs,
)
from askloom.plans.runs import summarise_run
from askloom.plans.tuning import (
    DEMO_TEMPLATE, REASONED_DEMO_TEMPLATE, REASONED_TASK_TEMPLATE, TASK_TEMPLATE, Program, demo_prefix, fewshot_search,
    golden_set, golden_split,
)
from askloom.session import scratch_path
from askloom.workload.chunks import UNIQUE, doc_index_rows
from askloom.workload.evaluation import EVALUATED, REQUEST, evaluation_tables, parity_judge, quoted
from askloom.workload.registry import load, query
from askloom.workload.retrieval import chunk_texts, text_hits_sql

SHORT = [m.split(".")[1] for m in METRICS]
AVERAGES = EVALUATED + """,
    means AS (
      SELECT 'run-' || source AS run_url, """ + ", ".join(
    f"round(avg(CAST({m} AS FLOAT)), 6) AS {m}" for m in SHORT
) + """
      FROM base JOIN truth USING (doc_id) JOIN judged USING (doc_id) JOIN response USING (doc_id)
      GROUP BY 1)"""


def _rounded(df):
    return df.select("run_url", *[F.round(m, 6).alias(m) for m in SHORT])


@query("avg_metrics_by_run", AVERAGES + " SELECT * FROM means")
def q_avg_metrics_by_run(spark, sf):
    return _rounded(avg_metrics_by_run(evaluation_tables(spark, sf)[0]))


@query("avg_metrics_one_run", AVERAGES + " SELECT * FROM means WHERE run_url = 'run-src1'")
def q_avg_metrics_one_run(spark, sf):
    return _rounded(avg_metrics_by_run(evaluation_tables(spark, sf)[0], run="run-src1"))


@query("metrics_long", AVERAGES + """
    SELECT run_url, metric, value FROM (
      UNPIVOT means ON COLUMNS(* EXCLUDE run_url) INTO NAME metric VALUE value)""")
def q_metrics_long(spark, sf):
    return summarise_run(evaluation_tables(spark, sf)[0]).withColumn("value", F.round("value", 6))


def _reviewed(spark, sf):
    """Metrics, and assessments of which the harmful ones belong to another version."""
    metrics, assessments = evaluation_tables(spark, sf)
    harmful = F.col("response_assessment.ratings.harmful")
    version = F.when(harmful, F.concat(F.lit("old-"), "app_version")).otherwise(F.col("app_version"))
    return metrics, assessments.withColumn("app_version", version)


REPORT = EVALUATED + f""",
    report AS (
      SELECT 'r' || doc_id AS request_id, lang AS app_version, {REQUEST} AS request,
        CASE WHEN quality = 1 THEN text END AS expected_response, text || ' ' AS response,
        doc_id, source, toxic = 0 AS matched, """ + ", ".join(
    f"CASE WHEN toxic = 0 THEN llm_judged_{n} END AS judge_{n}" for n in JUDGED
) + """
      FROM base JOIN response USING (doc_id))"""
MATCHED = ", ".join(f"judge_{n}" for n in JUDGED)


@query("eval_report", REPORT + f"""
    SELECT request_id, app_version, md5(request) AS request_md5, md5(response) AS response_md5,
      md5(expected_response) AS expected_md5, CAST(least(doc_id % 4, 3) AS INT) AS n_expected,
      10 AS n_retrieved, {MATCHED}, CASE WHEN matched THEN 10 END AS n_rated
    FROM report""")
def q_eval_report(spark, sf):
    return eval_report(*_reviewed(spark, sf)).select(
        "request_id", "app_version", F.md5("request").alias("request_md5"),
        F.md5("response").alias("response_md5"), F.md5("expected_response").alias("expected_md5"),
        F.size("expected_retrieval_context").alias("n_expected"),
        F.size("retrieval_context").alias("n_retrieved"),
        *[f"judge_{n}" for n in JUDGED],
        F.array_size("judge_context_relevant_to_question").alias("n_rated"),
    )


@query("report_rows", REPORT + """,
    nested AS (
      SELECT doc_id,
        string_agg('{"chunk_id":"c' || n || '","doc_uri":"doc-' || doc_id
          || '","content":"text ' || n || '"}', ',' ORDER BY i)
          FILTER (WHERE i < least(doc_id % 4, 3)) AS expected,
        string_agg(CAST((doc_id + i) % 3 = 0 AS VARCHAR), ',' ORDER BY i) AS rated
      FROM (SELECT doc_id, i, doc_id + i AS n FROM base, range(10) AS r(i)) GROUP BY doc_id)
    SELECT request_id, md5(coalesce(expected_response, 'null')) AS expected_md5,
      '[' || coalesce(expected, '') || ']' AS expected_retrieval_context,
      coalesce(CAST(judge_harmful AS VARCHAR), 'null') AS judge_harmful,
      CASE WHEN matched THEN '[' || rated || ']' ELSE 'null' END
        AS judge_context_relevant_to_question
    FROM report JOIN nested USING (doc_id) WHERE source = 'src1'""")
def q_report_rows(spark, sf):
    rows = report_rows(eval_report(*_reviewed(spark, sf), run="run-src1"))
    return rows.select(
        "request_id", F.md5("expected_response").alias("expected_md5"),
        "expected_retrieval_context", "judge_harmful", "judge_context_relevant_to_question",
    )


@query("json_rows", """
    SELECT '{"doc_id":' || doc_id || CASE WHEN quality = 1 THEN ',"quality":1' ELSE '' END
      || ',"toxic":' || toxic || '}' AS json FROM labels""")
def q_json_rows(spark, sf):
    rows = load(spark, sf, "labels").withColumn("quality", F.nullif("quality", F.lit(0)))
    return json_rows(rows.select("doc_id", "quality", "toxic"))


@query("json_rows_nulls", """
    SELECT '{"doc_id":' || doc_id || ',"quality":' || CASE WHEN quality = 1 THEN '1' ELSE 'null' END
      || ',"toxic":' || toxic || '}' AS json FROM labels""")
def q_json_rows_nulls(spark, sf):
    rows = load(spark, sf, "labels").withColumn("quality", F.nullif("quality", F.lit(0)))
    return json_rows(rows.select("doc_id", "quality", "toxic"), keep_nulls=True)


GOLDEN = f"""
    WITH golden AS (
      SELECT doc_id, 'r' || doc_id AS request_id, {REQUEST} AS request,
        text || ' ' AS response
      FROM labels JOIN documents USING (doc_id) WHERE quality = 1 AND toxic = 0),
    texts AS (
      SELECT request_id, string_agg('text ' || (doc_id + (i * i + doc_id) % 12), '; ' ORDER BY i)
        AS context
      FROM golden, range(10) AS r(i) GROUP BY request_id),
    split AS (
      SELECT *, CASE WHEN (row_number() OVER (ORDER BY request_id) - 1) % 5 < 4 THEN 'train'
        ELSE 'test' END AS split FROM golden)"""


@query("golden_set", GOLDEN + """
    SELECT request_id, md5(request) AS request_md5, md5(response) AS response_md5, context
    FROM golden JOIN texts USING (request_id)""")
def q_golden_set(spark, sf):
    return golden_set(evaluation_tables(spark, sf)[0]).select(
        "request_id", F.md5("request").alias("request_md5"),
        F.md5("response").alias("response_md5"), "context",
    )


@query("golden_split", GOLDEN + " SELECT request_id, split FROM split")
def q_golden_split(spark, sf):
    return golden_split(evaluation_tables(spark, sf)[0]).select("request_id", "split")


def _systems(spark, sf):
    """Three systems answer every golden request; the judge scores each answer."""
    golden = golden_set(evaluation_tables(spark, sf)[0])
    answers = F.array(
        F.struct(F.lit("raw").alias("system"), F.concat("response", F.lit(".")).alias("response")),
        F.struct(F.lit("second").alias("system"), F.col("context").alias("response")),
        F.struct(F.lit("tuned").alias("system"), F.col("response")),
    )
    rows = golden.select("request_id", "request", F.explode(answers).alias("a"))
    return judge(rows.select("request_id", "request", "a.system", "a.response"), parity_judge)


def _score_sql() -> str:
    from askloom.fixed_values import JUDGE_QUESTIONS
    from askloom.workload.evaluation import _judge_prompt_length

    return " + ".join(
        f"CASE WHEN {_judge_prompt_length(q)} % 2 = 0 THEN 1 ELSE 0 END"
        for q in JUDGE_QUESTIONS.values()
    )


SCORES = GOLDEN + f""",
    answers AS (
      SELECT request_id, request, 'raw' AS system, response || '.' AS response FROM golden
      UNION ALL SELECT request_id, request, 'second', context FROM golden JOIN texts USING (request_id)
      UNION ALL SELECT request_id, request, 'tuned', response FROM golden),
    means AS (
      SELECT system, avg({_score_sql()}) AS mean_score FROM answers GROUP BY system)"""


@query("mean_score", SCORES + " SELECT system, round(mean_score, 6) AS mean_score FROM means")
def q_mean_score(spark, sf):
    return mean_score(_systems(spark, sf)).withColumn("mean_score", F.round("mean_score", 6))


@query("compare_systems", SCORES + """
    SELECT m.system AS against, round(100 * (t.mean_score - m.mean_score) / nullif(m.mean_score, 0), 6)
      AS improvement_pct
    FROM means m JOIN means t ON t.system = 'tuned' WHERE m.system <> 'tuned'""")
def q_compare_systems(spark, sf):
    means = mean_score(_systems(spark, sf))
    return compare_systems(means, "tuned").withColumn(
        "improvement_pct", F.round("improvement_pct", 6)
    )


@query("best_candidate", """
    WITH means AS (
      SELECT c AS candidate, avg((doc_id * (c + 3) + quality) % 4) AS mean_score
      FROM labels, range(8) AS r(c) GROUP BY c)
    SELECT CAST(candidate AS INT) AS candidate, round(mean_score, 6) AS mean_score FROM means
    ORDER BY means.mean_score DESC, candidate LIMIT 1""")
def q_best_candidate(spark, sf):
    c = F.col("candidate")
    scores = load(spark, sf, "labels").withColumn(
        "candidate", F.explode(F.sequence(F.lit(0), F.lit(7)))
    ).withColumn("score", (F.col("doc_id") * (c + 3) + F.col("quality")) % 4)
    return best_candidate(scores).withColumn("mean_score", F.round("mean_score", 6))


def digest_response():
    """Offline stand-in for the tuned model: depends on every character of the prompt, its examples included."""
    return lambda prompts: [md5(p.encode()).hexdigest()[: 1 + len(p) % 29] for p in prompts]


def _demo_sql() -> str:
    """An example of a prompt as an SQL expression over request, context and response."""
    before, middle, after, end = (
        DEMO_TEMPLATE.replace("{context}", "{request}").replace("{response}", "{request}")
        .split("{request}")
    )
    return (
        f"{quoted(before)} || request || {quoted(middle)} || context || {quoted(after)} "
        f"|| response || {quoted(end)}"
    )


def _task_sql() -> str:
    before, middle, end = TASK_TEMPLATE.replace("{context}", "{request}").split("{request}")
    return f"{quoted(before)} || request || {quoted(middle)} || context || {quoted(end)}"


def _response_sql(prompt: str) -> str:
    return f"left(md5({prompt}), CAST(1 + length({prompt}) % 29 AS BIGINT))"


def _drawn_sql(kind: str, pool: str, first: int) -> str:
    return f"""
      SELECT candidate, '{kind}' AS kind, rn, demo FROM (
        SELECT r.c AS candidate, {_demo_sql()} AS demo, row_number() OVER (
          PARTITION BY r.c ORDER BY md5('{kind}#' || r.c || '#' || request_id), request_id) AS rn
        FROM {pool}, range({first}, 8) AS r(c)) WHERE rn <= 2"""


@query("fewshot_search", GOLDEN + f""",
    train AS (
      SELECT request_id, request, response, context
      FROM split JOIN texts USING (request_id) WHERE split = 'train'),
    taught AS (
      SELECT request_id, request, context, {_response_sql("p")} AS response
      FROM (SELECT *, {quoted(demo_prefix([]))} || {_task_sql()} AS p FROM train)),
    good AS (SELECT * FROM taught WHERE {_score_sql()} >= 2),
    drawn AS ({_drawn_sql("labelled", "train", 1)}
      UNION ALL {_drawn_sql("generated", "good", 2)}),
    prefixes AS (
      SELECT r.c AS candidate, {quoted(demo_prefix([]))}
        || coalesce(string_agg(demo, '' ORDER BY kind, rn), '') AS prefix
      FROM range(8) AS r(c) LEFT JOIN drawn ON drawn.candidate = r.c GROUP BY r.c),
    answers AS (
      SELECT candidate, request, {_response_sql("p")} AS response
      FROM (SELECT candidate, request, prefix || {_task_sql()} AS p FROM train, prefixes))
    SELECT CAST(candidate AS INT) AS candidate, count(*) AS n,
      round(avg({_score_sql()}), 6) AS mean_score
    FROM answers GROUP BY candidate""")
def q_fewshot_search(spark, sf):
    split = golden_split(evaluation_tables(spark, sf)[0])
    train = split.where("split = 'train'").drop("split")
    scores, _ = fewshot_search(train, digest_response, parity_judge, accept=2)
    return scores.groupBy("candidate").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score")
    )


# --- held-out comparison and saved programs --------------------------------------------

def digest_author(shift: int, span: int):
    """Offline stand-in for a model that reasons: its response depends on every character of the prompt."""
    def factory():
        def ask(prompts):
            return [
                f" It has {len(p)} characters.\nResponse: {md5(p.encode()).hexdigest()[:1 + (len(p) + shift) % span]}"
                for p in prompts
            ]

        return ask

    return factory


def _reasoned_sql(parts: str, template: str) -> str:
    """A prompt template as an SQL expression over columns named as its fields."""
    out = template
    for name in ("request", "context", "rationale", "response"):
        out = out.replace("{" + name + "}", f"' || {parts}{name} || '")
    return f"'{out}'"


def _answer_sql(prompt: str, shift: int, span: int) -> str:
    return f"left(md5({prompt}), CAST(1 + (length({prompt}) + {shift}) % {span} AS BIGINT))"


SYSTEMS = {"raw": (0, 29), "second": (7, 23), "tuned": (0, 29)}
TRAINED = """
    shown AS (
      SELECT row_number() OVER (ORDER BY request_id) - 1 AS position, request, context, response,
        'Seen in ' || request_id || '.' AS rationale
      FROM split JOIN texts USING (request_id) WHERE split = 'train' QUALIFY position < 3)"""
HELD_OUT = GOLDEN + "," + TRAINED + "," + UNIQUE.replace("WITH", "", 1).replace("texts AS", "pieces AS").replace(
    "FROM texts)", "FROM pieces)") + """,
    passages AS (SELECT chunk_id AS key, content AS text FROM uniq),
    questions AS (SELECT request_id AS q, request AS text FROM split WHERE split = 'test'),""" + text_hits_sql(
    "questions", "passages") + f""",
    found AS (
      SELECT q AS request_id, string_agg('`' || text || '`', '' ORDER BY rank) AS context
      FROM hits JOIN passages USING (key) WHERE rank <= 3 GROUP BY q),
    asked AS (
      SELECT request_id, request, coalesce(found.context, '') AS context
      FROM split LEFT JOIN found USING (request_id) WHERE split = 'test'),
    program AS (SELECT string_agg({_reasoned_sql("", REASONED_DEMO_TEMPLATE)}, '' ORDER BY position) AS demos FROM shown),
    prompts AS (
      SELECT request_id, request, {quoted(demo_prefix([]))} || {_reasoned_sql("", REASONED_TASK_TEMPLATE)} AS bare,
        {quoted(demo_prefix([]))} || demos || {_reasoned_sql("", REASONED_TASK_TEMPLATE)} AS shown
      FROM asked, program),
    answers AS ({" UNION ALL ".join(
        f"SELECT request_id, request, '{name}' AS system, {_answer_sql('shown' if name == 'tuned' else 'bare', *how)} AS response,"
        f" length({'shown' if name == 'tuned' else 'bare'}) AS seen FROM prompts"
        for name, how in SYSTEMS.items())}),
    scored AS (SELECT *, {_score_sql()} AS score FROM answers)"""


def _held_out(spark, sf):
    """Three systems on the test rows, the tuned one with a program that was saved and read again."""
    split = golden_split(evaluation_tables(spark, sf)[0])
    train = split.where("split = 'train'").withColumn("rationale", F.concat(F.lit("Seen in "), "request_id", F.lit(".")))
    shown = [r.asDict() for r in sample_first(train, 3, ["request_id"]).collect()]
    path = scratch_path(spark, "programs")
    write_program(spark, Program([{**d, "augmented": True} for d in shown]), path)
    test = split.where("split = 'test'").select("request_id", "request", "response")
    chunks = doc_index_rows(spark, sf, in_place=True)
    hits = search_terms(test, term_index(chunks, "chunk_id", "content"), k=3, query_key="request_id", text="request")
    named = hits.withColumnsRenamed({"query_key": "request_id", "index_key": "chunk_id"})
    systems = {
        name: System(digest_author(*how), read_program(spark, path) if name == "tuned" else None)
        for name, how in SYSTEMS.items()
    }
    return compare_held_out(
        test, with_texts(named, chunk_texts(spark, sf), ["content"]), systems, parity_judge, best="tuned"
    )


@query("held_out_scores", HELD_OUT + """
    SELECT request_id, system, response, 'It has ' || seen || ' characters.' AS rationale, CAST(score AS INT) AS score
    FROM scored""")
def q_held_out_scores(spark, sf):
    return _held_out(spark, sf)[0].drop("judge_error")


@query("compare_held_out", HELD_OUT + """
    SELECT o.system AS against, count(*) AS pairs, 0::BIGINT AS unpaired, count(*) FILTER (t.score > o.score) AS wins,
      count(*) FILTER (t.score < o.score) AS losses, count(*) FILTER (t.score = o.score) AS ties,
      round(100 * (avg(t.score) - avg(o.score)) / nullif(avg(o.score), 0), 6) AS improvement_pct,
      round(avg(t.score - o.score), 6) AS mean_gain,
      round(stddev_samp(t.score - o.score) / sqrt(count(*)), 6) AS gain_error
    FROM scored o JOIN scored t ON t.request_id = o.request_id AND t.system = 'tuned' WHERE o.system <> 'tuned'
    GROUP BY o.system""")
def q_compare_held_out(spark, sf):
    found = _held_out(spark, sf)[1]
    return found.withColumns({c: F.round(c, 6) for c in ("improvement_pct", "mean_gain", "gain_error")})


@query("saved_program", """
    SELECT source AS program, CAST(row_number() OVER w - 1 AS INT) AS position, doc_id % 2 = 0 AS augmented,
      lang AS request, md5(text) AS context_md5, CASE WHEN doc_id % 3 <> 0 THEN 'Since ' || doc_id END AS rationale,
      CAST(n_chars AS VARCHAR) AS response
    FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id) QUALIFY row_number() OVER w <= 4""")
def q_saved_program(spark, sf):
    """A program of four examples per source, with whole texts as contexts, written and read again."""
    doc = F.col("doc_id")
    placed = first_rows(load(spark, sf, "documents"), 4).select(
        F.col("source").alias("program"), "position", (doc % 2 == 0).alias("augmented"), F.col("lang").alias("request"),
        F.col("text").alias("context"), F.when(doc % 3 != 0, F.concat(F.lit("Since "), doc)).alias("rationale"),
        F.col("n_chars").cast("string").alias("response"),
    )
    path = scratch_path(spark, "programs")
    write_programs(placed, path)
    read = read_programs(spark, path)
    return read.select("program", "position", "augmented", "request", F.md5("context").alias("context_md5"), "rationale", "response")


def first_rows(docs, n):
    place = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    return docs.withColumn("position", place - 1).where(F.col("position") < n)
