"""Reading, writing, cleaning and generating source tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from askloom.functions.text import letters_only, short_id
from askloom.plans.generation import ORDINALS, PLAIN_DOCUMENT, generate_source, generate_tickets
from askloom.session import cut, scratch_path
from askloom.sources.tables import (
    ensure_schema, explode_items, merged_schema, read_csv_source, read_source, reset_schema, write_csv, write_merged,
    write_new, write_overwrite,
)
from askloom.workload.registry import load, query, scratch_schema


@query("csv_source", """
    SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents""")
def q_csv_source(spark, sf):
    docs = load(spark, sf, "documents")
    path = scratch_path(spark, "csv")
    write_csv(docs, path)
    read = read_csv_source(spark, path, docs.schema)
    return read.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query("merge_schema", """
    SELECT doc_id, CAST(NULL AS INT) AS quality, CAST(NULL AS INT) AS toxic, lang, source
    FROM documents""")
def q_merge_schema(spark, sf):
    new = load(spark, sf, "documents").select("doc_id", "lang", "source")
    return merged_schema(new, load(spark, sf, "labels").schema)


@query("merge_schema_nested", """
    SELECT conv_id, role, CAST(NULL AS VARCHAR) AS old_md5, md5(text) AS new_md5, length(text) AS n_chars,
      CAST(NULL AS BIGINT) AS old_turn, 's' || turn AS step_id, 'turn' AS step_kind, CAST(NULL AS VARCHAR) AS old_step,
      'b' AS tag_new, CAST(NULL AS VARCHAR) AS tag_old, CAST(NULL AS BIGINT) AS old_only, turn % 3 = 0 AS no_request
    FROM (SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 THEN role END AS role, CASE WHEN turn % 3 <> 0 THEN text END AS text
      FROM conversations)""")
def q_merge_schema_nested(spark, sf):
    """A table whose struct, array of structs and map of structs get new fields and keep old ones."""
    turns = load(spark, sf, "conversations")
    tag = lambda name: F.create_map(F.lit("k"), F.struct(F.lit("b").alias(name)))
    old = turns.select(
        "conv_id", F.col("turn").alias("only_old"),
        F.struct(F.md5("text").alias("text_md5"), "role", F.struct("turn").alias("meta")).alias("request"),
        F.array(F.struct(F.lit("x").alias("note"), F.concat(F.lit("s"), "turn").alias("step_id"))).alias("steps"),
        tag("old").alias("tags"),
    )
    new = turns.select(
        "conv_id",
        F.when(F.col("turn") % 3 != 0, F.struct(
            "role", F.struct(F.length("text").cast("bigint").alias("n_chars")).alias("meta"), F.md5("text").alias("digest"),
        )).alias("request"),
        F.array(F.struct(F.concat(F.lit("s"), "turn").alias("step_id"), F.lit("turn").alias("kind"))).alias("steps"),
        tag("new").alias("tags"), F.col("turn").alias("added"),
    )
    with scratch_schema(spark) as schema:
        write_merged(old, f"{schema}.log")
        write_merged(new, f"{schema}.log")
        log = spark.read.table(f"{schema}.log")
        step, tagged = F.col("steps")[0], F.col("tags")["k"]
        return cut(log.select(
            "conv_id", "request.role", F.col("request.text_md5").alias("old_md5"), F.col("request.digest").alias("new_md5"),
            F.col("request.meta.n_chars").alias("n_chars"), F.col("request.meta.turn").alias("old_turn"),
            step["step_id"].alias("step_id"), step["kind"].alias("step_kind"), step["note"].alias("old_step"),
            tagged["new"].alias("tag_new"), tagged["old"].alias("tag_old"), F.col("only_old").alias("old_only"),
            F.col("request").isNull().alias("no_request"),
        ))


@query("table_writes", """
    SELECT step, columns, n FROM (VALUES ('create', 'doc_id,lang'), ('create again', 'doc_id,lang'), ('replace', 'lang,n'),
      ('merge', 'lang,n,source')) AS v(step, columns),
      (SELECT count(*) AS docs, count(DISTINCT lang) AS langs, count(DISTINCT source) AS sources FROM documents) AS c,
      LATERAL (SELECT CASE WHEN step LIKE 'create%' THEN docs WHEN step = 'replace' THEN langs ELSE sources END AS n) AS r
    UNION ALL SELECT 'reset', '', 0""")
def q_table_writes(spark, sf):
    """The write modes one after the other: what the table holds after each of them."""
    docs = load(spark, sf, "documents")
    seen = []
    with scratch_schema(spark) as schema:
        ensure_schema(spark, schema)
        table = f"{schema}.t"

        def look(step):
            held = spark.read.table(table)
            seen.append(cut(held.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(step).alias("step"), F.lit(",".join(held.columns)).alias("columns"), "n")))

        write_new(docs.select("doc_id", "lang"), table)
        look("create")
        try:
            write_new(docs.limit(0), table)
        except AnalysisException:
            look("create again")
        write_overwrite(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), table)
        look("replace")
        write_merged(docs.select("source").distinct(), table)
        look("merge")
        reset_schema(spark, schema, really=True)
        left = spark.sql(f"SHOW TABLES IN {schema}").agg(F.count(F.lit(1)).alias("n"))
        seen.append(cut(left.select(F.lit("reset").alias("step"), F.lit("").alias("columns"), "n")))
    out = seen[0]
    for df in seen[1:]:
        out = out.unionByName(df)
    return out


@query("explode_items", """
    SELECT source AS category, md5(unnest(string_split(text, chr(10)))) AS item_md5 FROM documents""")
def q_explode_items(spark, sf):
    docs = read_source(spark, f"{sf}/documents.parquet")
    items = docs.select(F.create_map("source", F.split("text", "\n")).alias("items"))
    return explode_items(items, "items", "item").select("category", F.md5("item").alias("item_md5"))


@query("distinct_categories", "SELECT DISTINCT source, lang FROM documents")
def q_distinct_categories(spark, sf):
    return load(spark, sf, "documents").select("source", "lang").distinct()


@query("letters_only", """
    SELECT doc_id, md5(regexp_replace(text, '[^a-zA-Z\\s]', '', 'g')) AS clean_md5 FROM documents""")
def q_letters_only(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", F.md5(letters_only(F.col("text"))).alias("clean_md5")
    )


@query("ticket_ids", """
    SELECT doc_id, substring(md5(doc_id || '#' || source), 1, 7) AS ticket_number FROM documents""")
def q_ticket_ids(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", short_id(F.col("doc_id"), F.col("source")).alias("ticket_number")
    )


def _categories(spark, sf):
    """A name for every benchmark text that depends on all of it."""
    return load(spark, sf, "benchmark").select(F.concat(F.lit("topic "), F.md5("text")).alias("category"))


CATEGORIES = """
    WITH cats AS (
      SELECT DISTINCT regexp_replace('topic ' || md5(text), '[^a-zA-Z\\s]', '', 'g') AS category FROM benchmark),
    counted AS (
      SELECT category,
        3 + CAST('0x' || substring(md5(category || '#0'), 1, 8) AS BIGINT) % 8 AS wanted FROM cats)"""
_BEFORE, _MIDDLE, _AFTER = PLAIN_DOCUMENT.replace("{category}", "{symptoms}").split("{symptoms}")


TICKETS = CATEGORIES + f""",
    named AS (
      SELECT category, category || ' with the ' || {ORDINALS}[i] || ' sign of wear' AS symptom
      FROM counted, range(1, 11) AS r(i) WHERE i <= wanted)
    SELECT category, '{_BEFORE}' || symptom || '{_MIDDLE}' || category || '{_AFTER}'
        AS issue_description,
      substring(md5(category || '#' || symptom || '#0'), 1, 7) AS ticket_number
    FROM named"""


@query("generate_tickets", TICKETS)
def q_generate_tickets(spark, sf):
    return generate_tickets(_categories(spark, sf))


@query("generate_source_table", TICKETS)
def q_generate_source_table(spark, sf):
    """The job as a whole: the table is written, refused a second time, read and dropped."""
    with scratch_schema(spark) as schema:
        made = generate_source(spark, f"{schema}.tickets", _categories(spark, sf))
        try:
            generate_source(spark, f"{schema}.tickets", ["again"])
        except AnalysisException:
            return cut(made)
    raise AssertionError("an existing table was overwritten")


def counting_author():
    """Offline stand-in: names as many x as there are earlier symptoms; a document is its symptom."""
    def ask(prompts):
        out = []
        for p in prompts:
            if p.startswith("Given the symptoms "):
                out.append(p[len("Given the symptoms "):].split(",", 1)[0])
            else:
                out.append("sign " + "x" * (1 + p.count('"sign ')))
        return out

    return ask


@query("generate_tickets_model", CATEGORIES + """
    SELECT category, 'sign ' || repeat('x', CAST(i AS INT)) AS issue_description,
      substring(md5(category || '#sign ' || repeat('x', CAST(i AS INT)) || '#0'), 1, 7)
        AS ticket_number
    FROM counted, range(1, 11) AS r(i) WHERE i <= wanted""")
def q_generate_tickets_model(spark, sf):
    return generate_tickets(_categories(spark, sf), domain="tickets", model=counting_author)
