"""Nearest neighbours, contexts, prompts and answers."""

from hashlib import md5

import numpy as np
from pyspark.sql import functions as F

from askloom.fixed_values import CHAT_TEMPLATE
from askloom.functions.vectors import cosine
from askloom.operators.codes import checked_pairs
from askloom.operators.embedding import embed
from askloom.operators.ivf import make_ivf, read_ivf, rows_read, write_ivf
from askloom.operators.knn import ann_join, knn_join, read_cells, recall_at_k, write_cells
from askloom.operators.terms import read_term_index, search_terms, term_index, write_term_index
from askloom.operators.vectors import rank_hits
from askloom.plans.answering import answer_questions, format_context, prompts_for, retrieve
from askloom.plans.index import build_chunks, build_index, create_or_sync_index, stored_index, vector_rows
from askloom.workload.chunks import UNIQUE, doc_chunks, doc_index_rows
from askloom.session import cut, scratch_path
from askloom.workload.registry import load, query, scratch_schema

VEC = dict(query_key="vec_id", query_vec="embedding", index_key="vec_id", index_vec="embedding")


def ranked_sql(k: int, table: str = "embeddings") -> str:
    """CTE ``hits(q, i, score, rank)`` over all pairs of the vectors."""
    return f"""
    pairs AS (
      SELECT a.vec_id AS q, b.vec_id AS i,
        round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score
      FROM {table} a CROSS JOIN {table} b),
    hits AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, i) AS rank FROM pairs)
      WHERE rank <= {k})"""


def _hits(df):
    return df.select(
        "query_key", "index_key", F.round("score", 5).alias("score"),
        F.col("rank").cast("bigint").alias("rank"),
    )


HITS_OUT = "SELECT q AS query_key, i AS index_key, round(score, 5) AS score, rank FROM hits"


@query("knn_top3", "WITH" + ranked_sql(3) + HITS_OUT)
def q_knn_top3(spark, sf):
    e = load(spark, sf, "embeddings")
    return _hits(knn_join(e, e, k=3, **VEC))


@query("knn_top10_cells", "WITH" + ranked_sql(10) + HITS_OUT)
def q_knn_top10_cells(spark, sf):
    e = load(spark, sf, "embeddings")
    return _hits(knn_join(e, e, k=10, cells=16, probes=2, **VEC))


@query("knn_top5_stored_cells", "WITH" + ranked_sql(5) + HITS_OUT)
def q_knn_top5_stored_cells(spark, sf):
    e = load(spark, sf, "embeddings")
    path = scratch_path(spark, "cells")
    write_cells(e, path, key="vec_id", vec="embedding", cells=8)
    return _hits(knn_join(e, e, k=5, cells=read_cells(spark, path), **VEC))


def cells_sql(cells: int, probes: int, k: int) -> str:
    """CTE ``near(q, i, score, rank)``: the search of the ``probes`` nearest cells."""
    return f"""
    pivots AS (
      SELECT row_number() OVER (ORDER BY md5(vec_id::VARCHAR)) AS cell, embedding FROM embeddings
      ORDER BY md5(vec_id::VARCHAR) LIMIT {cells}),
    sims AS (
      SELECT e.vec_id, p.cell,
        list_cosine_similarity(e.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS s
      FROM embeddings e CROSS JOIN pivots p),
    home AS (SELECT vec_id, arg_max(cell, s) AS cell FROM sims GROUP BY vec_id),
    sizes AS (SELECT cell, count(*) AS n FROM home GROUP BY cell),
    ordered AS (
      SELECT vec_id AS q, cell, row_number() OVER w AS pos, sum(coalesce(n, 0)) OVER w
        - coalesce(n, 0) AS held
      FROM sims LEFT JOIN sizes USING (cell) WINDOW w AS (PARTITION BY vec_id ORDER BY s DESC)),
    near AS (
      SELECT * FROM (
        SELECT p.*, row_number() OVER (PARTITION BY p.q ORDER BY score DESC, p.i) AS rank
        FROM pairs p JOIN home h ON h.vec_id = p.i
        JOIN ordered o ON o.q = p.q AND o.cell = h.cell
        WHERE o.pos <= {probes} OR o.held < {k})
      WHERE rank <= {k})"""


NEAR = "WITH" + ranked_sql(3) + "," + cells_sql(16, 8, 3)


@query("ann_top3", NEAR + HITS_OUT.replace("FROM hits", "FROM near"))
def q_ann_top3(spark, sf):
    e = load(spark, sf, "embeddings")
    return _hits(ann_join(e, e, k=3, cells=16, probes=8, **VEC))


@query("ann_recall", NEAR + """
    SELECT round(count(n.i) / count(*), 6) AS recall
    FROM hits h LEFT JOIN near n ON n.q = h.q AND n.i = h.i""")
def q_ann_recall(spark, sf):
    e = load(spark, sf, "embeddings")
    found = ann_join(e, e, k=3, cells=16, probes=8, **VEC)
    recall = recall_at_k(found, knn_join(e, e, k=3, **VEC))
    return recall.withColumn("recall", F.round("recall", 6))


def every_hundredth(e):
    """The stated set of queries of a search."""
    return e.where("vec_id % 100 = 0")


@query("knn_top10_codes", "WITH" + ranked_sql(10) + HITS_OUT + " WHERE q % 100 = 0")
def q_knn_top10_codes(spark, sf):
    e = load(spark, sf, "embeddings")
    return _hits(knn_join(every_hundredth(e), e, k=10, **VEC))


@query("knn_codes_checked", """
    SELECT count(*) * count(*) FILTER (vec_id % 100 = 0) AS pairs, true AS all_neighbours, true AS under_a_fifth
    FROM embeddings""")
def q_knn_codes_checked(spark, sf):
    """Whether less than a fifth of all pairs is scored exactly, and enough for ten neighbours each."""
    e = load(spark, sf, "embeddings")
    asked = every_hundredth(e)
    found = checked_pairs(asked, e, k=10, **VEC)
    return found.select(
        "pairs", (F.col("checked") >= 10 * asked.count()).alias("all_neighbours"),
        (F.col("checked") < 0.2 * F.col("pairs")).alias("under_a_fifth"),
    )


def others(hits, k):
    """The hits of other vectors than the query itself."""
    return rank_hits(hits.where("query_key <> index_key").drop("rank"), k)


@query("ivf_recall", """
    SELECT 'queries' AS measure, count(*) AS n FROM embeddings WHERE vec_id % 100 = 0
    UNION ALL SELECT 'recall of 0.9 or more', 1 UNION ALL SELECT 'fewer pairs read than there are', 1""")
def q_ivf_recall(spark, sf):
    """Recall of a stored inverted file against the ten exact neighbours, the vector itself left out."""
    e = load(spark, sf, "embeddings")
    asked = every_hundredth(e)
    path = scratch_path(spark, "ivf")
    write_ivf(make_ivf(e, key="vec_id", vec="embedding"), path)
    ivf = read_ivf(spark, path)
    found = others(ann_join(asked, e, k=11, cells=ivf, **VEC), 10)
    recall = recall_at_k(found, others(knn_join(asked, e, k=11, **VEC), 10))
    read = rows_read(asked, ivf, k=11, key="vec_id", vec="embedding")
    row = lambda df, name, n: df.select(F.lit(name).alias("measure"), n.cast("bigint").alias("n"))
    return (
        row(asked.agg(F.count(F.lit(1)).alias("n")), "queries", F.col("n"))
        .unionByName(row(recall, "recall of 0.9 or more", F.col("recall") >= 0.9))
        .unionByName(row(read, "fewer pairs read than there are", F.col("read") < F.col("pairs")))
    )


@query("cosine_next", """
    SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6)
      AS score
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def q_cosine_next(spark, sf):
    e = load(spark, sf, "embeddings")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(after, "vec_id").select(
        "vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("score")
    )


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_counts():
    """Offline stand-in for an embedding model: how often each letter occurs."""
    return lambda texts: np.array([[t.count(c) for c in LETTERS] for t in texts])


def _letters_sql(text: str) -> str:
    counts = ", ".join(f"length({text}) - length(replace({text}, '{c}', ''))" for c in LETTERS)
    return f"[{counts}]::DOUBLE[]"


def vector_index(spark, sf):
    """The chunks of all documents with vectors of their letter counts; their texts are in :func:`chunk_texts`."""
    rows = vector_rows(doc_chunks(spark, sf), uri_col="doc_id", category_col="source", embedder=letter_counts)
    return rows.withColumn("doc_uri", F.concat(F.lit("doc-"), "doc_uri"))


def chunk_texts(spark, sf):
    return doc_chunks(spark, sf).select("chunk_id", F.col("chunk").alias("content"))


def vector_questions(spark, sf):
    """A question about every hundredth document, holding its whole text, with the vector of that text."""
    asked = load(spark, sf, "documents").where("doc_id % 100 = 0").select(
        F.concat(F.lit("q"), "doc_id").alias("request_id"), F.col("source").alias("category"), "text",
        F.concat(F.lit("What about {"), "text", F.lit("}?")).alias("question"),
    )
    return embed(asked, "text", embedder=letter_counts).drop("text")


RETRIEVED = UNIQUE + f""",
    index_rows AS (
      SELECT chunk_id, 'doc-' || doc_uri AS doc_uri, category, content, {_letters_sql("content")} AS v FROM uniq),
    questions AS (
      SELECT 'q' || doc_id AS request_id, 'What about {{' || text || '}}?' AS question, {_letters_sql("text")} AS v
      FROM documents WHERE doc_id % 100 = 0),
    pairs AS (
      SELECT request_id, chunk_id, round(list_cosine_similarity(q.v, c.v), 9) AS score
      FROM questions q CROSS JOIN index_rows c WHERE list_sum(q.v) > 0 AND list_sum(c.v) > 0),
    hits AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, chunk_id) AS rank FROM pairs)
      WHERE rank <= 3),
    found AS (
      SELECT request_id, chunk_id, doc_uri, category, content, score, rank FROM hits JOIN index_rows USING (chunk_id)),
    contexts AS (
      SELECT request_id, string_agg('`' || content || '`', '' ORDER BY rank) AS context
      FROM found GROUP BY request_id),
    asked AS (
      SELECT request_id, question, coalesce(context, '') AS context FROM questions LEFT JOIN contexts USING (request_id))"""


def _prompt_sql() -> str:
    """The chat template as an SQL expression over ``context`` and ``question``."""
    before, rest = CHAT_TEMPLATE.split("{context}")
    between, after = rest.split("{question}")
    return f"'{before}' || context || '{between}' || question || '{after}'"


@query("retrieve_columns", RETRIEVED + """
    SELECT request_id, chunk_id, doc_uri, category, md5(content) AS content_md5, rank FROM found""")
def q_retrieve_columns(spark, sf):
    return retrieve(vector_questions(spark, sf), vector_index(spark, sf), texts=chunk_texts(spark, sf)).select(
        "request_id", "chunk_id", "doc_uri", "category", F.md5("content").alias("content_md5"),
        F.col("rank").cast("bigint").alias("rank"),
    )


@query("context_format", RETRIEVED + """
    SELECT request_id, md5(context) AS context_md5, length(context) AS n_chars FROM contexts""")
def q_context_format(spark, sf):
    hits = retrieve(vector_questions(spark, sf), vector_index(spark, sf), texts=chunk_texts(spark, sf))
    return format_context(hits).select(
        "request_id", F.md5("context").alias("context_md5"),
        F.length("context").cast("bigint").alias("n_chars"),
    )


@query("prompt_render", RETRIEVED + f"""
    SELECT request_id, md5({_prompt_sql()}) AS prompt_md5 FROM asked""")
def q_prompt_render(spark, sf):
    return prompts_for(vector_questions(spark, sf), vector_index(spark, sf), texts=chunk_texts(spark, sf)).select(
        "request_id", F.md5("prompt").alias("prompt_md5")
    )


def digest_of_prompt():
    """Offline stand-in for a chat model: an answer that depends on every character of the prompt."""
    return lambda prompts: [f"{md5(p.encode()).hexdigest()} of {len(p)} characters." for p in prompts]


def digest_sql() -> str:
    """The stand-in's answer as an SQL expression over ``context`` and ``question``."""
    return f"md5({_prompt_sql()}) || ' of ' || length({_prompt_sql()}) || ' characters.'"


@query("answer_questions", RETRIEVED + f""",
    sizes AS (SELECT request_id, CAST(count(*) AS INTEGER) AS n_chunks FROM found GROUP BY request_id)
    SELECT request_id, {digest_sql()} AS response, 1 AS tries, n_chunks
    FROM asked LEFT JOIN sizes USING (request_id)""")
def q_answer_questions(spark, sf):
    answered = answer_questions(
        vector_questions(spark, sf), vector_index(spark, sf), digest_of_prompt, texts=chunk_texts(spark, sf)
    )
    return answered.where(F.col("error").isNull()).select(
        "request_id", "response", "tries", F.array_size("retrieval_context").alias("n_chunks"),
    )


def words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[ \\t\\n\\x0b\\f\\r]+'), lambda w: w <> '')"


@query("embed_chunks", UNIQUE + f""",
    buckets AS (
      SELECT chunk_id, CAST('0x' || md5(w)[1:8] AS BIGINT) % 256 AS b, count(*) AS tf
      FROM (SELECT chunk_id, unnest({words_sql("content")}) AS w FROM uniq) GROUP BY ALL),
    idf AS (
      SELECT b, ln(((SELECT count(*) FROM uniq) + 1) / (count(*) + 1)) AS idf FROM buckets GROUP BY b),
    weights AS (SELECT chunk_id, b, tf * idf AS w FROM buckets JOIN idf USING (b)),
    units AS (
      SELECT chunk_id, b, CAST(w / sqrt(sum(w * w) OVER (PARTITION BY chunk_id)) AS FLOAT) AS x FROM weights
      WHERE w <> 0)
    SELECT chunk_id, CAST(count(x) AS INTEGER) AS n_set, 256 AS dim,
      CAST(coalesce(sum((b + 1) * round(CAST(x AS DOUBLE) * 100)), 0) AS BIGINT) AS checksum,
      coalesce(max_by(b, (round(CAST(x AS DOUBLE), 5), -b)), -1) AS top_bucket
    FROM uniq LEFT JOIN units USING (chunk_id) GROUP BY chunk_id""")
def q_embed_chunks(spark, sf):
    """Values of the hashed vectors: entries set, a weighted sum of all of them, and the largest one's place."""
    index = embed(doc_index_rows(spark, sf), "content").select(
        "chunk_id", F.transform("embedding", lambda x: x.cast("double")).alias("v")
    )
    placed = F.transform("v", lambda x, i: (i + 1) * F.round(x * 100))
    best = F.array_max(F.transform("v", lambda x, i: F.struct(F.round(x, 5).alias("x"), (-i).alias("b"))))
    n_set = F.size(F.filter("v", lambda x: x != 0))
    return index.select(
        "chunk_id", n_set.alias("n_set"), F.size("v").alias("dim"),
        F.aggregate(placed, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("checksum"),
        F.when(n_set > 0, -best["b"]).otherwise(-1).cast("bigint").alias("top_bucket"),
    )


def text_hits_sql(questions: str, texts: str) -> str:
    """CTEs ending in ``hits(q, key, score, rank)``: TF-IDF search of ``questions(q, text)`` in ``texts(key, text)``."""
    def weights(name: str, source: str, key: str, idf: str) -> str:
        return f"""
    {name}_counts AS (
      SELECT {key}, w AS term, count(*) AS tf FROM (SELECT {key}, unnest({words_sql("text")}) AS w FROM {source}) GROUP BY ALL),
    {name}_raw AS (SELECT {key}, term, (1 + ln(tf)) * {idf} AS w FROM {name}_counts JOIN inside USING (term)),
    {name} AS (
      SELECT {key}, term, CAST(round(w * 1000000 / sqrt(sum(w * w) OVER (PARTITION BY {key}))) AS BIGINT) AS weight
      FROM {name}_raw WHERE w > 0)"""

    return f"""
    inside AS (
      SELECT term, count(*) AS texts FROM (
        SELECT DISTINCT key, unnest({words_sql("text")}) AS term FROM {texts}) GROUP BY term),
    {weights("held", texts, "key", "1")},
    {weights("asked_terms", questions, "q", f"ln(((SELECT count(*) FROM {texts}) + 1) / (texts + 1))")},
    summed AS (
      SELECT q, key, CAST(sum(a.weight * h.weight) AS BIGINT) AS score
      FROM asked_terms a JOIN held h USING (term) GROUP BY q, key),
    hits AS (
      SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, key) AS rank FROM summed)"""


TEXT_RETRIEVAL = UNIQUE + """,
    passages AS (SELECT chunk_id AS key, content AS text FROM uniq),
    questions AS (SELECT item_id AS q, text FROM benchmark),""" + text_hits_sql("questions", "passages") + """
    SELECT q AS request_id, chunk_id, doc_uri, category, score, CAST(rank AS INTEGER) AS rank
    FROM hits JOIN uniq ON chunk_id = key WHERE rank <= 3"""


def _text_hits_of(spark, sf, index):
    """Benchmark texts as questions over the chunk index of the documents, by TF-IDF."""
    chunks = doc_index_rows(spark, sf)
    questions = load(spark, sf, "benchmark")
    hits = search_terms(questions, index, k=3, query_key="item_id", text="text")
    named = hits.withColumnsRenamed({"query_key": "request_id", "index_key": "chunk_id"})
    return named.join(chunks.select("chunk_id", "doc_uri", "category"), "chunk_id").select(
        "request_id", "chunk_id", "doc_uri", "category", F.round(F.col("score") * 1e12).cast("bigint").alias("score"), "rank"
    )


@query("text_retrieval", TEXT_RETRIEVAL)
def q_text_retrieval(spark, sf):
    return _text_hits_of(spark, sf, term_index(doc_index_rows(spark, sf), "chunk_id", "content"))


@query("text_retrieval_joined", TEXT_RETRIEVAL)
def q_text_retrieval_joined(spark, sf):
    """The same over the stored, bucketed form of the index, with common terms looked up."""
    chunks = doc_index_rows(spark, sf, in_place=True)
    with scratch_schema(spark) as schema:
        write_term_index(term_index(chunks, "chunk_id", "content"), f"{schema}.texts", buckets=8)
        return cut(_text_hits_of(spark, sf, read_term_index(spark, f"{schema}.texts")))


@query("retrieve_texts", UNIQUE + f""",
    vecs AS (SELECT chunk_id, doc_uri, category, {_letters_sql("content")} AS v FROM uniq),
    asked AS (SELECT item_id, {_letters_sql("text")} AS v FROM benchmark),
    pairs AS (
      SELECT item_id AS request_id, chunk_id, doc_uri, category,
        round(list_cosine_similarity(a.v, c.v), 9) AS score
      FROM asked a CROSS JOIN vecs c WHERE list_sum(a.v) > 0 AND list_sum(c.v) > 0)
    SELECT request_id, chunk_id, doc_uri, category, round(score, 4) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, chunk_id) AS rank
      FROM pairs) WHERE rank <= 3""")
def q_retrieve_texts(spark, sf):
    """The benchmark texts as questions over the chunks of the documents, by letter counts."""
    chunks = doc_chunks(spark, sf)
    index = build_index(
        chunks, uri_col="doc_id", category_col="source", embedder=letter_counts
    )
    questions = load(spark, sf, "benchmark").select(
        F.col("item_id").alias("request_id"), F.col("text").alias("question")
    )
    hits = retrieve(
        embed(questions, "question", embedder=letter_counts), cut(index),
        columns=("doc_uri", "category"),
    )
    return hits.select(
        "request_id", "chunk_id", "doc_uri", "category", F.round("score", 4).alias("score"),
        F.col("rank").cast("bigint").alias("rank"),
    )


@query("retrieve_stored", RETRIEVED + """
    SELECT request_id, chunk_id, doc_uri, category, md5(content) AS content_md5, rank FROM found""")
def q_retrieve_stored(spark, sf):
    """The same questions to the stored index: created from some documents, then synced with all of them."""
    docs = load(spark, sf, "documents").withColumn("uri", F.col("doc_id"))
    path = scratch_path(spark, "stored-index")
    for state in (docs.where("doc_id % 3 <> 0"), docs):
        create_or_sync_index(
            spark, build_chunks(state, "text"), path, embedder=letter_counts, uri_col="uri", category_col="source"
        )
    index = stored_index(spark, path).withColumn("doc_uri", F.concat(F.lit("doc-"), "doc_uri"))
    return retrieve(vector_questions(spark, sf), index).select(
        "request_id", "chunk_id", "doc_uri", "category", F.md5("content").alias("content_md5"),
        F.col("rank").cast("bigint").alias("rank"),
    )
