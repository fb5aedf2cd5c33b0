"""Chunking queries."""

from pyspark.sql import functions as F

from askloom.operators.chunking import chunk_separator, chunk_tokens
from askloom.operators.subwords import chunk_subwords
from askloom.plans.index import build_chunks, unique_chunks
from askloom.workload.registry import load, query


def chunks_sql(table: str, key: str, text: str, size: int, overlap: int, extra: str = "") -> str:
    """CTEs ending in ``chunks(key, extra..., chunk_no, chunk, chunk_id)``."""
    step = size - overlap
    return f"""
    WITH toks AS (
      SELECT {key}{extra}, string_split_regex({text}, '\\s+') AS t FROM {table}
      WHERE length({text}) > 0),
    windows AS (
      SELECT *, unnest(range(0, CAST(ceil(greatest(len(t) - {overlap}, 1) / {step}.0) AS BIGINT)))
        AS chunk_no FROM toks),
    texts AS (
      SELECT * EXCLUDE t, array_to_string(t[chunk_no * {step} + 1 : chunk_no * {step} + {size}], ' ')
        AS chunk FROM windows),
    chunks AS (SELECT *, md5(chunk) AS chunk_id FROM texts)"""


DOC_CHUNKS = chunks_sql("documents", "doc_id", "text", 300, 100, ", source, lang")
UNIQUE = DOC_CHUNKS + """,
    uniq AS (
      SELECT chunk_id, doc_id AS doc_uri, source AS category, chunk AS content FROM (
        SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY doc_id, source, chunk_no) AS rn
        FROM chunks) WHERE rn = 1)"""


def doc_chunks(spark, sf):
    return build_chunks(load(spark, sf, "documents"), "text")


def doc_index_rows(spark, sf, *, in_place=False):
    return unique_chunks(
        doc_chunks(spark, sf), id_col="chunk_id", uri_col="doc_id", category_col="source",
        text_col="chunk", in_place=in_place,
    )


@query("chunk_tokens", DOC_CHUNKS + """
    SELECT doc_id, source, CAST(chunk_no AS INT) AS chunk_no, chunk_id, length(chunk) AS n_chars
    FROM chunks""")
def q_chunk_tokens(spark, sf):
    return doc_chunks(spark, sf).select(
        "doc_id", "source", "chunk_no", "chunk_id", F.length("chunk").cast("bigint").alias("n_chars")
    )


@query("chunk_stats", DOC_CHUNKS + """
    SELECT source, lang, count(*) AS n_chunks, count(DISTINCT doc_id) AS n_docs,
      CAST(sum(length(chunk)) AS BIGINT) AS n_chars
    FROM chunks GROUP BY source, lang""")
def q_chunk_stats(spark, sf):
    return doc_chunks(spark, sf).groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.count_distinct("doc_id").alias("n_docs"),
        F.sum(F.length("chunk")).alias("n_chars"),
    )


@query("chunk_dup_ids", DOC_CHUNKS + """
    SELECT chunk_id, count(*) AS n FROM chunks GROUP BY chunk_id HAVING count(*) > 1""")
def q_chunk_dup_ids(spark, sf):
    return (
        doc_chunks(spark, sf).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )


@query("chunk_all_columns", DOC_CHUNKS + """
    SELECT d.doc_id, d.lang, d.source, d.n_chars, md5(d.text) AS text_md5, c.chunk_id
    FROM chunks c JOIN documents d USING (doc_id)""")
def q_chunk_all_columns(spark, sf):
    return doc_chunks(spark, sf).select(
        "doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"), "chunk_id"
    )


@query("chunk_pages", chunks_sql("pages", "page_id", "html", 60, 20) + """
    SELECT page_id, CAST(chunk_no AS INT) AS chunk_no, chunk_id FROM chunks""")
def q_chunk_pages(spark, sf):
    return chunk_tokens(load(spark, sf, "pages"), "html", size=60, overlap=20).select(
        "page_id", "chunk_no", "chunk_id"
    )


# A range starts at s, ends at e(s), and the next one starts at nxt(s).
SEPARATOR = """
    WITH RECURSIVE lines AS (
      SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ps
      FROM documents WHERE length(text) > 0),
    pieces AS (
      SELECT doc_id, i, ps[i] AS p,
        len(list_filter(string_split_regex(ps[i], '\\s+'), lambda x: x <> '')) AS n
      FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM lines)),
    sums AS (
      SELECT doc_id, i, n,
        CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS upto FROM pieces),
    ends AS (
      SELECT a.doc_id, a.i AS s, max(b.i) AS e
      FROM sums a JOIN sums b ON a.doc_id = b.doc_id AND b.i >= a.i
        AND (b.i = a.i OR b.upto - a.upto + a.n <= {size})
      GROUP BY a.doc_id, a.i),
    starts AS (
      SELECT x.doc_id, x.s, x.e,
        coalesce(min(t.i), x.e + 1) AS nxt
      FROM ends x JOIN sums l ON l.doc_id = x.doc_id AND l.i = x.e
      JOIN sums f ON f.doc_id = x.doc_id AND f.i = x.e + 1
      LEFT JOIN sums t ON t.doc_id = x.doc_id AND t.i > x.s AND t.i <= x.e
        AND l.upto - t.upto + t.n <= {overlap} AND f.upto - t.upto + t.n <= {size}
      GROUP BY x.doc_id, x.s, x.e),
    walk AS (
      SELECT doc_id, s, e FROM ends WHERE s = 1
      UNION ALL
      SELECT n.doc_id, n.s, n.e FROM walk w
      JOIN starts st ON st.doc_id = w.doc_id AND st.s = w.s
      JOIN ends n ON n.doc_id = w.doc_id AND n.s = st.nxt),
    texts AS (
      SELECT w.doc_id, w.s,
        regexp_replace(regexp_replace(array_to_string(l.ps[w.s:w.e], chr(10)), '^\\s+', ''),
          '\\s+$', '') AS chunk
      FROM walk w JOIN lines l USING (doc_id))
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INT) AS chunk_no,
      md5(chunk) AS chunk_id
    FROM texts WHERE chunk <> ''"""


@query("chunk_separator", SEPARATOR.format(size=300, overlap=100))
def q_chunk_separator(spark, sf):
    return chunk_separator(load(spark, sf, "documents"), "text").select(
        "doc_id", "chunk_no", "chunk_id"
    )


@query("chunk_separator_small", SEPARATOR.format(size=60, overlap=25))
def q_chunk_separator_small(spark, sf):
    return chunk_separator(load(spark, sf, "documents"), "text", size=60, overlap=25).select(
        "doc_id", "chunk_no", "chunk_id"
    )


@query("index_rows", UNIQUE + """
    SELECT chunk_id, doc_uri, category, md5(content) AS content_md5 FROM uniq""")
def q_index_rows(spark, sf):
    return doc_index_rows(spark, sf).select(
        "chunk_id", "doc_uri", "category", F.md5("content").alias("content_md5")
    )


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("chunk_subwords", """
    SELECT doc_id, md5(text) AS joined_md5, CAST(length(text) AS INT) AS covered, true AS full_chunks
    FROM documents WHERE length(text) > 0""")
def q_chunk_subwords(spark, sf):
    """Chunks of 200 sub-word tokens put together again: every character is there, and all but the last are full."""
    chunks = chunk_subwords(load(spark, sf, "documents"), "text", tokenizer_file(), size=200, overlap=0)
    per_doc = chunks.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("chunk_no", "chunk", "start", "end", "n_tokens"))).alias("cs")
    )
    # A character whose bytes fall into two chunks is in both of them.
    before = lambda i: F.when(i == 0, 0).otherwise(F.get("cs", i - 1)["end"])
    own = F.transform("cs", lambda c, i: F.substr(c["chunk"], before(i) - c["start"] + 1))
    full = F.forall(F.slice("cs", F.lit(1), F.size("cs") - 1), lambda c: c["n_tokens"] == 200)
    last = F.element_at("cs", -1)
    return per_doc.select(
        "doc_id", F.md5(F.array_join(own, "")).alias("joined_md5"), last["end"].alias("covered"),
        (full & last["n_tokens"].between(1, 200)).alias("full_chunks"),
    )
