"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from askloom.llm import (
    archives, conversation_repair, decontamination, divergence, language_id, lm_scoring, near_dedup, packing, pii,
    quality_classifier, quality_rules, sharding, url_filter,
)
from askloom.llm.registry import query, table

#: The four counts, as contracts fix them.
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_near_dedup", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(4, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS p FROM words)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = r
), firsts AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM firsts LEFT JOIN sizes USING (doc_id)
""")
def op1(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query("op2_quality_rules")
def op2(spark, sf_dir):
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *BASE, "base_failed", "kept")


@query("op4_decontamination", r"""
WITH bytes_of AS (
  SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents
  UNION ALL SELECT 'b', item_id, row_number() OVER (), coalesce(text, '') FROM benchmark
), words AS (
  SELECT kind, id, r, regexp_extract_all(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM bytes_of
), sizes AS (
  SELECT DISTINCT least(10, len(w)) AS size FROM words WHERE kind = 'b' AND len(w) > 0
), places AS (
  SELECT kind, id, r, w, size, unnest(range(1, len(w) - size + 2)) AS p
  FROM words, sizes WHERE kind = 'd' OR size = least(10, len(w))
), windows AS (
  SELECT kind, id, r, p, size, array_to_string(w[p:p + size - 1], ' ') AS s FROM places
), hits AS (
  SELECT d.r, d.p, d.size, b.id AS item
  FROM windows d JOIN windows b ON d.s = b.s AND d.size = b.size WHERE d.kind = 'd' AND b.kind = 'b'
), hit_words AS (
  SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + size)) AS q FROM hits) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT r, CAST(item AS VARCHAR) AS i FROM hits) GROUP BY r
)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r) WHERE kind = 'd'
""")
def op4(spark, sf_dir):
    found = decontamination.find_overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op3_quality_classifier")
def op3(spark, sf_dir):
    return quality_classifier.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query("op5_url_filter")
def op5(spark, sf_dir):
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


@query("op6_lm_scoring", r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT r, doc_id, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM texts
), words AS (
  SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i, len(ws) AS n FROM split
), pairs AS (
  SELECT b.r, b.i, a.w AS u, b.w AS w FROM words a JOIN words b ON a.r = b.r AND b.i = a.i + 1
), corpus AS (SELECT count(*) AS n FROM words
), word_total AS (SELECT w, count(*) AS c FROM words GROUP BY w
), word_own AS (SELECT r, w, count(*) AS c FROM words GROUP BY r, w
), pair_total AS (SELECT u, w, count(*) AS c FROM pairs GROUP BY u, w
), pair_own AS (SELECT r, u, w, count(*) AS c FROM pairs GROUP BY r, u, w
), scored AS (
  SELECT x.r, CASE
    WHEN x.i > 1 AND pt.c > po.c THEN ln((pt.c - po.c) / (ut.c - uo.c))
    ELSE ln(CASE WHEN x.i > 1 THEN 0.4 ELSE 1 END * greatest(wt.c - wo.c, 1) / greatest(corpus.n - x.n, 1)) END AS s
  FROM words x CROSS JOIN corpus JOIN word_total wt ON wt.w = x.w JOIN word_own wo ON wo.r = x.r AND wo.w = x.w
  LEFT JOIN pairs p ON p.r = x.r AND p.i = x.i LEFT JOIN pair_total pt ON pt.u = p.u AND pt.w = p.w
  LEFT JOIN pair_own po ON po.r = p.r AND po.u = p.u AND po.w = p.w
  LEFT JOIN word_total ut ON ut.w = p.u LEFT JOIN word_own uo ON uo.r = p.r AND uo.w = p.u
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(sum(s), 3) AS log_score, round(sum(s) / len(ws), 6) AS score
FROM split LEFT JOIN scored USING (r) GROUP BY r, doc_id, ws
""")
def op6(spark, sf_dir):
    scored = lm_scoring.backoff_scores(table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("score", 6).alias("score")
    )


@query("op7_archives")
def op7(spark, sf_dir):
    records = archives.archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def joined_spans(spans):
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


@query("op8_pii")
def op8(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(joined_spans("base"), 256).alias("base_sha256"), joined_spans("spans").alias("spans"),
    )


@query("op9_packing")
def op9(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), with_ids=False)
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query("op10_sharding")
def op10(spark, sf_dir):
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


# The SQL of op11 carries, for each role written last, the cheapest (cost, audit, lines) through a conversation.
WAY = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])"


def _edit(state: str, edit: str, cost: str, line: str | None = None, when: str = "true") -> str:
    lines = f"{state}.r" if line is None else f"list_append({state}.r, {line})"
    made = f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {lines}}}::{WAY}"
    return f"CASE WHEN {state}.c IS NOT NULL AND {when} THEN {made} END"


def _best(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _turn(state: str, x: str) -> str:
    """The states after the turn ``x``; inserts before it are made already."""
    own, user, assistant = f"{x}.role || ':' || {x}.text", f"'user:' || {x}.text", f"'assistant:' || {x}.text"
    stay = {k: _edit(f"{state}.s{k}", "D", "3") for k in range(4)}
    keep = lambda k, i: _edit(f"{state}.s{k}", "K", f"{x}.extra", own, f"NOT {x}.gone AND {x}.i = '{i}'")
    rerole = lambda k, line: _edit(f"{state}.s{k}", "R", f"(2 + {x}.extra)", line, f"NOT {x}.gone")
    return f"""{{'s0': {stay[0]}, 's1': {_best(stay[1], keep(0, "s"))},
      's2': {_best(stay[2], *(f for k in (0, 1, 3) for f in (keep(k, "u"), rerole(k, user))))},
      's3': {_best(stay[3], keep(2, "a"), rerole(2, assistant))}}}"""


def _inserted(state: str) -> str:
    user = _best(f"{state}.s2", *(_edit(f"{state}.s{k}", "I", "2", "'user:'") for k in (0, 1, 3)))
    again = _edit(f"({user})", "I", "2", "'assistant:'")
    return f"{{'s0': {state}.s0, 's1': {state}.s1, 's2': {user}, 's3': {_best(f'{state}.s3', again)}}}"


START = f"{{'s0': {{'c': 0, 'a': '', 'r': []}}::{WAY}, " + ", ".join(f"'s{k}': NULL::{WAY}" for k in (1, 2, 3)) + "}"


@query("op11_conversation_repair", rf"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS step
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
    lambda c, b: xor(step[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS i,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM damaged
), seen AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
    lag(i) OVER (PARTITION BY conv_id ORDER BY place) || i NOT IN ('su', 'ua', 'au') AS odd
  FROM placed
), gathered AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
    count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated, count(*) FILTER (odd) AS illegal,
    list({{'i': i, 'gone': blank OR again, 'extra': CAST(cut AS BIGINT), 'role': role, 'text': text}} ORDER BY place) AS turns
  FROM seen GROUP BY conv_id
), folded AS (
  SELECT * EXCLUDE (turns), list_reduce(
    list_append(flatten(list_transform(turns, lambda t: [{{'s': {START}, 'x': NULL}}, {{'s': {START}, 'x': t}}])),
      {{'s': {START}, 'x': NULL}}),
    lambda was, op: {{'s': CASE WHEN op.x IS NULL THEN {_inserted("was.s")} ELSE {_turn("was.s", "op.x")} END, 'x': op.x}},
    {{'s': {START}, 'x': turns[1]}}).s AS s FROM gathered
), best AS (SELECT * EXCLUDE (s), {_best("s.s0", "s.s3")} AS w FROM folded)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost,
  coalesce(w.a, '') AS audit, sha256(coalesce(array_to_string(w.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
""")
def op11(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    repair = conversation_repair.repair_conversations(conversation_repair.damaged(turns))
    digests = conversation_repair.text_digests(repair.turns)
    named = lambda df: df.withColumnRenamed("conv_id", "_id")
    same = F.col("conv_id").eqNullSafe(F.col("_id"))
    kept = turns.select("conv_id").distinct().join(named(repair.conversations), same, "left").drop("_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return kept.join(named(digests), same, "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query("op12_divergence", r"""
WITH split AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), words AS (SELECT r, lang, source, unnest(w) AS term FROM split
), kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), sizes AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source
), groups AS (SELECT DISTINCT lang, source FROM split
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (coalesce(s.n, 0) + l.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM shares WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
""")
def op12(spark, sf_dir):
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


@query("op13_language_id")
def op13(spark, sf_dir):
    return language_id.identify_languages(table(spark, sf_dir, "documents"))
