"""Text search over sparse TF-IDF vectors: rows of (key, term, weight) and an inverted index of postings.

The weight of a term is ``1 + ln(count)``, in a question times ``ln((texts + 1) / (texts with the term + 1))``, scaled so
that the vector of the text or question has length one, as a whole number of millionths (lnc.ltc in the SMART notation).
The texts' side needs nothing but the text, so the vectors are made in one pass without a shuffle. Scores are sums of
products of whole numbers: exact, in whatever order they are summed.

Questions (their terms are counted first) go to every task, as an inverted index of their own, in blocks of bounded size.
Texts stream by, those that are alike together with questions that are alike: the terms that many of them share are multiplied as a matrix,
other terms are scattered into one score per question. A task hands on the k best texts of each
question: vectors are read once per block and not shuffled.

On a stored index, which has postings only, questions are joined with the postings by term, and products summed per question and text.
A term that is in very many texts would give a row for each of them, for every question that holds it.
Such common terms are left out at first. The k-th best sum over the other terms bounds the k-th best score
from below, and what common terms can add to any score is known from their largest weight. Only texts that can still be
among the k best are then looked up, by text and term. Questions for which that proves nothing (they have
hardly any rare terms) go through all their postings: those of the terms they hold are put together to texts again, a
posting once for all questions, and the texts are scanned as above.

Both ways give the same result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from askloom.operators.keys import look_up, small_side
from askloom.operators.vectors import rank_hits
from askloom.session import cut, stage

UNIT = 1_000_000
#: Share of all texts above which a term counts as common.
COMMON_SHARE = 0.05
#: ... but never below so many texts, for which a join is no burden.
COMMON_LEAST = 1000
BUCKETS = 64
#: Rows of the questions' side (a term and two or three numbers each) up to which they go to every task.
SMALL_ROWS = 200_000
#: Questions that are scanned for at once at most.
SCAN_QUESTIONS = 50_000
#: Terms of the questions that are scanned for at once, about: some 20 bytes each in every task.
BLOCK_TERMS = 2_000_000
#: Clusters of the questions of a block, the frequent terms that tell them apart, and questions that are multiplied together at most.
CLUSTERS = 8
FREQUENT = 256
GROUP_QUESTIONS = 2_000
#: Weights of texts that a task gathers before it multiplies, and scores that it holds at once, about.
SCAN_NUMBERS = 1 << 19
SCORES = 1 << 18
#: Tasks per slot of a scan at most.
SCAN_TASKS = 3
#: Share of the pairs above which a term's weights are multiplied as a matrix, and numbers in it at most.
DENSE_SHARE = 0.004
DENSE_NUMBERS = 1 << 21
#: Rows that a task collects for a group of questions before it goes back to the k best of each.
HELD_HITS = 500_000
SPACE = re.compile(r"[ \t\n\x0b\f\r]+")


class TermIndex:
    """``postings`` (term, number, weight), ``keys`` (number, key), ``terms`` (term, texts) and ``n_texts``.

    ``vectors`` (key, terms, weights, number) while it is not stored, written when a part is first asked for.
    There are very many postings: a text is a number in them.
    """

    def __init__(self, numbered: DataFrame | None, common_share: float, common_least: int):
        self.numbered, self.common_share, self.common_least = numbered, common_share, common_least

    @cached_property
    def vectors(self) -> DataFrame | None:
        return None if self.numbered is None else stage(self.numbered, "vectors")

    @cached_property
    def postings(self) -> DataFrame:
        return posting_rows(self.vectors).where("term IS NOT NULL").drop("key")

    @cached_property
    def keys(self) -> DataFrame:
        return self.vectors.select("number", "key")

    @cached_property
    def terms(self) -> DataFrame:
        return stage(text_counts(self.vectors.select(F.explode("terms").alias("term"))), "terms")

    @cached_property
    def n_texts(self) -> int:
        return self.vectors.count()


def text_counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("texts"))


def posting_rows(vectors: DataFrame) -> DataFrame:
    """``term, number, weight, key``: the key in one row of each text, which has no term if the text has none."""
    listed = F.posexplode_outer(F.arrays_zip("terms", "weights")).alias("place", "p")
    return vectors.select("number", "key", listed).select(
        F.col("p.terms").alias("term"), "number", F.col("p.weights").alias("weight"),
        F.when(F.coalesce("place", F.lit(0)) == 0, F.col("key")).alias("key"),
    )


def counted(text: str | None) -> Counter:
    """Lower-case words between ASCII white space; none for null."""
    return Counter(w for w in SPACE.split((text or "").lower()) if w)


def term_vectors(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, terms, tfs, weights`` of every text, with the weights of the texts' side; ``key`` is unique.

    Counted where the text lies.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Some texts at a time, since a text may hold very many words.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts = [counted(t.as_py()) for t in part.column(1)]
                sizes = np.array([len(c) for c in counts], dtype=np.int64)
                tf = np.array([n for c in counts for n in c.values()], dtype=np.int64)
                raw = 1 + np.log(np.maximum(tf, 1))
                lengths = np.sqrt(np.bincount(np.repeat(np.arange(len(counts)), sizes), raw * raw, len(counts)))
                weight = np.floor(raw * UNIT / np.repeat(lengths, sizes) + 0.5).astype(np.int64)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                listed = lambda values: pa.ListArray.from_arrays(ends, values)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), listed(pa.array([w for c in counts for w in c], pa.string())),
                    listed(pa.array(tf)), listed(pa.array(weight)),
                ], names=["key", "terms", "tfs", "weights"])

    known = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), text)
    return known.mapInArrow(run, f"key {kind}, terms array<string>, tfs array<bigint>, weights array<bigint>")


def question_weights(questions: DataFrame, key: str, text: str, index: TermIndex) -> DataFrame:
    """``query_key, term, q, texts`` of the terms that the index has; one that is in every text weighs nothing."""
    counts = term_vectors(questions, key, text).select("key", F.explode(F.arrays_zip("terms", "tfs")).alias("c")).select(
        "key", F.col("c.terms").alias("term"), F.col("c.tfs").alias("tf")
    )
    idf = F.log((F.lit(index.n_texts) + 1) / (F.col("texts") + 1))
    raw = counts.join(index.terms, "term").withColumn("w", (1 + F.log("tf")) * idf).where("w > 0")
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("key")))
    return raw.select(
        F.col("key").alias("query_key"), "term", F.round(F.col("w") * UNIT / length).cast("bigint").alias("q"), "texts"
    )


def term_index(
    df: DataFrame, key: str, text: str, *, common_share: float = COMMON_SHARE, common_least: int = COMMON_LEAST,
) -> TermIndex:
    """The sparse vectors of the texts of ``df``, made in one pass, and what follows from them."""
    numbered = term_vectors(df, key, text).drop("tfs").withColumn("number", F.monotonically_increasing_id())
    return TermIndex(numbered, common_share, common_least)


def write_term_index(index: TermIndex, name: str, *, buckets: int = BUCKETS) -> None:
    """Keep the index as the tables ``<name>_postings`` and ``<name>_terms``, both bucketed and sorted by term, and ``<name>_keys``.

    Searches on them shuffle the terms of the questions only. The postings are written in one pass over the texts,
    and the others from them: vectors that are not there yet are not written besides.
    """
    def keep(df: DataFrame, part: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, "term").sortBy("term").saveAsTable(f"{name}_{part}")
        return df.sparkSession.table(f"{name}_{part}")

    postings = keep(posting_rows(index.vectors if "vectors" in vars(index) else index.numbered), "postings")
    keep(text_counts(postings.where("term IS NOT NULL")), "terms")
    postings.where("key IS NOT NULL").select("number", "key").write.mode("overwrite").saveAsTable(f"{name}_keys")
    spark = postings.sparkSession
    spark.createDataFrame(
        [(spark.table(f"{name}_keys").count(), index.common_share, index.common_least)],
        "n_texts bigint, common_share double, common_least bigint",
    ).write.mode("overwrite").saveAsTable(f"{name}_settings")


def read_term_index(spark: SparkSession, name: str) -> TermIndex:
    n_texts, *settings = spark.table(f"{name}_settings").first()
    index = TermIndex(None, *settings)
    index.postings = spark.table(f"{name}_postings").where("term IS NOT NULL").select("term", "number", "weight")
    index.keys, index.terms, index.n_texts = spark.table(f"{name}_keys"), spark.table(f"{name}_terms"), n_texts
    return index


def _summed(asked: DataFrame, postings: DataFrame) -> DataFrame:
    """``query_key, number, score`` of all texts that share a term; ``asked`` is written."""
    asked = small_side(asked.select("query_key", "term", "q"), SMALL_ROWS)
    found = postings.join(asked, "term").groupBy("query_key", "number")
    return found.agg(F.sum(F.col("q") * F.col("weight")).alias("score"))


def _joined(asked: DataFrame, index: TermIndex, k: int) -> DataFrame:
    """``query_key, index_key, score`` of the k best texts of each question, and of those that tie with the last."""
    rare, common = asked.where("NOT common"), asked.where("common").select("query_key", "term", "q")
    # One row per common term that is asked for.
    top = index.postings.join(small_side(stage(common.select("term").distinct(), "common"), SMALL_ROWS), "term").groupBy("term").agg(
        F.max("weight").alias("top")
    )
    common = stage(common.join(top, "term"), "common-terms")
    partial = stage(_summed(rare, index.postings), "sums")
    more = common.groupBy("query_key").agg(F.sum(F.col("q") * F.col("top")).alias("more"))
    place = Window.partitionBy("query_key").orderBy(F.desc("score"))
    kth = partial.withColumn("_n", F.row_number().over(place)).where(F.col("_n") == k).select(
        "query_key", F.col("score").alias("kth")
    )
    # One row per question: which ones are settled by their rare terms.
    bounds = cut(
        asked.select("query_key").distinct().join(more, "query_key", "left").join(kth, "query_key", "left")
        .select("query_key", F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("kth", F.lit(-1)).alias("kth"))
        .withColumn("settled", (F.col("more") == 0) | (F.col("kth") > F.col("more")))
    )
    near = partial.join(bounds.where("settled"), "query_key").where(F.col("score") >= F.col("kth") - F.col("more"))
    near = stage(near.select("query_key", "number", "score"), "near")
    # A question whose texts and common terms are many goes through its postings too: what is looked up stays small.
    pairs = near.groupBy("query_key").agg(F.count(F.lit(1)).alias("texts")).join(
        common.groupBy("query_key").agg(F.count(F.lit(1)).alias("terms")), "query_key", "left"
    )
    share = SMALL_ROWS // max(1, bounds.count())
    looked = cut(pairs.where(F.col("texts") * F.coalesce("terms", F.lit(0)) <= share).select("query_key"))
    near = near.join(looked, "query_key", "left_semi")
    wanted = stage(near.select("query_key", "number").join(common, "query_key").select("query_key", "term", "number", "q"), "wanted")
    added = index.postings.join(small_side(wanted, SMALL_ROWS), ["term", "number"]).select(
        "query_key", "number", (F.col("q") * F.col("weight")).alias("score")
    )
    looked_up = near.unionByName(added).groupBy("query_key", "number").agg(F.sum("score").alias("score"))
    # Ties are settled by the key, so all of them are looked up.
    best = looked_up.withColumn("_n", F.rank().over(place)).where(F.col("_n") <= k).drop("_n")
    named = look_up(stage(best, "best"), index.keys, "number").select("query_key", F.col("key").alias("index_key"), "score")
    still_open = stage(asked.join(looked, "query_key", "left_anti"), "open")
    if still_open.isEmpty():
        return named
    return named.unionByName(_scan(*_restored(still_open, index), k, written=False))


def _restored(asked: DataFrame, index: TermIndex) -> tuple[DataFrame, DataFrame]:
    """``asked``, and ``key, terms, weights`` of the texts that share a term with a question, with numbers for terms.

    Only postings of the terms asked for are shuffled, once however many questions hold the term.
    """
    terms = stage(asked.select("term").distinct().withColumn("id", F.monotonically_increasing_id()), "open-terms")
    found = index.postings.join(small_side(terms, SMALL_ROWS), "term").select("number", "id", "weight")
    texts = found.repartition("number").groupBy("number").agg(F.collect_list(F.struct("id", "weight")).alias("p"))
    restored = texts.join(index.keys, "number").select("key", F.col("p.id").alias("terms"), F.col("p.weight").alias("weights"))
    return asked.join(terms, "term").select("query_key", F.col("id").alias("term"), "q"), restored


def best_hits(hits: pa.Table, k: int) -> pa.Table:
    """The k best rows of each ``q``, by score, then key."""
    hits = hits.sort_by([("q", "ascending"), ("score", "descending"), ("key", "ascending")])
    q = hits["q"].to_numpy()
    new = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, dtype=np.int64)
    starts = np.repeat(new, np.diff(np.append(new, len(q))))
    return hits.filter(pa.array(np.arange(len(q)) - starts < k))


class Group(NamedTuple):
    """Questions ``first``, ``first + 1``, ... that are alike, as an inverted index: the questions of each term and its weights.

    Weights are whole numbers of at most a million, which 32 bits hold exactly.
    """

    cluster: int
    first: int
    n: int
    terms: np.ndarray
    starts: np.ndarray
    question: np.ndarray
    weight: np.ndarray


class Block(NamedTuple):
    """The questions of a block in groups. Of texts and questions, ``frequent`` terms and ``centres`` tell the cluster."""

    names: list
    vocabulary: pa.Array
    frequent: np.ndarray
    centres: np.ndarray
    groups: list[Group]


def nearest(row: np.ndarray, column: np.ndarray, value: np.ndarray, n: int, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of ``n`` rows, of length one, and the number of the nearest centre of each."""
    vectors = np.zeros((n, centres.shape[1]), dtype=np.float32)
    vectors[row, column] = value
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
    return vectors, np.argmax(vectors @ centres.T, axis=1)


def question_block(rows: pa.Table) -> Block:
    """The rows ``query_key, term, q`` of a few questions as a block.

    Questions are put in clusters by their frequent terms. These only decide which questions and texts are multiplied together, not the result.
    """
    rows = rows.combine_chunks()
    named, worded = (pc.dictionary_encode(rows[c]).combine_chunks() for c in ("query_key", "term"))
    vocabulary, names = worded.dictionary, named.dictionary.to_pylist()
    question, term = (d.indices.to_numpy(zero_copy_only=False).astype(np.int64) for d in (named, worded))
    weight, n = rows["q"].to_numpy().astype(np.float64), len(names)
    frequent = np.argsort(-np.bincount(term, minlength=len(vocabulary)), kind="stable")[:FREQUENT]
    column = np.full(len(vocabulary), -1)
    column[frequent] = np.arange(len(frequent))
    often = column[term] >= 0
    known = question[often], column[term[often]], weight[often], n
    vectors, cluster = nearest(*known, np.zeros((1, len(frequent)), dtype=np.float32))
    centres = vectors[np.linspace(0, n - 1, min(n, CLUSTERS)).astype(np.int64)] if n else vectors
    for _ in range(6):
        vectors, cluster = nearest(*known, centres) if n else (vectors, cluster)
        sums = np.stack([vectors[cluster == c].sum(axis=0) for c in range(len(centres))]) if n else centres
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-9)[:, None]
    order = np.argsort(cluster, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    question = place[question]
    by = np.lexsort((question, term))
    question, term, weight = question[by], term[by], weight[by]
    groups = []
    for c in np.unique(cluster):
        first, last = np.searchsorted(cluster[order], [c, c + 1])
        for at in range(first, last, GROUP_QUESTIONS):
            size = min(GROUP_QUESTIONS, last - at)
            own = np.flatnonzero((question >= at) & (question < at + size))
            terms, starts = np.unique(term[own], return_index=True)
            groups.append(Group(
                int(c), int(at), int(size), terms, np.append(starts, len(own)), (question[own] - at).astype(np.int32), weight[own].astype(np.float32)
            ))
    return Block([names[i] for i in order], vocabulary, frequent, centres, groups)


class Scan:
    """The k best texts so far of each question of a block, while texts go by."""

    def __init__(self, block: Block, k: int):
        self.block, self.k, n_terms = block, k, len(block.vocabulary)
        self.column = np.full(n_terms, -1, dtype=np.int32)
        self.column[block.frequent] = np.arange(len(block.frequent))
        # The place of a term of the vocabulary among those of a group.
        self.local = np.full((len(block.groups), n_terms), -1, dtype=np.int32)
        for i, g in enumerate(block.groups):
            self.local[i, g.terms] = np.arange(len(g.terms))
        self.kth = [np.ones(g.n) for g in block.groups]
        self.hits: list[list[pa.Table]] = [[] for _ in block.groups]
        self.held = [0] * len(block.groups)
        self.waiting, self.numbers = [], 0

    def add(self, keys: pa.Array, terms: pa.ListArray, weights: pa.ListArray) -> None:
        self.waiting.append((keys, terms.flatten(), pc.list_value_length(terms).to_numpy(zero_copy_only=False), weights.flatten().to_numpy()))
        self.numbers += len(self.waiting[-1][-1]) + len(terms)
        if self.numbers >= SCAN_NUMBERS:
            self.flush()

    def flush(self) -> None:
        """Score the texts that wait, those of a cluster together."""
        if not self.waiting:
            return
        keys, words, sizes, held = zip(*self.waiting)
        self.waiting, self.numbers = [], 0
        keys, sizes, held = pa.concat_arrays(keys), np.concatenate(sizes), np.concatenate(held)
        # Looked up in one go: each time, a table of the whole vocabulary is made.
        at = pc.index_in(pa.concat_arrays(words), self.block.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
        known, owner = at >= 0, np.repeat(np.arange(len(sizes)), sizes)
        at, owner, held = at[known], owner[known], held[known].astype(np.float64)
        sizes, column = np.bincount(owner, minlength=len(sizes)), self.column[at]
        often = column >= 0
        _, cluster = nearest(owner[often], column[often], held[often], len(sizes), self.block.centres)
        order = np.argsort(cluster, kind="stable")
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        ends = np.cumsum(sizes)
        place = np.arange(len(at)) + np.repeat(starts - ends + sizes, sizes)
        keys, at, held, cluster = keys.take(pa.array(order)), at[place], held[place], cluster[order]
        ends = np.append(0, ends)
        for i, group in enumerate(self.block.groups):
            # Texts of the questions' own cluster first: they raise what the others have to reach.
            for c in sorted(set(cluster.tolist()), key=lambda c: (c != group.cluster, c)):
                lo, hi = np.searchsorted(cluster, [c, c + 1])
                some = slice(ends[lo], ends[hi])
                self.score(i, keys.slice(lo, hi - lo), at[some], np.diff(ends[lo:hi + 1]), held[some])

    def score(self, i: int, keys: pa.Array, at: np.ndarray, sizes: np.ndarray, held: np.ndarray) -> None:
        """Scores of texts (rows) for the questions of a group (columns): whole numbers below 2 ** 53, so exact."""
        group, local = self.block.groups[i], self.local[i][at]
        n, known = len(sizes), local >= 0
        owner, local, held = np.repeat(np.arange(n), sizes)[known], local[known], held[known]
        lengths = np.diff(group.starts)
        # Terms of many of the pairs are multiplied as a matrix.
        pairs = np.bincount(local, minlength=len(lengths)) * lengths
        dense = np.flatnonzero(pairs > DENSE_SHARE * n * group.n)
        dense = dense[np.argsort(-pairs[dense], kind="stable")][: DENSE_NUMBERS // group.n]
        row = np.full(len(lengths), -1)
        row[dense] = np.arange(len(dense))
        matrix, in_dense = np.zeros((len(dense), group.n)), row[local] >= 0
        place = self.places(group.starts[dense], lengths[dense])
        matrix[np.repeat(np.arange(len(dense)), lengths[dense]), group.question[place]] = group.weight[place]
        texts = np.zeros((n, len(dense)))
        texts[owner[in_dense], row[local[in_dense]]] = held[in_dense]
        owner, local, held = owner[~in_dense], local[~in_dense], held[~in_dense]
        step = max(1, min(256, SCORES // group.n))
        ends = np.searchsorted(owner, np.arange(0, n + step, step))
        for t, lo in enumerate(range(0, n, step)):
            hi, part = min(n, lo + step), slice(ends[t], ends[t + 1])
            scores = texts[lo:hi] @ matrix
            sizes = lengths[local[part]]
            place = self.places(group.starts[local[part]], sizes)
            cell = np.repeat((owner[part] - lo) * group.n, sizes)
            cell += group.question[place]
            product = np.repeat(held[part], sizes)
            product *= group.weight[place]
            scores += np.bincount(cell, product, scores.size).reshape(scores.shape)
            self.keep(i, keys, lo, scores)

    @staticmethod
    def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``starts[0], starts[0] + 1, ...`` up to ``sizes[0]`` numbers, then the same of the others."""
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)

    def keep(self, i: int, keys: pa.Array, first: int, scores: np.ndarray) -> None:
        n, least = self.block.groups[i].n, self.kth[i]
        found = np.flatnonzero(scores >= least)
        if len(found) > 2 * self.k * n and len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
            found = np.flatnonzero(scores >= least)
        if not len(found):
            return
        self.hits[i].append(pa.table({
            "q": pa.array(found % n), "key": keys.take(pa.array(first + found // n)),
            "score": pa.array(scores.ravel()[found].astype(np.int64)),
        }))
        self.held[i] += len(found)
        if self.held[i] >= min(HELD_HITS, 4 * self.k * n + 1):
            self.settle(i)

    def settle(self, i: int) -> pa.Table:
        n, best = self.block.groups[i].n, best_hits(pa.concat_tables(self.hits[i]), self.k)
        found = np.bincount(best["q"].to_numpy(), minlength=n)
        lowest = np.full(n, np.inf)
        np.minimum.at(lowest, best["q"].to_numpy(), best["score"].to_numpy())
        self.kth[i] = np.where(found >= self.k, lowest, 1)
        self.hits[i], self.held[i] = [best], 0
        return best

    def best(self) -> Iterator[pa.Table]:
        """The hits of each group, with the numbers that its questions have in the block."""
        self.flush()
        for i, group in enumerate(self.block.groups):
            if self.hits[i]:
                best = self.settle(i)
                yield best.set_column(0, "q", pc.add(best["q"], group.first))


def _scan(asked: DataFrame, vectors: DataFrame, k: int, *, written: bool = True) -> DataFrame:
    """``query_key, index_key, score`` of the k best texts per question and task.

    Many questions are scanned for in blocks of bounded size, one after the other: the vectors are read once per
    block, and what is written are k rows per question.
    """
    rows, questions = asked.agg(F.count(F.lit(1)), F.count_distinct("query_key")).first()
    blocks = max(1, -(-rows // BLOCK_TERMS), -(-questions // (SCAN_QUESTIONS or questions or 1)))
    if blocks == 1:
        return _scanned_block(asked, vectors, k)
    found, vectors = None, vectors if written else stage(vectors, "restored")
    for n in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("query_key", F.lit(29)), F.lit(blocks)) == n)
        best = stage(rank_hits(_scanned_block(block, vectors, k), k).drop("rank"), "scanned")
        found = best if found is None else found.unionByName(best)
    return found


def _scanned_block(asked: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    block = question_block(asked.select("query_key", "term", "q").toArrow())
    kind = vectors.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(block, k)
        for batch in batches:
            scan.add(*batch.columns)
        for best in scan.best():
            yield from best.to_batches()

    # A task finds out anew what a text has to reach: a few for each slot, of many texts each.
    few = vectors.select("key", "terms", "weights").coalesce(SCAN_TASKS * asked.sparkSession.sparkContext.defaultParallelism)
    found = few.mapInArrow(run, f"q bigint, key {kind}, score bigint")
    listed = asked.sparkSession.createDataFrame(
        list(enumerate(block.names)), f"q bigint, query_key {asked.schema['query_key'].dataType.simpleString()}"
    )
    return found.join(F.broadcast(listed), "q").select("query_key", F.col("key").alias("index_key"), "score")


def search_terms(
    questions: DataFrame, index: TermIndex, *, k: int = 3, query_key: str, text: str, query_cols: list[str] = (),
) -> DataFrame:
    """``query_key, index_key, score, rank``: the k best of the texts that share a weighted term with the question.

    ``score`` is the cosine of the sparse vectors; ties go to the smaller key.
    """
    asked = question_weights(questions, query_key, text, index)
    limit = max(index.common_least, int(index.common_share * index.n_texts))
    asked = stage(asked.withColumn("common", F.col("texts") > limit), "asked")
    scanned = index.numbered is not None and SCAN_QUESTIONS
    found = _scan(asked, index.vectors, k) if scanned else _joined(asked, index, k)
    hits = rank_hits(found, k)
    hits = hits.select("query_key", "index_key", (F.col("score") / (UNIT * UNIT)).alias("score"), "rank")
    if query_cols:
        hits = hits.join(questions.select(F.col(query_key).alias("query_key"), *query_cols), "query_key")
    return hits
