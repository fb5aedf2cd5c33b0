"""Source divergence audit: how far the vocabularies of a language's sources lie apart.

Each (language, source) group is a row of term shares over the terms that at least ``MIN_DOCS`` documents
of the language hold. A share is a whole number of billionths with one count added to every term, and the
divergence of p from q over a term is ``floor((p - q)^2 / q)``; all arithmetic is in whole numbers.

Method: Gustavson's row-by-row product. The terms form a term-major index (one row per term with its
postings). A group scatters its own terms through the postings of these terms into a dense accumulator
with one cell per peer, so no pair of postings ever becomes a row. Terms that a group, its peer or both
lack are not visited: their share is the group's zero share, and the sums over them follow from the
distinct shares of either side ("zero baselines").

The index of a language is cut by the hash of the term into slices of bounded postings, as many as its
size asks for, so a language or source with a third of all rows is many tasks. A slice gives one partial
sum per pair of groups and at most ``top`` terms per group.

Defined cases: null text, language and source are the empty text, and a group of their own; a group
without terms has the zero share everywhere; a language without kept terms gives pairs of value 0 and no
terms; repeated rows count as documents of their own; no rows give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from askloom.llm.common import UPPER_TO_LOWER, staged, utf8

MIN_DOCS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
#: Postings of a slice aimed at: the number of group pairs, within these bounds.
SLICE_POSTINGS = (200_000, 4_000_000)
#: Distinct (group, term) counts that a task holds before it hands them on.
HELD_TERMS = 500_000
#: Texts are split into words in pieces of about this many bytes.
PIECE_BYTES = 1 << 20
#: Postings gathered at once while a group scatters its terms.
GATHER = 1 << 20

#: A-Z lower-cased; every other ASCII character that is no letter separates terms.
TO_TERMS = bytes(
    b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in UPPER_TO_LOWER
)

COUNTS = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64()),
])


def pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists of bounded size."""
    data = data.translate(TO_TERMS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def term_counts(docs: DataFrame, *, text: str, lang: str, source: str) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, summed per task as far as memory allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, inside = defaultdict(Counter), defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang_, source_), counts in seen.items():
                held = inside[lang_, source_]
                terms = list(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang_] * len(terms), pa.string()), pa.array([source_] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(counts.values(), pa.int64()), pa.array([held[t] for t in terms], pa.int64()),
                ], schema=COUNTS)
            seen.clear()
            inside.clear()

        for batch in batches:
            for row in zip(*batch.columns):
                lang_, source_, data = (v.as_py() for v in row)
                group, distinct = (lang_, source_), set()
                for terms in pieces(data):
                    seen[group].update(terms)
                    distinct.update(terms)
                inside[group].update(distinct)
                if sum(map(len, seen.values())) >= HELD_TERMS:
                    yield from flush()
        yield from flush()

    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(named(lang), named(source), utf8(text)).mapInArrow(
        run, "lang string, source string, term string, n bigint, docs bigint"
    )


def term_index(docs: DataFrame, *, text: str, lang: str, source: str, min_docs: int) -> DataFrame:
    """The term-major index ``lang, term, total, postings`` of the kept terms.

    A term's postings are one entry per source of its language. One shuffle by (lang, term) serves
    both aggregations; what it deals out was summed per task before.
    """
    counts = term_counts(docs, text=text, lang=lang, source=source).repartition("lang", "term")
    by_group = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return by_group.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings"),
        F.sum("docs").alias("docs"),
    ).where(F.col("docs") >= min_docs).drop("docs")


def shares(counts: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """``1 + floor(UNIT * (count + 1) / size)``, exact for counts of any size."""
    size = np.maximum(size, 1)
    if len(counts) and counts.max() >= 2**62 // UNIT:
        pairs = np.broadcast_arrays(counts.astype(object), size)
        return np.array([1 + UNIT * (int(c) + 1) // int(d) for c, d in zip(*pairs)], dtype=np.int64)
    return 1 + UNIT * (counts + 1) // size


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Slice:
    """Some terms of a language in term-major order, and all groups of the language."""

    def __init__(self, sizes: np.ndarray, n_terms: int, lengths: np.ndarray, peer: np.ndarray, n: np.ndarray):
        """``sizes``: counts per group over all ``n_terms`` kept terms; the rest: postings of this slice."""
        self.peer, self.p = peer, shares(n, (sizes + n_terms)[peer])
        self.zero = shares(np.zeros(len(sizes), dtype=np.int64), sizes + n_terms)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.term = np.repeat(np.arange(len(lengths)), lengths)
        by_group = np.argsort(peer, kind="stable")
        ends = np.searchsorted(peer[by_group], np.arange(len(sizes) + 1))
        self.rows = [by_group[a:b] for a, b in zip(ends, ends[1:])]
        #: Distinct shares per group and how many terms have them.
        pairs, self.times = np.unique(np.stack([peer, self.p]), axis=1, return_counts=True)
        self.peer_of, self.p_of = pairs if pairs.size else np.zeros((2, 0), dtype=np.int64)

    def row(self, g: int) -> np.ndarray:
        """The dense accumulator of group ``g``: its divergence from every group over the slice's terms."""
        zero, z = self.zero, self.zero[g]
        nothing = gap(z, zero)
        # As if neither side had any of the terms; then the terms of one side each; then those of both.
        acc = len(self.lengths) * nothing
        own = self.peer_of == g
        for p, times in zip(self.p_of[own], self.times[own]):
            acc += times * (gap(p, zero) - nothing)
        np.add.at(acc, self.peer_of, self.times * (gap(z, self.p_of) - nothing[self.peer_of]))
        rows = self.rows[g]
        size = self.lengths[self.term[rows]]
        cuts = np.searchsorted(np.cumsum(size), np.arange(GATHER, size.sum() + GATHER, GATHER), side="right")
        for some in np.split(rows, np.unique(cuts)):
            size = self.lengths[self.term[some]]
            at = np.arange(size.sum()) + np.repeat(self.starts[self.term[some]] - np.cumsum(size) + size, size)
            p, h, q = np.repeat(self.p[some], size), self.peer[at], self.p[at]
            np.add.at(acc, h, gap(p, q) - gap(p, zero[h]) - gap(z, q) + nothing[h])
        return acc


def audit_slice(groups: pa.Table, index: pa.Table, top: int) -> pa.Table:
    """Partial sums per pair of groups, and the foremost terms of each group, of one slice."""
    groups = groups.sort_by("source")
    names = groups["source"].combine_chunks()
    sizes = groups["n"].to_numpy().astype(np.int64)
    n_terms, lang_n = groups["terms"][0].as_py(), groups["lang_n"][0].as_py()
    index = index.combine_chunks()
    postings = index["postings"].combine_chunks() if index.num_rows else pa.array([], index.schema.field("postings").type)
    entries = postings.flatten()
    peer = pc.index_in(entries.field("source"), names).to_numpy(zero_copy_only=False).astype(np.int64)
    n = entries.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.list_value_length(postings).to_numpy(zero_copy_only=False).astype(np.int64)
    part = Slice(sizes, n_terms, lengths, peer, n)
    q = shares(index["total"].to_numpy().astype(np.int64), lang_n + n_terms)
    out = []

    def add(g: int, kind: str, items, values: np.ndarray) -> None:
        same = lambda v: pa.repeat(pa.scalar(v, pa.string()), len(values))
        found = pa.table({"source": same(names[g].as_py()), "part": same(kind), "item": items, "value": pa.array(values)})
        out.append(found.sort_by([("value", "descending"), ("item", "ascending")])[:top] if kind == "term" else found)

    for g in range(len(sizes)):
        peers = np.flatnonzero(np.arange(len(sizes)) != g)
        add(g, "pair", names.take(pa.array(peers)), part.row(g)[peers])
        own, above = part.rows[g], q[part.term[part.rows[g]]]
        more = part.p[own] > above
        terms = index["term"].take(pa.array(part.term[own[more]]))
        add(g, "term", terms, gap(part.p[own[more]], above[more]))
    return pa.concat_tables(out).append_column("lang", pa.repeat(groups["lang"][0], sum(map(len, out))))


def source_divergence(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = MIN_DOCS, top: int = TOP_TERMS, slice_postings: tuple[int, int] = SLICE_POSTINGS,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of ``docs``.

    Part ``pair`` has a row per other source of the language, part ``term`` the ``top`` terms that the
    group uses more than its language. Within a group and part ranks follow the value, then the item.
    """
    index = staged(term_index(docs, text=text, lang=lang, source=source, min_docs=min_docs), "term-index")
    sizes = index.select("lang", F.explode("postings").alias("p")).groupBy("lang", F.col("p.source").alias("source"))
    sizes = sizes.agg(F.sum("p.n").alias("n"), F.count(F.lit(1)).alias("entries"))
    terms = index.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    known = docs.select(named(lang).alias("lang"), named(source).alias("source")).distinct()
    groups = known.join(sizes, ["lang", "source"], "left").join(terms, "lang", "left").fillna(0)
    per_lang = groups.groupBy("lang").agg(F.sum("entries").alias("_p"), F.count(F.lit(1)).alias("_s"))
    held = F.greatest(F.lit(slice_postings[0]), F.least(F.lit(slice_postings[1]), F.col("_s") * F.col("_s")))
    slices = F.greatest(F.lit(1), F.ceil(F.col("_p") / held)).cast("int").alias("slices")
    # One row per group: written, so that its size decides how the joins below are done.
    groups = staged(groups.join(per_lang.select("lang", slices), "lang"), "groups")
    dealt = index.join(groups.select("lang", "slices").distinct(), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "slices").cast("int").alias("slice"), "term", "total", "postings"
    )
    peers = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))

    def run(groups: pa.Table, index: pa.Table) -> pa.Table:
        order = ["lang", "source", "part", "item", "value"]
        if not groups.num_rows:
            return pa.table([[]] * 5, schema=pa.schema([*((c, pa.string()) for c in order[:4]), ("value", pa.int64())]))
        return audit_slice(groups, index, top).select(order)

    keys = ["lang", "slice"]
    partial = peers.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(
        run, "lang string, source string, part string, item string, value bigint"
    )
    summed = partial.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return summed.withColumn("rank", F.row_number().over(place)).where((F.col("part") == "pair") | (F.col("rank") <= top))
