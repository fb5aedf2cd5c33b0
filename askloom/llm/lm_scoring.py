"""Stupid-backoff language-model scores from counts over the whole corpus.

A word after another scores count(pair) / count(first), or ``BACKOFF`` times its own share of the corpus
where no other document holds the pair. A document does not vouch for itself: its own counts are
taken off first, and a word that only it holds counts as seen once.

Count tables are partitioned by hash. Documents are read in chunks of some MB; a chunk adds up its
own words and pairs and sends each partition one block of distinct hashes and counts, a partition adds
up its blocks and answers every chunk in the order it asked, and the chunk, brought together with
its answers, sums the scores of its documents. So a pair that stands in every document is one entry
per chunk, no partition holds more than its share of distinct pairs, and the number of partitions and
chunks follows the size of the corpus.

Hashes have 40 bits inside a partition, which may join two of a few million grams; counts are exact
otherwise. A chunk is a run of rows of one input split; should a split be read in another order the
second time, the chunk's checksum differs and the job fails instead of giving wrong scores.

Defined cases: a null, empty or blank text has no words and a null score; a text of one word is scored
by its share; repeated rows are other documents to each other; an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from askloom.llm.common import mix64, utf8, word_hashes

BACKOFF = 0.4
CHUNK_BYTES = 8_000_000
#: Text bytes whose grams make one partition of the count tables.
PART_BYTES = 16_000_000
TAG = np.uint64((1 << 40) - 1)
#: The partition that adds up the words of the corpus.
ALL_WORDS = -1
SEPARATOR = b"\x00"


class Chunk:
    """Words of some documents: places of distinct words and pairs, and the documents they stand in."""

    def __init__(self, texts: list[bytes]):
        words = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        flat = word_hashes([w for ws in words for w in ws])
        self.words, self.word_at = np.unique(flat, return_inverse=True)
        follows = np.ones(len(flat), dtype=bool)
        follows[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = False
        #: Places that have a word before them in their document.
        self.second = np.flatnonzero(follows)
        code = self.word_at[self.second - 1] * np.int64(max(len(self.words), 1)) + self.word_at[self.second]
        distinct, self.pair_at = np.unique(code, return_inverse=True)
        first, last = np.divmod(distinct, max(len(self.words), 1))
        # Pairs are hashed by the hashes of their words, so that every chunk names them alike.
        self.pairs = mix64(self.words[first] * np.uint64(0x9E3779B97F4A7C15) + self.words[last] + np.uint64(1))

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of words and pairs, words first, and their counts here."""
        return (
            np.concatenate([mix64(self.words), self.pairs]),
            np.concatenate([
                np.bincount(self.word_at, minlength=len(self.words)),
                np.bincount(self.pair_at, minlength=len(self.pairs)),
            ]),
        )

    def score(self, totals: np.ndarray, corpus: int, backoff: float) -> np.ndarray:
        """Sum of log scores per document; not a number without words."""
        n_docs, n_words = len(self.sizes), len(self.words)
        word_total, pair_total = totals[:n_words], totals[n_words:]

        def others(at: np.ndarray, doc: np.ndarray, total: np.ndarray) -> np.ndarray:
            """Counts of all other documents at each place."""
            _, inverse, own = np.unique(doc * np.int64(max(len(total), 1)) + at, return_inverse=True, return_counts=True)
            return total[at] - own[inverse]

        words = others(self.word_at, self.doc, word_total)
        rest = np.maximum(corpus - self.sizes[self.doc], 1)
        log = np.log(backoff * np.maximum(words, 1) / rest)
        if len(self.second):
            pairs = others(self.pair_at, self.doc[self.second], pair_total)
            seen = pairs > 0
            at = self.second[seen]
            log[at] = np.log(pairs[seen] / words[at - 1])
        # The first word of a text is scored by its share, without the factor.
        starts = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        log[starts] -= np.log(backoff)
        return np.where(self.sizes > 0, np.bincount(self.doc, log, n_docs), np.nan)


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int):
    """(name, ids, texts) of the chunks of a task."""
    part, number = TaskContext.get().partitionId(), 0
    ids, texts, held = [], [], 0

    def named() -> str:
        return f"{part}-{number}-{xxhash.xxh3_64_hexdigest(SEPARATOR.join(texts))}"

    for batch in batches:
        for doc, text in zip(*((v.as_py() for v in c) for c in batch.columns)):
            ids.append(doc)
            texts.append(text)
            held += len(text)
            if held >= chunk_bytes:
                yield named(), ids, texts
                number += 1
                ids, texts, held = [], [], 0
    if ids:
        yield named(), ids, texts


def _deal(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (partition, hash), the bounds of the partitions, and 40-bit tags in that order."""
    part = (hashes % np.uint64(parts)).astype(np.int64)
    tag = (hashes // np.uint64(parts)) & TAG
    order = np.lexsort((tag, part))
    return order, np.searchsorted(part[order], np.arange(parts + 1)), tag[order]


def _pack40(tags: np.ndarray) -> bytes:
    return tags.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def count_blocks(docs: DataFrame, parts: int, chunk_bytes: int) -> DataFrame:
    """``chunk, part, tags, counts`` of ``_id, _bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in _chunks(batches, chunk_bytes):
            chunk = Chunk(texts)
            hashes, counts = chunk.grams()
            order, bounds, tags = _deal(hashes, parts)
            counts = counts[order].astype("<u4")
            rows = [
                (name, p, _pack40(tags[a:b]), counts[a:b].tobytes())
                for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a
            ]
            rows.append((name, ALL_WORDS, bytes(5), np.array([chunk.sizes.sum()], "<f8").tobytes()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.binary()))],
                names=["chunk", "part", "tags", "counts"],
            )

    return docs.mapInArrow(run, "chunk string, part int, tags binary, counts binary")


def add_up(blocks: DataFrame) -> DataFrame:
    """``chunk, part, totals``: for every block the sums over all blocks of its partition, in its order."""

    def run(key, table):
        if key[0].as_py() == ALL_WORDS:
            total = sum(np.frombuffer(v.as_py(), "<f8")[0] for v in table.column("counts"))
            answers = [np.array([total], dtype="<f8").tobytes()] * table.num_rows
            return pa.table({"chunk": table.column("chunk"), "part": table.column("part"),
                             "totals": pa.array(answers, pa.binary())})
        tags = [_unpack40(v.as_py()) for v in table.column("tags")]
        counts = [np.frombuffer(v.as_py(), "<u4") for v in table.column("counts")]
        distinct, at = np.unique(np.concatenate(tags), return_inverse=True)
        totals = np.bincount(at, np.concatenate(counts), len(distinct)).astype("<u4")[at]
        ends = np.cumsum([len(t) for t in tags])
        answers = [totals[b - len(t): b].tobytes() for t, b in zip(tags, ends)]
        return pa.table({
            "chunk": table.column("chunk"), "part": table.column("part"), "totals": pa.array(answers, pa.binary()),
        })

    return blocks.groupBy("part").applyInArrow(run, "chunk string, part int, totals binary")


def texts_by_chunk(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """``chunk, doc, bytes, at``: the rows with the name of their chunk and their place in it."""
    kind = dict(docs.dtypes)["_id"]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list = []

        def watched():
            for batch in batches:
                types[:] = batch.schema.types
                yield batch

        for name, ids, texts in _chunks(watched(), chunk_bytes):
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * len(ids)), pa.array(ids, type=types[0]), pa.array(texts, pa.binary()),
                pa.array(range(len(ids)), pa.int32()),
            ], names=["chunk", "doc", "bytes", "at"])

    return docs.mapInArrow(named, f"chunk string, doc {kind}, bytes binary, at int")


def backoff_scores(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    backoff: float = BACKOFF,
    chunk_bytes: int = CHUNK_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``doc_id, n_words, log_score, score``: the sum of log scores, and its mean per word."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("_id"), utf8(text).alias("_bytes"))
    size = rows.agg(F.sum(F.octet_length("_bytes"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    blocks = count_blocks(rows, parts, chunk_bytes)
    answers = add_up(blocks)

    answered = {"chunk", "part", "totals"}

    def score(left, right):
        if not left.num_rows or not right.num_rows or set(right.column_names) != answered:
            raise RuntimeError("a chunk was read in another order the second time")
        left, right = left.sort_by("at"), right.sort_by("part")
        chunk = Chunk([v.as_py() for v in left.column("bytes")])
        parcels = [v.as_py() for v in right.column("totals")]
        corpus = int(np.frombuffer(parcels[0], "<f8")[0])
        got = np.frombuffer(b"".join(parcels[1:]), "<u4").astype(np.int64)
        hashes, _ = chunk.grams()
        order, _, _ = _deal(hashes, parts)
        totals = np.zeros(len(order), dtype=np.int64)
        totals[order] = got
        log = chunk.score(totals, corpus, backoff)
        has = chunk.sizes > 0
        return pa.table({
            id_col: left.column("doc"), "n_words": pa.array(chunk.sizes),
            "log_score": pa.array(log, pa.float64(), mask=~has),
            "score": pa.array(log / np.maximum(chunk.sizes, 1), pa.float64(), mask=~has),
        })

    texts = texts_by_chunk(rows, chunk_bytes)
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"`{id_col}` {kind}, n_words long, log_score double, score double"
    )
