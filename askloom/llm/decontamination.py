r"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. Every window of ``n``
consecutive words of a benchmark item goes into the set; an item with fewer words, but not none, is
one window. Documents are scanned once: their words become the numbers of benchmark words, windows
of known words only are looked up by hash, and a hit counts when the words are equal.

The set is broadcast in blocks of at most ``max_windows`` windows, whatever the size of the
benchmark: a larger one is scanned for block by block and the hits are merged per document.

Defined cases: null and empty texts have no words, no hit and count as clean; an item without
words has no window; repeated documents are judged each for itself and repeated items each
count; with an empty benchmark every document is clean. Extra columns are kept.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from askloom.llm.common import map_rows, mix64, staged, utf8

WINDOW = 10
#: Windows in one broadcast: at most about 100 MB in a Python worker.
MAX_WINDOWS = 200_000

_WORD_BYTES = [b for b in range(256) if b >= 0x80 or chr(b).isalnum()]
#: One byte to one byte, so that places in the normalised text are places in the text.
NORMAL = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b in set(_WORD_BYTES) else 32 for b in range(256)
)


def normal_words(data: bytes) -> list[bytes]:
    return data.translate(NORMAL).split()


def item_windows(benchmark: DataFrame, *, n: int, id_col: str, text: str) -> DataFrame:
    """``item, words`` (joined by blanks): the windows of every item, repeated ones once per item."""
    kind = dict(benchmark.dtypes)[id_col]

    def make():
        def run(item, data):
            words = normal_words(data)
            size = min(n, len(words))
            spans = (b" ".join(words[i: i + size]) for i in range(len(words) - size + 1))
            return item, list(dict.fromkeys(spans)) if words else []

        return run

    arrays = map_rows(
        benchmark.select(id_col, utf8(text).alias("_bytes")), make, f"item {kind}, words array<binary>"
    )
    return arrays.select("item", F.explode("words").alias("words"))


class WindowSet:
    """The windows of one block: word numbers, hashes by window length, and items per window."""

    def __init__(self, windows: list[tuple[object, bytes]]):
        self.ids: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list] = defaultdict(list)
        for item, joined in windows:
            seq = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in joined.split())
            self.items[seq].append(item)
        by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for seq in self.items:
            by_length[len(seq)].append(seq)
        self.filters = {}
        for length, seqs in sorted(by_length.items()):
            bits = max(16, (len(seqs) * 16).bit_length())
            table = np.zeros(1 << bits, dtype=bool)
            h = _window_hash(np.array(seqs, dtype=np.uint64).T)
            table[(h >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.filters[length] = (table, np.uint64(64 - bits))

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged spans of hit words (end exclusive) and the items that occur."""
        get = self.ids.get
        seq = np.fromiter((get(w, 0) for w in words), dtype=np.uint64, count=len(words))
        known = np.flatnonzero(seq)
        spans, items = [], set()
        if not len(known):
            return spans, items
        gaps = np.concatenate([[0], np.cumsum(seq == 0)])
        for length, (table, shift) in self.filters.items():
            if len(seq) < length:
                continue
            starts = known[known <= len(seq) - length]
            starts = starts[gaps[starts + length] == gaps[starts]]
            if not len(starts):
                continue
            h = _window_hash([seq[starts + i] for i in range(length)])
            for at in starts[table[(h >> shift).astype(np.int64)]].tolist():
                found = self.items.get(tuple(seq[at: at + length].tolist()))
                if found:
                    items.update(found)
                    spans.append((at, at + length))
        return merge_spans(spans), items


def _window_hash(columns) -> np.ndarray:
    h = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + c)
    return h


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _blocks(windows: DataFrame, max_windows: int) -> Iterator[WindowSet]:
    """The set in pieces the driver can hold, one at a time."""
    n = windows.count()
    if n == 0:
        return
    blocks = -(-n // max_windows)
    if blocks > 1:
        # A few spare blocks, as hashes do not fill them evenly.
        blocks += 1 + blocks // 8
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b)
        rows = [(r["item"], bytes(r["words"])) for r in part.collect()]
        if rows:
            yield WindowSet(rows)


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    n: int = WINDOW,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``items`` (sorted as strings), ``spans`` of words."""
    spark = docs.sparkSession
    windows = staged(item_windows(benchmark, n=n, id_col=item_col, text=item_text), "windows")
    kind = dict(docs.dtypes)[id_col]
    schema = (
        f"`{id_col}` {kind}, _row long, n_words long, items array<string>, "
        "spans array<struct<start:long,end:long>>"
    )
    # Repeated ids stay apart: a row is its place in the table.
    source = docs.select(id_col, F.monotonically_increasing_id().alias("_row"), utf8(text).alias("_bytes"))

    def scan(block: WindowSet | None) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def make():
            index = shared.value

            def run(doc, row, data):
                words = normal_words(data)
                spans, items = index.find(words) if index else ([], ())
                found = sorted(map(str, items))
                return doc, row, len(words), found, [{"start": a, "end": b} for a, b in spans]

            return run

        return map_rows(source, make, schema)

    parts = [scan(block) for block in _blocks(windows, max_windows)] or [scan(None)]
    if len(parts) == 1:
        merged = parts[0]
    else:
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part)
        # One row per block for each document.
        together = union.groupBy(id_col, "_row", "n_words").agg(
            F.flatten(F.collect_list("items")).alias("items"),
            F.flatten(F.collect_list("spans")).alias("spans"),
        )

        def merge():
            return lambda doc, row, words, items, spans: (
                doc, row, words, sorted(set(items)),
                [{"start": a, "end": b} for a, b in merge_spans((s["start"], s["end"]) for s in spans)],
            )

        merged = map_rows(together.select(id_col, "_row", "n_words", "items", "spans"), merge, schema)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])
    return merged.select(id_col, "n_words", hit.alias("n_hit"), "items", "spans")


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    n: int = WINDOW,
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    drop_share: float = 0.5,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    A document of whose words at least ``drop_share`` are hit goes; from others the hit spans are
    cut, with the white space and punctuation inside them. A null text stays null.
    """
    spark = docs.sparkSession
    windows = staged(item_windows(benchmark, n=n, id_col=item_col, text=item_text), "windows")
    schema = docs.schema
    if windows.count() <= max_windows:
        block = next(_blocks(windows, max_windows), None)
        if block is None:
            return docs
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                yield _cut_batch(batch, text, drop_share, lambda i, words: index.find(words)[0])

        return docs.mapInArrow(scan, schema)

    # Several blocks: all spans of a text are known before it is cut.
    row, found = _new_names(docs, "_row", "_spans")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    spans = find_overlaps(
        numbered.select(F.col(row).alias("_id"), F.col(text).alias("_text")), windows,
        n=n, id_col="_id", text="_text", item_col="item", item_text="words", max_windows=max_windows,
    ).where("n_hit > 0").select(F.col("_id").alias(row), F.col("spans").alias(found))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(batch.num_columns - 1).to_pylist()
            yield _cut_batch(
                batch.select(batch.schema.names[:-1]), text, drop_share,
                lambda i, words: [(s["start"], s["end"]) for s in known[i] or ()],
            )

    return numbered.join(spans, row, "left").drop(row).select(*docs.columns, found).mapInArrow(cut, schema)


def _new_names(df: DataFrame, *names: str) -> list[str]:
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def _cut_batch(batch: pa.RecordBatch, text: str, drop_share: float, spans_of) -> pa.RecordBatch:
    at = batch.schema.get_field_index(text)
    texts, stays = [], []
    for i, value in enumerate(batch.column(at).to_pylist()):
        data = (value or "").encode()
        words = normal_words(data)
        spans = spans_of(i, words)
        hit = sum(b - a for a, b in spans)
        stays.append(not hit or hit < drop_share * len(words))
        texts.append(cut_words(data, spans).decode() if hit and stays[-1] else value)
    columns = list(batch.columns)
    columns[at] = pa.array(texts, type=batch.schema.field(at).type)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(stays))


def cut_words(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of ``spans`` and what stands between them."""
    plain = data.translate(NORMAL)
    places, i, size = [], 0, len(plain)
    while i < size:
        if plain[i] == 32:
            i += 1
            continue
        end = plain.find(b" ", i)
        end = size if end < 0 else end
        places.append((i, end))
        i = end
    out, done = [], 0
    for a, b in spans:
        out.append(data[done: places[a][0]])
        done = places[b - 1][1]
    out.append(data[done:])
    return b"".join(out)
