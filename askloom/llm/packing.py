"""Packing along a space-filling curve.

Each document becomes a hashed vector of its words, projected to three dimensions and quantised;
the Hilbert key of that cell orders the documents, so neighbours in a sequence are alike. The order is
cut into sequences of ``length`` tokens: a document that does not fit goes on in the next one, and
only the very last sequence needs padding.

Texts are tokenized once; the ids are written as two-byte numbers (four for larger vocabularies). Only
keys and lengths go through the range sort by (key, id), so copies spread over partitions; a partition adds
the tokens of those before it. What is shared is one count per partition. The ids are then shuffled once, to
the places of their documents, by row number and without a sort.

Texts are cut into the pre-tokenizer's pieces in Arrow; each distinct piece of some texts is tokenized by
itself and remembered, which gives the ids of the whole text; the tests compare the two.

Defined cases: a null or empty text is the end token alone; a text of any length runs over as many
sequences as it needs; repeated rows are packed each for itself; an empty table gives no piece.
Extra columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from askloom.llm.common import staged
from askloom.llm.hilbert import hilbert_keys

LENGTH = 4096
END_ID = 2
DIMS = 3
BITS = 10
#: Pieces remembered by a worker at most, and characters of such a piece.
CACHE = 600_000
CACHE_CHARS = 40
#: Bytes and number of texts that are cut into pieces at once, unless one alone is longer.
AT_ONCE = 4_000_000
ROWS_AT_ONCE = 1000

#: What the direct way may hold: printable ASCII, line ends, and the letters of Latin-1 that
#: neither normalisation nor lower-casing changes beyond one letter for one.
PLAIN = re.compile("[\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
#: The pre-tokenizer's pieces within such texts, lower-cased, that are no runs of letters.
NO_WORDS = "('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+)"


class TextTokenizer:
    """Token ids of texts as packed bytes. Pieces are tokenized once and remembered.

    Texts beyond ``PLAIN``, or with the strings of special tokens, go through the tokenizer whole.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.split = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = {2: "H", 4: "I"}[self.type.itemsize]
        # How the tokenizer writes the bytes of letters beyond ASCII.
        self.letters: dict[int, str] = {}
        # When half full, only what is asked for again is kept.
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.half = max(1, cache // 2)

    def _packed(self, ids) -> bytes:
        return np.array(ids, dtype=self.type).tobytes()

    def _piece(self, piece: str) -> bytes:
        for c in piece if not piece.isascii() else ():
            if ord(c) not in self.letters:
                self.letters[ord(c)] = self.split.pre_tokenize_str(c)[0][0]
        ids = [t.id for t in self.model.tokenize(piece.translate(self.letters))] if piece else []
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _looked_up(self, pieces: list[str]) -> list[bytes]:
        new, old, found = self.pieces, self.older, []
        for piece in pieces:
            got = new.get(piece)
            if got is None:
                got = old.get(piece)
                if got is None:
                    got = self._piece(piece)
                if len(piece) <= CACHE_CHARS:
                    new[piece] = got
            found.append(got)
        if len(new) >= self.half:
            self.older, self.pieces = new, {}
        return found

    def _is_plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _direct(self, texts: list[str]) -> list[bytes]:
        """The ids of plain texts: each distinct piece is looked up once, then numbers are gathered."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(pa.array(texts, pa.large_string())), NO_WORDS, r" \1 ")
        pieces = pc.ascii_split_whitespace(spaced)
        coded = pieces.values.dictionary_encode()
        found = self._looked_up(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(found), self.type)
        sizes = np.array([len(f) for f in found], dtype=np.int64) // self.type.itemsize
        starts = np.cumsum(sizes) - sizes
        place = coded.indices.to_numpy()
        lengths = sizes[place]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.repeat(starts[place] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
        at = (ends[pieces.offsets.to_numpy()] * self.type.itemsize).tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, some texts at a time."""
        held, size = [], 0
        for text in texts:
            if held and (size + len(text) > AT_ONCE or len(held) >= ROWS_AT_ONCE):
                yield from self._some(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        yield from self._some(held)

    def _some(self, texts: list[str]) -> Iterator[bytes]:
        plain = [self._is_plain(t) for t in texts]
        direct = iter(self._direct([t for t, p in zip(texts, plain) if p]))
        for text, p in zip(texts, plain):
            yield next(direct) if p else self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


_TOKENIZERS: dict[str, TextTokenizer] = {}


def tokenizer(path: str) -> TextTokenizer:
    """One per worker process, so that its pieces outlive a task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = TextTokenizer(path)
    return _TOKENIZERS[path]


def word_vector(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean of a fixed random direction per token: the projection of the hashed bag of tokens."""
    if not len(ids):
        return np.zeros(table.shape[1])
    counts = np.bincount(ids % len(table), minlength=len(table))
    v = np.sqrt(counts, dtype=np.float64)
    return (v @ table) / np.linalg.norm(v)


def directions(buckets: int = 1 << 12, dims: int = DIMS) -> np.ndarray:
    """Random signs by hash: the same in every task."""
    h = [xxhash.xxh3_64_intdigest(i.to_bytes(8, "little")) for i in range(buckets)]
    return np.array([[1.0 if x >> d & 1 else -1.0 for d in range(dims)] for x in h])


def tokenized(
    docs: DataFrame, tokenizer_path: str, *, end_id: int = END_ID, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, key, doc_tokens, ids``: tokens with the end id, and the place on the curve."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(tokenizer_path)
        end = np.array([end_id], dtype=t.type).tobytes()
        table = directions()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                ids, points = [], []
                for packed in t.encode_all(v.as_py() or "" for v in part.column(1)):
                    packed += end
                    ids.append(packed)
                    points.append(word_vector(np.frombuffer(packed, t.type), table))
                # Directions of unit vectors in 4096 buckets: sums lie near 0, with deviation 1.
                cells = np.clip((np.array(points) + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                keys = hilbert_keys(cells, BITS)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(keys, pa.int64()),
                    pa.array([len(p) // t.type.itemsize for p in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ], names=[id_col, "key", "doc_tokens", "ids"])

    return docs.select(id_col, text).mapInArrow(
        run, f"`{id_col}` {kind}, key long, doc_tokens long, ids binary"
    )


def along_curve(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``_row, _part, _inside`` of the rows in the order of (key, id): their partition and the tokens before them in it.

    Written once: partitions and running sums have to agree. One pass over a sorted partition adds up.
    """
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = np.asarray(batch.column(1), dtype=np.int64)
            ends = total + np.cumsum(n)
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(n), part), pa.int64()), pa.array(ends - n)],
                names=[*batch.schema.names, "_part", "_inside"],
            )

    order = ["key", id_col, "_row"]
    ordered = rows.select(*order, "doc_tokens").repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(
        ordered.select("_row", "doc_tokens").mapInArrow(add_up, "_row long, doc_tokens long, _part long, _inside long"),
        "packing",
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    length: int = LENGTH,
    end_id: int = END_ID,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, key``.

    With ``with_ids`` also the piece's ``ids``; they and the checksum are of little-endian unsigned
    32-bit numbers.
    """
    kind = dict(docs.dtypes)[id_col]
    wide = tokenized(docs, tokenizer_path, end_id=end_id, id_col=id_col, text=text)
    # Tokens are made once, here; a row number finds them again, as ids may repeat.
    tokens = staged(wide.withColumn("_row", F.monotonically_increasing_id()), "tokens")
    places = along_curve(tokens, id_col)
    # One number per partition of the sort.
    sizes = places.groupBy("_part").agg(F.sum("doc_tokens").alias("n")).collect()
    before, total = {}, 0
    for part, n in sorted(map(tuple, sizes)):
        before[part], total = total, total + n
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "key"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_of = tokenizer(tokenizer_path).type
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for doc, n, key, ids, section, inside in zip(*((v.as_py() for v in c) for c in part.columns)):
                    data = memoryview(np.frombuffer(ids, kind_of).astype("<u4").tobytes())
                    place, start = before[section] + inside, 0
                    while start < n:
                        sequence, offset = divmod(place + start, length)
                        size = min(n - start, length - offset)
                        piece = data[4 * start: 4 * (start + size)]
                        row = (doc, start, size, zlib.crc32(piece), n, sequence, offset, key)
                        rows.append((*row, bytes(piece)) if with_ids else row)
                        start += size
                types = [part.schema.field(0).type, *[pa.int64()] * 7, *[pa.binary()] * with_ids]
                columns = list(zip(*rows)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(columns, types)],
                    names=[*names, *["ids"] * with_ids],
                )

    fields = [f"`{id_col}` {kind}", *(f"`{c}` long" for c in names[1:]), *["ids binary"] * with_ids]
    # The narrow places are hashed, so that ids need no sort.
    placed = tokens.join(places.drop("doc_tokens").hint("shuffle_hash"), "_row")
    return placed.select(id_col, "doc_tokens", "key", "ids", "_part", "_inside").mapInArrow(
        cut, ", ".join(fields)
    )
