r"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

Base spans follow fixed patterns per kind and always stay. The field looks at runs of neighbouring
chunks (words between white space that hold a digit or an @): a candidate is a segment of up to
``MAX_CHUNKS`` chunks without the punctuation around it, its features are those of the whole
span (shape, digits, separators, checksum), and the best set of segments and kinds for a run is found
by dynamic programming over segment ends. Weights are fitted by likelihood, with forward and backward
sums over all segmentations, on a bounded sample of runs of the corpus: base spans are the truth, and
rewritten ones (other separators, no plus) teach what the patterns miss.

Defined cases: a null or empty text has no span; runs and texts of any length are read whole; repeated
rows give equal spans; without any run to learn from nothing is added. Other columns are kept.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

KINDS = ["email", "ip", "card", "phone"]
MAX_CHUNKS = 6
MAX_CHARS = 256
#: Runs that the fit sees at most, per kind of span and for those without one.
SAMPLE = 300
EPOCHS = 6
RATE = 0.2
DECAY = 1e-4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Chunks with a digit or an @; the look behind keeps the scan linear.
ACTIVE = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
OPENING = "\"'<[{*#$%&|,;:!?=~`"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; failing matches are dropped."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        # Long runs of digits are beyond 255 unless they lead with zeros.
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for kind, pattern, low, high in (("card", CARD, 16, 19), ("phone", PHONE, 8, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind != "card" or luhn(digits)):
                out.append((kind, m.start(), m.end()))
    return out


def runs_of(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring active chunks; chunks longer than any entity break a run."""
    runs: list[list[tuple[int, int]]] = []
    end = -9
    for m in ACTIVE.finditer(text):
        if m.end() - m.start() > MAX_CHARS:
            end = -9
            continue
        if m.start() - end <= 2 and text[end: m.start()].isspace():
            runs[-1].append(m.span())
        else:
            runs.append([m.span()])
        end = m.end()
    return runs


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in OPENING:
        start += 1
    while start < end and not text[end - 1].isalnum():
        end -= 1
    return start, end


def shape(s: str) -> str:
    out = re.sub(r"[^\W\d_]+", "a", s)
    return re.sub("[0-9]+", lambda m: "d" + str(min(len(m[0]), 5)), out)[:40]


def span_features(s: str) -> list[str]:
    digits = re.sub("[^0-9]", "", s)
    letters = any(c.isalpha() for c in s)
    n = len(digits)
    bucket = n if n < 8 else 8 if n < 10 else 10 if n < 12 else 12 if n < 16 else n if n < 20 else 20
    marks = "".join(sorted({c for c in s if not c.isalnum()}))[:12]
    return [
        "bias", f"shape {shape(s)}", f"digits {bucket} {letters}", f"marks {marks}", f"@ {s.count('@')}",
        f"luhn {n if 13 <= n <= 19 else 0} {13 <= n <= 19 and luhn(digits)}", f"plus {s[:1] == '+'}",
        f"octets {s.count('.') == 3 and not letters and all(p and len(p) < 4 and int(p) < 256 for p in s.split('.') if p.isascii() and p.isdigit()) and len(re.findall('[0-9]+', s)) == 4}",
        f"groups {'-'.join(str(len(g)) for g in re.findall('[0-9]+', s)[:7])} {letters}",
    ]


class SpanField:
    """Weights per (feature, kind); everything outside a segment scores 0."""

    def __init__(self, weights: dict[str, list[float]] | None = None):
        self.weights = weights or {}

    def segments(self, text: str, run: list[tuple[int, int]]):
        """(first chunk, last chunk + 1, start, end, features) of all candidates."""
        for i in range(len(run)):
            for j in range(i + 1, min(i + MAX_CHUNKS, len(run)) + 1):
                if run[j - 1][1] - run[i][0] > MAX_CHARS:
                    break
                start, end = trimmed(text, run[i][0], run[j - 1][1])
                # Trimming must not empty the chunks at the ends.
                if start < run[i][1] and end > run[j - 1][0] and end > start:
                    yield i, j, start, end, span_features(text[start:end])

    def scores(self, features: list[str]) -> list[float]:
        total = [0.0] * len(KINDS)
        for f in features:
            w = self.weights.get(f)
            if w:
                for k, x in enumerate(w):
                    total[k] += x
        return total

    def decode(self, text: str, run: list[tuple[int, int]]) -> list[Span]:
        by_end = defaultdict(list)
        for i, j, start, end, f in self.segments(text, run):
            s = self.scores(f)
            k = max(range(len(KINDS)), key=lambda k: (s[k], -k))
            if s[k] > 0:
                by_end[j].append((i, s[k], (KINDS[k], start, end)))
        best: list[tuple[float, int, Span | None]] = [(0.0, 0, None)]
        for j in range(1, len(run) + 1):
            now = (best[j - 1][0], j - 1, None)
            for i, s, span in by_end[j]:
                if best[i][0] + s > now[0]:
                    now = (best[i][0] + s, i, span)
            best.append(now)
        out, j = [], len(run)
        while j:
            _, i, span = best[j]
            if span:
                out.append(span)
            j = i
        return out[::-1]

    def learn(self, examples: list[tuple[str, list[Span]]], epochs: int = EPOCHS, rate: float = RATE) -> None:
        """Stochastic gradient steps on the log likelihood of the true segmentations."""
        lattice = []
        for text, gold in examples:
            truth = {(a, b): KINDS.index(k) for k, a, b in gold}
            for run in runs_of(text):
                segs = list(self.segments(text, run))
                lattice.append((len(run), segs, [truth.get((s[2], s[3])) for s in segs]))
        for _ in range(epochs):
            for n, segs, truth in lattice:
                scores = [self.scores(s[4]) for s in segs]
                mass = [sum(math.exp(min(x, 50)) for x in s) for s in scores]
                forward, backward = [1.0] + [0.0] * n, [0.0] * n + [1.0]
                by_end, by_start = defaultdict(list), defaultdict(list)
                for at, s in enumerate(segs):
                    by_end[s[1]].append(at)
                    by_start[s[0]].append(at)
                for j in range(1, n + 1):
                    forward[j] = forward[j - 1] + sum(forward[segs[a][0]] * mass[a] for a in by_end[j])
                for i in range(n - 1, -1, -1):
                    backward[i] = backward[i + 1] + sum(mass[a] * backward[segs[a][1]] for a in by_start[i])
                for at, (i, j, _, _, f) in enumerate(segs):
                    outside = forward[i] * backward[j] / forward[n]
                    for k in range(len(KINDS)):
                        p = outside * math.exp(min(scores[at][k], 50))
                        step = rate * ((truth[at] == k) - p)
                        if abs(step) > 1e-4:
                            for name in f:
                                w = self.weights.setdefault(name, [0.0] * len(KINDS))
                                w[k] += step - rate * DECAY * w[k]


def rewritten(text: str, gold: list[Span]) -> list[tuple[str, list[Span]]]:
    """Examples with a span written in another way, of the same kind."""
    out = []
    for kind, a, b in gold:
        s = text[a:b]
        digits = re.sub("[^0-9]", "", s)
        forms = []
        if kind == "phone" and len(digits) >= 10:
            x, y, z = digits[-10:-7], digits[-7:-4], digits[-4:]
            forms = [f"({x}) {y}-{z}", f"{x}-{y}-{z}", f"{x}.{y}.{z}"]
        elif kind == "card" and len(digits) == 16:
            forms = [sep.join(digits[i: i + 4] for i in range(0, 16, 4)) for sep in ("-", ".")]
        elif kind == "email" and "." in s.split("@")[0]:
            forms = [s.upper()]
        for form in forms:
            start = a
            out.append((text[:a] + form + text[b:], [(kind, start, start + len(form))]))
    return out


def sample_runs(docs: DataFrame, text: str, sample: int) -> list[str]:
    """Texts of runs, at most ``sample`` per kind of their first base span and for none, by hash."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {}
            for v in batch.column(0):
                value = v.as_py()
                for run in runs_of(value) if value else ():
                    piece = value[run[0][0]: run[-1][1]]
                    if len(piece) <= 4 * MAX_CHARS:
                        gold = base_spans(piece)
                        out[piece] = gold[0][0] if gold else "none"
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.string())], ["run", "kind"]
            )

    runs = docs.select(F.col(text).cast("string")).mapInArrow(scan, "run string, kind string").distinct()
    w = Window.partitionBy("kind").orderBy(F.xxhash64("run"), "run")
    rows = runs.withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample).orderBy("kind", "r").collect()
    return [r["run"] for r in rows]


def train(docs: DataFrame, *, text: str = "text", sample: int = SAMPLE) -> SpanField:
    examples = []
    for run in sample_runs(docs, text, sample):
        gold = base_spans(run)
        examples.append((run, gold))
        examples.extend(rewritten(run, gold) if len(gold) == 1 else [])
    examples.sort(key=lambda e: hash_of(e[0]))
    field = SpanField()
    field.learn(examples)
    return field


def hash_of(s: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(s.encode())


def all_spans(text: str, field: SpanField) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans), each by kind and start."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for run in runs_of(text):
        for kind, a, b in field.decode(text, run):
            # The base spans around a place are found by bisection: tables of numbers hold many.
            at = bisect.bisect_left(taken, (b,))
            if not any(y > a for _, y in taken[max(0, at - len(KINDS) - 2): at]):
                added.append((kind, a, b))
    order = lambda s: (KINDS.index(s[0]), s[1], s[2])
    return sorted(base, key=order), sorted(base + added, key=order)


def find_pii(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", field: SpanField | None = None
) -> DataFrame:
    """``doc_id, base, spans``: arrays of kind, start, end (code points, end exclusive)."""
    kind = dict(docs.dtypes)[id_col]
    weights = (field or train(docs, text=text)).weights
    element = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = SpanField(weights)
        for batch in batches:
            both = [all_spans(v.as_py() or "", field) for v in batch.column(1)]
            arrays = [
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row[i]] for row in both], pa.list_(element))
                for i in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[id_col, "base", "spans"])

    spans = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(id_col, F.col(text).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, base {spans}, spans {spans}"
    )


def masked(text: str, spans: list[Span]) -> str:
    """The text with the spans replaced by their kind; overlapping ones as one, named by the first."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out.append(text[done:a] + f"[{kind.upper()}]")
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, *, text: str = "text", field: SpanField | None = None) -> DataFrame:
    """``docs`` with personal data masked in ``text``; all columns and rows stay, a null stays null."""
    weights = (field or train(docs, text=text)).weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = SpanField(weights)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = [
                value and masked(value, all_spans(value, field)[1]) for value in (v.as_py() for v in batch.column(at))
            ]
            columns = list(batch.columns)
            columns[at] = pa.array(out, type=batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
