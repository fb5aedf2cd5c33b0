"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard verification.

Signatures. A shingle's hash is a place in a universe of 2**20 places. Permutation sigma moves the
places, permutation pi orders them; coordinate k is the smallest value of pi shifted by k (Li and Li,
C-MinHash). With pi stored once, the K coordinates of a shingle are K neighbouring entries, so a
signature is a minimum over slices.

Candidates. ``BANDS`` bands of ``ROWS`` coordinates; two texts at the threshold of 0.8 share none with
probability 5e-8. Equal shingle sets are one class from the start and only its smallest id goes on.
A bucket of up to ``SMALL`` members gives all its pairs, at most 15 per member. A larger one is
compared with five of its members: the most central (whose buckets are the fullest) and one by hash.
The members of the large buckets that this leaves in different components are
compared completely, by a prefix filter on their whole shingle sets: with the shingles in one order
for all, rarest first, two sets at the threshold share one among the first fifth of the larger and the
first ninth of the smaller. Shingles whose owners are connected are passed over; the owners outside a
shingle's main component are joined with all its owners, in blocks of ``BLOCK``; a pair is looked at
with its first common shingle only. One whose places rule the threshold out is dropped there, and one whose
``SKETCH_BITS`` one-bit coordinates differ too often: five deviations above what two texts at the threshold do. So a group of copies costs a few
comparisons per member, a passage that many texts share is no reason to compare them, and of texts that are
almost near enough to a group no pairs are written.

Links. Candidates whose signatures agree in less than 0.64 of the coordinates (over four deviations
below the threshold) are dropped; for the rest the whole shingle sets are compared. At first each text
is compared with the candidate most like it; what that leaves in different components is compared
next, so the pairs inside a group of near copies cost no comparison.

Defined cases: a null, empty or blank text has no shingles, is linked with nothing and kept; texts
shorter than a shingle are one shingle; repeated rows are exact copies of each other and share one
class (two rows with one id both say kept); a null id is linked with nothing and kept; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from askloom.llm.common import map_rows, shingle_set, staged, utf8
from askloom.llm.components import connected_components

COORDINATES = 128
ROWS = 4
BANDS = COORDINATES // ROWS
PLACES_BITS = 20
SMALL = 16
HUBS = 4
#: Counters of shingles; two that share one only disturb the order, which is the same for all sets.
COUNTER_BITS = 18
#: So many owners of a shingle are met with the outsiders in one place.
BLOCK = 2048
#: Least share of equal coordinates of a candidate.
ESTIMATE = 0.64
#: One bit of each of so many coordinates stands for a text in the complete comparison; a multiple of 64.
SKETCH_BITS = 2048
#: So many deviations more than two texts at the threshold may sketches differ.
DEVIATIONS = 5
SEED = 20240229


@lru_cache
def permutations(coordinates: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """sigma, and every circular shift of pi as the rows of a sliding window."""
    draw = np.random.RandomState(SEED)
    sigma = draw.permutation(1 << PLACES_BITS).astype(np.int32)
    pi = draw.permutation(1 << PLACES_BITS).astype(np.int32)
    circle = np.concatenate([pi, pi[: coordinates - 1]])
    return sigma, np.lib.stride_tricks.sliding_window_view(circle, coordinates)


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    sigma, shifted = permutations(coordinates)
    places = sigma[(shingles >> np.uint64(64 - PLACES_BITS)).astype(np.int64)]
    best = np.full(coordinates, 1 << PLACES_BITS, dtype=np.int32)
    step = 2048 * COORDINATES // coordinates
    for at in range(0, len(places), step):
        np.minimum(best, shifted[places[at: at + step]].min(axis=0), out=best)
    return best


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The lowest bit of ``SKETCH_BITS`` coordinates, 64 to a number; two differ in half of ``1 - Jaccard`` of the bits."""
    return np.packbits((signature(shingles, SKETCH_BITS) & 1).astype(bool)).view(np.int64)


def _most_differing(percent: int) -> int:
    """Bits in which the sketches of two texts at the threshold may differ."""
    share = (1 - percent / 100) / 2
    return int(SKETCH_BITS * share + DEVIATIONS * (SKETCH_BITS * share * (1 - share)) ** 0.5)


def _differing(a: str, b: str) -> Column:
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def _fingerprint(n: int):
    def run(doc, data):
        s = shingle_set(data, n)
        if not len(s):
            return doc, 0, 0, 0, [], b""
        digest = xxhash.xxh3_128_digest(s.tobytes())
        d1, d2 = np.frombuffer(digest, dtype=np.int64).tolist()
        sig = signature(s)
        bands = [
            xxhash.xxh3_64_intdigest(sig[i: i + ROWS].tobytes(), seed=i) - (1 << 63)
            for i in range(0, COORDINATES, ROWS)
        ]
        return doc, len(s), d1, d2, bands, sig.astype(np.uint8).tobytes()

    return run


def fingerprints(docs: DataFrame, *, words: int, id_col: str, text: str) -> DataFrame:
    """``id, n, d1, d2`` (digest of the set), ``bands``, ``sig`` (a byte per coordinate)."""
    kind = dict(docs.dtypes)[id_col]
    return map_rows(
        docs.select(id_col, utf8(text).alias("_bytes")), lambda: _fingerprint(words),
        f"id {kind}, n int, d1 long, d2 long, bands array<long>, sig binary",
    )


def _alike(batches):
    """``a, b, agree`` of the pairs whose signatures (columns 2 and 3) agree well enough."""
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES) for c in batch.columns[2:]
        )
        agree = (left == right).sum(axis=1)
        at = pa.array(np.flatnonzero(agree >= ESTIMATE * COORDINATES))
        pairs = [c.take(at) for c in batch.columns[:2]]
        yield pa.RecordBatch.from_arrays([*pairs, pa.array(agree, pa.int32()).take(at)], names=["a", "b", "agree"])


def _linked(percent: int):
    """``a, b`` of the pairs whose shingle sets (columns 2 and 3) reach the threshold."""

    def reaches(x, y) -> bool:
        x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= percent * (len(x) + len(y) - common)

    def run(batches):
        for batch in batches:
            at = pa.array([i for i, (x, y) in enumerate(zip(*batch.columns[2:])) if reaches(x, y)], pa.int64())
            yield pa.RecordBatch.from_arrays([c.take(at) for c in batch.columns[:2]], names=["a", "b"])

    return run


def _needed(n: int, percent: int) -> int:
    """Common shingles that a set of ``n`` needs with any set."""
    return -(-percent * n // 100)


def _needed_as_smaller(n: int, percent: int) -> int:
    """Common shingles that a set of ``n`` needs with one at least as large."""
    return -(-2 * percent * n // (100 + percent))


def _counts(batches):
    """``slot, c``: how many sets of a task hold a shingle that falls on the counter."""
    total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    for batch in batches:
        for v in batch.column("shingles"):
            slots = np.frombuffer(v.as_py(), dtype=np.uint64) >> np.uint64(64 - COUNTER_BITS)
            total += np.bincount(slots.astype(np.int64), minlength=len(total))
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], names=["slot", "c"])


def _prefix(counts, percent: int):
    def make():
        total = counts.value

        def run(doc, data):
            s = np.frombuffer(data, dtype=np.uint64)
            often = total[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
            first = s[np.lexsort((s, often))][: len(s) - _needed(len(s), percent) + 1]
            core = len(s) - _needed_as_smaller(len(s), percent) + 1
            return doc, len(s), core, first.view(np.int64).tolist(), sketch(s).tolist()

        return run

    return make


def _sized(small: Column, large: Column, percent: int) -> Column:
    """Sets so different in size cannot reach the threshold."""
    return 100 * F.least(small, large) >= percent * F.greatest(small, large)


class _Linker:
    """Components found so far, and the tables that candidates are looked up in."""

    def __init__(self, nodes: DataFrame, percent: int):
        self.nodes, self.percent = nodes, percent
        self.sets = self.tested = self.labels = None

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs ``a, b`` (a < b) not seen before whose signatures agree well enough, with ``agree``."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        sig = self.nodes.select("id", "sig")
        kind = dict(sig.dtypes)["id"]
        found = staged(
            pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(_alike, f"a {kind}, b {kind}, agree int"),
            "candidates",
        )
        seen = found.select("a", "b")
        self.tested = seen if self.tested is None else staged(self.tested.unionByName(seen), "tested")
        return found

    def verify(self, likely: DataFrame) -> None:
        """Compare the pairs; at first each text with its best candidate, which settles most others."""
        best = likely.groupBy("b").agg(F.max(F.struct("agree", "a")).alias("best"))
        best = staged(best.select(F.col("best.a").alias("a"), "b"), "best")
        self.compare(best)
        side = lambda c: self.labels.select(
            F.col("node").alias(c), F.col("component").alias(f"in_{c}")
        )
        rest = (
            likely.select("a", "b").join(best, ["a", "b"], "left_anti")
            .join(side("a"), "a", "left").join(side("b"), "b", "left")
            .where(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).select("a", "b")
        )
        self.compare(staged(rest, "rest"))

    def compare(self, pairs: DataFrame) -> None:
        """Compare whole shingle sets; links join the components."""
        if self.labels is not None and pairs.isEmpty():
            return
        # Only the sets of these pairs are dealt out, both ends of a pair to one place.
        ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("id")).join(self.sets, "id")
        both = ends.groupBy("a", "b").agg(
            F.min(F.struct("id", "shingles")).alias("x"), F.max(F.struct("id", "shingles")).alias("y")
        )
        kind = dict(self.nodes.dtypes)["id"]
        found = staged(
            both.select("a", "b", "x.shingles", F.col("y.shingles").alias("others"))
            .mapInArrow(_linked(self.percent), f"a {kind}, b {kind}"),
            "links",
        )
        if self.labels is None:
            self.labels = connected_components(found)
        elif not found.isEmpty():
            known = self.labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            self.labels = connected_components(known.unionByName(found))

    def labelled(self, members: DataFrame) -> DataFrame:
        """``members`` with the present component of each."""
        return members.drop("component").join(
            self.labels.withColumnRenamed("node", "id"), "id", "left"
        ).withColumn("component", F.coalesce("component", "id"))

    def pairs_of_small(self, members: DataFrame) -> DataFrame:
        """All pairs of buckets with at most SMALL members, but for those connected already."""
        lists = members.groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("id", "n", "component"))).alias("m")
        )
        at = F.posexplode("m").alias("i", "x")
        later = lists.select("m", at).select("x", F.explode(F.slice("m", F.col("i") + 2, SMALL)).alias("y"))
        return later.where(
            _sized(F.col("x.n"), F.col("y.n"), self.percent) & (F.col("x.id") < F.col("y.id"))
            & (F.col("x.component") != F.col("y.component"))
        ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))

    def pairs_with_hubs(self, members: DataFrame) -> DataFrame:
        """Every member of a large bucket with the HUBS most central and one other of the bucket."""
        score = members.groupBy("id").agg(F.sum("c").alias("score"))
        scored = members.join(score, "id")
        near = Window.partitionBy("key").orderBy(F.desc("score"), F.xxhash64("id"))
        # One order for all buckets: those of one group mostly pick the same member.
        far = Window.partitionBy("key").orderBy(F.xxhash64("id", F.lit(0)))
        who = F.struct("id", "n", "component").alias("h")
        pick = lambda w, k: scored.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
        hubs = pick(near, HUBS).select("key", who).unionByName(pick(far, 1).select("key", who)).distinct()
        # The buckets of one group mostly name the same hubs: a member meets each of them once, not in every bucket.
        named = hubs.groupBy("key").agg(F.sort_array(F.collect_list("h")).alias("hubs"))
        met = members.join(named, "key").groupBy("id", "n", "component").agg(
            F.array_distinct(F.flatten(F.collect_set("hubs"))).alias("hubs")
        )
        wanted = F.filter(
            "hubs", lambda h: (F.col("component") != h["component"]) & _sized(F.col("n"), h["n"], self.percent)
        )
        return met.select("id", F.explode(wanted).alias("h")).select(
            F.least("id", "h.id").alias("a"), F.greatest("id", "h.id").alias("b")
        )

    def link(self, members: DataFrame, texts: Callable[[DataFrame], DataFrame]) -> None:
        """Verify the candidates of all buckets; ``members`` has ``id, n, component, key``.

        ``texts`` makes the shingle sets of ids: of candidates and of everything in a large bucket.
        """
        counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        shared = staged(members.join(counts, "key"), "buckets")
        small = shared.where(F.col("c") <= SMALL)
        large = shared.where(F.col("c") > SMALL)
        likely = self.likely(self.pairs_of_small(small).unionByName(self.pairs_with_hubs(large)).distinct())
        ids = likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id")))
        self.sets = staged(texts(ids.unionByName(large.select("id")).distinct()), "sets")
        self.verify(likely)
        large = self.labelled(large)
        mixed = large.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).where("low <> high")
        left = staged(large.join(mixed, "key", "left_semi").select("id").distinct(), "mixed")
        if not left.isEmpty():
            self.verify(self.likely(self.pairs_by_prefix(left)))

    def pairs_by_prefix(self, ids: DataFrame) -> DataFrame:
        """All pairs of ``ids`` that can reach the threshold, but for those connected already."""
        sets = staged(self.sets.join(ids, "id", "left_semi"), "mixed-sets")
        counted = sets.select("shingles").mapInArrow(_counts, "slot long, c long")
        got = counted.groupBy("slot").agg(F.sum("c").alias("c")).toArrow()
        total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        total[got["slot"].to_numpy()] = got["c"].to_numpy()
        kind = dict(sets.dtypes)["id"]
        firsts = staged(map_rows(
            sets.select("id", "shingles"), _prefix(sets.sparkSession.sparkContext.broadcast(total), self.percent),
            f"id {kind}, n int, core int, firsts array<long>, sketch array<long>",
        ), "firsts")
        prefixes = self.labelled(firsts.drop("sketch"))
        rows = staged(
            prefixes.select("id", "n", "core", "component", F.posexplode("firsts").alias("at", "key")), "prefixes"
        )
        parts = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
        mixed = parts.groupBy("key").agg(
            F.sum("m").alias("c"), F.max(F.struct("m", "component")).alias("main")
        ).where("c > main.m").select(
            "key", F.col("main.component").alias("main"), F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")
        )
        # A pair is looked at with its first common shingle only, so a row has those before its own.
        met = staged(
            rows.join(mixed, "key").join(firsts.select("id", "sketch", "firsts"), "id")
            .withColumn("before", F.slice("firsts", F.lit(1), F.col("at"))).drop("firsts"),
            "met",
        )
        salt = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("salt")
        owners = met.select("key", salt, "id", "n", "core", "component", "main", "at", "before", "sketch")
        outsiders = met.where("component <> main").select(
            "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"),
            F.struct("id", "n", "core", "component", "at", "before", "sketch").alias("h"),
        )
        mine = F.struct("n", "id") < F.struct("h.n", "h.id")
        most = F.least("at", "h.at") + 1 + F.least(F.col("n") - F.col("at"), F.col("h.n") - F.col("h.at")) - 1
        return owners.join(outsiders, ["key", "salt"]).where(
            (F.col("component") != F.col("h.component")) & ((F.col("component") == F.col("main")) | mine)
            & _sized(F.col("n"), F.col("h.n"), self.percent)
            & (F.when(mine, F.col("at") < F.col("core")).otherwise(F.col("h.at") < F.col("h.core")))
            & ((100 + self.percent) * most.cast("long") >= self.percent * (F.col("n") + F.col("h.n")).cast("long"))
            & ~F.arrays_overlap("before", "h.before")
            & (_differing("sketch", "h.sketch") <= _most_differing(self.percent))
        ).select(F.least("id", "h.id").alias("a"), F.greatest("id", "h.id").alias("b"))


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Texts are linked when 100 times the common shingles reach ``percent`` times the union. A
    component is named by its smallest id, the one document that is kept.
    """
    prints = staged(fingerprints(docs, words=words, id_col=id_col, text=text), "fingerprints")
    solid = prints.where("n > 0 AND id IS NOT NULL")
    classes = staged(solid.groupBy("n", "d1", "d2").agg(F.min("id").alias("first")), "classes")
    nodes = staged(
        solid.join(classes.select(F.col("first").alias("id")), "id", "left_semi")
        .select("id", "n", "bands", "sig").dropDuplicates(["id"]),
        "nodes",
    )
    kind = dict(nodes.dtypes)["id"]

    def texts(ids: DataFrame) -> DataFrame:
        rows = docs.select(F.col(id_col).alias("id"), utf8(text).alias("_bytes"))
        return map_rows(
            rows.join(ids.hint("merge"), "id", "left_semi").dropDuplicates(["id"]),
            lambda: lambda doc, data: (doc, shingle_set(data, words).tobytes()),
            f"id {kind}, shingles binary",
        )

    linker = _Linker(nodes, percent)
    members = nodes.select(
        "id", "n", F.col("id").alias("component"), F.explode("bands").alias("key")
    )
    linker.link(members, texts)
    own = (
        classes.join(linker.labels.withColumnRenamed("node", "first"), "first", "left")
        .select("n", "d1", "d2", F.coalesce("component", "first").alias("component"))
    )
    placed = prints.select("id", "n", "d1", "d2").join(own, ["n", "d1", "d2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return placed.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
