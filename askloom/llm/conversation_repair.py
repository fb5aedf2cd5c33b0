"""Conversation repair: the cheapest edits that give every conversation a sound order of roles.

A sound conversation is empty, or one system turn at most and then user and assistant in turns, ending with
the assistant. Edits are Keep (0), Rerole to user or assistant (2), Delete (3, required for blank and
repeated turns) and Insert of an empty user or assistant turn anywhere (2); a truncated turn that is not
deleted costs 1 more. Of the cheapest edits those with the least string of initials are taken, the audit.

Method: depth-first branch and bound with an explicit stack. A node is a number of turns dealt with and the
role written last. Its bound is the cost so far plus what the remaining turns cost at the very least: the
forced costs, and 2 for each of the most disjoint pairs of neighbours that cannot stay as they are. The
incumbent is the best (cost, audit) of a whole path; each node keeps the best (cost, audit) with which
it was reached, and a worse prefix is given up. The search ends when no open node can beat the incumbent.

Scale: turns are range-sorted by (conversation, turn, role, text), so a conversation with a third of all
rows lies in many partitions. It is cut into segments of at most ``SEGMENT`` turns; a segment of a longer
conversation is solved from every role to every role, and a conversation's segments are then chained. What
comes together for one conversation is the faults, edits and costs, since its audit is one value, but
never its texts. Repeats are found by an aggregate over (conversation, role, digest of the text), edits go
back to the texts by their place, and digests are taken while sorted rows stream by.

Defined cases: a null role or text counts as one blank; null turns come first and count for no gap; null
conversations are one conversation; rows of one turn are ordered by role, then text; repeated rows are
duplicates; a conversation without turns is sound. Columns beyond the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from askloom.llm.common import staged

#: Turns solved at once.
SEGMENT = 128
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: What was written last: nothing, or a turn of this role.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = {NOTHING: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
SOUND_ENDS = (NOTHING, ASSISTANT)
#: The only role that Rerole and Insert can write next.
WRITES = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
SOLID = r"[^\x20\x09-\x0D]"
CLOSED = r"[.!?][\x20\x09-\x0D]*\z"


# --- one segment -----------------------------------------------------------------------

class Turn(NamedTuple):
    role: int | None  # None: neither system nor user nor assistant
    gone: bool  # has to be deleted
    extra: int  # cost of leaving it in


class Bounds:
    """What the turns from any place on cost at least, for given ends.

    A turn that has to be deleted costs that. A turn that can't keep its role costs a rerole; beside such turns
    anything may stand. Of the others, neighbours that can't follow each other cost an edit at or between them,
    and disjoint pairs cost as many; the end counts as a neighbour of the last turn.
    """

    def __init__(self, turns: Sequence[Turn], ends: Sequence[int]):
        n = len(turns)
        self.ends = ends
        # A system turn stays only if nothing was written before it: that is looked at apart.
        self.free = [t.role not in (USER, ASSISTANT) for t in turns if not t.gone]
        self.live = [t.role for t in turns if not t.gone]
        self.forced, self.next_live = [0] * (n + 1), [len(self.live)] * (n + 1)
        for i in range(n - 1, -1, -1):
            t = turns[i]
            change = 0 if t.role in (USER, ASSISTANT) else REROLE
            self.forced[i] = self.forced[i + 1] + (DELETE if t.gone else change + t.extra)
            self.next_live[i] = self.next_live[i + 1] - (not t.gone)
        self.pairs = [0] * (len(self.live) + 3)
        for k in range(len(self.live) - 1, -1, -1):
            clash = not self.free[k] and self.clash(self.live[k], k + 1)
            self.pairs[k] = max(self.pairs[k + 1], clash + self.pairs[k + 2])
        # With nothing written: everything before a system turn is deleted, and that turn stays.
        self.system_first = [DELETE * n * 9] * (n + 1)
        for i in range(n - 1, -1, -1):
            t, after = turns[i], self.system_first[i + 1] + DELETE
            stays = t.role == SYSTEM and not t.gone
            self.system_first[i] = min(after, t.extra + self.written(i + 1, SYSTEM)) if stays else after

    def clash(self, last: int, k: int) -> int:
        """1 if the k-th live turn, or the end, can't come right after ``last`` as it is."""
        if k < len(self.live):
            return int(not self.free[k] and self.live[k] not in FOLLOWS[last])
        return int(last not in self.ends)

    def written(self, i: int, last: int) -> int:
        k = self.next_live[i]
        return self.forced[i] + REROLE * max(self.pairs[k], self.clash(last, k) + self.pairs[k + 1])

    def least(self, i: int, last: int) -> int:
        found = self.written(i, last)
        return min(found, self.system_first[i]) if last == NOTHING else found


def first_incumbent(turns: Sequence[Turn], start: int, ends: Sequence[int]) -> tuple[int, str] | None:
    """Deleting everything, with inserts at the end; None if no end can be reached."""
    found = []
    for end in ends:
        kept, last, audit, cost = None, start, "", 0
        if end == SYSTEM and start == NOTHING:
            kept = next((i for i, t in enumerate(turns) if not t.gone and t.role == SYSTEM), None)
        for i, t in enumerate(turns):
            audit += "K" if i == kept else "D"
            cost += t.extra if i == kept else DELETE
            last = SYSTEM if i == kept else last
        while last != end and end in NAMES:
            audit, cost, last = audit + "I", cost + INSERT, WRITES[last]
        if last == end:
            found.append((cost, audit))
    return min(found, default=None)


def branch_and_bound(turns: Sequence[Turn], start: int, ends: Sequence[int]) -> tuple[int, str, int] | None:
    """(cost, audit, nodes visited) of the best way from ``start`` to one of ``ends``."""
    incumbent = first_incumbent(turns, start, ends)
    if incumbent is None:
        return None
    bounds, n, visited = Bounds(turns, ends), len(turns), 0
    reached: dict[tuple[int, int], tuple[int, str]] = {(0, start): (0, "")}
    stack = [(0, start, 0, "")]
    while stack:
        i, last, cost, audit = stack.pop()
        if reached[i, last] != (cost, audit):
            continue  # reached better since
        if (cost + bounds.least(i, last), audit) > (incumbent[0], incumbent[1][: len(audit)]):
            continue
        visited += 1
        if i == n and last in ends:
            incumbent = min(incumbent, (cost, audit))
        writes = WRITES[last]
        steps = [("I", i, writes, cost + INSERT)]
        if i < n:
            t = turns[i]
            steps.append(("D", i + 1, last, cost + DELETE))
            if not t.gone:
                steps.append(("R", i + 1, writes, cost + REROLE + t.extra))
                if t.role in FOLLOWS[last]:
                    steps.append(("K", i + 1, t.role, cost + KEEP + t.extra))
        open_nodes = []
        for initial, j, role, total in steps:
            path = audit + initial
            if (total, path) < reached.get((j, role), (total + 1, "")):
                bound = total + bounds.least(j, role)
                if (bound, path) <= (incumbent[0], incumbent[1][: len(path)]):
                    reached[j, role] = total, path
                    open_nodes.append((bound, path, (j, role, total, path)))
        # The most promising child is visited first.
        stack += [node for _, _, node in sorted(open_nodes, reverse=True)]
    return *incumbent, visited


def last_written(start: int, audit: str, turns: Sequence[Turn]) -> list[int]:
    """The role after each edit."""
    out, last, i = [], start, 0
    for edit in audit:
        if edit == "K":
            last = turns[i].role
        elif edit != "D":
            last = WRITES[last]
        i += edit != "I"
        out.append(last)
    return out


def ways(turns: Sequence[Turn], whole: bool) -> list[tuple[int, int, int, str]]:
    """(start, end, cost, audit): the one best way of a whole conversation, or all ways of a segment."""
    out = []
    for start, ends in [(NOTHING, SOUND_ENDS)] if whole else [(s, (e,)) for s in range(4) for e in range(4)]:
        if found := branch_and_bound(turns, start, ends):
            cost, audit, _ = found
            out.append((start, [start, *last_written(start, audit, turns)][-1], cost, audit))
    return out


def chain(segments: Sequence[Sequence[tuple[int, int, int, str]]]) -> list[tuple[int, str]]:
    """(role before, edits) of every segment along the best way through all of them."""
    best: dict[int, tuple[int, str]] = {NOTHING: (0, "")}
    back = []
    for found in segments:
        step: dict[int, tuple[int, str, int, str]] = {}
        for start, end, cost, audit in found:
            if start in best:
                way = best[start][0] + cost, best[start][1] + audit, start, audit
                step[end] = min(step.get(end, way), way)
        back.append(step)
        best = {end: way[:2] for end, way in step.items()}
    last = min((end for end in SOUND_ENDS if end in best), key=best.__getitem__)
    out = []
    for step in reversed(back):
        _, _, start, audit = step[last]
        out.append((start, audit))
        last = start
    return out[::-1]


# --- jobs ------------------------------------------------------------------------------

class Repair(NamedTuple):
    """``conversations``: one row each, with counts of faults, ``cost`` and ``audit``; ``turns``: the repaired
    rows ``place, turn, role, text, edit`` of each (deleted ones are left out)."""

    conversations: DataFrame
    turns: DataFrame


def code(role: Column, text: Column) -> Column:
    """Initial (s, u, a or -) and fault (blank, truncated, none) of a turn as two characters."""
    initial = F.substring(role, 1, 1)
    fault = F.when(~text.rlike(SOLID), "b").when(~text.rlike(CLOSED), "t").otherwise("-")
    return F.concat(F.when(initial.isin(*ROLE_OF), initial).otherwise("-"), fault)


def in_order(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, part, local``: the turns in global order, written once."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    # Equal rows are told apart, so that even they may lie in several partitions.
    keyed = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), text_of(role).alias("role"),
        text_of(text).alias("text"), F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv", "turn", "role", "text", "tie"]
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return staged(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
        .withColumn("part", F.spark_partition_id()).withColumn("local", local),
        "turns",
    )


def segments(ordered: DataFrame, size: int) -> DataFrame:
    """``conv, part, entries, whole``: the turns of a conversation in one stretch of the order."""
    named = ordered.select("conv", "part", "local", "turn", code(F.col("role"), F.col("text")).alias("code"))
    # The first turn of each role and text; marked by an entry without a code.
    firsts = ordered.groupBy("conv", "role", F.sha2("text", 256).alias("digest")).agg(
        F.min(F.struct("part", "local")).alias("at")
    ).select("conv", "at.part", "at.local", F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("code"))
    cut = staged(
        named.unionByName(firsts).groupBy("conv", "part", F.floor(F.col("local") / size).alias("seg"))
        .agg(F.collect_list(F.struct("local", "code", "turn")).alias("entries")),
        "segments",
    )
    several = cut.groupBy(F.col("conv").alias("_conv")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return cut.join(several, F.col("conv").eqNullSafe(F.col("_conv")), "left").select(
        "conv", "part", "entries", F.col("_n").isNull().alias("whole")
    )


SOLVED = """part int, low bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,
  first string, last string, low_turn bigint, high_turn bigint, distinct_turns bigint, codes string,
  ways array<struct<start:int, end:int, cost:bigint, audit:string>>"""


def legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


def solve_segment(part: int, entries: list[dict], whole: bool) -> tuple:
    firsts = {e["local"] for e in entries if e["code"] is None}
    rows = sorted((e for e in entries if e["code"] is not None), key=lambda e: e["local"])
    codes = [
        e["code"][0] + ("d" if e["code"][1] != "b" and e["local"] not in firsts else e["code"][1]) for e in rows
    ]
    turns = as_turns(codes)
    initials, faults = [c[0] for c in codes], [c[1] for c in codes]
    numbers = [e["turn"] for e in rows if e["turn"] is not None]
    illegal = sum(not legal(a + b) for a, b in zip(initials, initials[1:]))
    found = [dict(zip(("start", "end", "cost", "audit"), way)) for way in ways(turns, whole)]
    return (
        part, rows[0]["local"], len(rows), faults.count("b"), faults.count("d"), faults.count("t"), illegal,
        initials[0], initials[-1], min(numbers, default=None), max(numbers, default=None), len(set(numbers)),
        "".join(codes), found,
    )


def as_turns(codes: Sequence[str]) -> list[Turn]:
    return [Turn(ROLE_OF.get(c[0]), c[1] in "bd", TRUNCATED * (c[1] == "t")) for c in codes]


def mapped(df: DataFrame, fields: str, make) -> DataFrame:
    """Rows from rows, in Arrow batches; ``make`` gives the rows for one row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Some rows at a time: one row may hold or give very much.
            for at in range(0, batch.num_rows, 64):
                rows = [out for row in batch.slice(at, 64).to_pylist() for out in make(row)]
                columns = zip(*rows) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), type=t) for c, t in zip(columns, schema.types)], schema=schema
                )

    return df.mapInArrow(run, fields)


PLANNED = """gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string,
  edits array<struct<part:int, low:bigint, start:int, codes:string, audit:string, place:bigint>>"""


def plan(row: dict) -> tuple:
    """One conversation from its segments in order."""
    parts = row["segments"]
    path = chain([[(w["start"], w["end"], w["cost"], w["audit"]) for w in s["ways"]] for s in parts])
    illegal = sum(s["illegal"] for s in parts)
    illegal += sum(not legal(a["last"] + b["first"]) for a, b in zip(parts, parts[1:]))
    numbered = [s for s in parts if s["low_turn"] is not None]
    distinct = sum(s["distinct_turns"] for s in numbered)
    distinct -= sum(a["high_turn"] == b["low_turn"] for a, b in zip(numbered, numbered[1:]))
    gaps = numbered[-1]["high_turn"] - numbered[0]["low_turn"] + 1 - distinct if numbered else 0
    edits, place, cost = [], 0, 0
    for s, (start, audit) in zip(parts, path):
        edits.append({"part": s["part"], "low": s["low"], "start": start, "codes": s["codes"], "audit": audit, "place": place})
        place += len(audit) - audit.count("D")
        cost += min(w["cost"] for w in s["ways"] if (w["start"], w["audit"]) == (start, audit))
    total = lambda name: sum(s[name] for s in parts)
    return (
        row["conv"], gaps, total("blank"), total("duplicate"), total("truncated"), illegal, cost,
        "".join(audit for _, audit in path), edits,
    )


def edited(row: dict) -> Iterator[tuple]:
    """``conv, part, local, place, role, edit`` of the turns that one segment leaves; an insert has no local."""
    e, i = row["e"], 0
    codes = [e["codes"][k: k + 2] for k in range(0, len(e["codes"]), 2)]
    place = e["place"]
    for edit, last in zip(e["audit"], last_written(e["start"], e["audit"], as_turns(codes))):
        if edit != "D":
            local = None if edit == "I" else e["low"] + i
            yield row["conv"], e["part"], local, place, None if edit == "K" else NAMES[last], edit
            place += 1
        i += edit != "I"


def repair_conversations(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    segment: int = SEGMENT,
) -> Repair:
    """The faults, the cheapest edits and the repaired turns of every conversation of ``rows``."""
    kind = rows.select(conv).schema[0].dataType.simpleString()
    ordered = in_order(rows, conv, turn, role, text)
    solved = mapped(
        segments(ordered, segment), f"conv {kind}, {SOLVED}",
        lambda row: [(row["conv"], *solve_segment(row["part"], row["entries"], row["whole"]))],
    )
    fields = [c for c in solved.columns if c != "conv"]
    gathered = solved.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("segments"))
    planned = staged(mapped(gathered, f"conv {kind}, {PLANNED}", lambda row: [plan(row)]), "repairs")
    edits = mapped(
        planned.select("conv", F.explode("edits").alias("e")),
        f"conv {kind}, part int, local bigint, place bigint, new_role string, edit string", edited,
    )
    # One edit for each turn at most, joined by its place in the order: no key is hot.
    stays = edits.where(F.col("local").isNotNull()).drop("conv").join(ordered, ["part", "local"]).select(
        F.col("conv").alias(conv), "place", "turn", F.coalesce("new_role", "role").alias("role"), "text", "edit"
    )
    added = edits.where(F.col("local").isNull()).select(
        F.col("conv").alias(conv), "place", F.lit(None).cast("bigint").alias("turn"), F.col("new_role").alias("role"),
        F.lit("").alias("text"), "edit",
    )
    return Repair(planned.drop("edits").withColumnRenamed("conv", conv), stays.unionByName(added))


def text_digests(turns: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """``conv_id, repaired_sha256``: the digest of the ``role:text`` lines of each conversation.

    Rows stream by in order; a task holds one batch of them, however long a conversation is.
    """
    kind = dict(turns.dtypes)[conv]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, now, done = None, None, ([], [])

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(done[0], keys.type), pa.array(done[1])], names=[conv, "repaired_sha256"])
            done[0].clear()
            done[1].clear()
            return out

        for batch in batches:
            keys = batch.column(0)
            for key, role, text in zip(*batch.columns):
                key = key.as_py()
                if digest is None or key != now:
                    if digest is not None:
                        done[0].append(now)
                        done[1].append(digest.hexdigest())
                    digest, now = hashlib.sha256(), key
                else:
                    digest.update(b"\n")
                digest.update(f"{role.as_py()}:{text.as_py()}".encode())
            if done[0]:
                yield flush()
        if digest is not None:
            done[0].append(now)
            done[1].append(digest.hexdigest())
            yield flush()

    ordered = turns.repartition(conv).sortWithinPartitions(conv, "place").select(conv, "role", "text")
    return ordered.mapInArrow(run, f"`{conv}` {kind}, repaired_sha256 string")


# --- damage, to test repairs -----------------------------------------------------------

def damaged(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults planted by a checksum of ``conv:turn``: dropped, emptied, cut off, repeated, of another role."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named(conv), F.lit(":"), named(turn))) % 20
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    said = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(named(text), "[.!?]", ""))
    return (
        rows.select(conv, turn, role, text).withColumn("_kind", kind).where("_kind <> 0")
        .withColumn("_copy", F.explode(copies))
        .select(
            conv, turn, F.when(F.col("_kind") == 4, "user").otherwise(named(role)).alias(role),
            said.otherwise(named(text)).alias(text),
        )
    )
