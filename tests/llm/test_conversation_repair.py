"""Conversation repair against a plain dynamic programme and by properties of the repaired turns."""

import hashlib
import random
import re
import zlib

import pytest

from askloom.llm import conversation_repair as repair
from askloom.llm.conversation_repair import (
    FOLLOWS, NOTHING, SOUND_ENDS, WRITES, Turn, branch_and_bound, chain, damaged, repair_conversations, text_digests, ways,
)

SCHEMA = "conv_id long, turn long, role string, text string, part string, audit string, code string"


def cheapest(turns, start, ends):
    """(cost, audit) over all edits, place by place."""

    def insert(best):
        best = dict(best)
        for _ in range(4):
            for role, (cost, audit) in list(best.items()):
                best[WRITES[role]] = min(best.get(WRITES[role], (cost + 2, audit + "I")), (cost + 2, audit + "I"))
        return best

    best = insert({start: (0, "")})
    for t in turns:
        after = {}
        for role, (cost, audit) in best.items():
            found = [(role, cost + 3, "D")]
            if not t.gone:
                found.append((WRITES[role], cost + 2 + t.extra, "R"))
                found += [(t.role, cost + t.extra, "K")] * (t.role in FOLLOWS[role])
            for new, total, edit in found:
                after[new] = min(after.get(new, (total, audit + edit)), (total, audit + edit))
        best = insert(after)
    return min((best[e] for e in ends if e in best), default=None)


def random_turns(draw, n):
    return [Turn(draw.choice([1, 2, 3, 2, 3, None]), draw.random() < 0.2, int(draw.random() < 0.3)) for _ in range(n)]


def test_search_finds_the_optimum():
    draw = random.Random(3)
    for _ in range(400):
        turns = random_turns(draw, draw.choice([0, 1, 2, 3, 5, 8, 13]))
        for start in range(4):
            for ends in [(0,), (1,), (2,), (3,), SOUND_ENDS]:
                found = branch_and_bound(turns, start, ends)
                assert (found and found[:2]) == cheapest(turns, start, ends)


def test_bounds_never_exceed_the_cost():
    draw = random.Random(4)
    for _ in range(300):
        turns = random_turns(draw, 7)
        for ends in [SOUND_ENDS, (2,)]:
            bounds = repair.Bounds(turns, ends)
            for i in range(8):
                for last in range(4):
                    if best := cheapest(turns[i:], last, ends):
                        assert bounds.least(i, last) <= best[0]


def test_search_visits_few_nodes():
    draw = random.Random(5)
    for kind in ([2], [2, 2, 3, 3], [2, 3]):
        turns = [Turn(kind[i % len(kind)], False, i % 3 == 0) for i in range(400)]
        assert branch_and_bound(turns, NOTHING, SOUND_ENDS)[2] < 2000
    assert branch_and_bound(random_turns(draw, 100), NOTHING, SOUND_ENDS)[2] < 200_000


@pytest.mark.parametrize("size", [1, 3, 10])
def test_chained_segments_are_the_whole(size):
    draw = random.Random(6)
    for _ in range(60):
        turns = random_turns(draw, draw.randint(1, 20))
        parts = [turns[i: i + size] for i in range(0, len(turns), size)]
        path = chain([ways(p, whole=len(parts) == 1) for p in parts])
        assert "".join(audit for _, audit in path) == cheapest(turns, NOTHING, SOUND_ENDS)[1]


def expected(rows):
    """Per conversation the columns of the query, from rows that are damaged already."""
    by_conv, out = {}, {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, got in by_conv.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, faults = set(), [], []
        for _, role, text in got:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "-"
            seen.add((role, text))
            faults.append(fault)
            turns.append(Turn({"s": 1, "u": 2, "a": 3}.get(role[:1]), fault in "bd", int(fault == "t")))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:]))
        cost, audit = cheapest(turns, NOTHING, SOUND_ENDS)
        lines, i, last = [], 0, NOTHING
        for edit in audit:
            last = turns[i].role if edit == "K" else last if edit == "D" else WRITES[last]
            role = got[i][1] if edit == "K" else {1: "system", 2: "user", 3: "assistant"}.get(last)
            if edit != "D":
                lines.append((role, "" if edit == "I" else got[i][2]))
            i += edit != "I"
        numbers = [r[0] for r in got if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        digest = hashlib.sha256("\n".join(":".join(x) for x in lines).encode()).hexdigest()
        out[conv] = (gaps, *map(faults.count, "bdt"), illegal, cost, audit, digest, lines)
    return out


def some_rows():
    draw = random.Random(7)
    texts = ["Yes.", "no", "", " \n", "What?! \t", "a.b", "é", None, "long " * 30_000 + "end."]
    roles = ["user", "assistant", "system", "u", "", None, "Über", "tool", "a\nb"]
    rows = []
    for conv in [None, 1, 2, 3, 4, 5, 6, 7]:
        for k in range(draw.randint(1, 12)):
            rows.append((conv, draw.choice([None, k, k, k * 3]), draw.choice(roles[:3] * 3 + roles), draw.choice(texts)))
    rows += [(9, k, "user" if k % 2 else "system", f"turn {k % 50}.") for k in range(400)]
    rows += [(10, None, None, None)] * 60 + [(11, 5, "user", "Same.")] * 30
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("segment", [repair.SEGMENT, 4])
def test_repair(spark, segment):
    rows = some_rows()
    want = expected(rows)
    result = repair_conversations(frame(spark, rows), segment=segment)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in text_digests(result.turns).collect()}
    got = {r["conv_id"]: r for r in result.conversations.collect()}
    assert set(got) == set(want) and result.conversations.count() == len(want)
    empty = hashlib.sha256(b"").hexdigest()
    for conv, r in got.items():
        columns = (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"])
        assert (*columns, digests.get(conv, empty)) == want[conv][:-1]
    lines = {}
    for r in result.turns.orderBy("conv_id", "place").collect():
        lines.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert r["place"] == len(lines[r["conv_id"]]) - 1
    assert lines == {conv: w[-1] for conv, w in want.items() if w[-1]}
    for conv in lines:
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in lines[conv]))


def test_no_rows(spark):
    result = repair_conversations(frame(spark, some_rows()).limit(0))
    assert result.conversations.collect() == [] and result.turns.collect() == []
    assert text_digests(result.turns).collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", "A! b? c.") for c in [None, *range(40)] for t in [None, 0, 1]] + [(5, 7, None, None)]
    want = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(tuple, damaged(frame(spark, rows)).collect()), key=str) == sorted(want, key=str)
