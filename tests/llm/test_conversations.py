"""Conversation repair against a search over all edits: null ids, turns, roles and texts, repeated rows, ties, a long conversation in many
segments, empty tables and columns with clashing names."""
import collections
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from hourwise.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, k int, part string, digest string, audit string, count long"
RNG = random.Random(3)
SPACE = "\x20\x09\x0A\x0B\x0C\x0D"


def rows():
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "User", "agent"]
    texts = ["Hello.", "Yes!", "cut off", "", " \t\n", None, "why?  ", "a.b", "é ?", "Fin. "]
    out = [(c, RNG.choice([None, *range(6)]), RNG.choice(roles), RNG.choice(texts)) for c in range(150) for _ in range(RNG.randint(1, 7))]
    out += [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {c} {t}.") for c in range(150, 260) for t in range(4)]
    out += [(None, 1, "user", "A."), (None, 2, "assistant", "B."), (300, 1, "user", "same.")] + [(300, 1, "user", "same.")] * 40
    out += [(400, t, RNG.choice(roles[:5]), RNG.choice([f"Line {t}.", f"line {t}", "Again."])) for t in range(300)]
    return [(*r, 1, "p", "d", "a", 2) for r in out]


def key(conv, turn):
    return f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"


def damaged(table):
    for c, t, role, text, *_ in table:
        role, text, hit = role if role is not None else " ", text if text is not None else " ", zlib.crc32(key(c, t).encode()) % 20
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            for _ in range(2 if hit == 3 else 1):
                yield c, t, "user" if hit == 4 else role, text


def cheapest(rows, faults):
    """(cost, initials) by uniform-cost search over (rows read, roles so far), with the contract's own words."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, shape = heapq.heappop(heap)
        if (i, shape) in seen:
            continue
        seen.add((i, shape))
        if i == len(rows) and re.fullmatch("(s?ua)?", shape):
            return cost, audit

        def add(more, letter, onward, role=""):
            grown = re.sub("ua(?=u)", "", shape + role)  # an earlier pair no longer matters
            if re.fullmatch("s?(ua?)?", grown):
                heapq.heappush(heap, (cost + more, audit + letter, i + onward, grown))
        for new in "ua":
            add(5, "I", 0, new)
        if i < len(rows):
            add(2, "D", 1)
            if faults[i] not in ("blank", "duplicate"):
                cut = 5 * (faults[i] == "truncated")
                if rows[i][2][:1] in ("s", "u", "a"):
                    add(cut, "K", 1, rows[i][2][:1])
                for new in "ua":
                    add(1 + cut, "R", 1, new)


def brute(table, ids):
    groups = collections.defaultdict(list)
    for r in table:
        groups[r[0]].append(r)
    out = {}
    for conv in ids:
        own = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        faults, seen = [], set()
        for _, _, role, text in own:
            solid = text.strip(SPACE)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in own} - {None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        if not own:
            out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            continue
        cost, audit = cheapest(own, faults)
        kept = len(audit.replace("D", ""))
        names = (["system"] if kept % 2 else []) + ["user", "assistant"] * (kept // 2)
        lines, at = [], iter(own)
        for letter in audit:
            row = None if letter == "I" else next(at)
            if letter != "D":
                name = names[len(lines)]
                lines.append(f"{row[2] if letter == 'K' else name}:{row[3] if row else ''}")
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    got = {}
    for r in df.collect():
        assert r.conv_id not in got
        got[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
    return got


@pytest.mark.parametrize("segment", [C.SEGMENT, 5])
def test_repair(spark, segment):
    table = rows()
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    assert results(C.repair(C.damage(df), df, segment=segment)) == brute(list(damaged(table)), {r[0] for r in table})


def test_damage(spark):
    table = rows()
    got = collections.Counter((r.conv_id, r.turn, r.role, r.text) for r in C.damage(spark.createDataFrame(table, SCHEMA)).collect())
    assert got == collections.Counter(damaged(table))


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair(C.damage(empty), empty).collect() == []
    ids = spark.createDataFrame([(7,), (None,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert results(C.repair(empty, ids)) == {7: nothing, None: nothing}


@pytest.mark.parametrize("block", [1, 2, 3])
def test_blocks_of_any_length(block):
    tables = C.Blocks(block)
    for _ in range(500):
        s = np.array([RNG.randrange(C.SYMBOLS) for _ in range(RNG.randint(0, 12))], np.uint8)
        start, cost, behind = tables.read(s)
        audit, state = tables.trace(s, behind)
        rows = [(0, 0, "suax"[x // 3], "") for x in s.tolist()]
        faults = [["", "truncated", "blank"][x % 3] for x in s.tolist()]
        assert (cost + tables.vectors[start][0], audit + C.tail(state)) == cheapest(rows, faults)
        at, costs = tables.mapped(s)
        assert (at[0], costs[0]) == (start, cost)
