"""Repair of conversations by the cheapest edits, with Four-Russians block tables.

A row's first fault is blank, duplicate (role and text seen earlier) or truncated. Edits: Keep 0, Rerole to user or assistant 1,
Delete 2 (the only one for blank and duplicate rows), Insert an empty user or assistant row 5; a truncated row that stays adds 5. The
initials of the roles that remain must read ``(s?(ua)+)?``. Of the cheapest edits those whose initials come first in ASCII are taken.

1. Rows are symbols (class of the role's initial, fault). Equal rows of a turn are counted before they are shuffled. A vector holds the
   cost to the conversation's end from each of the four states (nothing yet, after system, user, assistant); less its minimum it is one
   of few, so ``Blocks`` tabulates, for every vector and every block of ``BLOCK`` symbols, the vector before the block and the cost between.
2. Symbols are sorted over ranges of rows, so a long conversation lies in several partitions, in segments of up to ``SEGMENT`` symbols. A segment is read
   block by block from its end, by lookup. Segments of one conversation compose: each maps the vector after it to the one before it.
3. With the vector after each block known, a block is expanded backward into the vectors between its symbols, and forward from its state the first
   initial that keeps the cost is taken: no two edits of a state have one initial, so this is the first of all cheapest ones.
4. Texts meet the edits in a sort by conversation that is read as a stream; no conversation's texts are held.

Rows go by turn (nulls first), then role, then the text's SHA-256. A null text or role is one space, a null id a conversation of its own.
Repeated rows are duplicates. A role counts by its first character. A conversation without rows gives zeros and an empty audit; an empty table
gives none. Only id, turn, role and text are read. The audit of a conversation, a character a row, is one value.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, sized, worker_state

BLOCK = 3
SEGMENT = 1 << 16
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Classes of initials and faults; a symbol is class * 3 + fault.
CLASSES, CLEAN, CUT, GONE = "sua", 0, 1, 2
SYMBOLS = 12
#: States: nothing yet, after system, after user, after assistant. What a new user or assistant row leads to, and what a kept one of each class.
NEW = (2, 2, 3, 2)
KEPT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
#: Cost to the end behind the last row, inserts included.
END = (0, 2 * INSERT, INSERT, 0)
LEGAL = frozenset({(0, 1), (1, 2), (2, 1)})


def edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that a row allows, by initial. Inserts are apart."""
    kind, fault = divmod(symbol, 3)
    out = [("D", DELETE, state)]
    if fault != GONE:
        more = TRUNCATED * (fault == CUT)
        if kind in KEPT[state]:
            out.append(("K", more, KEPT[state][kind]))
        out.append(("R", REROLE + more, NEW[state]))
    return out


def before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to the end before a row, from those behind it; inserts before the row count."""
    costs = [min(cost + after[to] for _, cost, to in edits(q, symbol)) for q in range(4)]
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEW[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


class Blocks:
    """The tables. ``vectors``: the normalised vectors that occur, the first one is that of the end."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors, number = [END], {END: 0}
        step: list[list[tuple[int, int]]] = []
        while len(step) < len(self.vectors):
            row = []
            for symbol in range(SYMBOLS):
                costs = before(self.vectors[len(step)], symbol)
                low = min(costs)
                vector = tuple(c - low for c in costs)
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                row.append((number[vector], low))
            step.append(row)
        self.step = np.array(step)  # [vector, symbol] -> (vector, cost)
        n = len(self.vectors)
        self.next, self.cost = np.arange(n)[:, None], np.zeros((n, 1), np.int64)
        for k in range(block):  # one more symbol in front: code = symbol * 12**k + code so far
            into = self.step[self.next]  # [vector, code, symbol, 2]
            self.next = into[..., 0].transpose(0, 2, 1).reshape(n, -1)
            self.cost = (self.cost[:, :, None] + into[..., 1]).transpose(0, 2, 1).reshape(n, -1)
        self.known: dict[tuple[int, int, int], tuple[str, int]] = {}

    def codes(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """The odd symbols at the front and the codes of the blocks behind them."""
        odd = len(symbols) % self.block
        rest = symbols[odd:].reshape(-1, self.block).astype(np.int64)
        return symbols[:odd].tolist(), (rest @ SYMBOLS ** np.arange(self.block - 1, -1, -1)).tolist()

    def read(self, symbols: np.ndarray, end: int = 0) -> tuple[int, int, list[int]]:
        """Vector before the symbols, the cost between, and the vector behind each block (and behind each odd symbol in front), from the end."""
        odd, codes = self.codes(symbols)
        cost, behind = 0, []
        for code in reversed(codes):
            behind.append(end)
            cost += int(self.cost[end, code])
            end = int(self.next[end, code])
        for symbol in reversed(odd):
            behind.append(end)
            end, more = self.step[end, symbol].tolist()
            cost += more
        return end, cost, behind

    def mapped(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind the symbols the one before them, and the cost between."""
        odd, codes = self.codes(symbols)
        at = np.arange(len(self.vectors))
        cost = np.zeros(len(at), np.int64)
        for code in reversed(codes):
            cost += self.cost[at, code]
            at = self.next[at, code]
        for symbol in reversed(odd):
            cost += self.step[at, symbol, 1]
            at = self.step[at, symbol, 0]
        return at, cost

    def expand(self, end: int, symbols: list[int], state: int) -> tuple[str, int]:
        """Initials of the first cheapest edits of some symbols, and the state behind them; ``end``: the vector behind them."""
        costs = [self.vectors[end]]
        for symbol in reversed(symbols):
            costs.append(before(costs[-1], symbol))
        costs.reverse()
        out = []
        for k, symbol in enumerate(symbols):
            while True:
                now, behind = costs[k], costs[k + 1]
                choices = [(letter, to, True) for letter, cost, to in edits(state, symbol) if cost + behind[to] == now[state]]
                if INSERT + now[NEW[state]] == now[state]:
                    choices.append(("I", NEW[state], False))
                letter, state, onward = min(choices)
                out.append(letter)
                if onward:
                    break
        return "".join(out), state

    def trace(self, symbols: np.ndarray, behind: list[int], state: int = 0) -> tuple[str, int]:
        """Initials of the edits of all symbols from a state on, and the state behind them. ``behind`` is of ``read``."""
        odd, codes = self.codes(symbols)
        out, at = [], len(behind)
        for symbol in odd:
            at -= 1
            letters, state = self.expand(behind[at], [symbol], state)
            out.append(letters)
        for k, code in enumerate(codes):
            at -= 1
            key = (behind[at], code, state)
            if key not in self.known:
                first = len(odd) + k * self.block
                self.known[key] = self.expand(behind[at], symbols[first:first + self.block].tolist(), state)
            letters, state = self.known[key]
            out.append(letters)
        return "".join(out), state


def tail(state: int) -> str:
    """Inserts behind the last row."""
    return "I" * (END[state] // INSERT)


def illegal(symbols: np.ndarray) -> int:
    kinds = (symbols // 3).tolist()
    return sum(p not in LEGAL for p in zip(kinds, kinds[1:]))


def _blocks() -> Blocks:
    return worker_state("conversation blocks", Blocks)


def _rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, kind, blank, cut, times, fresh): equal rows of a turn as one; ``fresh``: no earlier row of the conversation has its role and text."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.substring("role", 1, 1)
    counted = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("kind"),
        blank.alias("blank"), cut.alias("cut")).groupBy("conv_id", "turn", "role", "digest", "kind", "blank", "cut").agg(F.count("*").alias("times"))
    counted = materialize(counted, "conv-counted")
    # where a role and text occur in several turns, the first of them
    first = (counted.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
             .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"), F.count("*").alias("turns")).where("turns > 1"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    fresh = F.col("turns").isNull() | F.col("turn").eqNullSafe(F.col("first.turn"))
    return materialize(counted.join(first, same, "left").select(*counted.columns, fresh.alias("fresh")), "conv-rows")


def _symbols(rows: DataFrame, kind: str, segment: int) -> DataFrame:
    """(conv_id, part, k, symbols): a conversation's symbols in order of (part, k), up to ``segment`` a row."""
    ordered = (rows.select("conv_id", "turn", "role", "digest", "times", (
        F.col("kind") * 3 + F.when(F.col("blank") | ~F.col("fresh"), GONE).when(F.col("cut"), CUT).otherwise(CLEAN)).alias("symbol"),
        (F.col("kind") * 3 + GONE).alias("again"))
        .repartitionByRange("conv_id", "turn", "role", "digest").sortWithinPartitions("conv_id", "turn", "role", "digest")
        .select("conv_id", "symbol", "again", "times"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        now, k, held, any_ = None, 0, bytearray(), False
        id_type = pa.int64()

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [id_type, pa.int32(), pa.int64(), pa.binary()])],
                                              ["conv_id", "part", "k", "symbols"])
        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, symbol, again, times in zip(*(c.to_pylist() for c in batch.columns)):
                if not any_ or conv != now:
                    if held:
                        out.append((now, part, k, bytes(held)))
                    now, k, held, any_ = conv, 0, bytearray(), True
                left, fill = times, symbol
                while left:
                    n = 1 if left == times else min(left, segment - len(held))
                    held += bytes([fill]) * n
                    left, fill = left - n, again
                    if len(held) >= segment:
                        out.append((now, part, k, bytes(held)))
                        k, held = k + 1, bytearray()
                        if sum(len(o[3]) for o in out[-64:]) > 1 << 22:
                            yield batch_of()
            if len(out) > 5000:
                yield batch_of()
        if held:
            out.append((now, part, k, bytes(held)))
        if out:
            yield batch_of()
    return materialize(ordered.mapInArrow(pack, f"conv_id {kind}, part int, k long, symbols binary"), "conv-symbols")


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one segment: conv_id, audit, cost, illegal."""
    blocks = _blocks()
    for batch in batches:
        found = []
        for symbols in batch.column("symbols").to_pylist():
            symbols = np.frombuffer(symbols, np.uint8)
            start, cost, behind = blocks.read(symbols)
            audit, state = blocks.trace(symbols, behind)
            found.append((audit + tail(state), cost + blocks.vectors[start][0], illegal(symbols)))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(c, t) for c, t in zip(zip(*found), [pa.string(), pa.int64(), pa.int64()]))],
                                         ["conv_id", "audit", "cost", "illegal"])


def _solve_long(symbols: DataFrame, kind: str) -> DataFrame:
    """Conversations of several segments. Between segments only the maps of vectors and states travel."""
    key = f"conv_id {kind}, part int, k long"

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks()
        for batch in batches:
            own = [np.frombuffer(s, np.uint8) for s in batch.column("symbols").to_pylist()]
            vectors, costs = zip(*(blocks.mapped(s) for s in own))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["conv_id", "part", "k"]).columns, pa.array([v.tolist() for v in vectors], pa.list_(pa.int32())),
                 pa.array([c.tolist() for c in costs], pa.list_(pa.int64())), pa.array([int(s[0]) for s in own], pa.int32()),
                 pa.array([int(s[-1]) for s in own], pa.int32()), pa.array([illegal(s) for s in own], pa.int64())],
                ["conv_id", "part", "k", "vectors", "costs", "first", "last", "inside"])

    def ends(rows: pd.DataFrame) -> pd.DataFrame:
        """The vector behind each segment; cost and illegal pairs of the conversation at its first segment."""
        rows = rows.sort_values(["part", "k"])
        vector, cost, behind = 0, 0, []
        for vectors, costs in zip(rows["vectors"][::-1], rows["costs"][::-1]):
            behind.append(vector)
            cost += int(costs[vector])
            vector = int(vectors[vector])
        pairs = rows["inside"].sum() + sum((a // 3, b // 3) not in LEGAL for a, b in zip(rows["last"][:-1], rows["first"][1:]))
        first = np.arange(len(rows)) == 0
        return rows[["conv_id", "part", "k"]].assign(behind=behind[::-1], cost=np.where(first, cost + _blocks().vectors[vector][0], 0),
                                                     illegal=np.where(first, pairs, 0))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks()
        for batch in batches:
            audits, states = [], []
            for s, end in zip(batch.column("symbols").to_pylist(), batch.column("behind").to_pylist()):
                s = np.frombuffer(s, np.uint8)
                behind = blocks.read(s, end)[2]
                pieces = [blocks.trace(s, behind, q) for q in range(4)]
                audits.append([a for a, _ in pieces])
                states.append([q for _, q in pieces])
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["conv_id", "part", "k", "cost", "illegal"]).columns, pa.array(audits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int32()))],
                ["conv_id", "part", "k", "cost", "illegal", "audits", "states"])

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        """The state before each segment, and the inserts behind the last."""
        rows = rows.sort_values(["part", "k"])
        state, starts = 0, []
        for states in rows["states"]:
            starts.append(state)
            state = int(states[state])
        return rows[["conv_id", "part", "k"]].assign(start=starts, tail=[""] * (len(rows) - 1) + [tail(state)])

    def place(x: DataFrame, y: DataFrame) -> list:
        return [x["conv_id"].eqNullSafe(y["conv_id"]), x["part"] == y["part"], x["k"] == y["k"]]
    behind = symbols.mapInArrow(maps, f"{key}, vectors array<int>, costs array<long>, first int, last int, inside long") \
        .groupBy("conv_id").applyInPandas(ends, f"{key}, behind int, cost long, illegal long")
    found = symbols.join(behind, place(symbols, behind)).select(symbols["conv_id"], symbols["part"], symbols["k"], "symbols", "behind", "cost", "illegal")
    pieces = materialize(found.mapInArrow(expand, f"{key}, cost long, illegal long, audits array<string>, states array<int>"), "conv-pieces")
    starts = pieces.select("conv_id", "part", "k", "states").groupBy("conv_id").applyInPandas(chain, f"{key}, start int, tail string")
    own = pieces.join(starts, place(pieces, starts)).select(pieces["conv_id"], F.struct(
        pieces["part"], pieces["k"], F.concat(F.get("audits", F.col("start")), "tail").alias("audit")).alias("piece"), "cost", "illegal")
    return own.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["audit"]), "").alias("audit"),
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _counts(rows: DataFrame) -> DataFrame:
    gone = F.col("times") - F.col("fresh").cast("long")
    turns = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("times")).otherwise(0)).alias("blank"), F.sum(F.when(~F.col("blank"), gone).otherwise(0)).alias("duplicate"),
        F.sum((~F.col("blank") & F.col("fresh") & F.col("cut")).cast("long")).alias("truncated"))
    return turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a stream sorted by conversation, the audit before the rows: the audit's row with the digest of the repaired rows."""
    audit_row, letters, at, state, lines, digest = None, "", 0, 0, 0, None
    types = None

    def line(role: str, text: str) -> None:
        nonlocal lines
        digest.update((("\n" if lines else "") + role + ":" + text).encode())
        lines += 1

    def new_role() -> str:
        nonlocal state
        state = NEW[state]
        return "user" if state == 2 else "assistant"

    def inserts() -> None:
        nonlocal at
        while at < len(letters) and letters[at] == "I":
            line(new_role(), "")
            at += 1

    def done() -> Iterator[tuple]:
        if audit_row is not None:
            inserts()
            yield (*audit_row, digest.hexdigest())
    for batch in batches:
        types = [*(batch.schema.field(c).type for c in ("conv_id", *COUNTS)), pa.string(), pa.string()]
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("sort", "role", "text", "conv_id", *COUNTS))):
            if row[0] == 0:
                out += done()
                audit_row, letters, at, state, lines, digest = (*row[3:], row[2]), row[2], 0, 0, 0, hashlib.sha256()
                continue
            inserts()
            letter, role = letters[at], row[1]
            at += 1
            if letter == "K":
                state = KEPT[state][CLASSES.index(role[0])]
                line(role, row[2])
            elif letter == "R":
                line(new_role(), row[2])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv_id", *COUNTS, "audit", "repaired_sha256"])
    last = list(done())
    if last:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*last), types)], ["conv_id", *COUNTS, "audit", "repaired_sha256"])


def repair(rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows`` (and of ``ids``, which has the column ``conv``): conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit (the edits' initials), repaired_sha256 (digest of the repaired rows as ``role:text`` lines)."""
    one = F.lit(" ")
    source = rows.select(rows[conv].alias("conv_id"), rows[turn].alias("turn"), F.coalesce(rows[role], one).alias("role"),
                         F.coalesce(rows[text], one).alias("text"))
    kind = source.schema["conv_id"].dataType.simpleString()
    counted = _rows(source)
    symbols = _symbols(counted, kind, segment)
    many = materialize(symbols.groupBy("conv_id").count().where("count > 1").select(F.col("conv_id").alias("many")), "conv-many")
    in_many = F.col("conv_id").eqNullSafe(F.col("many"))
    audits = symbols.join(sized(many), in_many, "left_anti").mapInArrow(_solve, f"conv_id {kind}, audit string, cost long, illegal long")
    if not many.isEmpty():
        audits = audits.unionByName(_solve_long(materialize(symbols.join(sized(many), in_many, "left_semi"), "conv-long"), kind))
    counts = _counts(counted)
    known = counts.join(audits.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    if ids is not None:
        every = ids.select(ids[conv].alias("c")).distinct()
        known = every.join(known, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("conv_id").withColumnRenamed("c", "conv_id")
    heads = known.select("conv_id", F.lit(0).alias("sort"), F.lit(None).cast(source.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
                         F.lit(None).cast("binary").alias("digest"), F.coalesce("audit", F.lit("")).alias("text"),
                         *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS))
    texts = source.select("conv_id", F.lit(1).alias("sort"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text",
                          *(F.lit(None).cast("long").alias(c) for c in COUNTS))
    stream = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "sort", "turn", "role", "digest")
    fields = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return stream.select("sort", "role", "text", "conv_id", *COUNTS).mapInArrow(_hashed, fields)


def damage(table: DataFrame) -> DataFrame:
    """The input that the query repairs: rows of ``conversations`` dropped, emptied, cut, repeated or given another role by a checksum of their place."""
    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.coalesce("text", F.lit(" "))
    return (table.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), hit.alias("hit")).where("hit != 0")
            .select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again")).drop("again"))
