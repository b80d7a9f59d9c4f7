"""Removal of repeated byte strings with an enhanced suffix array.

Every byte covered by a string of ``LENGTH`` bytes (a window) that starts
somewhere else too is found, in four steps:

1. Anchors. Each window picks the least hash of its ``GRAM``-byte grams, a choice that
   depends on the window alone. Neighbouring windows share their pick: one row a run of windows, about 1 for
   140 bytes, with the gram's hash (key) and a 128-bit hash of the run's bytes (context).
2. Keys seen once hold no repeat. Contexts seen twice are repeated throughout.
3. For the other contexts, the suffixes from the anchors of a key are sorted; a stack scan of their common
   prefixes gives the interval tree; in each interval the left extensions are tested: where they
   differ, the interval is a maximal repeat, and for each occurrence the longest left
   extension that it shares with another one counts, not just its neighbour's.
4. A key with more than ``GROUP`` distinct contexts is never gathered: its windows are halved by
   offset, again and again, and grouped by the bytes that a half has in common (rank doubling), until
   the contexts agree, part, or are single windows.

Null and empty texts have no bytes; texts under ``LENGTH`` bytes stay whole; matches
never cross documents; repeated rows are repeats of one another. A null id is an id. Memory is bounded by the slice size and the
longest document.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, sized, text_or_empty

LENGTH = 400
GRAM = 128
#: Distinct contexts of a key that one task sorts, at most.
GROUP = 100
#: Bytes that are hashed at a time; longer documents are cut into segments that overlap by a window.
SLICE = 1 << 18
SEGMENT = 1 << 22

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_TABLES = np.random.default_rng(20240229).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_KNOWN: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if (which, n) not in _KNOWN:
        out = []
        for b in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _KNOWN[which, n] = out[0], out[1]
    return _KNOWN[which, n]


class Hashes:
    """Hashes of any substring of ``data`` from prefix sums."""

    def __init__(self, data: np.ndarray, which: int):
        size = 1 << max(16, int(len(data) + 1).bit_length())
        power, self.inverse = _powers(which, size)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[which][data] * power[:len(data)], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.prefix[end] - self.prefix[start]) * self.inverse[start])


def sliding_least(v: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` neighbours: block-wise running minima from both sides."""
    n = len(v) - w + 1
    padded = np.full(-(-len(v) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(v)] = v
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def anchor_runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text index, first window, windows - 1, anchor - first window, key, context hashes) of every run of windows."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    one, two = Hashes(data, 0), Hashes(data, 1)
    at = np.arange(len(data) - GRAM + 1)
    gram = one.of(at, at + GRAM)
    low = np.uint64((1 << 24) - 1)
    least = sliding_least((gram & ~low) | at.astype(np.uint64), LENGTH - GRAM + 1)
    anchor = (least & low).astype(np.int64)
    windows = np.arange(len(anchor))
    windows = windows[windows + LENGTH <= ends[:len(windows)]]
    if not len(windows):
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    picked, own = anchor[windows], owner[windows]
    cut = np.flatnonzero((picked[1:] != picked[:-1]) | (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)) + 1
    first, last = windows[np.concatenate([[0], cut])], windows[np.concatenate([cut - 1, [len(windows) - 1]])]
    a, o = anchor[first], owner[first]
    shape = _mix(((last - first) * 1024 + (a - first)).astype(np.uint64))
    key = gram[a]
    c1, c2 = one.of(first, last + LENGTH) ^ shape, two.of(first, last + LENGTH) ^ shape
    begin = np.cumsum(sizes) - sizes
    return (o, first - begin[o], last - first, a - first, key.view(np.int64), c1.view(np.int64), c2.view(np.int64))


def _pieces(batch: pa.RecordBatch, text: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(rows, offsets, bytes) of about SLICE bytes; long texts in segments whose windows do not overlap."""
    rows, offsets, texts, size = [], [], [], 0
    for row, value in enumerate(batch.column(text)):
        raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
        for at in range(0, max(1, len(raw) - LENGTH + 1), SEGMENT):
            part = raw[at:at + SEGMENT + LENGTH - 1] if len(raw) > SEGMENT else raw
            rows.append(row)
            offsets.append(at)
            texts.append(part)
            size += len(part)
            if size >= SLICE:
                yield rows, offsets, texts
                rows, offsets, texts, size = [], [], [], 0
    if rows:
        yield rows, offsets, texts


RUN = "lo long, n int, off int, key long, c1 long, c2 long"


def runs_of(docs: DataFrame) -> DataFrame:
    """Runs of all documents: doc_id, th (hash of id and text), RUN."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, texts in _pieces(batch, 2):
                o, lo, n, off, key, c1, c2 = anchor_runs(texts)
                if len(o):
                    take = pa.array(np.array(rows, np.int64)[o])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(take), batch.column(1).take(take), pa.array(lo + np.array(offsets, np.int64)[o]),
                         pa.array(n.astype(np.int32)), pa.array(off.astype(np.int32)), pa.array(key), pa.array(c1), pa.array(c2)],
                        ["doc_id", "th", "lo", "n", "off", "key", "c1", "c2"])
    return docs.mapInArrow(run, f"doc_id {kind}, th long, {RUN}")


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while lo + 1 < hi:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo + (a[lo:lo + 1] == b[lo:lo + 1])


def lcp_intervals(lcp: list[int]) -> list[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of the tree; lcp[i] is that of the sorted suffixes i and i + 1."""
    out, stack = [], []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            out.append((length, first, i))
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))
    return out


def maximal_repeats(lefts: list[bytes], rights: list[bytes], least: int) -> list[tuple[int, int, list[int]]]:
    """Maximal repeats of at least ``least`` bytes around the anchors of one key, as (bytes before the anchor, bytes from it on,
    occurrences). ``lefts`` are the bytes before each anchor, reversed; ``rights`` those from it on."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    found = []
    for length, first, last in lcp_intervals(lcp):
        if not length:
            continue
        members = sorted(order[first:last + 1], key=lefts.__getitem__)
        shared = [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        # the interval tree of the left extensions: each node is a set that is left-diverse beyond its depth
        for depth, x, y in lcp_intervals(shared):
            if depth + length >= least:
                found.append((depth, length, members[x:y + 1]))
    return found


def coverage(lefts: list[bytes], rights: list[bytes], least: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Of each occurrence the spans (before, after) around the anchor that repeats cover."""
    spans: list[set] = [set() for _ in lefts]
    if len(lefts) == 2:
        before, after = common(*lefts), common(*rights)
        if before + after >= least:
            spans = [{(before, after)}, {(before, after)}]
    else:
        for before, after, members in maximal_repeats(lefts, rights, least):
            for m in members:
                spans[m].add((before, after))
    return [sorted(s) for s in spans]


def _contexts(runs: DataFrame, docs: DataFrame, kind: str) -> DataFrame:
    """``runs`` with their bytes as ``ctx``."""
    wanted = materialize(
        runs.groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th"))
        .agg(F.collect_list(F.struct("lo", "n", "off", "key", "c1", "c2")).alias("wanted")), "repeat-wanted")
    joined = docs.join(sized(wanted, 200_000), docs["doc_id"].eqNullSafe(F.col("__id")) & (docs["th"] == F.col("__th")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc_id, th, text, wanted = (batch.column(i).slice(row, 1) for i in range(4))
                raw = (text[0].as_py() or "").encode("utf-8", "surrogatepass")
                fields = wanted.flatten()
                lo, n = fields.field("lo").to_pylist(), fields.field("n").to_pylist()
                ctx = [raw[a:a + k + LENGTH] for a, k in zip(lo, n)]
                zeros = pa.array(np.zeros(len(ctx), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [doc_id.take(zeros), th.take(zeros), *(fields.field(c) for c in ("lo", "n", "off", "key", "c1", "c2")),
                     pa.array(ctx, pa.binary())], ["doc_id", "th", "lo", "n", "off", "key", "c1", "c2", "ctx"])
    return joined.select("doc_id", "th", "text", "wanted").mapInArrow(run, f"doc_id {kind}, th long, {RUN}, ctx binary")


SPAN = "start long, stop long"


def _scan_groups(contexts: DataFrame, kind: str) -> DataFrame:
    """Spans (doc_id, th, start, stop) of keys with few contexts: the interval tree of each key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "th", "start", "stop"]

        def flush(group: list[tuple], out: list[tuple]) -> None:
            lefts = [ctx[:off][::-1] for *_, off, ctx in group]
            rights = [ctx[off:] for *_, off, ctx in group]
            for (doc_id, th, lo, off, _), spans in zip(group, coverage(lefts, rights)):
                out.extend((doc_id, th, lo + off - before, lo + off + after) for before, after in spans)
        key, group, id_type = None, [], None
        for batch in batches:
            id_type, out = batch.schema.field(0).type, []
            cols = [batch.column(i).to_pylist() for i in range(6)]
            for doc_id, th, lo, off, k, ctx in zip(*cols):
                if k != key:
                    if len(group) > 1:
                        flush(group, out)
                    key, group = k, []
                group.append((doc_id, th, lo, off, ctx))
            yield _rows(out, id_type, names)
        if len(group) > 1:
            out = []
            flush(group, out)
            yield _rows(out, id_type, names)
    return (contexts.select("doc_id", "th", "lo", "off", "key", "ctx").repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, f"doc_id {kind}, th long, {SPAN}"))


def _rows(out: list[tuple], id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*out)) if out else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [id_type, *[pa.int64()] * (len(names) - 1)])], names=names)


def _halved(rows: DataFrame, kind: str) -> DataFrame:
    """Each row (a range first..last of window offsets before the anchor) cut in two at the middle of its grid cell, with the hash of the bytes that
    all windows of the half's cell have in common (part) and of all bytes of its windows (d1, d2)."""
    columns = ["doc_id", "th", "lo", "off", "key", "ctx", "cell", "width", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {c: batch.column(i).to_pylist() for i, c in enumerate(columns)}
            out = []
            for row, (off, ctx, cell, width, first, last) in enumerate(
                    zip(*(cols[c] for c in ("off", "ctx", "cell", "width", "first", "last")))):
                half = (width + 1) // 2
                for c, w in ((cell, half), (cell + half, width - half)):
                    a, b = max(first, c), min(last, c + w - 1)
                    if w < 1 or a > b:
                        continue
                    # windows start off - o; those of the cell share [off - c, off - (c + w - 1) + LENGTH)
                    shared = hashlib.blake2b(ctx[off - c:off - (c + w - 1) + LENGTH], digest_size=8).digest()
                    whole = hashlib.blake2b(ctx[off - b:off - a + LENGTH], digest_size=16).digest()
                    out.append((row, c, w, a, b, int.from_bytes(shared, "little", signed=True),
                                int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)))
            if out:
                take, *rest = zip(*out)
                take = pa.array(take, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(take) for i in range(6)), *(pa.array(x, pa.int32()) for x in rest[:4]),
                     *(pa.array(x, pa.int64()) for x in rest[4:])], [*columns, "part", "d1", "d2"])
    return rows.select(*columns).mapInArrow(
        run, f"doc_id {kind}, th long, lo long, off int, key long, ctx binary, cell int, width int, first int, last int, "
             "part long, d1 long, d2 long")


def _hot_spans(contexts: DataFrame, kind: str) -> list[DataFrame]:
    """Spans of keys with many contexts, by halving."""
    rows = contexts.select(
        "doc_id", "th", "lo", "off", "key", "ctx", F.lit(0).alias("cell"), F.lit(LENGTH - GRAM + 1).alias("width"),
        (F.col("off") - F.col("n")).alias("first"), F.col("off").alias("last"))
    spans = []
    while not rows.isEmpty():
        cut = materialize(_halved(rows, kind), "repeat-halves")
        cells = ["key", "cell", "width", "part"]
        classes = cut.groupBy(*cells, "first", "last", "d1", "d2").agg(F.count("*").alias("m"))
        classes = materialize(classes, "repeat-half-classes")
        keys = (classes.groupBy(*cells).agg(F.count("*").alias("classes"), F.min("m").alias("rarest")))
        marked = materialize(cut.join(classes, [*cells, "first", "last", "d1", "d2"]).join(keys, cells), "repeat-marked")
        spans.append(marked.where("m > 1").select(
            "doc_id", "th", (F.col("lo") + F.col("off") - F.col("last")).alias("start"),
            (F.col("lo") + F.col("off") - F.col("first") + LENGTH).alias("stop")))
        # one occurrence of a repeated part stands for all
        more = marked.where("classes > 1 and rarest = 1 and width > 1")
        rows = more.where("m = 1").unionByName(
            more.where("m > 1").dropDuplicates([*cells, "first", "last", "d1", "d2"])).drop("part", "d1", "d2", "m", "classes", "rarest")
    return spans


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, spans): the merged byte ranges of each document that repeated windows cover. ``docs`` has doc_id, th, text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = materialize(runs_of(docs), "repeat-runs")
    keys = (runs.groupBy("key").agg(
        F.count("*").alias("total"), *(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("c1", "c2")))
        .where("total > 1")
        .select("key", ((F.col("min_c1") != F.col("max_c1")) | (F.col("min_c2") != F.col("max_c2"))).alias("mixed")))
    keys = materialize(keys, "repeat-keys")
    shared = materialize(runs.join(sized(keys), "key"), "repeat-shared")
    # contexts of mixed keys, how often each occurs, and how many their key has
    classes = materialize(shared.where("mixed").groupBy("key", "c1", "c2").agg(F.count("*").alias("m")), "repeat-classes")
    counts = classes.groupBy("key").agg(F.count("*").alias("classes"), F.min("m").alias("rarest"))
    classes = materialize(classes.join(counts, "key"), "repeat-counted")
    mixed = materialize(shared.where("mixed").drop("mixed").join(classes, ["key", "c1", "c2"]), "repeat-mixed")
    whole = shared.where("not mixed").select("doc_id", "th", "lo", "n").union(
        mixed.where("m > 1").select("doc_id", "th", "lo", "n"))
    spans = whole.select("doc_id", "th", F.col("lo").alias("start"), (F.col("lo") + F.col("n") + LENGTH).alias("stop"))
    # one occurrence of a context stands for all; a key whose contexts all recur is settled
    open_ = mixed.where("rarest = 1")
    alone = open_.where("m = 1")
    heads = (open_.where("m > 1").groupBy("key", "c1", "c2", "classes")
             .agg(F.min(F.struct("doc_id", "th", "lo", "n", "off")).alias("x"))
             .select("x.doc_id", "x.th", "x.lo", "x.n", "x.off", "key", "c1", "c2", "classes"))
    chosen = alone.select(*heads.columns).unionByName(heads)
    few, many = chosen.where(F.col("classes") <= GROUP), chosen.where(F.col("classes") > GROUP)
    columns = ["doc_id", "th", "lo", "n", "off", "key", "c1", "c2"]
    spans = spans.unionByName(_scan_groups(_contexts(few.select(columns), docs, kind), kind))
    many = materialize(many.select(columns), "repeat-many")
    if not many.isEmpty():
        for part in _hot_spans(materialize(_contexts(many, docs, kind), "repeat-hot"), kind):
            spans = spans.unionByName(part)
    by_doc = spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for own in batch.column(2).to_pylist():
                out: list[list[int]] = []
                for s in sorted((x["start"], x["stop"]) for x in own):
                    if out and s[0] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], s[1])
                    else:
                        out.append(list(s))
                merged.append(out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(merged, pa.list_(pa.list_(pa.int64())))], ["doc_id", "th", "spans"])
    return materialize(by_doc.mapInArrow(merge, f"doc_id {kind}, th long, spans array<array<long>>"), "repeat-spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (removed byte ranges, ascending), kept (the remaining bytes)."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text_or_empty(text_col)).alias("th"),
                        text_or_empty(text_col).alias("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(named).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "spans")
    joined = named.join(sized(spans, 500_000), named["doc_id"].eqNullSafe(F.col("__id")) & (named["th"] == F.col("__th")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, spans, kept = [], [], []
            for text, own in zip(batch.column(1), batch.column(2)):
                raw, own, at, parts = (text.as_py() or "").encode("utf-8", "surrogatepass"), own.as_py() or [], 0, []
                for a, b in own:
                    parts.append(raw[at:a])
                    at = b
                parts.append(raw[at:])
                total.append(len(raw))
                spans.append(own)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])
    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, spans array<array<long>>, kept binary")
