"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level vocabulary (over a space and the text), B a merge-type SentencePiece vocabulary (over the text; it adds the space). The byte
offsets where tokens of both end cut a document into groups; in a group, each stretch between neighbouring ends is one link of an A and a B token.

1. Fragments. A byte range of a document gives an open prefix (tokens up to the first common end in it), closed groups, and an open
   suffix (tokens after the last common end). Fragments compose: the left one's suffix and the right one's prefix become a closed group,
   or stay open if one of them has no common end. Composition is associative. A text of up to ``SEGMENT`` code points is one fragment; a longer one is
   cut before spaces between word characters, where both tokenizers begin anew, its segments are dealt to tasks, each
   task composes the fragments of its byte ranges of ``RANGE`` bytes as a tree, and rounds of ``FAN`` neighbours compose those of a document across tasks.
2. Link counts of id pairs are summed over the corpus, from partial sums of each task, and the highest of each B id is found.
3. Each document's links look up their counts: up to ``HELD`` most frequent pairs are held by every task; the links of the others, each of
   which occurs no more often than any held one, are joined with the counts by pair and summed by document. Nothing is left out.

Texts that are null, empty, or whose joined A or B bytes are not the space and the text (a text that holds U+2581) have no tokens: zeros and ''.
Repeated rows are aligned one by one, null ids pass through, ties for the highest count all count, an empty table gives none. Only id
and text are read. Memory is linear in the longest document. The two encoders hold the words of texts that a worker has met, in bounded number.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytelevel import ByteEncoder
from .common import materialize, small, worker_state
from .pieces import PieceEncoder

#: Code points of a document that one row holds, about; bytes of a fragment; fragments that one step of a round composes.
SEGMENT, RANGE, FAN = 1 << 16, 1 << 14, 16
#: Code points that a task aligns at a time, about.
SLICE = 400_000
#: Words that a worker keeps encoded for each tokenizer, at most, twice over.
CACHE = 100_000
#: Pairs with their counts that every task holds, at most (13 bytes each).
HELD = 1_000_000
#: Distinct pairs that a task counts before it hands them on.
FLUSH = 1_000_000
_CUT = re.compile(r"(?<=\w) (?=\w)")


class Tokenizers:
    """Both encoders, the bytes of their ids, and the strings of the group notation."""

    def __init__(self, byte_path: str, pattern: str, piece_path: str):
        self.a, self.b = ByteEncoder(byte_path, pattern, CACHE), PieceEncoder(piece_path, CACHE)
        a, b = self.a.vocabulary.tokens, self.b.model.bytes
        if max(len(a), len(b)) > 1 << 16:
            raise ValueError("vocabularies of at most 65,536 tokens are expected")
        self.a_length, self.b_length = (np.array([len(t or b"") for t in x], np.int64) for x in (a, b))
        self.a_bytes, self.b_bytes = a, b
        # an A id, the last A id of a group, a B id, the last one
        self.strings = [f"{i}{end}" for x, ends in ((a, ",|"), (b, ",;")) for end in ends for i in range(len(x))]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """A and B ids of each text, None where the bytes of either are not the space and the text."""
        out = []
        for text, a, b in zip(texts, self.a.encode([" " + t for t in texts]), self.b.encode(texts, checked=False)):
            a, b = np.frombuffer(a, "<u4").astype(np.int64), np.frombuffer(b, "<u4").astype(np.int64)
            whole = (" " + text).encode()
            same = bool(text) and all(
                lengths[ids].sum() == len(whole) and b"".join(map(of.__getitem__, ids.tolist())) == whole
                for ids, lengths, of in ((a, self.a_length, self.a_bytes), (b, self.b_length, self.b_bytes)))
            out.append((a, b) if same else None)
        return out


class Closed(NamedTuple):
    """Groups that begin and end at common ends: their number, notation codes (see ``Tokenizers.strings``) in order, links (A id << 16 | B id)."""
    groups: int
    codes: np.ndarray
    links: np.ndarray


class Fragment(NamedTuple):
    """``cut``: some common end lies in the range; without one all tokens are in the prefix."""
    cut: bool
    prefix: tuple[np.ndarray, np.ndarray]
    closed: Closed
    suffix: tuple[np.ndarray, np.ndarray]


class Alignment:
    """The monoid's operations over two vocabularies."""

    def __init__(self, a_length: np.ndarray, b_length: np.ndarray):
        self.a_length, self.b_length = a_length, b_length
        none = np.zeros(0, np.int64)
        self.nothing = Closed(0, none, none)
        self.empty = Fragment(False, (none, none), self.nothing, (none, none))

    def close(self, a: np.ndarray, b: np.ndarray) -> tuple[Closed, np.ndarray, np.ndarray]:
        """Groups of tokens over one stretch of bytes that both sequences fill; the group of each link and of each notation code."""
        if not len(a):
            return self.nothing, self.nothing.codes, self.nothing.codes
        a_end, b_end = self.a_length[a].cumsum(), self.b_length[b].cumsum()
        mark = np.zeros(int(a_end[-1]) + 1, np.uint8)
        mark[a_end] += 1
        mark[b_end] += 2
        mark = mark[np.flatnonzero(mark)]
        of_a, of_b, both = mark & 1, mark >> 1, mark == 3
        group = both.cumsum() - both
        links = a[of_a.cumsum(dtype=np.int64) - of_a] << 16 | b[of_b.cumsum(dtype=np.int64) - of_b]
        a_last, b_last = both[of_a == 1], both[of_b == 1]
        a_group, b_group = a_last.cumsum() - a_last, b_last.cumsum() - b_last
        groups = int(both.sum())
        a_before = np.concatenate([[0], np.bincount(a_group, minlength=groups).cumsum()])
        b_before = np.concatenate([[0], np.bincount(b_group, minlength=groups).cumsum()])
        codes = np.empty(len(a) + len(b), np.int64)
        n, m = len(self.a_length), len(self.b_length)
        codes[np.arange(len(a)) + b_before[a_group]] = a + n * a_last
        codes[np.arange(len(b)) + a_before[b_group + 1]] = b + 2 * n + m * b_last
        of_code = np.empty(len(codes), np.int64)
        of_code[np.arange(len(a)) + b_before[a_group]] = a_group
        of_code[np.arange(len(b)) + a_before[b_group + 1]] = b_group
        return Closed(groups, codes, links), group, of_code

    def fragments(self, a: np.ndarray, b: np.ndarray, size: int) -> list[Fragment]:
        """The fragments of each ``size`` bytes of two token sequences that begin together; a token belongs to the range it ends in."""
        a_end, b_end = self.a_length[a].cumsum(), self.b_length[b].cumsum()
        total = int(max(a_end[-1:].sum(), b_end[-1:].sum()))
        out = []
        for start in range(0, total, size):
            i, j = (np.searchsorted(x, [start, start + size], side="right") for x in (a_end, b_end))
            common = np.intersect1d(a_end[slice(*i)], b_end[slice(*j)], assume_unique=True)
            if not len(common):
                out.append(self.empty._replace(prefix=(a[slice(*i)], b[slice(*j)])))
                continue
            k, h = (np.searchsorted(x, common[[0, -1]], side="right") for x in (a_end, b_end))
            out.append(Fragment(True, (a[i[0]:k[0]], b[j[0]:h[0]]), self.close(a[slice(*k)], b[slice(*h)])[0], (a[k[1]:i[1]], b[h[1]:j[1]])))
        return out

    def join(self, *parts: Closed) -> Closed:
        return Closed(sum(p.groups for p in parts), np.concatenate([p.codes for p in parts]), np.concatenate([p.links for p in parts]))

    def compose(self, x: Fragment, y: Fragment) -> Fragment:
        def with_(one: tuple, other: tuple) -> tuple:
            return tuple(np.concatenate(p) for p in zip(one, other))
        if not y.cut:
            return x._replace(suffix=with_(x.suffix, y.prefix)) if x.cut else x._replace(prefix=with_(x.prefix, y.prefix))
        if not x.cut:
            return y._replace(prefix=with_(x.prefix, y.prefix))
        between = self.close(*with_(x.suffix, y.prefix))[0]
        return Fragment(True, x.prefix, self.join(x.closed, between, y.closed), y.suffix)

    def tree(self, fragments: list[Fragment]) -> Fragment:
        while len(fragments) > 1:
            pairs = [fragments[k:k + 2] for k in range(0, len(fragments), 2)]
            fragments = [self.compose(*p) if len(p) == 2 else p[0] for p in pairs]
        return fragments[0] if fragments else self.empty

    def whole(self, x: Fragment) -> Closed:
        """A whole document's groups: its start and its end are common."""
        return self.join(self.close(*x.prefix)[0], x.closed, self.close(*x.suffix)[0])


RESULT = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "counts"]


def _schema(kind: str) -> str:
    return (f"rid long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, counts binary")


def _digest(strings: list[str], codes: np.ndarray) -> str:
    return hashlib.sha256("".join(map(strings.__getitem__, codes.tolist()))[:-1].encode()).hexdigest() if len(codes) else ""


def _counted(links: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct links, ascending, and how often each occurs, as 32-bit little-endian numbers."""
    found, n = np.unique(links, return_counts=True)
    return found.astype("<u4").tobytes(), n.astype("<u4").tobytes()


def _by_size(lengths: list[int], most: int) -> Iterator[slice]:
    """Slices of at most ``most`` in all, one at least."""
    at, size = 0, 0
    for k, n in enumerate(lengths):
        if k > at and size + n > most:
            yield slice(at, k)
            at, size = k, 0
        size += n
    if at < len(lengths):
        yield slice(at, len(lengths))


def _short_rows(tools: Tokenizers, monoid: Alignment, texts: list[str]) -> Iterator[list]:
    """n_a, n_b, n_groups, n_links, groups_sha256, links, counts of each text, aligned all at once: every document's end is a common end."""
    tokens = tools.encode(texts)
    some = [t for t in tokens if t]
    closed, group, of_code = monoid.close(*(np.concatenate([t[k] for t in some]) if some else monoid.nothing.codes for k in (0, 1)))
    # groups, codes and links of each document, in order
    sizes = np.array([len(t[0]) + len(t[1]) for t in some], np.int64)
    code_end = sizes.cumsum()
    group_end = of_code[code_end - 1] + 1 if some else sizes
    link_end = np.searchsorted(group, group_end)
    at = iter(zip([0, *code_end], code_end, [0, *group_end], group_end, [0, *link_end], link_end))
    for t in tokens:
        if t is None:
            yield [0, 0, 0, 0, "", b"", b""]
            continue
        c0, c1, g0, g1, l0, l1 = next(at)
        yield [len(t[0]), len(t[1]), int(g1 - g0), int(l1 - l0), _digest(tools.strings, closed.codes[c0:c1]), *_counted(closed.links[l0:l1])]


def _segments(text: str, size: int) -> list[str]:
    """The text cut before spaces between word characters, at ``size`` code points or later, without those spaces."""
    out, at = [], 0
    while found := _CUT.search(text, at + size):
        out.append(text[at:found.start()])
        at = found.end()
    return [*out, text[at:]]


def aligned(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, id_col: str, text_col: str, segment: int = SEGMENT,
            size: int = RANGE, fan: int = FAN) -> DataFrame:
    """One row per document: rid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links and counts (distinct links of the document)."""
    source = docs.select(F.monotonically_increasing_id().alias("rid"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def tools() -> tuple[Tokenizers, Alignment]:
        def make() -> tuple[Tokenizers, Alignment]:
            t = Tokenizers(byte_path, pattern, piece_path)
            return t, Alignment(t.a_length, t.b_length)
        return worker_state(f"aligner {byte_path} {pattern} {piece_path}", make)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, monoid = tools()
        for batch in small(batches):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for part in _by_size([len(t) + 200 for t in texts], SLICE):
                cols = list(zip(*_short_rows(own, monoid, texts[part])))
                types = [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
                ids = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids.column(0), ids.column(1), *map(pa.array, cols, types)], RESULT)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(2).to_pylist()):
                cut = _segments(text, segment)
                one = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.column(0).to_pylist() * len(cut)), pa.array(one.column(1).to_pylist() * len(cut), one.schema.field(1).type),
                     pa.array(range(len(cut)), pa.int64()), pa.array(cut, pa.string())], ["rid", "doc_id", "seg", "text"])

    def as_row(x: Fragment | None) -> dict:
        x, valid = (Fragment(False, *[(np.zeros(0, np.int64),) * 2, Closed(0, *[np.zeros(0, np.int64)] * 2)], (np.zeros(0, np.int64),) * 2), False) \
            if x is None else (x, True)
        packed = [a.astype("<u4").tobytes() for a in (*x.prefix, x.closed.codes, x.closed.links, *x.suffix)]
        return dict(zip(PARTS, [valid, x.cut, x.closed.groups, *packed]))

    def as_fragment(row: dict) -> Fragment | None:
        if not row["valid"]:
            return None
        pa_, pb, codes, links, sa, sb = (np.frombuffer(row[c], "<u4").astype(np.int64) for c in PARTS[3:])
        return Fragment(row["cut"], (pa_, pb), Closed(row["groups"], codes, links), (sa, sb))

    def fragment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, monoid = tools()
        for batch in batches:
            for k, text in enumerate(batch.column(3).to_pylist()):
                tokens = own.encode([text])[0]
                row = as_row(tokens and monoid.tree(monoid.fragments(*tokens, size)))
                yield pa.RecordBatch.from_arrays([*batch.select([0, 1, 2]).slice(k, 1).columns, *(pa.array([row[c]], t) for c, t in zip(PARTS, PART_TYPES))],
                                                 ["rid", "doc_id", "seg", *PARTS])

    def compose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, monoid = tools()
        rows = rows.sort_values("seg")
        found = [as_fragment(r) for r in rows.to_dict("records")]
        row = as_row(None if None in [f and 1 for f in found] else monoid.tree(found))
        return pd.DataFrame([{"rid": key[0], "doc_id": rows["doc_id"].iloc[0], "seg": key[1], **row}])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, monoid = tools()
        n = len(own.a_length)
        for batch in batches:
            for row in batch.to_pylist():
                x = as_fragment(row)
                closed = monoid.whole(x) if x else monoid.nothing
                n_a = int((closed.codes < 2 * n).sum())
                values = [n_a, len(closed.codes) - n_a, closed.groups, len(closed.links), _digest(own.strings, closed.codes), *_counted(closed.links)]
                types = [pa.int64(), batch.schema.field("doc_id").type, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([row["rid"], row["doc_id"], *values], types)], RESULT)

    fields = f"rid long, doc_id {kind}, seg long, " + ", ".join(
        f"{c} {t}" for c, t in zip(PARTS, ["boolean", "boolean", "long", *["binary"] * 6]))
    is_long = F.coalesce(F.length("text") > segment, F.lit(False))
    rows = source.where(~is_long).mapInArrow(short, _schema(kind))
    cut = source.where(is_long).mapInArrow(split, f"rid long, doc_id {kind}, seg long, text string").repartition("rid", "seg")
    pieces = materialize(cut.mapInArrow(fragment, fields), "align-fragments")
    left = pieces.agg(F.max("seg")).first()[0]
    while left:
        left //= fan
        pieces = pieces.groupBy("rid", F.expr(f"seg div {fan}").alias("to")).applyInPandas(compose, fields)
    return rows.unionByName(pieces.mapInArrow(finish, _schema(kind)))


PARTS = ["valid", "cut", "groups", "prefix_a", "prefix_b", "codes", "links", "suffix_a", "suffix_b"]
PART_TYPES = [pa.bool_(), pa.bool_(), pa.int64(), *[pa.binary()] * 6]


def pair_counts(rows: DataFrame) -> DataFrame:
    """(link, n, best): how often each pair of ids is linked in the corpus, and whether no pair of its B id is linked more often."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, counts, size = [], [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            found, place = np.unique(np.concatenate(links), return_inverse=True)
            return found, np.bincount(place, weights=np.concatenate(counts), minlength=len(found)).astype(np.int64)

        def out(found: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(found), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(found[k:k + 50_000].astype(np.int64)), pa.array(n[k:k + 50_000])], ["link", "n"])
        for batch in small(batches):
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                links.append(np.frombuffer(i, "<u4"))
                counts.append(np.frombuffer(c, "<u4").astype(np.int64))
                size += len(links[-1])
                if size > FLUSH:
                    found, n = summed()
                    links, counts, size = [found], [n], len(found)
                    if size > FLUSH // 2:
                        yield from out(found, n)
                        links, counts, size = [], [], 0
        if links:
            yield from out(*summed())
    sums = rows.select("links", "counts").mapInArrow(count, "link long, n long").groupBy("link").agg(F.sum("n").alias("n"))
    sums = materialize(sums, "align-pairs")
    b = F.col("link").bitwiseAND(0xFFFF)
    # at most one row for each id of the B vocabulary
    highest = sums.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return sums.join(F.broadcast(highest), b == F.col("b")).select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def least_held(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` pairs reach, by bins of counts (eight for each power of two, so at most 512 rows)."""
    bins = counts.groupBy(F.floor(F.log2("n") * 8).alias("bin")).agg(F.count("*").alias("pairs"), F.min("n").alias("lo"), F.max("n").alias("hi")).collect()
    above, least = 0, max((r.hi for r in bins), default=0) + 1
    for r in sorted(bins, key=lambda r: -r.bin):
        above += r.pairs
        if above > most:
            break
        least = r.lo
    return least


def align(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
          held: int = HELD, segment: int = SEGMENT, size: int = RANGE, fan: int = FAN) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    rows = materialize(aligned(docs, byte_path, pattern, piece_path, id_col, text_col, segment, size, fan), "aligned", "zstd")
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = materialize(pair_counts(rows), "align-counts")
    least = least_held(counts, held)
    top = counts.where(F.col("n") >= least).orderBy("link").toArrow()
    table = spark.sparkContext.broadcast([top.column(c).to_numpy() for c in ("link", "n", "best")])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, n, best = table.value
        names = [*RESULT[:7], "n_best", "count_sum", "links", "counts"]
        for batch in small(batches):
            sums, other, times = [], [], []
            for i, c in zip(batch.column(7).to_pylist(), batch.column(8).to_pylist()):
                i, c = np.frombuffer(i, "<u4"), np.frombuffer(c, "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(links, i), max(0, len(links) - 1))
                known = links[at] == i if len(links) else np.zeros(len(i), bool)
                at = at[known]
                sums.append((int((c[known] * best[at]).sum()), int((c[known] * n[at]).sum())) if len(at) else (0, 0))
                other.append(i[~known].astype(np.int64))
                times.append(c[~known])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], *(pa.array([s[k] for s in sums], pa.int64()) for k in (0, 1)),
                 pa.array(other, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))], names)
    fields = _schema(kind).replace("links binary, counts binary", "n_best long, count_sum long, links array<long>, counts array<long>")
    found = rows.mapInArrow(look_up, fields)
    wanted = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.where(F.col("n") < least).isEmpty():
        return found.select(*wanted)
    found = materialize(found, "align-found", "zstd")
    rest = (found.where(F.size("links") > 0).select("rid", F.explode(F.arrays_zip("links", "counts")).alias("x"))
            .select("rid", F.col("x.links").alias("link"), F.col("x.counts").alias("times"))
            .join(counts, "link").groupBy("rid")
            .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    both = found.drop("links", "counts").join(rest, "rid", "left")
    return (both.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).select(*wanted))
