"""Byte-level BPE encoding and decoding with Spark higher-order functions.

Encoding. The distinct words of the corpus (matches of the split pattern) are
counted; a word is encoded by a fold of ranked merges over its bytes:
each step reads the lowest, leftmost of the neighbouring pairs' ranks, merges that pair and looks
up its two new neighbours in a literal rank map. The most frequent words are encoded once and held by every task (a bounded table);
the other words are encoded by the same fold, once for each slice of documents that
has them and in a row of that slice, so texts are never shuffled.

Decoding concatenates the binary pieces of the ids.

Null texts count as empty (no tokens); a very long word costs one step for each byte; repeated
rows are encoded one by one; null ids pass through.
"""
from __future__ import annotations

import base64
import hashlib
import json
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small
from .words import MARKS, ODD, after_space, matcher

#: No merge; comes after every token.
NONE = 1 << 16
#: An item of the fold is rank << RANK | place << PLACE | token: the rank of its pair with the next item, its first byte's place in the word, its token.
PLACE, RANK = 17, 45
TOKEN, LOW = (1 << PLACE) - 1, (1 << RANK) - 1
#: Multiplier of the pair hash; a pair is (left << 17) | right, so the product stays below 2**63.
FACTOR = 0x1E3779B1


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class RankMap:
    """The literals of one vocabulary.

    The rank map is a perfect hash table of two literal arrays: ``shift`` by the
    pair's group, and ``slots`` of pair << 17 | merged token, so that a lookup is two
    array reads and never a scan.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= NONE:
            raise ValueError("a vocabulary of at most 65,536 tokens is expected")
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 17 | b] = rank
        self.size = 1 << (len(pairs) * 3 // 2).bit_length()
        self.groups = self.size // 2
        members: dict[int, list[int]] = {}
        for key in pairs:
            members.setdefault(self._group(key), []).append(key)
        shift, slots = [0] * self.groups, [-1] * self.size
        byte_tokens = [ranks[bytes([b])] for b in range(256)]
        for group, keys in sorted(members.items(), key=lambda x: -len(x[1])):
            homes = [self._home(k) for k in keys]
            d = 0
            while any(slots[h ^ d] >= 0 for h in homes) or len({h ^ d for h in homes}) < len(homes):
                d += 1
                if d == self.size:
                    raise ValueError("two pairs have one hash; choose another FACTOR")
            shift[group] = d
            for k, h in zip(keys, homes):
                slots[h ^ d] = k << 17 | pairs[k]
        # an empty slot holds a key above all others
        self.shift, self.slots = json.dumps(shift), json.dumps([x if x >= 0 else 1 << 51 for x in slots])
        # items by byte and next byte (256: none)
        self.byte_items = json.dumps([pairs.get(a << 17 | b, NONE) << RANK | a for a in byte_tokens for b in [*byte_tokens, NONE]])

    def _home(self, key: int) -> int:
        return (key * FACTOR >> 12) & (self.size - 1)

    def _group(self, key: int) -> int:
        return (key * FACTOR >> 33) & (self.groups - 1)

    def merged(self, key: Column) -> Column:
        """The token that a pair merges to, or NONE. ``key`` is a column that costs nothing to read twice."""
        x = key * FACTOR
        group = F.shiftright(x, 33).bitwiseAND(self.groups - 1).cast("int")
        home = F.shiftright(x, 12).bitwiseAND(self.size - 1).cast("int")
        slot = F.get(F.from_json(F.lit(self.slots), "array<bigint>"),
                     home.bitwiseXOR(F.get(F.from_json(F.lit(self.shift), "array<int>"), group)))
        # the merged token if the keys agree, else more than NONE
        return F.least(slot.bitwiseXOR(F.shiftleft(key, 17)), F.lit(NONE).cast("long"))

    def fold(self, word: Column) -> Column:
        """Token ids of one word. Items without a token frame it, so that each pair has neighbours."""
        codes = F.transform(F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ""), F.ascii)

        def with_pairs(codes: Column) -> Column:
            return F.transform(codes, lambda c, i: F.get(
                F.from_json(F.lit(self.byte_items), "array<bigint>"), c * 257 + F.coalesce(F.get(codes, i + 1), F.lit(256))
            ).bitwiseOR(F.shiftleft((i + 1).cast("long"), PLACE)))

        def step(state: Column, _: Column) -> Column:
            def with_least(outer: Column, least: Column) -> Column:
                def merge(old: Column, i: Column) -> Column:
                    best = F.shiftright(least, RANK)
                    left, after = F.get(old, i - 2), F.get(old, i + 1)
                    around = F.zip_with(
                        F.array(F.shiftleft(left.bitwiseAND(TOKEN), 17).bitwiseOR(best),
                                F.shiftleft(best, 17).bitwiseOR(after.bitwiseAND(TOKEN))),
                        F.array(left.bitwiseAND(LOW), least.bitwiseAND(LOW - TOKEN).bitwiseOR(best)),
                        lambda key, low: F.shiftleft(self.merged(key), RANK).bitwiseOR(low))
                    return F.concat(F.slice(old, F.lit(1), i - 2), around, F.slice(old, i + 2, F.size(old)))
                return F.when(least >= NONE << RANK, outer).otherwise(
                    F.aggregate(F.array(F.array_position(outer, least).cast("int")), outer, merge))
            return F.aggregate(F.array(F.array_min(state)), state, with_least)
        first, last = (F.array(F.lit(NONE << RANK | place | NONE)) for place in (0, LOW - TOKEN))
        framed = F.concat(first, F.get(F.transform(F.array(codes), with_pairs), F.lit(0)), last)
        return F.aggregate(F.sequence(F.lit(1), F.octet_length(word)), framed, step, lambda s: F.transform(
            F.slice(s, F.lit(2), F.size(s) - 2), lambda x: x.bitwiseAND(TOKEN).cast("int")))


#: Words that every task holds ready encoded, at most: the most frequent ones, each of up to WORD_BYTES bytes.
HELD_WORDS = 250_000
WORD_BYTES = 48


#: Bytes of text that a task cuts into parts at a time, when it counts and when it looks words up; one longer text is cut alone.
COUNT_BYTES = 1 << 22
SLICE_BYTES = 1 << 21


def text_slices(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``most`` bytes of the text column, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + most, "right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


class Cut:
    """Texts cut at their spaces. ``parts`` (Arrow) are the distinct parts that stand behind a space, ``firsts`` what stands before (of a text that must
    be matched whole: all of it); ``refs`` counts through both, ``ends`` says where in ``refs`` a text ends."""

    def __init__(self, texts: pa.Array):
        values = pc.fill_null(texts, "")
        whole = [ODD.search(t) is not None for t in values.to_pylist()]
        lists = pc.split_pattern(pc.if_else(pa.array(whole, pa.bool_()), "", values), " ")
        flat, sizes = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(sizes)
        begins = self.ends - sizes
        self.firsts = pc.if_else(pa.array(whole, pa.bool_()), values, flat.take(pa.array(begins))).to_pylist()
        encoded = flat.dictionary_encode()
        self.refs = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.refs[begins] = len(encoded.dictionary) + np.arange(len(sizes))
        self.parts = encoded.dictionary


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def word_counts(docs: DataFrame, text_col: str, pattern: str) -> DataFrame:
    """(word, n): every distinct match of the pattern in the texts and how often it occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = matcher(pattern).findall
        for batch in text_slices(batches, 0, COUNT_BYTES):
            cut, words = Cut(batch.column(0)), Counter()
            n = np.bincount(cut.refs, minlength=len(cut.parts))[:len(cut.parts)]
            # letters, also with one mark after them, are one word with the space before, as in after_space
            last, stem = pc.utf8_slice_codeunits(cut.parts, -1), pc.utf8_slice_codeunits(cut.parts, 0, -1)
            marked = pc.and_(pc.is_in(last, pa.array(sorted(MARKS))), pc.utf8_is_alpha(stem))
            easy = pc.or_(marked, pc.utf8_is_alpha(cut.parts))
            spaced = pc.binary_join_element_wise("", pc.if_else(marked, stem, cut.parts).filter(easy), " ")
            easy, marked = (x.to_numpy(zero_copy_only=False) for x in (easy, marked))
            for part, k in zip(strings(cut.parts.filter(pa.array(~easy))), n[~easy].tolist()):
                for w in find(" " + part):
                    words[w] += k
            for mark in MARKS:
                words[mark] += int(n[marked & pc.equal(last, mark).to_numpy(zero_copy_only=False)].sum())
            for first in cut.firsts:
                words.update(find(first))
            found = pa.concat_arrays([spaced, pa.array(words.keys(), pa.string())])
            yield pa.RecordBatch.from_arrays([found, pa.array(np.concatenate([n[easy], np.array([*words.values()], np.int64)]))], ["word", "n"])
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return found.where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def held_words(docs: DataFrame, text_col: str, pattern: str, rank_map: RankMap) -> dict[str, bytes]:
    """The most frequent words of the corpus with their ids (32-bit, little-endian), encoded by the fold. At most HELD_WORDS words, about 15 MB."""
    top = (word_counts(docs, text_col, pattern).where(F.octet_length("word") <= WORD_BYTES)
           .orderBy(F.desc("n"), "word").limit(HELD_WORDS))
    top = materialize(top.select("word").repartition(64, "word"), "bpe-words")
    encoded = materialize(top.select("word", rank_map.fold(F.col("word")).alias("ids")), "bpe-held")
    table = encoded.toArrow()
    ids = [x for chunk in table.column("ids").chunks for x in packed(chunk)]
    return dict(zip([x for chunk in table.column("word").chunks for x in strings(chunk)], ids))


def packed(ids: pa.ListArray) -> list[bytes]:
    """Each list of ids as 32-bit little-endian integers."""
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
    edges = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)) * 4
    return [flat[a:b] for a, b in pairwise([0, *edges.tolist()])]


#: Stands in the ids of a slice of documents for its first word that is not held; the next number for the second, and so on.
HOLE = 1 << 17


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every stretch, one stretch after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str,
            finish: Callable[[list[bytes]], list[pa.Array]], columns: str) -> DataFrame:
    """doc_id and what ``finish`` makes of the ids of a batch. Frequent words are looked up; a task leaves holes for the
    other words, which the same fold then encodes, once per slice of documents."""
    rank_map = RankMap(load_ranks(ranks_path))
    held = docs.sparkSession.sparkContext.broadcast(held_words(docs, text_col, pattern, rank_map))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, find = held.value, matcher(pattern).findall
        own: dict[str, int] = {}  # the words of a slice that are not held

        def encoded(found: list[str]) -> bytes:
            ids = map(words.get, found)
            return b"".join([x if x is not None else (HOLE + own.setdefault(w, len(own))).to_bytes(4, "little") for w, x in zip(found, ids)])

        class Parts(dict):
            def __missing__(self, part: str) -> bytes:
                found = after_space(part, find)
                value = encoded(found)
                if len(self) < 100_000 and all(map(words.__contains__, found)):
                    self[part] = value
                return value
        known = Parts()
        for batch in text_slices(batches, 1, SLICE_BYTES):
            own.clear()
            cut = Cut(batch.column(1))
            values = [*map(known.__getitem__, strings(cut.parts)), *(encoded(find(x)) for x in cut.firsts)]
            sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
            tokens, starts = np.frombuffer(b"".join(values), "<u4"), np.cumsum(sizes) - sizes
            ids, at = [], 0
            for end in cut.ends.tolist():
                refs = cut.refs[at:end]
                ids.append(tokens[stretches(starts[refs], sizes[refs])].tobytes())
                at = end
            missing = [list(own), *[None] * (len(ids) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(missing, pa.list_(pa.string()))], ["doc_id", "ids", "missing"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare: list[bytes] = []
        for batch in small(batches):
            out = []
            for raw, new in zip(batch.column(1).to_pylist(), batch.column(2)):
                if new.is_valid:
                    rare = packed(new.values)
                codes = np.frombuffer(raw, "<u4")
                holes = np.flatnonzero(codes >= HOLE)
                whole, at = [], 0
                for hole, k in zip((holes * 4).tolist(), codes[holes].tolist()):
                    whole += (raw[at:hole], rare[k - HOLE])
                    at = hole + 4
                out.append(b"".join([*whole, raw[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *finish(out)], ["doc_id", *(c.split()[0] for c in columns.split(", "))])
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    open_ = source.mapInArrow(look_up, f"doc_id {kind}, ids binary, missing array<string>")
    # the rows keep their order from one function to the other; a slice's first row has its words
    rare = F.when(F.col("missing").isNotNull(), F.transform("missing", rank_map.fold))
    return open_.select("doc_id", "ids", rare.alias("rare")).mapInArrow(fill, f"doc_id {kind}, {columns}")


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (binary, 32-bit little-endian)."""
    return _encode(docs, ranks_path, pattern, id_col, text_col, lambda ids: [pa.array(ids, pa.binary())], "ids binary")


class Pieces:
    """The bytes of every id, for decoding."""

    def __init__(self, pieces: list[bytes], most: int = 100_000):
        self.bytes, self.most = np.frombuffer(b"".join(pieces), np.uint8), most
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: bytes) -> bytes:
        codes = np.frombuffer(ids, "<u4")
        return b"".join(self.bytes[stretches(self.starts[x], self.sizes[x])].tobytes()
                        for x in (codes[at:at + self.most] for at in range(0, len(codes), self.most)))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, the digest of its ids and of the bytes that they decode to."""
    ranks = load_ranks(ranks_path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    table = Pieces(pieces)

    def digest(ids: list[bytes]) -> list[pa.Array]:
        return [pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(table.decode(x)).hexdigest() for x in ids], pa.string())]
    return _encode(docs, ranks_path, pattern, id_col, text_col, digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")
