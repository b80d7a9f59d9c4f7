"""Near-duplicate classes by ProbMinHash.

1. A document's weighted shingles (five words; weight 1 + ln(count)) arrive as
   Poisson processes: an element of weight w has exponential gaps of mean 1/w, each arrival
   falls into a random one of the signature's registers, a register keeps its first
   arrival's element. An element stops as soon as its next arrival is later than every register
   (early termination). Two registers agree with the probability Jaccard of the documents. A document that
   repeats shingles is signed with weight 1 too; there two registers agree with the plain Jaccard of the sets. Without repeats both are one.
2. Documents with equal words are one node. Bands of ``ROWS`` registers of both signatures make bucket keys. In each bucket every member is
   compared with the bucket's first one (a star, not all pairs); of a row's stars the one with the smallest first member goes ahead, the
   others follow where that leaves the two apart.
3. Each candidate is verified on the full shingles: probability Jaccard, or plain Jaccard of the sets, of at
   least ``THRESHOLD`` links.
4. Members of one bucket that are still in different components are compared by sketches of both signatures; those of which
   one comes within six standard errors of the threshold are grouped, and inside the groups, in blocks, likest
   first, pairs of different components are verified. No link that a bucket shows is lost, and rows grow
   with the members, not with their pairs.
5. Classes are the connected components of the links.

With 42 bands of 6, a pair at 0.8 by either measure shares no bucket with probability 3e-6.
Words are runs of non-white-space, lower case. A document of one to four words has
one shingle; empty and null texts have none and equal one another. Rows that repeat are copies; a null id
stays null and its class is that of its text. Memory is linear in the longest document.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, sized, small, text_or_empty, unused
from .components import components

SHINGLE = 5
BANDS, ROWS = 42, 6
REGISTERS = BANDS * ROWS
THRESHOLD = 0.8
#: Rows of a bucket or group that one task compares with one another, about; larger ones are cut into pairs of blocks.
BLOCK = 512
#: Code points of text that are hashed at a time.
SLICE = 500_000

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> 64-bit hash, kept for up to 200,000 words."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < 200_000:
            self[word] = h
        return h


def shingles(words: list[list[str]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(document index, shingle hash) of all shingles of the documents, repeats included."""
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((h for w in words for h in map(hashes.__getitem__, w)), np.uint64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(flat))  # words from here to the document's end
    total = np.repeat(lengths, lengths)
    first = left == total
    h = np.zeros(len(flat), np.uint64)
    for k in range(SHINGLE):
        # a document shorter than a shingle has one of all its words
        inside = left > k
        part = np.zeros(len(flat), np.uint64)
        part[:max(0, len(flat) - k)] = flat[k:]
        h = np.where(inside, mix(h * _STEP + part), h)
    keep = (left >= SHINGLE) | (first & (total < SHINGLE))
    return owner[keep], h[keep]


def weighted(owner: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, shingle) with weight 1 + ln(count)."""
    key = mix(h ^ mix(owner.astype(np.uint64) + _STEP))
    _, at, counts = np.unique(key, return_index=True, return_counts=True)
    return owner[at], h[at], 1 + np.log(counts)


def signatures(owner: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Register contents of each of ``n`` documents, all elements round by round: the j-th arrivals of the elements that can
    still change a register."""
    regs, sig = np.full(n * REGISTERS, np.inf), np.zeros(n * REGISTERS, np.uint64)
    last = np.full(n, np.inf)
    time, j = np.zeros(len(h)), 0
    state = h
    while len(state):
        j += 1
        draw = mix(state + np.uint64(int(_STEP) * 2 * j & 0xFFFFFFFFFFFFFFFF))
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        time = time + gap / weight
        slot = owner * REGISTERS + (mix(draw + _STEP) % np.uint64(REGISTERS)).astype(np.int64)
        better = np.flatnonzero(time < regs[slot])
        better = better[np.argsort(-time[better], kind="stable")]  # of equal slots the earliest is written last
        regs[slot[better]], sig[slot[better]] = time[better], state[better]
        if j < 16 or j % 8 == 0:
            docs = np.unique(owner)
            last[docs] = regs.reshape(n, REGISTERS)[docs].max(axis=1)
        live = time < last[owner]
        if not live.all():
            owner, state, weight, time = owner[live], state[live], weight[live], time[live]
    return sig.reshape(n, REGISTERS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """[documents, BANDS] bucket keys."""
    parts = sig.reshape(len(sig), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), BANDS)).copy()
    for k in range(ROWS):
        h = mix(h * _STEP + parts[:, :, k])
    return h.view(np.int64)


def sketch_of(sig: np.ndarray) -> np.ndarray:
    """One byte of each register."""
    return (mix(sig) & np.uint64(255)).astype(np.uint8)


def unweighted(owner: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(document, bucket keys, sketch) by signatures without weights, of the documents that repeat a shingle."""
    documents = np.unique(owner[weight > 1])
    if len(documents):
        place = np.full(n, -1)
        place[documents] = np.arange(len(documents))
        some = place[owner] >= 0
        sig = signatures(place[owner[some]], h[some], np.ones(int(some.sum())), len(documents))
        yield from zip(documents.tolist(), band_keys(sig), sketch_of(sig))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Plain Jaccard of the shingle sets and probability Jaccard of the weights; ``a`` and ``b`` are (sorted shingles, weights)."""
    if not len(a[0]) or not len(b[0]):
        same = float(len(a[0]) == len(b[0]))
        return same, same
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(i)
    plain = len(i) / union
    if not len(i):
        return 0.0, 0.0
    x, y = a[1][i], b[1][j]
    only_x, only_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    # sum_j max(x_j / x_i, y_j / y_i) over shared j: those of a higher ratio x/y count by x, the others by y
    order = np.argsort(x / y)
    x, y = x[order], y[order]
    ratio = x / y
    above = np.searchsorted(ratio, ratio, side="right")
    x_tail = np.concatenate([np.cumsum(x[::-1])[::-1], [0]])
    y_head = np.concatenate([[0], np.cumsum(y)])
    total = (x_tail[above] + only_x) / x + (y_head[above] + only_y) / y
    return plain, float((1 / total).sum())


def _slices(batches: Iterator[pa.RecordBatch], texts: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most SLICE code points and 1,000 rows (one row at least)."""
    for batch in batches:
        at, size, lengths = 0, 0, pc.fill_null(pc.utf8_length(batch.column(texts)), 0).to_pylist()
        for k, n in enumerate(lengths):
            if k > at and (size + n > SLICE or k - at >= 1000):
                yield batch.slice(at, k - at)
                at, size = k, 0
            size += n
        if at < batch.num_rows:
            yield batch.slice(at)


def text_hash(text_col: str) -> Column:
    return F.xxhash64(text_or_empty(text_col))


def sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, th, fp1, fp2, n, bands, sketch, plain): hash of the text, fingerprint of the words, number of distinct shingles,
    bucket keys, one byte of each register; the same of the signature without weights, null where no shingle repeats."""
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), text_hash(text_col).alias("th"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in _slices(batches, 1):
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            prints = [xxhash.xxh3_128_digest(" ".join(w).encode("utf-8", "surrogatepass")) for w in words]
            both = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
            owner, h, weight = weighted(*shingles(words, hashes), len(words))
            n = np.bincount(owner, minlength=len(words))
            sig = signatures(owner, h, weight, len(words))
            keys, sketch = band_keys(sig), sketch_of(sig)
            bands, plain = [k if c else k[:0] for k, c in zip(keys, n)], [None] * len(words)
            for k, again, own in unweighted(owner, h, weight, len(words)):
                bands[k] = np.concatenate([bands[k], again[again != keys[k]]])
                plain[k] = own.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(n.astype(np.int64)),
                 pa.array(bands, pa.list_(pa.int64())), pa.array([x.tobytes() for x in sketch], pa.binary()), pa.array(plain, pa.binary())],
                ["doc_id", "text", "th", "fp1", "fp2", "n", "bands", "sketch", "plain"])
    return source.mapInArrow(
        run, f"doc_id {kind}, text string, th long, fp1 long, fp2 long, n long, bands array<long>, sketch binary, plain binary")


def verify(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Of ``pairs`` (a, b) of nodes those whose texts are similar enough. ``nodes`` has rid and text."""
    pairs = materialize(pairs.select("a", "b"), "near-pairs")
    needed = materialize(pairs.select("a").union(pairs.select("b")).distinct(), "near-needed")
    texts = nodes.select("rid", "text").join(sized(needed), F.col("rid") == F.col("a"), "left_semi")
    joined = (pairs.join(texts.select(F.col("rid").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("rid").alias("b"), F.col("text").alias("text_b")), "b")
              .select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held = WordHashes(), {}

        def own(node: int, text: str) -> tuple[np.ndarray, np.ndarray]:
            if node not in held:
                if len(held) >= 64:
                    held.pop(next(iter(held)))
                _, h, w = weighted(*shingles([words_of(text)], hashes), 1)
                order = np.argsort(h)
                held[node] = h[order], w[order]
            return held[node]
        for batch in _slices(batches, 3):
            a, b, text_a, text_b = (batch.column(i).to_pylist() for i in range(4))
            links = [max(similarity(own(i, s), own(j, t))) >= threshold for i, j, s, t in zip(a, b, text_a, text_b)]
            yield batch.select([0, 1]).filter(pa.array(links, pa.bool_()))
    return materialize(joined.mapInArrow(run, "a long, b long"), "near-links")


def _in_blocks(rows: DataFrame, group: str) -> DataFrame:
    """A group of more than BLOCK rows as pairs of blocks (i <= j): each row goes to the pairs that its block is in."""
    mine = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    return (rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
            .drop("other", "blocks").repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", "rid"))


def _groups(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[tuple[list[dict], bool]]:
    """Rows of each (group, i, j) of the sorted stream, and whether it is a block with itself."""
    now, rows = None, []
    for batch in small(batches):
        for row in batch.to_pylist():
            key = (row[group], row["i"], row["j"])
            if key != now:
                if len(rows) > 1:
                    yield rows, now[1] == now[2]
                now, rows = key, []
            rows.append(row)
    if len(rows) > 1:
        yield rows, now[1] == now[2]


def _candidates(rows: list[dict], same: bool, threshold: float) -> list[tuple[float, int, int]]:
    """(estimate, row, row) of the pairs in different components whose sketches allow one of the similarities (and for the plain one
    their sizes), likest first. Six standard errors below the threshold are let through."""
    least = threshold - 6 * (threshold * (1 - threshold) / REGISTERS) ** 0.5
    sketch = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint8).reshape(len(rows), -1)
    repeats = any(r["plain"] for r in rows)
    plain = np.frombuffer(b"".join(r["plain"] or r["sketch"] for r in rows), np.uint8).reshape(len(rows), -1) if repeats else sketch
    comp, n, mine = (np.array([r[c] for r in rows]) for c in ("comp", "n", "mine"))
    found = []
    for a in range(len(rows) - 1):
        b = np.arange(a + 1, len(rows))
        b = b[comp[b] != comp[a]]
        if not same:
            b = b[mine[b] != mine[a]]
        if len(b):
            alike = (sketch[b] == sketch[a]).mean(axis=1)
            if repeats:
                fits = np.minimum(n[b], n[a]) >= np.maximum(n[b], n[a]) * (threshold - 1e-9)
                alike = np.maximum(alike, np.where(fits, (plain[b] == plain[a]).mean(axis=1), 0))
            found += [(float(e), a, int(k)) for e, k in zip(alike, b) if e >= least]
    return sorted(found, key=lambda x: -x[0])


class _Union(dict):
    """Union-find over component labels."""

    def root(self, x: int) -> int:
        while self.setdefault(x, x) != x:
            self[x] = x = self[self[x]]
        return x


def _near_in_buckets(rows: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) that join, bucket by bucket, the rows whose sketches are near, as a forest: at most a row less than the bucket has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, same in _groups(batches, "key"):
            union, edges = _Union(), []
            for _, a, b in _candidates(group, same, threshold):
                a, b = group[a]["rid"], group[b]["rid"]
                x, y = union.root(a), union.root(b)
                if x != y:
                    union[x] = y
                    edges.append((a, b))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])
    return rows.mapInArrow(run, "a long, b long")


def _links_in_groups(rows: DataFrame, threshold: float) -> DataFrame:
    """Verified links that join different components of a group, likest pairs first: a pair whose components are joined
    already needs no check."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for group, same in _groups(batches, "grp"):
            union, edges, held = _Union(), [], {}

            def own(k: int) -> tuple[np.ndarray, np.ndarray]:
                if k not in held:
                    _, h, w = weighted(*shingles([words_of(group[k]["text"])], hashes), 1)
                    order = np.argsort(h)
                    held[k] = h[order], w[order]
                return held[k]
            for _, a, b in _candidates(group, same, threshold):
                x, y = union.root(group[a]["comp"]), union.root(group[b]["comp"])
                if x != y and max(similarity(own(a), own(b))) >= threshold:
                    union[x] = y
                    edges.append((group[a]["rid"], group[b]["rid"]))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])
    return rows.mapInArrow(run, "a long, b long")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), class_size, n_shingles; th (hash of its text), comp (the class's own number)."""
    signed = materialize(sign(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()), "near-signed")
    copies = materialize(signed.groupBy("fp1", "fp2").agg(F.min("rid").alias("rid")), "near-copies")
    nodes = signed.join(copies.select("rid"), "rid", "left_semi") if copies.count() > 1_000_000 else \
        signed.join(F.broadcast(copies.select("rid")), "rid", "left_semi")
    members = nodes.select("rid", "n", F.explode("bands").alias("key"))
    heads = members.groupBy("key").agg(F.min("rid").alias("head"), F.count("*").alias("c")).where("c > 1")
    shared = materialize(members.join(heads.select("key", "head"), "key"), "near-buckets")
    star = materialize(shared.where("rid != head").select(F.col("head").alias("a"), F.col("rid").alias("b")).distinct(), "near-stars")
    # one candidate a row first; the others only where that leaves two rows apart
    links = verify(star.groupBy("b").agg(F.min("a").alias("a")), signed, threshold)
    apart = star
    placed = components(links).select(F.col("node").alias("at"), "label")
    for end in ("a", "b"):
        apart = (apart.join(placed, F.col(end) == F.col("at"), "left")
                 .withColumn(f"of_{end}", F.coalesce("label", end)).drop("at", "label"))
    links = materialize(links.union(verify(apart.where("of_a != of_b"), signed, threshold)), "near-star-links")
    first = components(links)

    # what the stars leave apart: members of one bucket in different components
    placed = (shared.join(first, F.col("rid") == F.col("node"), "left")
              .select("key", "rid", F.coalesce("label", "rid").alias("comp")))
    mixed = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"))
             .where("lo != hi").select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    open_ = (placed.join(mixed, "key")
             .join(nodes.select(F.col("rid").alias("__r"), "n", "sketch", "plain"), F.col("rid") == F.col("__r")).drop("__r"))
    near = materialize(_near_in_buckets(_in_blocks(open_, "key"), threshold), "near-estimated")
    groups = components(near).select(F.col("node").alias("rid"), F.col("label").alias("grp"))
    sizes = groups.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = (groups.join(sizes, "grp").join(first, F.col("rid") == F.col("node"), "left")
            .select("grp", "blocks", F.col("rid").alias("__r"), F.coalesce("label", "rid").alias("comp"))
            .join(signed.select("rid", "n", "sketch", "plain", "text"), F.col("rid") == F.col("__r")).drop("__r"))
    rest = materialize(_links_in_groups(_in_blocks(rows, "grp"), threshold), "near-rest")
    links = materialize(links.union(rest), "near-all-links")
    labels = components(links)

    keyed = (signed.select("doc_id", "th", "fp1", "fp2", "n")
             .join(copies, ["fp1", "fp2"])
             .join(labels, F.col("rid") == F.col("node"), "left")
             .select("doc_id", "th", "n", F.coalesce("label", "rid").alias("comp")))
    keyed = materialize(keyed, "near-classes")
    classes = keyed.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return keyed.join(classes, "comp").select("doc_id", "class_id", "class_size", F.col("n").alias("n_shingles"), "th", "comp")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id (of rows that share that id, one); all columns stay."""
    found = near_classes(docs, id_col, text_col, threshold)
    first = found.where("class_size > 1").groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("first"))
    grouped = found.where("class_size > 1").select("doc_id", "th", "comp").distinct().join(first, "comp")
    own_id, own_th, own_class, own_keep = (unused(docs, c) for c in ("__id", "__th", "__class", "__keep"))
    grouped = materialize(grouped.select(
        F.col("doc_id").alias(own_id), F.col("th").alias(own_th), F.col("comp").alias(own_class),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))).alias(own_keep)), "near-grouped")
    match = docs[id_col].eqNullSafe(F.col(own_id)) & (text_hash(text_col) == F.col(own_th))
    alone = docs.join(sized(grouped), match, "left_anti")
    keepers = (docs.join(sized(grouped.where(own_keep)), match, "inner").dropDuplicates([own_class])
               .select(*[docs[c] for c in docs.columns]))
    return alone.unionByName(keepers)
