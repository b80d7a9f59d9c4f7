"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + <w, x> + 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): the sum-of-squares identity
gives all pairwise interactions in time linear in the document. x holds the
document's distinct words (hashed, log counts, unit length) and one bin of each
statistic. The machine is fitted by mini-batch Adam on at most ``FIT_ROWS``
labelled rows (those with the smallest id hashes); every row is scored, in one pass
without a shuffle.

Null texts count as empty and are scored by their statistics; rows with a null id are scored and not held out;
labels that name no document or have a null label are ignored, the larger of two labels
of one document counts. Without any label every score is 0.5. Repeated rows get equal scores.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices, small

#: Labelled rows that the fit uses, at most.
FIT_ROWS = 10_000
WORD_BITS = 15
FACTORS = 8
BINS = 12
EPOCHS = 12
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
STATISTICS = ("upper", "lower", "digit", "space", "pipe", "bang", "symbol", "stop", "comma", "newline", "high", "quote",
              "word_length", "distinct", "lines", "repeated_lines", "words", "n_chars")
WORDS = 1 << WORD_BITS
SIZE = WORDS + len(STATISTICS) * BINS

_CLASSES = np.zeros((256, 12))
for _k, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"|", b"!",
                           b"%#$&*@^~=+<>{}[]\\/_", b".?", b",;:", b"\n", bytes(range(128, 256)), b"\"'()-")):
    _CLASSES[list(_set), _k] = 1


class _Hashed(dict):
    """Word -> bucket, kept for up to 200,000 words."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) & (WORDS - 1)
        if len(self) < 200_000:
            self[word] = h
        return h


def featurise(texts: list[str | None], n_chars: list[int | None], hashed: _Hashed) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of each text: its buckets, their weights; and the table of statistics."""
    ids, weights, stats = [], [], np.zeros((len(texts), len(STATISTICS)))
    for row, (text, chars) in enumerate(zip(texts, n_chars)):
        text = text or ""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        words = text.split()
        buckets = np.fromiter(map(hashed.__getitem__, words), np.int64, len(words))
        own, counts = np.unique(buckets, return_counts=True)
        w = np.log1p(counts)
        if len(w):
            w /= np.sqrt((w * w).sum())
        ids.append(own)
        weights.append(w)
        lines = text.split("\n")
        stats[row, :12] = np.bincount(raw, minlength=256) @ _CLASSES / max(len(raw), 1)
        stats[row, 12:] = (len(text) / max(len(words), 1), len(own) / max(len(words), 1) ** 0.8, np.log1p(len(lines)),
                           1 - len(set(lines)) / len(lines), np.log1p(len(words)), np.log1p(max(chars if chars is not None else len(text), 0)))
    return ids, weights, stats


@dataclass
class Machine:
    """A fitted machine; ``edges`` are the inner borders of each statistic's bins."""
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    edges: np.ndarray

    def parts(self) -> tuple:
        return self.bias, self.linear, self.factors, self.edges

    def rows(self, ids: list[np.ndarray], weights: list[np.ndarray], stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse matrix (indices, values, row starts): words, then one bin a statistic."""
        n, s = len(ids), len(STATISTICS)
        bins = np.stack([np.searchsorted(self.edges[k], stats[:, k]) for k in range(s)], 1) if n else np.zeros((0, s), int)
        bins = WORDS + bins + np.arange(s) * BINS
        starts = np.concatenate([[0], np.cumsum([len(x) + s for x in ids])]).astype(np.int64)
        index, value = np.empty(starts[-1], np.int64), np.empty(starts[-1])
        for i, (x, w) in enumerate(zip(ids, weights)):
            a, b = starts[i], starts[i + 1]
            index[a:b - s], value[a:b - s] = x, w
            index[b - s:b], value[b - s:b] = bins[i], 0.25
        return index, value, starts

    def margins(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margin of each row by the sum-of-squares identity, and its factor sums."""
        if len(starts) < 2:
            return np.zeros(0), np.zeros((0, FACTORS))
        at = starts[:-1]
        vx = self.factors[index] * value[:, None]
        sums = np.add.reduceat(vx, at, axis=0)
        squares = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), at)
        linear = np.add.reduceat(self.linear[index] * value, at)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums

    def scores(self, texts: list[str | None], n_chars: list[int | None], hashed: _Hashed) -> np.ndarray:
        margin, _ = self.margins(*self.rows(*featurise(texts, n_chars, hashed)))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(ids: list[np.ndarray], weights: list[np.ndarray], stats: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = 128,
        rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Logistic loss, mini-batch Adam with sparse rows gathered densely a batch."""
    rng = np.random.default_rng(seed)
    if not len(labels):
        return Machine(0.0, np.zeros(SIZE), np.zeros((SIZE, FACTORS)), np.zeros((len(STATISTICS), BINS - 1)))
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    mean = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    machine = Machine(float(np.log(mean / (1 - mean))), np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, FACTORS)), edges)
    index, value, starts = machine.rows(ids, weights, stats)
    table = np.concatenate([machine.linear[:, None], machine.factors], 1)
    m, v, step = np.zeros_like(table), np.zeros_like(table), 0
    steps = max(epochs * -(-len(labels) // batch), 300)
    order = np.empty(0, int)
    while step < steps:
        if len(order) == 0:
            order = rng.permutation(len(labels))
        rows, order = np.sort(order[:batch]), order[batch:]
        spans = [np.arange(starts[r], starts[r + 1]) for r in rows]
        own = np.concatenate(spans)
        lengths = np.array([len(s) for s in spans])
        at = np.concatenate([[0], np.cumsum(lengths)])
        idx, val = index[own], value[own]
        machine.linear, machine.factors = table[:, 0], table[:, 1:]
        margin, sums = machine.margins(idx, val, at)
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]) / len(rows)
        e = np.repeat(error, lengths) * val
        vx = table[idx, 1:] * val[:, None]
        grads = np.concatenate([e[:, None], e[:, None] * (np.repeat(sums, lengths, axis=0) - vx)], 1)
        used, place = np.unique(idx, return_inverse=True)
        g = np.stack([np.bincount(place, grads[:, c], len(used)) for c in range(FACTORS + 1)], 1) + decay * table[used]
        step += 1
        m[used] = 0.9 * m[used] + 0.1 * g
        v[used] = 0.99 * v[used] + 0.01 * g * g
        table[used] -= rate * m[used] / (np.sqrt(v[used]) + 1e-6)
        machine.bias -= rate * float(error.sum())
    machine.linear, machine.factors = table[:, 0].copy(), table[:, 1:].copy()
    return machine


def fold_of(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo FOLDS."""
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of labelled rows (id, text, n_chars, label), a few rows at a time."""
    hashed = _Hashed()
    for b in small(batches):
        ids, weights, stats = featurise(b.column(1).to_pylist(), b.column(2).to_pylist(), hashed)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(3).cast(pa.int32()), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
             pa.array([x.astype(np.float32) for x in weights], pa.list_(pa.float32())), pa.array(list(stats), pa.list_(pa.float64()))],
            ["id", "y", "ids", "weights", "stats"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          chars_col: str = "n_chars", fit_rows: int = FIT_ROWS) -> Machine:
    """Fit on labelled rows outside the held-out fold."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold_of(id_col) != HELD_OUT))
              .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id").limit(fit_rows))
    chosen = materialize(chosen, "quality-labels")
    # one row an id, so that at most ``fit_rows`` rows arrive below: of rows that share an id the one whose text comes first
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(chars_col).cast("long").alias("chars"))
              .join(F.broadcast(chosen), F.col("id") == F.col("__id"))
              .groupBy("id").agg(F.min(F.struct("text", "chars", "__y")).alias("row")).select("id", "row.*"))
    kind = sample.schema["id"].dataType.simpleString()

    rows = sample.select("id", "text", "chars", "__y").mapInArrow(
        vectors, f"id {kind}, y int, ids array<int>, weights array<float>, stats array<double>").toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    stats = np.array(rows.column("stats").to_pylist(), float).reshape(-1, len(STATISTICS))
    ids = [np.array(x.values.to_numpy(), np.int64) for x in rows.column("ids")]
    weights = [np.array(x.values.to_numpy(), float) for x in rows.column("weights")]
    return fit(ids, weights, stats, rows.column("y").to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(machine.parts())
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold_of(id_col) == HELD_OUT, F.lit(False)).alias("held_out"),
                         F.col(text_col).alias("text"), F.col(chars_col).cast("long").alias("n_chars"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, hashed = Machine(*sent.value), _Hashed()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = machine.scores(part.column(2).to_pylist(), part.column(3).to_pylist(), hashed)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.float64()), pa.array((found >= THRESHOLD).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_quality(docs: DataFrame, machine: Machine, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` without the rows that score below the threshold; all columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(machine.parts())

    @F.arrow_udf("boolean")
    def good(texts: pa.Array, chars: pa.Array) -> pa.Array:
        machine, hashed = Machine(*sent.value), _Hashed()
        return pa.concat_arrays([pa.array(machine.scores(t.to_pylist(), c.to_pylist(), hashed) >= THRESHOLD, pa.bool_())
                                 for t, c in zip(slices(texts, 256), slices(chars, 256))])
    return docs.where(good(F.col(text_col), F.col(chars_col).cast("long")))
