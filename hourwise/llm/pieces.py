"""Encoding and decoding with merge-type SentencePiece vocabularies.

Encoding. Spaces become U+2581 and one goes before the text. A score-ordered agenda then
holds the adjacent pairs of symbols that a piece of the vocabulary joins: the pair of the highest score,
leftmost of equals, is merged and its two new neighbours enter. Symbols that are no piece fall back to
byte pieces. No piece may hold U+2581 after another character (checked when the vocabulary is read), so no merge
crosses the start of a word: texts are cut there, and a worker keeps a bounded number of words encoded. The words
of an Arrow batch that it does not hold are merged together, their agendas being the rows of a matrix; a long word has a heap of its own.

Check. Those words are encoded by the sentencepiece library in one call too; a difference ends the job.

Decoding joins the pieces: U+2581 is a space, the first one goes, control pieces are empty, runs of byte
pieces are decoded as UTF-8 with U+FFFD for a byte that fits nowhere.

Null texts count as empty: the begin and end ids alone. Repeated rows are encoded one by one, null ids pass
through, an empty table gives none. A word without spaces of n characters takes n log n steps. Only id and text are read.
"""
from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytelevel import held_or_fresh, little
from .common import small, worker_state

SPACE = "▁"
#: Words that a worker keeps encoded, twice over and those of a batch, and the longest kept.
CACHE = 300_000
WORD = 64
#: Words of up to so many symbols are merged in a matrix of so many rows.
LISTED, ROWS = 48, 4096
NONE = 1 << 30
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")


class PieceModel:
    """One vocabulary file, read by the library: scores, byte pieces, control pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = SentencePieceProcessor(model_file=path)
        p = self.library
        self.begin, self.end, self.unknown = p.bos_id(), p.eos_id(), p.unk_id()
        self.ids: dict[str, int] = {}
        self.order: dict[str, float] = {}
        self.bytes: list[bytes] = []  # what an id stands for
        self.kind = bytearray()  # 0 text, 1 byte, 2 control or unknown
        self.byte_ids = [p.unk_id()] * 256
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            if p.is_unused(i):
                raise ValueError("a vocabulary without unused pieces is expected")
            if p.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif p.is_control(i) or p.is_unknown(i):
                self.bytes.append(b"")
            else:
                if re.search(f"[^{SPACE}]{SPACE}", piece):
                    raise ValueError("a piece goes on beyond the start of a word")
                self.ids[piece] = i
                self.order[piece] = -p.get_score(i)
                self.bytes.append(piece.replace(SPACE, " ").encode())
            self.kind.append(1 if p.is_byte(i) else 2 if self.bytes[-1] == b"" else 0)
        self.controls = frozenset(i for i, kind in enumerate(self.kind) if kind == 2)

        self._tables()

    def _tables(self) -> None:
        """Symbols of the characters and a hash table of the pairs that a piece joins: pair -> (place in score order, joined symbol)."""
        symbols = dict(self.ids)
        for piece in self.ids:
            for c in piece:
                symbols.setdefault(c, len(self.bytes) + len(symbols) - len(self.ids))
        self.pad, self.shift = 1 << 17, 18
        self.plain = len(self.bytes)  # symbols below are ids
        self.symbol = np.full(0x110000, -1, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i
        for b in range(128):  # characters of one byte that are no piece have their byte piece
            if self.symbol[b] < 0:
                self.symbol[b] = self.byte_ids[b]
        places = {score: k for k, score in enumerate(sorted(set(self.order.values())))}
        pairs = {symbols[piece[:k]] << self.shift | symbols[piece[k:]]: (places[self.order[piece]], i)
                 for piece, i in self.ids.items() for k in range(1, len(piece))
                 if piece[:k] in symbols and piece[k:] in symbols}
        self.bits = (4 * len(pairs)).bit_length()
        size, self.tries = 1 << self.bits, 1
        self.keys, self.place, self.joined = np.full(size, -1, np.int64), np.full(size, NONE, np.int32), np.zeros(size, np.int32)
        for home, (key, (place, i)) in zip(self._home(np.array(list(pairs), np.int64)).tolist(), pairs.items()):
            tries = 0
            while self.keys[(home + tries) % size] >= 0:
                tries += 1
            at = (home + tries) % size
            self.keys[at], self.place[at], self.joined[at] = key, place, i
            self.tries = max(self.tries, tries + 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Table slots of the pairs; a slot of another key's place NONE where no piece joins a pair."""
        keys = left.astype(np.int64) << self.shift | right
        home = self._home(keys)
        out = np.full(keys.shape, -1, np.int64)
        for k in range(self.tries):
            at = (home + k) & ((1 << self.bits) - 1)
            out = np.where(self.keys[at] == keys, at, out)
        return out

    def _places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        slots = self._slots(left, right)
        return np.where(slots >= 0, self.place[slots], NONE)

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, spaces as U+2581, as 32-bit little-endian numbers."""
        out = {w: self.packed(self.agenda(w)) for w in words if len(w) > LISTED}
        short = sorted((w for w in words if 0 < len(w) <= LISTED), key=len)
        for at in range(0, len(short), ROWS):
            out.update(self._matrix(short[at:at + ROWS]))
        return out

    def _matrix(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        lengths = np.array([len(w) for w in words])
        codes = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        width = int(lengths.max())
        inside = np.arange(width + 1) < lengths[:, None]
        symbols = np.full((len(words), width + 1), self.pad, np.int32)
        symbols[inside] = codes
        alone = (symbols < 0).any(axis=1)  # a character that falls back to several bytes
        for k in np.flatnonzero(alone).tolist():
            yield words[k], self.packed(self.agenda(words[k]))
        rows = np.flatnonzero(~alone)
        symbols = symbols[rows]
        agenda = self._places(symbols[:, :-1], symbols[:, 1:])
        columns = np.arange(width + 1)
        while len(rows):
            best = agenda.argmin(axis=1)  # the leftmost of equals
            open_ = agenda[np.arange(len(rows)), best] < NONE
            if not open_.all():
                done = symbols[~open_]
                used = done != self.pad
                ends = (4 * used.sum(axis=1).cumsum()).tolist()
                flat, odd = done[used].astype("<u4").tobytes(), (used & (done >= self.plain)).any(axis=1).tolist()
                for k, start, end, strange in zip(rows[~open_].tolist(), [0, *ends], ends, odd):
                    yield words[k], self.packed(self.agenda(words[k])) if strange else flat[start:end]
                rows, symbols, agenda, best = rows[open_], symbols[open_], agenda[open_], best[open_]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            joined = self.joined[self._slots(symbols[each, best], symbols[each, best + 1])]
            after = np.minimum(columns + (columns > best[:, None]), width)
            symbols = np.take_along_axis(symbols, after, 1)
            symbols[:, -1] = self.pad
            symbols[each, best] = joined
            agenda = np.take_along_axis(agenda, np.minimum(after[:, :-1], width - 1), 1)
            agenda[:, -1] = NONE
            if width > 1:
                agenda[each, best] = self._places(joined, symbols[each, best + 1])
                left = np.flatnonzero(best > 0)
                agenda[left, best[left] - 1] = self._places(symbols[left, best[left] - 1], joined[left])

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return little(array("I", ids)).tobytes()

    def agenda(self, word: str) -> list[int]:
        """Ids of a word of any length, spaces as U+2581. The agenda is a heap over linked symbols; entries whose symbols have changed since
        are skipped."""
        out: list[int] = []
        for symbol in self._heaped(word):
            known = self.ids.get(symbol)
            if known is not None:
                out.append(known)
            else:
                out.extend(self.byte_ids[b] for b in symbol.encode())
        return out

    def _heaped(self, word: str) -> list[str]:
        order, symbols, n = self.order.get, list(word), len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            score = order(symbols[i] + symbols[i + 1])
            if score is not None:
                heap.append((score, i, i + 1, 2))
        heapq.heapify(heap)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            joined = symbols[left] = a + b
            symbols[right] = ""
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                both = joined + symbols[nxt]
                score = order(both)
                if score is not None:
                    heapq.heappush(heap, (score, left, nxt, len(both)))
            prev = before[left]
            if prev >= 0:
                both = symbols[prev] + joined
                score = order(both)
                if score is not None:
                    heapq.heappush(heap, (score, prev, left, len(both)))
        return [symbol for symbol in symbols if symbol]

    def decode(self, ids: list[int]) -> bytes:
        """The text of the ids in UTF-8."""
        if not self.controls.isdisjoint(ids[1:-1]):
            return self._mended(ids)  # a control piece ends a run of bytes
        joined = b"".join(map(self.bytes.__getitem__, ids))
        first = next((i for i in ids if self.kind[i] != 2), None)
        if first is not None and self.kind[first] == 0 and joined[:1] == b" ":
            joined = joined[1:]
        try:
            joined.decode()
        except UnicodeDecodeError:
            return self._mended(ids)
        return joined

    def _mended(self, ids: list[int]) -> bytes:
        """As ``decode`` where byte pieces are no UTF-8: a byte that fits nowhere becomes U+FFFD."""
        out, run, started = [], bytearray(), False
        for i in [*ids, None]:
            if i is not None and self.kind[i] == 1:
                run += self.bytes[i]
                continue
            while run:
                started = True
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:size]).decode().encode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�".encode())
                del run[:size]
            if i is not None and self.kind[i] == 0:
                piece = self.bytes[i]
                out.append(piece if started or piece[:1] != b" " else piece[1:])
                started = True
        return b"".join(out)


def words(text: str) -> list[str]:
    """A text, not empty, cut into words that begin with U+2581."""
    plain = text.split(" ")
    if "" not in plain and SPACE not in text:
        return plain
    return [w[1:] for w in _WORDS.findall(SPACE + text.replace(" ", SPACE))]


class PieceEncoder:
    """Ids of texts, and a bounded number of words (without their first U+2581) kept encoded."""

    def __init__(self, path: str, cache: int = CACHE):
        self.model, self.cache = PieceModel(path), cache
        self.recent: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str | None], checked: bool = True) -> list[bytes]:
        """Ids of the texts of a batch, without begin and end ids, as 32-bit little-endian numbers. ``checked``: words met for the first time
        are compared with the library."""
        cut = [words(t) if t else [] for t in texts]
        fresh = held_or_fresh(set().union(*cut), self.recent, self.old)
        ids_of = self.model.encode_words([SPACE + w for w in fresh])
        if checked:
            self.check(fresh, ids_of)
        for word in fresh:
            self.recent[word] = ids_of[SPACE + word]
        out = [b"".join(map(self.recent.__getitem__, ws)) for ws in cut]
        for word in fresh:
            if len(word) > WORD:
                del self.recent[word]
        if len(self.recent) > self.cache:
            self.old, self.recent = self.recent, {}
        return out

    def check(self, fresh: list[str], ids_of: dict[str, bytes]) -> None:
        fresh = [w for w in fresh if w]
        for word, ids in zip(fresh, self.model.library.encode(fresh, num_threads=1)):
            if self.model.packed(ids) != ids_of[SPACE + word]:
                raise ValueError(f"the library encodes {word[:80]!r} in another way")


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", ends: bool = True,
                     checked: bool = True) -> DataFrame:
    """One row per document: doc_id, ids (binary, 32-bit little-endian), decoded (the text that the ids decode to, binary). ``ends``: with begin and
    end ids. ``checked``: the words encoded are compared with the library."""
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, decoded in _encoded(batches, model, ends, checked):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                                             ["doc_id", "ids", "decoded"])
    return source.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def _encoded(batches: Iterator[pa.RecordBatch], path: str, ends: bool,
             checked: bool) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[bytes]]]:
    """Small batches with the ids of their texts and what those decode to."""
    encoder = worker_state(f"pieces {path}", lambda: PieceEncoder(path))
    model = encoder.model
    begin, end = (np.array([i], "<u4").tobytes() if ends else b"" for i in (model.begin, model.end))
    for batch in small(batches):
        ids = [begin + x + end for x in encoder.encode(batch.column(1).to_pylist(), checked)]
        yield batch, ids, [model.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens (begin and end ids too), the digest of its ids and of the text that they decode to."""
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, decoded in _encoded(batches, model, True, True):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
