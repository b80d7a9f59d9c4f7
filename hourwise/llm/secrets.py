"""Secret scan: fixed formats, plus high-entropy strings found by a sliding window.

Every candidate (a run of token characters) is walked once by a window of
``WINDOW`` characters. The window's character counts and the sum of c*log2(c)
change by one character in and one out, so its Shannon entropy costs O(1) a
step. Windows above the threshold of their character class (hex digits, or
letters and digits) merge into one span. Spans that an allow-list pattern
covers, or that a fixed format already reports, are suppressed.

Null and empty texts have no spans; offsets count code points; repeated rows
are scanned one by one. Runs in one pass over the table, without a shuffle.
"""
from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small, unused

# Fixed formats of the contract.
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

RUN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{20,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Bits a character above which a window of the class counts as random. Log2(20) = 4.32 is the most a window can have.
THRESHOLDS = {"hex": 3.0, "base64": 3.6}
#: Strings that look random and are not secret: UUIDs, words joined by separators, rows of one sequence.
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?:[A-Za-z]{2,}[-_/=+])+[A-Za-z]*",
    r"[-_=+/.]*\d+(?:[-_=+/.]\d+)*[-_=+/.]*",
    r"(?i:0123456789(?:abcdef|abcdefghijklmnopqrstuvwxyz)?|abcdefghijklmnopqrstuvwxyz(?:0123456789)?)+",
    r"[A-Za-z0-9+/_=-]*EXAMPLE[A-Za-z0-9+/_=-]*",
)

_XLOGX = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]  # one more: a character comes in before one leaves
_HEX = frozenset("0123456789abcdefABCDEF")


def entropy_spans(s: str, window: int = WINDOW, thresholds: dict[str, float] = THRESHOLDS) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``s`` that are random for their class. A window is of class hex
    if it has hex digits only; it must hold a digit and a letter in any class."""
    xlogx = _XLOGX if window == WINDOW else [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    counts: dict[str, int] = {}
    total = 0.0
    digits = letters = hexes = 0
    log_w = math.log2(window)
    spans: list[tuple[int, int]] = []
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += xlogx[n + 1] - xlogx[n]
        digits += c.isdigit()
        letters += c.isalpha()
        hexes += c in _HEX
        if i >= window:
            c = s[i - window]
            n = counts[c]
            counts[c] = n - 1
            total -= xlogx[n] - xlogx[n - 1]
            digits -= c.isdigit()
            letters -= c.isalpha()
            hexes -= c in _HEX
        if i >= window - 1 and digits and letters:
            bits = log_w - total / window
            if bits >= thresholds["hex" if hexes == window else "base64"]:
                start = i - window + 1
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((start, i + 1))
    return spans


class Scanner:
    """Finds the spans of one text. ``allow``: patterns; a span all of whose characters lie in a match is suppressed."""

    def __init__(self, allow: Iterable[str] = ALLOW, window: int = WINDOW, thresholds: dict[str, float] | None = None):
        self.allow = re.compile("|".join(f"(?:{p})" for p in allow)) if allow else None
        self.window, self.thresholds = window, thresholds or THRESHOLDS

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the fixed formats."""
        found = []
        low = text.encode("utf-8", "surrogatepass").lower()
        if any(k in low for k in KEYWORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        return found

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans and added ones, each as (start, kind, end)."""
        base, added = self.base(text), []
        runs = [(m.start(), m[0]) for m in RUN.finditer(text)]
        for at, run in runs:
            base += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(run)]
        base.sort()
        for at, run in runs:
            for m in CANDIDATE.finditer(run):
                allowed = None
                for a, b in entropy_spans(m[0], self.window, self.thresholds):
                    lo, hi = at + m.start() + a, at + m.start() + b
                    if any(s <= lo and hi <= e for s, _, e in base):
                        continue
                    if allowed is None:
                        allowed = [x.span() for x in self.allow.finditer(m[0])] if self.allow else []
                    if not any(x <= a and b <= y for x, y in allowed):
                        added.append((lo, 3, hi))
        return base, added


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW,
         window: int = WINDOW, thresholds: dict[str, float] | None = None) -> DataFrame:
    """One row per document: counts of each kind, the digest of the base spans and all spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(allow, window, thresholds)
        for batch in small(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base, added = scanner.spans(text or "")
                n = [0, 0, 0]
                for _, k, _ in base:
                    n[k] += 1
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + added)), len(added)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")


def mask(docs: DataFrame, text_col: str = "text", allow: tuple[str, ...] = ALLOW, window: int = WINDOW,
         thresholds: dict[str, float] | None = None, chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with each found span of the text replaced by ``[SECRET]``; overlapping spans merge; a null text stays null. All
    columns stay; ``chars_col``, if there, is the masked text's length where the text changed."""

    @F.arrow_udf("string")
    def hide(texts: pa.Array) -> pa.Array:
        scanner = Scanner(allow, window, thresholds)

        def one(t: str | None) -> str | None:
            if not t:
                return t
            base, added = scanner.spans(t)
            if not base and not added:
                return t
            out, at = [], 0
            for a, _, b in sorted(base + added):
                if b <= at:
                    continue
                if a >= at:
                    out += [t[at:a], "[SECRET]"]
                at = b
            return "".join(out) + t[at:]
        return pa.concat_arrays([pa.array(map(one, some.to_pylist()), pa.string()) for some in slices(texts)])
    masked, kind = unused(docs, "__masked"), dict(docs.dtypes).get(chars_col)
    out = docs.withColumn(masked, hide(F.col(text_col)))
    if kind:
        out = out.withColumn(chars_col, F.when(F.col(masked) != F.col(text_col), F.length(masked).cast(kind)).otherwise(F.col(chars_col)))
    return out.withColumn(text_col, F.col(masked)).drop(masked).select(*docs.columns)
