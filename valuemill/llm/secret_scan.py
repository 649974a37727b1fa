"""Secret scans: patterns of known secrets, and sliding-window Shannon entropy over candidate strings.

A candidate string is a maximal run of characters of a class (hexadecimal, base 64) that is at least a window
long. Windows slide along all candidates of a block together: one character leaves, one enters, the counts and the
sum of ``c * log2(c)`` follow. Windows above the class's entropy are joined to spans; spans that an allow-list
knows are left out. Pattern spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuemill.llm.common import blocks, utf8_block

# ---------------------------------------------------------------------------
# The patterns of base spans and their least lengths.
# ---------------------------------------------------------------------------
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")
_HEX = b"0123456789abcdef"


@dataclass(frozen=True)
class EntropyClass:
    """Windows of ``window`` characters of ``alphabet`` with ``bits`` of entropy or more and a character of each set in ``needs``."""

    kind: str
    alphabet: bytes
    window: int
    bits: float
    needs: tuple[bytes, ...] = ()


_DIGITS, _LOWER, _UPPER = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Long words of prose have neither digits nor capitals inside, so they are no candidates of either class.
CLASSES = (EntropyClass("entropy_hex", _DIGITS + b"abcdefABCDEF", 20, 3.0, (_DIGITS, b"abcdefABCDEF")),
           EntropyClass("entropy_base64", _UPPER + _LOWER + _DIGITS + b"+/=", 24, 4.0, (_DIGITS, _LOWER, _UPPER)))
#: A candidate string that one of these finds is known not to be a secret: listed alphabets, examples, paths in lower case.
ALLOWED = (rb"0123456789abcdef|abcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ", rb"EXAMPLE", rb"^[a-z0-9]*(?:/[a-z0-9]+){2,}/?$")
#: What stands before a published checksum.
ALLOWED_BEFORE = rb"(?:sha(?:1|256|384|512)|md5)[:-]$"
#: Windows of one candidate that are slid in one row of the count matrix, rows of that matrix.
_STEPS, _ROWS = 64, 4096
_UNIT = 1 << 32


def _runs(member: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of members, of at least ``least`` bytes, none across two documents."""
    size = len(member)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(member & (edge[:-1] | ~np.r_[False, member[:-1]]))
    ends = np.flatnonzero(member & (edge[1:] | ~np.r_[member[1:], False])) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def _hot_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, c: EntropyClass) -> tuple[np.ndarray, np.ndarray]:
    """(start, run) of each window over the entropy, by start. Sums are whole numbers, so where a long run is cut changes nothing."""
    index = np.zeros(256, np.int64)
    index[list(c.alphabet)] = np.arange(len(c.alphabet))
    n = np.arange(c.window + 1)
    term = np.rint(np.where(n > 0, n * np.log2(np.maximum(n, 1)), 0) * _UNIT).astype(np.int64)
    most = int(np.floor((np.log2(c.window) - c.bits) * c.window * _UNIT))  # entropy >= bits: the sum of c log2 c is at most this
    needed = []
    for s in c.needs:
        has = np.zeros(256, np.int32)
        has[list(s)] = 1
        needed.append(np.r_[0, np.cumsum(has[data], dtype=np.int64)])
    windows = ends - starts - c.window + 1
    pieces = -(-windows // _STEPS)
    run = np.repeat(np.arange(len(starts)), pieces)
    first = (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * _STEPS
    begin, count = starts[run] + first, np.minimum(_STEPS, windows[run] - first)
    order = np.argsort(-count, kind="stable")
    at, of = [], []
    for i in range(0, len(order), _ROWS):
        part = order[i:i + _ROWS]
        b, left, rows = begin[part], count[part], np.arange(len(part))
        counts = np.zeros((len(part), len(c.alphabet)), np.int64)
        np.add.at(counts, (np.repeat(rows, c.window), index[data[(b[:, None] + np.arange(c.window)).ravel()]]), 1)
        total = term[counts].sum(1)
        for t in range(int(left[0]) if len(left) else 0):
            live = int(np.searchsorted(-left, -t, side="left"))  # rows are by falling number of windows
            b_t, r = b[:live] + t, rows[:live]
            if t:
                out, new = index[data[b_t - 1]], index[data[b_t + c.window - 1]]
                k = counts[r, out]
                total[:live] += term[k - 1] - term[k]
                counts[r, out] = k - 1
                k = counts[r, new]
                total[:live] += term[k + 1] - term[k]
                counts[r, new] = k + 1
            hot = total[:live] <= most
            for sums in needed:
                hot &= sums[b_t + c.window] > sums[b_t]
            if hot.any():
                at.append(b_t[hot])
                of.append(run[part[:live][hot]])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, of = np.concatenate(at), np.concatenate(of)
    order = np.argsort(at)
    return at[order], of[order]


class Scanner:
    def __init__(self, classes: tuple[EntropyClass, ...] = CLASSES, allowed: tuple[bytes, ...] = ALLOWED, allowed_before: bytes | None = ALLOWED_BEFORE):
        self.classes, self.allowed = classes, [re.compile(p) for p in allowed]
        self.before = re.compile(allowed_before) if allowed_before else None
        self.rank = {k: i for i, k in enumerate([*BASE_KINDS, *[c.kind for c in classes]])}

    def _base(self, raw: bytes) -> list[tuple[str, int, int]]:
        found = []
        if b":" in raw or b"=" in raw:
            found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
        if b"AKIA" in raw:
            found += [("access", m.start(), m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= ACCESS_LEAST]
        return found

    def _known(self, raw: bytes, start: int, end: int) -> bool:
        return any(p.search(raw, start, end) if not p.pattern.startswith(b"^") else p.match(raw[start:end]) for p in self.allowed) or bool(
            self.before and self.before.search(raw[max(0, start - 16):start]))

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, int, int]]]:
        """For each document of a block its spans (kind, start, end) in code points, by start, then kind, then end."""
        raw, ends = data.tobytes(), offsets.tolist()
        found = [self._base(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)]

        def put(kind: str, start: np.ndarray, end: np.ndarray) -> None:
            own = np.searchsorted(offsets, start, side="right") - 1
            for d, s, e in zip(own.tolist(), (start - offsets[own]).tolist(), (end - offsets[own]).tolist(), strict=True):
                found[d].append((kind, s, e))

        member = np.zeros(256, bool)
        member[list(_HEX)] = True
        put("hex", *_runs(member[data], offsets, HEX_LEAST))
        base = [list(own) for own in found]
        for c in self.classes:
            member = np.zeros(256, bool)
            member[list(c.alphabet)] = True
            starts, stops = _runs(member[data], offsets, c.window)
            at, run = _hot_windows(data, starts, stops, c)
            new = np.r_[True, (run[1:] != run[:-1]) | (at[1:] > at[:-1] + c.window)] if len(at) else np.zeros(0, bool)
            begin, end = at[new], at[np.r_[new[1:], True]] + c.window if len(at) else at
            run = run[new]
            keep = [not self._known(raw, s, e) for s, e in zip(starts[run].tolist(), stops[run].tolist(), strict=True)]
            begin, end = begin[keep], end[keep]
            own = np.searchsorted(offsets, begin, side="right") - 1
            shift = offsets[own]
            # What a pattern has already reported whole is not reported again.
            fresh = [not any(s0 <= s and e <= e0 for _, s0, e0 in base[d])
                     for d, s, e in zip(own.tolist(), (begin - shift).tolist(), (end - shift).tolist(), strict=True)]
            put(c.kind, begin[fresh], end[fresh])
        heads = None
        for d, spans in enumerate(found):
            if spans:
                if heads is None:
                    heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                at = ends[d]
                points = [(k, int(heads[at + s] - heads[at]), int(heads[at + e] - heads[at])) for k, s, e in spans]
                found[d] = sorted(points, key=lambda x: (x[1], self.rank[x[0]], x[2]))
        return found


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", classes: tuple[EntropyClass, ...] = CLASSES,
         allowed: tuple[bytes, ...] = ALLOWED, allowed_before: bytes | None = ALLOWED_BEFORE) -> DataFrame:
    """id and ``spans`` (array of kind, start, end; code points, end exclusive) of every row of ``docs``.

    A null or empty text has no spans; ids may be null or repeat, equal rows give equal results, other columns are ignored
    whatever their names; an empty table gives no rows. Each text is scanned whole, in one narrow pass.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed, allowed_before)
        for batch in batches:
            data, offsets = utf8_block(batch.column(1))
            for i, j in blocks(offsets):
                rows = scanner.scan(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in own] for own in rows]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(spans, pa.list_(span))], [id_col, "spans"])

    return docs.select(F.col(id_col), F.col(text)).mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<kind: string, start: int, end: int>>")


def is_base(span: Column) -> Column:
    return span["kind"].isin(*BASE_KINDS)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, mask: str = "[secret]", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and text with every span replaced by ``mask``; spans that overlap are one. A null text stays null."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            column = batch.column(1)
            data, offsets = utf8_block(column)
            for i, j in blocks(offsets):
                rows, texts = scanner.scan(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), column.slice(i, j - i).to_pylist()
                for d, own in enumerate(rows):
                    pieces, at = [], 0
                    for _, s, e in own:
                        if s >= at:
                            pieces += [texts[d][at:s], mask]
                        at = max(at, e)
                    if own:
                        texts[d] = "".join(pieces) + texts[d][at:]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(texts, pa.string())], [id_col, "text"])

    return docs.select(F.col(id_col), F.col(text)).mapInArrow(run, f"`{id_col}` {kind}, text string")
