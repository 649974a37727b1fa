"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut into chunks by a rolling hash. A chunk met again, in whatever document, is not encoded again: its words between the
first and the last white space keep their ids. Where two chunks meet, the text is encoded anew as it stands, from the word before
the join to the word after it. If the ids are those that the words have alone, the join is exact; else the window is widened, until
its outermost words on both sides have their own ids again; in the end it is the whole text.

The pass is narrow: no text moves. A Python worker keeps its caches over all its tasks, within a stated number of bytes;
losing a worker loses only its caches.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from valuemill.llm.common import Generations, blocks, rolling_cuts, utf8_block

#: Mean chunk of 2 ** CHUNK_BITS bytes; bytes of text worked on at once.
CHUNK_BITS, WORK_BITS = 10, 19
#: Bytes that a worker's caches may take, entries weighed with what Python spends on them: half for words, half for chunks.
CACHE_BYTES = 64 << 20
#: A longer word is encoded but not kept.
WORD_KEPT = 256
_OVERHEAD = 250
#: Words of one call of the library.
TOGETHER = 64
_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")
_SPACES = frozenset(b" \t\n\r\x0b\x0c")


class WordEncoder:
    """Ids of words that white space separates, each encoded once while it is kept.

    ``separable``: whether the tokenizer's steps leave words alone across white space. If not, only whole texts may be encoded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = self.tokenizer.decoder is None  # then decoding joins the tokens by blanks
        self.separable = self._separable()
        self.words = Generations(CACHE_BYTES // 4)  # two generations are held
        self._tokens = None

    def _separable(self) -> bool:
        split, normal = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        if split is None:
            return False
        parts = ["a", "Word", "it's", "é", "é", "́", "123", "日本", ".", "<|endoftext|>"]
        normalise = normal.normalize_str if normal is not None else str
        for space in (" ", "\t", "\n", "\r", "\x0b", "\x0c", "  ", " \n"):
            for a in parts:
                for b in parts:
                    pieces = [p for p, _ in split.pre_tokenize_str(normalise(a + space + b))]
                    if pieces != [p for w in (a, b) for p, _ in split.pre_tokenize_str(normalise(w))]:
                        return False
        return True

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit integers."""
        return [np.asarray(ids, "<u4").tobytes() if len(ids) > 32 else array("I", ids).tobytes() for ids in self.library([t.decode() for t in texts])]

    def _alone(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of each word alone. Where words are separable, many are encoded in one text and told apart by where their tokens begin."""
        if not self.separable:
            yield from self.packed(words)
            return
        for i in range(0, len(words), 1 << 14):
            texts = [w.decode() for w in words[i:i + (1 << 14)]]
            groups = [texts[j:j + TOGETHER] for j in range(0, len(texts), TOGETHER)]
            for group, e in zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
                ends = np.cumsum([len(w) + 1 for w in group])
                at = np.searchsorted([a for a, _ in e.offsets], ends, side="left").tolist()
                ids = array("I", e.ids).tobytes()
                for a, b in zip([0, *at], at, strict=False):
                    yield ids[4 * a:4 * b]

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def decoded(self, ids: list[bytes]) -> list[bytes]:
        """The text of each document's ids."""
        if not self.plain:
            return [self.decode(np.frombuffer(x, "<u4").tolist()).encode() for x in ids]
        if self._tokens is None:
            self._tokens = pa.array([self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())], pa.string())
        ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
        tokens = self._tokens.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), tokens), " ").cast(pa.binary()).to_pylist()

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of each word alone."""
        found, missing = {}, []
        for w in words:
            if (known := self.words.get(w)) is None:
                missing.append(w)
            else:
                found[w] = known
        for w, ids in zip(missing, self._alone(missing), strict=True):
            found[w] = ids
            if len(w) <= WORD_KEPT:
                self.words.put(w, ids, len(w) + len(ids) + _OVERHEAD)
        return found

    def agrees(self, window: bytes, known: bytes) -> bool:
        """Whether the ids that words have together are those that they have alone."""
        return window == known


def _word_before(data: bytes, begin: int, at: int) -> int:
    """Start of the last word of data[begin:at]; ``begin`` if there is none."""
    room = 64
    while True:
        low = max(begin, at - room)
        part = data[low:at].rstrip()
        words = part.rsplit(None, 1)
        start = low + len(part) - len(words[-1]) if words else low
        if low == begin or start > low:
            return start if words else begin
        room *= 4


def _word_after(data: bytes, at: int, end: int) -> int:
    """End of the first word of data[at:end]; ``end`` if there is none."""
    room = 64
    while True:
        high = min(end, at + room)
        part = data[at:high].lstrip()
        words = part.split(None, 1)
        stop = high - len(part) + len(words[0]) if words else high
        if high == end or stop < high:
            return stop if words else end
        room *= 4


class ChunkEncoder:
    def __init__(self, path: str):
        self.words, self.chunks = WordEncoder(path), Generations(CACHE_BYTES // 4)
        self.made = self.reused = self.repaired = self.widened = self.whole = 0

    def _chunk(self, text: bytes) -> list:
        """[length of the open word at the left, closed words, length of the open word at the right]."""
        words = text.split()
        if words and len(words[0]) == len(text):
            return [len(text), None, 0]
        head = len(words.pop(0)) if words and text[0] not in _SPACES else 0
        tail = len(words.pop()) if words and text[-1] not in _SPACES else 0
        return [head, words, tail]

    def encode(self, data: bytes, cuts: np.ndarray, ends: list[int]) -> list[tuple[bytes, bytes]]:
        """(ids, decoded text) of each document of a block; ``ends``: where documents end."""
        if not self.words.separable:
            self.whole += len(ends)
            ids = self.words.packed([data[a:b] for a, b in zip([0, *ends], ends, strict=False)])
            return list(zip(ids, self.words.decoded(ids), strict=True))
        docs, new, seams, at, k = [], {}, {}, 0, 0
        cuts = cuts.tolist()
        for end in ends:
            # Pieces: a chunk's record, or (start, end, whether chunks meet there) of a word that no chunk holds closed.
            pieces, begin, open_at, met = [], at, at, False
            while at < end:
                text, start, at, k = data[at:cuts[k]], at, cuts[k], k + 1
                record = self.chunks.get(text) or new.get(text)
                if record is None:
                    self.made += 1
                    new[text] = record = self._chunk(text)
                else:
                    self.reused += 1
                if record[1] is not None:
                    if met or record[0]:
                        pieces.append((open_at, start + record[0], met))
                    pieces.append(record)
                    open_at = at - record[2]
                met = True
            if open_at < end:
                pieces.append((open_at, end, open_at < start))
            while k < len(cuts) and cuts[k] <= end:
                k += 1
            docs.append((pieces, begin, end))
            for p in pieces:
                if isinstance(p, tuple) and p[2]:
                    low, high = _word_before(data, begin, p[0]), _word_after(data, p[1], end)
                    seams[begin, p[0]] = data[low:high], data[low:p[0]].strip(), data[p[1]:high].strip()
        words = {data[p[0]:p[1]] for pieces, _, _ in docs for p in pieces if isinstance(p, tuple)}.union(
            *(r[1] for r in new.values() if r[1]), *((a, b) for _, a, b in seams.values()))
        words.discard(b"")
        known = self.words.learn(words)
        known[b""] = b""
        for text, r in new.items():
            if r[1] is not None:
                r[1] = b"".join(known[w] for w in r[1])
                self.chunks.put(text, r, len(text) + len(r[1]) + _OVERHEAD)
        windows = list({w for w, _, _ in seams.values()})
        together = dict(zip(windows, self.words.packed(windows), strict=True))
        ids = []
        for pieces, begin, end in docs:
            wrong = []
            for p in pieces:
                if isinstance(p, tuple) and p[2]:
                    self.repaired += 1
                    window, before, after = seams[begin, p[0]]
                    if not self.words.agrees(together[window], known[before] + known[data[p[0]:p[1]]] + known[after]):
                        wrong.append((p[0] - begin, p[1] - begin))
            ids.append(self._widened(data[begin:end], wrong) if wrong else b"".join(known[data[p[0]:p[1]]] if isinstance(p, tuple) else p[1] for p in pieces))
        return list(zip(ids, self.words.decoded(ids), strict=True))

    def _widened(self, text: bytes, joins: list[tuple[int, int]]) -> bytes:
        """Ids of a text whose ``joins`` disagree: windows around them grow until their outermost words have their own ids."""
        spans = [m.span() for m in _WORD.finditer(text)]
        known = self.words.learn({text[a:b] for a, b in spans})
        alone, starts, last = [known[text[a:b]] for a, b in spans], [a for a, _ in spans], len(spans) - 1
        done: list[tuple[int, int, bytes]] = []
        todo = [(int(np.searchsorted(starts, p)) - 1, int(np.searchsorted(starts, max(q, p + 1)))) for p, q in joins]
        while todo:
            low, high = todo.pop(0)
            step = 1
            while True:
                self.widened += 1
                low, high = max(low, 0), min(high, last)
                if low == 0 and high == last:
                    self.whole += 1
                    return self.words.packed([text])[0]
                # A window that reaches an end of the text takes the white space there, and needs no agreement at that side.
                ids = self.words.packed([text[0 if low == 0 else spans[low][0]:len(text) if high == last else spans[high][1]]])[0]
                left, right = b"" if low == 0 else alone[low], b"" if high == last else alone[high]
                if len(ids) >= len(left) + len(right) and self.words.agrees(ids[:len(left)], left) and self.words.agrees(ids[len(ids) - len(right):], right):
                    break
                low, high, step = low - step, high + step, 2 * step
            if done and low < done[-1][1]:  # it reaches into the window before: both are one
                todo.insert(0, (min(done.pop()[0], low), high))
            else:
                done.append((low, high, ids[len(left):len(ids) - len(right)]))
        out, at = [], 0
        for low, high, ids in done:
            out += [*alone[at:low + (low > 0)], ids]
            at = high + (high == last)
        return b"".join(out + alone[at:])


@lru_cache(maxsize=1)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder, so one set of caches, for each worker."""
    return ChunkEncoder(path)


def word_encoder(path: str) -> WordEncoder:
    return chunk_encoder(path).words


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, ids (binary: little-endian unsigned 32-bit integers) and decoded of every row.

    ``path``: a tokenizer file of the ``tokenizers`` library, readable on every executor. A null text
    counts as empty and has no ids; ids may be null or repeat; other columns are ignored. With a tokenizer that
    joins text across white space every text is encoded whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path)
        for batch in batches:
            data, offsets = utf8_block(batch.column(1))
            for i, j in blocks(offsets, 1 << WORK_BITS):
                part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                found = encoder.encode(part.tobytes(), rolling_cuts(part, own, CHUNK_BITS, room_bits=WORK_BITS + 1), own[1:].tolist())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array([len(x) // 4 for x, _ in found], pa.int64()),
                    pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.binary()).cast(pa.string())],
                    [id_col, "n_tokens", "ids", "decoded"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary, decoded string")


def decode(ids: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """id and text of rows with ``ids`` as ``encode`` returns them; null ids give an empty text."""
    kind = ids.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            texts = [encoder.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return ids.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, text string")
