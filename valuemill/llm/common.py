"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemill.session import sf_path, ship_package

#: Bytes of text hashed at once; a longer document is hashed whole.
BLOCK_BYTES = 1 << 21
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; ships the package first, so Python tasks find it."""
    ship_package(spark)
    return spark.read.parquet(sf_path(sf_dir, name))


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def utf8_block(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:] \
        if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES):
    """Ranges [i, j) of documents with at most ``most`` bytes each, or one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _byte_codes(lower: bool) -> np.ndarray:
    codes = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_MULTIPLIER))
    if lower:
        codes[ord("A"):ord("Z") + 1] = codes[ord("a"):ord("z") + 1]
    return codes


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier modulo 2^64 and those of its inverse."""
    def run(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)
    return run(_MULTIPLIER), run(pow(_MULTIPLIER, -1, 1 << 64))


#: The white space that separates words: blank and bytes 9 to 13.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """(hash of each word, document of each word, word start, word end) of a block of documents.

    A word is a run of bytes other than blank and 9 to 13; A-Z count as a-z if ``lower``. The hash
    is a 64-bit polynomial over random byte codes, taken from one running sum over the block.
    """
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    first = np.zeros(size + 1, bool)
    first[offsets[:-1]] = True
    first[size] = True
    solid = ~_SPACE[data]
    before = np.empty(size, bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:size]))
    after = np.empty(size, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    room = 1 << max(21, int(size).bit_length())
    power, inverse = _powers(room)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_byte_codes(lower)[data] * power[:size], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def rolling_cuts(data: np.ndarray, offsets: np.ndarray, bits: int, window: int = 16, room_bits: int = 21) -> np.ndarray:
    """Ends of content-defined chunks of a block of UTF-8 documents, every document's end among them.

    A chunk ends where the rolling hash of its last ``window`` bytes has ``bits`` zero bits, so equal
    passages are cut alike wherever they stand; never inside a character or a window that spans two documents.
    Blocks of up to 2 ** room_bits bytes share one table of powers.
    """
    size = len(data)
    if size < window:
        return offsets[1:]
    power, inverse = _powers(1 << max(room_bits, int(size).bit_length()))
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_byte_codes(False)[data] * power[:size], out=sums[1:])
    low = (sums[window:] - sums[:-window]) * inverse[:size + 1 - window] * np.uint64(_MULTIPLIER)
    ends = np.flatnonzero(low >> np.uint64(64 - bits) == 0) + window
    ends = ends[ends < size]
    ends = ends[(data[ends] & 0xC0) != 0x80]
    begun = offsets[np.searchsorted(offsets, ends, side="left") - 1]
    return np.union1d(ends[ends - begun >= window], offsets[1:])


class Generations:
    """A dictionary of bounded size: what was not asked for during a whole generation is forgotten."""

    def __init__(self, most: int):
        self.most, self.young, self.old, self.held = most, {}, {}, 0

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value, weight: int = 1) -> None:
        if self.held >= self.most:
            self.young, self.old, self.held = {}, self.young, 0
        self.young[key] = value
        self.held += weight
