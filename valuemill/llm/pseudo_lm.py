"""Masked pseudo-likelihood: a window network predicts every word from both sides.

A word is one of 32 x 32 classes of its hash. The network sums position-wise vectors of the two words to
either side, and gives the first digit of the middle word's class, then the second given the first. It is
trained on the whole corpus, every word masked once: a hash of id and text deals each document to a round and, within it,
to a training part of about PART_BYTES, so parts follow the corpus and not its files or the cores that read them. Each part takes
gradient steps over the words of its documents in the order of their hashes, from the round's common weights; the weights of
all parts are averaged by the words they saw and start the next round. Sums of weights meet in groups of FAN tasks, so no task or driver takes all.
A word's probability is that of its class times its share of the class's words, counted over the whole corpus.
A document's score is the sum of the log-probabilities of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuemill.llm.common import BLOCK_BYTES, blocks, utf8_block, word_hashes
from valuemill.session import materialize

#: Values of a digit, classes, words to either side, hidden units.
DIGIT, SIDE, HIDDEN = 32, 2, 16
CLASSES = DIGIT * DIGIT
#: Rounds of averaging, words of a gradient step, its rate, sums of weights that meet in one group.
ROUNDS, BATCH, RATE, FAN = 2, 256, 0.3, 64
#: Bytes of text of a training part (in the mean: documents are dealt by hash).
PART_BYTES = 1 << 22
_SHAPES = ((2 * SIDE, CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, DIGIT), (DIGIT,), (HIDDEN, DIGIT), (DIGIT, DIGIT))
_STEP = 1 << 14
#: Where the vectors of each place around begin.
_SIDES = np.arange(2 * SIDE) * (CLASSES + 1)
#: At most so many of the most frequent words have their shares sent to every task (16 bytes each); all others are joined.
FREQUENT = 1 << 18
#: Shares are whole numbers of 1 / UNIT, so their sums don't depend on the order in which they meet.
UNIT = 1 << 24


class WindowNetwork:
    """Vectors by position and class (the last class: outside the document), hidden bias, first digit, second digit."""

    def __init__(self, packed: bytes | None = None):
        if packed is None:
            rng = np.random.default_rng(11)
            self.params = [(rng.normal(0, 0.1, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for s in _SHAPES]
        else:
            flat, at, self.params = np.frombuffer(packed, "<f4"), 0, []
            for s in _SHAPES:
                self.params.append(flat[at:at + int(np.prod(s))].reshape(s).copy())
                at += int(np.prod(s))

    def packed(self) -> bytes:
        return np.concatenate([p.ravel() for p in self.params]).astype("<f4").tobytes()

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.params]).astype(np.float64)

    def _hidden(self, around: np.ndarray) -> np.ndarray:
        vectors, bias = self.params[:2]
        total = vectors[0][around[:, 0]] + bias
        for k in range(1, 2 * SIDE):
            total += vectors[k][around[:, k]]
        return np.tanh(total, out=total)

    def log_probabilities(self, around: np.ndarray, word: np.ndarray) -> np.ndarray:
        _, _, w1, b1, w2, given = self.params
        out = np.empty(len(word), np.float32)
        for at in range(0, len(word), _STEP):
            rows, own = around[at:at + _STEP], word[at:at + _STEP]
            first, second, n = own // DIGIT, own % DIGIT, np.arange(len(own))
            hidden = self._hidden(rows)
            one = hidden @ w1 + b1
            two = hidden @ w2 + given[first]
            chosen = one[n, first] + two[n, second]
            for x in (one, two):  # tanh bounds the inputs, so exp stays in range
                np.exp(x, out=x)
            out[at:at + _STEP] = chosen - np.log(one.sum(axis=1)) - np.log(two.sum(axis=1))
        return out

    def learn(self, around: np.ndarray, word: np.ndarray, rate: float) -> None:
        """One gradient step; words run along the last axis, so sums over classes and units are sums of whole rows."""
        vectors, bias, w1, b1, w2, given = self.params
        first, second, n = word // DIGIT, word % DIGIT, np.arange(len(word))
        flat = (around + _SIDES).T.ravel()
        table = vectors.reshape(-1, HIDDEN)
        near = np.take(table, flat, axis=0).reshape(2 * SIDE, len(word), HIDDEN)
        hidden = np.ascontiguousarray((near.sum(axis=0) + bias).T)
        np.tanh(hidden, out=hidden)
        scale = np.float32(rate / np.sqrt(len(word)))
        digits = np.zeros((DIGIT, len(word)), np.float32)
        digits[first, n] = 1
        one, two = w1.T @ hidden + b1[:, None], w2.T @ hidden + given.T @ digits
        for x, y in ((one, first), (two, second)):
            x -= x.max(axis=0)
            np.exp(x, out=x)
            x /= x.sum(axis=0)
            x[y, n] -= 1
        slope = w1 @ one + w2 @ two
        slope *= 1 - hidden * hidden
        slope *= scale
        one *= scale
        two *= scale
        w1 -= hidden @ one.T
        b1 -= one.sum(axis=1)
        w2 -= hidden @ two.T
        given -= digits @ two.T
        bias -= slope.sum(axis=1)
        # Rows of the vectors that the words around name, each changed once by the sum of its slopes.
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        named = flat[order]
        begin = np.flatnonzero(np.diff(named, prepend=-1))
        rows = named[begin]
        changed = np.take(table, rows, axis=0)
        changed -= np.add.reduceat(np.take(np.ascontiguousarray(slope.T), order % len(word), axis=0), begin, axis=0)
        np.minimum(changed, 8, out=changed)
        table[rows] = np.maximum(changed, -8, out=changed)
        for p in (bias, w1, b1, w2, given):
            np.minimum(p, 8, out=p)
            np.maximum(p, -8, out=p)


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(classes around, class, document, hash) of each word of a block."""
    hashes, doc, _, _ = word_hashes(data, offsets, lower=True)
    word = (hashes >> np.uint64(54)).astype(np.int64)
    padded = np.concatenate([np.full(SIDE, CLASSES), word, np.full(SIDE, CLASSES)])
    owner = np.concatenate([np.full(SIDE, -1), doc, np.full(SIDE, -1)])
    n, around = len(word), np.empty((len(word), 2 * SIDE), np.int64)
    for k, step in enumerate((*range(-SIDE, 0), *range(1, SIDE + 1))):
        at = slice(SIDE + step, SIDE + step + n)
        around[:, k] = np.where(owner[at] == doc, padded[at], CLASSES)
    return around, word, doc, hashes


def pieces(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(part, texts) of rows sorted by part: the next rows of a part up to ``most`` bytes or just above. The rows alone say where pieces end, not the batches that bring them."""
    own, held, size = None, [], 0
    for batch in batches:
        part = batch.column(0).to_numpy()
        text = batch.column(1).cast(pa.large_string())
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < len(part):
            if held and part[i] != own:
                yield own, pa.concat_arrays(held)
                held, size = [], 0
            own, stop, before = int(part[i]), int(np.searchsorted(part, part[i], side="right")), int(ends[i - 1]) if i else 0
            j = min(stop, int(np.searchsorted(ends, before + most - size)) + 1)
            held.append(text.slice(i, j - i))
            size += int(ends[j - 1]) - before
            if size >= most:
                yield own, pa.concat_arrays(held)
                held, size = [], 0
            i = j
    if held:
        yield own, pa.concat_arrays(held)


def learned(batches: Iterator[pa.RecordBatch], start: bytes, rate: float) -> tuple[int, np.ndarray]:
    """(words, sum of weights times words) of the parts of these rows, each trained on all its words from ``start``."""
    seen, total, net, own, words, k = 0, 0.0, WindowNetwork(start), None, 0, 0
    for part, texts in pieces(batches):
        if part != own:
            seen, total = seen + words, total + words * net.flat()
            net, own, words, k = WindowNetwork(start), part, 0, 0
        around, word, _, _ = windows(*utf8_block(texts))
        masked = np.random.default_rng(k).permutation(len(word))
        for at in range(0, len(word), BATCH):
            rows = masked[at:at + BATCH]
            net.learn(around[rows], word[rows], rate)
        words, k = words + len(word), k + 1
    return seen + words, total + words * net.flat()


def _added(rows: DataFrame) -> DataFrame:
    """Sums of groups of FAN tasks."""
    def add(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("task")
        total = sum(np.frombuffer(x, "<f8") for x in batch.column("weights").to_pylist())
        return pa.table({"task": pa.array([batch.column("task")[0].as_py() // FAN], pa.int64()), "words": pa.array([sum(batch.column("words").to_pylist())], pa.int64()),
                         "weights": pa.array([total.tobytes()], pa.binary())})
    return rows.groupBy(F.floor(F.col("task") / FAN)).applyInArrow(add, "task long, words long, weights binary")


def train(docs: DataFrame, rounds: int = ROUNDS, text: str = "text", id_col: str = "doc_id") -> bytes:
    """The network's weights, from all documents; the same, up to rounding, however rows lie in files and partitions. Without words they are the initial ones.

    Each text moves once, to its part. Null and empty texts have no words. Rows equal in id and text are of one part, which is read as a stream.
    """
    weights = WindowNetwork().packed()
    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text)).alias("deal"), F.col(text).alias("text")).where("octet_length(text) > 0")
    rows = rows.withColumn("turn", F.pmod("deal", F.lit(rounds)))
    sizes = dict(rows.groupBy("turn").agg(F.sum(F.octet_length("text"))).collect())  # one row a round
    for turn in range(rounds):
        def run(batches: Iterator[pa.RecordBatch], start: bytes = weights, rate: float = RATE / (1 + turn)) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            seen, total = learned(batches, start, rate)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["task", "words", "weights"])

        parts = -(-sizes.get(turn, 0) // PART_BYTES)
        if not parts:
            continue
        own = rows.where(F.col("turn") == turn).select(F.pmod(F.shiftrightunsigned("deal", 20), F.lit(parts)).alias("part"), "deal", "text")
        own = own.repartition("part").sortWithinPartitions("part", "deal").select("part", "text")
        found = _added(_added(own.mapInArrow(run, "task long, words long, weights binary"))).collect()
        if found:
            found.sort(key=lambda r: r["task"])
            words = sum(r["words"] for r in found)
            weights = (sum(np.frombuffer(r["weights"], "<f8") for r in found) / words).astype("<f4").tobytes()
    return weights


def word_shares(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n, share): how often each word occurs in all documents, and the log of its share of the words of its class, in units of 1 / UNIT; a word is named by its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_block(batch.column(0))
            for i, j in blocks(offsets):
                words, n = np.unique(word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower=True)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    counts = materialize(docs.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    of = F.shiftrightunsigned("word", 54)
    totals = counts.groupBy(of.alias("of")).agg(F.sum("n").alias("total"))  # CLASSES rows
    return counts.join(F.broadcast(totals), of == F.col("of")).select("word", "n", F.round(F.log(F.col("n") / F.col("total")) * UNIT).cast("long").alias("share"))


def frequent(shares: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(least, words in order, shares): the words that occur ``least`` times or more, ``least`` being the first power of two for which they are ``most`` or fewer."""
    digits = F.length(F.bin("n"))
    have = dict(shares.groupBy(digits.alias("digits")).count().collect())  # at most 63 rows
    least = 1
    while sum(c for d, c in have.items() if 2 ** (d - 1) >= least) > most:
        least *= 2
    found = shares.where(F.col("n") >= least).select("word", "share").toArrow()
    words, share = found.column("word").to_numpy(), found.column("share").to_numpy()
    order = np.argsort(words)
    return least, words[order], share[order]


def scored(docs: DataFrame, weights: bytes, id_col: str = "doc_id", text: str = "text", shares: DataFrame | None = None) -> DataFrame:
    """id, mean_log_probability, pseudo_perplexity, log_probability (sum over all words) and n_words of every row.

    With ``shares`` (``word_shares`` of a corpus that has these documents) probabilities are of words, else of their classes.
    Null texts count as empty: no words, 0, and null for the mean and the perplexity. Other columns are ignored; equal texts have equal scores.
    Shares of the FREQUENT words are sent to every task; every other word of a row is joined with its share and summed by row.
    """
    least, known, known_share = frequent(shares, FREQUENT) if shares is not None else (1, None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = WindowNetwork(weights)
        for batch in batches:
            data, offsets = utf8_block(batch.column(1))
            for i, j in blocks(offsets):
                around, word, doc, hashes = windows(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                log = net.log_probabilities(around, word).astype(np.float64)
                total, other, others = np.bincount(doc, log, minlength=j - i), np.zeros(0, np.int64), np.zeros(j - i, np.int64)
                share = np.zeros(j - i)
                if known is not None and len(word):
                    name = hashes.view(np.int64)
                    at = np.minimum(np.searchsorted(known, name), max(len(known) - 1, 0))
                    found = known[at] == name if len(known) else np.zeros(len(name), bool)
                    share = np.bincount(doc[found], known_share[at[found]], minlength=j - i)
                    other, others = name[~found], np.bincount(doc[~found], minlength=j - i)
                ends = np.concatenate([[0], np.cumsum(others)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.bincount(doc, minlength=j - i), pa.int64()), pa.array(total), pa.array(share.astype(np.int64)),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.array(other, pa.int64()))], ["id", "n", "log", "share", "other"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, n long, log double, share long, other array<long>")
    total = F.col("log")
    if shares is not None:
        # Written, so that a row has a name, its file and place, which is the same for every run of a task.
        rows = materialize(rows, "pseudo-scores").select("*", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
        rest = shares.where(F.col("n") < least).select("word", F.col("share").alias("rest"))
        sums = rows.select("file", "place", F.explode("other").alias("word")).join(rest, "word").groupBy("file", "place").agg(F.sum("rest").alias("rest"))
        rows = rows.drop("other").join(sums, ["file", "place"], "left")
        total = total + (F.col("share") + F.coalesce("rest", F.lit(0))) / UNIT
    rows = rows.select("id", "n", total.alias("total")).withColumn("mean", F.when(F.col("n") > 0, F.col("total") / F.col("n")))
    return rows.select(F.col("id").alias(id_col), F.col("mean").alias("mean_log_probability"), F.exp(-F.col("mean")).alias("pseudo_perplexity"), F.col("total").alias("log_probability"), F.col("n").alias("n_words"))
