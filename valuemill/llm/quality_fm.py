"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): the pairwise term
costs rank * features by the sum-of-squares identity. Training fits a bounded sample of labelled rows in
numpy on the driver; scoring reads every whole text in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuemill.llm.common import blocks, utf8_block, word_hashes

#: Word buckets; rank; labelled rows that training takes at most, of each label; passes; learning rate; weight decay.
BUCKETS, RANK, SAMPLE, EPOCHS, RATE, DECAY, BATCH = 1 << 12, 8, 6000, 12, 0.02, 1e-5, 256
#: Few rows are passed over more often, until there were this many steps.
STEPS = 400
#: Statistics and the edges of their bins; each bin is a feature.
_SHARE = (0.0005, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8)
STATISTICS = {
    "distinct_words": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97), "repeats": _SHARE, "upper": _SHARE, "digits": _SHARE, "symbols": _SHARE,
    "bars": _SHARE, "marks": _SHARE, "stops": _SHARE, "wide": _SHARE, "spaces": _SHARE, "lines": _SHARE, "symbol_run": _SHARE,
    "word_length": (2, 3, 3.5, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 15), "log_words": (1, 2, 3, 4, 5, 6, 7, 8, 9, 10), "log_chars": (2, 3, 4, 5, 6, 7, 8, 9, 10, 11),
}
_SLOT = np.cumsum([0] + [len(e) + 1 for e in STATISTICS.values()])
FEATURES = BUCKETS + int(_SLOT[-1])


def _bytes_in(ranges: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in ranges]] = True
    return out


_KINDS = {"upper": _bytes_in("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _bytes_in("0123456789"), "symbols": _bytes_in("#$%&*@^~<>={}[]\\+_/"),
          "bars": _bytes_in("|"), "marks": _bytes_in("!?"), "stops": _bytes_in(".,;:"), "spaces": _bytes_in(" \t\r\x0b\x0c"), "lines": _bytes_in("\n")}
_WIDE = np.arange(256) >= 0xC0
_HARD = _KINDS["symbols"] | _KINDS["bars"] | _KINDS["marks"]


def features(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) entries of a block of documents, sorted by document.

    A text's word entries have length 1 together, its statistics one entry of 1 each. A text without words has only statistics.
    """
    n = len(offsets) - 1
    hashes, doc, starts, ends = word_hashes(data, offsets, lower=True)
    words = np.bincount(doc, minlength=n).astype(np.float64)
    some, size = np.maximum(words, 1), np.maximum(np.diff(offsets), 1).astype(np.float64)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets]) / size

    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    again = (doc[1:] == doc[:-1]) & (hashes[1:] == hashes[:-1])
    hard = _HARD[data]
    last_hard = hard[ends - 1] if len(ends) else np.zeros(0, bool)
    stats = {"distinct_words": np.bincount(d[fresh], minlength=n) / some, "repeats": np.bincount(doc[1:][again], minlength=n) / some,
             **{k: share(v[data]) for k, v in _KINDS.items()}, "wide": share(_WIDE[data]), "symbol_run": np.bincount(doc[last_hard], minlength=n) / some,
             "word_length": np.bincount(doc, ends - starts, minlength=n) / some, "log_words": np.log1p(words), "log_chars": np.log1p(chars)}
    stat = np.stack([BUCKETS + _SLOT[i] + np.searchsorted(edges, stats[name], side="right") for i, (name, edges) in enumerate(STATISTICS.items())], axis=1)
    cell, count = np.unique(doc * BUCKETS + (hashes >> np.uint64(52)).astype(np.int64), return_counts=True)
    who = cell // BUCKETS
    value = np.log1p(count)
    value = value / np.sqrt(np.maximum(np.bincount(who, value ** 2, minlength=n), 1e-12))[who]
    at = np.concatenate([who, np.repeat(np.arange(n), stat.shape[1])])
    which = np.concatenate([cell % BUCKETS, stat.ravel()])
    amount = np.concatenate([value, np.ones(stat.size)])
    order = np.argsort(at, kind="stable")
    return at[order], which[order], amount[order]


class FactorisationMachine:
    def __init__(self, seed: int = 7):
        self.bias, self.linear = 0.0, np.zeros(FEATURES)
        self.factors = np.random.default_rng(seed).normal(0, 0.02, (FEATURES, RANK))

    def raw(self, n: int, doc: np.ndarray, which: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid and the sums over features of each factor: linear in the entries."""
        out = self.bias + np.bincount(doc, self.linear[which] * x, minlength=n)
        sums = np.empty((n, RANK))
        for f in range(RANK):
            vx = self.factors[which, f] * x
            sums[:, f] = np.bincount(doc, vx, minlength=n)
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(doc, vx ** 2, minlength=n))
        return out, sums

    def score(self, *entries) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*entries)[0], -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> FactorisationMachine:
        """Adam on the log loss, both labels with equal weight in total."""
        rng, step = np.random.default_rng(seed), 0
        weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
        params = [self.linear, self.factors]
        m, s = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(1, len(rows))))):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                chosen = order[at:at + BATCH]
                n = len(chosen)
                doc = np.repeat(np.arange(n), [len(rows[i][0]) for i in chosen])
                which = np.concatenate([rows[i][0] for i in chosen]).astype(np.int64)
                x = np.concatenate([rows[i][1] for i in chosen]).astype(np.float64)
                raw, sums = self.raw(n, doc, which, x)
                slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) * weight[chosen] / n
                each = slope[doc] * x
                grads = [np.bincount(which, each, minlength=FEATURES) + DECAY * self.linear, np.empty_like(self.factors)]
                for f in range(RANK):
                    grads[1][:, f] = np.bincount(which, each * (sums[doc, f] - self.factors[which, f] * x), minlength=FEATURES) + DECAY * self.factors[:, f]
                step += 1
                self.bias -= RATE * float(slope.sum())
                for p, g, a, b in zip(params, grads, m, s, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        return self


def _chars(docs: DataFrame, text: str):
    """The table's own n_chars, else the characters of the text."""
    counted = F.length(F.coalesce(F.col(text), F.lit("")))
    return (F.coalesce(F.col("n_chars").cast("double"), counted.cast("double")) if "n_chars" in docs.columns else counted.cast("double")).alias("chars")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE, text: str = "text") -> FactorisationMachine | None:
    """Fit on at most ``sample`` rows of each label, those with the least hash of the id, held-out ids never.

    Labels that are null, or neither 0 nor 1, are left out; None if one of the two labels is missing.
    """
    known = (labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col(target).isin(0, 1))
             .select(F.col("doc_id").alias("label_id"), F.col(target).cast("int").alias("label")).withColumn("turn", F.xxhash64("label_id")))
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy("turn", "label_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    ids = picked.select("label_id", "label").distinct()  # at most 2 * sample rows
    rows = docs.select("doc_id", F.col(text).alias("text"), _chars(docs, text)).join(F.broadcast(ids), F.col("doc_id") == F.col("label_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_block(batch.column(1))
            chars = batch.column(2).to_numpy(zero_copy_only=False)
            for i, j in blocks(offsets):
                doc, which, x = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], chars[i:j])
                cut = np.searchsorted(doc, np.arange(1, j - i))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(3).slice(i, j - i), pa.array([a.astype("<u2").tobytes() for a in np.split(which, cut)], pa.binary()),
                                                  pa.array([a.astype("<f4").tobytes() for a in np.split(x, cut)], pa.binary())], ["id", "label", "which", "x"])

    got = rows.select("doc_id", "text", "chars", "label").mapInArrow(run, "id long, label int, which binary, x binary").toArrow()
    got = got.sort_by([("id", "ascending"), ("label", "ascending")])
    y = got.column("label").to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return None
    entries = [(np.frombuffer(a, "<u2"), np.frombuffer(b, "<f4")) for a, b in zip(got.column("which").to_pylist(), got.column("x").to_pylist(), strict=True)]
    return FactorisationMachine().fit(entries, y)


def scored(docs: DataFrame, model: FactorisationMachine | None, threshold: float = 0.7, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs``, its columns ``keep`` (all), fm_score (0 to 1) and fm_predicted (1 from ``threshold`` on); columns of those names are replaced.

    Null and empty texts are scored by their statistics; without a model the score is 0.5. Equal texts with equal n_chars have equal scores.
    """
    from pyspark.sql.types import DoubleType, IntegerType, StructType

    docs = docs.drop("fm_score", "fm_predicted")
    kept = docs.select(*[F.col(f"`{c}`") for c in keep or docs.columns])
    if model is None:
        return kept.withColumns({"fm_score": F.lit(0.5), "fm_predicted": F.lit(int(threshold <= 0.5))})
    schema = StructType(list(kept.schema.fields)).add("fm_score", DoubleType()).add("fm_predicted", IntegerType())
    names, width = schema.fieldNames(), len(kept.columns)
    own = kept.columns.index(text) if text in kept.columns else width + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_block(batch.column(own))
            chars = batch.column(width).to_numpy(zero_copy_only=False)
            scores = [model.score(j - i, *features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], chars[i:j])) for i, j in blocks(offsets)]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names)

    # Read by position: their names may be those of other columns.
    more = [] if own < width else [F.col(text).alias("fm_text")]
    return docs.select(*[F.col(f"`{c}`") for c in kept.columns], _chars(docs, text).alias("fm_chars"), *more).mapInArrow(run, schema)
