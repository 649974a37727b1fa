"""Mixing sources to target weights by iterative proportional fitting.

Token counts of the cells (source, language, topic) are summed over all documents; raking scales
them to the target marginals in turn until all hold. The sample has a stated share of all tokens: its cells are
raked again with what they hold as their bound, so a scarce cell is kept whole and makes no other cell smaller.
A document is then drawn with the probability of its cell. The draw is a hash of the document, so it does not depend on partitions or retries.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = ("source", "lang", "topic")
#: Name of the category of nulls; topics; share of a category's own weight in its target: weight ** TEMPER, made to sum to 1.
MISSING, TOPICS, TEMPER = "(null)", 8, 0.7
#: Raking ends when every marginal is within TOLERANCE of its target, or after ROUNDS.
TOLERANCE, ROUNDS = 1e-9, 1000
#: Share of all tokens that the sample is expected to have.
KEPT = 0.5
#: Most cells (source, language, topic) that are raked on the driver.
CELLS = 200_000
_WORD = r"[\x20\x09-\x0D]+"


def words(text: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), _WORD), lambda w: w != "")


def topic_of(found: Column) -> Column:
    """A lexical topic: the class of the word with the least hash, which near copies share; texts without words have their own."""
    return F.coalesce(F.concat(F.lit("t"), F.pmod(F.array_min(F.transform(found, lambda w: F.xxhash64(w))), F.lit(TOPICS)).cast("string")), F.lit("none"))


def uniform(id_col: str, text: str, seed: int) -> Column:
    """A number in [0, 1) from the id and the text."""
    key = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(str(seed)), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rake(index: list[np.ndarray], weights: np.ndarray, targets: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Cell weights whose marginals meet ``targets`` (each sums to 1), and the largest distance left.

    ``index``: for each dimension the category of each cell. Categories without weight keep none.
    """
    w = weights / max(weights.sum(), 1e-300)
    gap = 0.0
    for _ in range(ROUNDS):
        for at, target in zip(index, targets, strict=True):
            have = np.bincount(at, w, len(target))
            w = w * np.divide(target, have, out=np.zeros_like(target), where=have > 0)[at]
        gap = max((float(np.abs(np.bincount(at, w, len(t)) - t)[np.bincount(at, weights, len(t)) > 0].max(initial=0)) for at, t in zip(index, targets, strict=True)), default=0.0)
        if gap <= TOLERANCE:
            break
    return w, gap


def _target(totals: np.ndarray, names: list[str], wanted: dict[str, float] | None) -> np.ndarray:
    """Shares by name, or the tempered shares of the categories; only of categories with tokens."""
    share = np.array([wanted.get(n, 0.0) for n in names]) if wanted else totals ** TEMPER
    share = np.where(totals > 0, share, 0.0)
    return share / share.sum() if share.sum() else share


def _level(weights: np.ndarray, bounds: np.ndarray, wanted: float) -> float:
    """The least c with sum(min(bounds, c * weights)) = wanted; wanted is at most the bounds of the cells with weight."""
    some = weights > 0
    weights, bounds = weights[some], bounds[some]
    if wanted <= 0 or not len(weights):
        return 0.0
    order = np.argsort(bounds / weights, kind="stable")
    weights, bounds = weights[order], bounds[order]
    full = np.concatenate([[0.0], np.cumsum(bounds)])  # the first k cells are at their bounds
    free = np.append(np.cumsum(weights[::-1])[::-1], 0.0)
    reached = full[:-1] + bounds / weights * free[:-1]  # sum when cell k has just come to its bound
    k = min(int(np.searchsorted(reached, wanted)), len(weights) - 1)
    return float(min((wanted - full[k]) / free[k], bounds[k] / weights[k]))


def fill(index: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray], share: float) -> np.ndarray:
    """Expected tokens of each cell in a sample of ``share`` of all tokens, none above what the cell holds.

    Cells of categories without a target get none. A category that holds less than its target of the sample is to be kept
    whole, what it lacks is spread over the others; cells are then raked to these marginals within their bounds. Where no sample has
    all of them, the nearest found is brought to the sample's size, so that this always holds while there are tokens with targets.
    """
    open_to = np.all([t[at] > 0 for at, t in zip(index, targets, strict=True)], axis=0)
    bounds = np.where(open_to, tokens, 0.0)
    size = min(share * tokens.sum(), bounds.sum())
    if size <= 0:
        return np.zeros_like(bounds)
    w, held = bounds * (size / bounds.sum()), []
    for at, t in zip(index, targets, strict=True):
        holds = np.bincount(at, bounds, len(t))
        t = np.where(holds > 0, t, 0.0)
        held.append(np.minimum(holds, _level(t, holds, size) * t))
    groups = [np.split(np.argsort(at, kind="stable"), np.cumsum(np.bincount(at, minlength=len(t)))[:-1]) for at, t in zip(index, targets, strict=True)]
    for _ in range(ROUNDS):
        for own, wanted in zip(groups, held, strict=True):
            for cells, x in zip(own, wanted, strict=True):
                if x > 0:
                    w[cells] *= _level(w[cells], bounds[cells], min(x, bounds[cells].sum()))
        w = np.clip(w, np.where(bounds > 0, 1e-200, 0.0), np.where(bounds > 0, 1e200, 0.0))
        now = np.minimum(bounds, w)
        if max(np.abs(np.bincount(at, now, len(x)) - x).max() for at, x in zip(index, held, strict=True)) <= TOLERANCE * size:
            break
    return np.minimum(bounds, w * _level(w, bounds, size))


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", text: str = "text", seed: int = 1, share: float = KEPT) -> DataFrame:
    """Every row and column of ``docs`` with mix_topic, mix_tokens, mix_weight, mix_probability, mix_sampled (columns of those names are replaced).

    ``docs`` has ``source`` and ``lang``, and may have ``topic``; else the lexical topic is used. ``targets``
    gives shares by category for a dimension; a dimension without them gets tempered shares. mix_weight
    is target over actual tokens of the cell. The expected tokens of the sample are ``share`` of all tokens (of those with a target,
    if they are fewer) and have the target marginals, as far as the categories hold enough tokens (``fill``); rows without words are kept by ``share``. Nulls are a category; an empty table gives no rows; rows that are equal in id
    and text share their draw. The driver gets one row for each cell; more than ``CELLS`` of them are an error.
    """
    columns = [c for c in docs.columns if c not in ("mix_topic", "mix_tokens", "mix_weight", "mix_probability", "mix_sampled")]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])  # packed, so no name clashes
    topic = F.col("topic").cast("string") if "topic" in docs.columns else topic_of(F.col("words"))
    found = docs.withColumn("row", row).select("row", "source", "lang", words(text).alias("words"), uniform(id_col, text, seed).alias("draw"),
                                               *(["topic"] if "topic" in docs.columns else []))
    found = found.select("row", "draw", "source", "lang", F.size("words").cast("long").alias("mix_tokens"), topic.alias("mix_topic"))
    cell = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in ("source", "lang", "mix_topic")]
    found = found.withColumn("cell", F.to_json(F.array(*cell)))
    cells = (found.groupBy("cell").agg(F.sum("mix_tokens").alias("tokens"), *[F.first(x).alias(d) for d, x in zip(DIMENSIONS, cell, strict=True)])
             .limit(CELLS + 1).collect())
    if len(cells) > CELLS:
        raise ValueError(f"more than {CELLS} cells of source, language and topic; use coarser categories")
    cells.sort(key=lambda r: r["cell"])
    tokens = np.array([r["tokens"] for r in cells], np.float64)
    index, goals = [], []
    for d in DIMENSIONS:
        names = sorted({r[d] for r in cells})
        place = {n: i for i, n in enumerate(names)}
        at = np.array([place[r[d]] for r in cells], np.int64)
        index.append(at)
        goals.append(_target(np.bincount(at, tokens, len(names)), names, (targets or {}).get(d)))
    raked, _ = rake(index, tokens, goals) if len(cells) else (tokens, 0.0)
    ratio = np.divide(raked * tokens.sum(), tokens, out=np.ones_like(tokens), where=tokens > 0)  # cells without tokens change no marginal
    wanted = fill(index, tokens, goals, share) if len(cells) else tokens
    chance = np.divide(wanted, tokens, out=np.full_like(tokens, share), where=tokens > 0)
    plan = docs.sparkSession.createDataFrame([(r["cell"], float(w), float(min(1.0, p))) for r, w, p in zip(cells, ratio, chance, strict=True)],
                                             "plan_cell string, mix_weight double, mix_probability double")
    return (found.join(plan, F.col("cell") == F.col("plan_cell"), "left")
            .select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)], "mix_tokens", "mix_topic", "mix_weight", "mix_probability",
                    (F.col("draw") < F.col("mix_probability")).alias("mix_sampled")))
