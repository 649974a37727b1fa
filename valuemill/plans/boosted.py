"""Queries of the parts of boosting (bins, histograms, splits, bootstrap weights, scoring) over lineitem, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemill.boosting import BinnedTable, BoostedTrees, Settings, bin_features, grow
from valuemill.boosting.model import Tree
from valuemill.functions.numeric import round6
from valuemill.session import sf_path, spread

FEATURES = ["l_quantity", "l_discount", "l_tax"]
SPLITS = Settings(trees=1, depth=2, l1=40.0, l2=2.5, min_gain=0.0, min_weight=100.0)
WEIGHTS = Settings(temperature=0.5, rows=0.8, seed=11)
#: Two models of two trees each, (feature, cut) by level or node and the leaves: what is scored, not what was learnt.
SYMMETRIC = ([((0, 20.0), (1, 0.04)), ((2, 0.03), (0, 35.0))], [(1.5, -2.0, 0.25, 4.0), (0.5, 1.0, -1.5, 2.0)])
HEAPS = ([((0, 10.0), None, (1, 0.06)), ((1, 0.02), (2, 0.05), None)], [(1.0, None, -1.0, 3.0), (2.0, 0.5, -4.0, None)])


def _table(spark: SparkSession, sf_dir: str) -> BinnedTable:
    rows = spread(spark.read.parquet(sf_path(sf_dir, "lineitem"))).withColumn("y", F.col("l_extendedprice").cast("double") / 1000)
    return bin_features(rows, FEATURES, "y", ["l_orderkey", "l_linenumber"])


def q_boost_bins(spark, sf_dir):
    """Rows in each bin of the binned table: with fewer values than bins, a bin for each value."""
    table = _table(spark, sf_dir)
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.conv(F.hex(F.substring("bins", i + 1, 1)), 16, 10).cast("int").alias("bin")) for i, f in enumerate(FEATURES)]))
    return table.rows.select(cells.alias("c")).groupBy("c.feature", "c.bin").agg(F.count("*").alias("n_rows"))


def _root(table: BinnedTable, settings: Settings):
    fit = grow._started(settings, None, grow.bases(table))
    return fit, grow.histograms(table.rows, table, [fit], [[]], {0: Tree(settings.depth)}, 0, 0)


def q_boost_histogram(spark, sf_dir):
    """Gradient and hessian sums of every bin at the root, in units of 2 ** -20."""
    _, sums = _root(_table(spark, sf_dir), SPLITS)
    return sums.select(F.get(F.array(*map(F.lit, FEATURES)), F.col("feature")).alias("feature"), "bin", F.col("g").alias("gradient"), F.col("h").alias("hessian"))


def q_boost_splits(spark, sf_dir):
    """The splits of a tree of two levels with L1 and L2 penalties: node, feature, bin, gain and the values of both sides."""
    table = _table(spark, sf_dir)
    own, tree = _root(table, SPLITS)[0], Tree(2)
    found = []
    for level in range(2):
        sums = grow.histograms(table.rows, table, [own], [[]], {0: tree}, 0, level)
        for r in grow.best_splits(sums, [own]).collect():  # two nodes at most
            if r["gain"] is not None and r["gain"] > SPLITS.min_gain:
                left, right = grow.leaf_value(r["gl"], r["hl"], SPLITS), grow.leaf_value(r["gt"] - r["gl"], r["ht"] - r["hl"], SPLITS)
                tree.split(r["node"], r["feature"], r["bin"], left, right)
                found.append((r["node"], FEATURES[r["feature"]], r["bin"], round(r["gain"], 4), round(left, 6), round(right, 6)))
    return spark.createDataFrame(found, "node int, feature string, bin int, gain double, left_value double, right_value double")


def q_boost_weights(spark, sf_dir):
    """Bayesian bootstrap weights of the sampled rows, 0 of the others, by a key of order and line."""
    keys = spread(spark.read.parquet(sf_path(sf_dir, "lineitem"))).select((F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber").cast("long")).alias("row_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = grow.row_weights(batch.column(0).to_numpy(), WEIGHTS, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(w)], ["row_key", "weight"])

    return keys.mapInArrow(run, "row_key long, weight double").select("row_key", round6("weight").alias("weight"))


def _models() -> tuple[BoostedTrees, BoostedTrees]:
    cuts = [np.array([10.0, 20.0, 35.0]), np.array([0.02, 0.04, 0.06]), np.array([0.03, 0.05])]
    at = lambda f, c: int(np.searchsorted(cuts[f], c))
    masks, heaps = [], []
    for levels, leaves in zip(*SYMMETRIC, strict=True):
        t = Tree(2)
        for k, (f, c) in enumerate(levels):
            t.feature[(1 << k) - 1:(2 << k) - 1], t.bin[(1 << k) - 1:(2 << k) - 1] = f, at(f, c)
        t.value[3:] = leaves
        masks.append(t)
    for nodes, leaves in zip(*HEAPS, strict=True):
        t = Tree(2)
        for i, node in enumerate(nodes):
            if node:
                t.feature[i], t.bin[i] = node[0], at(*node)
            else:
                t.value[i] = leaves[2 * i - 2]  # a leaf above the last level
        t.value[3:] = [x or 0.0 for x in leaves]
        heaps.append(t)
    return BoostedTrees(FEATURES, cuts, 0.75, 0.3, True, masks), BoostedTrees(FEATURES, cuts, -0.5, 0.1, False, heaps)


def q_boost_scores(spark, sf_dir):
    """Every row scored by symmetric trees, by bit mask, and by walked trees."""
    by_mask, by_walk = _models()
    rows = spark.read.parquet(sf_path(sf_dir, "lineitem"))
    return rows.select("l_orderkey", "l_linenumber", round6(by_mask.prediction()).alias("by_mask"), round6(by_walk.prediction()).alias("by_walk"))


BOOST_QUERIES = {f.__name__.removeprefix("q_"): f for f in (q_boost_bins, q_boost_histogram, q_boost_splits, q_boost_weights, q_boost_scores)}

_UNIT = "1048576.0"
_BINNED = """src AS (SELECT l_orderkey, l_linenumber, l_extendedprice::DOUBLE / 1000 AS y, dense_rank() OVER (ORDER BY l_quantity) - 1 AS b0,
                dense_rank() OVER (ORDER BY l_discount) - 1 AS b1, dense_rank() OVER (ORDER BY l_tax) - 1 AS b2 FROM lineitem),
base AS (SELECT sum(round(y * 1048576.0)::HUGEINT)::DOUBLE / count(*) / 1048576.0 AS base FROM src),
grad AS (SELECT l_orderkey, l_linenumber, b0, b1, b2, round_even((base - y) * 1048576.0, 0)::BIGINT AS g FROM src, base)"""


def _cells(rows: str, node: str) -> str:
    return " UNION ALL ".join(f"SELECT {node} AS node, {i} AS f, b{i} AS bin, g FROM {rows}" for i in range(3))


def _best_sql(rows: str, node: str) -> str:
    s = SPLITS
    score = lambda g, h: f"pow(greatest(abs({g}) - {s.l1}, 0), 2) / ({h} + {s.l2})"
    return f"""SELECT node, f, bin, gain, gl, hl, gt, ht FROM (
    SELECT *, {score('gl', 'hl')} + {score('(gt - gl)', '(ht - hl)')} - {score('gt', 'ht')} AS gain FROM (
      SELECT node, f, bin, sum(g) OVER up::DOUBLE / {_UNIT} AS gl, sum(h) OVER up::DOUBLE AS hl, sum(g) OVER whole::DOUBLE / {_UNIT} AS gt, sum(h) OVER whole::DOUBLE AS ht
      FROM (SELECT node, f, bin, sum(g) AS g, count(*) AS h FROM ({_cells(rows, node)}) GROUP BY node, f, bin)
      WINDOW up AS (PARTITION BY node, f ORDER BY bin ROWS UNBOUNDED PRECEDING), whole AS (PARTITION BY node, f)))
  WHERE least(hl, ht - hl) >= {s.min_weight} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) = 1"""


def _splits_sql() -> str:
    s = SPLITS
    value = lambda g, h: f"round(-sign({g}) * greatest(abs({g}) - {s.l1}, 0) / ({h} + {s.l2}), 6)"
    below = "CASE WHEN (CASE first.f WHEN 0 THEN b0 WHEN 1 THEN b1 ELSE b2 END) > first.bin THEN 2 ELSE 1 END"
    return f"""WITH {_BINNED},
first AS ({_best_sql('grad', '0')}),
placed AS (SELECT grad.*, {below} AS branch FROM grad, first WHERE first.gain > {s.min_gain}),
second AS ({_best_sql('placed', 'branch')})
SELECT node::INTEGER AS node, CASE f WHEN 0 THEN '{FEATURES[0]}' WHEN 1 THEN '{FEATURES[1]}' ELSE '{FEATURES[2]}' END AS feature, bin::INTEGER AS bin, round(gain, 4) AS gain,
       {value('gl', 'hl')} AS left_value, {value('(gt - gl)', '(ht - hl)')} AS right_value
FROM (SELECT * FROM first UNION ALL SELECT * FROM second) WHERE gain > {s.min_gain}"""


def _weights_sql() -> str:
    def mixed(x: str) -> str:
        times = lambda v, c: f"((({v})::UHUGEINT * {c}::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT"
        a = f"list_transform([{x}], lambda v: {times('xor(v, v >> 30)', 0xBF58476D1CE4E5B9)})"
        b = f"list_transform({a}, lambda v: {times('xor(v, v >> 27)', 0x94D049BB133111EB)})"
        return f"list_transform({b}, lambda v: xor(v, v >> 31))[1]"

    def uniform(purpose: int) -> str:
        start = int(grow.mix(np.array([WEIGHTS.seed * 1_000_003 + 2 * 8 + purpose], np.uint64))[0])
        return f"(({mixed(f'xor(k::UBIGINT, {start}::UBIGINT)')} >> 11)::DOUBLE + 0.5) / 9007199254740992.0"

    return f"""SELECT k AS row_key, round(CASE WHEN {uniform(2)} < {WEIGHTS.rows} THEN pow(-ln({uniform(1)}), {WEIGHTS.temperature}) ELSE 0 END, 6) AS weight
FROM (SELECT l_orderkey::BIGINT * 8 + l_linenumber::BIGINT AS k FROM lineitem)"""


def _scores_sql() -> str:
    col = lambda f: f"{FEATURES[f]}::DOUBLE"
    pick = lambda f, c, low, high: f"CASE WHEN {col(f)} > {c} THEN {high} ELSE {low} END"
    masks = [pick(*a, pick(*b, x[0], x[1]), pick(*b, x[2], x[3])) for (a, b), x in zip(*SYMMETRIC, strict=True)]
    walks = [pick(*top, pick(*left, x[0], x[1]) if left else x[0], pick(*right, x[2], x[3]) if right else x[2]) for (top, left, right), x in zip(*HEAPS, strict=True)]
    return (f"SELECT l_orderkey, l_linenumber, round((0.75 + 0.3 * ({' + '.join(f'({m})' for m in masks)}))::DOUBLE, 6) AS by_mask, "
            f"round((-0.5 + 0.1 * ({' + '.join(f'({w})' for w in walks)}))::DOUBLE, 6) AS by_walk FROM lineitem")


BOOST_SQL = {
    "boost_bins": f"WITH {_BINNED} SELECT feature, bin::INTEGER AS bin, count(*) AS n_rows FROM ("
                  + " UNION ALL ".join(f"SELECT '{f}' AS feature, b{i} AS bin FROM src" for i, f in enumerate(FEATURES)) + ") GROUP BY ALL",
    "boost_histogram": f"WITH {_BINNED} SELECT CASE f WHEN 0 THEN '{FEATURES[0]}' WHEN 1 THEN '{FEATURES[1]}' ELSE '{FEATURES[2]}' END AS feature, bin::INTEGER AS bin, "
                       f"sum(g)::BIGINT AS gradient, (count(*) * 1048576)::BIGINT AS hessian FROM ({_cells('grad', '0')}) GROUP BY ALL",
    "boost_splits": _splits_sql(),
    "boost_weights": _weights_sql(),
    "boost_scores": _scores_sql(),
}
