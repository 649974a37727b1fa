"""Exact top-k inner products: candidates in order of falling norm, SVD-rotated partial sums, Cauchy-Schwarz bounds.

All candidates are put in slices by falling norm, the slices in bands that grow by a factor. The first band, the
longest vectors, gives each query a first k-th best score. A later band is met only by queries whose norm
times a slice's largest norm can still reach their k-th best score, which is decided before anything is
exchanged; when no query is left, the rest of the bands is not read. Queries that reach equally far share a
block, so a candidate is copied once for each block of queries that it may serve.

Where a block of queries meets a block of candidates, these are taken by falling norm again. A query leaves
when its norm times the next norm cannot reach its k-th best score; a pair leaves when its partial product
over the leading rotated dimensions plus the product of the residual norms cannot. The pairs that remain get
their exact integer product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuemill.session import materialize

#: Rows of a candidate block and of a query block (means), candidates taken at once, share of the squares that the leading dimensions hold.
CANDIDATES, QUERIES, STEP, LEADING = 8192, 2048, 512, 0.6
#: A band ends at GROWTH times the rank of the one before it and has GROWTH - 1 slices; accuracy of the norms at which slices end.
GROWTH, ACCURACY = 16, 100_000
#: Blocks of partial Gram matrices that the driver adds up.
GRAM_PARTS = 32
_EXACT = 1 << 52


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, v): floor(scale * x) of each component as long; rows with a null id, vector or component, or one that is not finite, are left out."""
    x = F.col(vector)
    whole = x.isNotNull() & F.col(id_col).isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(math.inf))), F.lit(False))
    return vectors.where(whole).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Integers, a row for each vector; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def rotation(rows: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all rows, from their Gram matrix: one pass, GRAM_PARTS small matrices for the driver."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((dims, dims))
        for b in batches:
            m = _matrix(b.column(0), dims).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % GRAM_PARTS], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "gram"])

    def add(batch: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in batch.column("gram").to_pylist())
        return pa.table({"gram": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("v").mapInArrow(partial, "part int, gram binary").groupBy("part").applyInArrow(add, "gram binary").collect()
    gram = sum((np.frombuffer(r["gram"], np.float64) for r in parts), np.zeros(dims * dims)).reshape(dims, dims)
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _exact(q: np.ndarray, c: np.ndarray, small: bool) -> np.ndarray:
    """Row by row inner products, exact; beyond 64 bits they stop at the limits."""
    if small:
        return np.einsum("ij,ij->i", q.astype(np.float64), c.astype(np.float64)).astype(np.int64)
    lo, hi = -(1 << 63), (1 << 63) - 1
    return np.array([min(max(sum(a * b for a, b in zip(x, y, strict=True)), lo), hi) for x, y in zip(q.tolist(), c.tolist(), strict=True)], np.int64)


def block_topk(qid: np.ndarray, q: np.ndarray, floor: np.ndarray, cid: np.ndarray, c: np.ndarray, rot: np.ndarray, k: int, small: bool) -> tuple[np.ndarray, ...]:
    """(query id, candidate id, score) of the k best candidates of each query among one block of candidates, but for scores below ``floor``."""
    fq, fc = q.astype(np.float64), c.astype(np.float64)
    nq, nc = np.linalg.norm(fq, axis=1), np.linalg.norm(fc, axis=1)
    order = np.argsort(-nc, kind="stable")
    cid, c, fc, nc = cid[order], c[order], fc[order], nc[order]
    rq, rc = fq @ rot, fc @ rot
    held = np.cumsum((rc ** 2).sum(axis=0))
    lead = int(np.searchsorted(held, LEADING * held[-1])) + 1 if len(held) else 0
    restq, restc = np.linalg.norm(rq[:, lead:], axis=1), np.linalg.norm(rc[:, lead:], axis=1)
    slack = 1e-9 * (nq.max(initial=0) * nc.max(initial=0)) + 0.25  # more than rounding can take; exact scores are whole numbers
    best = floor.copy()
    keep = (np.zeros(0, np.int64),) * 3  # query index, score, candidate id
    for at in range(0, len(cid), STEP):
        alive = np.flatnonzero(nq * nc[at] + slack >= best)
        if not len(alive):
            break
        block = slice(at, at + STEP)
        bound = rq[alive, :lead] @ rc[block, :lead].T + np.outer(restq[alive], restc[block]) + slack
        i, j = np.nonzero(bound >= best[alive, None])
        i, j = alive[i], j + at
        other = qid[i] != cid[j]
        i, j = i[other], j[other]
        if not len(i):
            continue
        score = np.concatenate([_exact(q[i[s:s + (1 << 16)]], c[j[s:s + (1 << 16)]], small) for s in range(0, len(i), 1 << 16)])
        near = score >= best[i]
        who, what, which = (np.concatenate([a, b]) for a, b in zip(keep, (i[near], score[near], cid[j[near]]), strict=True))
        order = np.lexsort((which, np.negative(what.astype(np.float64)) if small else ~what, who))
        who, what, which = who[order], what[order], which[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who, side="left")
        keep = who[rank < k], what[rank < k], which[rank < k]
        last = rank == k - 1
        best[who[last]] = np.maximum(best[who[last]], what[last])
    return qid[keep[0]], keep[2], keep[1]


def _slices(n: int) -> tuple[list[int], list[int]]:
    """Ranks by falling norm at which all slices of n rows but the last end, and the band of each slice; some GROWTH * log(n) of them."""
    ends, bands = [CANDIDATES], [0]
    while ends[-1] < n:
        step, band = ends[-1], bands[-1] + 1
        for _ in range(GROWTH - 1):
            if ends[-1] < n:
                ends.append(ends[-1] + step)
                bands.append(band)
    return ends[:-1], bands


def _pick(index: Column, values: list) -> Column:
    """The value at a zero-based index."""
    return F.element_at(F.array(*[F.lit(x) for x in values]), index + 1)


def _first(n: Column, name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1)).alias(name)


def _spread_over(n: Column) -> Column:
    return F.pmod(F.xxhash64("id"), n).cast("int")


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k best other rows by integer inner product, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``. Rows that share an id count once, with the smallest
    vector; shorter vectors count as ending in zeros; with fewer than k other rows all are returned; an empty
    table gives no rows. Other columns are ignored.
    """
    rows = quantised(vectors, id_col, vector).groupBy("id").agg(F.min("v").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = materialize(rows.withColumn("norm", norm), "topk-vectors")
    largest = F.max(F.greatest(F.abs(F.coalesce(F.array_max("v"), F.lit(0)).cast("double")), F.abs(F.coalesce(F.array_min("v"), F.lit(0)).cast("double"))))
    n, dims, most, longest = rows.agg(F.count("*"), F.max(F.size("v")), largest, F.max("norm")).first()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    small, slack = most ** 2 * max(1, dims) < _EXACT, 1e-9 * longest * longest + 0.25
    rot = rotation(rows, dims)
    ends, bands = _slices(n)
    cuts = rows.agg(F.percentile_approx("norm", [1 - e / n for e in ends], ACCURACY)).first()[0] if ends else []
    shorter = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: F.col("norm") < c)) if cuts else F.lit(0)
    placed = rows.withColumn("slice", shorter)
    held = {r["slice"]: (r["n"], r["top"]) for r in placed.groupBy("slice").agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect()}  # a row a slice
    queries, best = rows.where(is_query), None

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = block_topk(left.column("query_id").to_numpy(), _matrix(left.column("q"), dims), left.column("floor").to_numpy(),
                           right.column("id").to_numpy(), _matrix(right.column("v"), dims), rot, k, small) \
            if len(left) and len(right) else (np.zeros(0, np.int64),) * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(x, pa.int64()) for x in found), strict=True)))

    for band in sorted({bands[s] for s in held}):
        mine = sorted(s for s in held if bands[s] == band)
        kth = F.lit(-math.inf)
        asked = queries
        if best is not None:
            asked = queries.join(best.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("kth")), "id", "left")
            kth = F.coalesce("kth", F.lit(-math.inf))
        tops = F.array(*[F.lit(held[s][1]) for s in mine])  # falling, so a query reaches the first so many slices
        asked = asked.withColumn("floor", kth).withColumn("reach", F.size(F.filter(tops, lambda t: F.col("norm") * t + slack >= F.col("floor")))).where("reach > 0")
        reached = dict(map(tuple, asked.groupBy("reach").count().collect()))  # at most a row a slice of the band
        if not reached:
            break
        wide = list(range(len(mine) + 1))
        parts = [math.ceil(reached.get(r, 0) / QUERIES) for r in wide]  # blocks of the queries of each reach, those of longer reach first
        before = [sum(parts[r + 1:]) for r in wide]
        blocks = [math.ceil(held[s][0] / CANDIDATES) for s in mine]
        above = [sum(blocks[:j]) for j in wide]
        part = _pick(F.col("reach"), before) + _spread_over(_pick(F.col("reach"), parts))
        left = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q"), "floor", part.alias("part"), _first(_pick(F.col("reach"), above), "block"))
        at = F.array_position(F.array(*[F.lit(s) for s in mine]), F.col("slice")).cast("int") - 1
        block = _pick(at, above) + _spread_over(_pick(at, blocks))
        met = [s for j, s in enumerate(mine) if before[j]]
        right = placed.where(F.col("slice").isin(met)).select("id", "v", block.alias("block"), _first(_pick(at, before), "part"))
        found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(run, "query_id long, vec_id long, score long")
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        best = materialize(found.withColumn("rank", rank).where(F.col("rank") <= k), "topk-best")
    if best is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return best.select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings)
SELECT q.vec_id AS query_id, row_number() OVER w AS rank, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id) QUALIFY rank <= 5
"""
