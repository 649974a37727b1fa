import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuemill.llm import vector_topk


def brute(rows, k, every=50):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(x)) for x in v]
        vectors[i] = min(vectors.get(i, q), q)
    out = []
    for i in sorted(vectors):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(vectors[i], vectors[j])), j) for j in vectors if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out


def run(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumn("id", F.lit("x")).withColumn("v", F.lit(1)).withColumn("part", F.lit(1))
    return sorted(tuple(r) for r in vector_topk.top_inner_products(df, F.col("id") % 50 == 0, k).collect())


@pytest.mark.parametrize("block", [(8192, 2048, 16), (37, 3, 16), (16, 2, 3)])
def test_against_brute_force(spark, monkeypatch, block):
    for name, value in zip(("CANDIDATES", "QUERIES", "GROWTH"), block):
        monkeypatch.setattr(vector_topk, name, value)
    monkeypatch.setattr(vector_topk, "STEP", 16)
    rng = np.random.default_rng(5)
    m = (rng.normal(size=(300, 12)) * rng.lognormal(0, 1, (300, 1)) * np.geomspace(1, 0.05, 12)).astype(np.float32)
    m[100:140] = m[7]  # ties
    rows = [(i, v.tolist(), 0) for i, v in enumerate(m)]
    rows += [(301, None, 0), (350, [1.0] * 11 + [None], 0), (400, [float("nan")] * 12, 0), (450, [float("inf")] * 12, 0), (None, [1.0] * 12, 0), rows[5], (50, rows[50][1], 0)]
    assert run(spark, rows) == brute([(r[0], r[1]) for r in rows], 5)


def test_few_rows_large_values_and_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0, 2.0], 0)]) == []
    rows = [(0, [3.0e6, 1.0], 0), (1, [3.0e6, -1.0], 0), (2, [-5.0e6, 0.5], 0)]
    assert run(spark, rows) == brute([(r[0], r[1]) for r in rows], 5)
    assert run(spark, [(0, [], 0), (1, [], 0)]) == [(0, 1, 1, 0)]


def test_shorter_vectors_end_in_zeros(spark):
    assert run(spark, [(0, [1.0, 1.0], 0), (1, [1.0], 0), (2, [1.0, 2.0, 5.0], 0)]) == [(0, 1, 2, 256 * 256 * 3), (0, 2, 1, 256 * 256)]


def test_bands_grow_and_hold_every_rank(monkeypatch):
    monkeypatch.setattr(vector_topk, "CANDIDATES", 10)
    monkeypatch.setattr(vector_topk, "GROWTH", 4)
    assert vector_topk._slices(7) == ([], [0])
    assert vector_topk._slices(170) == ([10, 20, 30, 40, 80, 120, 160], [0, 1, 1, 1, 2, 2, 2, 3])
    assert len(vector_topk._slices(10 ** 12)[0]) < 70


@pytest.fixture()
def met(spark, monkeypatch, tmp_path):
    """Small blocks, and a note of how many candidates each meeting of blocks got."""
    for name, value in (("CANDIDATES", 16), ("QUERIES", 4), ("GROWTH", 3)):
        monkeypatch.setattr(vector_topk, name, value)
    plain, folder = vector_topk.block_topk, str(tmp_path)

    def noted(qid, q, floor, cid, *rest):
        import uuid
        with open(f"{folder}/{uuid.uuid4()}", "w") as f:
            f.write(str(len(cid)))
        return plain(qid, q, floor, cid, *rest)
    monkeypatch.setattr(vector_topk, "block_topk", noted)
    return lambda: [int(p.read_text()) for p in tmp_path.iterdir()]


def test_bands_that_no_query_can_reach_are_not_exchanged(spark, met):
    """Twelve long vectors along every axis answer all queries: what is short is met by none."""
    rng = np.random.default_rng(3)
    long = np.eye(4).repeat(3, axis=0) * 50
    rows = [(50 * i, v.tolist(), 0) for i, v in enumerate(rng.dirichlet(np.ones(4), 5))]
    rows += [(1000 + 7 * i + 1, v.tolist(), 0) for i, v in enumerate(long)] + [(2001 + 50 * (i // 49) + i % 49, v.tolist(), 0) for i, v in enumerate(rng.normal(0, 0.01, (300, 4)))]
    assert run(spark, rows, k=3) == brute([(r[0], r[1]) for r in rows], 3)
    assert sum(met()) < 100  # two blocks of queries; 317 candidates would meet each


def test_many_vectors_of_equal_length_and_zero_vectors(spark, met):
    rng = np.random.default_rng(4)
    signs = rng.choice([-1.0, 1.0], (120, 6))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(signs)] + [(200 + i, [0.0] * 6, 0) for i in range(60)]
    assert run(spark, rows) == brute([(r[0], r[1]) for r in rows], 5)
    assert max(met()) < 120  # a slice of equal norms is cut into blocks


def test_one_id_of_different_lengths_counts_once(spark, met):
    rows = [(1, [9.0, 9.0], 0), (1, [-9.0, 9.0], 0), (1, [0.5, 0.5], 0)] + [(i, [1.0, i / 100], 0) for i in range(40, 120)]
    assert run(spark, rows) == brute([(r[0], r[1]) for r in rows], 5)
