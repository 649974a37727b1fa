import random

import numpy as np
import pytest

from tests.llm.helpers import ODD, SCHEMA, documents, edited, near_components, prose
from valuemill.llm import graph, ngram_join


def run(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}


def corpus():
    texts = list(ODD) + ["one two three four five", "ONE two\tthree four  five", "one two", "Two one", "one two"]
    passage = prose(99, 70)
    for k in range(12):
        body = prose(k, 20 + 15 * k)
        texts += [body, body.upper()] + [edited(body, 50 * k + j, 0.02 * j) for j in range(5)]
        texts += [passage + " " + prose(1000 + k, 10 * k), passage + " " + prose(2000 + k, 2)]
    return texts


@pytest.mark.parametrize("unit", [1 << 22, 600])
def test_against_all_pairs(spark, monkeypatch, unit):
    monkeypatch.setattr(ngram_join, "UNIT", unit)  # the small one cuts units into blocks
    texts = corpus()
    assert run(documents(spark, texts).repartition(3)) == near_components(list(enumerate(texts)))


def test_the_bound_is_exact(spark):
    base = [f"a{i}" for i in range(39)]  # 35 shingles; a new last word replaces 1, k new last words k
    texts = [" ".join(base)] + [" ".join(base[:39 - k] + [f"z{k}{i}" for i in range(k)]) for k in range(1, 9)]
    got, want = run(documents(spark, texts)), near_components(list(enumerate(texts)))
    assert got == want and {v[1] for v in want.values()} != {0}


def test_null_and_repeated_ids_extra_columns_empty(spark):
    rows = [(None, "a b c d e f", None, None, 1), (7, "a b c d e f", None, None, 1), (9, "a b c d e f", None, None, 1), (9, "other", None, None, 1), (11, "other", None, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "lang as id", "source as n", "n_chars as component", "1 as parts", "2 as u")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(None, 2, 7), (7, 2, 7), (9, 2, 7), (9, 1, 9), (11, 1, 9)], key=str)
    assert ngram_join.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_linked_sets_meet_in_their_leads():
    """The bound of the first step, for all sizes and overlaps up to 90 and the worst places of the members."""
    for s in range(1, 91):
        for t in range(-(-3 * s // 4), 4 * s // 3 + 1):
            i = -(-75 * (s + t) // 175)
            if i > min(s, t):
                continue
            lead, other = 40 * s // 100 + 1, 40 * t // 100 + 1
            # Own members of either set come first where that hides most: x of them before the shared ones of the one, y of the other.
            least = min(min(max(0, lead - x), max(0, other - y)) for x in range(s - i + 1) for y in range(t - i + 1))
            assert 100 * least >= 5 * s or least >= -(-5 * s // 100)


def test_prefix_tree_finds_every_link():
    rng = random.Random(3)
    sets = []
    for _ in range(60):
        base = rng.sample(range(200), rng.randrange(1, 40))
        for _ in range(3):
            sets.append(np.array(sorted({x if rng.random() > 0.1 else rng.randrange(200) for x in base})))
    sets = [np.array(s) for s in {tuple(s.tolist()) for s in sets}]
    tree, hit = ngram_join.PrefixTree(sets), np.zeros(200, bool)
    for s in sets:
        want = {i for i, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 75 * len(np.union1d(s, t))}
        assert {tree.order[k] for k in tree.linked(s, hit)} == want and not hit.any()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(501, 540)] + [(7, 3), (3, 7), (9, 9)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{x: 500 for x in range(500, 540)}, 3: 3, 7: 3}
