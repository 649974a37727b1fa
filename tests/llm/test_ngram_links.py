"""All links between different texts: pairs of sets, and the number of links of each document."""

import itertools

import pytest

from tests.llm.helpers import SCHEMA, documents, shingles
from tests.llm.test_ngram_join import corpus
from valuemill.llm import ngram_join


def linked(x, y):
    both = len(x & y)
    return both > 0 and 100 * both >= 75 * (len(x) + len(y) - both)


def near_copies():
    """Texts of 60 words that differ in the last ones: many pairs, of which a spanning tree holds few; and a chain."""
    base = [f"a{i}" for i in range(60)]
    return [" ".join(base[:59 - i % 3] + [f"z{i}"]) for i in range(12)] + [" ".join(f"c{k}" for k in range(4 * i, 4 * i + 60)) for i in range(6)]


@pytest.mark.parametrize("unit", [1 << 22, 600])
def test_every_pair_is_returned(spark, monkeypatch, unit):
    monkeypatch.setattr(ngram_join, "UNIT", unit)
    texts = corpus() + near_copies()
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if linked(sets[i], sets[j])]
    count = [0] * len(sets)
    for i, j in pairs:
        count[i] += 1
        count[j] += 1
    df = documents(spark, texts).repartition(3)
    assert {r.doc_id: r.n_links for r in ngram_join.near_duplicates(df).collect()} == dict(enumerate(count))
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    want = {(i, j, len(sets[i]), len(sets[j])) for i, j in pairs if first[sets[i]] == i and first[sets[j]] == j}
    got = [tuple(r) for r in ngram_join.near_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > len(sets)


def test_links_of_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f", None, None, 1), (7, "a b c d e f", None, None, 1), (9, "A b c d e f", None, None, 1), (9, "other", None, None, 1), (None, "alone", None, None, 1), (3, None, None, None, 1)]
    got = [(r.doc_id, r.n_shingles, r.n_links) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted([(None, 2, 2), (7, 2, 2), (9, 2, 2), (9, 1, 0), (None, 1, None), (3, 0, 0)], key=str)
