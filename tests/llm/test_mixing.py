import numpy as np
import pytest

from tests.llm.helpers import ODD, SCHEMA, documents, prose, words
from valuemill.llm import mixing


def test_raking_meets_the_marginals():
    rng = np.random.default_rng(1)
    index = [np.repeat(np.arange(4), 6), np.tile(np.repeat(np.arange(3), 2), 4), np.tile(np.arange(2), 12)]
    weights = rng.integers(1, 1000, 24).astype(float)
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.25, 0.25]), np.array([0.9, 0.1])]
    w, gap = mixing.rake(index, weights, targets)
    assert gap <= mixing.TOLERANCE
    for at, t in zip(index, targets):
        assert np.bincount(at, w) == pytest.approx(t, abs=1e-8)
    ratio = np.log(w / weights)  # raking only multiplies by a factor for each category
    box = ratio.reshape(4, 3, 2)
    assert box[1:] - box[:-1] == pytest.approx(np.broadcast_to((box[1:] - box[:-1])[:, :1, :1], (3, 3, 2)), abs=1e-9)


def test_expected_tokens_have_the_targets(spark):
    df = documents(spark, [prose(i, 5 + i % 40) for i in range(800)])
    goal = {"source": {"s0": 0.4, "s1": 0.3, "s2": 0.2, "s3": 0.1}, "lang": {"en": 0.5, "fr": 0.5}}
    rows = mixing.mixed(df, goal).collect()
    assert len(rows) == 800 and all(r.mix_tokens == len(words(r.text)) for r in rows)
    total = sum(r.mix_tokens * r.mix_probability for r in rows)
    for d, shares in goal.items():
        for name, share in shares.items():
            assert sum(r.mix_tokens * r.mix_probability for r in rows if r[d] == name) / total == pytest.approx(share, abs=1e-6)
    assert max(r.mix_probability for r in rows) == pytest.approx(1.0)
    drawn = sum(r.mix_sampled for r in rows)
    assert abs(drawn - sum(r.mix_probability for r in rows)) < 5 * len(rows) ** 0.5
    again = mixing.mixed(df.repartition(7), goal).collect()
    assert {r.doc_id for r in again if r.mix_sampled} == {r.doc_id for r in rows if r.mix_sampled}


def test_odd_rows_own_topics_and_empty(spark):
    df = documents(spark, ODD, [(None, "x y", None, None, None), (4, "a", "en", "s0", 1), (4, "a", "en", "s0", 1)])
    rows = mixing.mixed(df).collect()
    assert len(rows) == df.count() and all(0 <= r.mix_probability <= 1 for r in rows)
    extra = df.selectExpr("*", "'sport' as topic", "1 as mix_cell_name", "2 as mix_tokens")
    assert {r.mix_topic for r in mixing.mixed(extra).collect()} == {"sport"}
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_stray_document_makes_the_sample_no_smaller(spark):
    texts = [prose(i, 20 + i % 40) for i in range(900)]
    few = [(5000, "one stray document", "en", "its own source", 18), (5001, "no language here at all", None, "s1", 23)]
    whole = mixing.mixed(documents(spark, texts)).collect()
    rows = mixing.mixed(documents(spark, texts, few)).collect()
    for r in (whole, rows):
        assert sum(x.mix_tokens * x.mix_probability for x in r) == pytest.approx(mixing.KEPT * sum(x.mix_tokens for x in r), rel=1e-6)
    by = {r.doc_id: r for r in rows}
    assert by[5000].mix_probability == pytest.approx(1.0, abs=1e-3) and by[5001].mix_probability == pytest.approx(1.0, abs=1e-3)
    assert max(abs(r.mix_probability - by[r.doc_id].mix_probability) for r in whole) < 0.05


@pytest.mark.parametrize("rare", [1e5, 1e3, 200.0])
def test_the_size_holds_on_skewed_sources(rare):
    rng = np.random.default_rng(4)
    sizes = [np.array([1 / 3, *np.full(19, 2 / 57)]), np.array([0.7, 0.15, 0.1, 0.05]), np.full(8, 1 / 8)]
    tokens = np.einsum("i,j,k->ijk", *sizes).ravel() * 1e9 * rng.uniform(0.5, 1.5, 640)
    index = [np.append(x.ravel(), y) for x, y in zip(np.indices((20, 4, 8)), (20, 1, 3), strict=True)]
    tokens = np.append(tokens, rare)
    goals = [mixing._target(np.bincount(at, tokens), [""] * (at.max() + 1), None) for at in index]
    got = mixing.fill(index, tokens, goals, 0.5)
    assert got.sum() == pytest.approx(0.5 * tokens.sum(), rel=1e-9) and (got <= tokens * (1 + 1e-12)).all()
    assert got[-1] == pytest.approx(rare, rel=1e-6)  # kept whole
    for at, goal in zip(index[1:], goals[1:], strict=True):
        assert np.bincount(at, got) / got.sum() == pytest.approx(goal, abs=1e-6)


def test_targets_that_no_sample_has():
    index = [np.array([0, 1]), np.array([0, 1])]  # the sources are the languages
    got = mixing.fill(index, np.array([900.0, 100.0]), [np.array([0.9, 0.1]), np.array([0.1, 0.9])], 0.5)
    assert got.sum() == pytest.approx(500) and (got <= [900, 100]).all()
    assert mixing.fill(index, np.array([900.0, 100.0]), [np.array([0.0, 1.0]), np.array([0.5, 0.5])], 0.5).tolist() == [0, 100]
