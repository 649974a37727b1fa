"""The quality classifier and the language model: brute force, held-out results, odd rows."""

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import ODD, SCHEMA, crc, documents, prose, words
from valuemill.llm import pseudo_lm, quality_fm
from valuemill.llm.common import utf8_block, word_hashes


def junk(i):
    return [" ".join([f"w{i % 7}"] * 40), " ".join(f"W{k}!!" for k in range(30)), " | ".join(f"w{k}" for k in range(30)), " ".join(f"w{k}$$$ w{k}%%%" for k in range(20))][i % 4]


def corpus(spark, n=400):
    good = [i % 5 != 0 for i in range(n)]
    return documents(spark, [prose(i, 30 + i % 50) if g else junk(i) + " " + prose(i, 5) for i, g in enumerate(good)]), \
        spark.createDataFrame([(i, int(g), 0) for i, g in enumerate(good)], "doc_id long, quality int, toxic int")


def test_words_of_a_block():
    texts = ["The quick  the", "", "\t", "THE\nquick", "é x", "the"]
    data, offsets = utf8_block(pa.array([*texts, None]))
    hashes, doc, starts, ends = word_hashes(data, offsets)
    assert [(d, bytes(data[a:b]).decode().translate({c: c + 32 for c in range(65, 91)})) for d, a, b in zip(doc, starts, ends)] == \
        [(i, w) for i, t in enumerate(texts) for w in words(t)]
    by = {}
    for (d, w), h in zip([(i, w) for i, t in enumerate(texts) for w in words(t)], hashes.tolist()):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


def test_the_pairwise_term_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    fm = quality_fm.FactorisationMachine()
    fm.linear = rng.normal(size=quality_fm.FEATURES)
    fm.factors = rng.normal(size=fm.factors.shape)
    which, x = np.array([3, 10, 4000, 4100, 7, 9]), np.array([0.5, 1.0, 0.2, 1.0, 2.0, 0.3])
    doc = np.array([0, 0, 0, 0, 1, 1])
    for d in (0, 1):
        at = np.flatnonzero(doc == d)
        pairs = sum(fm.factors[which[i]] @ fm.factors[which[j]] * x[i] * x[j] for k, i in enumerate(at) for j in at[k + 1:])
        assert fm.raw(2, doc, which, x)[0][d] == pytest.approx(fm.linear[which[at]] @ x[at] + pairs)


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels = corpus(spark)
    model = quality_fm.train(docs, labels)
    rows = {r.doc_id: r for r in quality_fm.scored(docs, model).collect()}
    assert set(rows[0].asDict()) == {*docs.columns, "fm_score", "fm_predicted"}
    held = [i for i in rows if crc(str(i)) % 4 == 2]
    assert 50 < len(held) < 150
    assert np.mean([rows[i].fm_predicted == (i % 5 != 0) for i in held]) >= 0.97
    assert {r.doc_id for r in docs.where(quality_fm.held_out()).collect()} == set(held)
    # Labels of held-out rows, and the id, source and language of any row, change no score.
    other = labels.withColumn("quality", quality_fm.F.when(quality_fm.held_out(), 1 - labels.quality).otherwise(labels.quality))
    again = quality_fm.scored(docs.selectExpr("doc_id", "text", "'xx' as lang", "'zz' as source", "n_chars"), quality_fm.train(docs, other))
    assert {r.doc_id: r.fm_score for r in again.collect()} == pytest.approx({i: r.fm_score for i, r in rows.items()})


def test_quality_of_odd_rows(spark):
    docs, labels = corpus(spark, 60)
    model = quality_fm.train(docs, labels)
    odd = documents(spark, ODD, [(None, "x", None, None, None)]).selectExpr("*", "1 as fm_text", "2 as fm_score", "3 as chars")
    rows = quality_fm.scored(odd, model).collect()
    assert len(rows) == len(ODD) + 1 and all(0 <= r.fm_score <= 1 and r.fm_predicted == (r.fm_score >= 0.7) for r in rows)
    assert quality_fm.scored(spark.createDataFrame([], SCHEMA), model).collect() == []
    assert quality_fm.train(docs, labels.limit(0)) is None
    assert {(r.fm_score, r.fm_predicted) for r in quality_fm.scored(docs, None).collect()} == {(0.5, 0)}


def test_pseudo_likelihood_against_brute_force(spark):
    docs = documents(spark, ODD + [prose(i, 200, 50) for i in range(40)], [(None, "x y", None, None, None)])
    weights = pseudo_lm.train(docs.repartition(3))
    net = pseudo_lm.WindowNetwork(weights)
    vectors, bias, w1, b1, w2, given = (p.astype(np.float64) for p in net.params)
    for r in pseudo_lm.scored(docs, weights).collect():
        text = next(d.text for d in docs.collect() if d.doc_id == r.doc_id) if r.doc_id is not None else "x y"
        data, offsets = utf8_block(pa.array([text]))
        ids = [int(h >> 54) for h in word_hashes(data, offsets)[0].tolist()]
        total = 0.0
        for i, own in enumerate(ids):
            around = [ids[i + s] if 0 <= i + s < len(ids) else pseudo_lm.CLASSES for s in (-2, -1, 1, 2)]
            hidden = np.tanh(sum(vectors[k][c] for k, c in enumerate(around)) + bias)
            one, two = hidden @ w1 + b1, hidden @ w2 + given[own // 32]
            total += one[own // 32] - np.log(np.exp(one).sum()) + two[own % 32] - np.log(np.exp(two).sum())
        assert r.n_words == len(words(text)) and r.log_probability == pytest.approx(total, rel=1e-3, abs=1e-3)
        assert (r.mean_log_probability is None) == (r.n_words == 0)


def test_training_lowers_the_loss_and_uses_both_sides(spark):
    sentence = "the cat sat on the mat while a dog ran by the old red barn and then slept well"
    docs = documents(spark, [" ".join([sentence] * 30)] * 60)
    mean = lambda w, t: pseudo_lm.scored(documents(spark, t), w).collect()[0].mean_log_probability
    weights = pseudo_lm.train(docs.repartition(2))
    start = pseudo_lm.WindowNetwork().packed()
    assert mean(weights, [sentence]) > mean(start, [sentence]) + 2
    assert mean(weights, [sentence]) > mean(weights, [" ".join(reversed(sentence.split()))]) + 0.5
    assert pseudo_lm.train(spark.createDataFrame([], SCHEMA)) == start
    assert pseudo_lm.scored(spark.createDataFrame([], SCHEMA), start).collect() == []
