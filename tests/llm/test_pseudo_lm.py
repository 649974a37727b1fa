"""Every word trains the network once; a word's probability is its class's times its share of the class."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import ODD, SCHEMA, documents, prose, words
from valuemill.llm import pseudo_lm
from valuemill.llm.common import utf8_block, word_hashes


def test_every_word_is_a_target_once(spark, monkeypatch):
    texts = [prose(i, 50) for i in range(40)] + ["one two", "", None, "x " * 3000]
    seen = Counter()
    monkeypatch.setattr(pseudo_lm.WindowNetwork, "learn", lambda self, around, word, rate: seen.update(word.tolist()))
    rows = pa.table({"part": pa.array(sorted(i % 3 for i in range(len(texts))), pa.int64()), "text": texts})
    start = pseudo_lm.WindowNetwork().packed()
    words_seen, total = pseudo_lm.learned(iter(rows.to_batches(max_chunksize=5)), start, 0.1)
    data, offsets = utf8_block(pa.array(texts))
    want = Counter((word_hashes(data, offsets, lower=True)[0] >> np.uint64(54)).astype(int).tolist())
    assert seen == want and words_seen == sum(want.values())
    assert np.allclose(total / words_seen, pseudo_lm.WindowNetwork(start).flat())


@pytest.mark.parametrize("chunk", [1, 4, 100])
def test_pieces_do_not_depend_on_batches(chunk):
    rng = np.random.default_rng(1)
    texts = ["y" * int(n) for n in rng.integers(0, 30, 80)] + [None, "z" * 500, "w"]
    rows = pa.table({"part": pa.array(np.sort(rng.integers(0, 6, len(texts)))), "text": texts})
    got = [(p, t.to_pylist()) for p, t in pseudo_lm.pieces(iter(rows.to_batches(max_chunksize=chunk)), 100)]
    want, held = [], []
    for p, t in zip(rows["part"].to_pylist(), texts):
        if held and (held[-1][0] != p or sum(len(x or "") for _, x in held) >= 100):
            want.append((held[0][0], [x for _, x in held]))
            held = []
        held.append((p, t))
    assert got == [*want, (held[0][0], [x for _, x in held])]


def test_a_step_against_brute_force():
    rng = np.random.default_rng(4)
    around, word = rng.integers(0, pseudo_lm.CLASSES + 1, (200, 4)), rng.integers(0, pseudo_lm.CLASSES, 200)
    around[:90, 1] = 7  # a word that stands around many
    net, plain = pseudo_lm.WindowNetwork(), [p.astype(np.float64) for p in pseudo_lm.WindowNetwork().params]
    net.learn(around, word, 0.2)
    vectors, bias, w1, b1, w2, given = plain
    new, scale = [p.copy() for p in plain], 0.2 / np.sqrt(200)
    for a, w in zip(around, word, strict=True):
        hidden = np.tanh(sum(vectors[k][c] for k, c in enumerate(a)) + bias)
        one, two = np.exp(hidden @ w1 + b1), np.exp(hidden @ w2 + given[w // 32])
        one, two = one / one.sum(), two / two.sum()
        one[w // 32] -= 1
        two[w % 32] -= 1
        slope = (w1 @ one + w2 @ two) * (1 - hidden ** 2)
        for k, c in enumerate(a):
            new[0][k][c] -= scale * slope
        for p, change in zip(new[1:5], (slope, np.outer(hidden, one), one, np.outer(hidden, two)), strict=True):
            p -= scale * change
        new[5][w // 32] -= scale * two
    for got, want in zip(net.params, new, strict=True):
        assert np.allclose(got, want, atol=1e-4)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "PART_BYTES", 3000)
    texts = [prose(i, 80, 400) for i in range(120)]
    docs = documents(spark, texts + texts[:20])
    got = []
    for n in (2, 16):
        dealt = docs.repartition(n)
        weights = pseudo_lm.train(dealt)
        assert weights != pseudo_lm.WindowNetwork().packed()
        got.append({r.doc_id: r.log_probability for r in pseudo_lm.scored(dealt, weights, shares=pseudo_lm.word_shares(dealt)).collect()})
    assert got[0].keys() == got[1].keys() and all(got[1][k] == pytest.approx(v, rel=1e-4) for k, v in got[0].items())


@pytest.mark.parametrize("frequent", [0, 40, 1 << 18])
def test_shares_against_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(pseudo_lm, "FREQUENT", frequent)
    texts = ODD + [prose(i, 60, 3000) for i in range(40)]
    docs = documents(spark, texts, [(None, "x y", None, None, None), (4, "same id", None, None, None)])
    weights = pseudo_lm.train(docs)
    got = pseudo_lm.scored(docs.repartition(3), weights, shares=pseudo_lm.word_shares(docs.repartition(2))).collect()
    plain = pseudo_lm.scored(docs, weights).collect()
    own = [r.text for r in docs.collect()]
    low = lambda t: [w.lower() if w.isascii() else w for w in words(t)]
    count = Counter(w for t in own for w in low(t))
    data, offsets = utf8_block(pa.array(list(count)))
    of = {w: int(h >> np.uint64(54)) for w, h in zip(count, word_hashes(data, offsets, lower=True)[0])}
    total = Counter()
    for w, n in count.items():
        total[of[w]] += n
    want = [(p.doc_id, p.n_words, p.log_probability + sum(np.log(count[w] / total[of[w]]) for w in low(t))) for p, t in zip(plain, own)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for a, b in zip(sorted([(r.doc_id, r.n_words, r.log_probability) for r in got], key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-6, abs=1e-4)
    assert len(set(of.values())) < len(of)  # some words share a class
    empty = spark.createDataFrame([], SCHEMA)
    assert pseudo_lm.scored(empty, weights, shares=pseudo_lm.word_shares(empty)).collect() == []
