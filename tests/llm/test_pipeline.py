"""The registered queries and the pipeline on the smallest table, each stage against brute force on its own input."""

import hashlib
import os

import pytest

import corpus_pipeline
from tests.llm.helpers import SCHEMA, SPACE, near_components, sha, words
from tests.llm.test_line_dedup import brute as brute_lines
from valuemill.llm.queries import QUERIES, tokenizer_path

DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(os.path.join(DIR, "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, DIR).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs.toArrow().to_pylist(), after.toArrow().to_pylist(), after.columns))
        docs = after
    return out


def test_columns_and_rows(stages):
    assert len(stages) == 5 and all(s[3] == COLUMNS for s in stages[:-1])
    for _, before, after, _ in stages:
        ids = [r["doc_id"] for r in after]
        assert 0 < len(ids) == len(set(ids)) and set(ids) <= {r["doc_id"] for r in before}


def test_quality_keeps_clean_documents(spark):
    larger = DIR.replace("0.001", "0.01")  # some dozen rejected documents to learn from
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, larger).select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    assert sum(i in kept for i, q in labels.items() if q == 1) >= 0.99 * sum(labels.values())
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.1 * sum(q == 0 for q in labels.values())


def test_lines_against_brute_force(stages):
    _, before, after, _ = stages[1]
    want = {}
    for r, (_, dropped, text) in zip(before, brute_lines([r["text"] for r in before], 10)):
        if not dropped or text.strip(SPACE):
            want[r["doc_id"]] = (text, len(text) if dropped else r["n_chars"])
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in after} == want


def test_one_of_each_near_group_stays(stages):
    _, before, after, _ = stages[2]
    parts = near_components([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after} == {i for i, (_, c) in parts.items() if i == c}


def raked(cells, share):
    """Expected tokens of each cell {(source, lang, topic): tokens}: bounded raking to tempered shares, levels by bisection."""
    size = share * sum(cells.values())

    def level(part, weight, wanted):
        low, high = 0.0, 1.0
        while sum(min(cells[c], high * weight[c]) for c in part) < wanted * (1 - 1e-13) and high < 1e30:
            high *= 2
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(cells[c], mid * weight[c]) for c in part) < wanted else (low, mid)
        return high

    now, goals = {c: share * n for c, n in cells.items()}, []
    for d in range(3):
        holds = {}
        for c, n in cells.items():
            holds[c[d]] = holds.get(c[d], 0) + n
        t = {k: v ** 0.7 / sum(x ** 0.7 for x in holds.values()) for k, v in holds.items() if v}
        low, high = 0.0, size * 1e6
        for _ in range(300):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(holds[k], mid * t[k]) for k in t) < size else (low, mid)
        goals.append({k: min(holds[k], high * t[k]) for k in t})
    for _ in range(300):
        for d, goal in enumerate(goals):
            for k, wanted in goal.items():
                part = [c for c in cells if c[d] == k and cells[c]]
                factor = level(part, now, min(wanted, sum(cells[c] for c in part)))
                for c in part:
                    now[c] *= factor
    final = level([c for c in cells if cells[c]], now, size)
    return {c: min(cells[c], final * now[c]) for c in cells}


def test_mixture_against_plain_raking(spark, stages):
    from valuemill.llm import mixing

    _, before, after, _ = stages[3]
    docs = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in before], SCHEMA)
    topic = {r.doc_id: r.t for r in docs.select("doc_id", mixing.topic_of(mixing.words("text")).alias("t")).collect()}
    cell = {r["doc_id"]: tuple("(null)" if x is None else x for x in (r["source"], r["lang"], topic[r["doc_id"]])) for r in before}
    cells = {}
    for r in before:
        cells[cell[r["doc_id"]]] = cells.get(cell[r["doc_id"]], 0) + len(words(r["text"]))
    want = raked(cells, mixing.KEPT)
    assert sum(want.values()) == pytest.approx(mixing.KEPT * sum(cells.values()))
    kept, close = set(), set()
    for r in before:
        key = hashlib.md5(f"{r['doc_id']}:1:{hashlib.md5((r['text'] or '').encode()).hexdigest()}".encode()).hexdigest()
        c = cell[r["doc_id"]]
        draw, chance = int(key[:13], 16) / float(1 << 52), want[c] / cells[c] if cells[c] else mixing.KEPT
        if draw < chance:
            kept.add(r["doc_id"])
        if abs(draw - chance) < 1e-3:
            close.add(r["doc_id"])
    assert {r["doc_id"] for r in after} - close == kept - close and len(close) <= 3
    assert 0 < len(kept) < len(before)


def test_encoding_against_the_library(stages):
    from tokenizers import Tokenizer
    import numpy as np

    t = Tokenizer.from_file(tokenizer_path())
    _, before, after, _ = stages[4]
    got = {r["doc_id"]: r for r in after}
    assert len(got) == len(before)
    for r in before:
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        own = got[r["doc_id"]]
        assert own["n_tokens"] == len(ids) and own["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert own["decoded_sha256"] == sha(t.decode(ids, skip_special_tokens=False))


def test_near_duplicates_of_the_whole_table(spark):
    rows = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    want = near_components([(r.doc_id, r.text) for r in rows])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op9_ngram_join"](spark, DIR).collect()} == want
