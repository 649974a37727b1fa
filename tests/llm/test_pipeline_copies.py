"""Texts with many copies go through the line stage and leave one copy after the n-gram stage."""

import corpus_pipeline
from tests.llm.helpers import documents, prose
from valuemill.llm import line_dedup


def test_one_of_many_copies_stays(spark):
    copied, cased = prose(1, 40) + "\n" + prose(2, 40), prose(3, 50)
    texts = [copied] * 12 + [cased, cased.upper(), f"  {cased}\t", f"{cased}\n"] * 3 + [f"Subscribe now\n{prose(100 + i, 40)}" for i in range(10)]
    after = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, documents(spark, texts), "").collect()}
    assert after == {i: t.removeprefix("Subscribe now\n") for i, t in enumerate(texts)}
    rest = corpus_pipeline.near_duplicates(spark, corpus_pipeline.lines(spark, documents(spark, texts), ""), "")
    assert {r.doc_id for r in rest.collect()} == {0, 12, *range(24, 34)}


def test_the_operator_still_counts_rows(spark):
    assert {r.text for r in line_dedup.drop_frequent_lines(documents(spark, ["a b"] * 10), 10).collect()} == {""}


def test_a_row_goes_for_its_own_text(spark):
    from tests.llm.helpers import SCHEMA
    long, other = prose(7, 60), prose(8, 60)
    rows = [(1, long), (2, long), (2, other), (3, None), (None, long), (5, other + " x"), (7, long + " y"), (7, "a b"), (7, "a b")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).selectExpr("*", "doc_id as gone_id", "'m' as mark", "text as row", "1 as id", "2 as a")
    left = corpus_pipeline.near_duplicates(spark, df, "")
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(1, long), (2, other), (3, None), (None, long), (7, "a b"), (7, "a b")], key=str)
    assert all(r.gone_id == r.doc_id and r.row == r.text for r in left.collect())


def test_stages_keep_columns_of_clashing_names(spark, sf_dir):
    texts = [None, "", "one line\nshared", *[f"shared\nown words {i} " + prose(i, 30) for i in range(12)]]
    more = ["n_lines", "n_dropped", "fm_score", "fm_predicted", "fm_text", "fm_chars", "mix_cell", "plan_cell", "mix_words", "mix_topic", "mix_sampled", "cell", "draw", "row", "words"]
    df = documents(spark, texts).selectExpr("*", *[f"concat('{c}', doc_id) as {c}" for c in more])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, df, sf_dir)
        assert left.columns == df.columns, name
        rows = left.collect()
        assert name != "line dedup" or len(rows) == 15
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in more), name
        assert stage(spark, df.where("false"), sf_dir).collect() == [], name
    assert {r.doc_id for r in corpus_pipeline.encoding(spark, df, sf_dir).collect()} == set(range(15))
    assert corpus_pipeline.encoding(spark, df.where("false"), sf_dir).collect() == []
