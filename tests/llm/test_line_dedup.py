from collections import Counter

from tests.llm.helpers import ODD, SCHEMA, SPACE, UPPER, documents
from valuemill.llm import line_dedup


def brute(texts, threshold):
    lines = [(t or "").split("\n") for t in texts]
    key = lambda x: x.strip(SPACE).translate(UPPER)
    found = Counter(k for own in lines for k in {key(x) for x in own} if k)
    gone = {k for k, n in found.items() if n >= threshold}
    return [(len(own), sum(key(x) in gone for x in own), "\n".join(x for x in own if key(x) not in gone)) for own in lines]


def run(df, threshold):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_frequent_lines(df, threshold).collect()}


def test_against_brute_force(spark):
    texts = ODD + [f"  Shared Line\t\nown {i}\n\nshared line\n" + ("\n".join(["other"] * i) if i % 2 else "tail") for i in range(30)]
    texts += ["shared line", "shared line\nSHARED LINE ", "İ\ni̇", "a\n a\n"]
    df = documents(spark, texts)
    for threshold in (1, 2, 10, 1000):
        assert list(dict(sorted(run(df, threshold).items())).values()) == brute(texts, threshold)


def test_other_columns_stay_and_clashing_names_are_safe(spark):
    df = documents(spark, ["a\nb", "a", "a"]).selectExpr("doc_id", "text", "lang as lines", "source as gone", "n_chars as pos", "'x' as line", "1 as id", "2 as content", "3 as n_lines")
    rows = line_dedup.drop_frequent_lines(df, 3).collect()
    assert {(r.doc_id, r.text, r.lines, r.gone, r.line, r.id, r.content, r.n_lines, r.n_dropped) for r in rows} == \
        {(0, "b", "fr", "s0", "x", 1, 2, 2, 1), (1, "", "en", "s1", "x", 1, 2, 1, 1), (2, "", "en", "s2", "x", 1, 2, 1, 1)}


def test_null_and_repeated_ids(spark):
    rows = [(None, "k\nx", None, None, 1), (None, "k\ny", None, None, 1), (5, "k\nz", None, None, 1), (5, "k\nz", None, None, 1)]
    got = line_dedup.drop_frequent_lines(spark.createDataFrame(rows, SCHEMA), 4).collect()
    assert sorted(r.text for r in got) == ["x", "y", "z", "z"]


def test_empty(spark):
    assert line_dedup.drop_frequent_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = line_dedup.drop_frequent_lines(documents(spark, ["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
