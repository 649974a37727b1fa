import pytest

from tests.llm.helpers import ODD, SCHEMA, crc, documents, prose
from valuemill.llm import sharding


def check(rows, docs, shards):
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in rows) == \
        sorted((d[0] if d[0] is not None else -1, len((d[1] or "").encode()) + 8, crc(d[1])) for d in docs)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert {r.law for r in rows} <= {"bytes"} and all(r.grown_shard is None and 0 <= r.shard < shards for r in rows)


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_equal_bytes_within_one_row(spark, shards):
    df = documents(spark, [prose(i, 3 + i % 60) for i in range(600)] + [prose(7, 10)] * 200)
    rows = sharding.histogram_shards(df, shards).collect()
    check(rows, [(r.doc_id, r.text) for r in df.collect()], shards)
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    for s in range(shards):
        assert abs(sum(r.size for r in rows if r.shard == s) - total / shards) <= 2 * most


def test_a_text_that_most_rows_share_is_split_by_id(spark):
    df = documents(spark, ["one text"] * 400 + [f"t{i}" for i in range(100)])
    rows = sharding.histogram_shards(df, 4).collect()
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)


def test_odd_rows_and_clashing_columns(spark):
    df = documents(spark, ODD, [(None, "no id", None, None, None), (3, "same id", "x", None, 1), (3, "same id", "x", None, 1)])
    for c in ("shard", "size", "h", "d", "bin", "slot", "law"):
        df = df.withColumn(c, df["doc_id"].cast("string"))
    rows = sharding.histogram_shards(df, 3).collect()
    check(rows, [(r.doc_id, r.text) for r in df.collect()], 3)


def test_empty(spark):
    assert sharding.histogram_shards(spark.createDataFrame([], SCHEMA)).collect() == []


def test_written_shards_hold_all_rows(spark, tmp_path):
    df = documents(spark, ODD + [prose(i, 9) for i in range(40)])
    sharding.write_shards(df, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
