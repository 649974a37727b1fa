from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.helpers import ODD, SCHEMA, documents, sha
from valuemill.llm import streaming_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        known = [x for x in groups[t or ""] if x is not None]
        keep = max(known) if known else None
        out.append((i, keep, len(groups[t or ""]), i == keep, sha(t)))
    return sorted(out, key=str)


def got(dedup, path):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in dedup.result(path).collect()), key=str)


def test_files_that_arrive_in_turn(spark, tmp_path):
    path = str(tmp_path / "docs")
    first = documents(spark, ODD + ["copy"] * 30 + [f"own {i}" for i in range(20)], [(None, "copy", None, None, None), (200, "only null", None, None, None)])
    first = first.withColumn("digest", F.lit("x")).withColumn("n", F.lit(1)).withColumn("file", F.lit("f"))
    first.repartition(4).write.parquet(path)
    dedup = streaming_dedup.StreamingDedup(spark, str(tmp_path / "state"), batch_bytes=2000)
    dedup.advance(path)
    assert got(dedup, path) == brute([(r.doc_id, r.text) for r in first.collect()])
    documents(spark, ["copy", "own 3", "new"]).withColumn("doc_id", F.col("doc_id") + 1000).withColumn("digest", F.lit("x")) \
        .withColumn("n", F.lit(1)).withColumn("file", F.lit("f")).write.mode("append").parquet(path)
    dedup.advance(path)  # the state of the first run is kept
    dedup.advance(path)  # nothing new
    assert got(dedup, path) == brute([(r.doc_id, r.text) for r in spark.read.parquet(path).collect()])


def test_texts_under_one_digest_are_kept_apart(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    documents(spark, ["a", "a", "b", "b", "b", "c"]).write.parquet(path)
    monkeypatch.setattr(streaming_dedup.F, "sha2", lambda c, n: F.lit("same"))
    dedup = streaming_dedup.StreamingDedup(spark, str(tmp_path / "state"))
    dedup.advance(path)
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in dedup.result(path).collect()}
    assert rows == {0: (1, 2, False), 1: (1, 2, True), 2: (4, 3, False), 3: (4, 3, False), 4: (4, 3, True), 5: (5, 1, True)}


def test_empty(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    dedup = streaming_dedup.StreamingDedup(spark, str(tmp_path / "state"))
    dedup.advance(path)
    assert got(dedup, path) == []
