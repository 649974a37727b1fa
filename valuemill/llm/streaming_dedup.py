"""Exact deduplication by a stateful stream.

A file stream reads the documents in micro-batches. Its state, kept by Spark in RocksDB on the
executors' disks and in the shared checkpoint, has one entry for each digest and never expires:
the stable identifier (largest id so far), the number of rows and the content locator (file and id of
the row that holds the bytes). Rows of one digest are combined before the shuffle, so a group that
holds a third of all rows sends one row for each task. Digests met more than once are hits: their
full bytes are compared, and rows whose bytes differ under one digest are kept apart.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemill.session import materialize, scratch_path

#: Bytes that one micro-batch reads.
BATCH_BYTES = 1 << 30
_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
          "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
          # Without it, each of the many small stores takes megabytes of disk in advance.
          "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _digest(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), whole.alias("body"), F.sha2(whole, 256).alias("digest"))


class StreamingDedup:
    """State and output of one stream under ``root``; ``advance`` may run again when files were added."""

    def __init__(self, spark: SparkSession, root: str | None = None, batch_bytes: int = BATCH_BYTES):
        self.spark, self.batch_bytes = spark, batch_bytes
        self.root = root or scratch_path(spark, "streaming-dedup")

    def advance(self, path: str, id_col: str = "doc_id", text: str = "text") -> None:
        """Take all files of ``path`` (Parquet) that were not read yet. A micro-batch that is repeated replaces its own output."""
        schema = self.spark.read.parquet(path).select(id_col, text).schema
        one = path.rstrip("/")
        path = f"{one[:-1]}[{one[-1]}]"  # a pattern for just this path: a plain one would have to be a folder
        rows = (self.spark.readStream.schema(schema).option("maxBytesPerTrigger", str(self.batch_bytes)).parquet(path)
                .withColumn("file", F.col("_metadata.file_path")))
        whole = F.coalesce(F.col(text), F.lit(""))
        ident = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
        state = (rows.select(F.sha2(whole, 256).alias("digest"), ident.alias("id"), "file")
                 .groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("id", "file")).alias("locator")))

        def put(changed: DataFrame, batch: int) -> None:
            changed.write.mode("overwrite").parquet(f"{self.root}/changed/batch={batch}")

        with _set(self.spark, _STATE):
            query = (state.writeStream.outputMode("update").foreachBatch(put)
                     .option("checkpointLocation", f"{self.root}/state").trigger(availableNow=True).start())
            query.awaitTermination()

    def entries(self) -> DataFrame:
        """digest, n, keep_id, file: the newest value of each entry of the state; counts and ids only grow."""
        changed = self.spark.read.schema("digest string, n long, locator struct<id:long,file:string>").parquet(f"{self.root}/changed")
        return (changed.groupBy("digest").agg(F.max("n").alias("n"), F.max("locator").alias("locator"))
                .select("digest", "n", F.col("locator.id").alias("keep_id"), F.col("locator.file").alias("file")))

    def result(self, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

        Null texts count as empty; the row with the largest id of equal texts stays (of rows that share
        that id, all are marked kept); a null id is below all others. An empty table gives no rows.
        """
        docs, entries = _digest(self.spark.read.parquet(path), id_col, text), self.entries()
        low = F.coalesce("id", F.lit(-(1 << 63)))
        hits = entries.where("n > 1").select("digest")
        # The bytes of the hits, grouped by themselves: one group for each digest unless two texts share it.
        bodies = docs.join(hits, "digest").groupBy("digest", "body").agg(F.count("*").alias("own_n"), F.max(low).alias("own_keep"))
        clashing = materialize(bodies.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest"), "digest-clashes")
        rows = docs.select("id", "digest").join(entries.select("digest", "n", "keep_id"), "digest")
        if not clashing.isEmpty():  # then their bytes are read again
            apart = bodies.join(clashing, "digest").select(F.col("digest").alias("d"), F.col("body").alias("own_body"), "own_n", "own_keep")
            mixed = (docs.join(clashing, "digest").join(apart, (F.col("digest") == F.col("d")) & (F.col("body") == F.col("own_body")))
                     .select("digest", "id", F.col("own_n").alias("n"), F.col("own_keep").alias("keep_id")))
            rows = rows.join(clashing, "digest", "left_anti").unionByName(mixed)
        null_id = F.lit(-(1 << 63))
        return rows.select(
            F.col("id").alias("doc_id"), F.nullif("keep_id", null_id).alias("keep_id"), F.col("n").alias("group_size"),
            (low == F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
