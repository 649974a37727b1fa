"""A keyed store whose batches are bucketed by the key, with a Bloom filter of each batch's keys.

The batches are partitions of a catalogue table at the store's path, ``CLUSTERED BY`` the key: a lookup
exchanges the requests into the store's buckets and leaves the store's rows where they are, and the newest
row of a key is found within its bucket. A batch that is written again replaces its own partition, as in
``KeyedStore``.

Beside the table lies a filter of each batch: a bitmap of ``BITS`` bits a key or more, as rows (word number, 64
bits), so it is built, kept and probed as a table and never sent to the driver whole. A lookup of a few
keys first asks the filters which batches can hold any of them and reads only those; the driver gets the numbers of
these batches. With ``PROBES`` bits a key about one absent key in 5,000 passes a batch's filter, so requests of
many thousands of keys meet nearly every batch: ``filtered=False`` leaves the filters out for them.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuemill.operators.store import last_wins
from valuemill.sources.files import path_missing
from valuemill.sources.keyed_store import BATCH, KeyedStore

BITS, PROBES = 32, 4
_FILTER_SCHEMA = f"size int, word long, bits long, {BATCH} long"


class BucketedStore(KeyedStore):
    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType, order: list[str], buckets: int = 64, filtered: bool = True):
        """``buckets`` is fixed for all batches at ``path``; take about the partitions of a lookup's shuffle."""
        super().__init__(spark, path, key, schema, order)
        self.buckets, self.filtered = buckets, filtered
        self.table = "bucketed_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        if not spark.catalog.tableExists(self.table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            where = self.path.replace("'", "\\'")
            spark.sql(f"CREATE TABLE {self.table} ({columns}, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH}) "
                      f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{where}'")
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)  # a repair fails without the folder
            spark.sql(f"MSCK REPAIR TABLE {self.table}")  # what another session wrote

    def _all(self) -> DataFrame:
        return self.spark.table(self.table)

    def _filters(self) -> DataFrame:
        try:
            return self.spark.read.schema(_FILTER_SCHEMA).parquet(f"{self.path}_filters")
        except AnalysisException as e:
            if not path_missing(e):
                raise
            return self.spark.createDataFrame([], _FILTER_SCHEMA)

    def batches(self) -> list[int]:
        """Numbers of the stored batches, from the catalogue."""
        return sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect())

    def next_batch(self) -> int:
        return max(self.batches(), default=-1) + 1

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Store ``rows`` as batch ``batch_id`` (newest row per key within the batch), one file a bucket, and its filter."""
        names = self.schema.fieldNames()
        uniq = last_wins(rows.select(*names).repartition(self.buckets, self.key), [self.key], self.order)
        quoted = ", ".join(f"`{n}`" for n in names)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION ({BATCH}={int(batch_id)}) SELECT {quoted} FROM {{uniq}}", uniq=uniq)
        keys = self._all().where(F.col(BATCH) == int(batch_id)).select(self.key)
        size = max(6, (max(1, keys.count()) * BITS - 1).bit_length())  # the bitmap has 2^size bits
        word, mask = self._probe(F.lit(size))
        bits = keys.select(F.explode(F.sequence(F.lit(1), F.lit(PROBES))).alias("probe"), self.key).select(word.alias("word"), mask.alias("mask"))
        bits.groupBy("word").agg(F.bit_or("mask").alias("bits")).select(F.lit(size).alias("size"), "word", "bits") \
            .write.mode("overwrite").parquet(f"{self.path}_filters/{BATCH}={int(batch_id)}")

    def write_batches(self, rows: DataFrame, batch_col: str) -> None:
        """Bulk load: every distinct ``batch_col`` value becomes one batch, one after the other."""
        for (n,) in sorted(rows.select(F.col(batch_col).cast("long")).distinct().collect()):
            self.write_batch(rows.where(F.col(batch_col).cast("long") == n), n)

    def _probe(self, size: Column) -> tuple[Column, Column]:
        """(word, mask) of the bit that the column ``probe`` sets for the key in a bitmap of 2^size bits."""
        power = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))
        bit = F.pmod(F.shiftrightunsigned(F.xxhash64(F.col(self.key), F.col("probe")), 1), power(size))
        return F.shiftright(bit, 6), power(F.pmod(bit, F.lit(64)))

    def may_hold(self, keys: DataFrame) -> DataFrame:
        """batch_id of the batches whose filter passes at least one of ``keys``: all that hold one, and few others."""
        filters = self._filters()
        sizes = [r["size"] for r in filters.select("size").distinct().collect()]  # at most 63 powers of two
        probes = keys.select(self.key).distinct().select(self.key, F.explode(F.array(*[F.lit(s) for s in sizes]).cast("array<int>")).alias("size")) \
            .select(self.key, "size", F.explode(F.sequence(F.lit(1), F.lit(PROBES))).alias("probe"))
        word, mask = self._probe(F.col("size"))
        met = filters.join(probes.withColumn("word", word).withColumn("mask", mask), ["size", "word"]).where("bits & mask != 0")
        return met.groupBy(BATCH, self.key).agg(F.count("*").alias("n")).where(F.col("n") == PROBES).select(BATCH).distinct()

    def rows_for(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Newest row of each key present in ``keys``, from the batches that can hold one; with ``before`` only of batches below it."""
        numbers = self.batches() if not self.filtered else [r[0] for r in self.may_hold(keys).collect()]
        numbers = [n for n in numbers if before is None or n < before]
        rows = self._all().where(F.col(BATCH).isin(numbers) if numbers else F.lit(False))
        hit = rows.join(keys.select(self.key).distinct(), self.key, "left_semi")
        return last_wins(hit, [self.key], [BATCH] + self.order).drop(BATCH)

    def compact(self, new_path: str) -> BucketedStore:
        """Write the newest row per key as batch 0 of a new store at ``new_path``."""
        new = BucketedStore(self.spark, new_path, self.key, self.schema, self.order, self.buckets, self.filtered)
        new.write_batch(self.current(), 0)
        return new
