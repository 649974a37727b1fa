"""Order of the turns of conversations, also of one that holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuemill.session import materialize

#: Rows of one conversation in a block of the second level of a scan.
BLOCK = 1024


class Placed:
    """Rows in the order of their conversations, written; their places are found without a task that holds a conversation.

    Range partitions cut a large conversation into pieces that are numbered apart; what lies before a piece comes from the
    pieces' counts, one row for each conversation and partition. Rows equal in ``order`` are numbered in any order. A null
    conversation is one of its own.
    """

    def __init__(self, rows: DataFrame, conv: str, order: list[str | Column], name: str):
        n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        keys = [F.col(conv).asc_nulls_first(), *order, F.col("tie")]
        self.conv, self.columns = conv, rows.columns
        tied = rows.withColumn("tie", F.monotonically_increasing_id())  # so that many equal rows are cut as well
        self.rows = materialize(tied.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("tie")
                                .withColumn("piece", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), name)
        found = self.rows.groupBy(F.col(conv).alias("piece_conv"), F.col("piece").alias("in_piece")).agg(F.min("nth").alias("first"), F.count("*").alias("n"))
        ahead = Window.partitionBy("piece_conv").orderBy("in_piece").rowsBetween(Window.unboundedPreceding, -1)
        self.pieces = found.select("piece_conv", "in_piece", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))

    def positioned(self, extra: DataFrame | None = None, extra_conv: str = "") -> DataFrame:
        """The rows with ``pos`` (long, from 0), and the columns of ``extra``, at most one row for each conversation (null where there is none).

        ``extra`` meets the pieces, not the rows: (conversation, piece) has no hot key.
        """
        pieces, names = self.pieces, []
        if extra is not None:
            names = [c for c in extra.columns if c != extra_conv]
            pieces = pieces.join(extra, F.col("piece_conv").eqNullSafe(F.col(extra_conv)), "left")
        same = F.col(self.conv).eqNullSafe(F.col("piece_conv")) & (F.col("piece") == F.col("in_piece"))
        return self.rows.join(pieces, same).select(*self.columns, (F.col("nth") - F.col("first") + F.col("ahead")).alias("pos"), *names)


def running(rows: DataFrame, keys: list[str], index: str, values: dict[str, str], combine=F.sum, zero=0, backward: bool = False) -> DataFrame:
    """``rows`` with, for each ``value: new`` of ``values``, ``combine`` over the rows of its keys before it by ``index`` (after it if ``backward``).

    ``index`` is unique within the keys. Two levels: blocks of ``BLOCK`` indices are combined first, so no window runs over more than
    the blocks of a key or the rows of a block.
    """
    block = F.floor(F.col(index) / BLOCK)
    by = (lambda c: F.col(c).desc()) if backward else F.col
    ahead = Window.partitionBy(*keys).orderBy(by("scan_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*keys, block.alias("scan_block")).agg(*[combine(v).alias(f"scan_{new}") for v, new in values.items()])
    blocks = blocks.select(*[F.col(k).alias(f"scan_key_{i}") for i, k in enumerate(keys)], F.col("scan_block").alias("scan_at"),
                           *[F.coalesce(combine(f"scan_{new}").over(ahead), F.lit(zero)).alias(f"scan_{new}") for new in values.values()])
    inside = Window.partitionBy(*keys, "scan_block").orderBy(by(index)).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("scan_block", block).select("*", *[F.coalesce(combine(v).over(inside), F.lit(zero)).alias(new) for v, new in values.items()])
    same = (F.col("scan_block") == F.col("scan_at"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"scan_key_{i}"))
    joined = local.join(blocks, same)
    both = (lambda a, b: a + b) if combine is F.sum else (lambda a, b: a.bitwiseXOR(b))
    return joined.select(*[F.col(c) for c in rows.columns], *[both(F.col(new), F.col(f"scan_{new}")).alias(new) for new in values.values()])
