"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined until exact, then one exchange.

DataFrame operations only. Rows are ordered by (first 60 bits of the text's md5, id), so equal texts
lie side by side. Law ``bytes``: a row goes to shard ``floor(n * bytes before it / all bytes)``, so
every shard has its equal part of the bytes but for less than one row at each end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuemill.session import materialize

#: A bracket is cut into at most 2 ** PROBE_BITS (+ 1) parts in each round; the first round has 2 ** FIRST_BITS.
PROBE_BITS, FIRST_BITS, KEY_BITS = 10, 12, 60
#: Slots are numbered in parts of a shard: key ranges times SALTS classes of the id.
PART_BITS, SALTS = 9, 16


def _text_key() -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(F.col("text"), F.lit(""))), 1, KEY_BITS // 4), 16, 10).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the sort key (h, d) of each row; a null id sorts first."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), _text_key().alias("h"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"))


def _inside(b: tuple) -> Column:
    """Rows of a bracket (hash or None, lowest, highest): a range of h, or of d within one hash."""
    h, lo, hi = b
    return F.col("h").between(lo, hi) if h is None else (F.col("h") == h) & F.col("d").between(lo, hi)


def _part(b: tuple) -> Column:
    h, lo, hi = b
    shift = max(0, (hi - lo).bit_length() - PROBE_BITS)
    return F.shiftright(F.col("h" if h is None else "d"), shift) - F.lit(lo >> shift)


def _counts(keys: DataFrame, brackets: list[tuple]) -> dict[tuple, list]:
    """Exact bytes of each part of each bracket, in key order: at most 2 ** PROBE_BITS + 1 rows for each."""
    which, part = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i, b in enumerate(brackets):
        which, part = F.when(_inside(b), F.lit(i)).otherwise(which), F.when(_inside(b), _part(b)).otherwise(part)
    rows = (keys.select(which.alias("i"), part.alias("part"), "h", "d", "size").where("i is not null")
            .groupBy("i", "part").agg(F.sum("size").alias("bytes"), *(f(c).alias(f"{f.__name__}_{c}") for c in "hd" for f in (F.min, F.max)))
            .collect())
    found: dict[tuple, list] = {b: [] for b in brackets}
    for r in sorted(rows, key=lambda r: (r["i"], r["part"])):
        found[brackets[r["i"]]].append(r)
    return found


def splitters(keys: DataFrame, shards: int) -> list[tuple[int, int]]:
    """For each k from 1 on, the last key (h, d) that stays below boundary k: the greatest whose bytes before it are under k / shards of all.

    Each round counts bytes in all parts of the brackets that still hold a boundary and keeps the part
    that holds it. It ends when every bracket is one key, after about log(rows) / PROBE_BITS rounds.
    """
    first = (keys.groupBy(F.shiftright("h", KEY_BITS - FIRST_BITS).alias("part"))
             .agg(F.sum("size").alias("bytes"), *(f(c).alias(f"{f.__name__}_{c}") for c in "hd" for f in (F.min, F.max))).collect())
    first.sort(key=lambda r: r["part"])
    total = sum(r["bytes"] for r in first)

    def narrow(parts: list, base: int, k: int) -> tuple[tuple, int]:
        for r in parts:
            if shards * base >= k * total:
                break
            kept, below = r, base
            base += r["bytes"]
        if kept["min_h"] < kept["max_h"]:
            return (None, kept["min_h"], kept["max_h"]), below
        return (kept["min_h"], kept["min_d"], kept["max_d"]), below

    if not total:
        return []
    at = {k: narrow(first, 0, k) for k in range(1, shards)}
    while wide := sorted({b for b, _ in at.values() if b[0] is None or b[1] < b[2]}, key=str):
        counts = _counts(keys, wide)
        at = {k: narrow(counts[b], base, k) if b in counts else (b, base) for k, (b, base) in at.items()}
    return [(at[k][0][0], at[k][0][1]) for k in range(1, shards)]


def histogram_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Assign every row of ``docs`` (doc_id, text; more columns are ignored) to a shard from 0 on.

    Returns doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard (null).
    Null texts count as empty (size 8); a null id is kept; rows equal in text and id stay in one shard;
    an empty table gives an empty result. The driver gets only counts of probed key ranges.
    """
    keys = materialize(keyed(docs), "shard-keys")
    shard = F.lit(0)
    for h, d in splitters(keys, shards):
        shard = shard + ((F.col("h") > h) | ((F.col("h") == h) & (F.col("d") > d))).cast("int")
    parts = ["shard", "bin", "salt"]
    placed = (keys.withColumn("shard", shard.cast("int"))
              .withColumn("bin", F.shiftright("h", KEY_BITS - PART_BITS))
              .withColumn("salt", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(SALTS))))
    # At most (2 ** PART_BITS + shards) * SALTS rows, whatever the input: numbered in one task, small enough to broadcast.
    sizes = placed.groupBy(*parts).agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("bin", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*parts, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy(*parts).orderBy("h", "d")
    return (placed.withColumn("at", F.row_number().over(within))
            .join(F.broadcast(offsets), parts)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("ahead") + F.col("at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Write the documents into folders ``shard=N`` of ``path``, each row once."""
    placed = histogram_shards(docs.select("doc_id", "text"), shards).select("doc_id", "text_crc32", "shard").distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    extra = {"shard", "text_crc32"} & set(docs.columns)
    rows = docs.drop(*extra).withColumn("text_crc32", F.crc32(F.encode(text, "UTF-8")))
    (rows.join(placed.withColumnRenamed("doc_id", "placed_id"),
               F.col("doc_id").eqNullSafe(F.col("placed_id")) & (rows["text_crc32"] == placed["text_crc32"]))
     .drop("placed_id", "text_crc32").hint("rebalance", "shard").write.partitionBy("shard").mode("overwrite").parquet(path))


#: DuckDB, for unique ids. CRC-32 (polynomial 0xEDB88320) is computed byte by byte.
SHARD_SQL = f"""
WITH t AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS crc
  FROM range(256) r(n)),
k AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, hex(encode(coalesce(text, ''))) AS bytes,
         ('0x' || substr(md5(coalesce(text, '')), 1, {KEY_BITS // 4}))::BIGINT AS h FROM documents),
s AS (
  SELECT *, least(23, (24 * (sum(size) OVER (ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size)) // (SELECT sum(size) FROM k)) AS shard FROM k)
SELECT doc_id, size::BIGINT AS size, 'bytes' AS law, shard::INTEGER AS shard,
       xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(size - 8), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT)),
                       lambda c, x: xor(c >> 8, t.crc[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
       row_number() OVER (PARTITION BY shard ORDER BY h >> {KEY_BITS - PART_BITS}, doc_id % {SALTS}, h, doc_id) - 1 AS slot,
       NULL::INTEGER AS grown_shard FROM s, t
"""
