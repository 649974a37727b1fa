"""Line deduplication: explode normalised lines, hash, count documents per hash, drop frequent lines, reassemble by position.

DataFrame operations only. The text itself moves once, in the last join; counting and marking move
16-byte hashes and positions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuemill.session import materialize

#: Stripped at both ends of a line: blank and code points 9 to 13.
STRIPPED = " \t\n\x0b\f\r"


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(STRIPPED)), string.ascii_uppercase, string.ascii_lowercase)


def _hash(key: Column, shortest: int) -> Column:
    """md5 of a key as 16 bytes; null for a key that is too short to be dropped."""
    return F.when(F.length(key) >= shortest, F.unhex(F.md5(key)))


def drop_frequent_lines(docs: DataFrame, threshold: int = 10, shortest: int = 1, id_col: str = "doc_id", text: str = "text", copies_once: bool = False) -> DataFrame:
    """Every row and column of ``docs``, its text without lines whose key is in ``threshold`` rows or more; adds n_lines, n_dropped.

    Columns of those two names are replaced. A row is a document; with ``copies_once``, rows whose texts have the same
    keys in the same order (empty ones aside) are one document in the count, so copies of a text don't make its lines
    frequent. A null or empty text is one empty line, which stays, and gives an empty text. Rows that are equal are treated alike.
    """
    docs = docs.drop("n_lines", "n_dropped")
    named = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"),
                        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("content"), _lines(text).alias("lines"))
    hashes = F.transform("lines", lambda x: _hash(line_key(x), shortest))
    counted = named.select(F.explode(F.array_distinct(hashes)).alias("line")).where("line is not null")
    if copies_once:
        keys = F.filter(F.transform("lines", line_key), lambda k: k != "")
        # The digest is taken below the explode, once a text and not once a line.
        counted = (named.select(F.unhex(F.md5(F.array_join(keys, "\n"))).alias("whole"), F.array_distinct(hashes).alias("own"))
                   .select("whole", F.explode("own").alias("line")).where("line is not null").distinct().select("line"))
    # Written, so that the join below reads two plain exchanges and Spark can split the rows of a very common line.
    frequent = materialize(counted.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= threshold).select("line"), "frequent-lines")
    places = named.select("id", "content", F.posexplode(hashes).alias("pos", "line")).where("line is not null")
    marked = (places.join(frequent, "line").groupBy("id", "content").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
              .withColumnsRenamed({"id": "gone_id", "content": "gone_content"}))
    joined = named.join(marked, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("content") == F.col("gone_content")), "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    # What lies between dropped positions, slice by slice: linear in the lines of the text.
    ends = F.concat(gone, F.array(F.size("lines")))
    start = lambda i: F.coalesce(F.get(gone, i - 1), F.lit(-1)) + 1
    kept = F.flatten(F.transform(ends, lambda end, i: F.slice("lines", start(i) + 1, end - start(i))))
    new_text = F.when(F.size(gone) > 0, F.array_join(kept, "\n")).otherwise(F.coalesce(F.col(f"row.c{docs.columns.index(text)}"), F.lit("")))
    return joined.select(*[new_text.alias(c) if c == text else F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)],
                         F.size("lines").cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"))


LINE_SQL = r"""
WITH l AS (
  SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))),
f AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f USING (key) GROUP BY doc_id
"""
