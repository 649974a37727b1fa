"""CSV files whose quoted fields hold line breaks, read by many tasks a file; types by the whole table.

Spark's text scan cuts a file into byte ranges ("blocks") at line breaks. Whether a line begins inside a quoted field
depends on the parity of all quotes before it in the file. So: one pass counts the quotes of each block; prefix
sums over the blocks give each block's starting parity; a second pass cuts every block into records from that parity.
A record that spans blocks leaves a fragment in each, which are joined by the block where it began. Nothing but the
fragments is shuffled. The driver holds one row a block, as many as the tasks that it plans for the scan anyway.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuemill.session import materialize
from valuemill.sources.files import READ_CSV

_BLOCKS = "file long, start long, odd boolean, even_end boolean, odd_end boolean, head string"
_PIECES = "file long, begin long, place long, piece string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array, np.ndarray]]:
    """((file, block), lines, whether each holds an odd number of quotes) in the order of the scan, which keeps a block's lines together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        odd = pc.count_substring(batch.column(2), '"').to_numpy(zero_copy_only=False) % 2 == 1
        cuts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), batch.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            yield (int(file[at]), int(start[at])), batch.column(2).slice(at, end - at), odd[at:end]


def block_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: whether its quotes are odd in number, whether a line ends after an even (odd) number of them, and a file's first line."""
    now, odd, ends, head = None, False, [False, False], None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"file": now[0], "start": now[1], "odd": odd, "even_end": ends[0], "odd_end": ends[1], "head": head}],
                                          pa.schema([("file", pa.int64()), ("start", pa.int64()), ("odd", pa.bool_()), ("even_end", pa.bool_()), ("odd_end", pa.bool_()), ("head", pa.string())]))

    for block, lines, quoted in _by_block(batches):
        if block != now:
            if now is not None:
                yield out()
            now, odd, ends, head = block, False, [False, False], lines[0].as_py() if block[1] == 0 else None
        after = np.logical_xor.accumulate(quoted) ^ odd
        ends, odd = [ends[0] or not after.all(), ends[1] or bool(after.any())], bool(after[-1])
    if now is not None:
        yield out()


def starts(blocks: list) -> dict[tuple[int, int], tuple[bool, int | None]]:
    """(file, block) -> (begins inside quotes, block where the record that is open there began)."""
    found, file, odd, begun = {}, None, False, None
    for b in sorted(blocks, key=lambda b: (b["file"], b["start"])):
        if b["file"] != file:
            file, odd, begun = b["file"], False, None
        found[b["file"], b["start"]] = (odd, begun if odd else None)
        ended = b["odd_end"] if odd else b["even_end"]
        odd ^= b["odd"]
        if odd and (ended or begun is None):
            begun = b["start"]
        if not odd:
            begun = None
    return found


def _records(known: dict):
    """Records of each block in order: whole ones without ``begin``, fragments with the block where their record began. Headers are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, odd, begin, header = None, [], False, None, False

        def rows(pieces: pa.Array, begun: int | None = None) -> pa.RecordBatch:
            n = len(pieces)
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * n, pa.int64()), pa.array([begun] * n, pa.int64()), pa.array([now[1]] * n, pa.int64()), pieces],
                                              ["file", "begin", "place", "piece"])

        def fragment(begun: int | None) -> pa.RecordBatch:
            return rows(pa.array(["\n".join(held)], kind), now[1] if begun is None else begun)

        for block, lines, quoted in _by_block(batches):
            kind = lines.type
            if block != now:
                if held:
                    yield fragment(begin)
                if block not in known:
                    raise RuntimeError("the scan's splits changed between the two passes; read again")
                now, held, (odd, begin) = block, [], known[block]
                header = block[1] == 0
            inside = np.logical_xor.accumulate(quoted) ^ odd  # after each line
            odd, last = bool(inside[-1]), np.flatnonzero(~inside)
            if not len(last):
                held += lines.to_pylist()
                continue
            first = np.concatenate([[0], last[:-1] + 1])
            held += lines.slice(0, last[0] + 1).to_pylist()
            if header:
                header, pieces = False, []
            elif begin is not None:
                yield fragment(begin)
                begin, pieces = None, []
            else:
                pieces = ["\n".join(held)]
            one = first[1:] == last[1:]
            if one.all():
                found = pa.concat_arrays([pa.array(pieces, kind), lines.take(pa.array(last[1:]))])
            else:
                texts = lines.to_pylist()
                found = pa.array(pieces + ["\n".join(texts[a:b + 1]) for a, b in zip(first[1:].tolist(), last[1:].tolist())], kind)
            held = lines.slice(last[-1] + 1).to_pylist()
            found = found.filter(pc.greater(pc.binary_length(found), 0))
            if len(found):
                yield rows(found)
        if held:
            yield fragment(begin)
    return run


def read_records(spark: SparkSession, path: str, names: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """(record: one row a CSV record as it stands in the files, names of the header).

    Every file begins with the same header, of one line, which must be ``names`` if given. Empty lines outside quotes are no records.
    Quotes are doubled inside quoted fields. The records are written once under the checkpoint folder.
    """
    lines = _lines(spark, path)
    blocks = lines.mapInArrow(block_quotes, _BLOCKS).collect()  # one row a split
    heads = {b["head"].removesuffix("\r") for b in blocks if b["start"] == 0}
    if len(heads) > 1 or any(h.count('"') % 2 for h in heads):
        raise ValueError("the files' headers differ or hold line breaks")
    found = next(csv.reader(heads)) if heads else list(names or [])
    if names is not None and found != names:
        raise ValueError(f"header {found} is not {names}")
    known = starts(blocks)
    rows = materialize(lines.mapInArrow(_records(known), _PIECES), "csv-records")
    whole = rows.where("begin IS NULL").select(F.col("piece").alias("record"))
    parts = rows.where("begin IS NOT NULL").groupBy("file", "begin").agg(F.sort_array(F.collect_list(F.struct("place", "piece"))).alias("parts"))
    joined = parts.select(F.concat_ws("\n", F.transform("parts", lambda p: p["piece"])).alias("record"))
    return whole.unionAll(joined).select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''"), found


def _parsed(records: DataFrame, schema: T.StructType, corrupt_col: str | None = None) -> DataFrame:
    options = {k: str(v) for k, v in READ_CSV.items() if k != "header"} | {"multiLine": "true", "mode": "PERMISSIVE" if corrupt_col else "FAILFAST"}
    if corrupt_col:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_col
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType | str, corrupt_col: str | None = None) -> DataFrame:
    """``read_csv`` with a schema, but one file is read by as many tasks as it has splits, also if quoted fields hold line breaks."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return _parsed(read_records(spark, path, schema.fieldNames())[0], schema, corrupt_col)


# Texts that count as a gap, and those of truth values.
GAPS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
TRUE, FALSE = ["True", "TRUE", "true"], ["False", "FALSE", "false"]
_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_ENDLESS = r"^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"


_KINDS = ["gap", "bool", "int64", "float64", "string"]


def _kind(c: Column) -> Column:
    """What one text can be, as a bit: the place in _KINDS."""
    whole = c.rlike(_WHOLE)
    bit = {k: F.lit(1 << i) for i, k in enumerate(_KINDS)}
    return (F.when(c.isNull() | c.isin(GAPS), bit["gap"]).when(c.isin(TRUE + FALSE), bit["bool"])
            .when(whole, F.when(F.trim(c).try_cast("long").isNotNull(), bit["int64"]).otherwise(bit["string"]))
            .when(c.rlike(_NUMBER) | c.rlike(_ENDLESS), bit["float64"]).otherwise(bit["string"]))


def infer_types(df: DataFrame) -> dict[str, str]:
    """Type of each text column by all its values, in one aggregate: int64 < float64 < string; gaps lift int64 to float64; only gaps: float64.

    bool if all are truth values; truth values with gaps or anything else are strings, and so are whole numbers beyond 64 bits. No rows: string.
    """
    cells = df.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in df.columns])).alias("at", "cell")) if df.columns else None  # one small expression for all columns
    rows = cells.groupBy("at").agg(F.bit_or(_kind(F.col("cell"))).alias("kinds")).collect() if df.columns else []  # a row a column
    found = {r["at"]: r["kinds"] for r in rows}
    types = {}
    for i, c in enumerate(df.columns):
        has = {k for j, k in enumerate(_KINDS) if found.get(i, 0) >> j & 1}
        if not has or "string" in has or ("bool" in has and len(has) > 1):
            types[c] = "string"
        elif has == {"bool"} or has == {"int64"}:
            types[c] = has.pop()
        else:
            types[c] = "float64"
    return types


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns in their types; gaps are null in every type."""
    def cell(name: str) -> Column:
        c = F.col(f"`{name}`")
        known = F.when(~c.isin(GAPS), c)
        if types[name] == "string":
            return known
        if types[name] == "bool":
            return known.isin(TRUE)
        if types[name] == "int64":
            return F.trim(known).cast("long")
        short = F.lower(known)
        return F.when(short.rlike(r"^-inf"), F.lit(float("-inf"))).when(short.rlike(r"^\+?inf"), F.lit(float("inf"))).otherwise(F.trim(known).try_cast("double"))
    return df.select(*[cell(c).alias(c) for c in df.columns])


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV with a header as texts; split-safe."""
    records, names = read_records(spark, path)
    return _parsed(records, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV without a schema: split-safe scan, types by ``infer_types`` over all rows."""
    texts = read_texts(spark, path)
    return typed(texts, infer_types(texts))
