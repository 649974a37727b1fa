"""Scans and sinks (CSV with header, Parquet) and the optional source.

Scans take an explicit schema (no inference pass over the data); ``infer=True`` is a fallback for
ad-hoc files only. The default sink format is Parquet: columnar, with predicate pushdown and column
pruning for every later read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# One CSV dialect for both directions: quotes doubled (RFC 4180), blanks kept, a NULL is an empty
# field and an empty text is a quoted one. The read-side NULL marker only has to be no real value.
READ_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
             "ignoreTrailingWhiteSpace": False, "nullValue": "\u0000", "emptyValue": ""}
_WRITE_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
              "ignoreTrailingWhiteSpace": False, "nullValue": "", "emptyValue": '""'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, multiline: bool = True, corrupt_col: str | None = None, **options) -> DataFrame:
    """CSV with a header line. With ``schema`` no inference pass runs.

    The header must name the schema's columns in order, else the read fails. A record that does not
    fit the schema fails the job; with ``corrupt_col`` its text is kept in that column instead.
    ``multiline=False`` lets one large file be split over tasks; use it only where no field holds a
    line break.
    """
    r = spark.read.options(**{**READ_CSV, "multiLine": multiline, **options})
    if schema is not None:
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if corrupt_col:
            # The header check would take the added column for one of the file's.
            schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
            r = r.option("columnNameOfCorruptRecord", corrupt_col)
        else:
            r = r.option("mode", options.get("mode", "FAILFAST")).option("enforceSchema", False)
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """CSV with a header line and no index column (Spark has no row index)."""
    df.write.mode(mode).options(**{**_WRITE_CSV, **options}).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.options(**_WRITE_CSV)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def path_missing(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def read_optional(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet"
                  ) -> DataFrame:
    """Read ``path`` if it exists, else an empty DataFrame with ``schema`` (the job goes on)."""
    try:
        df = read_table(spark, path, fmt, schema if fmt == "csv" else None)
        df.schema  # noqa: B018  (resolves the relation: raises here when the path is absent)
        return df
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return spark.createDataFrame([], schema)
