"""Landing a raw table: tidy column names and decode byte cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_tail(df: DataFrame, sep: str = "/") -> DataFrame:
    """Keep only the last ``sep``-separated segment of each column name (``a/b/year`` -> ``year``)."""
    return df.toDF(*[c.rsplit(sep, 1)[-1] for c in df.columns])


def decode_binary(df: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """Decode every BinaryType column as text; other columns pass through unchanged."""
    return df.select(*[
        F.decode(F.col(f"`{f.name}`"), charset).alias(f.name) if isinstance(f.dataType, T.BinaryType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def land(df: DataFrame) -> DataFrame:
    return decode_binary(rename_tail(df))
