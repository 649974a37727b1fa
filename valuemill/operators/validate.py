"""Row validation (allowed values, ranges, required/typed fields) and the null profile.

Validation is one projection: each rule is a boolean Column; failing rules contribute their
reason to an ``errors`` array. Valid and rejected rows are then two filters of the same plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def required(c: Column | str) -> Column:
    return _col(c).isNotNull()


def allowed(c: Column | str, values) -> Column:
    return _col(c).isin(list(values))


def in_range(c: Column | str, lo=None, hi=None) -> Column:
    c = _col(c)
    if lo is not None and hi is not None:
        return c.between(lo, hi)
    if lo is not None:
        return c >= lo
    if hi is not None:
        return c <= hi
    return F.lit(True)


def typed(c: Column | str, dtype: str) -> Column:
    """Value parses as ``dtype`` (NULL input fails too); an integer type takes no fraction."""
    x = _col(c)
    if dtype in ("tinyint", "smallint", "int", "bigint", "long"):
        return x.try_cast(dtype).isNotNull() & (x.try_cast(dtype).cast("double") == x.try_cast("double"))
    return x.try_cast(dtype).isNotNull()


def errors_column(rules: dict[str, Column]) -> Column:
    """Array of the reasons whose rule is not TRUE (a NULL outcome counts as a failure)."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(reason))
                                     for reason, r in rules.items()]))


def validate(df: DataFrame, rules: dict[str, Column], errors_col: str = "errors",
             valid_col: str = "is_valid") -> DataFrame:
    out = df.withColumn(errors_col, errors_column(rules))
    return out.withColumn(valid_col, F.size(F.col(errors_col)) == 0)


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    v = validate(df, rules)
    return v.where("is_valid").drop("errors", "is_valid"), v.where("NOT is_valid").drop("is_valid")


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: null count, row count, all-null flag, and the number of complete rows.

    One aggregate pass computes every count; the single result row is then unpivoted.
    """
    cols = cols or df.columns
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    aggs = [F.count(F.lit(1)).alias("_rows"), F.count_if(complete).alias("_complete")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
                                for i, c in enumerate(cols)])).alias("s")
    long = one.select("_rows", "_complete", stack)
    return long.select(
        F.col("s.column_name").alias("column_name"),
        F.col("s.null_count").alias("null_count"),
        F.col("_rows").alias("row_count"),
        (F.col("s.null_count") == F.col("_rows")).alias("all_null"),
        F.col("_complete").alias("complete_rows"),
    )
