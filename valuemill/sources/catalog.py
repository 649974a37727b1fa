"""Named datasets: logical name -> location (and format), from a plain dict."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from valuemill.sources.files import read_table, write_table


@dataclass
class Catalog:
    """Maps logical names to paths. Paths may hold ``{yesterday}`` / ``{today}`` placeholders."""

    paths: dict[str, str] = field(default_factory=dict)
    fmt: str = "parquet"

    def path(self, name: str, run_date: _dt.date | None = None) -> str:
        d = run_date or _dt.date.today()
        return self.paths[name].format(today=d.isoformat(),
                                       yesterday=(d - _dt.timedelta(days=1)).isoformat())

    def read(self, spark: SparkSession, name: str, run_date: _dt.date | None = None) -> DataFrame:
        return read_table(spark, self.path(name, run_date), self.fmt)

    def write(self, df: DataFrame, name: str, mode: str = "overwrite", run_date: _dt.date | None = None) -> None:
        write_table(df, self.path(name, run_date), self.fmt, mode)

    def register_views(self, spark: SparkSession, names: list[str] | None = None) -> None:
        for n in names or list(self.paths):
            self.read(spark, n).createOrReplaceTempView(n)
