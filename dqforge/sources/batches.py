"""Batches — the unit of validation: a frame, a query result, a table, or files found by regex."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass
class Batch:
    df: DataFrame
    batch_id: str = "default"
    identifiers: dict = field(default_factory=dict)

    @classmethod
    def from_df(cls, df: DataFrame, batch_id: str = "runtime") -> "Batch":
        """Runtime batch: validate a frame that already exists (no copy, stays lazy)."""
        return cls(df, batch_id)

    @classmethod
    def from_sql(cls, spark: SparkSession, query: str, batch_id: str = "query", args: dict | None = None) -> "Batch":
        """Query batch: the result of a full SQL query."""
        return cls(spark.sql(query, args=args), batch_id)

    @classmethod
    def from_table(cls, spark: SparkSession, table_or_path: str, batch_id: str | None = None) -> "Batch":
        """Table batch: a catalog table, or a parquet path when the name contains a slash."""
        df = spark.read.parquet(table_or_path) if "/" in table_or_path else spark.table(table_or_path)
        return cls(df, batch_id or table_or_path)

    def limit(self, n: int) -> "Batch":
        """Row-limited batch (unordered: which rows is arbitrary, as in the suite format)."""
        return Batch(self.df.limit(n), f"{self.batch_id}[:{n}]", dict(self.identifiers))


def list_batches(spark: SparkSession, directory: str, pattern: str, group_names: Iterable[str],
                 fmt: str = "csv", schema=None, options: dict | None = None, on: str = "file_name") -> DataFrame:
    """All files of a directory whose name matches ``pattern``; capture groups become batch columns.

    One read of every matching file (the scan stays parallel per file split); the batch key of
    a row comes from the file it was read from (``_metadata.file_name`` or ``file_path``).
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if on not in ("file_name", "file_path"):
        raise ValueError("on must be 'file_name' or 'file_path'")
    df = reader.load(directory).withColumn("_file_name", F.col(f"_metadata.{on}").alias("_file_name", metadata={"batch_column": True}))
    df = df.filter(F.col("_file_name").rlike(f"^{pattern}$"))
    for i, g in enumerate(group_names, start=1):
        df = df.withColumn(g, F.regexp_extract(F.col("_file_name"), pattern, i).alias(g, metadata={"batch_column": True}))
    return df


def latest_batch(df: DataFrame, order_col: str) -> DataFrame:
    """Rows of the last batch (``index: -1``): those whose batch key equals the maximum key.

    The maximum is a scalar subquery in the same plan (no cross join, no driver round-trip).
    """
    return df.filter(F.col(order_col) == df.agg(F.max(order_col)).scalar())


def latest_day(df: DataFrame, ts_col: str, name: str = "batch_date") -> DataFrame:
    """Rows of the last day of a timestamp column, with the day as batch key.  The largest timestamp is asked for first (one
    column, one value); the day is then a range on the raw column, which the file scan skips row groups by."""
    from ..operators.checks import on_dates

    last = df.agg(F.max(ts_col)).first()[0]
    rows = df.limit(0) if last is None else on_dates(df, ts_col, [last.date() if hasattr(last, "date") else last])
    return with_batch_day(rows, ts_col, name)


def with_batch_day(df: DataFrame, ts_col: str, name: str = "batch_date") -> DataFrame:
    """Batch key from a timestamp: its day as ``yyyy-MM-dd`` text (no zone shift for NTZ)."""
    return df.withColumn(name, F.date_format(F.col(ts_col), "yyyy-MM-dd"))
