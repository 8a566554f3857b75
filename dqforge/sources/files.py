"""File sources: typed CSV reads, named stages, a lenient checked loader, literal rows, and loads.

The checked loader reads every column as text, casts with ``try_cast`` and keeps per-row
diagnostics, so load errors are data (countable per file and column) instead of a failed job.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .rejects import typed, with_fields

CORRUPT = "_corrupt_record"


def _schema(spark: SparkSession, schema: StructType | str) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return spark.createDataFrame([], schema).schema


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = False,
             ts_format: str | None = None, **options) -> DataFrame:
    """Typed CSV read (headerless by default); ``ts_format`` fixes the timestamp text format."""
    r = spark.read.schema(_schema(spark, schema)).option("header", header)
    if ts_format:
        r = r.option("timestampNTZFormat", ts_format).option("timestampFormat", ts_format)
    return r.options(**options).csv(path)


@dataclass
class Stage:
    """A named stage: location + format + reader options (e.g. header skip, delimiter)."""

    path: str
    fmt: str = "csv"
    options: dict = field(default_factory=dict)

    def read(self, spark: SparkSession, schema: StructType | str | None = None) -> DataFrame:
        r = spark.read.format(self.fmt).options(**self.options)
        if schema is not None:
            r = r.schema(_schema(spark, schema))
        return r.load(self.path)


def load_csv_checked(spark: SparkSession, path: str, schema: StructType | str, header: bool = False,
                     allow_jagged: bool = True, ts_format: str | None = None, sep: str = ",",
                     **options) -> DataFrame:
    """Read CSV as text columns, cast to ``schema``, and keep diagnostics per row.

    Added columns: ``_file`` (file name), ``_n_fields`` (exact up to one more than the schema has; -1
    where a quote isn't closed: always an error), ``_too_many`` (more fields than the schema: always an
    error), ``_short`` (fewer fields: accepted when ``allow_jagged``), and ``_bad_<col>`` (non-empty text
    that does not cast).  ``_error`` is true for rejected rows; ``rejects.rejected_rows`` has their lines.
    A quote that is left open in the last field is read as the parser reads it, to the end of the line;
    only ``rejected_rows``, which sees every line, reports it.
    The fields are only counted for rows the parser flagged (short or long).
    """
    target = _schema(spark, schema)
    text_schema = StructType([StructField(f.name, StringType(), True) for f in target.fields])
    text_schema = text_schema.add(CORRUPT, StringType())
    r = (spark.read.schema(text_schema).option("header", header).option("sep", sep)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("columnPruning", False))  # the flags of a row don't depend on the columns a query keeps
    raw = r.options(**options).csv(path).withColumn("_file", F.col("_metadata.file_name"))
    n = len(target.fields)
    raw = with_fields(raw, F.col(CORRUPT), n, {"sep": sep, **options})  # counted by the parser, quotes and escapes as it reads them
    nf = F.when(F.col(CORRUPT).isNull(), F.lit(n)).otherwise(F.col("_fields.count"))
    # a scan of the corrupt record alone is refused: the count names a data column too
    nf = nf + F.coalesce(F.length(F.col(target.fields[0].name)) * 0, F.lit(0))
    cols = []
    bad = []
    for f in target.fields:
        src = F.col(f.name)
        value = typed(src, f.dataType, ts_format)
        cols.append(value.alias(f.name))
        bad.append((src.isNotNull() & (F.trim(src) != "") & value.isNull()).alias(f"_bad_{f.name}"))
    names = {f.name for f in target.fields}
    extra = [F.col(c) for c in raw.columns if c not in names and c not in (CORRUPT, "_file", "_fields")]  # partition columns
    out = raw.select(*cols, *extra, *bad, F.col("_file"), nf.alias("_n_fields"))
    out = out.withColumn("_too_many", F.col("_n_fields") > n).withColumn("_short", F.col("_n_fields").between(0, n - 1))
    err = F.col("_too_many") | (F.col("_n_fields") < 0) | reduce(lambda a, b: a | b, [F.col(f"_bad_{f.name}") for f in target.fields])
    if not allow_jagged:
        err = err | F.col("_short")
    return out.withColumn("_error", err)


def clean_rows(checked: DataFrame) -> DataFrame:
    """Accepted rows of a checked load, diagnostics dropped."""
    diag = [c for c in checked.columns if c.startswith("_")]
    return checked.filter(~F.col("_error")).drop(*diag)


def from_rows(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """Literal rows (fixtures, expected values); small by construction."""
    return spark.createDataFrame(rows, schema)


def load(df: DataFrame, target: str, mode: str = "overwrite", required: Iterable[str] = (),
         partition_by: Iterable[str] = (), cluster_by: Iterable[str] = ()) -> DataFrame:
    """Write a frame to a table (catalog name) or path, then check required columns for NULLs.

    Spark does not enforce ``nullable=False`` on write, so REQUIRED columns become a null check
    on the written data.  ``cluster_by`` (by default the clustering columns of an existing table) lays
    the rows out by range: each file holds one stretch of the keys, sorted, so a filter on a leading
    key skips the other files and row groups.  Returns the check results (lazy, over the written copy).
    """
    from ..operators.checks import column_checks
    from .tables import cluster_columns

    spark = df.sparkSession
    is_path = "/" in target or ":" in target
    keys = list(cluster_by)
    if not keys and not is_path and spark.catalog.tableExists(target):
        keys = cluster_columns(spark, target)
    by = [*partition_by, *keys]
    out = df.repartitionByRange(*by).sortWithinPartitions(*by) if keys else df
    w = out.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    elif keys and not is_path:
        w = w.clusterBy(*keys)
    if is_path:
        w.save(target)
        written = spark.read.parquet(target)
    else:
        w.saveAsTable(target)
        written = spark.table(target)
    req = list(required)
    if not req:
        return written.agg(F.count(F.lit(1)).alias("n_rows"))
    return column_checks(written, {c: {"null_check": {"equal_to": 0}} for c in req}, suite=f"load:{target}")
