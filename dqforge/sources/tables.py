"""Table reads and table lifecycle: parquet/table batches, create/drop, stores and hand-offs."""

from __future__ import annotations

from typing import Any, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir, scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """One parquet table of a data directory; optional column list (pruned at the scan)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


# ----------------------------------------------------------------- catalog lifecycle


def create_table(spark: SparkSession, name: str, schema: StructType | str, replace: bool = False,
                 location: str | None = None, cluster_by: Iterable[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` (or drop + create for replace) as a parquet table.

    Names and the location are bound parameters, never part of the statement.  ``cluster_by`` is kept as the table's
    clustering columns; ``files.load`` lays rows out by them (:func:`cluster_columns`).
    """
    if replace:
        drop_table(spark, name)
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields.fields)
    keys = list(cluster_by or [])
    clause = f" CLUSTER BY ({', '.join(map(quoted, keys))})" if keys else ""
    place = " LOCATION :location" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({ddl}) USING parquet{clause}{place}",
              args={"name": name, **({"location": location} if location else {})})


def cluster_columns(spark: SparkSession, name: str) -> list[str]:
    """The clustering columns of a catalog table."""
    import json
    import re

    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name}).collect()
    value = next((r["data_type"] for r in rows if r["col_name"] == "Table Properties"), "")
    found = re.search(r"clusteringColumns=(\[(?:\[[^\]]*\],?)*\])", value)
    return [".".join(c) for c in json.loads(found[1])] if found else []


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def create_db(spark: SparkSession, name: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})


def drop_db(spark: SparkSession, name: str, cascade: bool = True) -> None:
    spark.sql("DROP DATABASE IF EXISTS IDENTIFIER(:name)" + " CASCADE" * cascade, args={"name": name})


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


# ----------------------------------------------------------------- statements


def run_sql(spark: SparkSession, sql: str | list[str], args: Mapping[str, Any] | None = None) -> DataFrame | None:
    """Run one statement or a list in order, with named parameters; return the last result."""
    out = None
    for stmt in [sql] if isinstance(sql, str) else sql:
        stmt = stmt.strip().rstrip(";")
        if stmt:
            out = spark.sql(stmt, args=dict(args) if args else None)
    return out


# ----------------------------------------------------------------- stores and hand-offs


def store_results(results: DataFrame, path: str, run_id: str | None = None,
                  partition_by: Iterable[str] = ("suite",)) -> None:
    """Append verdict rows to a store, stamped with run id and time (only here, never in queries)."""
    import uuid

    stamped = results.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex)).withColumn(
        "run_ts", F.current_timestamp()
    )
    stamped.write.mode("append").partitionBy(*partition_by).parquet(path)


def archive_failures(failed: DataFrame, dest: str, columns: Iterable[str], fmt: str = "parquet") -> None:
    """Append the named columns of failing rows to a permanent table (path or catalog name)."""
    w = failed.select(*columns).write.mode("append").format(fmt)
    if "/" in dest or ":" in dest:
        w.save(dest)
    else:
        w.saveAsTable(dest)


def materialize(df: DataFrame, path: str | None = None, name: str = "stage") -> DataFrame:
    """Hand a frame to the next stage through the shared folder: write parquet, read it back.

    Keeps types (a CSV hand-off would lose them) and cuts lineage, so a lost executor
    re-reads the written files instead of recomputing the upstream plan.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    target = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
