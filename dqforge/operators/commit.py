"""Publishing as one commit: new rows go to a folder of their run, and one catalog change makes them visible.

The destination is a catalog table partitioned by ``RUN``.  A run writes its rows to a fresh folder that no reader
looks at, then points its partition there (``ADD PARTITION ... LOCATION``, or ``SET LOCATION`` when the run was
committed before).  A reader sees all of a run or nothing; a run that dies before the change leaves the table as it
was; a run that is tried again replaces what it had published, rows with NULL keys included.
"""

from __future__ import annotations

import posixpath
import uuid
from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .publish import WapResult, publish_new, with_defaults

#: The partition column: the run that published a row.
RUN = "run_id"


def create_run_table(spark: SparkSession, table: str, like: DataFrame, location: str | None = None) -> str:
    """An empty table with the columns of ``like`` and ``RUN``, unless it exists; returns its folder."""
    if RUN in (c.lower() for c in like.columns):
        raise ValueError(f"{RUN} is the partition column of the table")
    if not spark.catalog.tableExists(table):
        w = like.limit(0).withColumn(RUN, F.lit("")).write.partitionBy(RUN).format("parquet")
        (w.option("path", location) if location else w).saveAsTable(table)
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table}).where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def published_runs(spark: SparkSession, table: str) -> set[str]:
    """The runs that readers of the table see."""
    from urllib.parse import unquote

    return {unquote(r[0].split("=", 1)[1]) for r in spark.sql("SHOW PARTITIONS IDENTIFIER(:t)", args={"t": table}).collect()}


def _swap(spark: SparkSession, table: str, run: str, folder: str) -> None:
    """The commit: the run's partition is ``folder`` from now on."""
    args = {"t": table, "r": run, "l": folder}
    if run in published_runs(spark, table):
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) PARTITION ({RUN} = :r) SET LOCATION :l", args=args)
    else:
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD PARTITION ({RUN} = :r) LOCATION :l", args=args)


def publish_run(staged: DataFrame, table: str, keys: list[str], run: str, defaults: Mapping[str, Any] | None = None,
                location: str | None = None, staged_key_bytes: int | None = None) -> int:
    """Insert-only merge of ``staged`` into ``table`` as the commit of ``run``; returns the rows the run has published.

    Rows whose key another run has published are left out (a NULL key matches nothing); what this run had published
    before is replaced.  The table is created on its first run.  Of several runs at once each is whole, but they
    don't see each other's keys: publish to one table from one place at a time.
    """
    spark = staged.sparkSession
    if not run:
        raise ValueError("a run needs an id")
    root = create_run_table(spark, table, staged, location)
    others = spark.table(table).where(F.col(RUN) != run).drop(RUN)
    new = publish_new(staged, others, keys, defaults, staged_key_bytes=staged_key_bytes)
    folder = posixpath.join(root, "_runs", uuid.uuid4().hex)  # readers of the folder skip names with an underscore
    new.write.parquet(folder)
    n = spark.read.schema(new.schema).parquet(folder).count()
    if n or run in published_runs(spark, table):
        _swap(spark, table, run, folder)
        spark.catalog.refreshTable(table)
    return n


def write_audit_commit(df: DataFrame, table: str, keys: list[str], run: str, column: Any = None, rules: Any = None,
                       defaults: Mapping[str, Any] | None = None, on_fail: str = "raise", audit_path: str | None = None,
                       location: str | None = None) -> WapResult:
    """Write-audit-publish with one commit: the audit copy is checked while it is written, and published as ``run``
    when every check passes.  Nothing is published otherwise; the audit copy stays for inspection."""
    from .audit import audited_write
    from .checks import gate

    audit_path = audit_path or scratch_path(df.sparkSession, "audit")
    audit, results = audited_write(with_defaults(df, defaults), audit_path, column=column, table=rules, suite="audit")
    ok = gate(results, on_fail=on_fail)
    published = publish_run(audit, table, keys, run, location=location) if ok else 0
    return WapResult(results, ok, published, audit_path)


__all__ = ["RUN", "create_run_table", "publish_run", "published_runs", "write_audit_commit"]
