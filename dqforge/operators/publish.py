"""Write-audit-publish: stage, check, then an insert-only merge into the destination.

Parquet has no MERGE, so "insert when not matched" is a ``left_anti`` join of the staged rows
against the destination keys (only the key columns of the destination are read), followed by
an append.  Semantics kept from MERGE ... WHEN NOT MATCHED THEN INSERT:

* rows whose key already exists in the destination are left untouched;
* NULL keys never match, so such rows are always inserted;
* duplicate keys inside the staging set are all inserted;
* a column with a registry default is coalesced to that default on insert.

A re-run inserts nothing for non-NULL keys (the anti join sees the rows of the first run).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from ..sources.tables import materialize
from .checks import gate

# The staged keys are broadcast (to pre-filter the destination keys) only below this measured size.
BROADCAST_KEY_BYTES = 256 * 1024 * 1024


def key_bytes(df: DataFrame, keys: list[str]) -> int:
    """Measured bytes of the key columns as text plus 16 a value and row (one aggregation)."""
    width = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) + 16 for k in keys), F.lit(16))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()["b"]


def enrich(left: DataFrame, right: DataFrame, keys: list[str] | str, how: str = "left") -> DataFrame:
    """Equi join (default left outer) on shared key names; strategy left to AQE."""
    return left.join(right, keys, how)


def with_defaults(df: DataFrame, defaults: Mapping[str, Any] | None) -> DataFrame:
    """``COALESCE(col, default)`` for columns with a default (cast to the column type)."""
    if not defaults:
        return df
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        d = next((v for k, v in defaults.items() if k.lower() == c.lower()), None)
        out.append(F.coalesce(F.col(c), F.lit(d).cast(types[c.lower()])).alias(c) if d is not None else F.col(c))
    return df.select(*out)


def publish_new(staged: DataFrame, dest: DataFrame, keys: list[str], defaults: Mapping[str, Any] | None = None,
                staged_key_bytes: int | None = None) -> DataFrame:
    """Staged rows whose key is not in the destination (insert-only merge), in destination order.

    When the staged keys are measured (``staged_key_bytes``, see ``key_bytes``) at no more than
    ``BROADCAST_KEY_BYTES``, the destination key scan is first semi-joined with the broadcast
    staged keys, so only matching destination keys are shuffled into the anti join; otherwise both
    sides are shuffled on the key (AQE splits skewed parts).  Rows with a NULL key match nothing:
    they skip the join, so many of them don't meet in one task.
    """
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    known = staged.filter(~no_key)
    dest_keys = dest.select(*keys).filter(~no_key)
    if staged_key_bytes is not None and staged_key_bytes <= BROADCAST_KEY_BYTES:
        dest_keys = dest_keys.join(F.broadcast(known.select(*keys)), keys, "left_semi")
    new = known.join(dest_keys.distinct(), keys, "left_anti").select(*staged.columns)
    new = with_defaults(new.unionByName(staged.filter(no_key)), defaults)
    dest_cols = [c for c in dest.columns]
    missing = [c for c in dest_cols if c not in new.columns]
    types = {f.name: f.dataType for f in dest.schema.fields}
    return new.select(*[F.col(c) if c not in missing else F.lit(None).cast(types[c]).alias(c) for c in dest_cols])


def union_new(dest: DataFrame, new: DataFrame) -> DataFrame:
    """Destination plus inserted rows (UNION ALL by name)."""
    return dest.unionByName(new)


#: What a read of a folder without data says.
NO_TABLE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def publish(staged: DataFrame, dest_path: str, keys: list[str], defaults: Mapping[str, Any] | None = None) -> int:
    """Append the new rows of ``staged`` to the parquet table at ``dest_path``; returns rows added.

    The new rows are first written to the shared folder (they depend on the destination they
    are appended to), then appended — one commit of the destination per call.  A destination that
    doesn't exist yet gets every staged row, with defaults; any other failure to read it is raised.
    """
    spark = staged.sparkSession
    try:
        dest = spark.read.parquet(dest_path)
    except AnalysisException as e:
        if e.getCondition() not in NO_TABLE:
            raise
        with_defaults(staged, defaults).write.mode("append").parquet(dest_path)
        return spark.read.parquet(dest_path).count()
    new = materialize(publish_new(staged, dest, keys, defaults, staged_key_bytes=key_bytes(staged, keys)), name="publish-new")
    n = new.count()
    if n:
        new.write.mode("append").parquet(dest_path)
    return n


def table_buckets(spark, table: str) -> tuple[int, list[str], list[str]] | None:
    """``(num_buckets, bucket_columns, sort_columns)`` of a catalog table, or None."""
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not info.get("Num Buckets"):
        return None

    def cols(v):
        return [c.strip().strip("`") for c in (v or "").strip("[]").split(",") if c.strip()]

    return int(info["Num Buckets"]), cols(info.get("Bucket Columns")), cols(info.get("Sort Columns"))


def publish_to_table(staged: DataFrame, table: str, keys: list[str], defaults: Mapping[str, Any] | None = None,
                     buckets: int = 256) -> int:
    """Insert-only merge into a catalog table bucketed (and sorted) by the merge key.

    A new table is created with ``bucketBy(buckets, *keys)``; later merges read its key column
    per bucket, so the anti join shuffles only the staged rows into the table's buckets (the
    destination is never exchanged), and appends keep the bucket layout.  Returns rows added.
    """
    spark = staged.sparkSession
    if not spark.catalog.tableExists(table):
        out = with_defaults(staged, defaults)
        out.write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
        return spark.table(table).count()
    spec = table_buckets(spark, table)
    new = materialize(publish_new(staged, spark.table(table), keys, defaults), name="publish-new")
    n = new.count()
    if n:
        w = new.write.mode("append")
        if spec:
            n_b, b_cols, s_cols = spec
            w = w.bucketBy(n_b, *b_cols)
            if s_cols:
                w = w.sortBy(*s_cols)
        w.saveAsTable(table)
    return n


@dataclass
class WapResult:
    results: DataFrame
    passed: bool
    published: int
    audit_path: str


def write_audit_publish(df: DataFrame, dest_path: str, keys: list[str], column: Any = None, table: Any = None,
                        suite: Any = None, defaults: Mapping[str, Any] | None = None, on_fail: str = "raise",
                        audit_path: str | None = None) -> WapResult:
    """Stage ``df`` to an audit table, check it (fused), gate, and publish new rows on success.

    The audit copy is written once so checks and publish see the same rows; column and table checks
    ride along with that write (``audit.audited_write``).  It is kept for inspection when the gate
    fails.  With ``on_fail='warn'`` a failed gate publishes nothing.  The append is Spark's own (a
    reader may see a part of it while it runs); ``commit.write_audit_commit`` makes it one change.
    """
    from .audit import audited_write

    spark = df.sparkSession
    audit_path = audit_path or scratch_path(spark, "audit")
    if suite is not None:
        from .expectations import validate

        audit = materialize(df, audit_path)
        results = validate(audit, suite)
    else:
        audit, results = audited_write(df, audit_path, column=column, table=table, suite="audit", mode="overwrite")
    results = materialize(results, name="audit-results")
    ok = gate(results, on_fail=on_fail)
    published = publish(audit, dest_path, keys, defaults) if ok else 0
    return WapResult(results, ok, published, audit_path)


__all__ = ["WapResult", "enrich", "key_bytes", "publish", "publish_new", "publish_to_table", "table_buckets", "union_new",
           "with_defaults", "write_audit_publish"]
