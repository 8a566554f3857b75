"""Checks that ride along with a write: the rows are scanned once, and the verdicts come from the write job itself.

The fused aggregates of the checks are observed metrics of the frame that is written.  Exact distinct counts and
rules with DISTINCT cannot be observed; they read their column from the written copy afterwards.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, functions as F

from .checks import Check, _branch_rows, _with_exact_fallback, compile_column_checks, compile_table_checks, evaluate


def _observable(c: Check) -> bool:
    """Whether a check's aggregate may be observed: DISTINCT and subqueries may not."""
    text = c.expected if c.metric == "aggregate_rule" else ""
    return c.distinct_of is None and c.metric not in ("distinct_check", "unique_check") and not re.search(r"\b(distinct|select)\b", text or "", re.I)


def audited_write(df: DataFrame, path: str, column: Any = None, table: Any = None, suite: str | None = None, mode: str = "errorifexists",
                  approx_distinct: bool = False) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` to ``path`` as parquet and check it on the way; returns the written frame and the verdicts (as of
    ``run_checks`` with the same ``column`` and ``table`` checks)."""
    spark = df.sparkSession

    def build(exact: bool):
        checks = (compile_column_checks(df, column, approx_distinct) if column else []) + (compile_table_checks(df, table, exact=exact) if table else [])
        seen = [(i, c) for i, c in enumerate(checks) if _observable(c)]
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in seen:
            aggs += [c.value.alias(f"_v{i}"), (c.failed if c.failed is not None else F.lit(None).cast("bigint")).alias(f"_f{i}")]
        watched = Observation()
        return checks, seen, df.agg(*aggs).schema, watched, df.observe(watched, *aggs)

    checks, seen, schema, watched, rows = _with_exact_fallback(build)
    if not checks:
        raise ValueError("no checks given")
    rows.write.mode(mode).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    parts = []
    if seen:
        metrics = watched.get
        one = spark.createDataFrame([tuple(metrics[f.name] for f in schema.fields)], schema)
        parts.append(_branch_rows(one, [c for _, c in seen], suite, [], [i for i, _ in seen]))
    late = [c for c in checks if not _observable(c)]
    if late:
        parts.append(evaluate(written, late, suite))
    return written, reduce(lambda a, b: a.unionByName(b), parts)


__all__ = ["audited_write"]
