"""The verdict table every check, expectation and integrity operator returns.

One row per check (per batch when grouped).  It is a small DataFrame built lazily from one
aggregation row, so checks stay distributed until a caller (a gate, a test) collects it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RESULT_FIELDS = (
    ("suite", "string"),
    ("check_name", "string"),
    ("level", "string"),
    ("column_name", "string"),
    ("metric", "string"),
    ("comparator", "string"),
    ("expected", "string"),
    ("observed", "double"),
    ("n_rows", "bigint"),
    ("n_failed", "bigint"),
    ("passed", "boolean"),
)
RESULT_COLUMNS = [n for n, _ in RESULT_FIELDS]
RESULT_DDL = ", ".join(f"{n} {t}" for n, t in RESULT_FIELDS)


def fmt_value(v) -> str | None:
    """Deterministic text for an expected value (ints without a trailing ``.0``)."""
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    return str(v)


def result_struct(
    *,
    suite: str | None,
    check_name: str,
    level: str,
    column_name: str | None,
    metric: str | None,
    comparator: str | None,
    expected: str | Column | None,
    observed: Column,
    n_rows: Column,
    n_failed: Column | None,
    passed: Column,
    extra: dict | None = None,
) -> Column:
    """One result row as a struct with the fixed field types (so many can share one array).

    ``observed`` is rounded to 6 decimals so verdict tables compare equal across engines.
    """

    def s(v):
        if isinstance(v, Column):
            return v.cast("string")
        return F.lit(v) if isinstance(v, str) else F.lit(None).cast("string")

    return F.struct(
        s(suite).alias("suite"),
        s(check_name).alias("check_name"),
        s(level).alias("level"),
        s(column_name).alias("column_name"),
        s(metric).alias("metric"),
        s(comparator).alias("comparator"),
        s(expected).alias("expected"),
        F.round(observed.cast("double"), 6).alias("observed"),
        n_rows.cast("bigint").alias("n_rows"),
        (n_failed if n_failed is not None else F.lit(None)).cast("bigint").alias("n_failed"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        *[s(v).alias(k) for k, v in sorted((extra or {}).items())],
    )
