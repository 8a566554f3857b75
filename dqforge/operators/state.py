"""Mergeable check state: one row a batch, so a new batch updates a table's verdicts without rescanning old ones.

A state row holds counts, extremes, failing rows and, for distinct counts, a HyperLogLog sketch.  States of batches
are merged (sums, least and largest, sketch unions) and judged like one scan over all of them; all but the distinct
counts are exact, and those have a relative standard error of ``SKETCH_ERROR``.
"""

from __future__ import annotations

from typing import Any, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.rules import COMPARATORS, all_true, coerce_number, compare, count_failed, try_float
from ..results import fmt_value, result_struct
from .publish import NO_TABLE

#: log2 of a sketch's buckets, and the relative standard error that follows (1.04 / sqrt(2**14)).
SKETCH_LG_K = 14
SKETCH_ERROR = 0.0082


class CheckState:
    """Column checks (``null_check``, ``min``, ``max``, ``distinct_check``, ``unique_check``) and per-row rules as mergeable state.

    ``column`` is ``{column: {metric: {comparator: value[, tolerance: t]}}}``, ``rules`` is ``{name: SQL predicate}``.
    Names of checks and state columns come from these, so states of one set of checks fit together.
    """

    def __init__(self, column: Mapping[str, Mapping[str, Mapping[str, Any]]] | None = None, rules: Mapping[str, str] | None = None):
        self.items: list[dict] = []
        for name, metrics in (column or {}).items():
            for metric, cond in metrics.items():
                if metric not in ("null_check", "min", "max", "distinct_check", "unique_check"):
                    raise ValueError(f"{metric!r} has no mergeable state")
                cond = dict(cond)
                tolerance = cond.pop("tolerance", None)
                if len(cond) != 1 or next(iter(cond)) not in COMPARATORS:
                    raise ValueError(f"check {name}.{metric} needs exactly one comparator of {COMPARATORS}")
                (comparator, value), = cond.items()
                self.items.append({"name": f"{name}_{metric}", "level": "column", "column": name, "metric": metric, "comparator": comparator,
                                   "value": coerce_number(value), "tolerance": tolerance})
        for name, rule in (rules or {}).items():
            self.items.append({"name": name, "level": "table", "column": None, "metric": "row_rule", "rule": rule})
        if not self.items:
            raise ValueError("no checks given")

    def _columns(self, item: dict) -> list[tuple[str, Column, Any]]:
        """State columns of a check: name, aggregate over rows, aggregate over states."""
        at, metric = item["name"], item["metric"]
        if metric == "row_rule":
            return [(f"{at}__ok", all_true(item["rule"]), F.min), (f"{at}__failed", count_failed(item["rule"]), F.sum)]
        c = F.col(item["column"])
        if metric == "null_check":
            return [(f"{at}__n", F.count_if(c.isNull()), F.sum)]
        if metric in ("min", "max"):
            whole = F.min if metric == "min" else F.max
            return [(f"{at}__v", whole(c), whole)]
        sketch = F.hll_sketch_agg(c.cast("string"), F.lit(SKETCH_LG_K))
        return [(f"{at}__n", F.count(c), F.sum), (f"{at}__sketch", sketch, lambda s: F.hll_union_agg(s))]

    def of(self, df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
        """The state of ``df`` (of each batch of it with ``by``), one pass."""
        aggs = [F.count(F.lit(1)).alias("n_rows"), *[a.alias(n) for item in self.items for n, a, _ in self._columns(item)]]
        by = list(by)
        return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)

    def merged(self, states: DataFrame, by: Iterable[str] = ()) -> DataFrame:
        """The state of all batches together (of each group of batches with ``by``)."""
        aggs = [F.sum("n_rows").alias("n_rows"), *[again(F.col(n)).alias(n) for item in self.items for n, _, again in self._columns(item)]]
        by = list(by)
        return states.groupBy(*by).agg(*aggs) if by else states.agg(*aggs)

    def verdicts(self, states: DataFrame, suite: str | None = None, by: Iterable[str] = ()) -> DataFrame:
        """Result rows for each row of ``states``."""
        rows = []
        for item in self.items:
            at, metric = item["name"], item["metric"]
            if metric == "row_rule":
                raw, failed, expected, comparator = F.col(f"{at}__ok"), F.col(f"{at}__failed"), item["rule"], None
                passed, observed = raw == 1, raw.cast("double")
            else:
                n = F.col(f"{at}__n") if metric not in ("min", "max") else None
                distinct = F.hll_sketch_estimate(f"{at}__sketch") if metric in ("distinct_check", "unique_check") else None
                raw = {"null_check": n, "distinct_check": distinct, "unique_check": None if distinct is None else n - distinct}.get(metric)
                raw = F.col(f"{at}__v") if raw is None else raw
                failed, comparator = n if metric == "null_check" else None, item["comparator"]
                expected = fmt_value(item["value"]) + (f" ~{fmt_value(item['tolerance'])}" if item["tolerance"] is not None else "")
                passed, observed = compare(raw, comparator, item["value"], item["tolerance"]), try_float(raw)
            rows.append(result_struct(suite=suite, check_name=at, level=item["level"], column_name=item["column"], metric=metric, comparator=comparator,
                                      expected=expected, observed=observed, n_rows=F.col("n_rows"), n_failed=failed, passed=passed))
        return states.select(*by, F.inline(F.array(*rows)))


def record_state(state: DataFrame, store: str, batch_cols: list[str]) -> None:
    """Keep the states of batches beside the verdicts: a folder a batch.  A batch that is recorded again replaces its own."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*batch_cols).parquet(store)


def recorded(spark: SparkSession, store: str) -> DataFrame | None:
    """The states recorded so far, or None."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(store)
    except AnalysisException as e:
        if e.getCondition() not in NO_TABLE:
            raise
        return None


def update_verdicts(checks: CheckState, batch: DataFrame, store: str, batch_cols: list[str], suite: str | None = None) -> DataFrame:
    """Record the state of the rows of new (or repeated) batches and judge the whole table from the states; only ``batch`` is scanned."""
    state = checks.of(batch, batch_cols)
    record_state(state, store, batch_cols)
    states = recorded(batch.sparkSession, store)
    return checks.verdicts(checks.merged(state if states is None else states), suite)  # no rows so far: the empty state


__all__ = ["CheckState", "SKETCH_ERROR", "record_state", "recorded", "update_verdicts"]
