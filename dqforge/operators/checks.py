"""Check operators: column, table, value, threshold, interval, first-row, row rules, spot and
ground-truth checks, fused so that N checks on one table cost one scan.

Plan shape of a fused run: ``Scan (pruned to the referenced columns) → partial HashAggregate →
single-partition exchange of one row per task → final HashAggregate → Generate(inline)``.
Only exact distinct counts leave the fused pass: each becomes its own aggregation branch
(``groupBy(col)`` partial-combined before its shuffle) so that no ``Expand`` copies every row
once per distinct column.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rules import (
    COMPARATORS,
    RuleError,
    all_true,
    coerce_number,
    compare,
    count_failed,
    holds,
    guess_rule_kind,
    lint_rules,
    rule_flag,
    rule_kind,
    try_float,
)
from ..results import RESULT_COLUMNS, fmt_value, result_struct

Verdict = Callable[[Column, Column, Column], Column]

# Ground-truth key lists up to this length are also pushed to the scan as an IN filter.
PUSHDOWN_KEYS = 1000
# Literal ground-truth rows up to this number are broadcast.
BROADCAST_ROWS = 100_000
#: Failed checks that a gate's message lists.
SHOWN = 100


@dataclass
class Check:
    """One check compiled to aggregate expressions.

    ``value`` is the raw metric (an aggregate expression), ``failed`` the failing-row count (an
    aggregate, optional) and ``verdict(raw, failed, n_rows)`` the pass rule over the result row.
    ``distinct_of`` marks an exact distinct count, evaluated in its own branch.
    """

    name: str
    level: str
    column: str | None
    metric: str | None
    comparator: str | None
    expected: str | None
    value: Column | None
    verdict: Verdict
    failed: Column | None = None
    observed: Callable[[Column], Column] = field(default=lambda raw: try_float(raw))
    distinct_of: str | None = None
    distinct_mode: str = "distinct_check"
    suite: str | None = None  # overrides the suite of the evaluate() call (several suites, one pass)
    extra: dict | None = None  # extra text columns of the result row (same keys for all checks of a call)


# --------------------------------------------------------------------------- fused evaluation


def _branch_rows(row: DataFrame, checks: list[Check], suite: str | None, by: list[str], idx) -> DataFrame:
    structs = []
    for i, c in zip(idx, checks):
        raw = F.col(f"_v{i}")
        failed = F.col(f"_f{i}")
        n = F.col("_n")
        structs.append(
            result_struct(
                suite=c.suite if c.suite is not None else suite,
                extra=c.extra,
                check_name=c.name,
                level=c.level,
                column_name=c.column,
                metric=c.metric,
                comparator=c.comparator,
                expected=c.expected,
                observed=c.observed(raw),
                n_rows=n,
                n_failed=failed,
                passed=c.verdict(raw, failed, n),
            )
        )
    return row.select(*[F.col(b) for b in by], F.inline(F.array(*structs)))


def evaluate(df: DataFrame, checks: list[Check], suite: str | None = None, by: Iterable[str] | None = None) -> DataFrame:
    """Run compiled checks: one fused aggregation plus one branch per exact distinct count.

    With ``by`` (batch columns) every check is evaluated per group in the same single pass.
    Returns the result frame (``by`` columns first, then ``RESULT_COLUMNS``); lazy.
    """
    by = list(by or [])
    if len({tuple(sorted((c.extra or {}).keys())) for c in checks}) > 1:
        raise ValueError("all checks of one evaluation need the same extra columns")
    fused = [(i, c) for i, c in enumerate(checks) if c.distinct_of is None]
    distinct = [(i, c) for i, c in enumerate(checks) if c.distinct_of is not None]
    parts = []
    if fused or not distinct:
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in fused:
            aggs.append(c.value.alias(f"_v{i}"))
            aggs.append((c.failed if c.failed is not None else F.lit(None).cast("bigint")).alias(f"_f{i}"))
        row = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
        if fused:
            parts.append(_branch_rows(row, [c for _, c in fused], suite, by, [i for i, _ in fused]))
    for i, c in distinct:
        d = F.count_distinct(F.col(c.distinct_of))
        # unique_check: non-null rows minus distinct values (0 when the column is unique)
        raw = d if c.distinct_mode == "distinct_check" else F.count(F.col(c.distinct_of)) - d
        aggs = [F.count(F.lit(1)).alias("_n"), raw.alias(f"_v{i}"), F.lit(None).cast("bigint").alias(f"_f{i}")]
        row = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
        parts.append(_branch_rows(row, [c], suite, by, [i]))
    if not parts:
        raise ValueError("no checks given")
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_missing_batches(results: DataFrame, of_empty: DataFrame, df: DataFrame, expected: DataFrame, by: Iterable[str]) -> DataFrame:
    """Add, for every key of ``expected`` without a row in ``df``, the verdicts ``of_empty`` of a batch without rows (one row a
    check, attached as literals, so no batch is asked for on its own)."""
    by = list(by)
    there = df.select(*[F.col(b).alias(f"_there_{b}") for b in by]).distinct()
    match = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_there_{b}")) for b in by])
    missing = expected.select(*by).distinct().join(there, match, "left_anti")
    columns = [f for f in results.schema.fields if f.name not in by]
    rows = [F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in columns]) for r in of_empty.collect()]
    return results.unionByName(missing.select(*by, F.inline(F.array(*rows))))


# --------------------------------------------------------------------------- column checks

_COLUMN_METRICS = ("null_check", "distinct_check", "unique_check", "min", "max")


def _iter_mapping(spec) -> Iterable[tuple[str, Any]]:
    """Accept ``{k: v}`` or the list-of-single-key-dicts form ``[{k: v}, ...]``."""
    if isinstance(spec, Mapping):
        yield from spec.items()
    else:
        for item in spec:
            yield from item.items()


def compile_column_checks(df: DataFrame, mapping, approx_distinct: bool = False) -> list[Check]:
    """``{column: {metric: {comparator: value[, tolerance: t]}}}`` → compiled checks."""
    out: list[Check] = []
    known = {c.lower() for c in df.columns}
    for column, metrics in _iter_mapping(mapping):
        if column.lower() not in known:
            df.select(F.col(column))  # nested or unknown name: let analysis resolve it or raise
        c = F.col(column)
        for metric, cond in metrics.items():
            if metric not in _COLUMN_METRICS:
                raise ValueError(f"unknown column metric {metric!r}; expected one of {_COLUMN_METRICS}")
            cond = dict(cond)
            tol = cond.pop("tolerance", None)
            partition_clause = cond.pop("partition_clause", None)
            if len(cond) != 1 or next(iter(cond)) not in COMPARATORS:
                raise ValueError(f"check {column}.{metric} needs exactly one comparator of {COMPARATORS}")
            (cmp_name, val), = cond.items()
            val = coerce_number(val)
            expected = fmt_value(val) if tol is None else f"{fmt_value(val)} ~{fmt_value(tol)}"
            def verdict(raw, failed, n, cmp_name=cmp_name, val=val, tol=tol):
                return compare(raw, cmp_name, val, tol)

            base = dict(
                name=f"{column}_{metric}",
                level="column",
                column=column,
                metric=metric,
                comparator=cmp_name,
                expected=expected,
                verdict=verdict,
            )
            scope = c if partition_clause is None else F.when(F.expr(partition_clause), c)
            if metric == "null_check":
                nulls = F.count_if(scope.isNull()) if partition_clause is None else F.count_if(
                    F.expr(partition_clause) & c.isNull())
                out.append(Check(value=nulls, failed=nulls, **base))
            elif metric in ("distinct_check", "unique_check"):
                if approx_distinct:
                    d = F.approx_count_distinct(scope)
                    out.append(Check(value=d if metric == "distinct_check" else F.count(scope) - d, **base))
                elif partition_clause is None:
                    out.append(Check(value=None, distinct_of=column, distinct_mode=metric, **base))
                else:
                    d = F.count_distinct(scope)
                    out.append(Check(value=d if metric == "distinct_check" else F.count(scope) - d, **base))
            elif metric == "min":
                out.append(Check(value=F.min(scope), **base))
            else:
                out.append(Check(value=F.max(scope), **base))
    return out


def column_checks(df: DataFrame, mapping, suite: str | None = None, approx_distinct: bool = False) -> DataFrame:
    """Column-level checks (null / distinct / unique / min / max with comparators), fused."""
    return evaluate(df, compile_column_checks(df, mapping, approx_distinct), suite)


# --------------------------------------------------------------------------- table checks


def _rule_items(checks) -> Iterable[tuple[str, str]]:
    for name, spec in _iter_mapping(checks):
        yield name, spec["check_statement"] if isinstance(spec, Mapping) else spec


def compile_table_checks(df: DataFrame, checks, level: str = "table", exact: bool = False) -> list[Check]:
    """``{name: {check_statement: sql}}`` (or ``{name: sql}``) → compiled checks.

    An aggregate statement (``COUNT(*) = 9``) is evaluated once; a per-row statement
    (``2 * dmc < dc``) is folded over all rows with ``MIN(CASE WHEN ... THEN 1 ELSE 0 END)``
    and also reports its failing-row count.  The kind is decided at analysis time.
    """
    items = list(_rule_items(checks))
    lint_rules(df, dict(items))  # constant-literal trap (``'id' IS NOT NULL``): a warning per rule
    out = []
    for name, stmt in items:
        kind = rule_kind(df, stmt) if exact else guess_rule_kind(df, stmt)
        if kind == "aggregate":
            out.append(
                Check(
                    name=name,
                    level=level,
                    column=None,
                    metric="aggregate_rule",
                    comparator=None,
                    expected=stmt,
                    value=F.expr(stmt),
                    # a non-boolean result counts by truthiness (non-zero passes)
                    observed=lambda raw: raw.try_cast("boolean").cast("int").cast("double"),
                    verdict=lambda raw, failed, n: raw.try_cast("boolean"),
                )
            )
        else:
            out.append(
                Check(
                    name=name,
                    level=level,
                    column=None,
                    metric="row_rule",
                    comparator=None,
                    expected=stmt,
                    value=all_true(stmt),
                    failed=count_failed(stmt),
                    observed=lambda raw: raw.cast("double"),
                    verdict=lambda raw, failed, n: raw == 1,
                )
            )
    return out


def _with_exact_fallback(build):
    """Build from guessed rule kinds; if Catalyst rejects the fused aggregate, classify each rule
    exactly (one analysis per rule) and build again — user errors then surface per rule."""
    from pyspark.errors import AnalysisException

    try:
        return build(False)
    except AnalysisException:
        return build(True)


def table_checks(df: DataFrame, checks, suite: str | None = None) -> DataFrame:
    """Table-level checks; aggregate and per-row statements fused into one aggregation."""
    return _with_exact_fallback(lambda exact: evaluate(df, compile_table_checks(df, checks, exact=exact), suite))


def compile_row_rules(df: DataFrame, rules: Mapping[str, str | Column]) -> list[Check]:
    """``{name: per-row SQL rule}`` → compiled checks.  A rule that tests only literals gets a warning."""
    lint_rules(df, dict(rules))
    return [
        Check(
            name=name,
            level="row",
            column=None,
            metric="row_rule",
            comparator=None,
            expected=rule if isinstance(rule, str) else None,
            value=all_true(rule),
            failed=count_failed(rule),
            observed=lambda raw: raw.cast("double"),
            verdict=lambda raw, failed, n: raw == 1,
        )
        for name, rule in rules.items()
    ]


def row_rules(df: DataFrame, rules: Mapping[str, str | Column], suite: str | None = None) -> DataFrame:
    """One verdict per per-row rule over all rows (template form ``MIN(CASE WHEN rule ...)``)."""
    return evaluate(df, compile_row_rules(df, rules), suite)


def run_checks(
    df: DataFrame,
    column: Any = None,
    table: Any = None,
    suite: str | None = None,
    by: Iterable[str] | None = None,
    approx_distinct: bool = False,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Mapped suite (C13): all column and table rules of a config fused into one pass.  With ``by``, ``expected`` holds the
    keys of the batches there should be: one without rows gets the verdicts of an empty batch."""
    def build(exact: bool) -> DataFrame:
        compiled = []
        if column:
            compiled += compile_column_checks(df, column, approx_distinct)
        if table:
            compiled += compile_table_checks(df, table, exact=exact)
        return evaluate(df, compiled, suite, by)

    results = _with_exact_fallback(build)
    if by and expected is not None:
        results = with_missing_batches(results, run_checks(df.limit(0), column, table, suite, None, approx_distinct), df, expected, by)
    return results


# --------------------------------------------------------------------------- row flags


def row_flags(df: DataFrame, rules: Mapping[str, str | Column], id_cols: Iterable[str] = ()) -> DataFrame:
    """0/1 per rule per row (diagnosis); NULL rules give 0."""
    return df.select(*[F.col(c) for c in id_cols], *[rule_flag(r).alias(n) for n, r in rules.items()])


def failing_rows(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Rows breaking at least one rule (lazy filter over the same frame)."""
    ok = reduce(lambda a, b: a & b, [holds(r) for r in rules.values()])
    return df.filter(~ok)


# --------------------------------------------------------------------------- first-row check


def _truthy(df: DataFrame, name: str) -> Column:
    t = df.schema[name].dataType.typeName()
    c = F.col(name)
    if t == "boolean":
        return F.coalesce(c, F.lit(False))
    if t in ("string", "binary"):
        return F.coalesce(F.length(c) > 0, F.lit(False))
    if t in ("array", "map"):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if t in ("byte", "short", "integer", "long", "float", "double") or t.startswith("decimal"):
        return F.coalesce(c != 0, F.lit(False))
    return c.isNotNull()


def check_row(df: DataFrame, name: str = "first_row_check", suite: str | None = None) -> DataFrame:
    """Every value of the first row must be truthy (False, 0, '', empty and NULL fail).

    No row at all fails.  ``observed`` is the number of truthy values, ``n_failed`` the falsy ones.
    """
    first = df.limit(1)
    flags = [_truthy(first, c).cast("int") for c in first.columns]
    ok = reduce(lambda a, b: a + b, flags)
    agg = first.agg(F.count(F.lit(1)).alias("_n"), F.sum(ok).alias("_ok"))
    ncol = len(first.columns)
    return agg.select(
        F.inline(
            F.array(
                result_struct(
                    suite=suite,
                    check_name=name,
                    level="row",
                    column_name=None,
                    metric="first_row_truthy",
                    comparator=None,
                    expected=str(ncol),
                    observed=F.col("_ok"),
                    n_rows=F.col("_n"),
                    n_failed=F.lit(ncol) - F.col("_ok"),
                    passed=(F.col("_n") == 1) & (F.col("_ok") == ncol),
                )
            )
        )
    )


# --------------------------------------------------------------------------- value / threshold


def compile_value_check(name: str, metric: str, pass_value: Any, tolerance: float | None = None) -> Check:
    pv = pass_value if isinstance(pass_value, bool) else coerce_number(pass_value)
    if isinstance(pv, bool):
        def verdict(raw, failed, n):
            return raw.try_cast("boolean") == F.lit(pv)

        expected = "true" if pv else "false"
    elif isinstance(pv, float):
        def verdict(raw, failed, n):
            r = try_float(raw)
            if tolerance is None:
                return r == F.lit(pv)
            return r.between(F.lit(pv * (1 - tolerance)), F.lit(pv * (1 + tolerance)))

        expected = fmt_value(pv) if tolerance is None else f"{fmt_value(pv)} ~{fmt_value(tolerance)}"
    else:
        def verdict(raw, failed, n):
            return raw.cast("string") == F.lit(str(pv))

        expected = str(pv)
    return Check(
        name=name,
        level="table",
        column=None,
        metric=metric,
        comparator="equal_to",
        expected=expected,
        value=F.expr(metric),
        verdict=verdict,
    )


def value_check(df: DataFrame, metric: str, pass_value: Any, tolerance: float | None = None,
                name: str = "value_check", suite: str | None = None) -> DataFrame:
    """Metric (an aggregate SQL expression) equals ``pass_value`` (within a relative tolerance)."""
    return evaluate(df, [compile_value_check(name, metric, pass_value, tolerance)], suite)


def _bound(spark, b) -> tuple[Column, str]:
    """A threshold bound: a number, a one-value SQL query or a one-value DataFrame (scalar subquery)."""
    if isinstance(b, DataFrame):
        return b.scalar().cast("double"), "<query>"
    v = coerce_number(b)
    if isinstance(v, float):
        return F.lit(v), fmt_value(v)
    return spark.sql(v).scalar().cast("double"), v


def compile_threshold_check(spark, name: str, metric: str, min_threshold: Any, max_threshold: Any) -> Check:
    lo, lo_txt = _bound(spark, min_threshold)
    hi, hi_txt = _bound(spark, max_threshold)
    return Check(
        name=name,
        level="table",
        column=None,
        metric=metric,
        comparator="between",
        expected=f"[{lo_txt}, {hi_txt}]",
        value=F.expr(metric),
        verdict=lambda raw, failed, n: try_float(raw).between(lo, hi),
    )


def threshold_check(df: DataFrame, metric: str, min_threshold: Any, max_threshold: Any,
                    name: str = "threshold_check", suite: str | None = None) -> DataFrame:
    """``min <= metric <= max``; each bound a number, a SQL query or a DataFrame with one value.

    Query bounds are scalar subqueries planned into the same job (no cross join).
    """
    return evaluate(df, [compile_threshold_check(df.sparkSession, name, metric, min_threshold, max_threshold)], suite)


# --------------------------------------------------------------------------- interval check


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def interval_check(
    df: DataFrame,
    metrics_thresholds: Mapping[str, float],
    run_date,
    date_filter_column: str = "ds",
    days_back: int = -7,
    suite: str | None = None,
    name: str = "interval_check",
    ratio_formula: str = "max_over_min",
    ignore_zero: bool = False,
) -> DataFrame:
    """Each metric on ``run_date`` vs. ``run_date + days_back``: pass when the ratio ``<= limit``.

    ``ratio_formula``: ``max_over_min`` (``max(a, b) / min(a, b)``) or ``relative_diff``
    (``|today - ref| / ref``).  Both days are read in one scan with a range predicate on the raw
    column (pushed to the file scan, so row groups of other days are skipped); metrics are
    grouped by day and the two rows are folded into one.  A metric NULL on either day fails;
    zero on one day only fails (passes with ``ignore_zero``); zero on both days passes.
    """
    if ratio_formula not in ("max_over_min", "relative_diff"):
        raise ValueError("ratio_formula must be 'max_over_min' or 'relative_diff'")
    if date_filter_column not in df.columns:
        raise ValueError(f"interval check needs date column {date_filter_column!r}; frame has {df.columns}")
    today = _as_date(run_date)
    ref = today + _dt.timedelta(days=-abs(int(days_back)))
    names = list(metrics_thresholds)
    scoped = on_dates(df, date_filter_column, [today, ref]).withColumn("_day", day_of(df, date_filter_column))
    per_day = scoped.groupBy("_day").agg(*[F.expr(m).cast("double").alias(f"_m{i}") for i, m in enumerate(names)])
    folded = per_day.agg(
        *[F.max(F.when(F.col("_day") == F.lit(today), F.col(f"_m{i}"))).alias(f"_t{i}") for i in range(len(names))],
        *[F.max(F.when(F.col("_day") == F.lit(ref), F.col(f"_m{i}"))).alias(f"_r{i}") for i in range(len(names))],
    )
    structs = []
    for i, m in enumerate(names):
        t, r = F.col(f"_t{i}"), F.col(f"_r{i}")
        ratio = metrics_thresholds[m]
        hi, lo = F.greatest(t, r), F.least(t, r)
        raw = F.try_divide(hi, lo) if ratio_formula == "max_over_min" else F.try_divide(F.abs(t - r), r)
        neutral = F.lit(1.0) if ratio_formula == "max_over_min" else F.lit(0.0)
        observed = F.when((t == 0) & (r == 0), neutral).otherwise(raw)
        one_zero = ((t == 0) | (r == 0)) & ~((t == 0) & (r == 0))
        passed = (
            F.when(t.isNull() | r.isNull(), F.lit(False))
            .when(one_zero, F.lit(bool(ignore_zero)))
            .otherwise(F.coalesce(observed <= F.lit(float(ratio)), F.lit(False)))
        )
        structs.append(
            result_struct(
                suite=suite,
                check_name=name,
                level="table",
                column_name=date_filter_column,
                metric=m,
                comparator="ratio_leq",
                expected=f"{fmt_value(ratio)} vs {ref.isoformat()}",
                observed=F.round(observed, 6),
                n_rows=F.lit(None),
                n_failed=F.lit(None),
                passed=passed,
            )
        )
    return folded.select(F.inline(F.array(*structs)))


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("string", "varchar", "char")


def day_of(df: DataFrame, date_col: str) -> Column:
    """The day of a date, timestamp or text column; text that isn't a date is on no day (NULL)."""
    return F.col(date_col).try_cast("date") if _is_text(df, date_col) else F.to_date(F.col(date_col))


def on_dates(df: DataFrame, date_col: str, dates: Iterable) -> DataFrame:
    """Rows on the given days: a range predicate per day on the raw column, so the filter is
    pushed to the file scan (row groups / partitions of other days are skipped).  Text dates must
    begin with ``yyyy-MM-dd``; a time may follow.  Text that isn't a date is on no day: such rows
    are left out and never stop a check."""
    c = F.col(date_col)
    dtype = df.schema[date_col].dataType
    conds = []
    for d in (_as_date(x) for x in dates):
        if dtype.typeName() == "date":
            conds.append(c == F.lit(d))
        elif _is_text(df, date_col):  # ISO text sorts as its dates do; what else sorts there is no date
            conds.append((c >= F.lit(d.isoformat())) & (c < F.lit((d + _dt.timedelta(days=1)).isoformat())) & (day_of(df, date_col) == F.lit(d)))
        else:
            # text literals cast to the column's own type: a timestamp_ntz bound never meets a zone
            lo = F.lit(f"{d.isoformat()} 00:00:00").cast(dtype)
            hi = F.lit(f"{(d + _dt.timedelta(days=1)).isoformat()} 00:00:00").cast(dtype)
            conds.append((c >= lo) & (c < hi))
    return df.filter(reduce(lambda a, b: a | b, conds))


def metric_by_date(df: DataFrame, metrics: Mapping[str, str], date_col: str, dates: Iterable) -> DataFrame:
    """Metrics on several dates side by side: one scan (days pushed down), grouped by day."""
    return (
        on_dates(df, date_col, dates)
        .groupBy(day_of(df, date_col).alias(date_col))
        .agg(*[F.expr(expr).alias(alias) for alias, expr in metrics.items()])
    )


def value_set(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column with their row counts (partial-aggregated groupBy)."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- spot and ground-truth checks


def spot_keys(df: DataFrame, key_cols: list[str], n: int = 10, seed: str | int = "") -> DataFrame:
    """``n`` pseudo-random rows' keys: top-n by ``md5(keys|seed)`` (TakeOrderedAndProject, no sort)."""
    parts = [F.col(k) for k in key_cols] + ([F.lit(str(seed))] if seed != "" else [])
    h = F.md5(F.concat_ws("|", *parts))
    return df.select(*key_cols).orderBy(h, *[F.col(k) for k in key_cols]).limit(n)


def keep_matching(df: DataFrame, keys: DataFrame, key_cols: list[str], max_keys: int | None = None) -> DataFrame:
    """``WHERE key IN (subquery)`` as a semi join; the key side is broadcast when its size is bounded."""
    right = F.broadcast(keys) if max_keys is not None and max_keys <= 1_000_000 else keys
    return df.join(right, key_cols, "left_semi")


def spot_check(df: DataFrame, rules: Mapping[str, str | Column], key_cols: list[str], n: int = 10,
               seed: str | int = "", id_cols: Iterable[str] | None = None) -> DataFrame:
    """All rules on the rows of ``n`` pseudo-random keys, once for all keys (row flags)."""
    keys = spot_keys(df, key_cols, n, seed)
    spot = keep_matching(df, keys, key_cols, max_keys=n)
    return row_flags(spot, rules, list(id_cols) if id_cols is not None else key_cols)


def ground_truth_check(df: DataFrame, expected: Mapping[Any, Mapping[str, Any]] | list[Mapping[str, Any]] | DataFrame,
                       key: str) -> DataFrame:
    """Expected rows (values may be text) vs. actual rows, one flag per column per key.

    Output: key, ``found``, ``<col>_check`` 0/1 per expected column (a NULL on either side is 0),
    ``n_mismatch`` and ``passed``; one row per matching actual row, one failed row per missing
    key (a value or key that doesn't cast to the column's type is NULL).  Literal rows of at most
    ``BROADCAST_ROWS`` are broadcast into an inner join (the data side is never shuffled, however
    many rows one key holds) and their keys, when few, are also pushed to the scan as an ``IN``
    filter.  More rows, or a DataFrame, are joined as Spark sees fit.  Missing keys come from an
    anti join against the distinct matching keys (collapsed before any shuffle).
    """
    spark = df.sparkSession
    lower_cols = [c.lower() for c in df.columns]
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    scoped, small = df, False
    if isinstance(expected, DataFrame):
        cols = sorted((c for c in expected.columns if c.lower() != key.lower()), key=lambda c: lower_cols.index(c.lower()))
        exp = expected.select(F.col(key).cast("string"), *[F.col(c).cast("string") for c in cols])
    else:
        rows = [{key: k, **v} for k, v in expected.items()] if isinstance(expected, Mapping) else [dict(r) for r in expected]
        cols = sorted({c for r in rows for c in r if c != key}, key=lambda c: lower_cols.index(c.lower()))
        ddl = ", ".join(f"`{c}` string" for c in [key] + cols)
        exp = spark.createDataFrame([[None if r.get(c) is None else str(r.get(c)) for c in [key] + cols] for r in rows], ddl)
        small = len(rows) <= BROADCAST_ROWS
        keys = [r[key] for r in rows if r.get(key) is not None]
        if len(keys) <= PUSHDOWN_KEYS:
            scoped = df.filter(F.col(key).isin([F.lit(str(k)).try_cast(types[key.lower()]) for k in keys]))
    exp = exp.select(*[F.col(c).try_cast(types[c.lower()]).alias(f"_e_{c}") for c in [key] + cols])
    actual = scoped.select(F.col(key).alias("_a_key"), *[F.col(c).alias(f"_a_{c}") for c in cols])
    matched = actual.join(F.broadcast(exp) if small else exp, F.col("_a_key") == F.col(f"_e_{key}"), "inner")
    flags = [F.when(F.col(f"_a_{c}") == F.col(f"_e_{c}"), F.lit(1)).otherwise(F.lit(0)).alias(f"{c}_check") for c in cols]
    found = matched.select(F.col(f"_e_{key}").alias(key), F.lit(True).alias("found"), *flags)
    present = actual.select(F.col("_a_key")).distinct()
    missing = exp.join(present, F.col(f"_e_{key}") == F.col("_a_key"), "left_anti").select(
        F.col(f"_e_{key}").alias(key), F.lit(False).alias("found"), *[F.lit(0).alias(f"{c}_check") for c in cols]
    )
    out = found.unionByName(missing)
    mismatch = reduce(lambda a, b: a + b, [F.lit(1) - F.col(f"{c}_check") for c in cols]) if cols else F.lit(0)
    return out.withColumn("n_mismatch", mismatch.cast("int")).withColumn(
        "passed", F.col("found") & (F.col("n_mismatch") == 0)
    )


# --------------------------------------------------------------------------- gate (C14)


class CheckFailed(RuntimeError):
    """Failed checks: how many (``n_failed``), and the first ``SHOWN`` of them (``failed_rows``)."""

    def __init__(self, failed_rows, n_failed: int | None = None):
        self.failed_rows = failed_rows
        self.n_failed = len(failed_rows) if n_failed is None else n_failed
        names = ", ".join(str(r["check_name"]) for r in failed_rows)
        more = ", ..." if self.n_failed > len(failed_rows) else ""
        super().__init__(f"{self.n_failed} check(s) failed: {names}{more}" if failed_rows else "no verdicts: nothing was checked")


def not_passed() -> Column:
    """A verdict that isn't true: false, or NULL."""
    return ~F.coalesce(F.col("passed"), F.lit(False))


def failed_checks(results: DataFrame, columns: Iterable[str] = RESULT_COLUMNS) -> tuple[int, int, list[dict]]:
    """Number of verdicts, number of failed ones, and up to ``SHOWN`` of these.  However many there
    are, they are counted in Spark and only the shown ones are collected."""
    n, n_failed = results.agg(F.count(F.lit(1)), F.count_if(not_passed())).first()
    rows = [r.asDict() for r in results.filter(not_passed()).select(*columns).limit(SHOWN).collect()] if n_failed else []
    return n, n_failed, rows


def gate(results: DataFrame, on_fail: str = "raise") -> bool:
    """Stop (``raise``) or go on (``warn``) when any check failed.

    Verdicts are counted in Spark, so there may be any number of them.  A NULL verdict counts as
    failed, and so does a result frame without any verdict (nothing was checked).
    """
    import warnings

    if on_fail not in ("raise", "warn"):
        raise ValueError("on_fail must be 'raise' or 'warn'")
    n, n_failed, rows = failed_checks(results)
    if n and not n_failed:
        return True
    failure = CheckFailed(rows, n_failed)
    if on_fail == "raise":
        raise failure
    warnings.warn(str(failure), stacklevel=2)
    return False


__all__ = [
    "Check",
    "CheckFailed",
    "RuleError",
    "check_row",
    "column_checks",
    "day_of",
    "compile_column_checks",
    "compile_row_rules",
    "compile_table_checks",
    "compile_threshold_check",
    "compile_value_check",
    "evaluate",
    "failed_checks",
    "failing_rows",
    "gate",
    "ground_truth_check",
    "interval_check",
    "keep_matching",
    "metric_by_date",
    "not_passed",
    "on_dates",
    "value_set",
    "row_flags",
    "row_rules",
    "run_checks",
    "spot_check",
    "spot_keys",
    "table_checks",
    "threshold_check",
    "value_check",
]
