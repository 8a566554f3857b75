"""Rule expressions: user SQL text → Catalyst expressions, comparators, folds and flags.

Every helper returns a ``Column`` so that many rules can be fused into one aggregation
and stay inside whole-stage codegen; nothing here runs a job.
"""

from __future__ import annotations

import re
import warnings
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

# Comparator names used by column-level checks (fixed vocabulary of the check API).
COMPARATORS = ("equal_to", "greater_than", "geq_to", "less_than", "leq_to")


def as_col(rule: str | Column) -> Column:
    """SQL text or a Column → Column."""
    return F.expr(rule) if isinstance(rule, str) else rule


def coerce_number(value: Any) -> Any:
    """Float when the value reads as a number, else the value unchanged (thresholds, pass values)."""
    if isinstance(value, bool):
        return value
    try:
        return float(value)
    except (TypeError, ValueError):
        return value


def try_float(c: str | Column) -> Column:
    """Column form of ``coerce_number``: NULL instead of an error for text that is no number."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").try_cast("double")


def compare(observed: Column, comparator: str, value: Any, tolerance: float | None = None) -> Column:
    """``observed <comparator> value``; with a tolerance the bound is widened by ``value * tolerance``.

    The result is NULL when ``observed`` is NULL; callers fold NULL to a failure.
    """
    if comparator not in COMPARATORS:
        raise ValueError(f"unknown comparator {comparator!r}; expected one of {COMPARATORS}")
    v = F.lit(value)
    if tolerance is None:
        lo = hi = v
    else:
        lo = v * F.lit(1 - tolerance)
        hi = v * F.lit(1 + tolerance)
    if comparator == "equal_to":
        return observed == v if tolerance is None else observed.between(lo, hi)
    if comparator == "greater_than":
        return observed > lo
    if comparator == "geq_to":
        return observed >= lo
    if comparator == "less_than":
        return observed < hi
    return observed <= hi


def rule_flag(rule: str | Column) -> Column:
    """1 when the rule holds, else 0; a NULL rule counts as 0 (``CASE WHEN r THEN 1 ELSE 0``)."""
    return F.when(as_col(rule), F.lit(1)).otherwise(F.lit(0))


def first_true_flag(*rules: str | Column) -> Column:
    """Searched CASE with several branches: 1 when any branch holds, NULL branches fall through."""
    out = None
    for r in rules:
        out = F.when(as_col(r), F.lit(1)) if out is None else out.when(as_col(r), F.lit(1))
    return out.otherwise(F.lit(0))


def all_true(rule: str | Column) -> Column:
    """All-rows-true fold: ``MIN(CASE WHEN rule THEN 1 ELSE 0 END)``; NULL on an empty input."""
    return F.min(rule_flag(rule))


def count_failed(rule: str | Column) -> Column:
    """Rows where the rule is false or NULL."""
    return F.count_if(~F.coalesce(as_col(rule), F.lit(False)))


def holds(rule: str | Column) -> Column:
    """Rule as a strict boolean: NULL → False."""
    return F.coalesce(as_col(rule), F.lit(False))


class RuleError(ValueError):
    """A rule that cannot be evaluated (mixes per-row and aggregate terms, nested aggregates ...)."""


def rule_kind(df: DataFrame, rule: str) -> str:
    """``'aggregate'`` or ``'row'``, decided by Catalyst analysis of ``df.agg(rule)``; no job runs.

    Unknown columns are a user error and re-raised as is.  A rule mixing per-row and aggregate
    terms is reported as a bad rule.
    """
    try:
        df.agg(F.expr(rule).alias("_r")).schema
        return "aggregate"
    except AnalysisException as e:
        cond = e.getCondition() or ""
        if cond.startswith("MISSING_GROUP_BY") or cond.startswith("MISSING_AGGREGATION"):
            pass
        else:
            raise
    try:
        df.agg(all_true(rule).alias("_r")).schema
        return "row"
    except AnalysisException as e:
        raise RuleError(f"rule {rule!r} mixes per-row and aggregate terms: {e.getCondition()}") from e


_FN_IS_AGG: dict[tuple[int, str], bool] = {}
_LITERALS = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"")
_CALL = re.compile(r"([A-Za-z_][A-Za-z0-9_]*)\s*\(")
_IDENT = re.compile(r"`([^`]+)`|([A-Za-z_][A-Za-z0-9_]*)")
# words followed by "(" in SQL that are never aggregate functions
_NOT_CALLS = frozenset("and or not in when then else case as over filter exists between is like decimal varchar "
                       "char cast try_cast interval array map struct".split())


def is_aggregate_function(spark, name: str) -> bool:
    """Whether ``name`` is an aggregate function of the session (``DESCRIBE FUNCTION``, a
    driver-side command; cached per session and name, so a suite looks up each name once)."""
    key = (id(spark), name.lower())
    if key not in _FN_IS_AGG:
        try:
            rows = spark.sql(f"DESCRIBE FUNCTION `{name}`").collect()
            cls = next((r[0] for r in rows if str(r[0]).startswith("Class:")), "")
            _FN_IS_AGG[key] = ".aggregate." in cls
        except AnalysisException:  # unknown name: Catalyst reports it when the rule is analysed
            _FN_IS_AGG[key] = False
    return _FN_IS_AGG[key]


def _strip_literals(rule: str) -> str:
    return _LITERALS.sub(" ", rule)


def guess_rule_kind(df: DataFrame, rule: str) -> str:
    """``'aggregate'`` when the rule calls an aggregate function, else ``'row'`` — no round trip.

    Function kinds come from the session's registry (user-registered aggregates included); the
    fused aggregation built from the guess is analysed anyway, and callers fall back to
    ``rule_kind`` when that analysis fails.
    """
    calls = {m.group(1).lower() for m in _CALL.finditer(_strip_literals(rule))} - _NOT_CALLS
    spark = df.sparkSession
    return "aggregate" if any(is_aggregate_function(spark, c) for c in sorted(calls)) else "row"


def names_a_column(df: DataFrame, rule: str) -> bool:
    """True when the rule text (string literals removed) names a column of ``df``."""
    cols = {c.lower() for c in df.columns}
    for m in _IDENT.finditer(_strip_literals(rule)):
        name = (m.group(1) or m.group(2)).lower()
        if name in cols or name.split(".")[0] in cols:
            return True
    return False


def is_constant_rule(df: DataFrame, rule: str) -> bool:
    """True when the rule references no column of ``df`` (e.g. ``'id' IS NOT NULL`` tests a literal).

    Decided by analysing the rule as a filter over a one-row relation with no usable column: a
    filter rejects aggregates (``COUNT(*) > 0`` is not constant) and unknown names; no job runs.
    """
    spark = df.sparkSession
    r = F.expr(rule)
    try:
        spark.range(1).withColumnRenamed("id", "__dqforge_id__").filter(r.isNull() | r.isNotNull()).schema
        return True
    except AnalysisException:
        return False


def lint_rules(df: DataFrame, rules: dict[str, str]) -> list[str]:
    """Names of rules that test only literals (constant-literal trap); a warning per rule."""
    out = []
    for name, rule in rules.items():
        if (isinstance(rule, str) and not names_a_column(df, rule) and guess_rule_kind(df, rule) == "row"
                and is_constant_rule(df, rule)):
            warnings.warn(f"rule {name!r} ({rule}) references no column and is constant", stacklevel=2)
            out.append(name)
    return out
