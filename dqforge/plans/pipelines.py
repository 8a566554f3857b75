"""The pipelines of the reference (L1-L9) as plain functions composing the operators.

Scheduling, retries and notifications belong to an orchestrator; here each pipeline is the
data path: load → check → gate → publish/transform.  Every step is a Spark job over the
whole input; only verdict tables are collected (by the gate).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import checks as C
from ..operators import evaluate as EV
from ..operators import expectations as E
from ..operators import integrity as I
from ..operators import prep as PR
from ..operators import publish as P
from ..operators import registry as RG
from ..sources import files as FS
from ..sources import tables as TB
from ..sources.tables import materialize


@dataclass
class PipelineResult:
    passed: bool
    results: DataFrame | None = None
    output: DataFrame | None = None
    details: dict = field(default_factory=dict)


# --------------------------------------------------------------------------- L1 / L2 / L3: write-audit-publish


def write_audit_publish(df: DataFrame, dest_path: str, keys: Sequence[str], column: Any = None, table: Any = None,
                        registry: RG.Registry | None = None, on_fail: str = "raise") -> PipelineResult:
    """L1: stage → fused column + table checks → gate → insert-only merge.

    With a registry, the staged frame is first resolved to it and its defaults fill NULLs.  The
    audit copy is a run folder under the shared checkpoint folder (``details["audit_path"]``),
    kept for inspection; retention of that folder belongs to the platform's cleanup.
    """
    if registry is not None:
        df = RG.resolve_schema(df, registry)
    defaults = ({k.lower(): v["default"] for k, v in registry.properties.items() if "default" in v}
                if registry is not None else None)
    r = P.write_audit_publish(df, dest_path, list(keys), column=column, table=table, defaults=defaults, on_fail=on_fail)
    return PipelineResult(r.passed, r.results, details={"published": r.published, "audit_path": r.audit_path})


def mapped_write_audit_publish(df: DataFrame, dest_path: str, keys: Sequence[str], config: Mapping[str, Any],
                               on_fail: str = "raise") -> PipelineResult:
    """L2: as L1 with the rules taken from a config ``{"column": [...], "table": [...]}``."""
    return write_audit_publish(df, dest_path, keys, column=config.get("column"), table=config.get("table"),
                               on_fail=on_fail)


def suite_write_audit_publish(df: DataFrame, dest_path: str, keys: Sequence[str], suite: Any,
                              on_fail: str = "raise") -> PipelineResult:
    """L3: stage → expectation suite → gate → insert-only merge on a (composite) key."""
    r = P.write_audit_publish(df, dest_path, list(keys), suite=suite, on_fail=on_fail)
    return PipelineResult(r.passed, r.results, details={"published": r.published})


# --------------------------------------------------------------------------- L4: multi-table ELT


def multi_table_transform(left: DataFrame, right: DataFrame, key: str, left_checks: Mapping[str, Any],
                          right_checks: Mapping[str, Any], joined_checks: Mapping[str, Any], total_col: str,
                          ratio_of: tuple[str, str], ratio_name: str, on_fail: str = "raise",
                          total_of: Sequence[str] = (), target: str | None = None) -> PipelineResult:
    """L4: check both inputs → left join → total → check the joined table (incl. invariants) → ratio.

    ``*_checks`` are ``{"column": ..., "table": ...}`` configs.  ``total_col`` is the sum of
    ``total_of`` (a NULL part counts as 0); the joined table is written once (to ``target`` when
    given) and read by the checks and the output.  The ratio uses ``try_divide`` (NULL on a zero
    denominator).
    """
    both = C.run_checks(left, suite="left", **left_checks).unionByName(C.run_checks(right, suite="right", **right_checks))
    both = materialize(both, name="input-results")
    ok = C.gate(both, on_fail=on_fail)
    joined = P.enrich(left, right, key, "left")
    if total_of:
        parts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in total_of]
        joined = joined.withColumn(total_col, reduce(lambda a, b: a + b, parts))
    joined = materialize(joined, target, name="joined")
    jr = materialize(C.run_checks(joined, suite="joined", **joined_checks), name="joined-results")
    ok = C.gate(jr, on_fail=on_fail) and ok
    num, den = ratio_of
    out = joined.withColumn(ratio_name, F.try_divide(F.col(num), F.col(den)))
    return PipelineResult(ok, both.unionByName(jr), out, {"total_col": total_col})


# --------------------------------------------------------------------------- L5: dated files


def dated_files_checks(spark: SparkSession, files: Mapping[str, str], schema: Any, run_date, row_rules: Mapping[str, str],
                       value: tuple[str, Any] | None = None, interval: Mapping[str, float] | None = None,
                       threshold: tuple[str, Any, Any] | None = None, ts_format: str | None = None,
                       date_col: str = "upload_date", header: bool = True) -> PipelineResult:
    """Files listed newest first get load dates ``run_date - i``; all are read in one union,
    then row rules, a value check and a threshold check run over the table in one pass, an interval check over
    the rows of its two days.
    """
    parts = []
    for i, (name, path) in enumerate(files.items()):
        df = FS.read_csv(spark, path, schema, header=header, ts_format=ts_format)
        parts.append(PR.with_load_date(df, run_date, offset=i, name=date_col))
    table = reduce(lambda a, b: a.unionByName(b), parts)
    checks = C.compile_row_rules(table, row_rules)
    if value:
        checks.append(replace(C.compile_value_check("value_check", value[0], value[1]), suite="value"))
    if threshold:
        checks.append(replace(C.compile_threshold_check(spark, "threshold_check", *threshold), suite="threshold"))
    res = [C.evaluate(table, checks, "rows")]
    if interval:
        res.append(C.interval_check(table, interval, run_date, date_filter_column=date_col, days_back=-1, suite="interval"))
    results = materialize(reduce(lambda a, b: a.unionByName(b), res), name="dated-results")
    return PipelineResult(C.gate(results, on_fail="warn"), results, table)


# --------------------------------------------------------------------------- L6: integrity then ground truth


def load_with_integrity(spark: SparkSession, path: str, manifest: DataFrame, schema: Any,
                        expected: Mapping[Any, Mapping[str, Any]], key: str, file_hint: str) -> PipelineResult:
    """File checksums vs. manifest → checked load → no load errors → ground truth rows."""
    sums = materialize(I.verify_manifest(I.file_checksums(spark, path), manifest), name="checksums")
    checked = FS.load_csv_checked(spark, path, schema)
    load_ok = materialize(I.no_load_errors(checked, file_hint), name="load-results")
    truth = materialize(C.ground_truth_check(FS.clean_rows(checked), expected, key), name="truth-results")
    integrity_ok = sums.filter(F.col("status") != "ok").limit(1).count() == 0
    ok = integrity_ok and C.gate(load_ok, on_fail="warn") and truth.filter(~F.col("passed")).limit(1).count() == 0
    return PipelineResult(ok, load_ok, truth, {"checksums": sums})


# --------------------------------------------------------------------------- L7: load → suite → warn


def load_and_validate(spark: SparkSession, path: str, schema: Any, suite: Any, target: str | None = None,
                      required: Sequence[str] = (), allow_jagged: bool = True) -> PipelineResult:
    """Lenient load (jagged rows allowed) → required columns → optional table write → suite →
    warn on failure.  A NULL in a required column fails the load: ``CheckFailed``, nothing is written."""
    checked = FS.load_csv_checked(spark, path, schema, allow_jagged=allow_jagged)
    data = FS.clean_rows(checked)
    if required:
        C.gate(C.column_checks(data, {c: {"null_check": {"equal_to": 0}} for c in required}, suite="required"))
    if target:
        FS.load(data, target)
        data = spark.read.parquet(target) if "/" in target else spark.table(target)
    results = materialize(E.validate(data, suite), name="load-suite")
    return PipelineResult(C.gate(results, on_fail="warn"), results, data)


# --------------------------------------------------------------------------- L8: features and models


def feature_pipeline(raw: DataFrame, preprocess_suite: Any, feature_suite: Any, sentinel_cols: Sequence[str],
                     drop_cols: Sequence[str], onehot_cols: Sequence[str], bin_spec: tuple[str, list, list, str],
                     target: tuple[str, Any, str], drop_after: Sequence[str], on_fail: str = "raise") -> PipelineResult:
    """L8 data path: clean → suite → one-hot, bins, target flag → suite (each gated)."""
    clean = PR.clean(raw, sentinel_cols=sentinel_cols, drop=drop_cols)
    r1 = materialize(E.validate(clean, preprocess_suite), name="clean-suite")
    C.gate(r1, on_fail=on_fail)
    feats = PR.one_hot(clean, list(onehot_cols))
    col, edges, labels, name = bin_spec
    feats = PR.bin_column(feats, col, edges, labels, name)
    tcol, tval, tname = target
    feats = PR.flag_equals(feats, tcol, tval, tname).drop(*drop_after)
    r2 = materialize(E.validate(feats, feature_suite), name="feature-suite")
    ok = C.gate(r2, on_fail=on_fail)
    return PipelineResult(ok, r1.unionByName(r2), feats)


def train_and_select(features: DataFrame, feature_cols: Sequence[str], label: str, key: str,
                     models: Mapping[str, Mapping[str, Sequence]], folds: int = 5, seed: int = 55) -> PipelineResult:
    """L8 model path: stratified split → grid search per model → test metrics → best run → refit."""
    # written once to the shared folder: every fold of every grid point reads it
    split = TB.materialize(EV.stratified_split(features, label, key, 0.2, seed), name="split")
    train = split.filter(F.col("split") == "train").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")
    runs = []
    fitted = {}
    for name, grid in models.items():
        cvm, res = EV.grid_search(train, feature_cols, label, name, grid, folds=folds, seed=seed, key=key)
        pred = EV.positive_probability(cvm.bestModel.transform(test))
        pred = pred.withColumn("yhat", EV.predict_class("score"))
        m = EV.hard_label_metrics(pred, label, "yhat").withColumn("run_id", F.lit(name))
        runs.append(m)
        best_params = max(zip(cvm.avgMetrics, cvm.getEstimatorParamMaps()), key=lambda t: t[0])[1]
        fitted[name] = {p.name: v for p, v in best_params.items()}
    table = reduce(lambda a, b: a.unionByName(b), runs)
    best = EV.best_run(table).collect()[0]
    model = EV.refit(features, feature_cols, label, best["run_id"], fitted[best["run_id"]], seed)
    return PipelineResult(True, table, None, {"best": best.asDict(), "model": model, "params": fitted})


# --------------------------------------------------------------------------- L9: simple load and checks


def simple_load_checks(spark: SparkSession, rows: list, schema: Any, column: Any = None, table: Any = None,
                       value: tuple[str, Any] | None = None, first_row_sql: str | None = None,
                       name: str = "simple") -> PipelineResult:
    """Literal rows → (first-row, value, column, table) checks → drop the scratch table."""
    df = FS.from_rows(spark, rows, schema)
    view = f"_{name}_rows"
    df.createOrReplaceTempView(view)
    res = []
    if column or table:
        res.append(C.run_checks(df, column=column, table=table, suite=name))
    if value:
        res.append(C.value_check(df, value[0], value[1], suite=name))
    if first_row_sql:
        res.append(C.check_row(TB.run_sql(spark, first_row_sql.replace("{table}", view)), suite=name))
    results = materialize(reduce(lambda a, b: a.unionByName(b), res), name="simple-results")
    ok = C.gate(results, on_fail="warn")
    spark.catalog.dropTempView(view)
    return PipelineResult(ok, results)
