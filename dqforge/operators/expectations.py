"""Declarative expectation suites (JSON), validated as one fused aggregation per batch set.

A suite compiles to ``Check`` objects of the fused engine: row-count, not-null, value-set and
range expectations become aggregate terms of one pass (per batch with ``by``), and schema
expectations are answered from the frame's schema without a job.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path
from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from ..results import RESULT_COLUMNS, RESULT_DDL, result_struct
from .checks import Check, evaluate, not_passed, with_missing_batches

# Expectation types of the suite format that we evaluate (fixed vocabulary).
ROW_COUNT_BETWEEN = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
DISTINCT_IN_SET = "expect_column_distinct_values_to_be_in_set"
VALUES_BETWEEN = "expect_column_values_to_be_between"
COLUMNS_MATCH = "expect_table_columns_to_match_ordered_list"
OF_TYPE = "expect_column_values_to_be_of_type"
IN_SET = "expect_column_values_to_be_in_set"
SUPPORTED = (ROW_COUNT_BETWEEN, NOT_NULL, DISTINCT_IN_SET, VALUES_BETWEEN, COLUMNS_MATCH, OF_TYPE, IN_SET)

# Type words of the suite format → accepted Spark types ("int" is any integral type).
TYPE_WORDS = {
    "int": (ByteType, ShortType, IntegerType, LongType),
    "integer": (ByteType, ShortType, IntegerType, LongType),
    "int64": (LongType,),
    "int32": (IntegerType,),
    "long": (LongType,),
    "float": (FloatType, DoubleType),
    "float64": (DoubleType,),
    "double": (DoubleType,),
    "decimal": (DecimalType,),
    "str": (StringType,),
    "string": (StringType,),
    "object": (StringType,),
    "bool": (BooleanType,),
    "boolean": (BooleanType,),
    "date": (DateType,),
    "datetime": (TimestampType, TimestampNTZType),
    "timestamp": (TimestampType, TimestampNTZType),
}


@dataclass
class Expectation:
    expectation_type: str
    kwargs: dict = field(default_factory=dict)
    meta: dict = field(default_factory=dict)

    def expected_text(self) -> str:
        """Deterministic JSON of the arguments (the ``expected`` field of a result row)."""
        return json.dumps(self.kwargs, sort_keys=True, separators=(",", ":"))


@dataclass
class Suite:
    name: str
    expectations: list[Expectation]

    @classmethod
    def from_dict(cls, d: Mapping[str, Any], name: str | None = None) -> "Suite":
        exps = [
            Expectation(e["expectation_type"], dict(e.get("kwargs", {})), dict(e.get("meta", {})))
            for e in d.get("expectations", [])
        ]
        return cls(name or d.get("expectation_suite_name") or "suite", exps)


def load_suite(source: str | Path | Mapping[str, Any], name: str | None = None) -> Suite:
    """Suite from a JSON file or dict.  Keyed by path when loaded from a file (two files may share
    one inner name); an empty suite is valid and passes."""
    if isinstance(source, Mapping):
        return Suite.from_dict(source, name)
    p = Path(source)
    with open(p) as f:
        d = json.load(f)
    return Suite.from_dict(d, name or str(p.with_suffix("")))


# --------------------------------------------------------------------------- compilation


def _mostly_verdict(mostly: float | None):
    """Pass when the share of expected values among evaluated values is at least ``mostly``."""

    def verdict(raw, failed, n):
        if mostly is None:
            return failed == 0
        return F.coalesce(raw >= F.lit(float(mostly)), F.lit(True))

    return verdict


def _share(good: Column, evaluated: Column) -> Column:
    return F.when(evaluated == 0, F.lit(None)).otherwise(good / evaluated)


def compile_expectation(df: DataFrame, e: Expectation) -> Check | None:
    """Data-dependent expectations → fused ``Check``; schema expectations → None (see ``schema_rows``)."""
    t, k = e.expectation_type, e.kwargs
    if t not in SUPPORTED:
        raise ValueError(f"unsupported expectation {t!r}; supported: {SUPPORTED}")
    exp = e.expected_text()
    if t == ROW_COUNT_BETWEEN:
        lo, hi = k.get("min_value"), k.get("max_value")

        def verdict(raw, failed, n, lo=lo, hi=hi):
            ok = F.lit(True)
            if lo is not None:
                ok = ok & (raw >= F.lit(lo))
            if hi is not None:
                ok = ok & (raw <= F.lit(hi))
            return ok

        return Check(name=t, level="table", column=None, metric="row_count", comparator="between", expected=exp,
                     value=F.count(F.lit(1)), verdict=verdict)
    if t in (COLUMNS_MATCH, OF_TYPE):
        return None
    col = k["column"]
    c = F.col(col)
    mostly = k.get("mostly")
    if t == NOT_NULL:
        nulls = F.count_if(c.isNull())
        share = _share(F.count(c), F.count(F.lit(1)))
        return Check(name=t, level="column", column=col, metric="not_null", comparator="mostly", expected=exp,
                     value=share, failed=nulls, verdict=_mostly_verdict(mostly), observed=lambda raw: raw)
    if t in (IN_SET, DISTINCT_IN_SET):
        values = list(k["value_set"])
        bad = c.isNotNull() & ~c.isin(values)
        unexpected = F.count_if(bad)
        share = _share(F.count(c) - unexpected, F.count(c))
        mostly = None if t == DISTINCT_IN_SET else mostly
        return Check(name=t, level="column", column=col, metric="in_set", comparator="mostly", expected=exp,
                     value=share, failed=unexpected, verdict=_mostly_verdict(mostly), observed=lambda raw: raw)
    if t == VALUES_BETWEEN:
        lo, hi = k.get("min_value"), k.get("max_value")
        strict_lo, strict_hi = k.get("strict_min", False), k.get("strict_max", False)
        inside = F.lit(True)
        if lo is not None:
            inside = inside & ((c > F.lit(lo)) if strict_lo else (c >= F.lit(lo)))
        if hi is not None:
            inside = inside & ((c < F.lit(hi)) if strict_hi else (c <= F.lit(hi)))
        unexpected = F.count_if(c.isNotNull() & ~inside)
        share = _share(F.count(c) - unexpected, F.count(c))
        return Check(name=t, level="column", column=col, metric="between", comparator="mostly", expected=exp,
                     value=share, failed=unexpected, verdict=_mostly_verdict(mostly), observed=lambda raw: raw)
    raise AssertionError(t)


def _type_ok(dtype, word: str) -> bool:
    accepted = TYPE_WORDS.get(word.lower())
    if accepted is None:
        return dtype.simpleString() == word.lower()
    return isinstance(dtype, accepted)


def schema_rows(df: DataFrame, suite: Suite, by: Iterable[str] = ()) -> list[tuple]:
    """Schema expectations answered from ``df.schema`` on the driver (no job).

    Columns that only tell batches apart (``by``, and those that ``list_batches`` adds) aren't part
    of the data's schema."""
    rows = []
    names = [f.name for f in df.schema.fields if f.name not in set(by) and not f.metadata.get("batch_column")]
    types = {f.name: f.dataType for f in df.schema.fields}
    for e in suite.expectations:
        if e.expectation_type == COLUMNS_MATCH:
            want = list(e.kwargs.get("column_list", []))
            mism = sum(1 for a, b in zip(want, names) if a != b) + abs(len(want) - len(names))
            rows.append((suite.name, COLUMNS_MATCH, "schema", None, "columns_ordered", "equal_to", e.expected_text(),
                         float(len(names)), None, mism, want == names))
        elif e.expectation_type == OF_TYPE:
            col, word = e.kwargs["column"], e.kwargs["type_"]
            ok = col in types and _type_ok(types[col], word)
            rows.append((suite.name, OF_TYPE, "schema", col, "type", "equal_to", e.expected_text(),
                         None, None, 0 if ok else 1, ok))
    return rows


def _compile(df: DataFrame, suite: Suite, extra: dict | None, by: Iterable[str] = ()):
    checks = []
    for e in suite.expectations:
        c = compile_expectation(df, e)
        if c is not None:
            c.suite, c.extra = suite.name, extra
            checks.append(c)
    srows = [(*r, *[v for _, v in sorted((extra or {}).items())]) for r in schema_rows(df, suite, by)]
    return checks, srows


def _validate_many(df: DataFrame, suites: list[tuple[Suite, dict | None]], by: list[str]) -> DataFrame:
    """Every data expectation of every suite in ONE aggregation; schema rows added as literals."""
    spark = df.sparkSession
    extra_keys = sorted((suites[0][1] or {}).keys())
    checks, srows = [], []
    for suite, extra in suites:
        c, r = _compile(df, suite, extra, by)
        checks += c
        srows += r
        if not c and not r:  # an empty suite passes: one summary row
            srows.append((suite.name, "empty_suite", "table", None, None, None, None, None, None, 0, True,
                          *[v for _, v in sorted((extra or {}).items())]))
    ddl = RESULT_DDL + "".join(f", {k} string" for k in extra_keys)
    parts = []
    if checks:
        parts.append(evaluate(df, checks, None, by))
    if srows:
        if by:
            parts.append(_attach_keys(df.select(*by).distinct(), srows, by, extra_keys))
        else:
            parts.append(spark.createDataFrame(srows, ddl))
    return reduce(lambda a, b: a.unionByName(b), parts)


def validate(df: DataFrame, suite: Suite | Mapping | str, by: Iterable[str] | None = None, expected: DataFrame | None = None) -> DataFrame:
    """Run a suite over a batch (or over each batch of ``by``) → result rows; lazy.

    All data expectations share one aggregation; schema expectations are literal rows (repeated
    for every batch when grouped).  An empty suite passes with one summary row.  ``expected`` holds the
    keys of the batches there should be: one without rows gets the verdicts of an empty batch.
    """
    suite = suite if isinstance(suite, Suite) else load_suite(suite)
    by = list(by or [])
    results = _validate_many(df, [(suite, None)], by)
    if by and expected is not None:
        results = with_missing_batches(results, _validate_many(df.limit(0).drop(*by), [(suite, None)], []), df, expected, by)
    return results


def _attach_keys(keys: DataFrame, rows: list[tuple], by: list[str], extra_keys: list[str] = ()) -> DataFrame:
    """Repeat the few fixed schema rows for every batch key without a cross join: the rows are
    an array literal exploded next to each key."""
    structs = []
    for r in rows:
        d = dict(zip(RESULT_COLUMNS + list(extra_keys), r))
        structs.append(
            result_struct(
                suite=d["suite"], check_name=d["check_name"], level=d["level"], column_name=d["column_name"],
                metric=d["metric"], comparator=d["comparator"], expected=d["expected"],
                observed=F.lit(d["observed"]), n_rows=F.lit(d["n_rows"]), n_failed=F.lit(d["n_failed"]),
                passed=F.lit(d["passed"]), extra={k: d[k] for k in extra_keys},
            )
        )
    return keys.select(*[F.col(b) for b in by], F.inline(F.array(*structs)))


def validate_tiers(df: DataFrame, tiers: Mapping[str, Suite | Mapping | str], by: Iterable[str] | None = None) -> DataFrame:
    """Several suites by tier (e.g. ``warning``, ``failure``) in one pass; results carry ``tier``."""
    suites = [(s if isinstance(s, Suite) else load_suite(s), {"tier": t}) for t, s in tiers.items()]
    return _validate_many(df, suites, list(by or []))


def summary(results: DataFrame, keys: Iterable[str] = ("suite",)) -> DataFrame:
    """Pass-rate summary (the data-docs figure): checks, passed, rate per key."""
    keys = list(keys)
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(F.col("passed")).alias("n_passed"),
        F.round(F.count_if(F.col("passed")) / F.count(F.lit(1)), 6).alias("pass_rate"),
    )


def gate_tiers(results: DataFrame, fail_tier: str = "failure") -> bool:
    """Raise when a check of ``fail_tier`` failed; warn for other tiers; True when all passed.  A
    NULL verdict counts as failed."""
    import warnings

    from .checks import CheckFailed, failed_checks

    # each tier is asked for on its own: however many warnings there are, no hard failure is lost
    columns = ["tier", *RESULT_COLUMNS]
    _, n_hard, hard = failed_checks(results.filter(F.col("tier") == fail_tier), columns)
    _, n_soft, soft = failed_checks(results.filter(~F.col("tier").eqNullSafe(fail_tier)), columns)
    if n_soft:
        warnings.warn(str(CheckFailed(soft, n_soft)), stacklevel=2)
    if n_hard:
        raise CheckFailed(hard, n_hard)
    return not n_soft


def unexpected_values(df: DataFrame, column: str, value_set: Iterable, limit: int | None = None) -> DataFrame:
    """All values outside a set with their row counts (asked only after a failure); with ``limit``
    the most frequent ones."""
    c = F.col(column)
    found = df.filter(c.isNotNull() & ~c.isin(list(value_set))).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return found if limit is None else found.orderBy(F.desc("n"), F.col("value")).limit(limit)


# --------------------------------------------------------------------------- checkpoints


@dataclass
class Checkpoint:
    """Name, suite and batches, plus actions (store results) — a run of one suite over batches."""

    name: str
    suite: Suite
    batches: list = field(default_factory=list)  # list of Batch
    store_path: str | None = None

    def run(self) -> DataFrame:
        schemas = {b.df.schema.simpleString() for b in self.batches}
        if len(schemas) == 1 and "batch_id" not in self.batches[0].df.columns:
            # same schema: one union tagged by batch, validated in ONE grouped aggregation
            tagged = reduce(lambda a, b: a.unionByName(b),
                            [b.df.withColumn("batch_id", F.lit(b.batch_id)) for b in self.batches])
            ids = tagged.sparkSession.createDataFrame([(b.batch_id,) for b in self.batches], "batch_id string")
            res = validate(tagged, self.suite, by=["batch_id"], expected=ids)
            res = res.select(*[c for c in res.columns if c != "batch_id"], "batch_id")
        else:
            parts = [validate(b.df, self.suite).withColumn("batch_id", F.lit(b.batch_id)) for b in self.batches]
            res = reduce(lambda a, b: a.unionByName(b), parts)
        res = res.withColumn("checkpoint", F.lit(self.name))
        if self.store_path:
            from ..sources.tables import materialize, store_results

            res = materialize(res, name=f"checkpoint-{self.name}")
            store_results(res, self.store_path)
        return res


def run_checkpoint(df: DataFrame, suite, batch_cols: Iterable[str], name: str = "checkpoint", expected: DataFrame | None = None) -> DataFrame:
    """All batches of one frame (batch columns from ``list_batches`` or a derived day) in one pass; ``expected`` as in ``validate``."""
    return validate(df, suite, by=batch_cols, expected=expected).withColumn("checkpoint", F.lit(name))


__all__ = [
    "Checkpoint",
    "Expectation",
    "Suite",
    "compile_expectation",
    "gate_tiers",
    "load_suite",
    "run_checkpoint",
    "schema_rows",
    "summary",
    "unexpected_values",
    "validate",
    "validate_tiers",
]


# --------------------------------------------------------------------------- checkpoint configs

STORE_ACTION = "StoreValidationResultAction"


def _load_config(config) -> dict:
    if isinstance(config, Mapping):
        return dict(config)
    import yaml

    with open(config) as f:
        return yaml.safe_load(f)


def resolve_suite(name: str, suites) -> Suite:
    """Suite by name from a dict ``{name: suite}`` or a directory where ``a.b`` is ``a/b.json``."""
    if isinstance(suites, Mapping):
        s = suites[name]
        return s if isinstance(s, Suite) else load_suite(s, name=name)
    path = Path(suites).joinpath(*name.split(".")).with_suffix(".json")
    return load_suite(path, name=name)


def run_checkpoint_config(config, assets: Mapping[str, DataFrame], suites, batch_key: str | None = None,
                          store_path: str | None = None) -> DataFrame:
    """Run a checkpoint described like a checkpoint config file (YAML path or dict).

    Uses ``name``, ``expectation_suite_name`` and each validation's
    ``batch_request.data_asset_name`` (looked up in ``assets``); ``data_connector_query.index:
    -1`` selects the latest batch by ``batch_key``; a ``StoreValidationResultAction`` in
    ``action_list`` appends the results to ``store_path``.  Returns the results (``batch_id`` =
    asset name, ``checkpoint`` = name).
    """
    cfg = _load_config(config)
    name = cfg.get("name", "checkpoint")
    default_suite = cfg.get("expectation_suite_name")
    parts = []
    for v in cfg.get("validations") or []:
        br = v.get("batch_request") or {}
        asset = br["data_asset_name"]
        df = assets[asset]
        query = br.get("data_connector_query") or {}
        if query.get("index") == -1:
            if not batch_key:
                raise ValueError("index -1 (latest batch) needs batch_key")
            from ..sources.batches import latest_batch

            df = latest_batch(df, batch_key)
        suite = resolve_suite(v.get("expectation_suite_name") or default_suite, suites)
        parts.append(validate(df, suite).withColumn("batch_id", F.lit(asset)))
    if not parts:
        raise ValueError(f"checkpoint {name!r} has no validations")
    res = reduce(lambda a, b: a.unionByName(b), parts).withColumn("checkpoint", F.lit(name))
    actions = [(a.get("action") or {}).get("class_name") for a in cfg.get("action_list") or []]
    if STORE_ACTION in actions:
        if not store_path:
            raise ValueError(f"checkpoint {name!r} stores its results: store_path is needed")
        from ..sources.tables import materialize, store_results

        res = materialize(res, name=f"checkpoint-{name}")
        store_results(res, store_path, partition_by=("checkpoint",))
    return res


# --------------------------------------------------------------------------- failure details

def _unexpected_condition(e: Expectation):
    c = F.col(e.kwargs["column"])
    t = e.expectation_type
    if t in (IN_SET, DISTINCT_IN_SET):
        return c.isNotNull() & ~c.isin(list(e.kwargs["value_set"]))
    if t == VALUES_BETWEEN:
        lo, hi = e.kwargs.get("min_value"), e.kwargs.get("max_value")
        inside = F.lit(True)
        if lo is not None:
            inside = inside & ((c > F.lit(lo)) if e.kwargs.get("strict_min") else (c >= F.lit(lo)))
        if hi is not None:
            inside = inside & ((c < F.lit(hi)) if e.kwargs.get("strict_max") else (c <= F.lit(hi)))
        return c.isNotNull() & ~inside
    if t == NOT_NULL:
        return c.isNull()
    return None


def failure_details(df: DataFrame, suite: Suite | Mapping | str, results: DataFrame, limit: int | None = None) -> DataFrame:
    """The unexpected values of each failed value-level expectation; with ``limit`` the most frequent ones.

    Only failed checks are looked at (at most as many as the suite has, however many batches
    failed them); each becomes one grouped query over the batch.  Columns: ``check_name,
    column_name, value (text), n``.
    """
    suite = suite if isinstance(suite, Suite) else load_suite(suite)
    failed = {(r["check_name"], r["column_name"]) for r in
              results.filter(not_passed()).select("check_name", "column_name").distinct().collect()}
    parts = []
    for e in suite.expectations:
        cond = _unexpected_condition(e)
        if cond is None or (e.expectation_type, e.kwargs.get("column")) not in failed:
            continue
        col = e.kwargs["column"]
        found = df.filter(cond).groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        if limit is not None:
            found = found.orderBy(F.desc("n"), F.col("value").asc_nulls_first()).limit(limit)
        parts.append(found.select(F.lit(e.expectation_type).alias("check_name"), F.lit(col).alias("column_name"), "value", "n"))
    if not parts:
        return df.sparkSession.createDataFrame([], "check_name string, column_name string, value string, n bigint")
    return reduce(lambda a, b: a.unionByName(b), parts)
