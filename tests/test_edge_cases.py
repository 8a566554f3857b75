"""Hand-made edge cases (FIXTURES.md §2, small cases)."""

import warnings

import pytest
from pyspark.sql import functions as F

from dqforge.functions.rules import RuleError, is_constant_rule, rule_kind
from dqforge.operators import checks as C
from dqforge.operators import evaluate as EV
from dqforge.operators import prep as PR
from dqforge.operators import publish as P
from dqforge.operators import registry as RG
from dqforge.sources.files import clean_rows, load_csv_checked


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_all_true_fold_empty_and_null(spark):
    empty = spark.createDataFrame([], "x int")
    r = one(C.table_checks(empty, {"positive": "x > 0"}))
    assert r["observed"] is None and r["passed"] is False
    nulls = spark.createDataFrame([(1,), (None,)], "x int")
    r = one(C.table_checks(nulls, {"positive": "x > 0"}))
    assert r["passed"] is False and r["n_failed"] == 1


def test_rule_kind_and_constant_lint(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rule_kind(df, "a < b") == "row"
    assert rule_kind(df, "COUNT(*) = 1") == "aggregate"
    with pytest.raises(RuleError):
        rule_kind(df, "a > 0 AND COUNT(*) > 3")
    assert is_constant_rule(df, "'a' IS NOT NULL")
    assert not is_constant_rule(df, "a IS NOT NULL")
    assert not is_constant_rule(df, "COUNT(*) > 0")
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        C.table_checks(df, {"trap": "'a' IS NOT NULL"}).collect()
        assert any("constant" in str(x.message) for x in w)


def test_interval_cases(spark):
    import datetime as dt

    rows = [(dt.date(2024, 1, 2), 3.0), (dt.date(2024, 1, 1), 2.0), (dt.date(2024, 1, 3), 0.0),
            (dt.date(2024, 1, 4), 0.0)]
    df = spark.createDataFrame(rows, "ds date, v double")
    r = one(C.interval_check(df, {"SUM(v)": 1.5}, "2024-01-02", days_back=-1))
    assert r["passed"] and r["observed"] == 1.5  # ratio equal to the limit passes
    r = one(C.interval_check(df, {"SUM(v)": 1.5}, "2024-01-05", days_back=-1))
    assert not r["passed"]  # one side missing
    r = one(C.interval_check(df, {"SUM(v)": 1.5}, "2024-01-04", days_back=-1))
    assert r["passed"]  # both zero
    r = one(C.interval_check(df, {"SUM(v)": 1.5}, "2024-01-03", days_back=-1))
    assert not r["passed"]  # zero on one side only


def test_threshold_and_value(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert one(C.threshold_check(df, "MIN(x)", 1, 3))["passed"]
    assert one(C.threshold_check(df, "MAX(x)", 1, 3))["passed"]
    df.createOrReplaceTempView("bounds_t")
    assert one(C.threshold_check(df, "AVG(x)", "SELECT MIN(x) FROM bounds_t", "SELECT MAX(x) FROM bounds_t"))["passed"]
    assert not one(C.threshold_check(df, "AVG(x)", 2.5, "SELECT MAX(x) FROM bounds_t"))["passed"]
    assert one(C.value_check(df, "SUM(x)", 4))["passed"]
    assert not one(C.value_check(df, "SUM(x)", 4.5))["passed"]
    assert one(C.value_check(df, "SUM(x)", 4.3, tolerance=0.1))["passed"]
    s = spark.createDataFrame([("b",), ("a",)], "s string")
    assert one(C.value_check(s, "MAX(s)", "b"))["passed"]


def test_check_row_truthiness(spark):
    ok = spark.createDataFrame([(1, "x", True)], "a int, b string, c boolean")
    assert one(C.check_row(ok))["passed"]
    for row in [(0, "x", True), (1, "", True), (1, "x", False), (None, "x", True)]:
        bad = spark.createDataFrame([row], "a int, b string, c boolean")
        assert not one(C.check_row(bad))["passed"]
    assert not one(C.check_row(spark.createDataFrame([], "a int")))["passed"]


def test_gate(spark):
    df = spark.createDataFrame([(1,)], "x int")
    good = C.table_checks(df, {"c": "COUNT(*) = 1"})
    bad = C.table_checks(df, {"c": "COUNT(*) = 2"})
    assert C.gate(good)
    with pytest.raises(C.CheckFailed):
        C.gate(bad)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert C.gate(bad, on_fail="warn") is False


def test_insert_only_merge(spark, tmp_path):
    dest = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, tag string")
    staged = spark.createDataFrame([(1, "changed", None), (None, "nullkey", None), (3, "c", None), (3, "c2", "z")],
                                   "id int, v string, tag string")
    new = P.publish_new(staged, dest, ["id"], defaults={"tag": "dflt"})
    got = sorted((r["id"] or -1, r["v"], r["tag"]) for r in new.collect())
    assert got == [(-1, "nullkey", "dflt"), (3, "c", "dflt"), (3, "c2", "z")]
    path = str(tmp_path / "dest")
    dest.write.parquet(path)
    assert P.publish(staged, path, ["id"], defaults={"tag": "dflt"}) == 3
    # re-run: only the NULL-key row is inserted again
    assert P.publish(staged, path, ["id"], defaults={"tag": "dflt"}) == 1
    final = {r["id"]: r["v"] for r in spark.read.parquet(path).filter("id = 1").collect()}
    assert final == {1: "a"}


def test_wap_gate_blocks(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    path = str(tmp_path / "d")
    df.limit(0).write.parquet(path)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        r = P.write_audit_publish(df, path, ["id"], table={"big": "COUNT(*) > 5"}, on_fail="warn")
    assert not r.passed and r.published == 0 and spark.read.parquet(path).count() == 0
    r = P.write_audit_publish(df, path, ["id"], table={"some": "COUNT(*) > 0"})
    assert r.passed and r.published == 2


def test_bins(spark):
    vals = [16, 17, 29, 30, 39, 49, 59, 60, 100, 101]
    df = spark.createDataFrame([(v,) for v in vals], "age int")
    out = PR.bin_column(df, "age", [16, 29, 39, 49, 59, 100], [1, 2, 3, 4, 5], "age_bins")
    got = {r["age"]: r["age_bins"] for r in out.collect()}
    assert got == {16: None, 17: 1, 29: 1, 30: 2, 39: 2, 49: 3, 59: 4, 60: 5, 100: 5, 101: None}


def test_one_hot_order_and_nulls(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, "a", None), (3, "b", "y")], "id int, c string, d string")
    out = PR.one_hot(df, ["c", "d"], drop=["d_y"])
    assert out.columns == ["id", "c_a", "c_b", "d_x"]
    got = {r["id"]: (r["c_a"], r["c_b"], r["d_x"]) for r in out.collect()}
    assert got == {1: (0, 1, 1), 2: (1, 0, 0), 3: (0, 1, 0)}


def test_clean_keeps_trimmed_twins(spark):
    df = spark.createDataFrame([(" a", "?"), ("a ", "x"), ("a ", "x"), (None, "x")], "s string, w string")
    out = PR.clean(df, sentinel_cols=["w"])
    assert sorted((r["s"], r["w"]) for r in out.collect()) == [("a", "Unknown"), ("a", "x")]
    out = PR.clean(df.filter("w = 'x'"), trim_first=True)
    assert out.count() == 1


def test_best_run(spark):
    runs = spark.createDataFrame([("r1", 0.8, 0.7), ("r2", 0.8, 0.9), ("r3", 0.7, 0.99)], "run_id string, auc double, accuracy double")
    assert one(EV.best_run(runs))["run_id"] == "r2"
    tie = spark.createDataFrame([("r2", 0.8, 0.9), ("r1", 0.8, 0.9)], "run_id string, auc double, accuracy double")
    assert one(EV.best_run(tie))["run_id"] == "r1"


def test_hard_label_auc(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 0)] * 4 + [(0, 1)] * 2
    df = spark.createDataFrame(rows, "y int, yhat int")
    tpr, tnr = 3 / 4, 4 / 6
    assert one(EV.auc(df, "y", "yhat"))["auc"] == pytest.approx(round((tpr + tnr) / 2, 6))
    m = one(EV.hard_label_metrics(df, "y", "yhat"))
    assert m["auc"] == pytest.approx(round((tpr + tnr) / 2, 6))


def test_auc_matches_pairwise_definition(spark):
    import random

    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 30))) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    exact = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert one(EV.auc(df, "y", "s", n_buckets=8))["auc"] == pytest.approx(exact, abs=1e-6)


def test_stratified_split_counts(spark):
    rows = [(i, i % 3 == 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, label boolean")
    out = EV.stratified_split(df, "label", "k", 0.2, seed=1)
    got = {(r["label"], r["split"]): r["n"] for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    n_true = sum(1 for _, lab in rows if lab)
    import math

    assert got[(True, "test")] == math.ceil(n_true * 0.2)
    assert got[(False, "test")] == math.ceil((1000 - n_true) * 0.2)
    again = EV.stratified_split(df, "label", "k", 0.2, seed=1).filter("split = 'test'")
    assert sorted(r["k"] for r in again.collect()) == sorted(r["k"] for r in out.filter("split = 'test'").collect())


def test_resolve_schema(spark):
    reg = RG.load_registry({"t": {"properties": {
        "ID": {"type": "int", "description": "source_order=1"},
        "NAME": {"type": "varchar(10)", "description": "source_order=2", "default_source": "src=Full_Name"},
        "TIER": {"type": "varchar(5)", "description": "source_order=3", "default": "gold"},
        "SCORE": {"type": "float", "description": "source_order=4"},
        "FLAG": {"type": "bool", "description": "source_order=5"},
        "OTHER": {"type": "variant", "description": "source_order=6"},
    }}}, "t")
    df = spark.createDataFrame([(7, "Ann", "junk")], "Id int, full_name string, extra string")
    out = RG.resolve_schema(df, reg)
    assert out.columns == ["id", "name", "tier", "score", "flag", "other"]
    assert tuple(one(out)) == (7, "Ann", "gold", None, False, "")
    with pytest.raises(ValueError):
        RG.resolve_schema(spark.createDataFrame([(1,)], "zzz int"), reg)


def test_jagged_csv(spark, write_text):
    path = write_text("j/a.csv", "1,a,2.5\n2,b\n3,c,1.0,extra\n4,\"x,y\",3.0\n")
    checked = load_csv_checked(spark, path, "id int, s string, v double", allow_jagged=True)
    got = {r["id"]: (r["_short"], r["_too_many"], r["_error"]) for r in checked.collect()}
    assert got[1] == (False, False, False)
    assert got[2] == (True, False, False)
    assert got[3] == (False, True, True)
    assert got[4] == (False, False, False)
    strict = load_csv_checked(spark, path, "id int, s string, v double", allow_jagged=False)
    assert {r["id"] for r in strict.filter("_error").collect()} == {2, 3}
    assert sorted(r["id"] for r in clean_rows(checked).collect()) == [1, 2, 4]


def test_skewed_key_publish(spark):
    """A key holding a third of the staged rows: every row of it stays (no cap, no sampling)."""
    hot = [(0, i) for i in range(300)]
    cold = [(i, i) for i in range(1, 601)]
    staged = spark.createDataFrame(hot + cold, "k int, v int")
    dest = spark.createDataFrame([(k,) for k in range(500, 700)], "k int")
    new = P.publish_new(staged, dest.withColumn("v", F.lit(0)), ["k"])
    assert new.filter("k = 0").count() == 300
    assert new.count() == 300 + 499


def test_ground_truth_hot_key(spark):
    """One key holds a third of the rows: every actual row of it is compared, missing keys fail."""
    rows = [(1, "a")] * 300 + [(i, "b") for i in range(2, 602)]
    df = spark.createDataFrame(rows, "id int, v string")
    out = C.ground_truth_check(df, {1: {"v": "a"}, 2: {"v": "x"}, 999: {"v": "z"}}, "id")
    got = out.groupBy("id", "found", "passed").count().collect()
    assert {(r["id"], r["found"], r["passed"]): r["count"] for r in got} == {
        (1, True, True): 300, (2, True, False): 1, (999, False, False): 1}


def test_stratified_split_duplicated_hot_key(spark):
    """A key repeated for a third of the rows still gives exact per-label test counts."""
    import math

    rows = [(0, 1, j) for j in range(400)] + [(i, 1, 0) for i in range(1, 801)] + [(i, 0, 0) for i in range(801, 1001)]
    df = spark.createDataFrame(rows, "k int, label int, extra int")
    for frac in (0.2, 0.5, 0.9):
        out = EV.stratified_split(df, "label", "k", frac, seed=3)
        got = {(r["label"], r["split"]): r["n"] for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
        assert got[(1, "test")] == math.ceil(1200 * frac)
        assert got[(0, "test")] == math.ceil(200 * frac)
        assert out.count() == len(rows)


def test_numeric_aggregate_statement_is_truthy(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    got = {r["check_name"]: r["passed"] for r in C.table_checks(df, {"n": "COUNT(*)", "z": "SUM(x) - 3"}).collect()}
    assert got == {"n": True, "z": False}


def test_gate_tiers_many_warnings(spark):
    """One hard failure among 150,000 failed warnings still raises."""
    from pyspark.sql import functions as F

    from dqforge.operators import checks as C, expectations as E
    from dqforge.results import RESULT_COLUMNS, RESULT_DDL

    one = spark.createDataFrame([tuple([None] * len(RESULT_COLUMNS))], RESULT_DDL).withColumn("passed", F.lit(False))
    many = spark.range(150_000).select("id").join(one).withColumn("tier", F.when(F.col("id") == 149_999, "failure").otherwise("warning"))
    with pytest.raises(C.CheckFailed), pytest.warns(UserWarning):
        E.gate_tiers(many.drop("id"))
