"""Unit tests for helpers without a driver query of their own."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dqforge.functions.running import running_sums
from dqforge.operators import checks as C
from dqforge.operators import evaluate as EV
from dqforge.operators import expectations as E
from dqforge.operators import integrity as I
from dqforge.operators import registry as RG
from dqforge.sources.files import Stage


def test_running_sums_match_brute_force(spark):
    rnd = random.Random(11)
    vals = sorted({rnd.uniform(-100, 100) for _ in range(500)})
    rows = [(v, rnd.randint(0, 5)) for v in vals]
    df = spark.createDataFrame(rows, "x double, w int")
    for desc in (False, True):
        out = {r["x"]: r["cum_w"] for r in running_sums(df, "x", ["w"], descending=desc, n_buckets=7).collect()}
        order = sorted(rows, reverse=desc)
        acc = 0
        for x, w in order:
            acc += w
            assert out[x] == acc


def test_roc_points_brute_force(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 20))) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    P = sum(y for y, _ in rows)
    N = len(rows) - P
    got = {r["threshold"]: (r["tpr"], r["fpr"]) for r in EV.roc_points(df, "y", "s", n_buckets=5).collect()}
    for t in {s for _, s in rows}:
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        assert got[t] == (round(tp / P, 6), round(fp / N, 6))


def test_classification_report_values(spark):
    rows = [(1, 1)] * 5 + [(1, 0)] * 3 + [(0, 0)] * 6 + [(0, 1)] * 2
    df = spark.createDataFrame(rows, "y int, p int")
    rep = {r["class"]: r for r in EV.classification_report(df, "y", "p").collect()}
    p1, r1 = 5 / 7, 5 / 8
    p0, r0 = 6 / 9, 6 / 8
    f1 = 2 * p1 * r1 / (p1 + r1)
    f0 = 2 * p0 * r0 / (p0 + r0)
    assert rep["1"]["precision"] == round(p1, 6) and rep["1"]["recall"] == round(r1, 6)
    assert rep["0"]["f1_score"] == round(f0, 6) and rep["1"]["support"] == 8
    assert rep["accuracy"]["f1_score"] == round(11 / 16, 6)
    assert rep["macro avg"]["f1_score"] == round((f0 + f1) / 2, 6)
    assert rep["weighted avg"]["recall"] == round((r0 * 8 + r1 * 8) / 16, 6)
    conf = EV.confusion(df, "y", "p").collect()[0].asDict()
    assert conf == {"tp": 5, "fp": 2, "tn": 6, "fn": 3}


def test_penalty_c_grid_mapping():
    g = EV.penalty_c_grid(["l1", "l2"], [0.1, 1.0], n_train=100)
    assert g["elasticNetParam"] == [0.0, 1.0]
    assert g["regParam"] == sorted([1 / (0.1 * 100), 1 / (1.0 * 100)])


def test_stage_and_suite_files(spark, tmp_path, write_text):
    path = write_text("stage/a.csv", "h1;h2\n1;x\n2;y\n")
    df = Stage(str(tmp_path / "stage"), "csv", {"header": "true", "sep": ";"}).read(spark, "h1 int, h2 string")
    assert sorted(r["h1"] for r in df.collect()) == [1, 2] and path
    body = {"expectation_suite_name": "same.name", "expectations": [
        {"expectation_type": E.ROW_COUNT_BETWEEN, "kwargs": {"min_value": 1, "max_value": 1}}]}
    a = tmp_path / "suites" / "pass.json"
    b = tmp_path / "suites" / "fail.json"
    a.parent.mkdir()
    a.write_text(json.dumps({**body, "expectations": [{"expectation_type": E.ROW_COUNT_BETWEEN,
                                                        "kwargs": {"min_value": 1, "max_value": 5}}]}))
    b.write_text(json.dumps(body))
    sa, sb = E.load_suite(a), E.load_suite(b)
    assert sa.name != sb.name  # two files sharing one inner name are keyed by path
    assert E.validate(df, sa).collect()[0]["passed"]
    assert not E.validate(df, sb).collect()[0]["passed"]
    empty = tmp_path / "suites" / "empty.json"
    empty.write_text(json.dumps({"expectation_suite_name": "t", "expectations": []}))
    assert E.validate(df, E.load_suite(empty)).collect()[0]["passed"]


def test_registry_helpers(tmp_path):
    reg_json = {"title": "x", "definitions": {"fire": {"properties": {
        "ID": {"type": "int", "description": "source_order=1"},
        "MONTH": {"type": "varchar(25)", "description": "source_order=3"},
        "NOTE": {"type": "text"},
        "HASH_DIFF": {"type": "varchar(64)", "description": "source_order=2"},
    }, "dimensions": ["id"], "metrics": ["month"], "cluster_keys": {"columns": ["ID"]}}}}
    p = tmp_path / "reg.json"
    p.write_text(json.dumps(reg_json))
    reg = RG.load_registry(str(p), "fire")
    assert RG.registry_columns(reg) == ["id", "hash_diff", "month"]
    sch = RG.registry_schema(reg)
    assert [f.name for f in sch.fields] == ["id", "hash_diff", "month"]
    assert sch["id"].metadata["source_order"] == 1 and reg.cluster_keys == ["ID"]


def test_select_by_position_skips_audit_columns(spark):
    raw = spark.createDataFrame([("1", "abc", "x", "2.5")], "_c0 string, _c1 string, _c2 string, _c3 string")
    reg = RG.load_registry({"t": {"properties": {
        "ID": {"type": "int", "description": "source_order=1"},
        "HASH_DIFF": {"type": "varchar", "description": "source_order=2"},
        "V": {"type": "float", "description": "source_order=4"},
        "INSERT_TIMESTAMP": {"type": "timestamp", "description": "source_order=3"},
    }}}, "t")
    out = RG.select_by_position(raw, reg)
    assert out.columns == ["id", "v"] and tuple(out.collect()[0]) == (1, 2.5)


def test_fingerprints_and_diff_multiset(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    assert I.compare_fingerprints(a, a.orderBy(F.desc("k")), ["k", "v"]).collect()[0]["passed"]
    r = I.compare_fingerprints(a, b, ["k", "v"]).collect()[0]
    assert not r["passed"]
    d = {(x["k"], x["status"]): (x["n_source"], x["n_target"]) for x in I.diff_tables(a, b, ["k"], ["v"]).collect()}
    assert d == {(1, "count_differs"): (2, 1), (3, "missing_in_source"): (0, 1)}


def test_keep_matching_value_set_and_metrics_by_date(spark):
    import datetime as dt

    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 5)), (2, "b", dt.datetime(2024, 1, 2, 5)),
                                (3, "a", dt.datetime(2024, 1, 3, 5))], "k int, c string, ts timestamp_ntz")
    keys = spark.createDataFrame([(1,), (3,)], "k int")
    assert sorted(r["k"] for r in C.keep_matching(df, keys, ["k"], max_keys=2).collect()) == [1, 3]
    assert {r["value"]: r["n"] for r in C.value_set(df, "c").collect()} == {"a": 2, "b": 1}
    m = C.metric_by_date(df, {"n": "COUNT(*)"}, "ts", ["2024-01-01", "2024-01-03"]).collect()
    assert sorted((r["ts"].isoformat(), r["n"]) for r in m) == [("2024-01-01", 1), ("2024-01-03", 1)]
    u = E.unexpected_values(df, "c", ["a"]).collect()
    assert [(r["value"], r["n"]) for r in u] == [("b", 1)]


def test_approx_distinct_and_unique(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(100)], "a int, b int")
    exact = {r["check_name"]: r["observed"] for r in C.column_checks(df, {
        "a": {"distinct_check": {"equal_to": 10}, "unique_check": {"equal_to": 0}},
        "b": {"unique_check": {"equal_to": 0}}}).collect()}
    assert exact == {"a_distinct_check": 10.0, "a_unique_check": 90.0, "b_unique_check": 0.0}
    approx = C.column_checks(df, {"a": {"distinct_check": {"equal_to": 10}}}, approx_distinct=True).collect()[0]
    assert approx["observed"] == pytest.approx(10, abs=1)


def test_partition_clause_and_tolerance(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0)], "k int, v double")
    r = {x["check_name"]: x["passed"] for x in C.column_checks(df, {
        "v": {"null_check": {"equal_to": 0, "partition_clause": "k <> 2"},
              "max": {"equal_to": 7.5, "tolerance": 0.1}}}).collect()}
    assert r == {"v_null_check": True, "v_max": True}


def test_interval_formula_options(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2024, 1, 1), 4.0), (dt.date(2024, 1, 2), 5.0), (dt.date(2024, 1, 3), 0.0)],
                               "ds date, v double")
    r = C.interval_check(df, {"SUM(v)": 0.25}, "2024-01-02", days_back=-1, ratio_formula="relative_diff").collect()[0]
    assert r["observed"] == 0.25 and r["passed"]
    r = C.interval_check(df, {"SUM(v)": 1.5}, "2024-01-03", days_back=-1).collect()[0]
    assert not r["passed"]
    r = C.interval_check(df, {"SUM(v)": 1.5}, "2024-01-03", days_back=-1, ignore_zero=True).collect()[0]
    assert r["passed"]


def test_checkpoint_config_yaml(spark, tmp_path):
    d = tmp_path / "suites" / "taxi"
    d.mkdir(parents=True)
    (d / "demo.json").write_text(json.dumps({"expectation_suite_name": "taxi.demo", "expectations": [
        {"expectation_type": E.ROW_COUNT_BETWEEN, "kwargs": {"min_value": 1, "max_value": 2}},
        {"expectation_type": E.DISTINCT_IN_SET, "kwargs": {"column": "vendor_id", "value_set": [1, 2]}}]}))
    cfg = tmp_path / "chk.yml"
    cfg.write_text("""name: taxi.pass.chk
expectation_suite_name: taxi.demo
action_list:
  - name: store_validation_result
    action:
      class_name: StoreValidationResultAction
validations:
  - batch_request:
      datasource_name: my_datasource
      data_asset_name: trips
      data_connector_query:
        index: -1
""")
    trips = spark.createDataFrame([(1, "2019-01"), (4, "2019-01"), (2, "2019-02"), (1, "2019-02")],
                                  "vendor_id int, month string")
    store = str(tmp_path / "store")
    res = E.run_checkpoint_config(str(cfg), {"trips": trips}, str(tmp_path / "suites"), batch_key="month",
                                  store_path=store)
    got = {r["check_name"]: (r["passed"], r["n_rows"]) for r in res.collect()}
    assert got == {E.ROW_COUNT_BETWEEN: (True, 2), E.DISTINCT_IN_SET: (True, 2)}
    assert spark.read.parquet(store).count() == 2


def test_cli(spark, tmp_path, capsys):
    from dqforge.__main__ import main

    data = str(tmp_path / "t")
    spark.createDataFrame([(1, 5.0), (2, 7.0)], "id int, v double").write.parquet(data)
    cfg = tmp_path / "rules.json"
    cfg.write_text(json.dumps({"column": {"id": {"null_check": {"equal_to": 0}}}, "table": {"pos": "v > 0"}}))
    assert main(["checks", "--table", data, "--config", str(cfg)]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {r["check_name"] for r in out} == {"id_null_check", "pos"}
    suite = tmp_path / "s.json"
    suite.write_text(json.dumps({"expectations": [{"expectation_type": E.ROW_COUNT_BETWEEN,
                                                   "kwargs": {"min_value": 5, "max_value": 9}}]}))
    assert main(["validate", "--table", data, "--suite", str(suite)]) == 1
    assert main(["validate", "--table", data, "--suite", str(suite), "--warn"]) == 0


def test_running_sums_many_ranges(spark):
    rows = [(float(i) * 0.5, i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, w int")
    out = {r["x"]: r["cum_w"] for r in running_sums(df, "x", ["w"], descending=True, n_buckets=700).collect()}
    acc = 0
    for x, w in sorted(rows, reverse=True):
        acc += w
        assert out[x] == acc


def test_failure_details(spark):
    df = spark.createDataFrame([(1, 3), (4, 9), (4, 2), (None, 1), (2, 8)], "vendor int, p int")
    suite = {"expectations": [
        {"expectation_type": E.DISTINCT_IN_SET, "kwargs": {"column": "vendor", "value_set": [1, 2]}},
        {"expectation_type": E.VALUES_BETWEEN, "kwargs": {"column": "p", "min_value": 1, "max_value": 6}},
        {"expectation_type": E.NOT_NULL, "kwargs": {"column": "p"}}]}
    res = E.validate(df, suite)
    det = {(r["check_name"], r["value"]): r["n"] for r in E.failure_details(df, suite, res).collect()}
    assert det == {(E.DISTINCT_IN_SET, "4"): 2, (E.VALUES_BETWEEN, "9"): 1, (E.VALUES_BETWEEN, "8"): 1}


def test_tiers_by_batch_with_schema_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 7), ("b", 2)], "batch string, v int")
    warn = {"expectation_suite_name": "w", "expectations": [
        {"expectation_type": E.VALUES_BETWEEN, "kwargs": {"column": "v", "min_value": 0, "max_value": 5}},
        {"expectation_type": E.OF_TYPE, "kwargs": {"column": "v", "type_": "int"}}]}
    fail = {"expectation_suite_name": "f", "expectations": [
        {"expectation_type": E.ROW_COUNT_BETWEEN, "kwargs": {"min_value": 1, "max_value": 5}}]}
    res = E.validate_tiers(df, {"warning": warn, "failure": fail}, by=["batch"])
    got = {(r["batch"], r["tier"], r["metric"]): r["passed"] for r in res.collect()}
    assert got == {("a", "warning", "between"): False, ("b", "warning", "between"): True,
                   ("a", "warning", "type"): True, ("b", "warning", "type"): True,
                   ("a", "failure", "row_count"): True, ("b", "failure", "row_count"): True}
    with pytest.raises(C.CheckFailed):
        E.gate_tiers(res, fail_tier="warning")


def test_archive_failures_to_table(spark, tmp_path):
    from dqforge.sources.tables import archive_failures

    spark.sql(f"CREATE DATABASE IF NOT EXISTS dq_arch LOCATION '{tmp_path}/db'")
    df = spark.createDataFrame([(1, -5.0), (2, 3.0)], "id int, v double")
    archive_failures(C.failing_rows(df, {"pos": "v > 0"}), "dq_arch.failures", ["id", "v"])
    archive_failures(C.failing_rows(df, {"pos": "v > 0"}), "dq_arch.failures", ["id", "v"])
    assert spark.table("dq_arch.failures").count() == 2
    spark.sql("DROP DATABASE dq_arch CASCADE")


def test_publish_to_bucketed_table(spark, tmp_path):
    import contextlib
    import io

    from dqforge.operators import publish as P

    spark.sql(f"CREATE DATABASE IF NOT EXISTS dq_pub LOCATION '{tmp_path}/db'")
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    first = o.filter("o_orderdate < DATE '1998-01-01'")
    n0 = P.publish_to_table(first, "dq_pub.orders", ["o_orderkey"], buckets=8)
    assert n0 == first.count()
    assert P.table_buckets(spark, "dq_pub.orders") == (8, ["o_orderkey"], ["o_orderkey"])
    staged = o.filter("o_orderdate >= DATE '1997-01-01'")
    expected = P.publish_new(staged, first, ["o_orderkey"]).count()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        P.publish_new(staged, spark.table("dq_pub.orders"), ["o_orderkey"]).explain()
    plan = buf.getvalue()
    assert "Bucketed: true" in plan
    assert P.publish_to_table(staged, "dq_pub.orders", ["o_orderkey"]) == expected
    assert P.publish_to_table(staged, "dq_pub.orders", ["o_orderkey"]) == 0
    assert P.table_buckets(spark, "dq_pub.orders")[0] == 8
    spark.sql("DROP DATABASE dq_pub CASCADE")


def test_checkpoint_batches_fused(spark):
    from dqforge.sources.batches import Batch

    a = spark.createDataFrame([(1,), (2,)], "v int")
    b = spark.createDataFrame([(9,)], "v int")
    suite = E.load_suite({"expectation_suite_name": "s", "expectations": [
        {"expectation_type": E.VALUES_BETWEEN, "kwargs": {"column": "v", "min_value": 0, "max_value": 5}},
        {"expectation_type": E.COLUMNS_MATCH, "kwargs": {"column_list": ["v"]}}]})
    res = E.Checkpoint("c", suite, [Batch.from_df(a, "jan"), Batch.from_df(b, "feb")]).run()
    got = {(r["batch_id"], r["check_name"]): r["passed"] for r in res.collect()}
    assert got == {("jan", E.VALUES_BETWEEN): True, ("feb", E.VALUES_BETWEEN): False,
                   ("jan", E.COLUMNS_MATCH): True, ("feb", E.COLUMNS_MATCH): True}
    assert res.columns[-2:] == ["batch_id", "checkpoint"]
