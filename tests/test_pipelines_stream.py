"""Pipelines L1-L9 on small inputs, streaming validation, and table lifecycle helpers."""

import warnings

import pytest
from pyspark.sql import functions as F

from dqforge.operators import expectations as E
from dqforge.operators import integrity as I
from dqforge.operators import registry as RG
from dqforge.plans import pipelines as PL
from dqforge.sources import batches as B
from dqforge.sources import tables as TB
from dqforge.sources.files import read_csv
from dqforge.streaming.validate_stream import file_stream, validate_stream
from fixtures_data import (COL_CHECKS, COSTS, COST_SCHEMA, FIRE_MD5, FIRE_SCHEMA, FIRES_GOOD, FIRES_INVALID,
                           GROUND_TRUTH, TABLE_CHECKS)


def test_l1_write_audit_publish_with_registry(spark, tmp_path, write_text):
    fires = read_csv(spark, write_text("f/f.csv", FIRES_GOOD), FIRE_SCHEMA)
    reg = RG.load_registry({"fire": {"properties": {
        "ID": {"type": "int", "description": "source_order=1"},
        "MONTH": {"type": "varchar(25)", "description": "source_order=2"},
        "FFMC": {"type": "float", "description": "source_order=3"},
        "DMC": {"type": "float", "description": "source_order=4"},
        "DC": {"type": "float", "description": "source_order=5"},
        "AREA": {"type": "float", "description": "source_order=6"},
        "SOURCE": {"type": "varchar(10)", "description": "source_order=7", "default": "csv"},
    }}}, "fire")
    dest = str(tmp_path / "prod")
    r = PL.write_audit_publish(fires, dest, ["id"], column=COL_CHECKS, table=TABLE_CHECKS, registry=reg)
    assert r.passed and r.details["published"] == 9
    out = spark.read.parquet(dest)
    assert out.columns == ["id", "month", "ffmc", "dmc", "dc", "area", "source"] and out.filter("source = 'csv'").count() == 9
    r2 = PL.mapped_write_audit_publish(RG.resolve_schema(fires, reg), dest, ["id"], {"column": COL_CHECKS})
    assert r2.details["published"] == 0


def test_l3_suite_composite(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k1 int, k2 int, v string")
    dest = str(tmp_path / "d")
    df.limit(1).write.parquet(dest)
    suite = {"expectations": [{"expectation_type": E.NOT_NULL, "kwargs": {"column": "v"}}]}
    r = PL.suite_write_audit_publish(df, dest, ["k1", "k2"], suite)
    assert r.passed and r.details["published"] == 2


def test_l4_multi_table(spark, write_text):
    fires = read_csv(spark, write_text("f/f.csv", FIRES_GOOD), FIRE_SCHEMA).select("id", "month", "day", "area")
    costs = read_csv(spark, write_text("c/c.csv", COSTS), COST_SCHEMA)
    costs = costs.withColumn("total_cost", F.col("land_damage_cost") + F.col("property_damage_cost")
                             + F.col("lost_profits_cost"))
    r = PL.multi_table_transform(
        costs, fires, "id",
        {"table": {"rows": "COUNT(*) = 9"}},
        {"column": {"id": {"null_check": {"equal_to": 0}}}},
        {"table": {"parts": "land_damage_cost + property_damage_cost + lost_profits_cost = total_cost"}},
        "total_cost", ("total_cost", "area"), "cost_per_area")
    assert r.passed
    got = {row["id"]: row["cost_per_area"] for row in r.output.collect()}
    assert got[1] == 1920.0 and got[4] == pytest.approx(193.07692307692307)


def test_l5_dated_files(spark, write_text):
    header = "id,fare,total\n"
    p1 = write_text("d1/a.csv", header + "1,10.0,10.0\n2,5.0,5.1\n")
    p2 = write_text("d2/b.csv", header + "3,7.0,7.0\n4,8.0,8.0\n")
    r = PL.dated_files_checks(spark, {"b": p2, "a": p1}, "id int, fare double, total double", "2024-01-02",
                              {"fare_check": "ROUND(fare, 1) = ROUND(total, 1)"}, value=("COUNT(*)", 4),
                              interval={"COUNT(*)": 1.0}, threshold=("MAX(total)", 0, 100))
    v = {x["suite"]: x["passed"] for x in r.results.collect()}
    assert v == {"rows": False, "value": True, "interval": True, "threshold": True}


def test_l6_integrity_ground_truth(spark, write_text):
    path = write_text("g/forestfires.csv", FIRES_GOOD)
    manifest = spark.createDataFrame([("forestfires.csv", f'"{FIRE_MD5["good"]}"')], "file_name string, md5 string")
    r = PL.load_with_integrity(spark, path, manifest, FIRE_SCHEMA, {int(k): v for k, v in GROUND_TRUTH.items()}, "id",
                               "forestfires")
    assert r.details["checksums"].collect()[0]["status"] == "ok"
    assert not r.passed  # ground truth expects area 0; the file has 100 and 57.8
    bad = spark.createDataFrame([("forestfires.csv", FIRE_MD5["invalid"])], "file_name string, md5 string")
    st = I.verify_manifest(I.file_checksums(spark, path), bad).collect()[0]["status"]
    assert st == "mismatch"


def test_l7_load_validate(spark, write_text, tmp_path):
    path = write_text("l7/f.csv", FIRES_INVALID)
    suite = {"expectations": [
        {"expectation_type": E.ROW_COUNT_BETWEEN, "kwargs": {"min_value": 9, "max_value": 9}},
        {"expectation_type": E.VALUES_BETWEEN, "kwargs": {"column": "dmc", "min_value": 0, "max_value": 1000}},
    ]}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        r = PL.load_and_validate(spark, path, FIRE_SCHEMA, suite, target=str(tmp_path / "t"), required=["id"])
    assert not r.passed
    v = {x["metric"]: (x["passed"], x["n_failed"]) for x in r.results.collect()}
    assert v["row_count"] == (True, None) and v["between"] == (False, 1)


def test_l8_features_and_models(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(240):
        status = rnd.choice(["Never-married", "Married", "Divorced"])
        age = rnd.randint(17, 90) if status != "Never-married" else rnd.randint(17, 35)
        rows.append((i, age, rnd.choice(["Private", "?", "State-gov"]), rnd.choice(["Male", "Female"]), status,
                     rnd.randint(20, 60), 0))
    raw = spark.createDataFrame(rows, "id int, age int, workclass string, sex string, marital_status string, "
                                      "hours_per_week int, junk int")
    pre = {"expectations": [{"expectation_type": E.NOT_NULL, "kwargs": {"column": "age"}},
                            {"expectation_type": E.IN_SET, "kwargs": {"column": "sex", "value_set": ["Male", "Female"]}}]}
    feat = {"expectations": [{"expectation_type": E.IN_SET, "kwargs": {"column": "sex_Male", "value_set": [0, 1]}},
                             {"expectation_type": E.OF_TYPE, "kwargs": {"column": "sex_Male", "type_": "int"}}]}
    r = PL.feature_pipeline(raw, pre, feat, ["workclass"], ["junk"], ["workclass", "sex"],
                            ("age", [16, 29, 39, 49, 59, 100], [1, 2, 3, 4, 5], "age_bins"),
                            ("marital_status", "Never-married", "never_married"), ["marital_status", "age"])
    assert r.passed
    assert "workclass_Unknown" in r.output.columns and "never_married" in r.output.columns
    fcols = [c for c in r.output.columns if c not in ("id", "never_married")]
    feats = r.output.withColumn("age_bins", F.coalesce(F.col("age_bins"), F.lit(0)).cast("double"))
    t = PL.train_and_select(feats, fcols, "never_married", "id",
                            {"log_reg": {"regParam": [0.01], "elasticNetParam": [0.0]},
                             "gbt": {"maxIter": [5], "maxDepth": [2]}}, folds=2)
    assert t.details["best"]["run_id"] in ("log_reg", "gbt")
    assert t.details["model"] is not None


def test_l9_simple(spark):
    rows = [(1, 2.0), (2, 3.0)]
    r = PL.simple_load_checks(spark, rows, "id int, v double", column={"id": {"null_check": {"equal_to": 0}}},
                              table={"pos": "v > 0"}, value=("SUM(v)", 5),
                              first_row_sql="SELECT COUNT(*) AS n, MIN(v) > 0 AS ok FROM {table}")
    assert r.passed


def test_streaming_validation(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    (src / "a.csv").write_text("1,5\n2,7\n")
    (src / "b.csv").write_text("3,-1\n")
    out = str(tmp_path / "results")
    stream = file_stream(spark, str(src), "id int, v int")
    q = validate_stream(stream, out, table={"positive": "v > 0"}, checkpoint_location=str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = {r["_file"]: r["passed"] for r in spark.read.parquet(out).collect()}
    assert got == {"a.csv": True, "b.csv": False}
    (src / "c.csv").write_text("4,1\n")
    q = validate_stream(file_stream(spark, str(src), "id int, v int"), out, table={"positive": "v > 0"},
                        checkpoint_location=str(tmp_path / "ck"))
    q.awaitTermination(120)
    files = [r["_file"] for r in spark.read.parquet(out).collect()]
    assert sorted(files) == ["a.csv", "b.csv", "c.csv"]  # restart validated only the new file


def test_table_lifecycle_and_batches(spark, tmp_path):
    TB.create_db(spark, "dq_test_db")
    TB.create_table(spark, "dq_test_db.t", "id int, v string", location=str(tmp_path / "t"))
    assert TB.table_exists(spark, "dq_test_db.t")
    TB.run_sql(spark, ["INSERT INTO dq_test_db.t VALUES (1, 'a'), (2, 'b')", "SELECT 1"])
    b = B.Batch.from_table(spark, "dq_test_db.t")
    assert b.df.count() == 2 and b.limit(1).df.count() == 1
    q = B.Batch.from_sql(spark, "SELECT * FROM dq_test_db.t WHERE id = :k", args={"k": 2})
    assert q.df.collect()[0]["v"] == "b"
    TB.create_table(spark, "dq_test_db.t", "id int", replace=True, location=str(tmp_path / "t2"))
    assert spark.table("dq_test_db.t").columns == ["id"]
    TB.drop_table(spark, "dq_test_db.t")
    assert not TB.table_exists(spark, "dq_test_db.t")
    TB.drop_db(spark, "dq_test_db")
    res = spark.createDataFrame([("s", "c", True)], "suite string, check_name string, passed boolean")
    TB.store_results(res, str(tmp_path / "store"), run_id="r1")
    TB.store_results(res, str(tmp_path / "store"), run_id="r2")
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2
    m = TB.materialize(res, str(tmp_path / "m"))
    assert m.count() == 1


def test_list_batches_and_checkpoint(spark, tmp_path):
    d = tmp_path / "trips"
    d.mkdir()
    (d / "yellow_tripdata_sample_2019-01.csv").write_text("1,3\n2,4\n")
    (d / "yellow_tripdata_sample_2019-02.csv").write_text("1,9\n")
    (d / "other.csv").write_text("7,7\n")
    df = B.list_batches(spark, str(d), r"(yellow_tripdata_sample)_(\d{4}-\d{2})\.csv", ["asset", "month"],
                        schema="vendor_id int, passengers int")
    assert sorted(r["month"] for r in df.select("month").distinct().collect()) == ["2019-01", "2019-02"]
    latest = B.latest_batch(df, "month")
    assert latest.count() == 1
    suite = {"expectation_suite_name": "s", "expectations": [
        {"expectation_type": E.VALUES_BETWEEN, "kwargs": {"column": "passengers", "min_value": 1, "max_value": 6}},
        {"expectation_type": E.COLUMNS_MATCH, "kwargs": {"column_list": ["vendor_id", "passengers"]}}]}
    res = E.run_checkpoint(df, suite, ["month"])
    got = {(r["month"], r["check_name"]): r["passed"] for r in res.collect()}
    assert got[("2019-01", E.VALUES_BETWEEN)] and not got[("2019-02", E.VALUES_BETWEEN)]
    assert got[("2019-01", E.COLUMNS_MATCH)]  # batch columns aren't part of the data's schema
    ck = E.Checkpoint("c", E.load_suite(suite), [B.Batch.from_df(df.filter("month = '2019-01'"), "jan")],
                      store_path=str(tmp_path / "store"))
    assert ck.run().count() == 2 and spark.read.parquet(str(tmp_path / "store")).count() == 2
    empty = E.validate(df, {"expectations": []}).collect()
    assert len(empty) == 1 and empty[0]["passed"]
