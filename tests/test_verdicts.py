"""Verdicts at the edges: many verdicts, none, NULLs, text dates, booleans, jagged rows, first publishes."""

import pytest
from pyspark.sql import functions as F

from dqforge.operators import checks as C, evaluate as EV, expectations as E, integrity as I, publish as P
from dqforge.plans import pipelines as PL
from dqforge.results import RESULT_DDL
from dqforge.sources.files import load_csv_checked


def _verdicts(spark, n, failed):
    """``n`` verdicts; the ones of ``failed`` (a condition on id) failed."""
    cols = [c.split()[0] for c in RESULT_DDL.replace("`", "").split(", ")]
    types = dict(c.replace("`", "").split()[:2] for c in RESULT_DDL.split(", "))
    known = {"check_name": F.concat(F.lit("c"), F.col("id")), "passed": ~F.expr(failed)}
    return spark.range(n).select("id", *[known.get(c, F.lit(None).cast(types[c])).alias(c) for c in cols])


def test_gate_counts_any_number_of_verdicts(spark):
    assert C.gate(_verdicts(spark, 150_000, "false"))
    with pytest.raises(C.CheckFailed) as e:
        C.gate(_verdicts(spark, 150_000, "id = 149999"))
    assert e.value.n_failed == 1 and e.value.failed_rows[0]["check_name"] == "c149999"


def test_gate_tiers_keeps_the_hard_failure(spark):
    res = _verdicts(spark, 150_000, "true").withColumn("tier", F.expr("if(id = 149999, 'failure', 'warning')"))
    with pytest.warns(UserWarning, match="149999 check"), pytest.raises(C.CheckFailed) as e:
        E.gate_tiers(res)
    assert e.value.n_failed == 1


def test_gate_without_verdicts_or_with_a_null_verdict(spark):
    with pytest.raises(C.CheckFailed, match="nothing was checked"):
        C.gate(_verdicts(spark, 0, "false"))
    with pytest.raises(C.CheckFailed):
        C.gate(_verdicts(spark, 3, "if(id = 1, cast(null as boolean), false)"))


def test_equality_sees_shifted_nulls_and_separators(spark):
    ddl = "k int, a string, b string"
    for one, two in [(("a", None), (None, "a")), (("a|b", "c"), ("a", "b|c")), (("N", None), (None, "N")), (("", None), (None, ""))]:
        x, y = (spark.createDataFrame([(1, *r)], ddl) for r in (one, two))
        assert not I.compare_fingerprints(x, y, ["k", "a", "b"]).first()["passed"]
        assert I.diff_tables(x, y, ["k"], ["a", "b"]).count() == 2
        assert I.diff_tables(x, y, ["k"], ["a", "b"], prefilter_buckets=64).count() == 2


def test_multipart_etags(spark, tmp_path):
    import hashlib

    data = bytes(range(256)) * 10
    (tmp_path / "big.bin").write_bytes(data)
    parts = [hashlib.md5(data[i:i + 1000]).digest() for i in range(0, len(data), 1000)]
    etag = f'"{hashlib.md5(b"".join(parts)).hexdigest()}-{len(parts)}"'
    manifest = spark.createDataFrame([("big.bin", etag)], "file_name string, md5 string")
    status = lambda **k: I.verify_manifest(I.file_checksums(spark, str(tmp_path), **k), manifest).first()["status"]
    assert (status(part_bytes=1000), status(part_bytes=999), status()) == ("ok", "mismatch", "unverified")


def test_publish_first_run_defaults_null_keys_and_unreadable_destination(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "k int, v string")
    dest = str(tmp_path / "dest")
    assert P.publish(df, dest, ["k"], defaults={"v": "d"}) == 3
    assert P.publish(df, dest, ["k"], defaults={"v": "d"}) == 2  # NULL keys match nothing
    assert {r["v"] for r in spark.read.parquet(dest).collect()} == {"d", "x"}
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception):
        P.publish(df, str(broken), ["k"])
    assert [p.name for p in broken.iterdir()] == ["part-0.parquet"]


def test_text_dates_and_boolean_pass_values(spark):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-08", 1), ("2024-01-08 10:00:00", 1)], "ds string, v int")
    assert C.interval_check(df, {"MAX(v)": 1.0}, "2024-01-08").first()["passed"]
    assert C.on_dates(df, "ds", ["2024-01-08"]).count() == 2
    assert C.value_check(df, "MIN(v) > 0", True).first()["passed"]
    assert not C.value_check(df, "MIN(v) > 0", False).first()["passed"]


def test_row_rules_warn_of_constant_rules(spark):
    with pytest.warns(UserWarning, match="constant"):
        C.row_rules(spark.createDataFrame([(1,)], "id int"), {"trap": "'id' IS NOT NULL"}).collect()


def test_flags_do_not_depend_on_the_columns_kept(spark, tmp_path):
    (tmp_path / "f.csv").write_text('1,a,x\n2,b\n3,"c,c",z,extra\n4,d,w\n')
    checked = load_csv_checked(spark, str(tmp_path / "f.csv"), "id int, s string, t string")
    for cols in (["id", "_short", "_too_many"], ["_short", "_too_many"], checked.columns):
        got = checked.select(*cols).agg(F.count_if("_short").alias("s"), F.count_if("_too_many").alias("m")).first()
        assert tuple(got) == (1, 1)
    assert sorted(r[0] for r in checked.select("_n_fields").collect()) == [2, 3, 3, 4]


def test_required_column_fails_the_load(spark, tmp_path):
    (tmp_path / "r.csv").write_text("1,a\n,b\n")
    suite = {"expectation_suite_name": "s", "expectations": []}
    with pytest.raises(C.CheckFailed):
        PL.load_and_validate(spark, str(tmp_path / "r.csv"), "id int, s string", suite, target=str(tmp_path / "t"), required=["id"])
    assert not (tmp_path / "t").exists()


def test_ground_truth_as_a_frame_and_with_bad_keys(spark):
    df = spark.createDataFrame([(1, 2.5), (2, 3.0)], "id int, v double")
    truth = spark.createDataFrame([("1", "2.5"), ("2", "9"), ("3", "1")], "id string, v string")
    got = {r["id"]: (r["found"], r["passed"]) for r in C.ground_truth_check(df, truth, "id").collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (False, False)}
    got = C.ground_truth_check(df, {"1": {"v": "2.5"}, "x": {"v": "1"}}, "id").collect()
    assert sorted((r["id"] is None, r["passed"]) for r in got) == [(False, True), (True, False)]


def test_null_scores_and_labels(spark):
    rows = [(1, 0.9), (0, 0.1), (0, None), (None, 0.5), (1, 0.4)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = {r["threshold"]: (r["tpr"], r["fpr"]) for r in EV.roc_points(df, "y", "s").collect()}
    assert got == {0.9: (0.5, 0.0), 0.4: (1.0, 0.0), 0.1: (1.0, 1.0)}
    df = spark.createDataFrame([(i if i % 7 else None, i % 3 or None) for i in range(200)], "k int, y int")
    split = EV.stratified_split(df, "y", "k", 0.25)
    got = {r["y"]: (r["n"], r["t"]) for r in split.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect()}
    assert got == {None: (67, 17), 1: (67, 17), 2: (66, 17)}


def test_every_unexpected_value_is_listed(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    assert E.unexpected_values(df, "c", ["0"]).count() == 49
    assert E.unexpected_values(df, "c", ["0"], limit=5).count() == 5
