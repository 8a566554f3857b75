"""Publishing as one commit, checks that ride along with a write, and mergeable check state."""

import uuid

import pytest
from pyspark.sql import functions as F

from dqforge.operators import checks as C
from dqforge.operators import commit as K
from dqforge.operators.audit import audited_write
from dqforge.operators.state import SKETCH_ERROR, CheckState, record_state, recorded, update_verdicts

COLUMNS = {"id": {"null_check": {"equal_to": 1}, "distinct_check": {"geq_to": 100}, "unique_check": {"equal_to": 0}},
           "v": {"min": {"geq_to": 0}, "max": {"less_than": 10, "tolerance": 0.5}}}
RULES = {"rows": "COUNT(*) = 201", "distinct_rule": "COUNT(DISTINCT v) = 20", "row_rule": "v < 15", "id_or_v": "id IS NOT NULL OR v >= 0"}


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(200).select("id", (F.col("id") % 20).cast("double").alias("v")).unionByName(spark.createDataFrame([(None, 3.0)], "id long, v double"))


@pytest.fixture
def table(spark):
    name = f"runs_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_runs_are_whole_and_repeatable(spark, table, tmp_path):
    one = spark.createDataFrame([(1, "a"), (2, None), (None, "n"), (2, "again")], "k int, v string")
    two = spark.createDataFrame([(2, "late"), (3, "c"), (None, "m")], "k int, v string")
    where = str(tmp_path / "root")
    assert K.publish_run(one, table, ["k"], "r 1='x'", defaults={"v": "d"}, location=where) == 4
    assert K.publish_run(two, table, ["k"], "r2") == 2
    want = [(1, "a", "r 1='x'"), (2, "again", "r 1='x'"), (2, "d", "r 1='x'"), (3, "c", "r2"), (None, "m", "r2"), (None, "n", "r 1='x'")]
    assert _rows(spark.table(table)) == sorted(want, key=str)
    # each run again: nothing is added, rows with NULL keys included
    assert K.publish_run(one, table, ["k"], "r 1='x'", defaults={"v": "d"}) == 4 and K.publish_run(two, table, ["k"], "r2") == 2
    assert _rows(spark.table(table)) == sorted(want, key=str)
    # a run again with less: its rows are replaced
    assert K.publish_run(two.where("k = 3"), table, ["k"], "r2") == 1
    assert spark.table(table).where("run_id = 'r2'").count() == 1 and K.published_runs(spark, table) == {"r 1='x'", "r2"}
    with pytest.raises(ValueError):
        K.publish_run(two, table, ["k"], "")


def test_a_run_that_dies_before_the_commit_changes_nothing(spark, table, monkeypatch):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    more = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    K.publish_run(one, table, ["k"], "r1")

    def dies(*a):
        raise RuntimeError("killed")

    monkeypatch.setattr(K, "_swap", dies)
    for run in ("r1", "r2"):
        with pytest.raises(RuntimeError):
            K.publish_run(more, table, ["k"], run)
        assert _rows(spark.table(table)) == [(1, "a", "r1")]
    monkeypatch.undo()
    assert K.publish_run(more, table, ["k"], "r2") == 1 and spark.table(table).count() == 2


def test_audited_write_gives_the_verdicts_of_run_checks(spark, frame, tmp_path):
    for column, rules in ((COLUMNS, RULES), (COLUMNS, None), (None, {"rows": "COUNT(*) = 201"})):
        path = str(tmp_path / uuid.uuid4().hex)
        written, results = audited_write(frame, path, column=column, table=rules, suite="s")
        assert _rows(results) == _rows(C.run_checks(frame, column=column, table=rules, suite="s"))
        assert _rows(written) == _rows(frame)
    approx = audited_write(frame, str(tmp_path / "a"), column={"v": {"distinct_check": {"equal_to": 20}}}, approx_distinct=True)[1].collect()
    assert approx[0]["passed"]
    with pytest.raises(ValueError):
        audited_write(frame, str(tmp_path / "b"))


def test_the_audit_scans_the_rows_once(spark, frame, tmp_path):
    sc, scans = spark.sparkContext, spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    sc.setJobGroup("audit-scan", "one pass")
    try:
        checks = {"v": {"min": {"geq_to": 0}, "max": {"less_than": 100}}, "id": {"null_check": {"leq_to": 1}}}
        _, results = audited_write(frame.mapInArrow(counted, frame.schema), str(tmp_path / "once"), column=checks, table={"rows": "COUNT(*) = 201", "row_rule": "v < 25"})
        assert C.gate(results)
        assert scans.value == 201
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_write_audit_commit(spark, frame, table):
    ok = K.write_audit_commit(frame, table, ["id"], "day-1", column={"v": {"min": {"geq_to": 0}}}, rules={"rows": "COUNT(*) = 201"})
    assert ok.passed and ok.published == 201
    with pytest.warns(UserWarning):
        bad = K.write_audit_commit(frame.withColumn("id", F.col("id") + 1000), table, ["id"], "day-2", column={"v": {"max": {"less_than": 1}}}, on_fail="warn")
    assert not bad.passed and bad.published == 0 and spark.table(table).count() == 201
    assert K.write_audit_commit(frame, table, ["id"], "day-1", column={"v": {"min": {"geq_to": 0}}}).published == 201 and spark.table(table).count() == 201


def test_state_of_batches_equals_one_scan(spark, frame, tmp_path):
    checks = CheckState(COLUMNS, {"row_rule": "v < 15", "fine": "v >= 0"})
    store = str(tmp_path / "state")
    assert recorded(spark, store) is None
    batches = frame.withColumn("b", F.coalesce(F.col("id") % 4, F.lit(9)))
    for i in (0, 1, 2, 3, 9):
        last = update_verdicts(checks, batches.where(F.col("b") == i), store, ["b"], suite="s")
    cols = ["check_name", "comparator", "expected", "n_rows", "n_failed", "passed", "observed"]
    whole = {r["check_name"]: tuple(r) for r in C.run_checks(frame, column=COLUMNS, table={"row_rule": "v < 15", "fine": "v >= 0"}, suite="s").select(*cols).collect()}
    got = {r["check_name"]: tuple(r) for r in last.select(*cols).collect()}
    assert set(got) == set(whole)
    for name, row in got.items():
        if "distinct" in name or "unique" in name:
            assert row[:5] == whole[name][:5] and abs(row[6] - whole[name][6]) <= 5 * SKETCH_ERROR * 201
        else:
            assert row == whole[name]
    # a batch again replaces its own state
    record_state(checks.of(batches.where("b = 2"), ["b"]), store, ["b"])
    assert checks.merged(recorded(spark, store)).first()["n_rows"] == 201
    assert {r["b"]: r["n_rows"] for r in checks.of(batches, ["b"]).select("b", "n_rows").collect()} == {0: 50, 1: 50, 2: 50, 3: 50, 9: 1}
    by = checks.verdicts(checks.of(batches, ["b"]), by=["b"])
    assert by.where("check_name = 'id_null_check' AND passed").select("b").collect()[0][0] == 9
    with pytest.raises(ValueError):
        CheckState({"v": {"mode": {"equal_to": 1}}})
