"""One key / batch / score holding a third of all rows: results stay whole and exact.

Expected values come from DuckDB over the same rows (an independent engine)."""

import duckdb
import pytest
from pyspark.sql import functions as F

from dqforge.operators import checks as C
from dqforge.operators import evaluate as EV
from dqforge.operators import expectations as E
from dqforge.operators import integrity as I
from dqforge.operators import prep as PR
from dqforge.operators import publish as P

N = 90_000
HOT = N // 3


@pytest.fixture(scope="module")
def skewed(spark):
    i = F.col("id")
    return spark.range(N).select(
        F.when(i < HOT, F.lit(0)).otherwise(i).cast("long").alias("k"),
        (i % 7).cast("int").alias("v"),
        F.when(i < HOT, F.lit("hot")).otherwise(F.concat(F.lit("b"), (i % 5).cast("string"))).alias("batch"),
        F.when(i < HOT, F.lit(0.5)).otherwise((i % 997) / 997.0).alias("score"),
        ((i * 7919) % 3 == 0).cast("int").alias("y"),
        i.alias("row"),
    )


@pytest.fixture(scope="module")
def con(skewed):
    c = duckdb.connect()
    c.register("t", skewed.toPandas())
    return c


def test_diff_hot_key(skewed, con):
    target = skewed.withColumn("v", F.when((F.col("k") == 0) & (F.col("v") == 3), F.lit(99)).otherwise(F.col("v")))
    got = {(r["k"], r["status"]): (r["n_source"], r["n_target"])
           for r in I.diff_tables(skewed, target, ["k"], ["v"]).collect()}
    n3 = con.execute("SELECT COUNT(*) FROM t WHERE k = 0 AND v = 3").fetchone()[0]
    assert got == {(0, "missing_in_target"): (n3, 0), (0, "missing_in_source"): (0, n3)}


def test_batch_validation_hot_batch(skewed, con):
    suite = {"expectation_suite_name": "s", "expectations": [
        {"expectation_type": E.ROW_COUNT_BETWEEN, "kwargs": {"min_value": 1, "max_value": 20000}},
        {"expectation_type": E.VALUES_BETWEEN, "kwargs": {"column": "v", "min_value": 0, "max_value": 5}}]}
    res = {(r["batch"], r["metric"]): (r["n_rows"], r["n_failed"], r["passed"])
           for r in E.validate(skewed, suite, by=["batch"]).collect()}
    exp = {b: (n, bad) for b, n, bad in con.execute(
        "SELECT batch, COUNT(*), COUNT_IF(v > 5) FROM t GROUP BY batch").fetchall()}
    for b, (n, bad) in exp.items():
        assert res[(b, "row_count")] == (n, None, n <= 20000)
        assert res[(b, "between")] == (n, bad, bad == 0)


def test_dedupe_and_value_set_hot(skewed, con):
    assert PR.dedupe(skewed.select("k", "v")).count() == con.execute(
        "SELECT COUNT(*) FROM (SELECT DISTINCT k, v FROM t)").fetchone()[0]
    vs = {r["value"]: r["n"] for r in C.value_set(skewed, "batch").collect()}
    assert vs == dict(con.execute("SELECT batch, COUNT(*) FROM t GROUP BY batch").fetchall())


def test_auc_hot_score(skewed, con):
    exact = con.execute("""
        WITH g AS (SELECT score, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg FROM t GROUP BY score),
        c AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp FROM g)
        SELECT SUM(neg * (2.0 * cp - pos)) / (2.0 * SUM(pos) * SUM(neg)) FROM c""").fetchone()[0]
    assert EV.auc(skewed, "y", "score").collect()[0]["auc"] == pytest.approx(round(exact, 6), abs=1e-6)


def test_publish_hot_keys(skewed, con):
    dest = skewed.filter(F.col("k") >= 60_000)
    staged = skewed.filter((F.col("k") < 45_000) | (F.col("k") >= 80_000))
    got = P.publish_new(staged, dest, ["k"]).count()
    exp = con.execute("""SELECT COUNT(*) FROM t s WHERE (k < 45000 OR k >= 80000)
                         AND NOT EXISTS (SELECT 1 FROM t d WHERE d.k >= 60000 AND d.k = s.k)""").fetchone()[0]
    assert got == exp and got > HOT  # all rows of the hot key are inserted


def test_stratified_split_hot_label(skewed):
    import math

    out = EV.stratified_split(skewed, "batch", "row", 0.25, seed=9)
    got = {(r["batch"], r["split"]): r["n"] for r in out.groupBy("batch", "split").agg(F.count("*").alias("n")).collect()}
    sizes = {r["batch"]: r["n"] for r in skewed.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    for b, n in sizes.items():
        assert got[(b, "test")] == math.ceil(n * 0.25)


def test_diff_prefilter_same_result(skewed):
    target = skewed.withColumn("v", F.when(F.col("k") == 45_678, F.lit(42)).otherwise(F.col("v"))).unionByName(
        skewed.filter(F.col("k") == 70_001))
    plain = sorted(tuple(r) for r in I.diff_tables(skewed, target, ["k"], ["v"]).collect())
    pre = sorted(tuple(r) for r in I.diff_tables(skewed, target, ["k"], ["v"], prefilter_buckets=4096).collect())
    assert plain == pre and len(plain) == 3
    same = I.diff_tables(skewed, skewed, ["k"], ["v"], prefilter_buckets=4096)
    assert same.count() == 0
