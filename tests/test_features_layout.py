"""Sparse one-hot vectors, cluster layout, bound names, folds, registry texts and text dates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dqforge.operators import checks as C
from dqforge.operators import evaluate as EV
from dqforge.operators import prep as PR
from dqforge.operators import registry as RG
from dqforge.sources import files as FS
from dqforge.sources import tables as TB


def test_one_hot_vector(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b"), (5, "")], "k int, c string")
    got = {r.k: (r.c_vector.size, list(r.c_vector.indices)) for r in PR.one_hot_vector(df, "c").collect()}
    assert got == {1: (3, [2]), 2: (3, []), 3: (3, [1]), 4: (3, [2]), 5: (3, [0])}
    full = {r.k: list(r.v.indices) for r in PR.one_hot_vector(df.where("c IS NOT NULL"), "c", "v").collect()}
    assert full == {1: [2], 3: [1], 4: [2], 5: [0]}  # the last value keeps its place without a NULL


def test_a_million_values_stay_distributed(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("c"))
    out = PR.one_hot_vector(df, "c")
    assert out.agg(F.count(F.lit(1))).first()[0] == 1_000_000
    assert PR.category_index(df, "c").agg(F.min("index"), F.max("index"), F.count_distinct("index")).first()[:] == (0, 999_999, 1_000_000)


@pytest.fixture
def small_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_cluster_layout_skips_files(spark, tmp_path, small_parts):
    df = spark.range(40_000).select(F.xxhash64("id").alias("h"), (F.col("id") * 7919 % 40_000).alias("k"), F.lit("x").alias("v")).repartition(6)
    path = str(tmp_path / "clustered")
    FS.load(df, path, cluster_by=["k"])
    written = spark.read.parquet(path)
    assert written.count() == 40_000
    files = written.where("k BETWEEN 100 AND 120").select("_metadata.file_path").distinct().count()
    spread = written.groupBy("_metadata.file_path").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    assert len(spread) > 1 and all(a.hi < b.lo for a, b in zip(spread, spread[1:])) and files == 1
    name = "clustered_by_table"
    TB.create_table(spark, name, "h bigint, k bigint, v string", replace=True, location=str(tmp_path / "t"), cluster_by=["k", "h"])
    try:
        assert TB.cluster_columns(spark, name) == ["k", "h"]
        FS.load(df, name, mode="append")  # laid out by the table's own columns
        per_file = spark.table(name).groupBy("_metadata.file_path").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
        assert len(per_file) > 1 and all(a.hi <= b.lo for a, b in zip(per_file, per_file[1:])) and spark.table(name).count() == 40_000
    finally:
        TB.drop_table(spark, name)


def test_names_are_values_not_statements(spark):
    for bad in ("x; DROP TABLE y", "a b", "`q`` uote`"):
        with pytest.raises(Exception):
            TB.create_table(spark, bad, "a int")
        TB.drop_table(spark, "`no such table`")
    TB.create_table(spark, "plain_name", "a int, `odd ``name` string", replace=True)
    assert TB.table_exists(spark, "plain_name") and spark.table("plain_name").columns == ["a", "odd `name"]
    TB.drop_table(spark, "plain_name")
    assert not TB.table_exists(spark, "plain_name")


def test_folds_come_from_the_key(spark):
    df = spark.range(600).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 > 3).cast("int").alias("y"))
    one, other = (EV.with_folds(df.repartition(n), "k", 5).select("k", "fold").collect() for n in (1, 9))
    assert dict(one) == dict(other) and {f for _, f in one} == {0, 1, 2, 3, 4}
    grid = {"regParam": [0.01, 1.0], "elasticNetParam": [0.0, 1.0]}
    best = []
    for n in (1, 7):
        _, res = EV.grid_search(df.repartition(n), ["x"], "y", "log_reg", grid, folds=3, key="k")
        best.append({r.params: round(r.mean_auc, 6) for r in res.collect()})
    assert best[0] == best[1] and len(best[0]) == 4
    sizes = [1, 1]
    for model in ("log_reg", "gbt"):
        for values in EV.default_grid(model, 100).values():
            sizes[model == "gbt"] *= len(values)
    assert sizes == [18, 27]


def test_models_fit_after_an_observation(spark):
    from pyspark.sql import Observation

    seen = Observation()
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 > 3).cast("int").alias("y"))
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 200}
    for key in ("k", None):
        cvm, res = EV.grid_search(df, ["x"], "y", "log_reg", {"regParam": [0.01]}, folds=2, key=key)
        assert [round(r.mean_auc, 6) for r in res.collect()] == [1.0]
        assert cvm.bestModel.transform(df).count() == 200
    model = EV.refit(df, ["x"], "y", "log_reg", {"regParam": 0.01})
    pred = EV.positive_probability(model.transform(df)).select("y", EV.predict_class("score").alias("p"))
    assert pred.where("y <> p").count() == 0


def test_registry_texts(spark):
    reg = RG.load_registry({"t": {"properties": {
        "A": {"type": "int", "description": "source_order = 2, kept"}, "B": {"type": "number(10)", "description": "no place"},
        "C": {"description": "source_order=1"}, "D": {"type": "bool", "description": "source_order=x"}, "E": {"type": "timestamp_ntz", "description": None}}}}, "t")
    assert RG.registry_columns(reg) == ["c", "a"]
    assert RG.settings("plain text") == {} and RG.settings("a=1; B = two=2") == {"a": "1", "b": "two=2"}
    assert RG.resolve_schema(spark.createDataFrame([(1,)], "a int"), reg).collect()[0].asDict() == {"c": "", "a": 1}
    with pytest.raises(ValueError):
        RG.resolve_schema(spark.createDataFrame([(1,)], "z int"), reg)


def test_malformed_text_dates_are_on_no_day(spark):
    rows = [("2024-01-08", 1), ("2024-01-08x", 2), ("2024-01-08 10:00:00", 4), ("2024-01-01", 8), (None, 16), ("junk", 32)]
    df = spark.createDataFrame(rows, "ds string, v int")
    got = C.metric_by_date(df, {"s": "SUM(v)"}, "ds", ["2024-01-08", "2024-01-01"]).collect()
    assert {r.ds: r.s for r in got} == {dt.date(2024, 1, 8): 5, dt.date(2024, 1, 1): 8}
    assert C.interval_check(df, {"SUM(v)": 2.0}, "2024-01-08").collect()[0]["observed"] == 1.6


def test_expected_batches_without_rows(spark):
    from dqforge.operators import expectations as E

    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "b string, v int")
    expected = spark.createDataFrame([("a",), ("z",), (None,)], "b string")
    got = {(r.b, r.check_name): (r.n_rows, r.passed) for r in
           C.run_checks(df, column={"v": {"null_check": {"equal_to": 0}}}, table={"rows": "COUNT(*) > 0"}, by=["b"], expected=expected).collect()}
    assert got == {("a", "v_null_check"): (2, False), ("a", "rows"): (2, True), (None, "v_null_check"): (1, True), (None, "rows"): (1, True),
                   ("z", "v_null_check"): (0, True), ("z", "rows"): (0, False)}
    suite = {"expectations": [{"expectation_type": E.ROW_COUNT_BETWEEN, "kwargs": {"min_value": 1, "max_value": 9}},
                              {"expectation_type": E.NOT_NULL, "kwargs": {"column": "v"}}]}
    rows = E.run_checkpoint(df, suite, ["b"], expected=expected).where("b = 'z'").collect()
    assert sorted((r.n_rows, r.passed) for r in rows) == [(0, False), (0, True)]
