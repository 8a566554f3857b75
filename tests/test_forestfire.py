"""Goldens of FIXTURES.md §2 on the forest-fire and cost files."""

import pytest
from pyspark.sql import functions as F

from dqforge.operators import checks as C
from dqforge.operators import integrity as I
from dqforge.operators import publish as P
from dqforge.sources.files import load_csv_checked, read_csv
from fixtures_data import (COL_CHECKS, COSTS, COST_SCHEMA, DAYS, FIRE_MD5, FIRE_SCHEMA, FIRES_CORRUPT, FIRES_GOOD,
                           FIRES_INVALID, GROUND_TRUTH, MONTHS, TABLE_CHECKS)

TEXT = {"good": FIRES_GOOD, "corrupt": FIRES_CORRUPT, "invalid": FIRES_INVALID}


@pytest.fixture
def fires(spark, write_text):
    def _load(kind):
        path = write_text(f"{kind}/forestfires.csv", TEXT[kind])
        return load_csv_checked(spark, path, FIRE_SCHEMA)

    return _load


def verdicts(results):
    return {r["check_name"]: (r["passed"], r["observed"], r["n_failed"]) for r in results.collect()}


def test_checksums(spark, write_text):
    for kind, md5 in FIRE_MD5.items():
        path = write_text(f"sum_{kind}/forestfires.csv", TEXT[kind])
        row = I.file_checksums(spark, path).collect()[0]
        assert row["md5"] == md5
        assert row["file_name"] == "forestfires.csv"


@pytest.mark.parametrize(
    "kind, expect",
    [
        ("good", {"row_count_check": True, "dmc_less_than_twice_dc_check": True, "id_null_check": True,
                  "id_distinct_check": True, "ffmc_min": True, "ffmc_max": True}),
        ("corrupt", {"row_count_check": True, "dmc_less_than_twice_dc_check": False, "id_null_check": False,
                     "id_distinct_check": False, "ffmc_min": True, "ffmc_max": True}),
        ("invalid", {"row_count_check": True, "dmc_less_than_twice_dc_check": False, "id_null_check": True,
                     "id_distinct_check": True, "ffmc_min": True, "ffmc_max": True}),
    ],
)
def test_fused_checks(fires, kind, expect):
    df = fires(kind)
    v = verdicts(C.run_checks(df, column=COL_CHECKS, table=TABLE_CHECKS))
    assert {k: p for k, (p, _, _) in v.items()} == expect
    failed_rows = {"good": 0, "corrupt": 1, "invalid": 2}[kind]
    assert v["dmc_less_than_twice_dc_check"][2] == failed_rows
    assert v["ffmc_min"][1] == 69.0 and v["ffmc_max"][1] == 92.9
    assert v["id_null_check"][1] == {"good": 0, "corrupt": 9, "invalid": 0}[kind]
    assert v["id_distinct_check"][1] == {"good": 9, "corrupt": 0, "invalid": 9}[kind]


def test_corrupt_records_and_bad_calendar_words(fires):
    n_err = {k: fires(k).filter("_error").count() for k in TEXT}
    assert n_err == {"good": 0, "corrupt": 9, "invalid": 0}
    rule = F.col("month").isin(MONTHS) & F.col("day").isin(DAYS)
    bad = {k: sorted(r["id"] or -1 for r in C.failing_rows(fires(k), {"calendar": rule}).collect()) for k in TEXT}
    assert len(bad["good"]) == 0 and len(bad["corrupt"]) == 2 and bad["invalid"] == [1, 3, 9]


def test_no_load_errors(fires):
    assert C.gate(I.no_load_errors(fires("good"), "forestfires"), on_fail="warn")
    r = I.no_load_errors(fires("corrupt"), "forestfires").collect()[0]
    assert not r["passed"] and r["n_failed"] == 9


def test_ground_truth(fires, spark, write_text):
    def gt(df):
        return {r["id"]: r for r in C.ground_truth_check(df, {int(k): v for k, v in GROUND_TRUTH.items()}, "id").collect()}

    good = gt(fires("good"))
    assert not good[1]["passed"] and good[1]["area_check"] == 0 and good[1]["n_mismatch"] == 1
    assert not good[2]["passed"] and good[2]["area_check"] == 0 and good[2]["n_mismatch"] == 1
    corrupt = gt(fires("corrupt"))
    assert not corrupt[1]["found"] and not corrupt[2]["found"]
    invalid = gt(fires("invalid"))
    assert invalid[1]["month_check"] == 0 and invalid[1]["n_mismatch"] == 1
    assert invalid[2]["dmc_check"] == 0 and invalid[2]["n_mismatch"] == 1
    zero_area = fires("good").withColumn("area", F.lit(0.0))
    z = gt(zero_area)
    assert z[1]["passed"] and z[2]["passed"]


def test_costs_join_and_ratio(spark, write_text):
    fires = read_csv(spark, write_text("g/f.csv", FIRES_GOOD), FIRE_SCHEMA)
    costs = read_csv(spark, write_text("c/c.csv", COSTS), COST_SCHEMA)
    total = (F.col("land_damage_cost") + F.col("property_damage_cost") + F.col("lost_profits_cost")).cast("bigint")
    enriched = P.enrich(costs.withColumn("total_cost", total), fires.select("id", "y", "month", "day", "area"), "id")
    out = enriched.select("id", "month", "day", "total_cost", "area",
                          F.try_divide(F.col("total_cost"), F.col("area")).alias("cost_per_area"))
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["total_cost"] == 192000 and rows[1]["cost_per_area"] == 1920.0
    assert rows[2]["cost_per_area"] == pytest.approx(5190.311418685122)
    assert rows[8]["total_cost"] == 41000000 and rows[8]["cost_per_area"] == pytest.approx(550335.5704697986)
    assert rows[9]["cost_per_area"] == pytest.approx(771.4481966511648)
    inv = C.table_checks(enriched, {
        "parts_sum": "land_damage_cost + property_damage_cost + lost_profits_cost = total_cost"}).collect()[0]
    assert inv["passed"] and inv["n_rows"] == 9
    zero = enriched.withColumn("area", F.lit(0.0)).select(F.try_divide(F.col("total_cost"), F.col("area")).alias("r"))
    assert all(r["r"] is None for r in zero.collect())
