"""Driver queries over the test tables: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads whole tables from ``sf_dir``; rule sets below are the query parameters.
The equivalent DuckDB SQL lives in ``plans/oracle.py`` under the same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rules import first_true_flag
from ..operators import checks as C
from ..sources.tables import read_table


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# ----------------------------------------------------------------------------- rule sets

LINEITEM_COLUMN_CHECKS = {
    "l_orderkey": {"null_check": {"equal_to": 0}, "distinct_check": {"geq_to": 1}},
    "l_quantity": {"min": {"geq_to": 1}, "max": {"leq_to": 50}},
    "l_discount": {"min": {"geq_to": 0}, "max": {"less_than": 0.1}},
    "l_returnflag": {"null_check": {"equal_to": 0}, "distinct_check": {"equal_to": 3}},
    "l_extendedprice": {"min": {"greater_than": 1000}},
    "l_tax": {"max": {"leq_to": 0.075, "tolerance": 0.1}},
}

LINEITEM_TABLE_CHECKS = [
    {"row_count_check": {"check_statement": "COUNT(*) > 0"}},
    {"price_ge_quantity": {"check_statement": "l_extendedprice >= l_quantity"}},
    {"max_tax_check": {"check_statement": "MAX(l_tax) < 1"}},
    {"discount_le_tax": {"check_statement": "l_discount <= l_tax"}},
]

SHIPPING_RULES = {
    "ship_after_order": "l_shipdate > o_orderdate",
    "quantity_range": "l_quantity >= 1 AND l_quantity <= 50",
    "discount_range": "l_discount BETWEEN 0 AND 0.1",
    "tax_le_discount_plus": "l_tax <= l_discount + 0.05",
}

ORDER_RULES = {
    "status_known": "o_orderstatus IN ('F', 'O')",
    "price_positive": "o_totalprice > 0",
    "recent_order": "o_orderdate >= DATE '1996-01-01'",
}

LINEITEM_ROW_RULES = {
    "quantity_range": "l_quantity BETWEEN 1 AND 50",
    "price_over_1000": "l_extendedprice > 1000",
    "discount_le_tax": "l_discount <= l_tax",
}
SPOT_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]

# Two-branch money rule over decimals: the rounded sum of parts equals the rounded total, or
# (second branch) the net amount alone does, as when the tax part is missing.
_P = "CAST(l_extendedprice AS DECIMAL(12,2))"
_D = "CAST(l_discount AS DECIMAL(12,2))"
_X = "CAST(l_tax AS DECIMAL(12,2))"
PRICE_NET = f"ROUND({_P} * (1 - {_D}), 2)"
PRICE_TAX = f"ROUND({_P} * (1 - {_D}) * {_X}, 2)"
PRICE_TOTAL = f"{_P} * (1 - {_D}) * (1 + {_X})"
PRICE_BRANCH_1 = f"ROUND({PRICE_NET} + COALESCE({PRICE_TAX}, 0), 1) = ROUND({PRICE_TOTAL}, 1)"
PRICE_BRANCH_2 = f"ROUND({PRICE_NET}, 1) = ROUND({PRICE_TOTAL}, 1)"


# ----------------------------------------------------------------------------- checks family


def q_column_checks(spark, sf_dir):
    return C.column_checks(T(spark, sf_dir, "lineitem"), LINEITEM_COLUMN_CHECKS, suite="lineitem_columns")


def q_table_checks(spark, sf_dir):
    return C.table_checks(T(spark, sf_dir, "lineitem"), LINEITEM_TABLE_CHECKS, suite="lineitem_table")


def q_run_checks(spark, sf_dir):
    return C.run_checks(
        T(spark, sf_dir, "lineitem"), column=LINEITEM_COLUMN_CHECKS, table=LINEITEM_TABLE_CHECKS, suite="lineitem_all"
    )


def q_row_rules(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    o = T(spark, sf_dir, "orders")
    joined = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return C.row_rules(joined, SHIPPING_RULES, suite="shipping")


def q_row_flags(spark, sf_dir):
    return C.row_flags(T(spark, sf_dir, "orders"), ORDER_RULES, ["o_orderkey"])


def q_failing_rows(spark, sf_dir):
    return C.failing_rows(T(spark, sf_dir, "orders"), ORDER_RULES)


def q_price_round_check(spark, sf_dir):
    rule = first_true_flag(PRICE_BRANCH_1, PRICE_BRANCH_2) == 1
    return C.row_rules(T(spark, sf_dir, "lineitem"), {"price_round_check": rule}, suite="money")


def q_check_first_row(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    summary = o.agg(
        F.count(F.lit(1)).alias("n_orders"),
        (F.min("o_totalprice") > 0).alias("positive_prices"),
        F.count_distinct("o_orderstatus").alias("n_status"),
        F.count_if(F.col("o_totalprice") < 0).alias("n_negative"),
    )
    return C.check_row(summary, name="orders_summary_row", suite="orders_first_row")


VALUE_CHECKS = [
    ("status_count", "COUNT(DISTINCT o_orderstatus)", 3, None),
    ("avg_price", "AVG(o_totalprice)", 250000, 0.1),
    ("max_priority", "MAX(o_orderpriority)", "5-LOW", None),
    ("order_count", "COUNT(*)", 15000, None),
]


def q_value_check(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return C.evaluate(o, [C.compile_value_check(n, m, v, t) for n, m, v, t in VALUE_CHECKS], suite="orders_values")


THRESHOLD_CHECKS = [
    ("avg_balance", "AVG(c_acctbal)", 0, 10000),
    ("min_balance", "MIN(c_acctbal)", -1000, 0),
    ("segments", "COUNT(DISTINCT c_mktsegment)", 5, 5),
]


def q_threshold_check(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    return C.evaluate(
        c, [C.compile_threshold_check(spark, n, m, lo, hi) for n, m, lo, hi in THRESHOLD_CHECKS], suite="customer_thresholds"
    )


def q_threshold_sql_bounds(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    c = T(spark, sf_dir, "customer")
    lo = c.agg(F.min("c_custkey"))
    hi = c.agg(F.max("c_custkey"))
    return C.threshold_check(o, "MAX(o_custkey)", lo, hi, name="custkey_in_customer_range", suite="orders_bounds")


INTERVAL_METRICS = {"AVG(value)": 1.5, "COUNT(*)": 1.5, "SUM(value)": 1.1}


def q_interval_check(spark, sf_dir):
    ev = T(spark, sf_dir, "events")
    return C.interval_check(ev, INTERVAL_METRICS, "2024-01-30", date_filter_column="ts", days_back=-1, suite="events_interval")


# Ground truth for nation: key 1 carries a wrong region, key 99 does not exist.
NATION_TRUTH = {
    0: {"n_name": "NATION_0", "n_regionkey": "0"},
    1: {"n_name": "NATION_1", "n_regionkey": "2"},
    7: {"n_name": "NATION_7", "n_regionkey": "2"},
    99: {"n_name": "NATION_99", "n_regionkey": "4"},
}


def q_ground_truth_check(spark, sf_dir):
    return C.ground_truth_check(T(spark, sf_dir, "nation"), NATION_TRUTH, key="n_nationkey")


def q_spot_check(spark, sf_dir):
    return C.spot_check(T(spark, sf_dir, "lineitem"), LINEITEM_ROW_RULES, SPOT_KEY, n=10)


QUERIES = {
    "column_checks": q_column_checks,
    "table_checks": q_table_checks,
    "run_checks": q_run_checks,
    "row_rules": q_row_rules,
    "row_flags": q_row_flags,
    "failing_rows": q_failing_rows,
    "price_round_check": q_price_round_check,
    "check_first_row": q_check_first_row,
    "value_check": q_value_check,
    "threshold_check": q_threshold_check,
    "threshold_sql_bounds": q_threshold_sql_bounds,
    "interval_check": q_interval_check,
    "ground_truth_check": q_ground_truth_check,
    "spot_check": q_spot_check,
}


# ----------------------------------------------------------------------------- expectations family

from ..operators import expectations as E  # noqa: E402
from ..sources import batches as B  # noqa: E402


def _exp(t, **kw):
    return {"expectation_type": t, "kwargs": kw}


ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

ORDERS_SUITE = {
    "expectation_suite_name": "orders.pass",
    "expectations": [
        _exp(E.ROW_COUNT_BETWEEN, min_value=1000, max_value=100000000),
        _exp(E.NOT_NULL, column="o_orderkey"),
        _exp(E.DISTINCT_IN_SET, column="o_orderstatus", value_set=["F", "O", "P"]),
        _exp(E.VALUES_BETWEEN, column="o_totalprice", min_value=0, max_value=600000),
        _exp(E.IN_SET, column="o_orderpriority", value_set=ORDER_PRIORITIES, mostly=0.95),
    ],
}

CUSTOMER_FAIL_SUITE = {
    "expectation_suite_name": "customer.fail",
    "expectations": [
        _exp(E.ROW_COUNT_BETWEEN, min_value=9000, max_value=11000),
        _exp(E.DISTINCT_IN_SET, column="c_mktsegment", value_set=["AUTOMOBILE", "BUILDING"]),
        _exp(E.VALUES_BETWEEN, column="c_acctbal", min_value=0, max_value=10000, mostly=0.8),
        _exp(E.IN_SET, column="c_nationkey", value_set=list(range(10)), mostly=0.5),
        _exp(E.NOT_NULL, column="c_name", mostly=0.99),
    ],
}

PART_SCHEMA_SUITE = {
    "expectation_suite_name": "part.schema",
    "expectations": [
        _exp(E.COLUMNS_MATCH, column_list=["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
        _exp(E.OF_TYPE, column="p_size", type_="int"),
        _exp(E.OF_TYPE, column="p_retailprice", type_="int"),
        _exp(E.OF_TYPE, column="p_name", type_="str"),
        _exp(E.OF_TYPE, column="p_partkey", type_="int"),
        _exp(E.ROW_COUNT_BETWEEN, min_value=1, max_value=1000000000),
    ],
}

EVENTS_DAY_SUITE = {
    "expectation_suite_name": "events.daily",
    "expectations": [
        _exp(E.ROW_COUNT_BETWEEN, min_value=300, max_value=400),
        _exp(E.NOT_NULL, column="user_id"),
        _exp(E.VALUES_BETWEEN, column="value", min_value=0, max_value=500),
        _exp(E.IN_SET, column="event_type", value_set=["click", "view", "purchase", "signup"], mostly=0.75),
    ],
}

ORDERS_WARN_SUITE = {
    "expectation_suite_name": "orders.warn",
    "expectations": [
        _exp(E.ROW_COUNT_BETWEEN, min_value=20000, max_value=30000),
        _exp(E.VALUES_BETWEEN, column="o_totalprice", min_value=1000, max_value=400000, mostly=0.99),
        _exp(E.IN_SET, column="o_orderstatus", value_set=["F", "O"], mostly=0.9),
    ],
}


def q_suite_validate(spark, sf_dir):
    return E.validate(T(spark, sf_dir, "orders"), ORDERS_SUITE)


def q_suite_fail(spark, sf_dir):
    return E.validate(T(spark, sf_dir, "customer"), CUSTOMER_FAIL_SUITE)


def q_schema_expectations(spark, sf_dir):
    return E.validate(T(spark, sf_dir, "part"), PART_SCHEMA_SUITE)


def q_batch_validate(spark, sf_dir):
    ev = B.with_batch_day(T(spark, sf_dir, "events"), "ts")
    return E.run_checkpoint(ev, EVENTS_DAY_SUITE, ["batch_date"], name="events.daily.chk")


def q_latest_batch(spark, sf_dir):
    return B.latest_day(T(spark, sf_dir, "events"), "ts").select("event_id", "user_id", "event_type", "value", "batch_date")


def q_checkpoint_summary(spark, sf_dir):
    res = E.validate_tiers(T(spark, sf_dir, "orders"), {"warning": ORDERS_WARN_SUITE, "failure": ORDERS_SUITE})
    return E.summary(res, keys=("tier", "suite"))


QUERIES.update({
    "suite_validate": q_suite_validate,
    "suite_fail": q_suite_fail,
    "schema_expectations": q_schema_expectations,
    "batch_validate": q_batch_validate,
    "latest_batch": q_latest_batch,
    "checkpoint_summary": q_checkpoint_summary,
})


# ----------------------------------------------------------------------------- integrity family

from ..operators import integrity as I  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources.files import load_csv_checked  # noqa: E402

LOAD_SCHEMA = "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate date"


def _lineitem_as_text(li: DataFrame) -> DataFrame:
    """lineitem columns as CSV lines with bad tokens injected by a key rule:
    quantity 'n/a' on line 7; price 'abc' on line 3 of flag A; an impossible date on line 2 of
    flag N; an extra field on line 6 of flag R; the last field missing on line 5 of flag A."""
    ln, rf = F.col("l_linenumber"), F.col("l_returnflag")
    fields = [
        F.col("l_orderkey").cast("string"),
        ln.cast("string"),
        F.when(ln == 7, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")),
        F.when((ln == 3) & (rf == "A"), F.lit("abc")).otherwise(F.col("l_extendedprice").cast("string")),
        F.when((ln == 2) & (rf == "N"), F.lit("2024-13-45")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")),
    ]
    line = (
        F.when((ln == 6) & (rf == "R"), F.concat_ws(",", *fields, F.lit("extra")))
        .when((ln == 5) & (rf == "A"), F.concat_ws(",", *fields[:-1]))
        .otherwise(F.concat_ws(",", *fields))
    )
    return li.select(line.alias("value"), rf)


def q_load_errors(spark, sf_dir):
    out = scratch_path(spark, "load-errors")
    _lineitem_as_text(T(spark, sf_dir, "lineitem")).write.partitionBy("l_returnflag").text(out)
    checked = load_csv_checked(spark, out, LOAD_SCHEMA, allow_jagged=True)
    return I.load_errors(checked, group_col="l_returnflag")


def _fixed(df: DataFrame) -> DataFrame:
    """Doubles as decimals: a text form that every engine writes alike."""
    return df.select(*[F.col(f.name).cast("decimal(20,4)").alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def q_table_fingerprint(spark, sf_dir):
    parts = [I.table_fingerprint(_fixed(T(spark, sf_dir, t)), T(spark, sf_dir, t).columns).select(F.lit(t).alias("table_name"), "*")
             for t in ("lineitem", "orders")]
    return parts[0].unionByName(parts[1])


DIFF_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def _with_notes(li: DataFrame) -> DataFrame:
    """Two text columns with NULLs (line 2) and a separator inside a text (line 3)."""
    ln = F.col("l_linenumber")
    return li.withColumn("note_a", F.when(ln == 2, "a").when(ln == 3, "a|b")).withColumn("note_b", F.when(ln == 3, "c"))


def _lineitem_shifted(li: DataFrame) -> DataFrame:
    """A copy of the same size whose notes of flag N moved: a NULL to the other column, a separator
    to the other text."""
    ln, n = F.col("l_linenumber"), F.col("l_returnflag") == "N"
    return (li.withColumn("note_b", F.when(n & (ln == 2), F.lit("a")).when(n & (ln == 3), F.lit("b|c")).otherwise(F.col("note_b")))
            .withColumn("note_a", F.when(n & (ln == 2), F.lit(None)).when(n & (ln == 3), F.lit("a")).otherwise(F.col("note_a"))))


def _lineitem_target(li: DataFrame) -> DataFrame:
    """A drifted copy: line 7 dropped, quantity +1 on line 1 of flag R, line 6 of flag A doubled,
    notes of flag N shifted."""
    li = _lineitem_shifted(li)
    ln, rf = F.col("l_linenumber"), F.col("l_returnflag")
    kept = li.filter(ln != 7).withColumn(
        "l_quantity", F.when((ln == 1) & (rf == "R"), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    return kept.unionByName(li.filter((ln == 6) & (rf == "A")))


def q_diff_tables(spark, sf_dir):
    li = _with_notes(T(spark, sf_dir, "lineitem"))
    return I.diff_tables(li, _lineitem_target(li), DIFF_KEY, [c for c in li.columns if c not in DIFF_KEY])


def q_file_checksums(spark, sf_dir):
    return I.file_checksums(spark, sf_dir, glob="*.parquet").select("file_name", "length", "md5")


QUERIES.update({
    "load_errors": q_load_errors,
    "table_fingerprint": q_table_fingerprint,
    "diff_tables": q_diff_tables,
    "file_checksums": q_file_checksums,
})


# ----------------------------------------------------------------------------- publish / registry / prep

import datetime as _dt  # noqa: E402

from ..operators import prep as PR  # noqa: E402
from ..operators import publish as P  # noqa: E402
from ..operators import registry as RG  # noqa: E402
from ..sources.tables import archive_failures  # noqa: E402

D1997 = _dt.date(1997, 1, 1)
D1998 = _dt.date(1998, 1, 1)
D1999 = _dt.date(1999, 1, 1)


def q_publish_new(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    dest = o.filter(F.col("o_orderdate") < F.lit(D1998))
    staged = o.filter(F.col("o_orderdate") >= F.lit(D1997))
    return P.publish_new(staged, dest, ["o_orderkey"], defaults={"o_orderpriority": "3-MEDIUM"})


def q_publish_first(spark, sf_dir):
    """First publish into a folder that doesn't exist: NULL priorities get the default, twice published rows stay single."""
    o = T(spark, sf_dir, "orders")
    staged = o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")))
    path = scratch_path(spark, "publish-first")
    for _ in range(2):
        P.publish(staged, path, ["o_orderkey"], defaults={"o_orderpriority": "3-MEDIUM"})
    return spark.read.parquet(path)


def q_publish_new_composite(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    dest = li.filter(F.col("l_shipdate") < F.lit(D1999))
    staged = li.filter(F.col("l_shipdate") >= F.lit(D1998))
    return P.publish_new(staged, dest, ["l_orderkey", "l_linenumber"])


WAP_COLUMN_CHECKS = {"o_orderkey": {"null_check": {"equal_to": 0}}, "o_totalprice": {"min": {"geq_to": 0}}}
WAP_TABLE_PASS = {"row_count_check": "COUNT(*) > 0"}
WAP_TABLE_FAIL = {"row_count_check": "COUNT(*) > 1000000000"}


def _wap(spark, sf_dir, table_checks):
    o = T(spark, sf_dir, "orders")
    dest_path = scratch_path(spark, "wap-dest")
    o.filter(F.col("o_orderdate") < F.lit(D1997)).write.parquet(dest_path)
    P.write_audit_publish(o, dest_path, ["o_orderkey"], column=WAP_COLUMN_CHECKS, table=table_checks, on_fail="warn")
    return spark.read.parquet(dest_path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


def q_wap_publish(spark, sf_dir):
    return _wap(spark, sf_dir, WAP_TABLE_PASS)


def q_wap_gate_fail(spark, sf_dir):
    return _wap(spark, sf_dir, WAP_TABLE_FAIL)


def q_archive_failures(spark, sf_dir):
    path = scratch_path(spark, "archive")
    archive_failures(C.failing_rows(T(spark, sf_dir, "orders"), ORDER_RULES), path,
                     ["o_orderkey", "o_orderstatus", "o_totalprice"])
    return spark.read.parquet(path)


def _orders_customers(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    c = T(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return P.enrich(o, c, ["o_custkey"], "left")


def q_enrich_costs(spark, sf_dir):
    j = _orders_customers(spark, sf_dir)
    return j.select(
        "o_orderkey", "o_custkey", "c_name", "c_acctbal", "o_totalprice",
        (F.col("o_totalprice") + F.coalesce(F.col("c_acctbal"), F.lit(0.0))).alias("total_value"),
    )


def q_cost_ratio(spark, sf_dir):
    j = _orders_customers(spark, sf_dir)
    return j.select("o_orderkey", F.try_divide(F.col("o_totalprice"), F.col("c_acctbal")).alias("price_per_balance"))


CUSTOMER_REGISTRY = {
    "customer": {
        "properties": {
            "C_CUSTKEY": {"type": "int", "description": "source_order=1"},
            "CUSTOMER_NAME": {"type": "varchar(25)", "description": "source_order=2", "default_source": "source=C_NAME"},
            "C_NATIONKEY": {"type": "int", "description": "source_order=3"},
            "C_ACCTBAL": {"type": "float", "description": "source_order=4"},
            "LOYALTY_TIER": {"type": "varchar(10)", "description": "source_order=5", "default": "bronze"},
            "IS_ACTIVE": {"type": "bool", "description": "source_order=6"},
            "CREDIT_SCORE": {"type": "number", "description": "source_order=7"},
        },
        "dimensions": ["c_custkey"],
        "metrics": ["c_acctbal"],
        "cluster_keys": {"columns": ["C_CUSTKEY"]},
    }
}

POSITION_REGISTRY = {
    "customer_pos": {
        "properties": {
            "ID": {"type": "int", "description": "source_order=1"},
            "NATION": {"type": "int", "description": "source_order=3"},
            "BALANCE": {"type": "float", "description": "source_order=4"},
            "HASH_DIFF": {"type": "varchar(64)", "description": "source_order=5"},
        }
    }
}


def q_resolve_schema(spark, sf_dir):
    return RG.resolve_schema(T(spark, sf_dir, "customer"), RG.load_registry(CUSTOMER_REGISTRY, "customer"))


def q_select_by_position(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    T(spark, sf_dir, "customer").write.option("header", False).csv(path)
    raw = spark.read.option("header", False).csv(path)
    return RG.select_by_position(raw, RG.load_registry(POSITION_REGISTRY, "customer_pos"))


def q_clean_rows(spark, sf_dir):
    return PR.clean(T(spark, sf_dir, "part"), sentinel_cols=["p_type"], sentinel="ECONOMY", replacement="Unknown",
                    drop=["p_partkey", "p_retailprice"])


def q_one_hot(spark, sf_dir):
    return PR.one_hot(T(spark, sf_dir, "customer"), ["c_mktsegment"])


BALANCE_EDGES = [-1000, 0, 2500, 5000, 7500, 10000]


def q_bin_column(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return PR.bin_column(c, "c_acctbal", BALANCE_EDGES, [1, 2, 3, 4, 5], name="acctbal_bin")


def q_flag_equals(spark, sf_dir):
    p = T(spark, sf_dir, "part").select("p_partkey", "p_type")
    return PR.flag_equals(p, "p_type", "STANDARD", name="is_standard")


def q_with_load_date(spark, sf_dir):
    ev = T(spark, sf_dir, "events").select("event_id", "event_type")
    out = PR.with_load_date(ev, "2024-02-01", offset=1)
    return out.withColumn("upload_date", F.date_format("upload_date", "yyyy-MM-dd"))


QUERIES.update({
    "publish_new": q_publish_new,
    "publish_first": q_publish_first,
    "publish_new_composite": q_publish_new_composite,
    "wap_publish": q_wap_publish,
    "wap_gate_fail": q_wap_gate_fail,
    "archive_failures": q_archive_failures,
    "enrich_costs": q_enrich_costs,
    "cost_ratio": q_cost_ratio,
    "resolve_schema": q_resolve_schema,
    "select_by_position": q_select_by_position,
    "clean_rows": q_clean_rows,
    "one_hot": q_one_hot,
    "bin_column": q_bin_column,
    "flag_equals": q_flag_equals,
    "with_load_date": q_with_load_date,
})


# ----------------------------------------------------------------------------- model evaluation

from ..operators import evaluate as EV  # noqa: E402


def q_stratified_split(spark, sf_dir):
    return EV.stratified_split(T(spark, sf_dir, "labels"), "quality", "doc_id", test_fraction=0.2, seed=55)


def _scored(spark, sf_dir) -> DataFrame:
    """labels ⋈ documents; score from document length, hard label at 0.5 (length > 5000)."""
    lab = T(spark, sf_dir, "labels")
    docs = T(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    j = lab.join(docs, "doc_id", "inner")
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(5000.0))
    return j.withColumn("score", score).withColumn("yhat", EV.predict_class("score"))


def q_confusion(spark, sf_dir):
    return EV.confusion(_scored(spark, sf_dir), "quality", "yhat")


def q_classification_report(spark, sf_dir):
    return EV.classification_report(_scored(spark, sf_dir), "quality", "yhat")


def q_roc_points(spark, sf_dir):
    return EV.roc_points(_scored(spark, sf_dir), "quality", "score")


def q_auc(spark, sf_dir):
    return EV.auc(_scored(spark, sf_dir), "quality", "score")


def q_best_run(spark, sf_dir):
    runs = EV.hard_label_metrics(_scored(spark, sf_dir), "quality", "yhat", by=["lang"]).withColumnRenamed("lang", "run_id")
    return EV.best_run(runs)


GRID_FEATURES = ["n_chars", "is_en"]


def q_grid_search(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("is_en", (F.col("lang") == "en").cast("double")).withColumn(
        "n_chars", F.col("n_chars").cast("double"))
    _, res = EV.grid_search(s, GRID_FEATURES, "quality", "log_reg", folds=5, parallelism=8, key="doc_id")
    return res


QUERIES.update({
    "stratified_split": q_stratified_split,
    "confusion": q_confusion,
    "classification_report": q_classification_report,
    "roc_points": q_roc_points,
    "auc": q_auc,
    "best_run": q_best_run,
    "grid_search": q_grid_search,
})


# ----------------------------------------------------------------------------- more operators of the inventory

from ..sources.files import read_csv  # noqa: E402


def q_metric_by_date(spark, sf_dir):
    ev = T(spark, sf_dir, "events")
    out = C.metric_by_date(ev, {"n_events": "COUNT(*)", "avg_value": "ROUND(AVG(value), 6)"}, "ts",
                           ["2024-01-10", "2024-01-20"])
    return out.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "n_events", "avg_value")


def q_value_set(spark, sf_dir):
    return C.value_set(T(spark, sf_dir, "orders"), "o_orderpriority")


def q_unexpected_values(spark, sf_dir):
    return E.unexpected_values(T(spark, sf_dir, "customer"), "c_nationkey", list(range(10)))


BATCH_COLUMN_CHECKS = {
    "l_quantity": {"min": {"geq_to": 1}, "max": {"leq_to": 50}},
    "l_discount": {"max": {"leq_to": 0.1}},
    "l_orderkey": {"distinct_check": {"geq_to": 1000}},
}
BATCH_TABLE_CHECKS = {"tax_cap": "l_tax <= 0.08", "many_rows": "COUNT(*) > 15000"}


def q_run_checks_by_batch(spark, sf_dir):
    return C.run_checks(T(spark, sf_dir, "lineitem"), column=BATCH_COLUMN_CHECKS, table=BATCH_TABLE_CHECKS,
                        suite="lineitem_by_flag", by=["l_returnflag"])


def q_validate_tiers(spark, sf_dir):
    return E.validate_tiers(T(spark, sf_dir, "orders"), {"warning": ORDERS_WARN_SUITE, "failure": ORDERS_SUITE})


def q_compare_fingerprints(spark, sf_dir):
    """All columns against a drifted copy, a copy of the same size with moved texts, and itself in another order."""
    li = _with_notes(T(spark, sf_dir, "lineitem"))
    copies = {"lineitem_vs_copy": _lineitem_target(li), "lineitem_vs_shifted": _lineitem_shifted(li), "lineitem_vs_itself": li.repartition("l_partkey")}
    return I.compare_fingerprints(li, copies, li.columns)


CSV_TS_FORMAT = "dd/MM/yyyy HH:mm:ss"


def q_csv_header_ts(spark, sf_dir):
    path = scratch_path(spark, "events-csv")
    ev = T(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    ev.write.option("header", True).option("timestampNTZFormat", CSV_TS_FORMAT).csv(path)
    back = read_csv(spark, path, "event_id bigint, ts timestamp_ntz, event_type string", header=True,
                    ts_format=CSV_TS_FORMAT)
    return back.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"), "event_type")


EVENT_FILE_PATTERN = r".*/event_type=([a-z]+)/part-[^/]*\.csv"


def q_list_batches(spark, sf_dir):
    path = scratch_path(spark, "events-by-type")
    T(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type").write.partitionBy(
        "event_type").csv(path)
    df = B.list_batches(spark, path, EVENT_FILE_PATTERN, ["batch_type"],
                        schema="event_id bigint, user_id bigint, value double", on="file_path")
    suite = {"expectation_suite_name": "events.by_type", "expectations": [
        _exp(E.ROW_COUNT_BETWEEN, min_value=100, max_value=100000000),
        _exp(E.VALUES_BETWEEN, column="value", min_value=0, max_value=400, mostly=0.9),
    ]}
    return E.validate(df, suite, by=["batch_type"])


def q_union_new(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    dest = o.filter(F.col("o_orderdate") < F.lit(D1998))
    new = P.publish_new(o.filter(F.col("o_orderdate") >= F.lit(D1997)), dest, ["o_orderkey"])
    return P.union_new(dest, new).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


def q_dedupe(spark, sf_dir):
    return PR.dedupe(T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


def q_refit_predict(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("is_en", (F.col("lang") == "en").cast("double")).withColumn(
        "n_chars", F.col("n_chars").cast("double"))
    model = EV.refit(s, GRID_FEATURES, "quality", "log_reg", {"regParam": 0.01, "elasticNetParam": 0.0})
    pred = EV.positive_probability(model.transform(s))
    return pred.select("doc_id", "quality", EV.predict_class("score").alias("predicted"))


QUERIES.update({
    "metric_by_date": q_metric_by_date,
    "value_set": q_value_set,
    "unexpected_values": q_unexpected_values,
    "run_checks_by_batch": q_run_checks_by_batch,
    "validate_tiers": q_validate_tiers,
    "compare_fingerprints": q_compare_fingerprints,
    "csv_header_ts": q_csv_header_ts,
    "list_batches": q_list_batches,
    "union_new": q_union_new,
    "dedupe": q_dedupe,
    "refit_predict": q_refit_predict,
})


# ----------------------------------------------------------------------------- streaming

STREAM_SUITE = {
    "expectation_suite_name": "events.stream",
    "expectations": [
        _exp(E.ROW_COUNT_BETWEEN, min_value=1, max_value=1000000000),
        _exp(E.NOT_NULL, column="user_id"),
        _exp(E.VALUES_BETWEEN, column="value", min_value=0, max_value=500),
        _exp(E.IN_SET, column="event_type", value_set=["click", "view", "purchase", "signup"], mostly=0.75),
    ],
}


def q_stream_validate(spark, sf_dir):
    """The events file read as a stream (file source, availableNow) and validated per file."""
    from ..streaming.validate_stream import file_stream, validate_stream

    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = file_stream(spark, sf_dir, schema, fmt="parquet", pathGlobFilter="events.parquet")
    out = scratch_path(spark, "stream-results")
    q = validate_stream(stream, out, suite=STREAM_SUITE, checkpoint_location=scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("long"))


QUERIES["stream_validate"] = q_stream_validate


# ----------------------------------------------------------------------------- more pipelines and integrity

INVARIANT_RULES = {
    "value_is_price_plus_balance": "total_value = o_totalprice + COALESCE(c_acctbal, 0.0)",
    "price_positive": "o_totalprice > 0",
}


def q_invariant_check(spark, sf_dir):
    """Cross-column invariant on the enriched orders: the parts sum to the stored total (C11)."""
    return C.table_checks(q_enrich_costs(spark, sf_dir), INVARIANT_RULES, suite="orders_invariants")


def q_no_load_errors(spark, sf_dir):
    """Load verdict per file group of the lineitem text (I2): no rejected row in group R."""
    out = scratch_path(spark, "load-verdict")
    _lineitem_as_text(T(spark, sf_dir, "lineitem")).write.partitionBy("l_returnflag").text(out)
    checked = load_csv_checked(spark, out, LOAD_SCHEMA, allow_jagged=True).withColumn(
        "_file", F.concat(F.lit("l_returnflag="), F.col("l_returnflag"), F.lit("/"), F.col("_file")))
    return I.no_load_errors(checked, "l_returnflag=R/", name="group_R_loaded_cleanly")


def q_multi_table_transform(spark, sf_dir):
    """L4: check orders and customer, left join, check the joined table, then the ratio."""
    from .pipelines import multi_table_transform

    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = T(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    r = multi_table_transform(
        o, c, "o_custkey",
        {"column": {"o_orderkey": {"null_check": {"equal_to": 0}}}},
        {"table": {"has_rows": "COUNT(*) > 0"}},
        {"table": {"price_positive": "o_totalprice > 0", "total": "total_cost = o_totalprice + COALESCE(c_acctbal, 0)"}},
        "total_cost", ("o_totalprice", "c_acctbal"), "price_per_balance", on_fail="warn", total_of=("o_totalprice", "c_acctbal"))
    return r.output


QUERIES.update({
    "invariant_check": q_invariant_check,
    "no_load_errors": q_no_load_errors,
    "multi_table_transform": q_multi_table_transform,
})
