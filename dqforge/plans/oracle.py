"""DuckDB SQL equal in meaning to each driver query in ``plans/queries.py`` (same key).

Written by hand from the rule semantics; ``_row`` only lays a verdict out in the result-table
shape (names, types, rounding), the check expressions themselves are spelled out per query.
"""

from __future__ import annotations


def _s(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _row(suite, check_name, level, column_name, metric, comparator, expected, observed, n_rows, n_failed, passed, src):
    return (
        f"SELECT {_s(suite)} AS suite, {_s(check_name)} AS check_name, {_s(level)} AS level, "
        f"CAST({_s(column_name)} AS VARCHAR) AS column_name, CAST({_s(metric)} AS VARCHAR) AS metric, "
        f"CAST({_s(comparator)} AS VARCHAR) AS comparator, CAST({_s(expected)} AS VARCHAR) AS expected, "
        f"ROUND(CAST({observed} AS DOUBLE), 6) AS observed, CAST({n_rows} AS BIGINT) AS n_rows, "
        f"CAST({n_failed} AS BIGINT) AS n_failed, COALESCE({passed}, FALSE) AS passed FROM {src}"
    )


def _union(*parts):
    return "\nUNION ALL\n".join(parts)


# ----------------------------------------------------------------------------- checks family

_COL_AGG = """a AS (SELECT COUNT(*) AS n,
  COUNT_IF(l_orderkey IS NULL) AS ok_nulls,
  MIN(l_quantity) AS q_min, MAX(l_quantity) AS q_max,
  MIN(l_discount) AS d_min, MAX(l_discount) AS d_max,
  COUNT_IF(l_returnflag IS NULL) AS rf_nulls,
  MIN(l_extendedprice) AS p_min, MAX(l_tax) AS t_max
  FROM lineitem),
d1 AS (SELECT COUNT(*) AS n, COUNT(DISTINCT l_orderkey) AS v FROM lineitem),
d2 AS (SELECT COUNT(*) AS n, COUNT(DISTINCT l_returnflag) AS v FROM lineitem)"""


def _column_rows(suite):
    return [
        _row(suite, "l_orderkey_null_check", "column", "l_orderkey", "null_check", "equal_to", "0",
             "ok_nulls", "n", "ok_nulls", "ok_nulls = 0", "a"),
        _row(suite, "l_orderkey_distinct_check", "column", "l_orderkey", "distinct_check", "geq_to", "1",
             "v", "n", "NULL", "v >= 1", "d1"),
        _row(suite, "l_quantity_min", "column", "l_quantity", "min", "geq_to", "1", "q_min", "n", "NULL", "q_min >= 1", "a"),
        _row(suite, "l_quantity_max", "column", "l_quantity", "max", "leq_to", "50", "q_max", "n", "NULL", "q_max <= 50", "a"),
        _row(suite, "l_discount_min", "column", "l_discount", "min", "geq_to", "0", "d_min", "n", "NULL", "d_min >= 0", "a"),
        _row(suite, "l_discount_max", "column", "l_discount", "max", "less_than", "0.1", "d_max", "n", "NULL",
             "d_max < 0.1", "a"),
        _row(suite, "l_returnflag_null_check", "column", "l_returnflag", "null_check", "equal_to", "0",
             "rf_nulls", "n", "rf_nulls", "rf_nulls = 0", "a"),
        _row(suite, "l_returnflag_distinct_check", "column", "l_returnflag", "distinct_check", "equal_to", "3",
             "v", "n", "NULL", "v = 3", "d2"),
        _row(suite, "l_extendedprice_min", "column", "l_extendedprice", "min", "greater_than", "1000", "p_min", "n",
             "NULL", "p_min > 1000", "a"),
        _row(suite, "l_tax_max", "column", "l_tax", "max", "leq_to", "0.075 ~0.1", "t_max", "n", "NULL",
             "t_max <= 0.075::DOUBLE * (1 + 0.1::DOUBLE)", "a"),
    ]


_TBL_AGG = """t AS (SELECT COUNT(*) AS n,
  COUNT(*) > 0 AS r0,
  MIN(CASE WHEN l_extendedprice >= l_quantity THEN 1 ELSE 0 END) AS r1,
  COUNT_IF(NOT COALESCE(l_extendedprice >= l_quantity, FALSE)) AS f1,
  MAX(l_tax) < 1 AS r2,
  MIN(CASE WHEN l_discount <= l_tax THEN 1 ELSE 0 END) AS r3,
  COUNT_IF(NOT COALESCE(l_discount <= l_tax, FALSE)) AS f3
  FROM lineitem)"""


def _table_rows(suite):
    return [
        _row(suite, "row_count_check", "table", None, "aggregate_rule", None, "COUNT(*) > 0",
             "CAST(r0 AS INT)", "n", "NULL", "r0", "t"),
        _row(suite, "price_ge_quantity", "table", None, "row_rule", None, "l_extendedprice >= l_quantity",
             "r1", "n", "f1", "r1 = 1", "t"),
        _row(suite, "max_tax_check", "table", None, "aggregate_rule", None, "MAX(l_tax) < 1",
             "CAST(r2 AS INT)", "n", "NULL", "r2", "t"),
        _row(suite, "discount_le_tax", "table", None, "row_rule", None, "l_discount <= l_tax",
             "r3", "n", "f3", "r3 = 1", "t"),
    ]


COLUMN_CHECKS = f"WITH {_COL_AGG}\n" + _union(*_column_rows("lineitem_columns"))
TABLE_CHECKS = f"WITH {_TBL_AGG}\n" + _union(*_table_rows("lineitem_table"))
RUN_CHECKS = f"WITH {_COL_AGG}, {_TBL_AGG}\n" + _union(*_column_rows("lineitem_all"), *_table_rows("lineitem_all"))

_SHIP = [
    ("ship_after_order", "l_shipdate > o_orderdate"),
    ("quantity_range", "l_quantity >= 1 AND l_quantity <= 50"),
    ("discount_range", "l_discount BETWEEN 0 AND 0.1"),
    ("tax_le_discount_plus", "l_tax <= l_discount + 0.05"),
]
ROW_RULES = (
    "WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey), r AS (SELECT COUNT(*) AS n, "
    + ", ".join(
        f"MIN(CASE WHEN {r} THEN 1 ELSE 0 END) AS v{i}, COUNT_IF(NOT COALESCE({r}, FALSE)) AS f{i}"
        for i, (_, r) in enumerate(_SHIP)
    )
    + " FROM j)\n"
    + _union(*[_row("shipping", n, "row", None, "row_rule", None, r, f"v{i}", "n", f"f{i}", f"v{i} = 1", "r")
               for i, (n, r) in enumerate(_SHIP)])
)

_ORD = [
    ("status_known", "o_orderstatus IN ('F', 'O')"),
    ("price_positive", "o_totalprice > 0"),
    ("recent_order", "o_orderdate >= DATE '1996-01-01'"),
]
ROW_FLAGS = "SELECT o_orderkey, " + ", ".join(f"CASE WHEN {r} THEN 1 ELSE 0 END AS {n}" for n, r in _ORD) + " FROM orders"
FAILING_ROWS = "SELECT * FROM orders WHERE NOT (" + " AND ".join(f"COALESCE({r}, FALSE)" for _, r in _ORD) + ")"

_P = "CAST(l_extendedprice AS DECIMAL(12,2))"
_D = "CAST(l_discount AS DECIMAL(12,2))"
_X = "CAST(l_tax AS DECIMAL(12,2))"
_NET = f"ROUND({_P} * (1 - {_D}), 2)"
_TAX = f"ROUND({_P} * (1 - {_D}) * {_X}, 2)"
_TOT = f"{_P} * (1 - {_D}) * (1 + {_X})"
_PRICE_RULE = (
    f"(CASE WHEN ROUND({_NET} + COALESCE({_TAX}, 0), 1) = ROUND({_TOT}, 1) THEN 1 "
    f"WHEN ROUND({_NET}, 1) = ROUND({_TOT}, 1) THEN 1 ELSE 0 END) = 1"
)
PRICE_ROUND_CHECK = (
    f"WITH r AS (SELECT COUNT(*) AS n, MIN(CASE WHEN {_PRICE_RULE} THEN 1 ELSE 0 END) AS v, "
    f"COUNT_IF(NOT COALESCE({_PRICE_RULE}, FALSE)) AS f FROM lineitem)\n"
    + _row("money", "price_round_check", "row", None, "row_rule", None, None, "v", "n", "f", "v = 1", "r")
)

CHECK_FIRST_ROW = (
    "WITH s AS (SELECT COUNT(*) AS n_orders, MIN(o_totalprice) > 0 AS positive_prices, "
    "COUNT(DISTINCT o_orderstatus) AS n_status, COUNT_IF(o_totalprice < 0) AS n_negative FROM orders), "
    "f AS (SELECT COUNT(*) AS n, SUM(CAST(COALESCE(n_orders <> 0, FALSE) AS INT) + CAST(COALESCE(positive_prices, FALSE) AS INT)"
    " + CAST(COALESCE(n_status <> 0, FALSE) AS INT) + CAST(COALESCE(n_negative <> 0, FALSE) AS INT)) AS ok FROM (SELECT * FROM s LIMIT 1))\n"
    + _row("orders_first_row", "orders_summary_row", "row", None, "first_row_truthy", None, "4", "ok", "n", "4 - ok",
           "n = 1 AND ok = 4", "f")
)

VALUE_CHECK = (
    "WITH v AS (SELECT COUNT(*) AS n, COUNT(DISTINCT o_orderstatus) AS v0, AVG(o_totalprice) AS v1, "
    "MAX(o_orderpriority) AS v2, COUNT(*) AS v3 FROM orders)\n"
    + _union(
        _row("orders_values", "status_count", "table", None, "COUNT(DISTINCT o_orderstatus)", "equal_to", "3",
             "v0", "n", "NULL", "v0 = 3", "v"),
        _row("orders_values", "avg_price", "table", None, "AVG(o_totalprice)", "equal_to", "250000 ~0.1",
             "v1", "n", "NULL", "v1 BETWEEN 250000 * 0.9 AND 250000 * 1.1", "v"),
        _row("orders_values", "max_priority", "table", None, "MAX(o_orderpriority)", "equal_to", "5-LOW",
             "TRY_CAST(v2 AS DOUBLE)", "n", "NULL", "CAST(v2 AS VARCHAR) = '5-LOW'", "v"),
        _row("orders_values", "order_count", "table", None, "COUNT(*)", "equal_to", "15000",
             "v3", "n", "NULL", "v3 = 15000", "v"),
    )
)

THRESHOLD_CHECK = (
    "WITH v AS (SELECT COUNT(*) AS n, AVG(c_acctbal) AS v0, MIN(c_acctbal) AS v1, COUNT(DISTINCT c_mktsegment) AS v2 "
    "FROM customer)\n"
    + _union(
        _row("customer_thresholds", "avg_balance", "table", None, "AVG(c_acctbal)", "between", "[0, 10000]",
             "v0", "n", "NULL", "v0 BETWEEN 0 AND 10000", "v"),
        _row("customer_thresholds", "min_balance", "table", None, "MIN(c_acctbal)", "between", "[-1000, 0]",
             "v1", "n", "NULL", "v1 BETWEEN -1000 AND 0", "v"),
        _row("customer_thresholds", "segments", "table", None, "COUNT(DISTINCT c_mktsegment)", "between", "[5, 5]",
             "v2", "n", "NULL", "v2 BETWEEN 5 AND 5", "v"),
    )
)

THRESHOLD_SQL_BOUNDS = (
    "WITH v AS (SELECT COUNT(*) AS n, MAX(o_custkey) AS v0 FROM orders)\n"
    + _row("orders_bounds", "custkey_in_customer_range", "table", None, "MAX(o_custkey)", "between",
           "[<query>, <query>]", "v0", "n", "NULL",
           "v0 BETWEEN (SELECT MIN(c_custkey) FROM customer) AND (SELECT MAX(c_custkey) FROM customer)", "v")
)

_IV = [("AVG(value)", "1.5"), ("COUNT(*)", "1.5"), ("SUM(value)", "1.1")]
INTERVAL_CHECK = (
    "WITH d AS (SELECT CAST(ts AS DATE) AS day, "
    + ", ".join(f"CAST({m} AS DOUBLE) AS m{i}" for i, (m, _) in enumerate(_IV))
    + " FROM events WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1), "
    "f AS (SELECT "
    + ", ".join(
        f"MAX(CASE WHEN day = DATE '2024-01-30' THEN m{i} END) AS t{i}, MAX(CASE WHEN day = DATE '2024-01-29' THEN m{i} END) AS r{i}"
        for i in range(len(_IV))
    )
    + " FROM d)\n"
    + _union(*[
        _row("events_interval", "interval_check", "table", "ts", m, "ratio_leq", f"{ratio} vs 2024-01-29",
             f"CASE WHEN t{i} = 0 AND r{i} = 0 THEN 1.0 ELSE GREATEST(t{i}, r{i}) / NULLIF(LEAST(t{i}, r{i}), 0) END",
             "NULL", "NULL",
             f"CASE WHEN t{i} IS NULL OR r{i} IS NULL THEN FALSE ELSE "
             f"(CASE WHEN t{i} = 0 AND r{i} = 0 THEN 1.0 ELSE GREATEST(t{i}, r{i}) / NULLIF(LEAST(t{i}, r{i}), 0) END) <= {ratio} END",
             "f")
        for i, (m, ratio) in enumerate(_IV)
    ])
)

GROUND_TRUTH_CHECK = """
WITH e(n_nationkey, n_name, n_regionkey) AS (
  VALUES (0, 'NATION_0', 0), (1, 'NATION_1', 2), (7, 'NATION_7', 2), (99, 'NATION_99', 4)),
j AS (
  SELECT e.n_nationkey AS n_nationkey, a.n_nationkey IS NOT NULL AS found,
         CASE WHEN a.n_name = e.n_name THEN 1 ELSE 0 END AS n_name_check,
         CASE WHEN a.n_regionkey = e.n_regionkey THEN 1 ELSE 0 END AS n_regionkey_check
  FROM e LEFT JOIN nation a ON a.n_nationkey = e.n_nationkey)
SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, found, n_name_check, n_regionkey_check,
       CAST((1 - n_name_check) + (1 - n_regionkey_check) AS INTEGER) AS n_mismatch,
       found AND (1 - n_name_check) + (1 - n_regionkey_check) = 0 AS passed
FROM j
"""

SPOT_CHECK = """
WITH k AS (
  SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), l_orderkey, l_linenumber, l_partkey
  LIMIT 10)
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_quantity BETWEEN 1 AND 50 THEN 1 ELSE 0 END AS quantity_range,
       CASE WHEN l_extendedprice > 1000 THEN 1 ELSE 0 END AS price_over_1000,
       CASE WHEN l_discount <= l_tax THEN 1 ELSE 0 END AS discount_le_tax
FROM lineitem l
WHERE EXISTS (SELECT 1 FROM k WHERE k.l_orderkey = l.l_orderkey AND k.l_linenumber = l.l_linenumber
              AND k.l_partkey = l.l_partkey)
"""


ORACLE = {
    "column_checks": COLUMN_CHECKS,
    "table_checks": TABLE_CHECKS,
    "run_checks": RUN_CHECKS,
    "row_rules": ROW_RULES,
    "row_flags": ROW_FLAGS,
    "failing_rows": FAILING_ROWS,
    "price_round_check": PRICE_ROUND_CHECK,
    "check_first_row": CHECK_FIRST_ROW,
    "value_check": VALUE_CHECK,
    "threshold_check": THRESHOLD_CHECK,
    "threshold_sql_bounds": THRESHOLD_SQL_BOUNDS,
    "interval_check": INTERVAL_CHECK,
    "ground_truth_check": GROUND_TRUTH_CHECK,
    "spot_check": SPOT_CHECK,
}


# ----------------------------------------------------------------------------- expectations family
import json as _json  # noqa: E402


def _kw(**kw):
    return _json.dumps(kw, sort_keys=True, separators=(",", ":"))


_PRIOS = "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"
_PRIO_LIST = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_ORDERS_PASS_AGG = f"""o AS (SELECT COUNT(*) AS n,
  COUNT(o_orderkey) AS k_nn,
  COUNT_IF(o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P')) AS s_bad, COUNT(o_orderstatus) AS s_nn,
  COUNT_IF(o_totalprice IS NOT NULL AND NOT (o_totalprice >= 0 AND o_totalprice <= 600000)) AS p_bad, COUNT(o_totalprice) AS p_nn,
  COUNT_IF(o_orderpriority IS NOT NULL AND o_orderpriority NOT IN {_PRIOS}) AS r_bad, COUNT(o_orderpriority) AS r_nn
  FROM orders)"""


def _share(good, nn):
    return f"CASE WHEN {nn} = 0 THEN NULL ELSE ({good}) / CAST({nn} AS DOUBLE) END"


def _mostly(good, nn, mostly):
    return f"COALESCE(({_share(good, nn)}) >= {mostly}, TRUE)"


def _orders_pass_rows(suite="orders.pass"):
    return [
        _row(suite, "expect_table_row_count_to_be_between", "table", None, "row_count", "between",
             _kw(min_value=1000, max_value=100000000), "n", "n", "NULL", "n >= 1000 AND n <= 100000000", "o"),
        _row(suite, "expect_column_values_to_not_be_null", "column", "o_orderkey", "not_null", "mostly",
             _kw(column="o_orderkey"), _share("k_nn", "n"), "n", "n - k_nn", "(n - k_nn) = 0", "o"),
        _row(suite, "expect_column_distinct_values_to_be_in_set", "column", "o_orderstatus", "in_set", "mostly",
             _kw(column="o_orderstatus", value_set=["F", "O", "P"]), _share("s_nn - s_bad", "s_nn"), "n", "s_bad",
             "s_bad = 0", "o"),
        _row(suite, "expect_column_values_to_be_between", "column", "o_totalprice", "between", "mostly",
             _kw(column="o_totalprice", min_value=0, max_value=600000), _share("p_nn - p_bad", "p_nn"), "n", "p_bad",
             "p_bad = 0", "o"),
        _row(suite, "expect_column_values_to_be_in_set", "column", "o_orderpriority", "in_set", "mostly",
             _kw(column="o_orderpriority", value_set=_PRIO_LIST, mostly=0.95), _share("r_nn - r_bad", "r_nn"), "n",
             "r_bad", _mostly("r_nn - r_bad", "r_nn", 0.95), "o"),
    ]


SUITE_VALIDATE = f"WITH {_ORDERS_PASS_AGG}\n" + _union(*_orders_pass_rows())

SUITE_FAIL = """WITH c AS (SELECT COUNT(*) AS n,
  COUNT_IF(c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')) AS m_bad, COUNT(c_mktsegment) AS m_nn,
  COUNT_IF(c_acctbal IS NOT NULL AND NOT (c_acctbal >= 0 AND c_acctbal <= 10000)) AS a_bad, COUNT(c_acctbal) AS a_nn,
  COUNT_IF(c_nationkey IS NOT NULL AND c_nationkey NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9)) AS k_bad, COUNT(c_nationkey) AS k_nn,
  COUNT(c_name) AS nm_nn
  FROM customer)
""" + _union(
    _row("customer.fail", "expect_table_row_count_to_be_between", "table", None, "row_count", "between",
         _kw(min_value=9000, max_value=11000), "n", "n", "NULL", "n >= 9000 AND n <= 11000", "c"),
    _row("customer.fail", "expect_column_distinct_values_to_be_in_set", "column", "c_mktsegment", "in_set", "mostly",
         _kw(column="c_mktsegment", value_set=["AUTOMOBILE", "BUILDING"]), _share("m_nn - m_bad", "m_nn"), "n",
         "m_bad", "m_bad = 0", "c"),
    _row("customer.fail", "expect_column_values_to_be_between", "column", "c_acctbal", "between", "mostly",
         _kw(column="c_acctbal", min_value=0, max_value=10000, mostly=0.8), _share("a_nn - a_bad", "a_nn"), "n",
         "a_bad", _mostly("a_nn - a_bad", "a_nn", 0.8), "c"),
    _row("customer.fail", "expect_column_values_to_be_in_set", "column", "c_nationkey", "in_set", "mostly",
         _kw(column="c_nationkey", value_set=list(range(10)), mostly=0.5), _share("k_nn - k_bad", "k_nn"), "n",
         "k_bad", _mostly("k_nn - k_bad", "k_nn", 0.5), "c"),
    _row("customer.fail", "expect_column_values_to_not_be_null", "column", "c_name", "not_null", "mostly",
         _kw(column="c_name", mostly=0.99), _share("nm_nn", "n"), "n", "n - nm_nn", _mostly("nm_nn", "n", 0.99), "c"),
)

_PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
SCHEMA_EXPECTATIONS = "WITH p AS (SELECT COUNT(*) AS n FROM part), one AS (SELECT 1 AS x)\n" + _union(
    _row("part.schema", "expect_table_row_count_to_be_between", "table", None, "row_count", "between",
         _kw(min_value=1, max_value=1000000000), "n", "n", "NULL", "n >= 1 AND n <= 1000000000", "p"),
    _row("part.schema", "expect_table_columns_to_match_ordered_list", "schema", None, "columns_ordered", "equal_to",
         _kw(column_list=_PART_COLS), "6", "NULL", "0", "TRUE", "one"),
    _row("part.schema", "expect_column_values_to_be_of_type", "schema", "p_size", "type", "equal_to",
         _kw(column="p_size", type_="int"), "NULL", "NULL", "0", "TRUE", "one"),
    _row("part.schema", "expect_column_values_to_be_of_type", "schema", "p_retailprice", "type", "equal_to",
         _kw(column="p_retailprice", type_="int"), "NULL", "NULL", "1", "FALSE", "one"),
    _row("part.schema", "expect_column_values_to_be_of_type", "schema", "p_name", "type", "equal_to",
         _kw(column="p_name", type_="str"), "NULL", "NULL", "0", "TRUE", "one"),
    _row("part.schema", "expect_column_values_to_be_of_type", "schema", "p_partkey", "type", "equal_to",
         _kw(column="p_partkey", type_="int"), "NULL", "NULL", "0", "TRUE", "one"),
)


def _with_batch(sql_select: str) -> str:
    """Prefix a result-row SELECT with the batch key and the checkpoint name."""
    return sql_select.replace("SELECT ", "SELECT batch_date, ", 1) + ""


_EV_AGG = """e AS (SELECT strftime(ts, '%Y-%m-%d') AS batch_date, COUNT(*) AS n,
  COUNT(user_id) AS u_nn,
  COUNT_IF(value IS NOT NULL AND NOT (value >= 0 AND value <= 500)) AS v_bad, COUNT(value) AS v_nn,
  COUNT_IF(event_type IS NOT NULL AND event_type NOT IN ('click', 'view', 'purchase', 'signup')) AS t_bad,
  COUNT(event_type) AS t_nn
  FROM events GROUP BY 1)"""
BATCH_VALIDATE = f"WITH {_EV_AGG}\nSELECT *, 'events.daily.chk' AS checkpoint FROM (\n" + _union(
    _with_batch(_row("events.daily", "expect_table_row_count_to_be_between", "table", None, "row_count", "between",
                     _kw(min_value=300, max_value=400), "n", "n", "NULL", "n >= 300 AND n <= 400", "e")),
    _with_batch(_row("events.daily", "expect_column_values_to_not_be_null", "column", "user_id", "not_null", "mostly",
                     _kw(column="user_id"), _share("u_nn", "n"), "n", "n - u_nn", "(n - u_nn) = 0", "e")),
    _with_batch(_row("events.daily", "expect_column_values_to_be_between", "column", "value", "between", "mostly",
                     _kw(column="value", min_value=0, max_value=500), _share("v_nn - v_bad", "v_nn"), "n", "v_bad",
                     "v_bad = 0", "e")),
    _with_batch(_row("events.daily", "expect_column_values_to_be_in_set", "column", "event_type", "in_set", "mostly",
                     _kw(column="event_type", value_set=["click", "view", "purchase", "signup"], mostly=0.75),
                     _share("t_nn - t_bad", "t_nn"), "n", "t_bad", _mostly("t_nn - t_bad", "t_nn", 0.75), "e")),
) + "\n)"

LATEST_BATCH = """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS batch_date FROM events
WHERE strftime(ts, '%Y-%m-%d') = (SELECT MAX(strftime(ts, '%Y-%m-%d')) FROM events)
"""

_WARN_AGG = """w AS (SELECT COUNT(*) AS n,
  COUNT_IF(o_totalprice IS NOT NULL AND NOT (o_totalprice >= 1000 AND o_totalprice <= 400000)) AS p_bad, COUNT(o_totalprice) AS p_nn,
  COUNT_IF(o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')) AS s_bad, COUNT(o_orderstatus) AS s_nn
  FROM orders)"""
_WARN_PASSED = [
    "n >= 20000 AND n <= 30000",
    _mostly("p_nn - p_bad", "p_nn", 0.99),
    _mostly("s_nn - s_bad", "s_nn", 0.9),
]
_PASS_PASSED = [
    "n >= 1000 AND n <= 100000000",
    "(n - k_nn) = 0",
    "s_bad = 0",
    "p_bad = 0",
    _mostly("r_nn - r_bad", "r_nn", 0.95),
]
CHECKPOINT_SUMMARY = (
    f"WITH {_ORDERS_PASS_AGG}, {_WARN_AGG}, r AS (\n"
    + _union(
        *[f"SELECT 'warning' AS tier, 'orders.warn' AS suite, COALESCE({p}, FALSE) AS passed FROM w" for p in _WARN_PASSED],
        *[f"SELECT 'failure' AS tier, 'orders.pass' AS suite, COALESCE({p}, FALSE) AS passed FROM o" for p in _PASS_PASSED],
    )
    + ")\nSELECT tier, suite, COUNT(*) AS n_checks, COUNT_IF(passed) AS n_passed, "
    "ROUND(COUNT_IF(passed) / CAST(COUNT(*) AS DOUBLE), 6) AS pass_rate FROM r GROUP BY tier, suite"
)

ORACLE.update({
    "suite_validate": SUITE_VALIDATE,
    "suite_fail": SUITE_FAIL,
    "schema_expectations": SCHEMA_EXPECTATIONS,
    "batch_validate": BATCH_VALIDATE,
    "latest_batch": LATEST_BATCH,
    "checkpoint_summary": CHECKPOINT_SUMMARY,
})


# ----------------------------------------------------------------------------- integrity family

LOAD_ERRORS = """
WITH g AS (SELECT l_returnflag AS file_group,
  CAST(0 AS BIGINT) AS l_orderkey, CAST(0 AS BIGINT) AS l_linenumber,
  COUNT_IF(l_linenumber = 7) AS l_quantity,
  COUNT_IF(l_linenumber = 3 AND l_returnflag = 'A') AS l_extendedprice,
  COUNT_IF(l_linenumber = 2 AND l_returnflag = 'N') AS l_shipdate,
  COUNT_IF(l_linenumber = 6 AND l_returnflag = 'R') AS too_many_fields,
  COUNT_IF(l_linenumber = 5 AND l_returnflag = 'A') AS short_rows
  FROM lineitem GROUP BY 1)
SELECT file_group, column_name, CAST(n_errors AS BIGINT) AS n_errors FROM g
UNPIVOT (n_errors FOR column_name IN (l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate,
                                      too_many_fields, short_rows))
"""


def _fp(*cols):
    """Sums of both halves of the md5 of all columns; doubles (marked *) as decimals."""
    text = [f"CAST(CAST({c[1:]} AS DECIMAL(20,4)) AS VARCHAR)" if c[0] == "*" else f"CAST({c} AS VARCHAR)" for c in cols]
    h = "md5(" + " || ".join(f"COALESCE(length({t}) || ':' || {t}, 'N')" for t in text) + ")"
    half = lambda at: f"SUM(CAST(('0x' || substr({h}, {at}, 16))::UBIGINT AS DECIMAL(38,0)))"
    return f"CAST(COALESCE({half(1)}, 0) AS DECIMAL(38,0)) AS fingerprint, CAST(COALESCE({half(17)}, 0) AS DECIMAL(38,0)) AS fingerprint_low"


TABLE_FINGERPRINT = f"""
SELECT 'lineitem' AS table_name, COUNT(*) AS n_rows,
       {_fp('l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', '*l_quantity', '*l_extendedprice', '*l_discount', '*l_tax',
            'l_returnflag', 'l_linestatus', 'l_shipdate')}
FROM lineitem
UNION ALL
SELECT 'orders', COUNT(*), {_fp('o_orderkey', 'o_custkey', 'o_orderstatus', '*o_totalprice', 'o_orderdate', 'o_orderpriority')}
FROM orders
"""

_DRIFT = """src AS (
  SELECT *, CASE l_linenumber WHEN 2 THEN 'a' WHEN 3 THEN 'a|b' END AS note_a, CASE l_linenumber WHEN 3 THEN 'c' END AS note_b
  FROM lineitem),
shifted AS (
  SELECT * EXCLUDE (note_a, note_b),
         CASE WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN NULL WHEN l_returnflag = 'N' AND l_linenumber = 3 THEN 'a' ELSE note_a END AS note_a,
         CASE WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN 'a' WHEN l_returnflag = 'N' AND l_linenumber = 3 THEN 'b|c' ELSE note_b END AS note_b
  FROM src),
tgt AS (
  SELECT * REPLACE (CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
  FROM shifted WHERE l_linenumber <> 7
  UNION ALL
  SELECT * FROM shifted WHERE l_linenumber = 6 AND l_returnflag = 'A')"""

DIFF_TABLES = f"""
WITH {_DRIFT},
u AS (SELECT *, 1 AS s, 0 AS t FROM src UNION ALL SELECT *, 0, 1 FROM tgt),
g AS (SELECT * EXCLUDE (s, t), SUM(s) AS n_source, SUM(t) AS n_target FROM u GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(n_source AS BIGINT) AS n_source, CAST(n_target AS BIGINT) AS n_target,
       CASE WHEN n_target = 0 THEN 'missing_in_target' WHEN n_source = 0 THEN 'missing_in_source'
            ELSE 'count_differs' END AS status
FROM g WHERE n_source <> n_target
"""

ORACLE.update({
    "load_errors": LOAD_ERRORS,
    "table_fingerprint": TABLE_FINGERPRINT,
    "diff_tables": DIFF_TABLES,
})


# ----------------------------------------------------------------------------- publish / registry / prep

PUBLISH_NEW = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       COALESCE(o_orderpriority, '3-MEDIUM') AS o_orderpriority
FROM orders s
WHERE s.o_orderdate >= DATE '1997-01-01'
  AND NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderdate < DATE '1998-01-01' AND d.o_orderkey = s.o_orderkey)
"""

PUBLISH_FIRST = """
SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN '3-MEDIUM' ELSE COALESCE(o_orderpriority, '3-MEDIUM') END AS o_orderpriority)
FROM orders
"""

PUBLISH_NEW_COMPOSITE = """
SELECT * FROM lineitem s
WHERE s.l_shipdate >= DATE '1998-01-01'
  AND NOT EXISTS (SELECT 1 FROM lineitem d WHERE d.l_shipdate < DATE '1999-01-01'
                  AND d.l_orderkey = s.l_orderkey AND d.l_linenumber = s.l_linenumber)
"""

_DEST0 = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < DATE '1997-01-01'"
WAP_PUBLISH = f"""
WITH d AS ({_DEST0}),
n AS (SELECT o_orderkey, o_orderstatus FROM orders s WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = s.o_orderkey)),
f AS (SELECT * FROM d UNION ALL SELECT * FROM n)
SELECT o_orderstatus, COUNT(*) AS n_rows FROM f GROUP BY o_orderstatus
"""
WAP_GATE_FAIL = f"SELECT o_orderstatus, COUNT(*) AS n_rows FROM ({_DEST0}) GROUP BY o_orderstatus"

ARCHIVE_FAILURES = (
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT ("
    + " AND ".join(f"COALESCE({r}, FALSE)" for _, r in _ORD) + ")"
)

ENRICH_COSTS = """
SELECT o_orderkey, o_custkey, c_name, c_acctbal, o_totalprice, o_totalprice + COALESCE(c_acctbal, 0.0) AS total_value
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
"""
COST_RATIO = """
SELECT o_orderkey, o_totalprice / NULLIF(c_acctbal, 0) AS price_per_balance
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
"""

RESOLVE_SCHEMA = """
SELECT c_custkey, c_name AS customer_name, c_nationkey, c_acctbal, CAST('bronze' AS VARCHAR) AS loyalty_tier,
       FALSE AS is_active, CAST(NULL AS DECIMAL(38,0)) AS credit_score
FROM customer
"""
SELECT_BY_POSITION = "SELECT CAST(c_custkey AS INTEGER) AS id, c_nationkey AS nation, c_acctbal AS balance FROM customer"

CLEAN_ROWS = r"""
WITH d AS (SELECT DISTINCT * FROM part
           WHERE p_partkey IS NOT NULL AND p_name IS NOT NULL AND p_brand IS NOT NULL AND p_type IS NOT NULL
             AND p_size IS NOT NULL AND p_retailprice IS NOT NULL),
t AS (SELECT regexp_replace(regexp_replace(p_name, '^\s+', ''), '\s+$', '') AS p_name,
             regexp_replace(regexp_replace(p_brand, '^\s+', ''), '\s+$', '') AS p_brand,
             regexp_replace(regexp_replace(p_type, '^\s+', ''), '\s+$', '') AS p_type, p_size FROM d)
SELECT p_name, p_brand, CASE WHEN p_type = 'ECONOMY' THEN 'Unknown' ELSE p_type END AS p_type, p_size FROM t
"""

ONE_HOT = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END AS c_mktsegment_AUTOMOBILE,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS c_mktsegment_BUILDING,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS c_mktsegment_FURNITURE,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS c_mktsegment_HOUSEHOLD,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS c_mktsegment_MACHINERY
FROM customer
"""

BIN_COLUMN = """
SELECT c_custkey, c_acctbal,
  CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 1
       WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 2
       WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 3
       WHEN c_acctbal > 5000 AND c_acctbal <= 7500 THEN 4
       WHEN c_acctbal > 7500 AND c_acctbal <= 10000 THEN 5 END AS acctbal_bin
FROM customer
"""

FLAG_EQUALS = "SELECT p_partkey, p_type, CASE WHEN p_type = 'STANDARD' THEN 1 ELSE 0 END AS is_standard FROM part"

WITH_LOAD_DATE = "SELECT event_id, event_type, '2024-01-31' AS upload_date FROM events"

ORACLE.update({
    "publish_new": PUBLISH_NEW,
    "publish_first": PUBLISH_FIRST,
    "publish_new_composite": PUBLISH_NEW_COMPOSITE,
    "wap_publish": WAP_PUBLISH,
    "wap_gate_fail": WAP_GATE_FAIL,
    "archive_failures": ARCHIVE_FAILURES,
    "enrich_costs": ENRICH_COSTS,
    "cost_ratio": COST_RATIO,
    "resolve_schema": RESOLVE_SCHEMA,
    "select_by_position": SELECT_BY_POSITION,
    "clean_rows": CLEAN_ROWS,
    "one_hot": ONE_HOT,
    "bin_column": BIN_COLUMN,
    "flag_equals": FLAG_EQUALS,
    "with_load_date": WITH_LOAD_DATE,
})


# ----------------------------------------------------------------------------- model evaluation

STRATIFIED_SPLIT = """
WITH h AS (SELECT *, md5(concat_ws('|', doc_id, '55')) AS h FROM labels),
n AS (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality),
r AS (SELECT h.*, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS rn FROM h)
SELECT r.doc_id, r.quality, r.toxic, CASE WHEN rn <= CEIL(n.n * 0.2) THEN 'test' ELSE 'train' END AS split
FROM r JOIN n ON r.quality = n.quality
"""

_SCORED = """x AS (SELECT l.quality AS y, d.lang AS lang, CAST(d.n_chars AS DOUBLE) / (d.n_chars + 5000.0) AS score,
  CASE WHEN CAST(d.n_chars AS DOUBLE) / (d.n_chars + 5000.0) > 0.5 THEN 1 ELSE 0 END AS yhat
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

CONFUSION = f"""WITH {_SCORED}
SELECT COUNT_IF(y = 1 AND yhat = 1) AS tp, COUNT_IF(y = 0 AND yhat = 1) AS fp,
       COUNT_IF(y = 0 AND yhat = 0) AS tn, COUNT_IF(y = 1 AND yhat = 0) AS fn FROM x"""

CLASSIFICATION_REPORT = f"""WITH {_SCORED},
c AS (SELECT CAST(COUNT_IF(y = 1 AND yhat = 1) AS DOUBLE) AS tp, CAST(COUNT_IF(y = 0 AND yhat = 1) AS DOUBLE) AS fp,
             CAST(COUNT_IF(y = 0 AND yhat = 0) AS DOUBLE) AS tn, CAST(COUNT_IF(y = 1 AND yhat = 0) AS DOUBLE) AS fn FROM x),
m AS (SELECT *,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
  CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
  tp + fn AS s1, tn + fp AS s0, tp + fn + tn + fp AS n FROM c),
f AS (SELECT *, CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2.0 * p1 * r1 / (p1 + r1) END AS f1,
               CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2.0 * p0 * r0 / (p0 + r0) END AS f0 FROM m)
SELECT '0' AS class, ROUND(p0, 6) AS precision, ROUND(r0, 6) AS recall, ROUND(f0, 6) AS f1_score, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', ROUND(p1, 6), ROUND(r1, 6), ROUND(f1, 6), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', ROUND((p0 + p1) / 2, 6), ROUND((r0 + r1) / 2, 6), ROUND((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', ROUND(CASE WHEN n = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / n END, 6),
  ROUND(CASE WHEN n = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / n END, 6),
  ROUND(CASE WHEN n = 0 THEN 0.0 ELSE (f0 * s0 + f1 * s1) / n END, 6), CAST(n AS BIGINT) FROM f
"""

_ROC_CUM = f"""WITH {_SCORED},
g AS (SELECT score AS threshold, COUNT_IF(y = 1) AS pos, COUNT_IF(y <> 1) AS neg FROM x GROUP BY score),
c AS (SELECT threshold, pos, neg,
        SUM(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
        SUM(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
        SUM(pos) OVER () AS p_all, SUM(neg) OVER () AS n_all FROM g)"""

ROC_POINTS = _ROC_CUM + """
SELECT threshold, ROUND(CASE WHEN p_all = 0 THEN NULL ELSE cum_pos / CAST(p_all AS DOUBLE) END, 6) AS tpr,
       ROUND(CASE WHEN n_all = 0 THEN NULL ELSE cum_neg / CAST(n_all AS DOUBLE) END, 6) AS fpr FROM c
"""

AUC = _ROC_CUM + """
SELECT ROUND(SUM(CAST(neg AS DOUBLE) * (2.0 * cum_pos - pos)) / NULLIF(2.0 * SUM(pos) * SUM(neg), 0), 6) AS auc FROM c
"""

BEST_RUN = f"""WITH {_SCORED},
g AS (SELECT lang AS run_id, COUNT_IF(y = 1 AND yhat = 1) AS tp, COUNT_IF(y = 1) AS p,
             COUNT_IF(y = 0 AND yhat = 0) AS tn, COUNT_IF(y = 0) AS n FROM x GROUP BY lang),
r AS (SELECT run_id,
        ROUND((CAST(tp AS DOUBLE) / NULLIF(p, 0) + CAST(tn AS DOUBLE) / NULLIF(n, 0)) / 2, 6) AS auc,
        ROUND(CAST(tp + tn AS DOUBLE) / NULLIF(p + n, 0), 6) AS accuracy FROM g)
SELECT run_id, auc, accuracy FROM r ORDER BY auc DESC NULLS LAST, accuracy DESC NULLS LAST, run_id ASC LIMIT 1
"""

ORACLE.update({
    "stratified_split": STRATIFIED_SPLIT,
    "confusion": CONFUSION,
    "classification_report": CLASSIFICATION_REPORT,
    "roc_points": ROC_POINTS,
    "auc": AUC,
    "best_run": BEST_RUN,
})


# ----------------------------------------------------------------------------- more operators of the inventory

METRIC_BY_DATE = """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, COUNT(*) AS n_events, ROUND(AVG(value), 6) AS avg_value
FROM events
WHERE (ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00')
   OR (ts >= TIMESTAMP '2024-01-20 00:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00')
GROUP BY CAST(ts AS DATE)
"""

VALUE_SET = "SELECT o_orderpriority AS value, COUNT(*) AS n FROM orders GROUP BY o_orderpriority"

UNEXPECTED_VALUES = """
SELECT c_nationkey AS value, COUNT(*) AS n FROM customer
WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9)
GROUP BY c_nationkey
"""

_BATCH_AGG = """b AS (SELECT l_returnflag, COUNT(*) AS n,
  MIN(l_quantity) AS q_min, MAX(l_quantity) AS q_max, MAX(l_discount) AS d_max,
  MIN(CASE WHEN l_tax <= 0.08 THEN 1 ELSE 0 END) AS t_v, COUNT_IF(NOT COALESCE(l_tax <= 0.08, FALSE)) AS t_f,
  COUNT(*) > 15000 AS big
  FROM lineitem GROUP BY l_returnflag),
bd AS (SELECT l_returnflag, COUNT(*) AS n, COUNT(DISTINCT l_orderkey) AS v FROM lineitem GROUP BY l_returnflag)"""


def _by_flag(sql_select):
    return sql_select.replace("SELECT ", "SELECT l_returnflag, ", 1)


RUN_CHECKS_BY_BATCH = f"WITH {_BATCH_AGG}\n" + _union(
    _by_flag(_row("lineitem_by_flag", "l_quantity_min", "column", "l_quantity", "min", "geq_to", "1", "q_min", "n",
                  "NULL", "q_min >= 1", "b")),
    _by_flag(_row("lineitem_by_flag", "l_quantity_max", "column", "l_quantity", "max", "leq_to", "50", "q_max", "n",
                  "NULL", "q_max <= 50", "b")),
    _by_flag(_row("lineitem_by_flag", "l_discount_max", "column", "l_discount", "max", "leq_to", "0.1", "d_max", "n",
                  "NULL", "d_max <= 0.1", "b")),
    _by_flag(_row("lineitem_by_flag", "l_orderkey_distinct_check", "column", "l_orderkey", "distinct_check", "geq_to",
                  "1000", "v", "n", "NULL", "v >= 1000", "bd")),
    _by_flag(_row("lineitem_by_flag", "tax_cap", "table", None, "row_rule", None, "l_tax <= 0.08", "t_v", "n", "t_f",
                  "t_v = 1", "b")),
    _by_flag(_row("lineitem_by_flag", "many_rows", "table", None, "aggregate_rule", None, "COUNT(*) > 15000",
                  "CAST(big AS INT)", "n", "NULL", "big", "b")),
)


def _tier(tier, sql_select):
    return f"SELECT *, '{tier}' AS tier FROM ({sql_select})"


def _warn_rows(suite="orders.warn"):
    return [
        _row(suite, "expect_table_row_count_to_be_between", "table", None, "row_count", "between",
             _kw(min_value=20000, max_value=30000), "n", "n", "NULL", "n >= 20000 AND n <= 30000", "w"),
        _row(suite, "expect_column_values_to_be_between", "column", "o_totalprice", "between", "mostly",
             _kw(column="o_totalprice", min_value=1000, max_value=400000, mostly=0.99), _share("p_nn - p_bad", "p_nn"),
             "n", "p_bad", _mostly("p_nn - p_bad", "p_nn", 0.99), "w"),
        _row(suite, "expect_column_values_to_be_in_set", "column", "o_orderstatus", "in_set", "mostly",
             _kw(column="o_orderstatus", value_set=["F", "O"], mostly=0.9), _share("s_nn - s_bad", "s_nn"), "n",
             "s_bad", _mostly("s_nn - s_bad", "s_nn", 0.9), "w"),
    ]


VALIDATE_TIERS = f"WITH {_ORDERS_PASS_AGG}, {_WARN_AGG}\n" + _union(
    *[_tier("warning", r) for r in _warn_rows()], *[_tier("failure", r) for r in _orders_pass_rows()]
)

_COPIES = {"lineitem_vs_copy": "tgt", "lineitem_vs_shifted": "shifted", "lineitem_vs_itself": "src"}
COMPARE_FINGERPRINTS = f"WITH {_DRIFT},\n" + ",\n".join(
    f"x{i} AS (SELECT (SELECT COUNT(*) FROM src) AS na, (SELECT COUNT(*) FROM {t}) AS nb, "
    f"NOT EXISTS (SELECT * FROM (SELECT * FROM src EXCEPT ALL SELECT * FROM {t})) AS same)"
    for i, t in enumerate(_COPIES.values())) + "\n" + _union(*[
        _row(None, name, "integrity", None, "fingerprint", "equal_to", None, "nb", "na", "ABS(na - nb)", "na = nb AND same", f"x{i}")
        for i, name in enumerate(_COPIES)])

CSV_HEADER_TS = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, event_type FROM events"

LIST_BATCHES = f"""
WITH e AS (SELECT event_type AS batch_type, COUNT(*) AS n,
  COUNT_IF(value IS NOT NULL AND NOT (value >= 0 AND value <= 400)) AS v_bad, COUNT(value) AS v_nn
  FROM events GROUP BY event_type)
""" + _union(
    _row("events.by_type", "expect_table_row_count_to_be_between", "table", None, "row_count", "between",
         _kw(min_value=100, max_value=100000000), "n", "n", "NULL", "n >= 100 AND n <= 100000000", "e"
         ).replace("SELECT ", "SELECT batch_type, ", 1),
    _row("events.by_type", "expect_column_values_to_be_between", "column", "value", "between", "mostly",
         _kw(column="value", min_value=0, max_value=400, mostly=0.9), _share("v_nn - v_bad", "v_nn"), "n", "v_bad",
         _mostly("v_nn - v_bad", "v_nn", 0.9), "e").replace("SELECT ", "SELECT batch_type, ", 1),
)

UNION_NEW = """
WITH d AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < DATE '1998-01-01'),
n AS (SELECT o_orderkey, o_orderstatus FROM orders s WHERE s.o_orderdate >= DATE '1997-01-01'
      AND NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = s.o_orderkey)),
f AS (SELECT * FROM d UNION ALL SELECT * FROM n)
SELECT o_orderstatus, COUNT(*) AS n_rows FROM f GROUP BY o_orderstatus
"""

DEDUPE = "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem"

ORACLE.update({
    "metric_by_date": METRIC_BY_DATE,
    "value_set": VALUE_SET,
    "unexpected_values": UNEXPECTED_VALUES,
    "run_checks_by_batch": RUN_CHECKS_BY_BATCH,
    "validate_tiers": VALIDATE_TIERS,
    "compare_fingerprints": COMPARE_FINGERPRINTS,
    "csv_header_ts": CSV_HEADER_TS,
    "list_batches": LIST_BATCHES,
    "union_new": UNION_NEW,
    "dedupe": DEDUPE,
})


# ----------------------------------------------------------------------------- streaming

_STREAM_AGG = """s AS (SELECT 'events.parquet' AS _file, COUNT(*) AS n, COUNT(user_id) AS u_nn,
  COUNT_IF(value IS NOT NULL AND NOT (value >= 0 AND value <= 500)) AS v_bad, COUNT(value) AS v_nn,
  COUNT_IF(event_type IS NOT NULL AND event_type NOT IN ('click', 'view', 'purchase', 'signup')) AS t_bad,
  COUNT(event_type) AS t_nn FROM events)"""


def _stream(sql_select):
    return sql_select.replace("SELECT ", "SELECT _file, ", 1)


STREAM_VALIDATE = f"WITH {_STREAM_AGG}\nSELECT *, CAST(0 AS BIGINT) AS batch_id FROM (\n" + _union(
    _stream(_row("events.stream", "expect_table_row_count_to_be_between", "table", None, "row_count", "between",
                 _kw(min_value=1, max_value=1000000000), "n", "n", "NULL", "n >= 1 AND n <= 1000000000", "s")),
    _stream(_row("events.stream", "expect_column_values_to_not_be_null", "column", "user_id", "not_null", "mostly",
                 _kw(column="user_id"), _share("u_nn", "n"), "n", "n - u_nn", "(n - u_nn) = 0", "s")),
    _stream(_row("events.stream", "expect_column_values_to_be_between", "column", "value", "between", "mostly",
                 _kw(column="value", min_value=0, max_value=500), _share("v_nn - v_bad", "v_nn"), "n", "v_bad",
                 "v_bad = 0", "s")),
    _stream(_row("events.stream", "expect_column_values_to_be_in_set", "column", "event_type", "in_set", "mostly",
                 _kw(column="event_type", value_set=["click", "view", "purchase", "signup"], mostly=0.75),
                 _share("t_nn - t_bad", "t_nn"), "n", "t_bad", _mostly("t_nn - t_bad", "t_nn", 0.75), "s")),
) + "\n)"

ORACLE["stream_validate"] = STREAM_VALIDATE


# ----------------------------------------------------------------------------- more pipelines and integrity

_INV = [("value_is_price_plus_balance", "total_value = o_totalprice + COALESCE(c_acctbal, 0.0)"),
        ("price_positive", "o_totalprice > 0")]
INVARIANT_CHECK = (
    "WITH e AS (SELECT o_totalprice, c_acctbal, o_totalprice + COALESCE(c_acctbal, 0.0) AS total_value "
    "FROM orders LEFT JOIN customer ON c_custkey = o_custkey), r AS (SELECT COUNT(*) AS n, "
    + ", ".join(f"MIN(CASE WHEN {r} THEN 1 ELSE 0 END) AS v{i}, COUNT_IF(NOT COALESCE({r}, FALSE)) AS f{i}"
                for i, (_, r) in enumerate(_INV))
    + " FROM e)\n"
    + _union(*[_row("orders_invariants", n, "table", None, "row_rule", None, r, f"v{i}", "n", f"f{i}", f"v{i} = 1", "r")
               for i, (n, r) in enumerate(_INV)])
)

NO_LOAD_ERRORS = """
WITH g AS (SELECT COUNT(*) AS n,
  COUNT_IF(l_linenumber = 7 OR (l_linenumber = 3 AND l_returnflag = 'A') OR (l_linenumber = 2 AND l_returnflag = 'N')
           OR (l_linenumber = 6 AND l_returnflag = 'R')) AS e
  FROM lineitem WHERE l_returnflag = 'R')
""" + _row(None, "group_R_loaded_cleanly", "integrity", None, "load_errors", "equal_to", "0", "e", "n", "e", "e = 0", "g")

MULTI_TABLE_TRANSFORM = """
SELECT o_custkey, o_orderkey, o_totalprice, c_acctbal, o_totalprice + COALESCE(c_acctbal, 0.0) AS total_cost,
       o_totalprice / NULLIF(c_acctbal, 0) AS price_per_balance
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
"""

ORACLE.update({
    "invariant_check": INVARIANT_CHECK,
    "no_load_errors": NO_LOAD_ERRORS,
    "multi_table_transform": MULTI_TABLE_TRANSFORM,
})
