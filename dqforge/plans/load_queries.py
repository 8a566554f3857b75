"""Driver queries of loads, commits, audits, check state and the pipelines, each with its DuckDB SQL beside it.

Every query derives its files, tables and faults from the given tables by key rules, so its work grows with them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F

from ..operators import checks as C
from ..operators import commit as K
from ..operators import evaluate as EV
from ..operators import expectations as E
from ..operators import integrity as I
from ..operators import prep as PR
from ..operators.audit import audited_write
from ..operators.state import SKETCH_ERROR, CheckState, update_verdicts
from ..session import scratch_path
from ..sources import files as FS
from ..sources import tables as TB
from ..sources.batches import Batch
from ..sources.rejects import rejected_rows
from ..sources.tables import materialize, read_table as T
from . import pipelines as PL

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        name = f.__name__.removeprefix("q_")
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return register


# --------------------------------------------------------------------------- files: checksums, rejects, loads

#: Files that the documents are written to, and bytes of a part of theirs.
FILES, PART = 8, 65_536


def _write_files(lines: DataFrame, n: int, order: list[str], out: str) -> None:
    """``value`` in that order as ``n`` text files by ``g``, each by a task of its own (by a hash of ``g`` some tasks get several)."""
    dealt = lines.repartitionById(n, F.pmod(F.col("g"), F.lit(n)).cast("int"))
    dealt.sortWithinPartitions("g", *order).select("g", "value").write.partitionBy("g").text(out)


@query(f"""
WITH c AS (
  SELECT doc_id % {FILES} AS g, string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id, text) AS body FROM documents GROUP BY 1),
h AS (SELECT g, strlen(body) AS bytes, md5(body) AS m, hex(encode(body)) AS x FROM c),
p AS (
  SELECT g, i, md5(unhex(substr(x, i * {2 * PART} + 1, {2 * PART}))) AS m
  FROM (SELECT g, x, unnest(range(greatest(1, (bytes + {PART - 1}) // {PART}))) AS i FROM h)),
e AS (SELECT g, md5(unhex(string_agg(m, '' ORDER BY i))) || '-' || count(*) AS etag FROM p GROUP BY g),
s AS (SELECT h.g, m, CASE WHEN h.g % 2 = 0 THEN etag ELSE m END AS own FROM h JOIN e ON e.g = h.g)
SELECT g::VARCHAR AS file_name, own AS computed, CASE WHEN g = 3 THEN reverse(m) ELSE own END AS expected,
       CASE WHEN g = 3 AND reverse(m) <> m THEN 'mismatch' ELSE 'ok' END AS status FROM s WHERE g <> 5
UNION ALL SELECT '5', m, NULL, 'not_in_manifest' FROM s WHERE g = 5
UNION ALL SELECT '{FILES + 1}', NULL, repeat('0', 32), 'missing_file'
""")
def q_manifest_check(spark, sf_dir):
    """All texts of the documents as files; a manifest with multipart entries (even files), a wrong, a missing and an unknown one."""
    out = scratch_path(spark, "manifest")
    docs = T(spark, sf_dir, "documents").select((F.col("doc_id") % FILES).alias("g"), "doc_id", F.coalesce("text", F.lit("")).alias("value"))
    _write_files(docs, FILES, ["doc_id", "value"], out)
    sums = materialize(I.file_checksums(spark, out, glob="*.txt", recursive=True, part_bytes=PART, name_pattern=r"g=(\d+)/"), name="sums")
    g = F.col("file_name").cast("int")
    stored = sums.select("file_name", F.when(g % 2 == 0, F.concat(F.lit('"'), "etag", F.lit('"'))).when(g == 3, F.reverse("md5")).otherwise(F.col("md5")).alias("md5"))
    unknown = spark.range(1).select(F.lit(str(FILES + 1)).alias("file_name"), F.lit("0" * 32).alias("md5"))
    return I.verify_manifest(sums, stored.where(g != 5).unionByName(unknown))


REJECT_SCHEMA = "l_orderkey bigint, l_linenumber int, note string, l_quantity decimal(12,2), l_shipdate date"
REJECT_FILES = 16


def _faulty_lines(li: DataFrame) -> DataFrame:
    """lineitem as CSV lines by file ``g``; faults and quoted separators follow line number and flag."""
    ln, rf = F.col("l_linenumber"), F.col("l_returnflag")
    quoted = (ln == 4) | ((ln == 5) & (rf == "N"))
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    fields = [
        F.col("l_orderkey").cast("string"), ln.cast("string"), F.when(quoted, F.lit('"a\\"b,c"')).otherwise(F.lit("x")),
        F.when((ln == 7) | ((ln == 3) & (rf == "A")), F.lit("n/a")).otherwise(F.col("l_quantity").cast("decimal(12,2)").cast("string")),
        F.when((ln == 2) & (rf == "N"), F.lit("2024-13-45")).when((ln == 1) & (rf == "R"), F.lit("")).when((ln == 6) & (rf == "A"), F.concat(F.lit('"'), day)).otherwise(day),
    ]
    line = (F.when((ln == 6) & (rf == "R"), F.concat_ws(",", *fields, F.lit("extra"))).when((ln == 5) & (rf == "N"), F.concat_ws(",", *fields[:-1]))
            .otherwise(F.concat_ws(",", *fields)))
    return li.select((F.col("l_orderkey") % REJECT_FILES).alias("g"), "l_orderkey", "l_linenumber", line.alias("value"))


_FAULTY_SQL = f"""
f AS (
  SELECT l_orderkey, l_linenumber AS ln, l_returnflag AS rf, l_orderkey % {REJECT_FILES} AS g, l_orderkey::VARCHAR AS a, l_linenumber::VARCHAR AS b,
         CASE WHEN l_linenumber = 4 OR (l_linenumber = 5 AND l_returnflag = 'N') THEN '"a\\"b,c"' ELSE 'x' END AS c,
         CASE WHEN l_linenumber = 7 OR (l_linenumber = 3 AND l_returnflag = 'A') THEN 'n/a' ELSE l_quantity::DECIMAL(12,2)::VARCHAR END AS d,
         strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem),
l AS (
  SELECT g, l_orderkey, ln, rf, d, a || ',' || b || ',' || c || ',' || d || CASE
           WHEN ln = 5 AND rf = 'N' THEN '' WHEN ln = 2 AND rf = 'N' THEN ',2024-13-45' WHEN ln = 1 AND rf = 'R' THEN ','
           WHEN ln = 6 AND rf = 'A' THEN ',"' || day WHEN ln = 6 AND rf = 'R' THEN ',' || day || ',extra' ELSE ',' || day END AS raw_line FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY l_orderkey, ln, raw_line) AS line_number FROM l)"""


@query(f"""
WITH {_FAULTY_SQL},
p AS (
  SELECT g, line_number, raw_line, NULL AS column_name, 'too_many_fields' AS reason, NULL AS token FROM n WHERE ln = 6 AND rf = 'R'
  UNION ALL SELECT g, line_number, raw_line, NULL, 'short_row', NULL FROM n WHERE ln = 5 AND rf = 'N'
  UNION ALL SELECT g, line_number, raw_line, NULL, 'unterminated_quote', NULL FROM n WHERE ln = 6 AND rf = 'A'
  UNION ALL SELECT g, line_number, raw_line, 'l_quantity', 'not_castable', 'n/a' FROM n WHERE d = 'n/a'
  UNION ALL SELECT g, line_number, raw_line, 'l_shipdate', 'not_castable', '2024-13-45' FROM n WHERE ln = 2 AND rf = 'N'
  UNION ALL SELECT g, line_number, raw_line, 'l_shipdate', 'null_in_required', NULL FROM n WHERE ln = 1 AND rf = 'R')
SELECT g::INTEGER AS g, line_number, column_name, reason, token, raw_line FROM p
""")
def q_rejected_rows(spark, sf_dir):
    """Reject records of all line items as CSV files: short, long and unclosed lines, bad numbers and dates, missing required dates."""
    out = scratch_path(spark, "rejected")
    lines = _faulty_lines(T(spark, sf_dir, "lineitem"))
    _write_files(lines, REJECT_FILES, ["l_orderkey", "l_linenumber", "value"], out)
    found = rejected_rows(spark, out, REJECT_SCHEMA, allow_jagged=False, required=["l_shipdate"])
    g = F.regexp_extract("path", r"g=(\d+)/", 1).cast("int")
    return found.select(g.alias("g"), "line_number", "column_name", "reason", "token", "raw_line")


def _own_table(spark, name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


@query(f"""
WITH {_FAULTY_SQL},
k AS (SELECT * FROM n WHERE NOT (ln = 6 AND rf = 'R') AND d <> 'n/a' AND NOT (ln = 2 AND rf = 'N'))
SELECT 'l_orderkey_null_check' AS check_name, count(*) AS n_rows, 0::BIGINT AS n_failed, true AS passed FROM k
UNION ALL SELECT 'l_shipdate_null_check', count(*), count(*) FILTER ((ln = 1 AND rf = 'R') OR (ln = 5 AND rf = 'N')),
                 count(*) FILTER ((ln = 1 AND rf = 'R') OR (ln = 5 AND rf = 'N')) = 0 FROM k
""")
def q_load_required(spark, sf_dir):
    """A jagged load into a clustered catalog table, then the null checks of its required columns."""
    out, table = scratch_path(spark, "load-required"), _own_table(spark, "load_required")
    _faulty_lines(T(spark, sf_dir, "lineitem")).select("value").write.text(out)
    rows = FS.clean_rows(FS.load_csv_checked(spark, out, REJECT_SCHEMA))
    TB.create_table(spark, table, REJECT_SCHEMA, location=scratch_path(spark, "load-table"), cluster_by=["l_shipdate"])
    try:
        verdicts = materialize(FS.load(rows, table, required=["l_orderkey", "l_shipdate"]), name="required")
    finally:
        TB.drop_table(spark, table)
    return verdicts.select("check_name", "n_rows", "n_failed", "passed")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate::DATE AS o_orderdate FROM orders")
def q_stage_read(spark, sf_dir):
    """Orders through a named stage of headerless, pipe-separated files."""
    out = scratch_path(spark, "stage")
    T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date")).write.option("sep", "|").csv(out)
    stage = FS.Stage(out, options={"sep": "|", "header": "false"})
    return stage.read(spark, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate date")


@query("SELECT c_custkey, c_mktsegment, c_nationkey FROM customer")
def q_headerless_csv(spark, sf_dir):
    """Customers written and read as headerless typed CSV."""
    out = scratch_path(spark, "headerless")
    T(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey").write.csv(out)
    return FS.read_csv(spark, out, "c_custkey bigint, c_mktsegment string, c_nationkey int")


# --------------------------------------------------------------------------- catalog tables, batches, stores

@query("""
SELECT 'exists_before' AS step, 0::BIGINT AS n UNION ALL SELECT 'created', 1 UNION ALL SELECT 'rows', count(*) FROM orders
UNION ALL SELECT 'open_rows', count(*) FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'replaced_rows', 0 UNION ALL SELECT 'exists_after', 0
""")
def q_table_lifecycle(spark, sf_dir):
    """A database and a table: create, fill and ask by statements, replace, drop."""
    db = _own_table(spark, "life")
    table, steps = f"{db}.orders", []
    source = T(spark, sf_dir, "orders")
    TB.create_db(spark, db)
    try:
        steps.append(("exists_before", int(TB.table_exists(spark, table))))
        TB.create_table(spark, table, source.schema, location=scratch_path(spark, "life"))
        steps.append(("created", int(TB.table_exists(spark, table))))
        source.write.insertInto(table)
        found = TB.run_sql(spark, ["SELECT 1;", "SELECT count(*) AS n, count_if(o_orderstatus = :s) AS o FROM IDENTIFIER(:t)"], {"t": table, "s": "O"}).first()
        steps += [("rows", found["n"]), ("open_rows", found["o"])]
        TB.create_table(spark, table, source.schema, replace=True, location=scratch_path(spark, "life-again"))
        steps.append(("replaced_rows", spark.table(table).count()))
        TB.drop_table(spark, table)
        steps.append(("exists_after", int(TB.table_exists(spark, table))))
    finally:
        TB.drop_db(spark, db)
    return spark.createDataFrame(steps, "step string, n long")


_BATCH_SUITE = {"expectation_suite_name": "batch", "expectations": [
    {"expectation_type": E.NOT_NULL, "kwargs": {"column": "o_orderkey"}},
    {"expectation_type": E.IN_SET, "kwargs": {"column": "o_orderstatus", "value_set": ["F", "O"]}}]}


@query("""
WITH b AS (
  SELECT 'frame' AS batch_id, o_orderstatus AS s FROM orders UNION ALL SELECT 'query', o_orderstatus FROM orders WHERE o_totalprice > 100000
  UNION ALL SELECT 'table', o_orderstatus FROM orders),
n AS (SELECT batch_id, count(*) AS n_rows, count(*) FILTER (s NOT IN ('F', 'O')) AS bad FROM b GROUP BY 1
      UNION ALL SELECT 'limited', least(100, count(*)), NULL FROM orders UNION ALL SELECT 'empty', 0, 0)
SELECT batch_id, 'not_null' AS kind, n_rows, 0::BIGINT AS n_failed, true AS passed FROM n
UNION ALL SELECT batch_id, 'in_set', n_rows, bad, bad = 0 FROM n WHERE batch_id <> 'limited'
""")
def q_checkpoint_batches(spark, sf_dir):
    """One suite over batches of every kind: a frame, a query, a table, a limited and an empty one."""
    orders = T(spark, sf_dir, "orders")
    path = scratch_path(spark, "batch-table")
    orders.write.parquet(path)
    view = _own_table(spark, "batch_view")
    orders.createOrReplaceTempView(view)
    try:
        chosen = Batch.from_sql(spark, f"SELECT * FROM {view} WHERE o_totalprice > :p", "query", {"p": 100000})
        batches = [Batch.from_df(orders, "frame"), chosen, Batch.from_table(spark, path, "table"), Batch.from_df(orders.limit(0), "empty")]
        small = Batch.from_table(spark, path, "limited").limit(100)
        small.batch_id = "limited"
        res = materialize(E.Checkpoint("batches", E.load_suite(_BATCH_SUITE), [*batches, small]).run(), name="batches")
    finally:
        spark.catalog.dropTempView(view)
    kind = F.when(F.col("metric").isNotNull(), F.col("metric")).otherwise(F.col("check_name"))
    res = res.select("batch_id", kind.alias("kind"), "n_rows", "n_failed", "passed")
    # which 100 rows a limit takes is arbitrary: only what every choice gives is compared
    return res.where((F.col("batch_id") != "limited") | F.col("kind").contains("null"))


@query("""
SELECT r.run, v.check_name, count(*) AS n, bool_and(v.passed) AS passed
FROM (VALUES ('one'), ('two')) r(run),
     (SELECT 'price_positive' AS check_name, min(o_totalprice) > 0 AS passed FROM orders
      UNION ALL SELECT 'status_known', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) = 0 FROM orders) v
GROUP BY 1, 2
""")
def q_verdict_store(spark, sf_dir):
    """Verdicts of two runs appended to a store and read back."""
    store, orders = scratch_path(spark, "verdicts"), T(spark, sf_dir, "orders")
    rules = {"price_positive": "o_totalprice > 0", "status_known": "o_orderstatus IN ('F', 'O')"}
    for run in ("one", "two"):
        TB.store_results(C.row_rules(orders, rules, suite="orders"), store, run_id=run)
    return spark.read.parquet(store).groupBy(F.col("run_id").alias("run"), "check_name").agg(F.count(F.lit(1)).alias("n"), F.every("passed").alias("passed"))


@query("""
SELECT v.code, v.label, count(o_orderkey) AS n_orders FROM (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending'), ('X', 'unknown')) v(code, label)
LEFT JOIN orders ON o_orderstatus = v.code GROUP BY 1, 2
""")
def q_literal_rows(spark, sf_dir):
    """Literal rows joined with all orders."""
    names = FS.from_rows(spark, [("F", "finished"), ("O", "open"), ("P", "pending"), ("X", "unknown")], "code string, label string")
    counts = T(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("code")).agg(F.count("o_orderkey").alias("n"))
    return names.join(counts, "code", "left").select("code", "label", F.coalesce("n", F.lit(0)).alias("n_orders"))


# --------------------------------------------------------------------------- commits and audits

D1997, D1998 = dt.date(1997, 1, 1), dt.date(1998, 1, 1)


@query("""
SELECT CASE WHEN o_orderdate < DATE '1998-01-01' AND o_orderkey % 7 <> 0 THEN 'first' ELSE 'second' END AS run_id, o_orderstatus, count(*) AS n_rows,
       count(*) FILTER (o_orderkey % 7 = 0) AS n_null_keys
FROM orders WHERE o_orderdate < DATE '1998-01-01' AND o_orderkey % 7 <> 0 OR o_orderdate >= DATE '1997-01-01'
GROUP BY 1, 2
""")
def q_publish_runs(spark, sf_dir):
    """Two runs with overlapping orders, the second tried three times; every seventh key of it is NULL and stays single."""
    table = _own_table(spark, "published")
    o = T(spark, sf_dir, "orders")
    seventh = F.col("o_orderkey") % 7 == 0
    first = o.where((F.col("o_orderdate") < F.lit(D1998)) & ~seventh)
    second = o.where(F.col("o_orderdate") >= F.lit(D1997)).withColumn("o_orderkey", F.when(~seventh, F.col("o_orderkey")))
    try:
        K.publish_run(first, table, ["o_orderkey"], "first", location=scratch_path(spark, "published"))
        K.publish_run(second.where("o_orderstatus = 'O'"), table, ["o_orderkey"], "second")
        for _ in range(2):
            K.publish_run(second, table, ["o_orderkey"], "second")
        out = spark.table(table).groupBy("run_id", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("o_orderkey").isNull()).alias("n_null_keys"))
        return materialize(out, name="published-counts")
    finally:
        TB.drop_table(spark, table)


@query("""
WITH v AS (
  SELECT 'o_orderkey_null_check' AS check_name, 0.0::DOUBLE AS observed, 0::BIGINT AS n_failed, true AS passed
  UNION ALL SELECT 'o_totalprice_max', round(max(o_totalprice), 6), NULL, max(o_totalprice) <= 1000000000 FROM orders
  UNION ALL SELECT 'o_orderstatus_distinct_check', count(DISTINCT o_orderstatus), NULL, count(DISTINCT o_orderstatus) <= 3 FROM orders
  UNION ALL SELECT 'priced', CASE WHEN min(o_totalprice) > 0 THEN 1 ELSE 0 END, count(*) FILTER (NOT o_totalprice > 0), min(o_totalprice) > 0 FROM orders
  UNION ALL SELECT 'some_rows', 1, NULL, true
  UNION ALL SELECT 'many_custs', (count(DISTINCT o_custkey) > 10)::INT, NULL, count(DISTINCT o_custkey) > 10 FROM orders)
SELECT check_name, observed::DOUBLE AS observed, (SELECT count(*) FROM orders) AS n_rows, n_failed, passed FROM v
UNION ALL SELECT 'published', count(*), count(*), NULL, true FROM orders
""")
def q_audit_commit(spark, sf_dir):
    """Orders audited while they are written and published as one commit."""
    table = _own_table(spark, "audited")
    column = {"o_orderkey": {"null_check": {"equal_to": 0}}, "o_totalprice": {"max": {"leq_to": 1000000000}}, "o_orderstatus": {"distinct_check": {"leq_to": 3}}}
    rules = {"priced": "o_totalprice > 0", "some_rows": "COUNT(*) > 0", "many_custs": "COUNT(DISTINCT o_custkey) > 10"}
    try:
        r = K.write_audit_commit(T(spark, sf_dir, "orders"), table, ["o_orderkey"], "run", column=column, rules=rules, on_fail="warn", location=scratch_path(spark, "audited"))
        n = spark.table(table).count()
    finally:
        TB.drop_table(spark, table)
    shown = r.results.select("check_name", "observed", "n_rows", "n_failed", "passed")
    return shown.unionByName(spark.range(1).select(F.lit("published").alias("check_name"), F.lit(float(n)).alias("observed"), F.lit(n).cast("long").alias("n_rows"),
                                                   F.lit(None).cast("long").alias("n_failed"), F.lit(r.passed).alias("passed")))


STATE_CHECKS = CheckState({"o_totalprice": {"min": {"geq_to": 0}, "max": {"leq_to": 300000}}, "o_custkey": {"null_check": {"equal_to": 0}, "distinct_check": {"geq_to": 1}}},
                          {"status_known": "o_orderstatus IN ('F', 'O')", "dated": "o_orderdate >= DATE '1990-01-01'"})


@query("""
WITH o AS (SELECT *, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS cust FROM orders),
v AS (
  SELECT 'o_totalprice_min' AS check_name, round(min(o_totalprice), 6) AS observed, NULL::BIGINT AS n_failed, min(o_totalprice) >= 0 AS passed FROM o
  UNION ALL SELECT 'o_totalprice_max', round(max(o_totalprice), 6), NULL, max(o_totalprice) <= 300000 FROM o
  UNION ALL SELECT 'o_custkey_null_check', count(*) FILTER (cust IS NULL), count(*) FILTER (cust IS NULL), count(*) FILTER (cust IS NULL) = 0 FROM o
  UNION ALL SELECT 'o_custkey_distinct_check', 1, NULL, true
  UNION ALL SELECT 'status_known', (count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) = 0)::INT, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')),
                   count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) = 0 FROM o
  UNION ALL SELECT 'dated', 1, 0, true)
SELECT check_name, observed::DOUBLE AS observed, (SELECT count(*) FROM o) AS n_rows, n_failed, passed FROM v
""")
def q_incremental_checks(spark, sf_dir):
    """Verdicts over all orders from the states of their years, recorded in three steps, one of them twice; the distinct count
    shows 1 when it is within five standard errors of the exact one."""
    store = scratch_path(spark, "state")
    o = T(spark, sf_dir, "orders").withColumn("o_custkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey"))).withColumn("year", F.year("o_orderdate"))
    for part in ("year < 1995", "year BETWEEN 1995 AND 1997", "year BETWEEN 1995 AND 1997", "year >= 1998 OR year IS NULL"):
        found = update_verdicts(STATE_CHECKS, o.where(part), store, ["year"])
    exact = o.agg(F.count_distinct("o_custkey")).scalar()
    near = (F.abs(F.col("observed") - exact) <= 5 * SKETCH_ERROR * exact + 0.5).cast("double")
    shown = F.when(F.col("metric") == "distinct_check", near).otherwise(F.col("observed"))
    return found.select("check_name", shown.alias("observed"), "n_rows", "n_failed", "passed")


@query("""
SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY 1
""")
def q_wap_mapped(spark, sf_dir):
    """Write-audit-publish with the rules of a config, onto the orders before 1997."""
    o, path = T(spark, sf_dir, "orders"), scratch_path(spark, "wap-mapped")
    o.where(F.col("o_orderdate") < F.lit(D1997)).write.parquet(path)
    config = {"column": [{"o_orderkey": {"null_check": {"equal_to": 0}}}], "table": [{"rows": {"check_statement": "COUNT(*) > 0"}}]}
    PL.mapped_write_audit_publish(o, path, ["o_orderkey"], config, on_fail="warn")
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < DATE '1997-01-01')
SELECT l_returnflag, count(*) AS n_rows FROM lineitem l
WHERE l_shipdate < DATE '1997-01-01' OR NOT EXISTS (SELECT 1 FROM d WHERE d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber)
GROUP BY 1
""")
def q_wap_suite(spark, sf_dir):
    """Write-audit-publish behind an expectation suite, on a composite key."""
    li, path = T(spark, sf_dir, "lineitem"), scratch_path(spark, "wap-suite")
    li.where(F.col("l_shipdate") < F.lit(D1997)).write.parquet(path)
    suite = {"expectations": [{"expectation_type": E.NOT_NULL, "kwargs": {"column": "l_orderkey"}},
                              {"expectation_type": E.VALUES_BETWEEN, "kwargs": {"column": "l_quantity", "min_value": 1, "max_value": 50}}]}
    PL.suite_write_audit_publish(li, path, ["l_orderkey", "l_linenumber"], suite, on_fail="warn")
    return spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------------- pipelines over files

DATED = {"late": "o_orderdate >= TIMESTAMP '1998-01-01'", "early": "o_orderdate < TIMESTAMP '1998-01-01'"}


@query("""
WITH n AS (SELECT count(*) FILTER (o_orderdate >= DATE '1998-01-01') AS a, count(*) FILTER (o_orderdate < DATE '1998-01-01') AS b FROM orders)
SELECT 'rows' AS suite, 'positive' AS check_name, (SELECT count(*) FILTER (NOT o_totalprice > 50000) FROM orders) AS n_failed,
       (SELECT min(o_totalprice) > 50000 FROM orders) AS passed
UNION ALL SELECT 'value', 'value_check', NULL, (SELECT count(*) FROM orders) = 100
UNION ALL SELECT 'threshold', 'threshold_check', NULL, (SELECT max(o_totalprice) BETWEEN 0 AND 1000000 FROM orders)
UNION ALL SELECT 'interval', 'interval_check', NULL, CASE WHEN a = 0 OR b = 0 THEN false ELSE greatest(a, b)::DOUBLE / least(a, b) <= 3 END FROM n
""")
def q_dated_files(spark, sf_dir):
    """Two folders of order files with load dates, checked as one table."""
    o, files = T(spark, sf_dir, "orders"), {}
    for name, where in DATED.items():
        files[name] = scratch_path(spark, f"dated-{name}")
        o.where(where).select("o_orderkey", "o_totalprice").write.option("header", True).csv(files[name])
    r = PL.dated_files_checks(spark, files, "o_orderkey bigint, o_totalprice double", "2024-01-02", {"positive": "o_totalprice > 50000"},
                              value=("COUNT(*)", 100), interval={"COUNT(*)": 3.0}, threshold=("MAX(o_totalprice)", 0, 1000000))
    return r.results.select("suite", "check_name", "n_failed", "passed")


@query("""
SELECT 'checksums' AS step, 0::BIGINT AS n_bad
UNION ALL SELECT 'load_errors', count(*) FROM customer WHERE c_custkey % 100 = 7
UNION ALL SELECT 'truth', (SELECT count(*) FROM customer WHERE c_custkey = 2 AND c_mktsegment <> 'NONE')
""")
def q_load_integrity(spark, sf_dir):
    """Customers as files: checksums against a manifest, load errors of the files, ground truth of a key."""
    out = scratch_path(spark, "integrity")
    c = T(spark, sf_dir, "customer")
    nation = F.when(F.col("c_custkey") % 100 == 7, F.lit("?")).otherwise(F.col("c_nationkey").cast("string"))
    c.select(F.concat_ws(",", "c_custkey", "c_mktsegment", nation).alias("value")).write.text(out)
    manifest = materialize(I.file_checksums(spark, out, glob="*.txt").select("file_name", "md5"), name="integrity-manifest")
    r = PL.load_with_integrity(spark, f"{out}/*.txt", manifest, "c_custkey bigint, c_mktsegment string, c_nationkey int", {2: {"c_mktsegment": "NONE"}}, "c_custkey", "part-")
    bad = r.details["checksums"].where("status <> 'ok'").select(F.lit("checksums").alias("step"), F.lit(1).alias("n"))
    counts = (bad.unionByName(r.results.select(F.lit("load_errors").alias("step"), F.col("n_failed").alias("n")))
              .unionByName(r.output.where(C.not_passed()).select(F.lit("truth").alias("step"), F.lit(1).alias("n"))))
    steps = FS.from_rows(spark, [("checksums",), ("load_errors",), ("truth",)], "step string")
    return steps.join(counts.groupBy("step").agg(F.sum("n").alias("n")), "step", "left").select("step", F.coalesce("n", F.lit(0)).cast("long").alias("n_bad"))


@query("""
WITH k AS (SELECT * FROM part WHERE p_partkey % 13 <> 0)
SELECT 'not_null' AS kind, count(*) AS n_rows, count(*) FILTER (p_partkey % 17 = 0) AS n_failed, count(*) FILTER (p_partkey % 17 = 0) = 0 AS passed FROM k
UNION ALL SELECT 'between', count(*), count(*) FILTER (p_partkey % 17 <> 0 AND NOT p_size BETWEEN 1 AND 40),
                 count(*) FILTER (p_partkey % 17 <> 0 AND NOT p_size BETWEEN 1 AND 40) = 0 FROM k
""")
def q_load_and_validate(spark, sf_dir):
    """Parts as jagged files, written to a table and validated: every 13th line has too many fields, every 17th has no size."""
    p, out = T(spark, sf_dir, "part"), scratch_path(spark, "validate")
    key = F.col("p_partkey")
    line = F.when(key % 13 == 0, F.concat_ws(",", "p_partkey", "p_brand", "p_size", F.lit("more"))).when(key % 17 == 0, F.concat_ws(",", "p_partkey", "p_brand"))
    p.select(F.coalesce(line, F.concat_ws(",", "p_partkey", "p_brand", "p_size")).alias("value")).write.text(out)
    suite = {"expectations": [{"expectation_type": E.NOT_NULL, "kwargs": {"column": "p_size"}},
                              {"expectation_type": E.VALUES_BETWEEN, "kwargs": {"column": "p_size", "min_value": 1, "max_value": 40}}]}
    r = PL.load_and_validate(spark, out, "p_partkey bigint, p_brand string, p_size int", suite, target=scratch_path(spark, "validated"), required=["p_partkey"])
    kind = F.when(F.col("metric").isNotNull(), F.col("metric")).otherwise(F.col("check_name"))
    return r.results.select(kind.alias("kind"), "n_rows", "n_failed", "passed")


# --------------------------------------------------------------------------- dates as text, categories, folds

@query("""
SELECT o_orderdate::DATE AS day, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderdate::DATE IN (DATE '1997-03-01', DATE '1997-03-02', DATE '1998-05-05') AND o_orderkey % 5 <> 0 GROUP BY 1
""")
def q_text_dates(spark, sf_dir):
    """Metrics by day over dates kept as text, a fifth of them malformed."""
    o = T(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    o = o.withColumn("day", F.when(F.col("o_orderkey") % 5 == 0, F.concat(text, F.lit("x"))).when(F.col("o_orderkey") % 5 == 1, F.concat(text, F.lit(" 10:00:00"))).otherwise(text))
    return C.metric_by_date(o, {"n": "COUNT(*)", "total": "ROUND(SUM(o_totalprice), 2)"}, "day", ["1997-03-01", "1997-03-02", "1998-05-05"])


@query("""
WITH v AS (SELECT c_name AS value, count(*) AS n_rows FROM customer WHERE c_custkey % 10 <> 0 GROUP BY 1)
SELECT value, row_number() OVER (ORDER BY value) - 1 AS index, n_rows FROM v
""")
def q_category_index(spark, sf_dir):
    """Places of a sparse one-hot vector for a column with as many values as rows, NULL every tenth row."""
    c = T(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("c_name"))
    counts = c.where("c_name IS NOT NULL").groupBy(F.col("c_name").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return PR.category_index(c, "c_name").join(counts, "value").select("value", "index", "n_rows")


@query("""
SELECT ('0x' || substr(md5(doc_id || '|55'), 1, 8))::BIGINT % 5 AS fold, count(*) AS n_rows, sum(quality)::BIGINT AS n_good FROM labels GROUP BY 1
""")
def q_folds(spark, sf_dir):
    """Cross-validation folds of all labelled rows, from their keys."""
    f = EV.with_folds(T(spark, sf_dir, "labels"), "doc_id", 5)
    return f.groupBy(F.col("fold").cast("long").alias("fold")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("quality").alias("n_good"))


# --------------------------------------------------------------------------- checks that nulls and blanks can fail

@query("""
WITH e AS (SELECT CASE WHEN event_id % 9 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 7 = 0 THEN ' ' || event_type || '  ' WHEN event_id % 11 <> 0 THEN event_type END AS event_type, value FROM events)
SELECT 'user_id_null_check' AS check_name, count(*) FILTER (user_id IS NULL)::DOUBLE AS observed, count(*) FILTER (user_id IS NULL) = 0 AS passed FROM e
UNION ALL SELECT 'event_type_null_check', count(*) FILTER (event_type IS NULL), count(*) FILTER (event_type IS NULL) = 0 FROM e
UNION ALL SELECT 'padded', count(*) FILTER (event_type <> trim(event_type)), count(*) FILTER (event_type <> trim(event_type)) = 0 FROM e
UNION ALL SELECT 'kept_rows', count(*), true FROM e WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL
""")
def q_null_checks(spark, sf_dir):
    """Null checks, trimming and dropping of NULL rows over events with NULLs and outer blanks."""
    key = F.col("event_id")
    e = T(spark, sf_dir, "events").select(
        F.when(key % 9 != 0, F.col("user_id")).alias("user_id"),
        F.when(key % 7 == 0, F.concat(F.lit(" "), "event_type", F.lit("  "))).when(key % 11 != 0, F.col("event_type")).alias("event_type"), "value")
    found = C.column_checks(e, {c: {"null_check": {"equal_to": 0}} for c in ("user_id", "event_type")}).select("check_name", "observed", "passed")
    padded = C.row_rules(e, {"padded": "event_type IS NULL OR event_type = trim(event_type)"}).select("check_name", F.col("n_failed").cast("double").alias("observed"), "passed")
    kept = PR.drop_null_rows(e).agg(F.count(F.lit(1)).cast("double").alias("observed")).select(F.lit("kept_rows").alias("check_name"), "observed", F.lit(True).alias("passed"))
    return found.unionByName(padded).unionByName(kept)


@query("""
SELECT 'audited' AS check_name, count(*) FILTER (l_orderkey % 10 = 3)::BIGINT AS n_failed, count(*) FILTER (l_orderkey % 10 = 3) = 0 AS passed FROM lineitem
""")
def q_invariant_broken(spark, sf_dir):
    """A total that should be the sum of its parts, a unit too high in a tenth of the orders, audited while written."""
    cents = F.col("l_extendedprice").cast("decimal(20,2)")
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", cents.alias("a"), F.col("l_quantity").cast("decimal(20,2)").alias("b"))
    li = li.withColumn("total", F.col("a") + F.col("b") + F.when(F.col("l_orderkey") % 10 == 3, F.lit(1)).otherwise(F.lit(0)))
    _, results = audited_write(li, scratch_path(spark, "invariant"), table={"audited": "a + b = total"})
    return results.select("check_name", "n_failed", "passed")
