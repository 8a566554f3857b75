"""Running totals over range partitions against a plain loop."""

import random

from pyspark.sql import functions as F

from dqforge.functions.running import running_sums, running_totals


def _loop(rows):
    total, seen, out = 0, {}, {}
    for k, o, v in sorted(rows, key=lambda r: (r[0] is not None, str(r[0]), r[1])):
        seen.setdefault(k, [0, 0, 0])
        s = seen[k]
        s[0] += v or 0
        s[1] ^= v or 0
        s[2] += 1
        out[o] = tuple(s)
    return out


def test_totals_by_key_with_a_hot_key(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None, "hot", "hot", "hot"]), i, rnd.choice([None, 0, 5, -3, 1 << 40])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(7)
    for parts in (1, 13):
        got = running_totals(df, ["k"], [F.col("o")], {"s": (F.col("v"), "sum"), "x": (F.col("v"), "xor"), "n": (F.lit(1), "sum")}, parts)
        assert got.columns == ["k", "o", "v", "s", "x", "n"]
        assert {r.o: (r.s, r.x, r.n) for r in got.collect()} == _loop(rows)


def test_small_batches_and_empty(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(k, i, i) for i, k in enumerate("aaaaaaaabbbbcccccccccccccd")]
        df = spark.createDataFrame(rows, "k string, o long, v long")
        got = running_totals(df, ["k"], [F.col("o")], {"s": (F.col("v"), "sum"), "x": (F.col("v"), "xor"), "n": (F.lit(1), "sum")}, 3)
        assert {r.o: (r.s, r.x, r.n) for r in got.collect()} == _loop(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert running_totals(df.limit(0), ["k"], [F.col("o")], {"s": (F.col("v"), "sum")}, 3).count() == 0


def test_global_sums_and_balanced_parts(spark):
    # nine tenths of the scores lie within a thousandth of their range
    df = spark.range(20000).select((F.when(F.col("id") % 10 < 9, 0.5 + F.col("id") / 2e7).otherwise(F.col("id") / 2e4)).alias("s"), F.lit(1).alias("v")).distinct()
    out = running_sums(df, "s", ["v"], descending=True, n_buckets=8)
    rows = sorted(out.collect(), key=lambda r: -r.s)
    assert [r.cum_v for r in rows] == list(range(1, len(rows) + 1))
    sizes = [r["count"] for r in df.repartitionByRange(8, F.col("s").desc()).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
