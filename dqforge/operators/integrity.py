"""Integrity checks: file checksums vs. a manifest, load errors, and table fingerprints / diffs.

Fingerprints are order-free (count + sums of both 64-bit halves of a row md5 as DECIMAL(38,0)),
so two copies of a table compare with one aggregation each — no sort, no join.  A diff is a grouped
count per (key, row hash) over the union of both sides: it is partial-aggregated before its
shuffle, handles duplicate rows as a multiset and spreads a hot key over many hash groups.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..results import result_struct
from ..session import ensure_checkpoint_dir
from ..sources import byte_ranges as BR


# --------------------------------------------------------------------------- file checksums


def file_checksums(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False,
                   part_bytes: int | None = None, name_pattern: str = r"([^/]+)$") -> DataFrame:
    """``file_name, path, length, md5`` of every file under ``path`` (``file_name`` is the first group of ``name_pattern``).

    Byte-exact (the content is hashed as bytes, never decoded as text).  Without ``part_bytes`` files of up to
    ``byte_ranges.STEP_BYTES`` go through Spark's own reader (any file system it knows), longer ones of any size are
    read in steps of that many bytes.  With it, all are read in byte ranges (``sources.byte_ranges``) and ``etag`` is
    added, the multipart ETag of an upload in parts of that size.
    """
    if part_bytes:
        df = BR.multipart_checksums(spark, path, part_bytes, glob, recursive)
    else:
        r = spark.read.format("binaryFile")
        if glob:
            r = r.option("pathGlobFilter", glob)
        if recursive:
            r = r.option("recursiveFileLookup", "true")
        files = r.load(path)
        short = F.col("length") <= BR.STEP_BYTES
        df = files.where(short).select("path", "length", F.md5(F.col("content")).alias("md5"))
        listed = files.where(~short).select("path", "length")
        if not listed.isEmpty():
            whole = listed.select("path", "length", F.lit(BR.WHOLE).cast("long").alias("part"), F.lit(0).cast("long").alias("start"), F.col("length").alias("size"))
            df = df.unionByName(BR.range_checksums(whole).select("path", "length", "md5"))
    name = F.regexp_extract(F.col("path"), name_pattern, 1).alias("file_name")
    return df.select(name, "path", "length", "md5", *(["etag"] if part_bytes else []))


def verify_manifest(files: DataFrame, manifest: DataFrame, key: str = "file_name", hash_col: str = "md5") -> DataFrame:
    """Compare computed checksums with a manifest (stored ETags): one row per file of either side.

    ``status`` is ``ok``, ``mismatch``, ``missing_file`` or ``not_in_manifest``.  A multipart
    ETag (``<md5>-<parts>``) is no MD5 of the content: it is compared with the ``etag`` of the
    files (``file_checksums(part_bytes=...)``) and is ``unverified`` where they have none.
    """
    etag = F.col("etag") if "etag" in files.columns else F.lit(None).cast("string")
    a = files.select(F.col(key).alias("_k"), F.col(hash_col).alias("_md5"), etag.alias("_etag"))
    b = manifest.select(F.col(key).alias("_k2"), F.lower(F.regexp_replace(F.col(hash_col), '"', "")).alias("expected"))
    j = a.join(b, a["_k"] == b["_k2"], "full_outer")
    multipart = F.coalesce(F.col("expected").contains("-"), F.lit(False))
    j = j.withColumn("computed", F.when(multipart, F.col("_etag")).otherwise(F.col("_md5")))
    status = (
        F.when(F.col("_k").isNull(), F.lit("missing_file"))
        .when(F.col("_k2").isNull(), F.lit("not_in_manifest"))
        .when(F.col("computed") == F.col("expected"), F.lit("ok"))
        .when(multipart & F.col("_etag").isNull(), F.lit("unverified"))
        .otherwise(F.lit("mismatch"))
    )
    return j.select(F.coalesce(F.col("_k"), F.col("_k2")).alias(key), "computed", "expected", status.alias("status"))


# --------------------------------------------------------------------------- load errors


def load_errors(checked: DataFrame, group_col: str = "_file") -> DataFrame:
    """Error counts by file (or another group) and column from a ``load_csv_checked`` frame.

    One aggregation; rows ``(group, column_name, n_errors)`` including zero counts, plus
    ``too_many_fields`` and ``short_rows``.
    """
    cols = [c[len("_bad_"):] for c in checked.columns if c.startswith("_bad_")]
    aggs = [F.count_if(F.col(f"_bad_{c}")).alias(c) for c in cols]
    aggs += [F.count_if(F.col("_too_many")).alias("too_many_fields"), F.count_if(F.col("_short")).alias("short_rows")]
    g = checked.groupBy(F.col(group_col).alias("file_group")).agg(*aggs)
    names = cols + ["too_many_fields", "short_rows"]
    return g.unpivot("file_group", names, "column_name", "n_errors")


def no_load_errors(checked: DataFrame, filename: str, name: str = "filename_check") -> DataFrame:
    """Verdict: no rejected row comes from a file whose name contains ``filename``."""
    sub = checked.filter(F.col("_file").contains(filename))
    agg = sub.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_error")).alias("_e"))
    return agg.select(
        F.inline(
            F.array(
                result_struct(
                    suite=None, check_name=name, level="integrity", column_name=None, metric="load_errors",
                    comparator="equal_to", expected="0", observed=F.col("_e"), n_rows=F.col("_n"),
                    n_failed=F.col("_e"), passed=F.col("_e") == 0,
                )
            )
        )
    )


# --------------------------------------------------------------------------- fingerprints and diffs


def _text(c: Column) -> Column:
    return c.cast("string")


def row_hash(cols: Iterable[str]) -> Column:
    """md5 of the columns as text, each ``<length>:<text>`` or ``N`` for NULL: neither a shifted NULL
    nor a separator inside a text makes different rows look equal."""
    parts = []
    for c in cols:
        t = _text(F.col(c))
        parts.append(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("N")))
    return F.md5(F.concat(*parts))


def hash_halves(cols: Iterable[str]) -> tuple[Column, Column]:
    """Both 64-bit halves of the row md5 as exact DECIMAL(38,0) (sums of 10^18 rows don't overflow)."""
    h = row_hash(list(cols))
    return tuple(F.conv(F.substring(h, at, 16), 16, 10).cast("decimal(38,0)") for at in (1, 17))


def _hash_sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)")


def table_fingerprint(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``n_rows, fingerprint, fingerprint_low``: order-free, one aggregation (equal tables ⇒ equal
    fingerprints); the sums cover all 128 bits of the row hashes.

    Cast doubles and timestamps to a fixed text/decimal form first when the fingerprint is
    compared across engines.
    """
    high, low = hash_halves(cols)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), _hash_sum(high).alias("fingerprint"), _hash_sum(low).alias("fingerprint_low"))


def row_digests(cols: Mapping[str, bool]) -> tuple[Column, Column]:
    """Two seeded 64-bit hashes of a row, for comparisons inside Spark: each column with a mark for NULL (the hash skips
    NULLs), as text where the flag says so (its type differs between the sides).  No text is built for the others."""
    marked: list[Column] = []
    for c, as_text in cols.items():
        marked += [F.col(c).isNull(), _text(F.col(c)) if as_text else F.col(c)]
    return F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *marked)


def _as_text(one: DataFrame, other: DataFrame, cols: Iterable[str]) -> dict[str, bool]:
    return {c: one.schema[c].dataType != other.schema[c].dataType or one.schema[c].dataType.typeName() in ("map", "variant") for c in cols}


#: Bits of the parts that a hash is summed in: a sum of 10^12 of them is a long.
SUM_BITS = 22


def _digest_sums(digests: Iterable[Column]) -> list[Column]:
    """Order-free sums of all bits of hashes, as longs: three for each."""
    parts = [F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << SUM_BITS) - 1)) for h in digests for at in range(0, 64, SUM_BITS)]
    return [F.coalesce(F.sum(x), F.lit(0)) for x in parts]


# Buckets whose ids are broadcast to prefilter a diff are at most this many.
MAX_PREFILTER_BUCKETS = 4_000_000


def _bucket(key_cols: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in key_cols]), F.lit(buckets))


def bucket_fingerprints(df: DataFrame, key_cols: list[str], cols: Mapping[str, bool], buckets: int) -> DataFrame:
    """Per hash-of-key bucket: row count and order-free sums of the row hashes of ``cols``."""
    sums = _digest_sums(row_digests(cols))
    return df.groupBy(_bucket(key_cols, buckets).alias("_bkt")).agg(F.count(F.lit(1)).alias("_n"), F.array(*sums).alias("_h"))


def diff_tables(source: DataFrame, target: DataFrame, key_cols: list[str], compare_cols: list[str],
                prefilter_buckets: int | None = None) -> DataFrame:
    """Rows that differ between two tables, as a multiset per key and content hash (128 bits).

    Output: key columns, ``n_source``, ``n_target``, ``status`` (``missing_in_target``,
    ``missing_in_source`` or ``count_differs``) — only for groups whose counts differ.

    ``prefilter_buckets`` (for large, nearly equal tables): both sides are first summarised per
    hash-of-key bucket (map-side aggregated, one row per bucket); only rows of buckets whose
    summaries differ enter the grouped diff, through a broadcast semi join of the bad bucket
    ids.  The result is the same; the full shuffle is skipped when few buckets differ.
    """
    text = _as_text(source, target, key_cols + compare_cols)
    if prefilter_buckets:
        sf = bucket_fingerprints(source, key_cols, text, prefilter_buckets)
        tf = bucket_fingerprints(target, key_cols, text, prefilter_buckets).select("_bkt", F.col("_n").alias("_tn"), F.col("_h").alias("_th"))
        same = (F.col("_n") == F.col("_tn")) & (F.col("_h") == F.col("_th"))
        bad = sf.join(tf, "_bkt", "full_outer").filter(~F.coalesce(same, F.lit(False))).select("_bkt")
        ensure_checkpoint_dir(source.sparkSession)
        bad = bad.checkpoint(eager=True)  # computed once: counted here, joined below
        n_bad = bad.count()
        if n_bad <= MAX_PREFILTER_BUCKETS and n_bad < prefilter_buckets // 2:
            keep = F.broadcast(bad)
            source = source.withColumn("_bkt", _bucket(key_cols, prefilter_buckets)).join(keep, "_bkt", "left_semi")
            target = target.withColumn("_bkt", _bucket(key_cols, prefilter_buckets)).join(keep, "_bkt", "left_semi")
    one, two = row_digests({c: text[c] for c in compare_cols})
    side = [one.alias("_h1"), two.alias("_h2")]
    s = source.select(*key_cols, *side, F.lit(1).alias("_s"), F.lit(0).alias("_t"))
    t = target.select(*key_cols, *side, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    g = s.unionByName(t).groupBy(*key_cols, "_h1", "_h2").agg(F.sum("_s").alias("n_source"), F.sum("_t").alias("n_target"))
    status = (
        F.when(F.col("n_target") == 0, F.lit("missing_in_target"))
        .when(F.col("n_source") == 0, F.lit("missing_in_source"))
        .otherwise(F.lit("count_differs"))
    )
    return g.filter(F.col("n_source") != F.col("n_target")).select(
        *key_cols, F.col("n_source").cast("bigint").alias("n_source"), F.col("n_target").cast("bigint").alias("n_target"),
        status.alias("status"),
    )


def compare_fingerprints(a: DataFrame, b: DataFrame | Mapping[str, DataFrame], cols: Iterable[str], name: str = "source_vs_target") -> DataFrame:
    """Verdict row: the two tables have equal row counts and fingerprints (one aggregation a table).

    ``b`` may be several tables by check name; ``a`` is read once for all of them.  The fingerprints are sums of two seeded
    hashes a row (128 bits), which Spark computes without building text; ``table_fingerprint`` is the form that other
    engines can compute too.
    """
    cols, others = list(cols), dict(b) if isinstance(b, Mapping) else {name: b}
    text = {c: any(_as_text(a, x, [c])[c] for x in others.values()) for c in cols}

    def summary(df: DataFrame):
        row = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.array(*_digest_sums(row_digests(text))).alias("h")).alias("s"))
        return row.scalar()  # a single-row aggregate: a scalar subquery, no join

    row = a.sparkSession.range(1).select(summary(a).alias("_a"), *[summary(x).alias(f"_{i}") for i, x in enumerate(others.values())])
    verdicts = []
    for i, check in enumerate(others):
        n, m = F.col("_a.n"), F.col(f"_{i}.n")
        verdicts.append(result_struct(
            suite=None, check_name=check, level="integrity", column_name=None, metric="fingerprint", comparator="equal_to", expected=None,
            observed=m, n_rows=n, n_failed=F.abs(n - m), passed=(n == m) & (F.col("_a.h") == F.col(f"_{i}.h"))))
    return row.select(F.explode(F.array(*verdicts)).alias("v")).select("v.*")


__all__ = [
    "compare_fingerprints",
    "bucket_fingerprints",
    "diff_tables",
    "file_checksums",
    "hash_halves",
    "load_errors",
    "no_load_errors",
    "row_digests",
    "row_hash",
    "table_fingerprint",
    "verify_manifest",
]
