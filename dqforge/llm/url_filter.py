"""URL allow and block rules by host suffix and path prefix, in DataFrame operations only.

Every URL is expanded into its (host suffix, path prefix) expressions, the expressions are joined
with the rules on a 32-bit hash prefix, the full 128-bit digest confirms each hit, and the longest
rule wins (ties: the rule with the longer host, then block).  A host suffix starts at a label; a
path prefix is cut at every length that some rule path has, so a rule path need not end in a slash.
Only suffixes of as many labels as the longest rule host has are built, so a host's work doesn't
grow with the square of its labels.

Each distinct (host, path) is judged once (copies collapse before the shuffle), so a host or URL
that fills a third of the table is one row per task.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule;
a URL that no rule fits gets the default verdict and a null rule; rules with a null part are ignored;
of equal rules block wins; repeated rows give repeated results; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: Rules sent to every executor at once; more of them are shuffled instead.
BROADCAST_RULES = 100_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    pattern = r"^://([^/?#]*+)([^?#]*+)"  # possessive classes: linear on long URLs
    u = F.coalesce(url, F.lit(""))
    # the first "://" ends the scheme; text before it is skipped
    start = F.locate("://", u)
    tail = F.when(start > 0, F.substring(u, start, F.length(u)))
    host = F.coalesce(F.regexp_extract(tail, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(tail, pattern, 2), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _digest(text: Column) -> Column:
    return F.md5(text)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every page; ``rules`` has verdict, host and path."""
    rules = (rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')")
             .groupBy(F.lower("host").alias("r_host"), F.col("path").alias("r_path"))
             .agg(F.max("verdict").alias("r_verdict")))  # of equal rules, block wins
    expr = F.concat(F.length("r_host").cast("string"), F.lit(":"), "r_host", "r_path")
    rules = stored(rules.withColumn("r_digest", _digest(expr)).withColumn("short", _short(F.col("r_digest"))), "url-rules")
    stats = rules.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("r_path")).alias("cuts"),
                      F.max(F.size(F.split("r_host", r"\.", -1))).alias("labels")).first()
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    cuts = F.array(*[F.lit(x) for x in sorted(stats["cuts"])]) if stats["cuts"] else F.array().cast("array<int>")

    # the last 1, 2, ... labels of the host, as many as a rule has
    labels = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."))) + 1
    suffixes = F.transform(F.sequence(F.lit(1), F.least(labels, F.lit(stats["labels"] or 1))), lambda i: F.call_function("substring_index", F.col("host"), F.lit("."), -i))
    distinct = rows.where("host <> ''").groupBy("host", "path").agg(F.lit(1).alias("one")).drop("one")
    expressions = (distinct.withColumn("suffix", F.explode(F.array_distinct(suffixes)))
                   .withColumn("cut", F.explode(F.filter(cuts, lambda c: c <= F.length("path"))))
                   .withColumn("digest", _digest(F.concat(F.length("suffix").cast("string"), F.lit(":"), "suffix", F.expr("substring(path, 1, cut)"))))
                   .select("host", "path", "digest", _short(F.col("digest")).alias("short")))
    side = F.broadcast(rules) if stats["n"] <= BROADCAST_RULES else rules
    hits = expressions.join(side, "short").where("digest = r_digest")
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("size"), F.length("r_host").alias("host_size"), F.col("r_verdict"),
                    F.col("r_host"), F.col("r_path"))
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    best = best.select(F.col("host").alias("b_host"), F.col("path").alias("b_path"), F.concat("best.r_host", "best.r_path").alias("rule"),
                       F.col("best.r_verdict").alias("verdict"))
    # most pages fit no rule or share a rule's host: AQE splits a hot (host, path) of the left side
    return (rows.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
