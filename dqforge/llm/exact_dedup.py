"""Exact deduplication: 128-bit content hash, bytes compared inside each hash group.

Texts are grouped by two independent 64-bit hashes *and* by the text itself, so equal hashes of
different bytes end in different classes.  Partial aggregation leaves one row per distinct text and
task before the shuffle: a text that fills a third of the table is one row per task.

Defined results: a null text counts as empty and an empty text is a text like any other; a null id
stays only where its whole group has none; of repeated rows (same id, same text) one stays; an empty table gives an
empty result; other columns are ignored by ``duplicates`` and carried by ``deduplicate``.  Of rows of one id
and text that differ elsewhere, ``deduplicate`` keeps the one with the smallest hash of its columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

Hash = Callable[[Column], list[Column]]


def content_hash(text: Column) -> list[Column]:
    """Two 64-bit hashes under different seeds."""
    return [F.xxhash64(text), F.xxhash64(F.lit(0x5EED), text, F.length(text))]


def _keyed(docs: DataFrame, hash_of: Hash) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2 = hash_of(text)
    return docs.select(F.col("doc_id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"))


def duplicates(docs: DataFrame, keep: str = "min", hash_of: Hash = content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` is ``min`` or ``max``: which id of a group of equal texts stays.
    """
    best = {"min": F.min, "max": F.max}[keep]
    rows = _keyed(docs, hash_of)
    texts = (rows.groupBy("h1", "h2", "text")
             .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
             .select("h1", "h2", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")))
    groups = stored(texts.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("variants"), F.first("keep_id").alias("keep_id"),
        F.first("group_size").alias("group_size"), F.first("text_sha256").alias("text_sha256")), "dedup-groups")
    # repeated rows collapse to one row with a count, and come back after the join
    ids = rows.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    out = ids.join(groups.where("variants = 1").drop("variants"), ["h1", "h2"])
    clashing = groups.where("variants > 1").select("h1", "h2")
    if clashing.take(1):  # equal hashes of different bytes: these rows are classed by their text
        mine = rows.join(clashing, ["h1", "h2"], "left_semi")
        by_text = mine.groupBy("h1", "h2", "text").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        apart = (mine.groupBy("h1", "h2", "text", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
                 .join(by_text, ["h1", "h2", "text"]).withColumn("text_sha256", F.sha2("text", 256)))
        out = out.unionByName(apart.select(out.columns))
    nth = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("nth")
    return (out.select("doc_id", "keep_id", "group_size", "text_sha256", nth)
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256"))


def _row_hash(docs: DataFrame, columns: list[str]) -> Column:
    """A hash that orders rows of equal id and text; nulls have their place, maps count as JSON text."""
    parts = []
    for f in docs.select(*[F.col(f"`{c}`") for c in columns]).schema.fields:
        c = F.col(f"`{f.name}`")
        parts += [c.isNull(), F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c]
    return F.xxhash64(F.lit(0), *parts)


def deduplicate(docs: DataFrame, keep: str = "min", hash_of: Hash = content_hash) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per distinct text.

    Text and hash are the grouping key and the other columns ride in the aggregate, so whole rows
    are shuffled once and copies are dropped before the shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2 = hash_of(text)
    rest = [c for c in docs.columns if c != "text"]
    row = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"),
                   F.col("text").isNull().alias("absent"), _row_hash(docs, rest).alias("tie"),
                   F.struct(*[F.col(f"`{c}`").alias(c) for c in rest]).alias("row"))
    # nulls sort first in Spark's order: with `min` a known id must win over a null one
    pick = (F.max_by("one", F.struct("one.known", "one.id", ~F.col("one.absent"), F.bitwise_not("one.tie"))) if keep == "max"
            else F.min_by("one", F.struct(~F.col("one.known"), F.col("one.id"), F.col("one.absent"), F.col("one.tie"))))
    got = (docs.select(h1.alias("h1"), h2.alias("h2"), text.alias("t"), row.alias("one"))
           .groupBy("h1", "h2", "t").agg(pick.alias("one")))
    back = {c: F.col("one.row").getField(c).alias(c) for c in rest}
    back["text"] = F.when(~F.col("one.absent"), F.col("t")).alias("text")
    return got.select(*[back[c] for c in docs.columns])
