"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import types

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

#: Ids sent to every executor at once: 8 MB of longs.  More of them are shuffled instead.
BROADCAST_IDS = 1_000_000


#: What a Python worker gets at once while an intermediate is written: rows, and bytes unless one row has more.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: lineage ends there, so a
    lost executor costs a re-read and never the work before it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    old = {k: spark.conf.get(k, None) for k in BATCH}
    for k, v in BATCH.items():
        spark.conf.set(k, v)  # rows carry whole texts: few of them at once in a Python worker
    try:
        df.write.parquet(path)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def id_bucket(col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % mod


def row_key(id_col: str, text: Column) -> Column:
    """64-bit key of an (id, text) row; null ids and null texts have keys too."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))


def matching(df: DataFrame, keys: DataFrame, col: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``col`` is (``left_semi``) or isn't (``left_anti``) among the distinct
    ``keys``.  A key set of at most ``BROADCAST_IDS`` longs is sent to the rows; a larger one is
    joined by a shuffle."""
    if keys.count() <= BROADCAST_IDS:
        keys = F.broadcast(keys)
    return df.join(keys, col, how)


def vocabulary(name: str) -> str:
    """The file of a public tokenizer: a path, or a name that the installed package knows."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts and labels to learn from, and how many labelled ids each class has.

    Only ids whose ``crc32 mod`` isn't ``held`` take part.  Of each class the ``per_class`` ids with
    the smallest id hash are taken, so the sample is bounded (``2 * per_class`` ids) and the same on
    every run.  Null labels and null ids are left out; an id with several label rows counts once,
    with its largest label, and an id with several document rows with the smallest of their texts."""
    known = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
             .where("_id IS NOT NULL AND _y IN (0, 1)").where(id_bucket("_id", mod) != held)
             .groupBy("_id").agg(F.max("_y").alias("_y")))
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y in (0, 1):
        part = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(picked), "_id").groupBy("_id").agg(F.min("text").alias("text"), F.first("_y").alias("y")))
    return rows, counts


def slices(texts, chars: int = 1 << 21):
    """Lists of consecutive texts (null: empty) of about ``chars`` characters, one text at least: what
    a task holds in pieces at once doesn't depend on how many rows a batch has."""
    part, size = [], 0
    for t in texts:
        t = t if isinstance(t, str) else ""
        if part and size + len(t) > chars:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def per_process(key: tuple, make):
    """A value that a reused Python worker keeps from task to task."""
    kept = sys.modules.setdefault("_worker_values", types.ModuleType("_worker_values")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def release() -> None:
    """Drop what :func:`per_process` keeps: an operator without such values doesn't work beside those of an earlier one."""
    if sys.modules.pop("_worker_values", None) is not None:
        give_back()


def give_back() -> None:
    """Return what a task has freed to the machine: an idle Python worker lives on beside later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # what was freed goes back to the machine, where its C library can
    if trim is not None:
        trim(0)


def tidy(run):
    """``run``, a function from batches to batches, that returns its memory when its task ends."""
    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


class Memo:
    """Values of words, computed once while they are in use: two generations of at most ``limit``
    words each, so common words stay and the memory of a task is bounded."""

    def __init__(self, compute, limit: int = 250_000):
        self.compute, self.limit = compute, limit
        self.values: dict = {}
        self.old: dict = {}

    def lookup(self, lists: list[list[str]]):
        """A function that gives the value of any word of ``lists``."""
        values, old = self.values, self.old
        if len(values) > self.limit:
            self.old = old = values
            self.values = values = {}
        new = []
        for w in set().union(*lists).difference(values):
            if w in old:
                values[w] = old[w]
            else:
                new.append(w)
        if new:
            values.update(zip(new, self.compute(new)))
        return values.__getitem__
