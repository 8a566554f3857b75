"""Checksums of files of any size, computed over byte ranges in parallel.

A file is cut into parts of ``part_bytes``; every part is a row, the rows are dealt over the cluster, and a
task reads its ranges a few megabytes at a time, so no task holds a part, let alone a file.  The part sums of
a file (10,000 at most in a multipart upload) are put in order and folded into its ETag in one aggregation.
A range of more than ``STEP_BYTES`` (a whole file, say) is read by several tasks, one after the other: MD5 goes
byte by byte, so a task hands its state of 92 bytes to the task that reads on.

Files are listed by Spark without their content.  Ranges are opened by ``opener(path)``, a function that returns
a seekable binary file; by default Arrow's file systems (local, HDFS, object stores) by the path's scheme.
"""

from __future__ import annotations

import ctypes
import hashlib
import math
import re
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import materialize

#: Bytes that a task reads at once, of one range at most, and of ranges on average.
READ_BYTES, STEP_BYTES, TASK_BYTES = 4 << 20, 128 << 20, 128 << 20
#: Steps of long ranges between two writes of their states.
STEPS_A_JOB = 16
#: The part number that stands for a whole file.
WHOLE = -1


def open_range(path: str):
    """A seekable file of Arrow's file systems; Spark writes local paths as ``file:/a``."""
    from pyarrow import fs

    local = re.match(r"file:/*(/.*)", path) or re.match(r"(/.*)", path)
    where, name = (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(path)
    return where.open_input_file(name)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """``path, length`` of every file, without reading any.  Spark's readers leave out empty files."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path).select("path", "length")


def file_ranges(files: DataFrame, part_bytes: int, whole: bool = False) -> DataFrame:
    """``path, length, part, start, size``: the parts of each file, from 0; an empty file has one empty part.  With
    ``whole`` a file of several parts has a row for all of it too (part ``WHOLE``)."""
    if part_bytes < 1:
        raise ValueError("part_bytes must be positive")
    last = F.greatest(F.ceil(F.col("length") / F.lit(part_bytes)).cast("long") - 1, F.lit(0))
    first = F.when(last > 0, F.lit(WHOLE)).otherwise(F.lit(0)) if whole else F.lit(0)
    parts = files.select("path", "length", F.explode(F.sequence(first.cast("long"), last)).alias("part"))
    start = F.greatest(F.col("part"), F.lit(0)) * part_bytes
    size = F.when(F.col("part") == WHOLE, F.col("length")).otherwise(F.least(F.lit(part_bytes).cast("long"), F.col("length") - start))
    return parts.select("path", "length", "part", start.alias("start"), size.alias("size"))


class RunningMD5:
    """An MD5 whose state can be taken to another process, by the library that ``hashlib`` uses."""

    def __init__(self, state: bytes | None = None):
        self._lib, self._state = self._library(), ctypes.create_string_buffer(state or b"", 92)  # OpenSSL's MD5_CTX
        if state is None:
            self._lib.MD5_Init(self._state)

    @staticmethod
    def _library():
        import _hashlib

        return ctypes.CDLL(_hashlib.__file__)

    @classmethod
    def available(cls) -> bool:
        try:
            h = cls()
            h.update(b"a")
            h = cls(h.state)
            h.update(b"bc")
            return h.hexdigest() == hashlib.md5(b"abc", usedforsecurity=False).hexdigest()
        except (ImportError, AttributeError, OSError):
            return False

    @property
    def state(self) -> bytes:
        return self._state.raw

    def update(self, data: bytes) -> None:
        self._lib.MD5_Update(self._state, data, ctypes.c_size_t(len(data)))

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(16)
        self._lib.MD5_Final(out, ctypes.create_string_buffer(self._state.raw, 92))
        return out.raw.hex()


def _read_into(h, opener: Callable, path: str, start: int, size: int) -> None:
    with opener(path) as f:
        f.seek(start)
        while size > 0:
            got = f.read(min(size, READ_BYTES))
            if not got:
                raise OSError(f"{path} ended {size} bytes before its listed length")
            h.update(got)
            size -= len(got)


def _range_sums(opener: Callable):
    def sums(batches):
        for b in batches:
            out = []
            for path, start, size in zip(*(b.column(c).to_pylist() for c in ("path", "start", "size"))):
                h = hashlib.md5(usedforsecurity=False)
                _read_into(h, opener, path, start, size)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("path", "length", "part")), pa.array(out, pa.string())], names=["path", "length", "part", "md5"])
    return sums


def _range_steps(opener: Callable, step: int):
    """The next ``step`` bytes of each range, or what is left of it; its sum when nothing is left."""
    def steps(batches):
        for b in batches:
            states, sums = [], []
            for path, start, size, state, md5 in zip(*(b.column(c).to_pylist() for c in ("path", "start", "size", "state", "md5"))):
                if md5 is None:
                    h = RunningMD5(state)
                    _read_into(h, opener, path, start, min(size, step))
                    state, md5 = (None, h.hexdigest()) if size <= step else (h.state, None)
                states.append(state)
                sums.append(md5)
            left = pc.add(b.column("start"), step), pc.subtract(b.column("size"), step)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("path", "length", "part")), *left, pa.array(states, pa.binary()), pa.array(sums, pa.string())],
                                             names=["path", "length", "part", "start", "size", "state", "md5"])
    return steps


def dealt(ranges: DataFrame, n: int, total: int) -> DataFrame:
    """``n`` ranges of ``total`` bytes in all, dealt over tasks."""
    tasks = max(1, min(2 * n, max(math.ceil(total / TASK_BYTES), 2 * int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    return ranges.repartition(tasks, "path", "part")  # a number of its own: rows are few bytes, what they stand for isn't


def range_checksums(ranges: DataFrame, opener: Callable = open_range, step: int | None = None) -> DataFrame:
    """``path, length, part, md5`` of each range of :func:`file_ranges`.  A range of more than ``step`` bytes (``STEP_BYTES``)
    is read in so many steps, each by a task of its own (where the state of an MD5 can't be had, by one task)."""
    step = step or STEP_BYTES
    long = F.col("size") > step
    of = ranges.groupBy(long.alias("long")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.max("size").alias("most")).collect()
    of = {r["long"]: r for r in of}
    if True not in of or not RunningMD5.available():
        n, total = (sum(r[c] for r in of.values()) for c in ("n", "total"))
        return dealt(ranges, n, total).mapInArrow(_range_sums(opener), "path string, length long, part long, md5 string")
    n, most = of[True]["n"], of[True]["most"]
    on = ranges.where(long).select("*", F.lit(None).cast("binary").alias("state"), F.lit(None).cast("string").alias("md5"))
    for i in range(math.ceil(most / step)):
        if i and i % STEPS_A_JOB == 0:
            on = materialize(on, name="md5-state")
        on = dealt(on, n, n * step).mapInArrow(_range_steps(opener, step), "path string, length long, part long, start long, size long, state binary, md5 string")
    sums = on.select("path", "length", "part", "md5")
    if False in of:
        short = dealt(ranges.where(~long), of[False]["n"], of[False]["total"])
        sums = sums.unionByName(short.mapInArrow(_range_sums(opener), "path string, length long, part long, md5 string"))
    return sums


def multipart_checksums(spark: SparkSession, path: str | list[str], part_bytes: int, glob: str | None = None, recursive: bool = False,
                        whole: bool = True, opener: Callable = open_range) -> DataFrame:
    """``path, length, n_parts, md5, etag`` of every file.  ``etag`` is ``<md5 of the joined binary part md5s>-<parts>``.
    ``md5`` is that of the content: a file of several parts is read a second time for it, from end to end, so it is NULL
    there unless ``whole``."""
    sums = range_checksums(file_ranges(list_files(spark, path, glob, recursive), part_bytes, whole), opener)
    part = F.struct("part", "md5")
    g = sums.groupBy("path").agg(F.max("length").alias("length"), F.array_sort(F.collect_list(F.when(F.col("part") >= 0, part))).alias("p"),
                                 F.max(F.when(F.col("part") == WHOLE, F.col("md5"))).alias("whole"))
    n = F.size("p")
    etag = F.concat(F.md5(F.unhex(F.array_join(F.col("p.md5"), ""))), F.lit("-"), n.cast("string"))
    return g.select("path", "length", n.alias("n_parts"), F.when(n == 1, F.col("p")[0]["md5"]).otherwise(F.col("whole")).alias("md5"), etag.alias("etag"))
