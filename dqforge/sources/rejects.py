"""Reject records of a CSV load: file, line number, column, reason and text of every line that doesn't load.

Lines are read as text, split by split.  A task numbers the lines of its splits as they come and keeps the rejected
ones and one count a split; running totals of those counts turn the numbers within a split into lines of the file.
Fields are counted by the CSV parser itself: a marker is appended as one more field, and its position says how many
came before, whatever is quoted or escaped.
"""

from __future__ import annotations

from typing import Iterable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path

#: A private character, appended to a line as its last field.
MARK = ""
#: Splits whose line counts every task gets.
MAX_SPLITS_BROADCAST = 100_000
#: Reasons of reject records.
TOO_MANY, SHORT, OPEN_QUOTE, NOT_CAST, NULL_REQUIRED = "too_many_fields", "short_row", "unterminated_quote", "not_castable", "null_in_required"
_PROBLEM = "array<struct<column_name: string, reason: string, token: string>>"


def with_fields(df: DataFrame, line: Column, n: int, options: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``_fields``: the first ``n`` fields of a CSV line as text (``tokens``) and the ``count`` of its fields, exact up to
    ``n + 1``, then ``n + 2``; -1 where a quote isn't closed.  A NULL line has none.

    Each step is a generator of one row, so a line is parsed once however often its fields are used (as a plain expression
    every use would get a parser, with its buffers, of its own)."""
    opts = {k: str(v) for k, v in (options or {}).items()}
    sep = opts.get("sep", opts.get("delimiter", ","))
    names = [f"c{i}" for i in range(n + 2)]
    row = F.from_csv(F.concat(line, F.lit(sep + MARK)), ", ".join(f"{c} string" for c in names), {**opts, "mode": "PERMISSIVE"})
    parsed = df.select("*", F.explode(F.array(row)).alias("_csv"))
    listed = parsed.select("*", F.explode(F.array(F.array(*[F.col(f"_csv.{c}") for c in names]))).alias("_all")).drop("_csv")
    tokens = F.col("_all")
    at = F.array_position(tokens, F.lit(MARK))
    swallowed = F.exists(tokens, lambda t: F.coalesce(F.contains(t, F.lit(MARK)), F.lit(False)))
    count = F.when(at > 0, at - 1).when(swallowed, F.lit(-1)).otherwise(F.lit(n + 2)).cast("int")
    # the marker isn't a value of a short line's next column
    first = F.transform(F.slice(tokens, 1, n), lambda t: F.when(~F.contains(t, F.lit(MARK)), t))
    return listed.select("*", F.explode(F.array(F.struct(first.alias("tokens"), count.alias("count")))).alias("_fields")).drop("_all")


def typed(token: Column, data_type, ts_format: str | None) -> Column:
    if ts_format and data_type.typeName() in ("timestamp", "timestamp_ntz"):
        return F.try_to_timestamp(token, F.lit(ts_format)).cast(data_type)
    return token.try_cast(data_type)


def problems(tokens: Column, count: Column, schema: StructType, allow_jagged: bool, required: Iterable[str], ts_format: str | None) -> Column:
    """What is wrong with a line: an array of (column_name, reason, token), empty for a line that loads."""
    n, needed = len(schema.fields), {c.lower() for c in required}
    none = F.lit(None).cast("string")

    def problem(when: Column, column: str | None, reason: str, token: Column = none) -> Column:
        return F.when(when, F.struct(F.lit(column).cast("string").alias("column_name"), F.lit(reason).alias("reason"), token.alias("token")))

    cut = (count < n) & F.lit(not allow_jagged)
    whole = count >= 0
    found = [problem(count > n, None, TOO_MANY), problem(whole & cut, None, SHORT), problem(~whole, None, OPEN_QUOTE)]
    for i, f in enumerate(schema.fields):
        t = tokens[i]
        given = t.isNotNull() & (F.trim(t) != "")
        found.append(problem(whole & given & typed(t, f.dataType, ts_format).isNull(), f.name, NOT_CAST, t))
        if f.name.lower() in needed:
            found.append(problem(whole & ~cut & ~F.coalesce(given, F.lit(False)), f.name, NULL_REQUIRED))
    return F.filter(F.array(*found), lambda p: p.isNotNull())


def _numbered(batches):
    """mapInArrow function: rejected lines with their number within the split, and a row with each split's lines."""
    names = ["path", "block", "line", "raw", "problems", "n_lines"]
    now, line = None, 0

    def count_row(schema):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*now, None, None, None, line), schema)], names=names)

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        path, block = b.column("path").dictionary_encode(), b.column("block").to_numpy()
        code = path.indices.to_numpy()
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), b.column("problems").type, pa.int64()]
        new = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (block[1:] != block[:-1])))
        for lo, hi in zip(new.tolist(), [*new[1:].tolist(), n]):
            this = path.dictionary[int(code[lo])].as_py(), int(block[lo])
            if this != now:
                if now is not None:
                    yield count_row(kinds)
                now, line = this, 0
            part = b.slice(lo, hi - lo)
            keep = np.flatnonzero(part.column("problems").is_valid().to_numpy(zero_copy_only=False))
            if len(keep):
                some = part.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([some.column("path"), some.column("block"), pa.array(keep + line + 1), some.column("raw"), some.column("problems"),
                                                  pa.nulls(len(keep), pa.int64())], names=names)
            line += hi - lo
    if now is not None:
        yield count_row(kinds)


def rejected_rows(spark: SparkSession, path: str | list[str], schema: StructType | str, header: bool = False, allow_jagged: bool = True,
                  required: Iterable[str] = (), ts_format: str | None = None, **options) -> DataFrame:
    """One row per problem of a line: ``path, line_number`` (from 1, the header and blank lines counted), ``column_name`` (NULL
    for the line as a whole), ``reason, token, raw_line``.

    Reasons: ``too_many_fields``, ``short_row`` (unless ``allow_jagged``), ``unterminated_quote``, ``not_castable`` (non-blank
    text that isn't of the column's type) and ``null_in_required`` (blank or missing in a ``required`` column).  Blank lines
    and headers are no records.  One line is one record (``multiLine`` is refused).  The rejected lines are written once to
    the shared checkpoint folder.
    """
    from .files import _schema

    if str(options.get("multiLine", "false")).lower() == "true":
        raise ValueError("multiLine records have no line number of their own")
    target = _schema(spark, schema)
    sep = {"lineSep": options["lineSep"]} if "lineSep" in options else {}
    lines = spark.read.options(**sep).text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    parsed = with_fields(lines, F.col("value"), len(target.fields), {k: v for k, v in options.items() if k != "lineSep"})
    found = problems(F.col("_fields.tokens"), F.col("_fields.count"), target, allow_jagged, required, ts_format)
    rejected = (F.trim("value") != "") & (F.size("found") > 0)
    flagged = parsed.select("*", F.explode(F.array(found)).alias("found")).select("path", "block", F.when(rejected, F.col("value")).alias("raw"), F.when(rejected, F.col("found")).alias("problems"))
    out = scratch_path(spark, "rejects")
    kind = f"path string, block long, line long, raw string, problems {_PROBLEM}, n_lines long"
    flagged.mapInArrow(_numbered, kind).write.parquet(out)
    kept = spark.read.schema(kind).parquet(out)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    starts = kept.where("n_lines IS NOT NULL").select("path", "block", F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("_before"))
    if starts.count() <= MAX_SPLITS_BROADCAST:  # the rejected lines stay where they are: by split, a task would get all of one's
        starts = F.broadcast(starts)
    numbered = kept.where("line IS NOT NULL").join(starts, ["path", "block"]).withColumn("line_number", F.col("line") + F.col("_before"))
    if header:
        numbered = numbered.where("line_number > 1")
    return numbered.select("path", "line_number", F.inline("problems"), F.col("raw").alias("raw_line"))
