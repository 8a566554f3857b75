"""Distributed running totals in a given order, without a window over all rows or over one key.

``Window.orderBy(...)`` with no partition moves every row into one task, and one with a hot key moves
that key's rows there.  Instead the rows are sorted into range partitions (one shuffle; a hot key is
spread over as many of them as its rows fill), each task adds up its own part as it writes it, and what
the parts before hold of a part's first key comes from one summary row a part.
"""

from __future__ import annotations

from typing import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from ..session import scratch_path

#: How the totals of a key are put together: numpy's accumulation, its inverse for a start, SQL's aggregate.
_KINDS = {"sum": (np.add, np.subtract, F.sum), "xor": (np.bitwise_xor, np.bitwise_xor, F.bit_xor)}


def _accumulate(kinds: Mapping[str, str], schema: pa.Schema):
    """mapInArrow function over sorted rows: totals since the key's first row in this part."""
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, carry, at, opened = None, dict.fromkeys(kinds, np.int64(0)), 0, True
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            key = b.column("_key")
            new = np.ones(n, bool)
            new[0] = last is None or key[0].as_py() != last
            new[1:] = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            opened = opened and (last is None or not new[0])
            if last is None:
                new[0] = False  # goes on from the parts before, as far as this part can tell
            segment = np.cumsum(new)
            starts = np.append(0, np.flatnonzero(new))[segment]
            columns = {f.name: b.column(f.name) for f in b.schema}
            for name, kind in kinds.items():
                add, less, _ = _KINDS[kind]
                v = b.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
                with np.errstate(over="ignore"):
                    c = add.accumulate(v)
                    own = less(c, less(c[starts], v[starts]))
                    if not new[0]:
                        own = np.where(segment == 0, add(own, carry[name]), own)
                carry[name] = own[-1]
                columns[name] = pa.array(own)
            open_rows = (segment == 0) & opened
            opened = bool(open_rows[-1])
            columns["_part"] = pa.array(np.full(n, part, np.int32))
            columns["_row"] = pa.array(np.arange(at, at + n))
            columns["_open"] = pa.array(open_rows)
            last, at = key[n - 1].as_py(), at + n
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)
    return run


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Mapping[str, tuple[Column, str]],
                   parts: int | None = None) -> DataFrame:
    """Add a column per entry of ``values`` (``name: (long column, "sum" or "xor")``): the total over the rows of the same
    ``keys`` up to and including this one, in ``order``.

    Rows that tie in ``order`` come in any order; make it total where that matters.  NULL values count as 0, NULL keys are
    a key.  ``parts`` is the number of range partitions, ``spark.sql.shuffle.partitions`` if not given.  The sorted rows
    are written once to the shared checkpoint folder, so lineage ends there and the totals refer to one fixed layout.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    key = F.to_json(F.struct(*keys)) if keys else F.lit("")
    rows = df.select("*", key.alias("_key"), *[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, (c, _) in values.items()])
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    ranged = (rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)).sortWithinPartitions(*by)
    out = StructType([*ranged.schema.fields, StructField("_part", IntegerType()), StructField("_row", LongType()), StructField("_open", BooleanType())])
    path = scratch_path(spark, "running")
    ranged.mapInArrow(_accumulate({n: k for n, (_, k) in values.items()}, to_arrow_schema(out)), out).write.parquet(path)
    done = spark.read.schema(out).parquet(path)

    # one row a part: its last key and what it holds of it (a part's first key is the last key of all parts before that have it)
    names = list(values)
    edge = F.max_by(F.struct("_key", *names), "_row")
    first = F.min_by("_key", "_row")
    summary = done.groupBy("_part").agg(edge.alias("e"), first.alias("_first")).select("_part", "_first", "e.*")
    by_key, by_part = Window.partitionBy("_key").orderBy("_part"), Window.orderBy("_part")
    held = summary.select("_part", "_first", "_key", *[_KINDS[k][2](n).over(by_key).alias(n) for n, (_, k) in values.items()])
    before = held.select("_part", (F.lag("_key").over(by_part) == F.col("_first")).alias("_goes_on"), *[F.lag(n).over(by_part).alias(f"_before_{n}") for n in names])
    out_rows = done.join(F.broadcast(before), "_part")  # a row for each range partition
    goes_on = F.col("_open") & F.coalesce("_goes_on", F.lit(False))

    def total(n: str, kind: str) -> Column:
        whole = F.col(n) + F.col(f"_before_{n}") if kind == "sum" else F.col(n).bitwiseXOR(F.col(f"_before_{n}"))
        return F.when(goes_on, whole).otherwise(F.col(n)).alias(n)

    return out_rows.select(*df.columns, *[total(n, k) for n, (_, k) in values.items()])


def running_sums(df: DataFrame, order_col: str, value_cols: Sequence[str], descending: bool = False, n_buckets: int | None = None) -> DataFrame:
    """Add ``cum_<v>`` = sum of ``v`` over all rows up to and including this one in order.

    ``order_col`` must be unique per row (group by it first); ties would make the order partial.  ``n_buckets`` is the
    number of range partitions.
    """
    c = F.col(order_col)
    return running_totals(df, [], [c.desc() if descending else c.asc()], {f"cum_{v}": (F.col(v), "sum") for v in value_cols}, n_buckets)
