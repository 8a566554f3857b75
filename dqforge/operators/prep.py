"""Row cleaning and feature preparation, as native column expressions (no Python UDFs).

Cleaning: drop rows with NULLs, de-duplicate, trim text, replace sentinels, drop columns.
Features: right-closed bins, equality flags and one-hot columns ``<prefix>_<value>``.
"""

from __future__ import annotations

from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions.running import running_totals
from ..sources.tables import materialize


def drop_null_rows(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Rows with no NULL (in ``subset`` when given)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def dedupe(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Distinct rows; map-side partial aggregation collapses hot duplicates before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def _text_cols(df: DataFrame, cols: Iterable[str] | None) -> list[str]:
    return list(cols) if cols else [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def strip(c: Column) -> Column:
    """Leading and trailing whitespace removed (any whitespace, not only spaces)."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def trim_strings(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Strip every text column (or ``cols``) in one projection."""
    todo = set(_text_cols(df, cols))
    return df.select(*[strip(F.col(c)).alias(c) if c in todo else F.col(c) for c in df.columns])


def replace_sentinel(df: DataFrame, cols: Iterable[str], old: Any = "?", new: Any = "Unknown") -> DataFrame:
    """Exact-match replacement of a sentinel value in the given columns."""
    todo = set(cols)
    return df.select(
        *[F.when(F.col(c) == F.lit(old), F.lit(new)).otherwise(F.col(c)).alias(c) if c in todo else F.col(c)
          for c in df.columns]
    )


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def clean(df: DataFrame, sentinel_cols: Iterable[str] = (), drop: Iterable[str] = (), sentinel: Any = "?",
          replacement: Any = "Unknown", trim_first: bool = False) -> DataFrame:
    """The cleaning stage in order: drop NULL rows, de-duplicate, trim, replace sentinels, drop columns.

    De-duplication runs before trimming (so trimmed twins survive) unless ``trim_first``.
    """
    out = drop_null_rows(df)
    if trim_first:
        out = dedupe(trim_strings(out))
    else:
        out = trim_strings(dedupe(out))
    out = replace_sentinel(out, sentinel_cols, sentinel, replacement)
    return drop_columns(out, drop)


def bin_expr(c: str | Column, edges: Sequence[float], labels: Sequence[Any] | None = None) -> Column:
    """Right-closed bins ``(e0, e1] → labels[0], ...``; values outside ``(e0, e_last]`` → NULL."""
    c = F.col(c) if isinstance(c, str) else c
    labels = list(labels) if labels is not None else list(range(1, len(edges)))
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def bin_column(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[Any] | None = None,
               name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_bins", bin_expr(col, edges, labels))


def flag_equals(df: DataFrame, col: str, value: Any, name: str | None = None) -> DataFrame:
    """1 where ``col == value`` else 0 (NULL → 0)."""
    return df.withColumn(name or f"{col}_flag", F.when(F.col(col) == F.lit(value), F.lit(1)).otherwise(F.lit(0)))


def categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted distinct non-NULL values per column, from one aggregation job.

    Each branch is a ``groupBy(col)`` (partial-aggregated, so hot values collapse map-side);
    only the distinct values reach the driver: each is to be the name of an output column.
    """
    from functools import reduce

    parts = [
        df.select(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_val")).where(F.col(c).isNotNull()).distinct()
        for c in cols
    ]
    both = reduce(lambda a, b: a.unionByName(b), parts)
    out: dict[str, list] = {c: [] for c in cols}
    for r in both.collect():
        out[r["_col"]].append(r["_val"])
    for c in cols:
        out[c].sort()
    return out


def one_hot(df: DataFrame, cols: Sequence[str], cats: Mapping[str, Sequence] | None = None,
            prefix: Mapping[str, str] | None = None, drop: Iterable[str] = ()) -> DataFrame:
    """One-hot columns ``<prefix>_<value>`` (values sorted), non-encoded columns first.

    Categories come from one distinct pass unless given.  A NULL gets 0 in every column.
    ``drop`` removes generated columns (e.g. the redundant one of a binary column).
    """
    cats = dict(cats) if cats is not None else categories(df, cols)
    prefix = dict(prefix or {})
    drop = set(drop)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    enc = []
    for c in cols:
        for v in cats[c]:
            name = f"{prefix.get(c, c)}_{v}"
            if name in drop:
                continue
            enc.append(F.when(F.col(c).cast("string") == F.lit(str(v)), F.lit(1)).otherwise(F.lit(0)).alias(name))
    return df.select(*keep, *enc)


def category_index(df: DataFrame, col: str) -> DataFrame:
    """``value, index``: the distinct non-NULL values of a column and their places in sorted order, from 0.  Any number of
    values: they are numbered by running totals over range partitions and never come to the driver."""
    values = df.select(F.col(col).alias("value")).where("value IS NOT NULL").distinct()
    return running_totals(values, [], [F.col("value")], {"index": (F.lit(1), "sum")}).withColumn("index", F.col("index") - 1)


def one_hot_vector(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """A sparse one-hot vector beside the other columns (the wide form of :func:`one_hot` for many values): one place per
    distinct value in sorted order, no place set where the column is NULL."""
    from pyspark.ml.feature import OneHotEncoder

    index = materialize(category_index(df, col), name="categories")
    n = index.count()
    place = F.coalesce(F.col("index"), F.lit(n)).cast("double")
    # the number of categories is told, not looked for; the one after the last stands for NULL and is dropped
    meta = {"ml_attr": {"type": "nominal", "num_vals": n + 1}}
    named = index.select(F.col("value").alias("_category"), "index")
    rows = df.join(named, df[col] == F.col("_category"), "left").select(*df.columns, place.alias("_place", metadata=meta))
    out = name or f"{col}_vector"
    return OneHotEncoder(inputCols=["_place"], outputCols=[out], dropLast=True).fit(rows.limit(0)).transform(rows).drop("_place")


def with_load_date(df: DataFrame, run_date, offset: int = 0, name: str = "upload_date") -> DataFrame:
    """Constant load-date column: ``run_date - offset`` days (a date, never shifted by zone)."""
    import datetime as dt

    d = run_date if isinstance(run_date, dt.date) else dt.date.fromisoformat(str(run_date))
    return df.withColumn(name, F.lit(d - dt.timedelta(days=int(offset))))
