"""Schema-registry transforms: a JSON registry entry → Spark schema, positional select, resolve.

A registry entry lists ``properties{NAME: {type, description: "source_order=N", default,
default_source: "source=<col>"}}`` plus dimensions, metrics and cluster keys.  Everything here
runs on the driver over the schema and yields one ``select``; no data passes through Python.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Columns a positional load never selects (audit columns added by the warehouse).
SKIP_ON_LOAD = ("insert_timestamp", "hash_diff")


#: Words of registry types, looked for in this order, and what they are in Spark (fixed values).
TYPE_WORDS: list[tuple[str, DataType]] = [
    ("char|text|string", StringType()),
    ("bigint|^long$", LongType()),
    ("int", IntegerType()),
    ("number|numeric|decimal", DecimalType(38, 0)),
    ("float|double|real", DoubleType()),
    ("timestamp|datetime", TimestampNTZType()),
    ("date", DateType()),
    ("bool", BooleanType()),
]


@dataclass(frozen=True)
class RegistryColumn:
    """A property of a registry entry; ``order`` is its place in the source (from 1) or None, ``kind`` its Spark type or
    None where the type word says nothing."""

    name: str
    order: int | None
    source: str
    kind: DataType | None
    default: Any = None

    @property
    def type(self) -> DataType:
        return self.kind or StringType()

    def filler(self) -> Column:
        """What a frame without this column gets: the default, False for a flag, empty text for an unknown type, else NULL."""
        if self.default is not None:
            return F.lit(self.default).cast(self.type)
        if self.kind is None:
            return F.lit("")
        return F.lit(False) if isinstance(self.kind, BooleanType) else F.lit(None).cast(self.kind)


@dataclass
class Registry:
    table: str
    properties: dict
    dimensions: list = field(default_factory=list)
    metrics: list = field(default_factory=list)
    cluster_keys: list = field(default_factory=list)

    def columns(self) -> list[RegistryColumn]:
        """The properties that have a place in the source, in that order."""
        found = [_column(name, prop) for name, prop in self.properties.items()]
        return sorted((c for c in found if c.order is not None), key=lambda c: c.order)


def settings(text: Any) -> dict[str, str]:
    """``"key = value, other = value"`` as a dict with lower-case keys; text without ``=`` has no setting."""
    pairs = (part.partition("=") for part in re.split("[,;]", str(text or "")))
    return {key.strip().lower(): value.strip() for key, eq, value in pairs if eq and key.strip()}


def _column(name: str, prop: Mapping[str, Any]) -> RegistryColumn:
    order = settings(prop.get("description")).get("source_order", "")
    renamed = list(settings(prop.get("default_source")).values())
    return RegistryColumn(name.lower(), int(order) if re.fullmatch(r"\d+", order) else None, (renamed or [name])[0].lower(), _kind(prop.get("type")), prop.get("default"))


def _kind(word: Any) -> DataType | None:
    word = str(word or "").strip().lower()
    return next((kind for words, kind in TYPE_WORDS if re.search(words, word)), None)


def registry_type(word: str | None) -> DataType:
    """Registry type word → Spark type (text if it says nothing)."""
    return _kind(word) or StringType()


def load_registry(source: str | Path | Mapping[str, Any], table: str) -> Registry:
    """Registry entry of ``table`` from a JSON file or dict (either top-level or under ``definitions``)."""
    if isinstance(source, Mapping):
        d = dict(source)
    else:
        with open(source) as f:
            d = json.load(f)
    d = d.get("definitions", d)
    entry = d[table]
    ck = entry.get("cluster_keys") or {}
    return Registry(
        table=table,
        properties=dict(entry.get("properties", {})),
        dimensions=list(entry.get("dimensions", [])),
        metrics=list(entry.get("metrics", [])),
        cluster_keys=list(ck.get("columns", [])) if isinstance(ck, Mapping) else list(ck),
    )


def registry_columns(reg: Registry) -> list[str]:
    """Raw columns (those with a source order), lower case, in source order."""
    return [c.name for c in reg.columns()]


def registry_schema(reg: Registry) -> StructType:
    """``StructType`` in source order; metadata keeps source order, default and source column."""
    fields = []
    for c in reg.columns():
        meta = {"source_order": c.order, "source_column": c.source}
        if c.default is not None:
            meta["default"] = str(c.default)
        fields.append(StructField(c.name, c.type, True, meta))
    return StructType(fields)


def select_by_position(df: DataFrame, reg: Registry, cast: bool = True) -> DataFrame:
    """Positional select (``$1, $3, ...``) from a headerless read (``_c0, _c1, ...``).

    Columns named in ``SKIP_ON_LOAD`` are never selected; with ``cast`` values are ``try_cast``
    to the registry types (text that does not cast becomes NULL).
    """
    wanted = [c for c in reg.columns() if c.name not in SKIP_ON_LOAD]
    at = {c.name: F.col(f"_c{c.order - 1}") for c in wanted}
    return df.select(*[(at[c.name].try_cast(c.type) if cast else at[c.name]).alias(c.name) for c in wanted])


def resolve_schema(df: DataFrame, reg: Registry) -> DataFrame:
    """Fit a frame to the registry: rename from source columns, keep and order registry columns,
    drop the rest, add missing ones (default / typed NULL / False).  Case-insensitive both ways.

    Raises ``ValueError`` when no registry column is present.
    """
    there = {name.lower(): F.col(f"`{name}`") for name in df.columns}
    columns = reg.columns()
    found = {c.name: there.get(c.source, there.get(c.name)) for c in columns}
    if all(x is None for x in found.values()):
        raise ValueError(f"no registry column of {reg.table!r} in frame columns {df.columns}")
    return df.select(*[(c.filler() if found[c.name] is None else found[c.name]).alias(c.name) for c in columns])
