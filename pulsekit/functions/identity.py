"""What makes a row itself, whatever the types of its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType)


def hashable(df: DataFrame) -> list[Column]:
    """The columns of a frame in a form that can be hashed: what holds a map goes as JSON, which names every entry."""
    columns = [(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return [F.to_json(F.struct(c.alias("v"))) if _holds_map(kind) else c for c, kind in columns]


def row_tag(df: DataFrame) -> Column:
    """128 bits of hash over all columns, as hex digits: rows that differ share one with a chance of 2^-128 a pair."""
    columns = hashable(df)
    halves = [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]
    return F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves])
