"""Channel types, channel definitions and shapes."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the wire format: channel type name -> numpy code.
WIRE_CODES = {
    "int8": "i1",
    "uint8": "u1",
    "int16": "i2",
    "uint16": "u2",
    "int32": "i4",
    "uint32": "u4",
    "int64": "i8",
    "uint64": "u8",
    "float32": "f4",
    "float64": "f8",
    "bool": "?",
    "string": "u1",
}
DEFAULT_TYPE = "float64"

# Fixed values of the wire format: the two header versions and the compression names.
MAIN_HEADER_TYPE = "bsr_m-1.1"
DATA_HEADER_TYPE = "bsr_d-1.1"
COMPRESSIONS = ("none", "lz4", "bitshuffle_lz4")

# Every type gets a Spark type that holds all of its values: unsigned types go one step up.
SPARK_TYPES = {
    "int8": T.ByteType(),
    "uint8": T.ShortType(),
    "int16": T.ShortType(),
    "uint16": T.IntegerType(),
    "int32": T.IntegerType(),
    "uint32": T.LongType(),
    "int64": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
}

# One slot of the `value` struct per kind of value; arrays use the slot with an "a" in front.
VALUE_TYPE = T.StructType(
    [
        T.StructField("i", T.LongType()),
        T.StructField("u", T.DecimalType(20, 0)),
        T.StructField("f", T.DoubleType()),
        T.StructField("b", T.BooleanType()),
        T.StructField("s", T.StringType()),
        T.StructField("ai", T.ArrayType(T.LongType())),
        T.StructField("au", T.ArrayType(T.DecimalType(20, 0))),
        T.StructField("af", T.ArrayType(T.DoubleType())),
        T.StructField("ab", T.ArrayType(T.BooleanType())),
    ]
)


def type_name(declared: str | None) -> str:
    """The channel type as looked up: lower case, float64 when none is declared."""
    return DEFAULT_TYPE if declared is None else declared.lower()


def value_slot(declared: str | None) -> str:
    """Scalar slot of the value struct that holds this channel type."""
    name = type_name(declared)
    if name.startswith("int") or name in ("uint8", "uint16", "uint32"):
        return "i"
    return {"uint64": "u", "bool": "b", "string": "s"}.get(name, "f")


def is_scalar_shape(shape: Sequence[int] | None) -> bool:
    return shape is None or list(shape) == [1]


def spark_type(declared: str | None, shape: Sequence[int] | None = None) -> T.DataType:
    """Spark type of a channel: a scalar, or a flat array when the shape is not [1]."""
    name = type_name(declared)
    if name not in SPARK_TYPES:
        raise ValueError(f"unknown channel type {declared!r}, known are {list(SPARK_TYPES)}")
    element = SPARK_TYPES[name]
    if name == "string" or is_scalar_shape(shape):
        return element
    return T.ArrayType(element)


@dataclass(frozen=True)
class ChannelDef:
    """Definition of one channel as the data header carries it."""

    name: str
    type: str | None = None
    shape: tuple[int, ...] | None = None
    encoding: str | None = None
    compression: str | None = None

    @staticmethod
    def of(spec: "ChannelDef | dict | str") -> "ChannelDef":
        if isinstance(spec, ChannelDef):
            return spec
        if isinstance(spec, str):
            return ChannelDef(spec)
        shape = spec.get("shape")
        return ChannelDef(
            spec["name"],
            spec.get("type"),
            None if shape is None else tuple(shape),
            spec.get("encoding"),
            spec.get("compression"),
        )

    @property
    def endian(self) -> str:
        """Numpy byte order mark; anything that is not "big" counts as little."""
        return ">" if self.encoding == "big" else "<"

    @property
    def code(self) -> str:
        return self.endian + WIRE_CODES[type_name(self.type)]

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.type, self.shape)

    @property
    def n_elements(self) -> int | None:
        """Number of elements the shape asks for, None when the shape leaves it open."""
        return None if is_scalar_shape(self.shape) else math.prod(self.shape)

    def header_entry(self) -> dict:
        entry = {"name": self.name}
        if self.type is not None:
            entry["type"] = self.type
        if self.shape is not None:
            entry["shape"] = list(self.shape)
        if self.encoding is not None:
            entry["encoding"] = self.encoding
        if self.compression is not None:
            entry["compression"] = self.compression
        return entry


def channel_defs(specs: Iterable["ChannelDef | dict | str"]) -> list[ChannelDef]:
    return [ChannelDef.of(spec) for spec in specs]


def typed_value(value: Column, declared: str | None, shape: Sequence[int] | None = None) -> Column:
    """Read the value struct of `samples` as the Spark type of one channel."""
    slot = value_slot(declared)
    target = spark_type(declared, shape)
    if isinstance(target, T.ArrayType):
        slot = "a" + slot
    return value[slot].cast(target)


# ---- shapes: the wire names the fastest dimension first, so an image of shape [w, h] has h rows of w ----


def pixel(flat: Column, width: Column | int, x: Column | int, y: Column | int) -> Column:
    """Element (x, y) of an image kept as a flat array."""
    width, x, y = (c if isinstance(c, Column) else F.lit(c) for c in (width, x, y))
    return F.element_at(flat, (y * width + x + 1).cast("int"))


def reshape(flat: Column, shape: Sequence[int]) -> Column:
    """Nest a flat array by its shape, slowest dimension outermost; NULL when the sizes disagree.

    Shape [1] (a scalar slot) leaves the array as it is.
    """
    if is_scalar_shape(shape):
        return flat
    nested = flat
    sizes = list(shape)
    total = math.prod(sizes)
    # Cut into rows of the fastest dimension, then rows into planes, and so on.
    for depth, size in enumerate(sizes[:-1]):
        count = math.prod(sizes[depth + 1 :])
        nested = _chunks(nested, size, count)
    return F.when(F.size(flat) == total, nested)


def _chunks(array: Column, size: int, count: int) -> Column:
    starts = F.sequence(F.lit(0), F.lit(count - 1))
    return F.transform(starts, lambda i: F.slice(array, i * size + 1, F.lit(size)))
