"""Message parts as Arrow columns: all values of one channel in a batch are read or written at once."""

from __future__ import annotations

import io
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import json as pj

from pulsekit.functions.compression import pack, unpack
from pulsekit.functions.types import COMPRESSIONS, WIRE_CODES, ChannelDef, type_name, value_slot

OK, EMPTY, UNKNOWN_TYPE, UNKNOWN_COMPRESSION, DECODE_ERROR = range(5)
STATUS_NAMES = pa.array(["ok", "empty", "unknown_type", "unknown_compression", "decode_error"])

SLOT_TYPES = {
    "i": pa.int64(),
    "u": pa.decimal128(20, 0),
    "f": pa.float64(),
    "b": pa.bool_(),
    "s": pa.string(),
    "ai": pa.list_(pa.int64()),
    "au": pa.list_(pa.decimal128(20, 0)),
    "af": pa.list_(pa.float64()),
    "ab": pa.list_(pa.bool_()),
}


# ---- headers ----

_MAIN_HEADER = pa.schema(
    [
        ("pulse_id", pa.int64()),
        ("hash", pa.string()),
        ("dh_compression", pa.string()),
        ("global_timestamp", pa.struct([("sec", pa.int64()), ("epoch", pa.int64()), ("ns", pa.int64())])),
    ]
)
MAIN_HEADER_FIELDS = _MAIN_HEADER.names


def parse_main_headers(parts: pa.Array) -> pa.StructArray:
    """Main headers of a batch of messages; NULL fields where one is empty or broken."""
    texts = parts.to_pylist()
    try:
        lines = b"\n".join(texts)
        found = pj.read_json(
            io.BytesIO(lines),
            read_options=pj.ReadOptions(use_threads=False, block_size=len(lines) + 1),
            parse_options=pj.ParseOptions(explicit_schema=_MAIN_HEADER, unexpected_field_behavior="ignore"),
        )
        if found.num_rows == len(texts):
            return found.combine_chunks().to_struct_array().combine_chunks()
    except (pa.ArrowException, TypeError):
        pass
    return pa.array([_main_header(text) for text in texts], pa.struct(list(_MAIN_HEADER)))


def _main_header(text: bytes | None) -> dict:
    """One header by itself, where the batch holds some that do not parse."""
    try:
        header = json.loads(text)
        stamp = header.get("global_timestamp")
        picked = {"global_timestamp": None}
        if isinstance(stamp, dict):
            picked["global_timestamp"] = {k: _typed(stamp.get(k), int) for k in ("sec", "epoch", "ns")}
        picked["pulse_id"] = _typed(header.get("pulse_id"), int)
        picked |= {k: _typed(header.get(k), str) for k in ("hash", "dh_compression")}
        return picked
    except Exception:  # not JSON, or not an object
        return {}


def _typed(value, kind: type):
    return value if type(value) is kind else None


def parse_data_header(data: bytes, compression: str | None) -> list[ChannelDef] | None:
    """Channel definitions of a data header, None when it cannot be read."""
    try:
        header = json.loads(unpack(data, compression, "u1"))
        return [ChannelDef.of(entry) for entry in header["channels"]]
    except Exception:  # whatever is wrong with it, the message has no definitions
        return None


# ---- Arrow helpers ----


def binary_layout(array: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Offsets and data buffer of a binary array."""
    if not len(array):
        return np.zeros(1, np.int32), pa.py_buffer(b"")
    width = np.int64 if pa.types.is_large_binary(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], width)[array.offset : array.offset + len(array) + 1]
    return offsets, array.buffers()[2] or pa.py_buffer(b"")


def spread(dense: pa.Array, mask: np.ndarray) -> pa.Array:
    """Put the values at the places where the mask is set, NULL elsewhere."""
    if mask.all():
        return dense
    places = np.cumsum(mask) - 1
    return dense.take(pa.array(places, pa.int64(), mask=~mask))


def numbers(flat: np.ndarray, slot: str) -> pa.Array:
    if slot == "u":
        return pa.array(flat.astype(np.uint64)).cast(SLOT_TYPES["u"])
    if slot == "b":
        return pa.array(flat.view(np.uint8) != 0)
    return pa.array(flat.astype(np.int64 if slot == "i" else np.float64))


# ---- reading ----


def read_values(parts: pa.Array, channel: ChannelDef) -> tuple[dict[str, pa.Array], np.ndarray]:
    """Values of one channel, by slot of the value struct, and a status per part.

    A part that cannot be read is NULL with a status, never an error. A declared shape must fit the
    number of elements; shape [1], or none, takes what is there: one element is a scalar, several an array.
    """
    offsets, _ = binary_layout(parts)
    given = np.diff(offsets) > 0
    status = np.where(given, OK, EMPTY).astype(np.int8)
    name = type_name(channel.type)
    if name not in WIRE_CODES:
        return {}, np.where(given, UNKNOWN_TYPE, status)
    if channel.compression is not None and channel.compression not in COMPRESSIONS:
        return {}, np.where(given, UNKNOWN_COMPRESSION, status)
    if channel.compression not in (None, "none"):
        parts, status = _unpacked(parts, channel, status)
        offsets, _ = binary_layout(parts)

    width = np.dtype(channel.code).itemsize
    lengths = np.diff(offsets)
    counts = lengths // width
    fits = lengths % width == 0
    if channel.shape is not None and list(channel.shape) != [1]:
        fits &= counts == (channel.n_elements if channel.shape else -1)
    readable = (status == OK) & fits
    status[(status == OK) & ~fits] = DECODE_ERROR

    slot = value_slot(channel.type)
    if slot == "s":
        return _read_text(parts, readable, status)
    scalar = readable & (counts == 1) & (channel.n_elements is None)
    arrays = readable & ~scalar
    slots = {}
    if scalar.any():
        slots[slot] = spread(numbers(_flat(parts, scalar, channel.code), slot), scalar)
    if arrays.any():
        ends = np.concatenate([[0], np.cumsum(counts[arrays])]).astype(np.int32)
        dense = pa.ListArray.from_arrays(pa.array(ends), numbers(_flat(parts, arrays, channel.code), slot))
        slots["a" + slot] = spread(dense, arrays)
    return slots, status


def _flat(parts: pa.Array, mask: np.ndarray, code: str) -> np.ndarray:
    """The elements of the chosen parts, one after the other."""
    # A filter copies the chosen parts into one buffer of their own.
    chosen = parts.filter(pa.array(mask))
    offsets, data = binary_layout(chosen)
    width = np.dtype(code).itemsize
    return np.frombuffer(data, code, int(offsets[-1] - offsets[0]) // width, int(offsets[0]))


def _unpacked(parts: pa.Array, channel: ChannelDef, status: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    plain = []
    for i, data in enumerate(parts.to_pylist()):
        value = b""
        if data:
            try:
                value = unpack(data, channel.compression, channel.code)
                if not value:
                    status[i] = EMPTY
            except Exception:  # any damage makes the value NULL
                status[i] = DECODE_ERROR
        plain.append(value)
    return pa.array(plain, pa.binary()), status


def _read_text(parts: pa.Array, readable: np.ndarray, status: np.ndarray) -> tuple[dict[str, pa.Array], np.ndarray]:
    chosen = parts.filter(pa.array(readable))
    try:
        return {"s": spread(chosen.cast(pa.string()), readable)}, status
    except pa.ArrowInvalid:
        texts = []
        for place, data in zip(np.flatnonzero(readable), chosen.to_pylist()):
            try:
                texts.append(data.decode())
            except UnicodeDecodeError:
                texts.append(None)
                status[place] = DECODE_ERROR
        return {"s": spread(pa.array(texts, pa.string()), readable)}, status


def read_times(parts: pa.Array, endian: str) -> tuple[pa.Array, pa.Array]:
    """Seconds and nanoseconds from 16-byte timestamp parts, NULL where there is none."""
    offsets, _ = binary_layout(parts)
    lengths = np.diff(offsets)
    there = (lengths >= 16) & (lengths % 8 == 0)
    chosen = pc.binary_slice(parts.filter(pa.array(there)), 0, 16)
    ends, data = binary_layout(chosen)
    pairs = np.frombuffer(data, endian + "i8", len(chosen) * 2, int(ends[0]) if len(ends) else 0).astype(np.int64)
    return spread(pa.array(pairs[0::2]), there), spread(pa.array(pairs[1::2]), there)


def value_struct(slots: dict[str, pa.Array], n: int) -> pa.Array:
    """The value struct of `samples`; NULL as a whole where no slot holds anything."""
    if not slots:
        return pa.nulls(n, pa.struct([pa.field(k, t) for k, t in SLOT_TYPES.items()]))
    columns = [slots[k] if k in slots else pa.nulls(n, t) for k, t in SLOT_TYPES.items()]
    held = np.zeros(n, bool)
    for array in slots.values():
        held |= array.is_valid().to_numpy(zero_copy_only=False)
    fields = [pa.field(k, t) for k, t in SLOT_TYPES.items()]
    return pa.StructArray.from_arrays(columns, fields=fields, mask=pa.array(~held))


# ---- writing ----


def write_values(column: pa.Array, channel: ChannelDef) -> pa.Array:
    """Value parts of one channel: empty for NULL, else the bytes of its declared type."""
    code = channel.code
    if type_name(channel.type) == "string":
        parts = column.cast(pa.string()).cast(pa.binary())
        return _packed(pc.fill_null(parts, b""), column, channel)
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        flat = column.flatten()
    else:
        counts = column.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.drop_null()
    if flat.null_count:
        if not pa.types.is_floating(flat.type):
            raise ValueError(f"channel {channel.name!r} has NULL elements in an array of {flat.type}")
        flat = pc.fill_null(flat, float("nan"))
    if pa.types.is_decimal(flat.type):
        flat = flat.cast(pa.uint64())
    elements = flat.to_numpy(zero_copy_only=False)
    if len(elements) and code[1:] == "?":
        elements = elements != 0
    data = np.ascontiguousarray(elements.astype(code)).tobytes()
    ends = np.concatenate([[0], np.cumsum(counts)]) * np.dtype(code).itemsize
    return _packed(_binary(ends, data, len(column)), column, channel)


def _binary(ends: np.ndarray, data: bytes, n: int) -> pa.Array:
    offsets = pa.py_buffer(ends.astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(data)])


def _packed(parts: pa.Array, column: pa.Array, channel: ChannelDef) -> pa.Array:
    if channel.compression in (None, "none"):
        return parts
    valid = column.is_valid().to_pylist()
    # Empty data still gets a packed header, unlike NULL.
    packed = [pack(p, channel.compression, channel.code) if v else b"" for p, v in zip(parts.to_pylist(), valid)]
    return pa.array(packed, pa.binary())


def write_times(sec: pa.Array, ns: pa.Array, valid: np.ndarray, endian: str) -> pa.Array:
    """Timestamp parts of 16 bytes, empty where the value is NULL."""
    pairs = np.empty((len(sec), 2), endian + "i8")
    pairs[:, 0] = pc.fill_null(sec, 0).to_numpy(zero_copy_only=False)
    pairs[:, 1] = pc.fill_null(ns, 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(valid)]) * 16
    return _binary(ends, pairs[valid].tobytes(), len(sec))
