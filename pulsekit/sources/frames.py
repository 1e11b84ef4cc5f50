"""Captured messages: reading, decoding into tables, and encoding tables back.

A frame is one message: `stream_id`, `arrival_seq`, `recv_ts` and `parts`, an array of binaries holding
the main header, the data header, and a value and a timestamp part per channel. Every message brings its
data header along, so decoding needs no state: it is one narrow stage, the same in batch and streaming.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pulsekit.functions import wire
from pulsekit.functions.compression import pack
from pulsekit.functions.timestamps import header_seconds
from pulsekit.functions.types import (
    COMPRESSIONS,
    DATA_HEADER_TYPE,
    MAIN_HEADER_TYPE,
    VALUE_TYPE,
    ChannelDef,
    channel_defs,
    type_name,
    value_slot,
)
from pulsekit.operators.scan import OrderedScan

FRAMES_SCHEMA = "stream_id string, arrival_seq bigint, recv_ts timestamp, parts array<binary>"

_HEADER_SCHEMA = (
    "pulse_id bigint, hash string, dh_compression string, "
    "global_timestamp struct<sec: bigint, epoch: bigint, ns: bigint>"
)
# Parsed headers a task keeps at a time.
_KNOWN_HEADERS = 1000
_DATA_HEADER_SCHEMA = "channels array<struct<name: string>>"


def read_frames(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """A1: captured messages from Parquet, as a table or as a stream (`maxFilesPerTrigger` sets its pace)."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(FRAMES_SCHEMA).options(**options).parquet(path)


def header_hash(header: Column) -> Column:
    """H8: the hash a main header names: MD5 of the data header bytes as sent."""
    return F.md5(header)


def with_headers(frames: DataFrame) -> DataFrame:
    """Frames with the fields of their main header as columns."""
    header = F.from_json(F.get("parts", F.lit(0)).cast("string"), _HEADER_SCHEMA)
    rows = frames.withColumn("_h", header)
    stamp = F.col("_h.global_timestamp")
    return rows.withColumns(
        {
            "pulse_id": F.col("_h.pulse_id"),
            "header_hash": F.col("_h.hash"),
            "dh_compression": F.col("_h.dh_compression"),
            "global_sec": header_seconds(stamp),
            "global_ns": stamp["ns"],
            "_stamped": stamp.isNotNull(),
        }
    ).drop("_h")


def decode_messages(frames: DataFrame) -> DataFrame:
    """The envelope of each message, without touching its values; stays in the JVM.

    `n_channels` is what the data header declares, at any length; a packed header, or one that cannot be read, counts
    the channels delivered.
    `status` is ok, empty_header, bad_header, bad_timestamp or no_channels.
    """
    rows = with_headers(frames)
    first, second = F.get("parts", F.lit(0)), F.get("parts", F.lit(1))
    no_header = first.isNull() | (F.length(first) == 0) | (F.trim(first.cast("string")) == "{}")
    plain = F.coalesce(F.col("dh_compression"), F.lit("none")) == "none"
    declared = F.size(F.from_json(F.when(plain, second.cast("string")), _DATA_HEADER_SCHEMA)["channels"])
    delivered = F.greatest(F.floor((F.size("parts") - 1) / 2).cast("int"), F.lit(0))
    n_channels = F.when(declared >= 0, declared).otherwise(delivered)
    status = (
        F.when(no_header, "empty_header")
        .when(F.col("pulse_id").isNull() | F.col("header_hash").isNull(), "bad_header")
        .when(F.col("_stamped") & F.col("global_sec").isNull(), "bad_timestamp")
        .when(n_channels == 0, "no_channels")
        .otherwise("ok")
    )
    n_bytes = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + F.coalesce(F.length(p), F.lit(0)))
    kept = [c for c in ("stream_id", "arrival_seq", "recv_ts") if c in frames.columns]
    return rows.select(
        *kept,
        "pulse_id",
        "header_hash",
        "global_sec",
        "global_ns",
        n_bytes.alias("n_bytes"),
        n_channels.alias("n_channels"),
        status.alias("status"),
    )


# ---- decoding ----

_SAMPLE_FIELDS = [
    T.StructField("stream_id", T.StringType()),
    T.StructField("arrival_seq", T.LongType()),
    T.StructField("pulse_id", T.LongType()),
    T.StructField("header_hash", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("channel", T.StringType()),
    T.StructField("value", VALUE_TYPE),
    T.StructField("shape", T.ArrayType(T.IntegerType())),
    T.StructField("ts_sec", T.LongType()),
    T.StructField("ts_ns", T.LongType()),
    T.StructField("status", T.StringType()),
]
SAMPLES_SCHEMA = T.StructType(_SAMPLE_FIELDS)


class _Parts:
    """The parts of one batch of messages, addressed by message and position."""

    def __init__(self, batch: pa.RecordBatch):
        lists = batch.column("parts")
        self.values = lists.values
        bounds = lists.offsets.to_numpy()
        self.starts = bounds[:-1].astype(np.int64)
        self.sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(bounds), 0)

    def at(self, rows: np.ndarray, position: int) -> pa.Array:
        return pc.fill_null(self.values.take(pa.array(self.starts[rows] + position)), b"")


class _Heads:
    """The messages of a batch that have a usable main header, with its fields as columns."""

    def __init__(self, batch: pa.RecordBatch, parts: _Parts):
        rows = np.flatnonzero(parts.sizes > 1)
        fields = dict(zip(wire.MAIN_HEADER_FIELDS, wire.parse_main_headers(parts.at(rows, 0)).flatten()))
        usable = pc.and_(fields["pulse_id"].is_valid(), fields["hash"].is_valid())
        self.rows = rows[usable.to_numpy(zero_copy_only=False)]
        fields = {name: array.filter(usable) for name, array in fields.items()}
        stamp = fields["global_timestamp"]
        self.packing = pc.fill_null(fields["dh_compression"], "none")
        picked = pa.array(self.rows)
        self.columns = {
            "stream_id": batch.column("stream_id").take(picked),
            "arrival_seq": batch.column("arrival_seq").take(picked),
            "pulse_id": fields["pulse_id"],
            "header_hash": fields["hash"],
            "global_sec": pc.coalesce(pc.struct_field(stamp, "sec"), pc.struct_field(stamp, "epoch")),
            "global_ns": pc.struct_field(stamp, "ns"),
        }


def _by_header(heads: _Heads, parts: _Parts, cache: dict) -> Iterator[tuple[list[ChannelDef] | None, np.ndarray]]:
    """Places in `heads`, grouped by data header; parsed data headers are kept for later batches."""
    if not len(heads.rows):
        return
    headers = parts.at(heads.rows, 1).dictionary_encode()
    packings = heads.packing.dictionary_encode()
    code = headers.indices.to_numpy() * len(packings.dictionary) + packings.indices.to_numpy()
    for key in np.unique(code):
        h, p = divmod(int(key), len(packings.dictionary))
        identity = (headers.dictionary[h].as_py(), packings.dictionary[p].as_py())
        if identity not in cache:
            _make_room(cache)
            cache[identity] = wire.parse_data_header(*identity)
        yield cache[identity], np.flatnonzero(code == key)


def _make_room(known: dict | set) -> None:
    """A stream that changes its header all the time must not fill a task's memory with old ones."""
    if len(known) >= _KNOWN_HEADERS:
        known.clear()


def _read_channel(parts: _Parts, rows: np.ndarray, ordinal: int, channel: ChannelDef):
    """Value slots, seconds, nanoseconds and status of one channel over the given messages."""
    position = 2 + 2 * ordinal
    raw = parts.at(rows, position)
    slots, status = wire.read_values(raw, channel)
    # A message may end right after a value, and an empty value voids the timestamp sent with it.
    timed = parts.sizes[rows] > position + 1
    stamps = parts.at(rows[timed], position + 1)
    sec, ns = wire.read_times(stamps, channel.endian)
    sec, ns = wire.spread(sec, timed), wire.spread(ns, timed)
    given = pc.greater(pc.binary_length(raw), 0)
    nothing = pa.scalar(None, pa.int64())
    return slots, pc.if_else(given, sec, nothing), pc.if_else(given, ns, nothing), status


def decode_frames(frames: DataFrame, channels: Iterable[str] | None = None) -> DataFrame:
    """A2: one row per message and channel, with a typed value and a status.

    `channels` limits the work to these names: parts of others are not decoded. A value that cannot be
    read is NULL with a status. Messages without a usable header give no rows here and are found by
    :func:`decode_messages`.
    """
    wanted = None if channels is None else frozenset(channels)
    names = [f.name for f in _SAMPLE_FIELDS]
    schema = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in _SAMPLE_FIELDS])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in (part for whole in batches for part in _slices(whole)):
            parts = _Parts(batch)
            heads = _Heads(batch, parts)
            for defs, places in _by_header(heads, parts, cache):
                for ordinal, channel in enumerate(defs or ()):
                    if wanted is not None and channel.name not in wanted:
                        continue
                    present = places[parts.sizes[heads.rows[places]] > 2 + 2 * ordinal]
                    if not len(present):
                        continue
                    slots, sec, ns, status = _read_channel(parts, heads.rows[present], ordinal, channel)
                    n, picked = len(present), pa.array(present)
                    shape = None if channel.shape is None else list(channel.shape)
                    columns = {
                        "ordinal": pa.repeat(pa.scalar(ordinal, pa.int32()), n),
                        "channel": pa.repeat(pa.scalar(channel.name), n),
                        "value": wire.value_struct(slots, n),
                        "shape": pa.repeat(pa.scalar(shape, pa.list_(pa.int32())), n),
                        "ts_sec": sec,
                        "ts_ns": ns,
                        "status": wire.STATUS_NAMES.take(pa.array(status)),
                    }
                    arrays = [columns[c] if c in columns else heads.columns[c].take(picked) for c in names]
                    arrays = [a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, schema)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return frames.select("stream_id", "arrival_seq", "parts").mapInArrow(decode, SAMPLES_SCHEMA)


def decode_wide(frames: DataFrame, channels: Iterable[ChannelDef | dict]) -> DataFrame:
    """One typed row per message for a fixed set of channels: no explode, no pivot, no shuffle.

    A channel a message does not have, or declares with another type or another scalar/array form, is
    NULL there; the long form of :func:`decode_frames` keeps such values.
    """
    defs = channel_defs(channels)
    meta = [
        T.StructField("stream_id", T.StringType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("pulse_id", T.LongType()),
        T.StructField("header_hash", T.StringType()),
        T.StructField("global_sec", T.LongType()),
        T.StructField("global_ns", T.LongType()),
    ]
    fields = meta + [T.StructField(d.name, d.spark_type) for d in defs]
    schema = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in fields])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in (part for whole in batches for part in _slices(whole)):
            parts = _Parts(batch)
            heads = _Heads(batch, parts)
            for found, places in _by_header(heads, parts, cache):
                if not found:
                    continue
                rows = heads.rows[places]
                place = {d.name: (i, d) for i, d in enumerate(found)}
                arrays = [heads.columns[f.name].take(pa.array(places)) for f in meta]
                for d in defs:
                    target = schema.field(d.name).type
                    column = pa.nulls(len(rows), target)
                    ordinal, actual = place.get(d.name, (None, None))
                    if actual is not None and type_name(actual.type) == type_name(d.type):
                        present = parts.sizes[rows] > 2 + 2 * ordinal
                        slots, _, _, _ = _read_channel(parts, rows[present], ordinal, actual)
                        slot = ("a" if pa.types.is_list(target) else "") + value_slot(d.type)
                        if slot in slots:
                            column = wire.spread(slots[slot].cast(target), present)
                    arrays.append(column)
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return frames.select("stream_id", "arrival_seq", "parts").mapInArrow(decode, T.StructType(fields))


def frame_defs(frames: DataFrame) -> DataFrame:
    """The channel definitions in use: one row per data header and position.

    Each task names a header once, however many messages carry it, so next to nothing is shuffled.
    """
    fields = ["type", "shape", "encoding", "compression"]
    schema = "header_hash string, ordinal int, channel string, type string, shape array<int>, encoding string, compression string"
    types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.string()]

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        named: set = set()
        for batch in batches:
            parts = _Parts(batch)
            heads = _Heads(batch, parts)
            rows = []
            for defs, places in _by_header(heads, parts, cache):
                for declared in heads.columns["header_hash"].take(pa.array(places)).unique().to_pylist():
                    if defs is None or (declared, tuple(defs)) in named:
                        continue
                    _make_room(named)
                    named.add((declared, tuple(defs)))
                    for i, d in enumerate(defs):
                        shape = None if d.shape is None else list(d.shape)
                        rows.append((declared, i, d.name, type_name(d.type), shape, d.encoding, d.compression))
            if rows:
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(arrays, names=["header_hash", "ordinal", "channel", *fields])

    heads_only = frames.select("stream_id", "arrival_seq", F.slice("parts", 1, 2).alias("parts"))
    named = heads_only.mapInArrow(name, schema)
    one = F.min(F.struct("channel", *fields)).alias("_def")
    return named.groupBy("header_hash", "ordinal").agg(one).select("header_hash", "ordinal", "_def.*")


# ---- parallel lists per message ----


def collect_extended(samples: DataFrame) -> DataFrame:
    """A3: per message, lists aligned by channel: names, values, seconds, nanoseconds, pulse ids.

    A channel without a value has NULL in all lists but the names. A message's channels are the group,
    so groups stay as small as messages are.
    """
    keys = [c for c in ("stream_id", "arrival_seq", "pulse_id", "header_hash") if c in samples.columns]
    entry = F.struct("ordinal", "channel", "value", "ts_sec", "ts_ns")
    held = samples.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    when_there = lambda e, c: F.when(e["value"].isNotNull(), c)
    return held.select(
        *keys,
        F.transform("_e", lambda e: e["channel"]).alias("channels"),
        F.transform("_e", lambda e: e["value"]).alias("data"),
        F.transform("_e", lambda e: when_there(e, e["ts_sec"])).alias("timestamp"),
        F.transform("_e", lambda e: when_there(e, e["ts_ns"])).alias("timestamp_offset"),
        F.transform("_e", lambda e: when_there(e, F.col("pulse_id"))).alias("pulse_ids"),
    )


def to_long(extended: DataFrame) -> DataFrame:
    """A3, the other way: one row per message and channel from the aligned lists."""
    keys = [c for c in ("stream_id", "arrival_seq", "pulse_id", "header_hash") if c in extended.columns]
    zipped = F.arrays_zip("channels", "data", "timestamp", "timestamp_offset")
    rows = extended.select(*keys, F.posexplode(zipped).alias("ordinal", "_e"))
    return rows.select(
        *keys,
        "ordinal",
        F.col("_e.channels").alias("channel"),
        F.col("_e.data").alias("value"),
        F.col("_e.timestamp").alias("ts_sec"),
        F.col("_e.timestamp_offset").alias("ts_ns"),
    )


# ---- encoding ----

# Spark column type -> channel type, where none is declared.
_INFERRED = {
    "boolean": "bool",
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float32",
    "double": "float64",
    "string": "string",
    "decimal(20,0)": "uint64",
    "void": "float64",
}
_ROW_COLUMNS = ("stream_id", "arrival_seq", "recv_ts", "pulse_id", "global_sec", "global_ns")


def channel_type_of(column_type: str) -> str:
    """Channel type for a Spark column type; arrays go by their elements."""
    element = column_type.removeprefix("array<").removesuffix(">") if column_type.startswith("array<") else column_type
    if element not in _INFERRED:
        raise ValueError(f"no channel type for column type {column_type}")
    return _INFERRED[element]


def infer_specs(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """H9: type, shape and encoding of each column as a channel, one row per column.

    Scalars have shape [1]; an array column must have one size throughout, which is its shape.
    """
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in _ROW_COLUMNS]
    types = dict(df.dtypes)
    arrays = [c for c in columns if types[c].startswith("array<")]
    sizes = [F.min(F.size(f"`{c}`")).alias(f"lo_{i}") for i, c in enumerate(arrays)]
    sizes += [F.max(F.size(f"`{c}`")).alias(f"hi_{i}") for i, c in enumerate(arrays)]
    found = df.agg(F.count(F.lit(1)).alias("n"), *sizes)
    entries = []
    for ordinal, c in enumerate(columns):
        shape = F.array(F.lit(1))
        if c in arrays:
            i = arrays.index(c)
            lo, hi = F.col(f"lo_{i}"), F.col(f"hi_{i}")
            message = F.concat(F.lit(f"sizes of array column {c} vary from "), lo.cast("string"), F.lit(" to "), hi.cast("string"))
            shape = F.when(lo == hi, F.array(hi)).otherwise(F.raise_error(message).cast("array<int>"))
        entries.append(
            F.struct(
                F.lit(ordinal).alias("ordinal"),
                F.lit(c).alias("channel"),
                F.lit(channel_type_of(types[c])).alias("type"),
                shape.alias("shape"),
                F.lit("little").alias("encoding"),
            )
        )
    return found.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def _specs_for(wide: DataFrame, specs: Iterable[ChannelDef | dict | str] | None, compression: str | None) -> list[ChannelDef]:
    types = dict(wide.dtypes)
    given = channel_defs(specs) if specs is not None else [ChannelDef(c) for c in wide.columns if c not in _ROW_COLUMNS]
    full = []
    for d in given:
        if d.name not in types:
            raise ValueError(f"no column for channel {d.name!r}")
        is_array = types[d.name].startswith("array<")
        full.append(
            ChannelDef(
                d.name,
                d.type or channel_type_of(types[d.name]),
                d.shape if d.shape is not None or is_array else (1,),
                d.encoding or "little",
                d.compression or compression,
            )
        )
    for c in [compression, *[d.compression for d in full]]:
        if c is not None and c not in COMPRESSIONS:
            raise ValueError(f"unknown compression {c!r}, known are {list(COMPRESSIONS)}")
    return full


def data_header(defs: Iterable[ChannelDef]) -> bytes:
    return json.dumps({"htype": DATA_HEADER_TYPE, "channels": [d.header_entry() for d in defs]}).encode()


def encode_frames(
    wide: DataFrame,
    specs: Iterable[ChannelDef | dict | str] | None = None,
    header_compression: str | None = None,
    data_compression: str | None = None,
) -> DataFrame:
    """One message per row, with a channel per column of `specs` (all channel columns by default).

    Rows need `pulse_id`, `global_sec` and `global_ns`; missing `stream_id`, `arrival_seq`, `recv_ts` are
    filled. Without a declared shape an array goes out with the size it has, under a header of its own.
    NULL is sent as an empty value and timestamp. Compression names are checked before anything runs.
    """
    if header_compression is not None and header_compression not in COMPRESSIONS:
        raise ValueError(f"unknown header compression {header_compression!r}, known are {list(COMPRESSIONS)}")
    defs = _specs_for(wide, specs, data_compression)
    fill = {
        "stream_id": F.lit("stream"),
        "arrival_seq": F.col("pulse_id").cast("bigint"),
        "recv_ts": F.timestamp_micros(F.col("global_sec") * 1_000_000 + F.floor(F.col("global_ns") / F.lit(1000)).cast("bigint")),
    }
    meta = [F.col(c) if c in wide.columns else fill[c].alias(c) for c in ("stream_id", "arrival_seq", "recv_ts")]
    rows = wide.select(
        *meta,
        F.col("pulse_id").cast("bigint").alias("pulse_id"),
        F.col("global_sec").cast("bigint").alias("global_sec"),
        F.col("global_ns").cast("bigint").alias("global_ns"),
        *[F.col(f"`{d.name}`") for d in defs],
    )
    kept = list(_ROW_COLUMNS)
    out_fields = [rows.schema[c] for c in kept] + [
        T.StructField("header_hash", T.StringType()),
        T.StructField("_tail", T.ArrayType(T.BinaryType())),
    ]
    open_shapes = [i for i, d in enumerate(defs) if d.shape is None]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headers: dict[tuple, tuple[bytes, str]] = {}
        for batch in (part for whole in batches for part in _slices(whole, len(defs))):
            n = batch.num_rows
            columns = [batch.column(len(kept) + i) for i in range(len(defs))]
            heads, hashes = _headers_of(columns, defs, open_shapes, n, header_compression, headers)
            parts = [heads]
            for column, d in zip(columns, defs):
                valid = column.is_valid().to_numpy(zero_copy_only=False)
                parts.append(wire.write_values(column, d))
                parts.append(wire.write_times(batch.column("global_sec"), batch.column("global_ns"), valid, d.endian))
            # Part k of message m stands at k * n + m; a message wants all its parts in a row.
            order = np.arange(len(parts) * n).reshape(len(parts), n).T.ravel()
            flat = pa.chunked_array(parts).combine_chunks().take(pa.array(order))
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(parts))
            tail = pa.ListArray.from_arrays(ends, flat)
            arrays = [batch.column(c) for c in kept] + [hashes, tail]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in out_fields])

    encoded = rows.mapInArrow(encode, T.StructType(out_fields))
    packing = "" if header_compression is None else f'"dh_compression":"{header_compression}",'
    # Numbers and a hexadecimal hash need no escaping, and joining them is much cheaper than to_json.
    stamp = F.concat(
        F.lit(',"global_timestamp":{"sec":'),
        F.col("global_sec").cast("string"),
        F.lit(',"ns":'),
        F.col("global_ns").cast("string"),
        F.lit("}"),
    )
    main_header = F.concat(
        F.lit(f'{{"htype":"{MAIN_HEADER_TYPE}",{packing}"hash":"'),
        F.col("header_hash"),
        F.lit('","pulse_id":'),
        F.col("pulse_id").cast("string"),
        F.coalesce(stamp, F.lit("")),
        F.lit("}"),
    )
    # A row without a pulse id cannot be a message; it goes out with an empty header, and is found as such.
    main_header = F.coalesce(main_header, F.lit("{}")).cast("binary")
    return encoded.select(
        "stream_id", "arrival_seq", "recv_ts", F.concat(F.array(main_header), F.col("_tail")).alias("parts")
    )


def _slices(batch: pa.RecordBatch, channels: int = 0, most: int = 1 << 25) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose parts stay below `most` bytes; a value grows eightfold at most, and has 16 bytes of time.

    Reading and writing copy parts several times: a task holds a batch as it came, and the copies of one slice.
    """
    if not batch.num_rows:
        return
    a_row = 8 * batch.nbytes / batch.num_rows + 16 * channels
    step = max(1, int(most // a_row))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _headers_of(
    columns: list[pa.Array],
    defs: list[ChannelDef],
    open_shapes: list[int],
    n: int,
    compression: str | None,
    cache: dict[tuple, tuple[bytes, str]],
) -> tuple[pa.Array, pa.Array]:
    """Data header and its hash for each row; rows share a header when their array sizes agree."""
    sizes = np.zeros((n, len(open_shapes)), np.int64)
    for j, i in enumerate(open_shapes):
        sizes[:, j] = pc.fill_null(pc.list_value_length(columns[i]), 1).to_numpy(zero_copy_only=False)
    kinds, kind_of = np.unique(sizes, axis=0, return_inverse=True) if open_shapes else (sizes[:1], np.zeros(n, int))
    heads, hashes = [], []
    for kind in kinds:
        key = tuple(int(size) for size in kind)
        if key not in cache:
            _make_room(cache)
            shapes = dict(zip(open_shapes, key))
            shaped = [
                ChannelDef(d.name, d.type, (shapes[i],), d.encoding, d.compression) if i in shapes else d
                for i, d in enumerate(defs)
            ]
            header = pack(data_header(shaped), compression, "u1")
            cache[key] = (header, hashlib.md5(header).hexdigest())
        heads.append(cache[key][0])
        hashes.append(cache[key][1])
    places = pa.array(np.asarray(kind_of).ravel())
    return pa.array(heads, pa.binary()).take(places), pa.array(hashes, pa.string()).take(places)


# ---- building rows ----


def messages_from_rows(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Rows as channel values, by position (`names` must match the count) or by column name."""
    if names is None:
        return df
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} values for {len(names)} channels")
    return df.toDF(*names)


def with_channels(
    df: DataFrame,
    channels: dict[str, Column | Callable],
    metadata: dict[str, ChannelDef | dict] | None = None,
) -> DataFrame:
    """Add channels computed per pulse: a Column, or a function of a pandas Series of pulse ids.

    A channel with declared metadata is cast to that type; a function needs it.
    """
    metadata = metadata or {}
    for name, how in channels.items():
        declared = metadata.get(name)
        if isinstance(declared, dict):
            declared = ChannelDef.of({"name": name, **declared})
        target = None if declared is None else declared.spark_type
        if not isinstance(how, Column):
            how = F.pandas_udf(how, target or T.DoubleType())(F.col("pulse_id"))
        df = df.withColumn(name, how if target is None else how.cast(target))
    return df


def map_messages(frames: DataFrame, function: Callable, schema: T.StructType | str, arrow: bool = False) -> DataFrame:
    """Run an own handler over batches of messages (pandas frames, or Arrow batches)."""
    return frames.mapInArrow(function, schema) if arrow else frames.mapInPandas(function, schema)


def assign_pulse_ids(
    df: DataFrame, start: int = 0, explicit: str | None = "pulse_id", scan: OrderedScan = OrderedScan(), out: str = "pulse_id"
) -> DataFrame:
    """Number the rows of each stream from `start`; an explicit id re-bases the count from there.

    A bucket knows its row count and its last explicit id; what a bucket starts from follows from the
    buckets before it.
    """
    zero = F.lit(0).cast("bigint")
    given = F.lit(None).cast("bigint") if explicit is None else F.col(explicit).cast("bigint")
    rows = scan.bucketed(df).withColumn("_given", given)
    rows = rows.withColumn("_row", F.row_number().over(scan.local()).cast("bigint") - 1)
    # While no new id is given, id minus row number stays the same.
    rows = rows.withColumn("_base", F.last(F.col("_given") - F.col("_row"), ignorenulls=True).over(scan.local_until()))
    last_base = F.max_by("_base", scan.order).alias("_last_base")
    per_bucket = rows.groupBy(*scan.keys).agg(F.count(F.lit(1)).alias("_n"), last_base)
    before = scan.across_before()
    per_bucket = per_bucket.withColumn("_rows_before", F.coalesce(F.sum("_n").over(before), zero))
    carried = F.last(F.col("_last_base") - F.col("_rows_before"), ignorenulls=True).over(before)
    given_start = per_bucket.select(
        *scan.keys, (F.coalesce(carried, F.lit(start).cast("bigint")) + F.col("_rows_before")).alias("_carry")
    )
    numbered = scan.attached(rows, given_start)
    pulse = F.coalesce("_base", "_carry") + F.col("_row")
    return numbered.withColumn(out, pulse).drop("_given", "_row", "_base", "_carry", scan.bucket)
