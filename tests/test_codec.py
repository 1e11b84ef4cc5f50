"""Messages out and in again."""

import json
import math
import struct

import numpy as np
import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from pulsekit.functions import compression
from pulsekit.functions.types import spark_type, typed_value
from pulsekit.sources import frames as fr

META = "pulse_id bigint, global_sec bigint, global_ns bigint"


def sent(spark, values, schema, specs=None, **options):
    data = [(i, 123, 456, *v) for i, v in enumerate(values)]
    return fr.encode_frames(spark.createDataFrame(data, f"{META}, {schema}"), specs, **options)


def message(spark, channels, parts, main=None, header=None):
    main = {"pulse_id": 7, "hash": "h", "global_timestamp": {"sec": 1, "ns": 2}} if main is None else main
    header = json.dumps({"channels": channels}).encode() if header is None else header
    body = [json.dumps(main).encode(), header, *parts]
    return spark.createDataFrame([("s", 0, body)], "stream_id string, arrival_seq bigint, parts array<binary>")


def decoded(df):
    out = []
    for r in fr.decode_frames(df).orderBy("arrival_seq", "ordinal").collect():
        value = None
        if r.value is not None:
            value = next(v for v in r.value if v is not None)
        out.append((r.channel, value, r.status))
    return out


def test_channels_of_all_kinds(spark):
    """A message of scalars, text, a list, a curve and an image keeps order, type, shape and value."""
    names = ["turns", "gain", "label", "valve", "levels", "ramp", "frame"]
    values = [
        (3 - n, 0.25 * n - 1, f"run {n:03d} µ", n % 3 == 0, [n + 0.5, -n / 4], [float((n + 7 * k) % 11) for k in range(12)], [n * k for k in range(6)])
        for n in range(9)
    ]
    schema = "turns int, gain double, label string, valve boolean, levels array<float>, ramp array<double>, frame array<bigint>"
    specs = [*names[:5], {"name": "ramp", "shape": [12]}, {"name": "frame", "shape": [2, 3]}]
    frames = sent(spark, values, schema, specs)
    got = decoded(frames)
    k = len(names)
    assert [g[0] for g in got[:k]] == names
    assert [tuple(v for _, v, _ in got[k * n : k * n + k]) for n in range(len(values))] == values
    defs = rows(fr.frame_defs(frames), "ordinal", "channel", "type", "shape")
    assert [(d[1], d[2], d[3]) for d in defs] == list(
        zip(names, ["int32", "float64", "string", "bool", "float32", "float64", "int64"], [[1], [1], defs[2][3], [1], [2], [12], [2, 3]])
    )
    wide_specs = [{"name": d[1], "type": d[2], "shape": d[3]} for d in defs]
    back = fr.decode_wide(frames, wide_specs).orderBy("pulse_id")
    assert [tuple(r)[6:] for r in back.collect()] == values
    envelope = fr.decode_messages(frames).select("n_channels", "status", "global_sec", "global_ns").distinct().collect()
    assert [tuple(r) for r in envelope] == [(k, "ok", 123, 456)]


def test_bytes_of_every_type(spark):
    """Encoded values are the bytes the type has in numpy, for both byte orders."""
    kinds = {
        "int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "int64": "i8", "uint64": "u8",
        "float32": "f4", "float64": "f8", "bool": "?",
    }
    df = spark.createDataFrame([(7, 8, 9, [1, 0, 1])], f"{META}, v array<bigint>")
    for name, code in kinds.items():
        for order, mark in (("little", "<"), ("big", ">")):
            raw = fr.encode_frames(df, [{"name": "v", "type": name, "encoding": order}]).first().parts
            assert bytes(raw[2]) == np.array([1, 0, 1]).astype(mark + code).tobytes(), (name, order)
            assert bytes(raw[3]) == struct.pack(mark + "qq", 8, 9), (name, order)
    text = fr.encode_frames(spark.createDataFrame([(7, 8, 9, "ä b")], f"{META}, v string")).first().parts
    assert bytes(text[2]) == "ä b".encode()


@pytest.mark.parametrize("note", ["", "x" * 3000])
def test_channels_are_counted_in_the_header(spark, note):
    bare = json.dumps({"channels": [], "note": note}).encode()
    assert fr.decode_messages(message(spark, [], [b"1", b"2"], header=bare)).select("n_channels", "status").first() == (0, "no_channels")
    nested = json.dumps({"channels": [{"name": "a"}], "meta": {"channels": []}, "note": note}).encode()
    assert fr.decode_messages(message(spark, [], [b"1", b"2"], header=nested)).select("n_channels", "status").first() == (1, "ok")


def test_schema_change(spark):
    three = list(range(6))
    first = spark.createDataFrame([(0, 1, 2, 1, 2, three)], f"{META}, one bigint, two bigint, three array<int>")
    second = spark.createDataFrame([(0, 1, 2, 3, 4, three, 2.0)], f"{META}, one bigint, two bigint, three array<int>, four double")
    shaped = {"name": "three", "type": "uint16", "shape": [3, 2]}
    frames = fr.encode_frames(first, ["one", "two", shaped]).unionByName(fr.encode_frames(second, ["one", "two", shaped, "four"]))
    messages = fr.decode_messages(frames)
    assert [r.pulse_id for r in messages.collect()] == [0, 0]
    assert messages.select("header_hash").distinct().count() == 2
    got = fr.decode_frames(frames).where("channel = 'three'").collect()
    assert [(list(r["shape"]), list(r.value.ai)) for r in got] == [([3, 2], three)] * 2
    wide = fr.decode_wide(frames, [{"name": "four", "type": "float64"}, {"name": "one", "type": "int32"}])
    assert rows(wide, "four", "one") == [(2.0, None), (None, None)]


def test_nulls_and_empty_values(spark):
    frames = sent(spark, [(1, None, "one", [], "")], "one bigint, two double, three string, four array<double>, five string")
    assert decoded(frames) == [
        ("one", 1, "ok"), ("two", None, "empty"), ("three", "one", "ok"), ("four", None, "empty"), ("five", None, "empty"),
    ]
    times = rows(fr.decode_frames(frames), "channel", "ts_sec", "ts_ns")
    assert times == sorted([("one", 123, 456), ("two", None, None), ("three", 123, 456), ("four", None, None), ("five", None, None)])


def test_value_without_timestamp_and_short_messages(spark):
    one = struct.pack("<d", 1.5)
    channels = [{"name": "a"}, {"name": "b"}, {"name": "c"}]
    df = message(spark, channels, [one, b"", one])
    got = rows(fr.decode_frames(df), "channel", "value.f", "ts_sec", "status")
    assert got == [("a", 1.5, None, "ok"), ("b", 1.5, None, "ok")]
    empty_with_time = message(spark, channels[:1], [b"", struct.pack("<qq", 5, 6)])
    assert rows(fr.decode_frames(empty_with_time), "value", "ts_sec", "ts_ns") == [(None, None, None)]


@pytest.mark.parametrize("column,channel", [("smallint", "int16"), ("int", "int32"), ("bigint", "int64"), ("float", "float32"), ("double", "float64")])
def test_big_endian_arrays(spark, column, channel):
    data = [(1, 123456789, 987654321, [1] * 1024 if "int" in column else [1.0] * 1024)]
    df = spark.createDataFrame(data, f"{META}, v array<{column}>")
    frames = fr.encode_frames(df, [{"name": "v", "encoding": "big"}])
    raw = frames.first().parts
    assert bytes(raw[2]) == np.ones(1024, np.dtype(channel).newbyteorder(">")).tobytes()
    assert bytes(raw[3]) == struct.pack(">qq", 123456789, 987654321)
    r = fr.decode_frames(frames).select(typed_value(F.col("value"), channel, [1024]).alias("v"), "ts_sec", "ts_ns").first()
    assert (list(r.v), r.ts_sec, r.ts_ns) == (data[0][3], 123456789, 987654321)


def test_bool_from_numbers(spark):
    specs = [{"name": "a", "type": "bool"}, {"name": "b", "type": "bool"}, {"name": "c", "type": "bool", "shape": [4, 2]}]
    frames = sent(spark, [(1, True, [0, 1, 0, 1, 1, 0, 1, 0])], "a int, b boolean, c array<int>", specs)
    assert [v for _, v, _ in decoded(frames)] == [True, True, [False, True] * 2 + [True, False] * 2]


def test_declared_type_wins(spark):
    frames = sent(spark, [(99, 88)], "a bigint, b bigint", [{"name": "a", "type": "int32"}, "b"])
    assert rows(fr.frame_defs(frames), "channel", "type") == [("a", "int32"), ("b", "int64")]
    assert [v for _, v, _ in decoded(frames)] == [99, 88]


@pytest.mark.parametrize("packing", ["none", "lz4", "bitshuffle_lz4"])
@pytest.mark.parametrize("headers", [None, "lz4", "bitshuffle_lz4"])
def test_round_trip_of_packed_values(spark, packing, headers):
    values = [([1, 2, 3, 4, 5], -12, 99.0, "testing string", "a", "", None, [0.5] * 6, [], 999999, [True] * 9, list(range(5000)))]
    schema = (
        "a array<bigint>, b bigint, c double, d string, e string, f string, g string, h array<float>, i array<float>, j bigint, "
        "k array<boolean>, l array<int>"
    )
    frames = sent(spark, values, schema, header_compression=headers, data_compression=packing)
    got = [v for _, v, _ in decoded(frames)]
    assert got == [None if v in ("", []) else v for v in values[0]]
    assert fr.decode_messages(frames).first().status == "ok"
    times = dict(rows(fr.decode_frames(frames), "channel", "ts_sec"))
    # A packed empty value still has a header, and with it a timestamp; NULL never has.
    assert times["i"] == (None if packing == "none" else 123) and times["g"] is None


def test_bitshuffle_layout():
    """The first plane of a block holds the lowest bits of the first byte, first element lowest."""
    data = np.arange(128, dtype="<u2").tobytes() + np.array([9, 8, 7], "<u2").tobytes()
    packed = compression.pack(data, "bitshuffle_lz4", "<u2")
    assert struct.unpack(">qi", packed[:12]) == (262, 2048)
    length = struct.unpack(">I", packed[12:16])[0]
    planes = compression._unlz4(packed[16 : 16 + length], 256)
    assert planes[:16] == b"\xaa" * 16 and planes[16:32] == b"\xcc" * 16 and planes[48:64] == b"\x00\xff" * 8
    assert packed[16 + length :] == np.array([9, 8, 7], "<u2").tobytes()
    assert compression.unpack(packed, "bitshuffle_lz4", "<u2") == data
    rng = np.random.default_rng(1)
    for code in ("<i1", "<i4", "<f8"):
        for n in (0, 1, 7, 8, 127, 128, 1024, 5001):
            raw = rng.integers(0, 3, n).astype(code).tobytes()
            assert compression.unpack(compression.pack(raw, "bitshuffle_lz4", code), "bitshuffle_lz4", code) == raw
            assert compression.unpack(compression.pack(raw, "lz4", code), "lz4", code) == raw


def test_lz4_size_in_either_byte_order():
    packed = compression.pack(b"abcd" * 100, "lz4", ">i4")
    swapped = packed[:4][::-1] + packed[4:]
    assert compression.unpack(packed, "lz4", ">i4") == compression.unpack(swapped, "lz4", ">i4") == b"abcd" * 100


def test_unreadable_values_are_null(spark):
    ten = struct.pack("<i", 10)
    channels = [
        {"name": "good", "type": "INT32"},
        {"name": "short", "type": "int32"},
        {"name": "type", "type": "complex64"},
        {"name": "zip", "type": "int32", "compression": "zip"},
        {"name": "text", "type": "string"},
        {"name": "shape", "type": "int32", "shape": [2]},
        {"name": "lz4", "type": "int32", "compression": "lz4"},
        {"name": "default"},
    ]
    values = [ten, ten[:3], ten, ten, b"\xff\xfe", ten, b"\x01\x02\x03\x04\x05", struct.pack("<d", 2.5)]
    parts = [p for v in values for p in (v, struct.pack("<qq", 1, 2))]
    assert decoded(message(spark, channels, parts)) == [
        ("good", 10, "ok"),
        ("short", None, "decode_error"),
        ("type", None, "unknown_type"),
        ("zip", None, "unknown_compression"),
        ("text", None, "decode_error"),
        ("shape", None, "decode_error"),
        ("lz4", None, "decode_error"),
        ("default", 2.5, "ok"),
    ]
    assert {r.ts_sec for r in fr.decode_frames(message(spark, channels, parts)).collect()} == {1}


def test_message_status(spark):
    stamp = struct.pack("<d", 1.0)
    good = {"pulse_id": 1, "hash": "h", "global_timestamp": {"sec": 1, "ns": 2}}
    one = [{"name": "a"}]
    cases = [
        (message(spark, one, [stamp, b""], good), "ok", 1),
        (message(spark, one, [stamp, b""], {**good, "global_timestamp": {"epoch": 9, "ns": 2}}), "ok", 9),
        (message(spark, one, [stamp, b""], {**good, "global_timestamp": {"ns": 2}}), "bad_timestamp", None),
        (message(spark, one, [stamp, b""], {"pulse_id": 1, "hash": "h"}), "ok", None),
        (message(spark, [], [], good), "no_channels", 1),
        (message(spark, [], [stamp, b""], good), "no_channels", 1),
        (message(spark, one, [stamp, b""], {}), "empty_header", None),
        (message(spark, one, [stamp, b""], {"hash": "h"}), "bad_header", None),
        (message(spark, one, [stamp, b""], good, header=b"not json"), "ok", 1),
    ]
    for df, status, sec in cases:
        r = fr.decode_messages(df).first()
        assert (r.status, r.global_sec) == (status, sec)
    assert fr.decode_frames(cases[4][0]).count() == fr.decode_frames(cases[6][0]).count() == fr.decode_frames(cases[8][0]).count() == 0


def test_broken_headers_among_good_ones(spark):
    good = sent(spark, [(i,) for i in range(20)], "a bigint")
    bad = {3: b"", 5: b"{}", 7: b"no json", 9: b'{"pulse_id": "9", "hash": "x"}', 11: b"[1]", 13: b'{"hash": "x"}', 15: b"\n{\n}"}
    spoilt = F.create_map(*[F.lit(x) for pair in bad.items() for x in pair])
    head = F.coalesce(F.element_at(spoilt, F.col("arrival_seq").cast("int")), F.get("parts", F.lit(0)))
    mixed = good.coalesce(1).withColumn("parts", F.concat(F.array(head), F.slice("parts", 2, 10)))
    mixed = mixed.withColumn("parts", F.when(F.col("arrival_seq") != 17, F.col("parts")))
    kept = sorted(set(range(20)) - set(bad) - {17})
    assert sorted(r["i"] for r in fr.decode_frames(mixed).select("value.i").collect()) == kept
    assert sorted(r["a"] for r in fr.decode_wide(mixed, [{"name": "a", "type": "int64"}]).select("a").collect()) == kept
    states = dict(rows(fr.decode_messages(mixed), "arrival_seq", "status"))
    assert {s for i, s in states.items() if i in kept} == {"ok"} and len(states) == 20
    assert {i for i, s in states.items() if s == "empty_header"} == {3, 5, 17}
    assert {i for i, s in states.items() if s == "bad_header"} == {7, 9, 11, 13, 15}
    spaced = good.withColumn("parts", F.concat(F.array(F.lit(b'{\n "pulse_id": 4,\n "hash": "h", "global_timestamp": {"epoch": 5, "ns": 6}}')), F.slice("parts", 2, 10)))
    assert spaced.count() == fr.decode_frames(spaced).where("pulse_id = 4 AND header_hash = 'h'").count() == 20


def test_only_wanted_channels_are_decoded(spark):
    frames = sent(spark, [(1, 2.0, "x")], "a bigint, b double, c string")
    assert decoded_names(fr.decode_frames(frames, ["c", "a", "nope"])) == ["a", "c"]


def decoded_names(samples):
    return [r.channel for r in samples.orderBy("ordinal").collect()]


def test_arrays_of_open_size_change_the_header(spark):
    frames = sent(spark, [([1, 2],), ([1, 2, 3],), ([4, 5],)], "a array<bigint>")
    assert fr.frame_defs(frames).count() == 2
    assert [v for _, v, _ in decoded(frames)] == [[1, 2], [1, 2, 3], [4, 5]]


def test_more_headers_than_a_task_keeps(spark):
    frames = sent(spark, [([0] * (1 + i % 1100),) for i in range(2300)], "a array<tinyint>").coalesce(1)
    sizes = fr.decode_frames(frames).select(F.coalesce(F.size("value.ai"), F.lit(1)).alias("n"), "arrival_seq", "status")
    assert sizes.where("status <> 'ok' OR abs(n) <> 1 + arrival_seq % 1100").where("arrival_seq % 1100 <> 0").count() == 0
    assert fr.frame_defs(frames).count() == 1100


def test_spec_inference(spark):
    schema = "a bigint, b double, c string, d array<bigint>, e array<double>, f array<float>, g float, h boolean, i smallint"
    df = spark.createDataFrame([(1, 1.2, "t", [1, 2, 3], [1.0] * 4, [1.0] * 2, 1.0, True, 5)] * 2, schema)
    assert rows(fr.infer_specs(df), "ordinal", "type", "shape") == [
        (0, "int64", [1]), (1, "float64", [1]), (2, "string", [1]), (3, "int64", [3]), (4, "float64", [4]),
        (5, "float32", [2]), (6, "float32", [1]), (7, "bool", [1]), (8, "int16", [1]),
    ]
    nothing = spark.sql("SELECT NULL AS a")
    assert rows(fr.infer_specs(nothing), "type", "shape") == [("float64", [1])]
    ragged = spark.createDataFrame([([1, 2],), ([1],)], "a array<int>")
    with pytest.raises(Exception, match="vary"):
        fr.infer_specs(ragged).collect()


def test_checks_up_front(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], f"{META}, a int")
    for options in ({"header_compression": "zip"}, {"data_compression": "zip"}, {"specs": [{"name": "a", "compression": "zip"}]}, {"specs": ["b"]}):
        with pytest.raises(ValueError):
            fr.encode_frames(df, **options)
    with pytest.raises(ValueError):
        spark_type("complex64")
    with pytest.raises(ValueError):
        fr.messages_from_rows(df, ["one", "two"])
    assert fr.messages_from_rows(df, ["p", "s", "n", "v"]).columns == ["p", "s", "n", "v"]
    assert spark_type("uint64").simpleString() == "decimal(20,0)" and spark_type(None, [3]).simpleString() == "array<double>"


def test_image_of_three_dimensions(spark):
    from pulsekit.functions.types import reshape

    df = spark.createDataFrame([(list(range(24)),)], "v array<int>")
    got = df.select(reshape(F.col("v"), [4, 3, 2]).alias("v"), reshape(F.col("v"), [4, 3]).alias("w")).first()
    assert got.v == np.arange(24).reshape(2, 3, 4).tolist() and got.w is None


def test_extended_lists(spark):
    frames = sent(spark, [(1, None, "x"), (2, 3.0, None)], "a bigint, b double, c string")
    lists = fr.collect_extended(fr.decode_frames(frames)).orderBy("arrival_seq").collect()
    assert [list(r.channels) for r in lists] == [["a", "b", "c"]] * 2
    assert [list(r.pulse_ids) for r in lists] == [[0, None, 0], [1, 1, None]]
    assert [list(r.timestamp) for r in lists] == [[123, None, 123], [123, 123, None]]
    assert [v is None for v in lists[0].data] == [False, True, False]
    again = fr.to_long(fr.collect_extended(fr.decode_frames(frames)))
    assert rows(again, "arrival_seq", "ordinal", "value.i", "value.f", "value.s") == rows(
        fr.decode_frames(frames), "arrival_seq", "ordinal", "value.i", "value.f", "value.s"
    )


class _Batches:
    """A table of one Arrow batch that keeps what a function makes of it, to be looked at batch by batch."""

    def __init__(self, batch):
        self.batch = batch

    def select(self, *columns):
        return _Batches(self.batch.select(list(columns)))

    def mapInArrow(self, function, schema):
        return list(function(iter([self.batch])))


def test_large_messages_are_read_in_slices(spark):
    texts = [f"{i} é" + "x" * (20_000 if i % 2 else 0) for i in range(2000)]
    sent = spark.createDataFrame([(i, 1, 2, t) for i, t in enumerate(texts)], "pulse_id bigint, global_sec bigint, global_ns bigint, text string")
    frames = fr.encode_frames(sent).select("stream_id", "arrival_seq", "parts").toArrow().combine_chunks().to_batches()[0]
    assert frames.num_rows == 2000 and frames.nbytes > 20_000_000
    for made, value in (
        (fr.decode_frames(_Batches(frames)), lambda r: r["value"]["s"]),
        (fr.decode_wide(_Batches(frames), [{"name": "text", "type": "string"}]), lambda r: r["text"]),
    ):
        assert max(b.nbytes for b in made) < 8_000_000
        assert {r["pulse_id"]: value(r) for b in made for r in b.to_pylist()} == dict(enumerate(texts))
