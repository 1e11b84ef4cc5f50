"""Plans that send table rows through messages and back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from pulsekit.functions.types import pixel, reshape, typed_value
from pulsekit.operators.scan import OrderedScan
from pulsekit.plans.registry import plan
from pulsekit.sources.scratch import scratch_dir
from pulsekit.plans.views import MESSAGES_SQL, messages, samples, table
from pulsekit.sources import frames as fr


def _vectors(spark, sf_dir, **spec):
    """Embeddings as messages with one array channel."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("pulse_id"),
        F.lit(1700000000).cast("bigint").alias("global_sec"),
        (F.col("vec_id") * 1000).alias("global_ns"),
        "embedding",
        "label",
    )
    return fr.encode_frames(rows, [{"name": "embedding", "type": "float32", "shape": [64], **spec}])


def _embedding_of(decoded):
    return decoded.select(F.col("pulse_id").alias("vec_id"), typed_value(F.col("value"), "float32", [64]).alias("embedding"))


_VECTORS_SQL = "SELECT vec_id, embedding FROM embeddings"


@plan("a2_decode_frames", _VECTORS_SQL)
def a2_decode_frames(spark, sf_dir):
    return _embedding_of(fr.decode_frames(_vectors(spark, sf_dir)))


@plan("a2_decode_lz4", _VECTORS_SQL)
def a2_decode_lz4(spark, sf_dir):
    return _embedding_of(fr.decode_frames(_vectors(spark, sf_dir, compression="lz4")))


@plan("a2_decode_bitshuffle", _VECTORS_SQL)
def a2_decode_bitshuffle(spark, sf_dir):
    return _embedding_of(fr.decode_frames(_vectors(spark, sf_dir, compression="bitshuffle_lz4")))


def _items(spark, sf_dir):
    """Line items as messages of three scalar channels; some values are NULL."""
    quantity = F.when(F.col("l_linenumber") != 3, F.col("l_quantity"))
    flag = F.when(F.col("l_linestatus") == "F", F.col("l_returnflag"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pulse_id"),
        F.lit(1700000000).cast("bigint").alias("global_sec"),
        F.col("l_partkey").alias("global_ns"),
        quantity.alias("quantity"),
        F.col("l_linenumber").alias("line"),
        flag.alias("flag"),
    )
    return rows


_ITEMS_SQL = """
items AS (
  SELECT l_orderkey AS pulse_id, l_partkey AS ns, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity,
         l_linenumber AS line, CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS flag
  FROM lineitem)
"""


@plan(
    "a2_decode_scalars",
    f"""WITH {_ITEMS_SQL}
SELECT pulse_id, 0 AS ordinal, 'quantity' AS channel, quantity AS f, NULL::BIGINT AS i, NULL AS s FROM items
UNION ALL SELECT pulse_id, 1, 'line', NULL, line, NULL FROM items
UNION ALL SELECT pulse_id, 2, 'flag', NULL, NULL, flag FROM items""",
)
def a2_decode_scalars(spark, sf_dir):
    decoded = fr.decode_frames(fr.encode_frames(_items(spark, sf_dir)))
    return decoded.select("pulse_id", "ordinal", "channel", "value.f", "value.i", "value.s")


@plan(
    "h13_explicit_nulls",
    f"""WITH {_ITEMS_SQL},
parts AS (
  SELECT pulse_id, ns, 'quantity' AS channel, quantity IS NOT NULL AS there FROM items
  UNION ALL SELECT pulse_id, ns, 'line', true FROM items
  UNION ALL SELECT pulse_id, ns, 'flag', flag IS NOT NULL FROM items)
SELECT pulse_id, channel, there, CASE WHEN there THEN 1700000000::BIGINT END AS ts_sec,
       CASE WHEN there THEN ns END AS ts_ns, CASE WHEN there THEN 'ok' ELSE 'empty' END AS status
FROM parts""",
)
def h13_explicit_nulls(spark, sf_dir):
    decoded = fr.decode_frames(fr.encode_frames(_items(spark, sf_dir)))
    there = F.col("value").isNotNull().alias("there")
    return decoded.select("pulse_id", "channel", there, "ts_sec", "ts_ns", "status")


@plan(
    "a2_decode_wide",
    f"WITH {_ITEMS_SQL} SELECT pulse_id, ns AS global_ns, quantity, line, flag FROM items",
)
def a2_decode_wide(spark, sf_dir):
    channels = [{"name": "quantity", "type": "float64"}, {"name": "line", "type": "int32"}, {"name": "flag", "type": "string"}]
    decoded = fr.decode_wide(fr.encode_frames(_items(spark, sf_dir)), channels)
    return decoded.select("pulse_id", "global_ns", "quantity", "line", "flag")


_INT64_HEX = "".join("%02X" for _ in range(8))


@plan(
    "a8_encode_frames",
    f"""WITH heads AS (
  SELECT *, md5('{{"htype": "bsr_d-1.1", "channels": [{{"name": "key", "type": "int64", "shape": [1], "encoding": "little"}}, '
                || '{{"name": "line", "type": "int32", "shape": [1], "encoding": "big"}}]}}') AS hash FROM lineitem)
SELECT l_orderkey AS arrival_seq,
       '{{"htype":"bsr_m-1.1","hash":"' || hash || '","pulse_id":' || CAST(l_orderkey AS VARCHAR)
       || ',"global_timestamp":{{"sec":1700000000,"ns":' || CAST(l_suppkey AS VARCHAR) || '}}}}' AS main_header,
       printf('{_INT64_HEX}', l_partkey & 255, (l_partkey >> 8) & 255, (l_partkey >> 16) & 255, (l_partkey >> 24) & 255,
              (l_partkey >> 32) & 255, (l_partkey >> 40) & 255, (l_partkey >> 48) & 255, (l_partkey >> 56) & 255) AS key_part,
       printf('%08X', l_linenumber) AS line_part, printf('%016X%016X', 1700000000, l_suppkey) AS line_time, 6 AS n_parts
FROM heads""",
)
def a8_encode_frames(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pulse_id"),
        F.lit(1700000000).cast("bigint").alias("global_sec"),
        F.col("l_suppkey").alias("global_ns"),
        F.col("l_partkey").alias("key"),
        F.col("l_linenumber").alias("line"),
    )
    sent = fr.encode_frames(rows, ["key", {"name": "line", "type": "int32", "encoding": "big"}])
    part = lambda i: F.get("parts", F.lit(i))
    return sent.select(
        "arrival_seq",
        part(0).cast("string").alias("main_header"),
        F.hex(part(2)).alias("key_part"),
        F.hex(part(4)).alias("line_part"),
        F.hex(part(5)).alias("line_time"),
        F.size("parts").alias("n_parts"),
    )


@plan(
    "h8_header_hash",
    """SELECT vec_id AS pulse_id, md5('{"htype": "bsr_d-1.1", "channels": [{"name": "embedding", "type": "float32", '
       || '"shape": [64], "encoding": "little"}]}') AS header_hash, true AS agrees FROM embeddings""",
)
def h8_header_hash(spark, sf_dir):
    sent = fr.with_headers(_vectors(spark, sf_dir))
    computed = fr.header_hash(F.get("parts", F.lit(1)))
    return sent.select("pulse_id", "header_hash", (computed == F.col("header_hash")).alias("agrees"))


_WIRE_TYPES = ["int8", "uint8", "int16", "uint16", "int32", "uint32", "int64", "float32", "float64", "bool", "string"]


@plan(
    "h1_type_map",
    """SELECT l_orderkey AS pulse_id, CAST(l_linenumber - 4 AS TINYINT) AS int8, CAST(l_linenumber + 200 AS SMALLINT) AS uint8,
       CAST(l_linenumber * -1000 AS SMALLINT) AS int16, CAST(l_linenumber + 65000 AS INTEGER) AS uint16,
       CAST(l_linenumber * -100000 AS INTEGER) AS int32, CAST(l_linenumber + 4294967000 AS BIGINT) AS uint32,
       l_partkey - 5000000000 AS int64, CAST(CAST(l_suppkey AS HUGEINT) + 18446744073709000000 AS VARCHAR) AS uint64,
       CAST(l_discount AS FLOAT) AS float32, l_extendedprice AS float64, l_returnflag = 'R' AS bool, l_linestatus AS string
FROM lineitem""",
)
def h1_type_map(spark, sf_dir):
    line = F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pulse_id"),
        F.lit(1).cast("bigint").alias("global_sec"),
        F.lit(2).cast("bigint").alias("global_ns"),
        (line - 4).cast("tinyint").alias("int8"),
        (line + 200).cast("smallint").alias("uint8"),
        (line * -1000).cast("smallint").alias("int16"),
        (line + 65000).alias("uint16"),
        (line * -100000).alias("int32"),
        (line + F.lit(4294967000)).alias("uint32"),
        (F.col("l_partkey") - 5000000000).alias("int64"),
        (F.col("l_suppkey").cast("decimal(20,0)") + F.expr("18446744073709000000BD")).cast("decimal(20,0)").alias("uint64"),
        F.col("l_discount").cast("float").alias("float32"),
        F.col("l_extendedprice").alias("float64"),
        (F.col("l_returnflag") == "R").alias("bool"),
        F.col("l_linestatus").alias("string"),
    )
    specs = [{"name": t, "type": t} for t in [*_WIRE_TYPES[:7], "uint64", *_WIRE_TYPES[7:]]]
    back = fr.decode_wide(fr.encode_frames(rows, specs), specs)
    return back.select("pulse_id", *_WIRE_TYPES, F.col("uint64").cast("string").alias("uint64"))


@plan(
    "h2_byte_order",
    """SELECT vec_id, embedding, label, [CAST(trunc(x * 1000) AS BIGINT) FOR x IN embedding] AS thousandths,
       1700000000::BIGINT AS ts_sec, vec_id AS ts_ns FROM embeddings""",
)
def h2_byte_order(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("pulse_id"),
        F.lit(1700000000).cast("bigint").alias("global_sec"),
        F.col("vec_id").alias("global_ns"),
        "embedding",
        "label",
        F.transform("embedding", lambda x: (x * 1000).cast("bigint")).alias("thousandths"),
    )
    specs = [{"name": c, "encoding": "big"} for c in ("embedding", "label", "thousandths")]
    decoded = fr.decode_frames(fr.encode_frames(rows, specs))
    mine = lambda channel, value: F.max(F.when(F.col("channel") == channel, value))
    return decoded.groupBy(F.col("pulse_id").alias("vec_id")).agg(
        F.max_by(F.col("value.af").cast("array<float>"), F.when(F.col("channel") == "embedding", 1)).alias("embedding"),
        mine("label", F.col("value.i").cast("int")).alias("label"),
        F.max_by("value.ai", F.when(F.col("channel") == "thousandths", 1)).alias("thousandths"),
        F.max("ts_sec").alias("ts_sec"),
        F.max("ts_ns").alias("ts_ns"),
    )


@plan(
    "h4_scalar_unwrap",
    """SELECT vec_id AS pulse_id, CAST(label AS BIGINT) AS scalar, [CAST(embedding[1] AS DOUBLE)] AS one_by_one,
       [CAST(x AS DOUBLE) FOR x IN embedding[1:3]] AS three FROM embeddings""",
)
def h4_scalar_unwrap(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("pulse_id"),
        F.lit(1).cast("bigint").alias("global_sec"),
        F.lit(2).cast("bigint").alias("global_ns"),
        "label",
        F.slice("embedding", 1, 1).alias("one_by_one"),
        F.slice("embedding", 1, 3).alias("three"),
    )
    specs = [
        {"name": "label", "shape": [1]},
        {"name": "one_by_one", "shape": [1, 1]},
        {"name": "three", "shape": [1]},
    ]
    decoded = fr.decode_frames(fr.encode_frames(rows, specs))
    pick = lambda channel, value: F.max_by(value, F.when(F.col("channel") == channel, 1))
    return decoded.groupBy("pulse_id").agg(
        pick("label", F.col("value.i")).alias("scalar"),
        pick("one_by_one", F.col("value.af")).alias("one_by_one"),
        pick("three", F.col("value.af")).alias("three"),
    )


@plan(
    "h10_null_safe",
    """SELECT vec_id AS pulse_id, CASE WHEN vec_id % 7 IN (0, 1) THEN NULL ELSE embedding END AS embedding,
       CASE WHEN vec_id % 7 = 1 THEN NULL ELSE 1700000000::BIGINT END AS ts_sec,
       CASE vec_id % 7 WHEN 0 THEN 'decode_error' WHEN 1 THEN 'empty' ELSE 'ok' END AS status FROM embeddings""",
)
def h10_null_safe(spark, sf_dir):
    part = F.get("parts", F.lit(2))
    damaged = (
        F.when(F.col("arrival_seq") % 7 == 0, F.substring(part, 1, 255))
        .when(F.col("arrival_seq") % 7 == 1, F.lit(b""))
        .otherwise(part)
    )
    sent = _vectors(spark, sf_dir).withColumn(
        "parts", F.concat(F.slice("parts", 1, 2), F.array(damaged), F.slice("parts", 4, 1))
    )
    decoded = fr.decode_frames(sent)
    return decoded.select(
        "pulse_id", typed_value(F.col("value"), "float32", [64]).alias("embedding"), "ts_sec", "status"
    )


@plan(
    "h10_unknown_types",
    """SELECT o_orderkey AS pulse_id, unnest(['good', 'odd_type', 'odd_packing']) AS channel,
       unnest([o_totalprice, NULL, NULL]) AS f, unnest(['ok', 'unknown_type', 'unknown_compression']) AS status,
       5::BIGINT AS ts_sec FROM orders""",
)
def h10_unknown_types(spark, sf_dir):
    header = (
        '{"htype": "bsr_d-1.1", "channels": [{"name": "good", "type": "Float64"}, '
        '{"name": "odd_type", "type": "complex64"}, {"name": "odd_packing", "type": "float64", "compression": "zip"}]}'
    )
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pulse_id"),
        F.lit(5).cast("bigint").alias("global_sec"),
        F.lit(6).cast("bigint").alias("global_ns"),
        *[F.col("o_totalprice").alias(c) for c in ("good", "odd_type", "odd_packing")],
    )
    # The writer refuses such channels, so its good header is replaced by a foreign one.
    sent = fr.encode_frames(rows)
    foreign = F.concat(F.slice("parts", 1, 1), F.array(F.lit(header.encode())), F.slice("parts", 3, 6))
    decoded = fr.decode_frames(sent.withColumn("parts", foreign))
    return decoded.select("pulse_id", "channel", "value.f", "status", "ts_sec")


@plan("h5_utf8", "SELECT doc_id, text, 'ok' AS status FROM documents")
def h5_utf8(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pulse_id"),
        F.lit(1).cast("bigint").alias("global_sec"),
        F.lit(2).cast("bigint").alias("global_ns"),
        "text",
    )
    decoded = fr.decode_frames(fr.encode_frames(rows))
    return decoded.select(F.col("pulse_id").alias("doc_id"), F.col("value.s").alias("text"), "status")


@plan(
    "h3_reshape",
    """SELECT vec_id, [embedding[y * 8 + 1 : y * 8 + 8] FOR y IN range(0, 8)] AS image,
       embedding[5 * 8 + 3 + 1] AS pixel FROM embeddings""",
)
def h3_reshape(spark, sf_dir):
    decoded = fr.decode_frames(_vectors(spark, sf_dir, shape=[8, 8]))
    flat = typed_value(F.col("value"), "float32", [8, 8])
    return decoded.select(
        F.col("pulse_id").alias("vec_id"), reshape(flat, [8, 8]).alias("image"), pixel(flat, 8, 3, 5).alias("pixel")
    )


@plan(
    "h7_header_alias",
    """SELECT event_id AS arrival_seq, event_id AS pulse_id,
       CASE WHEN event_id % 3 < 2 THEN user_id END AS global_sec, 7::BIGINT AS global_ns,
       CASE WHEN event_id % 3 = 2 THEN 'bad_timestamp' ELSE 'no_channels' END AS status FROM events""",
)
def h7_header_alias(spark, sf_dir):
    event, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    key = F.when(F.col("event_id") % 3 == 0, "sec").when(F.col("event_id") % 3 == 1, "epoch").otherwise("seconds")
    header = F.concat(
        F.lit('{"htype": "bsr_m-1.1", "hash": "none", "pulse_id": '), event, F.lit(', "global_timestamp": {"'),
        key, F.lit('": '), user, F.lit(', "ns": 7}}'),
    )
    heads = table(spark, sf_dir, "events").select(
        F.lit("s").alias("stream_id"),
        F.col("event_id").alias("arrival_seq"),
        F.array(header.cast("binary"), F.lit(b'{"htype": "bsr_d-1.1", "channels": []}')).alias("parts"),
    )
    return fr.decode_messages(heads).select("arrival_seq", "pulse_id", "global_sec", "global_ns", "status")


@plan(
    "h9_infer_specs",
    """SELECT 0 AS ordinal, 'vec_id' AS channel, 'int64' AS type, [1] AS shape, 'little' AS encoding
UNION ALL SELECT 1, 'embedding', 'float32', [(SELECT CAST(max(len(embedding)) AS INTEGER) FROM embeddings)], 'little'
UNION ALL SELECT 2, 'label', 'int32', [1], 'little'""",
)
def h9_infer_specs(spark, sf_dir):
    return fr.infer_specs(table(spark, sf_dir, "embeddings"))


# ---- stored frames ----


def event_frames(spark, sf_dir):
    """Events as messages of two channels."""
    view = messages(spark, sf_dir)
    rows = view.select(
        "stream_id",
        "arrival_seq",
        F.col("recv_ts").cast("timestamp").alias("recv_ts"),
        "pulse_id",
        F.lit(1700000000).cast("bigint").alias("global_sec"),
        (F.col("k").cast("bigint") * 1000).alias("global_ns"),
        "value",
        "k",
    )
    return fr.encode_frames(rows)


@plan(
    "a1_read_frames",
    f"""WITH {MESSAGES_SQL}
SELECT stream_id, arrival_seq, pulse_id, 1700000000::BIGINT AS global_sec, k::BIGINT * 1000 AS global_ns,
       2 AS n_channels, 'ok' AS status FROM messages""",
)
def a1_read_frames(spark, sf_dir):
    path = scratch_dir(spark, "frames")
    event_frames(spark, sf_dir).write.mode("overwrite").parquet(path)
    read = fr.decode_messages(fr.read_frames(spark, path))
    return read.drop("recv_ts", "header_hash", "n_bytes")


@plan(
    "a2_frame_defs",
    """SELECT md5('{"htype": "bsr_d-1.1", "channels": [{"name": "embedding", "type": "float32", '
       || '"shape": [64], "encoding": "little"}]}') AS header_hash, 0 AS ordinal, 'embedding' AS channel,
       'float32' AS type, [64] AS shape, 'little' AS encoding, CAST(NULL AS VARCHAR) AS compression FROM embeddings LIMIT 1""",
)
def a2_frame_defs(spark, sf_dir):
    return fr.frame_defs(_vectors(spark, sf_dir))


# ---- parallel lists ----

_LISTED_SQL = """
listed AS (
  SELECT 's' AS stream_id, event_id // 5 AS arrival_seq, event_id // 5 AS pulse_id, CAST(event_id % 5 AS INTEGER) AS ordinal,
         event_type AS channel, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 30 THEN value END AS value,
         user_id AS ts_sec, event_id AS ts_ns FROM events)
"""


def _listed(spark, sf_dir):
    view = samples(spark, sf_dir)
    return view.select(
        "stream_id",
        F.col("pulse_id").alias("arrival_seq"),
        "pulse_id",
        (F.col("arrival_seq") % 5).cast("int").alias("ordinal"),
        "channel",
        F.when(F.col("k") >= 30, F.col("value")).alias("value"),
        F.col("user_id").alias("ts_sec"),
        F.col("arrival_seq").alias("ts_ns"),
    )


@plan(
    "a3_extended",
    f"""WITH {_LISTED_SQL}
SELECT stream_id, arrival_seq, pulse_id, list(channel ORDER BY ordinal) AS channels, list(value ORDER BY ordinal) AS data,
       list(CASE WHEN value IS NOT NULL THEN ts_sec END ORDER BY ordinal) AS "timestamp",
       list(CASE WHEN value IS NOT NULL THEN ts_ns END ORDER BY ordinal) AS timestamp_offset,
       list(CASE WHEN value IS NOT NULL THEN pulse_id END ORDER BY ordinal) AS pulse_ids
FROM listed GROUP BY stream_id, arrival_seq, pulse_id""",
)
def a3_extended(spark, sf_dir):
    return fr.collect_extended(_listed(spark, sf_dir))


@plan(
    "a3_to_long",
    f"""WITH {_LISTED_SQL}
SELECT stream_id, arrival_seq, pulse_id, ordinal, channel, value, CASE WHEN value IS NOT NULL THEN ts_sec END AS ts_sec,
       CASE WHEN value IS NOT NULL THEN ts_ns END AS ts_ns FROM listed""",
)
def a3_to_long(spark, sf_dir):
    return fr.to_long(fr.collect_extended(_listed(spark, sf_dir)))


# ---- making rows ----


@plan(
    "a9_pulse_ids",
    f"""WITH {MESSAGES_SQL},
numbered AS (
  SELECT stream_id, arrival_seq, row_number() OVER w - 1 AS row_index,
         CASE WHEN k % 20 = 0 THEN arrival_seq * 3 END AS explicit_id
  FROM messages WINDOW w AS (PARTITION BY stream_id ORDER BY arrival_seq))
SELECT stream_id, arrival_seq,
       coalesce(last_value(explicit_id - row_index IGNORE NULLS) OVER
         (PARTITION BY stream_id ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING), 1000) + row_index AS pulse_id
FROM numbered""",
)
def a9_pulse_ids(spark, sf_dir, scan=OrderedScan()):
    given = F.when(F.col("k") % 20 == 0, F.col("arrival_seq") * 3)
    rows = messages(spark, sf_dir).select("stream_id", "arrival_seq", given.alias("explicit_id"))
    return fr.assign_pulse_ids(rows, start=1000, explicit="explicit_id", scan=scan).drop("explicit_id")


@plan(
    "j2_derived_channels",
    f"""WITH {MESSAGES_SQL}
SELECT stream_id, arrival_seq, pulse_id, CAST(pulse_id * 2 AS INTEGER) AS doubled, pulse_id * 10.0::DOUBLE AS tenfold,
       CAST(pulse_id % 128 AS SMALLINT) AS small FROM messages""",
)
def j2_derived_channels(spark, sf_dir):
    view = messages(spark, sf_dir).select("stream_id", "arrival_seq", "pulse_id")
    return fr.with_channels(
        view,
        {
            "doubled": F.col("pulse_id") * 2,
            "tenfold": lambda pulses: pulses * 10.0,
            "small": lambda pulses: pulses % 128,
        },
        {"doubled": {"type": "int32"}, "small": {"type": "uint8", "shape": [1]}},
    )


def _high_values(batches):
    for rows in batches:
        rows = rows[rows["value"] > 10.0]
        yield pd.DataFrame({"stream_id": rows["stream_id"], "arrival_seq": rows["arrival_seq"], "excess": rows["value"] - 10.0})


@plan(
    "j3_map_messages",
    f"WITH {MESSAGES_SQL} SELECT stream_id, arrival_seq, value - 10.0::DOUBLE AS excess FROM messages WHERE value > 10",
)
def j3_map_messages(spark, sf_dir):
    view = messages(spark, sf_dir).select("stream_id", "arrival_seq", "value")
    return fr.map_messages(view, _high_values, "stream_id string, arrival_seq bigint, excess double")


@plan("j4_rows", "SELECT o_orderkey AS pulse_id, o_totalprice AS price, o_orderstatus AS state FROM orders")
def j4_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return fr.messages_from_rows(rows, ["pulse_id", "price", "state"])
