"""Plans over samples, the catalogue and retention rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pulsekit.operators import align, catalog, retention, select
from pulsekit.operators.scan import OrderedScan
from pulsekit.plans.registry import plan
from pulsekit.plans.views import CHANNELS, MESSAGES_SQL, SAMPLES_SQL, messages, samples, table

NOW = datetime(2024, 2, 1)
_NOW_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


# ---- choosing channels ----


@plan(
    "b1_select_channels",
    f"WITH {SAMPLES_SQL} SELECT pulse_id, channel, value FROM samples WHERE channel IN ('click', 'view')",
)
def b1_select_channels(spark, sf_dir):
    chosen = select.select_channels(samples(spark, sf_dir), ["view", {"name": "click", "modulo": 1}])
    return chosen.select("pulse_id", "channel", "value")


@plan("b2_all_channels", f"WITH {SAMPLES_SQL} SELECT pulse_id, channel, value FROM samples")
def b2_all_channels(spark, sf_dir):
    return select.select_channels(samples(spark, sf_dir), None).select("pulse_id", "channel", "value")


_RULES = [
    {"name": "click", "modulo": "10"},
    {"name": "click", "modulo": 10, "offset": 1},
    {"name": "view", "modulo": 5.0, "offset": 2},
    "error",
]


@plan(
    "b3_decimate",
    f"""WITH {SAMPLES_SQL}
SELECT pulse_id, arrival_seq, channel, value FROM samples
WHERE (channel = 'click' AND pulse_id % 10 IN (0, 1)) OR (channel = 'view' AND pulse_id % 5 = 2) OR channel = 'error'""",
)
def b3_decimate(spark, sf_dir):
    return select.decimate(samples(spark, sf_dir), _RULES).select("pulse_id", "arrival_seq", "channel", "value")


@plan(
    "b3_decimate_wide",
    f"""WITH {SAMPLES_SQL},
wide AS (
  SELECT pulse_id, arg_max(value, arrival_seq) FILTER (channel = 'click') AS click,
         arg_max(value, arrival_seq) FILTER (channel = 'error') AS error,
         arg_max(value, arrival_seq) FILTER (channel = 'view') AS view
  FROM samples WHERE channel IN ('click', 'error', 'view') GROUP BY pulse_id)
SELECT pulse_id, CASE WHEN pulse_id % 10 IN (0, 1) THEN click END AS click,
       CASE WHEN pulse_id % 5 = 2 THEN view END AS view
FROM wide WHERE pulse_id % 10 IN (0, 1) OR pulse_id % 5 = 2""",
)
def b3_decimate_wide(spark, sf_dir):
    wide = align.align_pulses(samples(spark, sf_dir), ["click", "error", "view"])
    return select.decimate(wide, _RULES[:3])


# ---- putting channels together ----

_CELLS = ",\n         ".join(f"arg_max(value, arrival_seq) FILTER (channel = '{c}') AS {c}" for c in CHANNELS)


@plan("c1_align_pulses", f"WITH {SAMPLES_SQL} SELECT pulse_id,\n         {_CELLS}\nFROM samples GROUP BY pulse_id")
def c1_align_pulses(spark, sf_dir):
    return align.align_pulses(samples(spark, sf_dir), CHANNELS)


@plan(
    "c2_merge_streams",
    """WITH sides AS (
  SELECT event_id // 5 AS pulse_id, event_id AS arrival_seq, event_type AS channel, value, user_id % 2 AS side,
         row_number() OVER (PARTITION BY user_id % 2, event_id // 5 ORDER BY event_id DESC) AS rn
  FROM events),
a AS (SELECT * FROM sides WHERE side = 0 AND rn = 1), b AS (SELECT * FROM sides WHERE side = 1 AND rn = 1)
SELECT coalesce(a.pulse_id, b.pulse_id) AS pulse_id, a.arrival_seq AS arrival_seq_a, a.channel AS channel_a,
       a.value AS value_a, b.arrival_seq AS arrival_seq_b, b.channel AS channel_b, b.value AS value_b
FROM a FULL JOIN b ON a.pulse_id = b.pulse_id""",
)
def c2_merge_streams(spark, sf_dir):
    both = samples(spark, sf_dir)
    columns = ["pulse_id", "arrival_seq", "channel", "value"]
    return align.merge_streams(
        both.where("user_id % 2 = 0").select(*columns), both.where("user_id % 2 = 1").select(*columns), "outer"
    )


@plan(
    "c3_channel_defs",
    """SELECT l_orderkey AS arrival_seq, l_linenumber AS place, CAST(l_partkey AS VARCHAR) AS header_hash, 0 AS ordinal,
       l_quantity AS value, p_name AS channel, p_type AS type, p_size AS modulo
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def c3_channel_defs(spark, sf_dir):
    long = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("arrival_seq"),
        F.col("l_linenumber").alias("place"),
        F.col("l_partkey").cast("string").alias("header_hash"),
        F.lit(0).alias("ordinal"),
        F.col("l_quantity").alias("value"),
    )
    defs = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("header_hash"),
        F.lit(0).alias("ordinal"),
        F.col("p_name").alias("channel"),
        F.col("p_type").alias("type"),
        F.col("p_size").alias("modulo"),
    )
    return align.with_channel_defs(long, defs)


@plan(
    "d6_collapse_duplicates",
    """WITH listed AS (
  SELECT user_id, event_id // 10 AS arrival_seq, event_type AS channel, CAST(event_id % 10 AS INTEGER) AS ordinal,
         value FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY arrival_seq, channel ORDER BY ordinal DESC) AS rn FROM listed)
SELECT arrival_seq, channel, ordinal, value FROM ranked WHERE rn = 1""",
)
def d6_collapse_duplicates(spark, sf_dir):
    listed = table(spark, sf_dir, "events").select(
        F.expr("event_id div 10L").alias("arrival_seq"),
        F.col("event_type").alias("channel"),
        (F.col("event_id") % 10).cast("int").alias("ordinal"),
        "value",
    )
    return align.collapse_duplicates(listed)


@plan(
    "g1_union",
    f"""WITH {MESSAGES_SQL}
SELECT stream_id, arrival_seq, pulse_id FROM messages
UNION ALL SELECT o_orderstatus, o_orderkey, o_orderkey FROM orders""",
)
def g1_union(spark, sf_dir):
    other = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("stream_id"),
        F.col("o_orderkey").alias("arrival_seq"),
        F.col("o_orderkey").alias("pulse_id"),
    )
    return align.union_streams(messages(spark, sf_dir).select("stream_id", "arrival_seq", "pulse_id"), other)


# ---- the catalogue: parts are channels, suppliers' nations their backends ----

CATALOG_SQL = """
catalog AS (
  SELECT p_name || ':' || CAST(p_partkey AS VARCHAR) AS name, p_type AS type, [1] AS shape,
         CAST(p_size AS BIGINT) AS modulo, CAST(p_partkey % 10 AS BIGINT) AS "offset", p_brand AS source
  FROM part)
"""


def part_catalog(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.concat_ws(":", "p_name", F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_type").alias("type"),
        F.array(F.lit(1)).alias("shape"),
        F.col("p_size").cast("bigint").alias("modulo"),
        (F.col("p_partkey") % 10).alias("offset"),
        F.col("p_brand").alias("source"),
    )


@plan(
    "b6_available",
    f"WITH {CATALOG_SQL} SELECT name FROM catalog WHERE regexp_matches(name, '^(?:.*ring:1.*)')",
)
def b6_available(spark, sf_dir):
    return catalog.available_channels(part_catalog(spark, sf_dir), "ring:1")


@plan(
    "b6_available_alternation",
    f"WITH {CATALOG_SQL} SELECT name FROM catalog WHERE name LIKE '%bolt%' OR name LIKE 'red%'",
)
def b6_available_alternation(spark, sf_dir):
    return catalog.available_channels(part_catalog(spark, sf_dir), "bolt|red")


@plan("b7_catalog_detail", f"""WITH {CATALOG_SQL} SELECT * FROM catalog WHERE name LIKE '%widget%'""")
def b7_catalog_detail(spark, sf_dir):
    return catalog.available_channels(part_catalog(spark, sf_dir), "widget", metadata=True)


@plan("b8_names", f"WITH {CATALOG_SQL} SELECT name FROM catalog")
def b8_names(spark, sf_dir):
    return catalog.channel_names(part_catalog(spark, sf_dir))


@plan("d5_distinct", "SELECT DISTINCT event_type AS channel FROM events ORDER BY channel")
def d5_distinct(spark, sf_dir):
    return catalog.distinct_channels(samples(spark, sf_dir))


@plan(
    "d8_flatten_catalog",
    """SELECT n_name AS backend, s_name AS name, 'float64' AS type, CAST(s_suppkey % 10 + 1 AS BIGINT) AS modulo
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def d8_flatten_catalog(spark, sf_dir):
    # One listing per backend, as its channels report themselves.
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("backend"))
    channel = F.struct(
        F.col("s_name").alias("name"), F.lit("float64").alias("type"), (F.col("s_suppkey") % 10 + 1).alias("modulo")
    )
    listing = (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey")
        .groupBy("backend", F.expr("s_suppkey div 1000L").alias("page"))
        .agg(F.collect_list(channel).alias("channels"))
    )
    return catalog.flatten_catalog(listing)


@plan(
    "d9_derive_catalog",
    """SELECT p_name AS channel, p_type AS type, CAST(p_size AS BIGINT) AS modulo, min(l_orderkey) AS first_pulse,
       max(l_orderkey) AS last_pulse, count(*) AS n_samples
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name, p_type, p_size""",
)
def d9_derive_catalog(spark, sf_dir):
    long = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("header_hash"), F.lit(0).alias("ordinal"), F.col("l_orderkey").alias("pulse_id")
    )
    defs = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("header_hash"),
        F.lit(0).alias("ordinal"),
        F.col("p_name").alias("channel"),
        F.col("p_type").alias("type"),
        F.col("p_size").cast("bigint").alias("modulo"),
    )
    return catalog.derive_catalog(long, defs)


@plan(
    "d4_latest",
    f"""WITH {SAMPLES_SQL}
SELECT channel, max(arrival_seq) AS arrival_seq, arg_max(value, arrival_seq) AS value,
       arg_max(recv_ts, arrival_seq) AS recv_ts
FROM samples GROUP BY channel""",
)
def d4_latest(spark, sf_dir):
    return catalog.latest(samples(spark, sf_dir), columns=["value", "recv_ts"])


# ---- status, request check, missing data ----

_STATE_SQL = f"""{SAMPLES_SQL},
state AS (
  SELECT channel || '_' || CAST(user_id AS VARCHAR) AS channel, true AS configured, bool_or(k >= 90) AS connected,
         bool_or(k >= 99) AS recording, max(recv_ts) AS last_event
  FROM samples GROUP BY channel, user_id)"""


def _state(spark, sf_dir):
    named = samples(spark, sf_dir).withColumn("channel", F.concat_ws("_", "channel", F.col("user_id").cast("string")))
    return named.groupBy("channel").agg(
        F.lit(True).alias("configured"),
        F.bool_or(F.col("k") >= 90).alias("connected"),
        F.bool_or(F.col("k") >= 99).alias("recording"),
        F.max("recv_ts").alias("last_event"),
    )


def _requested(spark, sf_dir):
    """Every channel, and one of each user that does not exist."""
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    return events.select(F.explode(F.array(F.concat_ws("_", "event_type", user), F.concat(F.lit("none_"), user))).alias("channel"))


@plan(
    "c4_status",
    f"""WITH {_STATE_SQL},
requested AS (
  SELECT DISTINCT unnest([event_type || '_' || CAST(user_id AS VARCHAR), 'none_' || CAST(user_id AS VARCHAR)]) AS channel
  FROM events)
SELECT channel, configured, connected, recording, last_event, epoch_us({_NOW_SQL} - last_event) // 1000000 AS age_s
FROM requested LEFT JOIN state USING (channel)""",
)
def c4_status(spark, sf_dir):
    status = catalog.channel_status(_requested(spark, sf_dir), _state(spark, sf_dir), _now())
    age = F.timestamp_diff("SECOND", _now() - F.col("time_since"), _now())
    return status.withColumn("age_s", age).drop("time_since")


@plan(
    "h12_time_since",
    f"""SELECT user_id, epoch_us({_NOW_SQL} - max(ts)) // 1000000 AS age_s FROM events GROUP BY user_id""",
)
def h12_time_since(spark, sf_dir):
    from pulsekit.functions.timestamps import age_seconds

    newest = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last_event"))
    return newest.select("user_id", age_seconds(F.col("last_event"), _now()).alias("age_s"))


@plan(
    "c8_verify_channels",
    f"""WITH {CATALOG_SQL},
wanted AS (
  SELECT p_name || ':' || CAST(p_partkey + 5 AS VARCHAR) AS channel, p_partkey % 6 + 1 AS modulo, p_partkey + 5 AS id
  FROM part),
state AS (SELECT l_partkey AS id, bool_or(l_returnflag = 'R') AS connected FROM lineitem GROUP BY l_partkey)
SELECT channel, c.name IS NOT NULL AS available, coalesce(s.connected AND c.name IS NOT NULL, false) AS connected,
       w.modulo AS requested_modulo, c.modulo AS source_modulo,
       coalesce(lcm(w.modulo, c.modulo), w.modulo) AS effective_modulo, CAST(0 AS BIGINT) AS "offset"
FROM wanted w LEFT JOIN catalog c ON w.channel = c.name LEFT JOIN state s ON w.id = s.id""",
)
def c8_verify_channels(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    wanted = parts.select(
        F.concat_ws(":", "p_name", (F.col("p_partkey") + 5).cast("string")).alias("channel"),
        (F.col("p_partkey") % 6 + 1).alias("modulo"),
        F.lit(None).cast("bigint").alias("offset"),
    )
    alive = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("connected"))
    state = alive.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws(":", "p_name", F.col("p_partkey").cast("string")).alias("channel"), "connected"
    )
    return catalog.verify_channels(wanted, part_catalog(spark, sf_dir), state)


_NULLABLE_SQL = f"""{SAMPLES_SQL},
nullable AS (SELECT user_id AS stream_id, arrival_seq, channel, CASE WHEN k >= 30 THEN value END AS value, recv_ts FROM samples)"""


def _nullable(spark, sf_dir):
    value = F.when(F.col("k") >= 30, F.col("value"))
    return samples(spark, sf_dir).select(F.col("user_id").alias("stream_id"), "arrival_seq", "channel", value.alias("value"), "recv_ts")


@plan(
    "e6_completeness",
    f"""WITH {_NULLABLE_SQL},
moves AS (
  SELECT stream_id, arrival_seq, CAST(value IS NOT NULL AS INTEGER)
         - coalesce(lag(CAST(value IS NOT NULL AS INTEGER)) OVER (PARTITION BY stream_id, channel ORDER BY arrival_seq), 0) AS move
  FROM nullable),
held AS (SELECT stream_id, arrival_seq, sum(move) OVER (PARTITION BY stream_id ORDER BY arrival_seq) AS n FROM moves),
done AS (SELECT stream_id, min(arrival_seq) AS complete_seq FROM held WHERE n = 5 GROUP BY stream_id),
begun AS (SELECT stream_id, min(recv_ts) AS since FROM nullable GROUP BY stream_id)
SELECT b.stream_id, any_value(d.complete_seq) AS complete_seq,
       CASE WHEN any_value(d.complete_seq) IS NOT NULL THEN count(*) FILTER (n.arrival_seq <= d.complete_seq) END AS messages,
       date_diff('microsecond', any_value(b.since), max(n.recv_ts) FILTER (n.arrival_seq = d.complete_seq)) AS elapsed_us
FROM begun b JOIN nullable n ON b.stream_id = n.stream_id LEFT JOIN done d ON b.stream_id = d.stream_id
GROUP BY b.stream_id""",
)
def e6_completeness(spark, sf_dir, scan=OrderedScan()):
    return catalog.completeness(_nullable(spark, sf_dir), CHANNELS, scan=scan)


@plan(
    "c7_missing_channels",
    """WITH named AS (
  SELECT event_type || '_' || CAST(user_id AS VARCHAR) AS channel,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 90 THEN value END AS value FROM events)
SELECT DISTINCT channel FROM named WHERE channel NOT IN (SELECT channel FROM named WHERE value IS NOT NULL)""",
)
def c7_missing_channels(spark, sf_dir):
    named = samples(spark, sf_dir).select(
        F.concat_ws("_", "channel", F.col("user_id").cast("string")).alias("channel"),
        F.when(F.col("k") >= 90, F.col("value")).alias("value"),
    )
    return catalog.missing_channels(named, named)


# ---- retention: line items are samples of their part's brand ----

_RETENTION_SQL = """
stored AS (
  SELECT l_orderkey AS pulse_id, l_linenumber AS ordinal, l_returnflag AS backend, l_linestatus AS channel,
         l_shipdate AS ts FROM lineitem),
rules AS (
  SELECT o_orderkey AS rule_seq, CASE WHEN o_custkey % 2 = 0 THEN 'N' ELSE 'R' END AS backend, 'O' AS channel, o_orderkey AS start_pulse,
         o_orderkey + 500 AS end_pulse, NULL::TIMESTAMP AS start_ts, NULL::TIMESTAMP AS end_ts,
         CAST(86400 * (o_custkey % 3000) AS BIGINT) AS ttl_s
  FROM orders
  UNION ALL
  SELECT CAST(c_custkey AS BIGINT), 'A', 'F', NULL, NULL, TIMESTAMP '1997-01-01' + to_days(CAST(c_custkey % 900 AS INTEGER)),
         TIMESTAMP '1997-01-15' + to_days(CAST(c_custkey % 900 AS INTEGER)), CAST(86400 * c_nationkey AS BIGINT)
  FROM customer),
matched AS (
  SELECT s.*, (SELECT arg_max(r.ttl_s, r.rule_seq) FROM rules r WHERE s.backend = r.backend AND s.channel = r.channel
               AND (s.pulse_id BETWEEN r.start_pulse AND r.end_pulse OR s.ts BETWEEN r.start_ts AND r.end_ts)) AS found
  FROM stored s),
dated AS (SELECT * EXCLUDE (found), coalesce(found, 604800) AS ttl_s, ts + to_seconds(coalesce(found, 604800)) AS expires_at
          FROM matched)
"""


def _stored(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pulse_id"),
        F.col("l_linenumber").alias("ordinal"),
        F.col("l_returnflag").alias("backend"),
        F.col("l_linestatus").alias("channel"),
        F.col("l_shipdate").alias("ts"),
    )


def _rules(spark, sf_dir):
    none = lambda t: F.lit(None).cast(t)
    by_pulse = (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("rule_seq"),
            F.when(F.col("o_custkey") % 2 == 0, "N").otherwise("R").alias("backend"),
            F.lit("O").alias("channel"),
            F.col("o_orderkey").alias("start_pulse"),
            (F.col("o_orderkey") + 500).alias("end_pulse"),
            none("timestamp_ntz").alias("start_ts"),
            none("timestamp_ntz").alias("end_ts"),
            (F.col("o_custkey") % 3000 * 86400).alias("ttl_s"),
        )
    )
    shift = F.make_dt_interval(days=(F.col("c_custkey") % 900).cast("int"))
    by_time = (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("rule_seq"),
            F.lit("A").alias("backend"),
            F.lit("F").alias("channel"),
            none("bigint").alias("start_pulse"),
            none("bigint").alias("end_pulse"),
            (F.expr("TIMESTAMP_NTZ'1997-01-01 00:00:00'") + shift).alias("start_ts"),
            (F.expr("TIMESTAMP_NTZ'1997-01-15 00:00:00'") + shift).alias("end_ts"),
            (F.col("c_nationkey").cast("bigint") * 86400).alias("ttl_s"),
        )
    )
    return by_pulse.unionByName(by_time)


@plan("c5_retention", f"WITH {_RETENTION_SQL} SELECT * FROM dated")
def c5_retention(spark, sf_dir):
    return retention.apply_retention(
        _stored(spark, sf_dir), _rules(spark, sf_dir), default_ttl_s=604800
    )


@plan("c6_purge", f"WITH {_RETENTION_SQL} SELECT * FROM dated WHERE expires_at > TIMESTAMP '2000-01-01 00:00:00'")
def c6_purge(spark, sf_dir):
    return retention.purge_expired(
        _stored(spark, sf_dir),
        _rules(spark, sf_dir),
        F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz"),
        default_ttl_s=604800,
    )


# ---- names and timestamps ----


@plan(
    "h11_split_channel",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'main' END AS backend,
       c_name AS channel FROM customer""",
)
def h11_split_channel(spark, sf_dir):
    from pulsekit.functions.names import default_backend, split_channel

    even = F.col("c_custkey") % 2 == 0
    written = F.when(even, F.concat_ws("/", "c_mktsegment", "c_name")).otherwise(F.col("c_name"))
    backend, channel = split_channel(written, default_backend("https://archive.example/main/"))
    return table(spark, sf_dir, "customer").select("c_custkey", backend.alias("backend"), channel.alias("channel"))


@plan(
    "h6_timestamps",
    """SELECT event_id, epoch_us(ts) // 1000000 AS sec, epoch_us(ts) % 1000000 * 1000 AS ns, ts AS joined,
       CAST(trunc(value) AS BIGINT) AS value_sec, CAST(trunc((value - trunc(value)) * 1e9) AS BIGINT) AS value_ns
FROM events""",
)
def h6_timestamps(spark, sf_dir):
    from pulsekit.functions.timestamps import join_ts, split_seconds, split_ts

    sec, ns = split_ts(F.col("ts"), ntz=True)
    value_sec, value_ns = split_seconds(F.col("value"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        sec.alias("sec"),
        ns.alias("ns"),
        F.convert_timezone(None, F.lit("UTC"), join_ts(sec, ns).cast("timestamp_ntz")).alias("joined"),
        value_sec.alias("value_sec"),
        value_ns.alias("value_ns"),
    )
