"""Plans that run a stream over the events to its end and read back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.plans.codec import event_frames
from pulsekit.plans.registry import plan
from pulsekit.sources.scratch import scratch_dir
from pulsekit.plans.streams_in_order import STATS_SQL
from pulsekit.plans.views import CHANNELS, MESSAGES_SQL, SAMPLES_SQL, as_messages, as_samples
from pulsekit.sources.archive import read_channels
from pulsekit.sources.frames import read_frames
from pulsekit.plans.archives import VERSION_CELLS, VERSION_SQL, typed_samples
from pulsekit.streaming import streams, versions

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


# Files arrive in groups of so many, each group backwards.
_GROUP = 2


def _event_files(spark, sf_dir, files=6, group=_GROUP):
    """The events in files by event number, in an order in which a stream takes them out of order."""
    path = scratch_dir(spark, "events")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    last = events.agg(F.max("event_id")).first()[0]
    file = F.expr(f"event_id * {files}L div {last + 1}L")
    for k in sorted(range(files), key=lambda k: (k // group, -k)):
        events.where(file == k).coalesce(1).write.mode("append").parquet(path)
    return path


def _events(spark, path):
    return spark.readStream.schema(_EVENTS).option("maxFilesPerTrigger", 1).parquet(path)


def _live_messages(spark, path):
    return as_messages(_events(spark, path)).withColumn("recv_ts", F.col("recv_ts").cast("timestamp"))


def _live_samples(spark, path):
    return as_samples(_events(spark, path)).withColumn("event_time", F.col("recv_ts").cast("timestamp"))


def _frame_stream(spark, sf_dir):
    path = scratch_dir(spark, "frames")
    event_frames(spark, sf_dir).write.mode("overwrite").parquet(path)
    return read_frames(spark, path, streaming=True, maxFilesPerTrigger="4")


def _landed(spark, stream, name):
    path = scratch_dir(spark, name)
    streams.run_available(stream, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


@plan(
    "i1_stream_samples",
    f"""WITH {MESSAGES_SQL}
SELECT stream_id, arrival_seq, pulse_id, value FROM messages WHERE pulse_id % 10 = 3 AND value > 5""",
)
def i1_stream_samples(spark, sf_dir):
    frames = _frame_stream(spark, sf_dir)
    samples = streams.stream_samples(frames, [{"name": "value", "modulo": 10, "offset": 3}], F.col("value.f") > 5)
    return _landed(spark, samples.select("stream_id", "arrival_seq", "pulse_id", F.col("value.f").alias("value")), "samples")


def _ended(spark, name, build):
    """What a stream that ends itself has landed, and the progress it filed."""
    path = scratch_dir(spark, name)
    done = streams.run_to_end(build(f"{path}/ends"), f"{path}/out", f"{path}/checkpoint", f"{path}/ends", progress=f"{path}/progress")
    assert done
    return spark.read.parquet(f"{path}/out"), f"{path}/progress"


@plan("i2_stream_continuity", STATS_SQL)
def i2_stream_continuity(spark, sf_dir):
    path = scratch_dir(spark, "continuity")
    messages = _live_messages(spark, _event_files(spark, sf_dir, group=1))
    query = streams.stream_continuity(messages, f"{path}/totals", f"{path}/checkpoint", available_now=True)
    query.awaitTermination()
    return streams.continuity_totals(spark, f"{path}/totals").drop("hwm")


# The events span 30 days, and at the smallest scale those of a pulse are hours apart; two files out of order span ten days.
_PATIENCE = "11 days"
_CELLS = ", ".join(f"arg_max(value, arrival_seq) FILTER (channel = '{c}') AS {c}" for c in CHANNELS)


@plan(
    "i3_stream_align",
    f"""WITH {SAMPLES_SQL}
SELECT pulse_id, {_CELLS} FROM samples GROUP BY pulse_id""",
)
def i3_stream_align(spark, sf_dir):
    samples = _live_samples(spark, _event_files(spark, sf_dir))
    build = lambda ends: streams.stream_align(streams.with_end(samples, ends, channel=CHANNELS[0]), CHANNELS, _PATIENCE)
    return _ended(spark, "aligned", build)[0]


@plan(
    "i3_stream_align_complete",
    f"""WITH {SAMPLES_SQL}
SELECT pulse_id, {_CELLS} FROM samples GROUP BY pulse_id""",
)
def i3_stream_align_complete(spark, sf_dir):
    samples = _live_samples(spark, _event_files(spark, sf_dir))
    build = lambda ends: streams.stream_align_complete(streams.with_end(samples, ends, channel=CHANNELS[0]), CHANNELS, _PATIENCE)
    return _ended(spark, "complete", build)[0]


@plan(
    "i3_stream_merge",
    f"""WITH {MESSAGES_SQL},
a AS (SELECT pulse_id, arg_max(value, arrival_seq) AS value_a, max(arrival_seq) AS arrival_seq_a
      FROM messages WHERE stream_id = 'click' GROUP BY pulse_id),
b AS (SELECT pulse_id, arg_max(value, arrival_seq) AS value_b, max(arrival_seq) AS arrival_seq_b
      FROM messages WHERE stream_id = 'view' GROUP BY pulse_id)
SELECT * FROM a FULL JOIN b USING (pulse_id)""",
)
def i3_stream_merge(spark, sf_dir):
    path = _event_files(spark, sf_dir)

    def build(ends):
        live = _live_messages(spark, path).withColumn("event_time", F.col("recv_ts"))
        sides = [live.where(F.col("stream_id") == s).select("pulse_id", "arrival_seq", "value", "event_time") for s in ("click", "view")]
        return streams.stream_merge(*[streams.with_end(side, ends) for side in sides], _PATIENCE)

    return _ended(spark, "merged", build)[0].select("pulse_id", "value_a", "arrival_seq_a", "value_b", "arrival_seq_b")


@plan(
    "i4_stream_rates",
    f"""WITH {MESSAGES_SQL}
SELECT stream_id, time_bucket(INTERVAL 1 HOUR, recv_ts) AS window_start, count(*) AS messages,
       CAST(sum(n_bytes) AS BIGINT) AS n_bytes, round(count(*) / 3600.0, 6) AS message_rate
FROM messages GROUP BY ALL""",
)
def i4_stream_rates(spark, sf_dir):
    messages = _live_messages(spark, _event_files(spark, sf_dir))
    build = lambda ends: streams.stream_rates(streams.with_end(messages, ends, "recv_ts"), "1 hour", delay=_PATIENCE)
    landed = _ended(spark, "rates", build)[0]
    start = F.convert_timezone(None, F.lit("UTC"), F.col("window_start").cast("timestamp_ntz"))
    rate = F.round("message_rate", 6)
    return landed.select("stream_id", start.alias("window_start"), "messages", "n_bytes", rate.alias("message_rate"))


# A batch drops what lies in windows that the batches up to the one before the last have closed.
_LATE_FILES, _LATE_GROUP = 12, 3


@plan(
    "i5_stream_late",
    f"""WITH {MESSAGES_SQL},
filed AS (SELECT *, arrival_seq * {_LATE_FILES} // (SELECT max(arrival_seq) + 1 FROM messages) AS file FROM messages),
taken AS (SELECT *, file // {_LATE_GROUP} * {_LATE_GROUP} + {_LATE_GROUP} - 1 - file % {_LATE_GROUP} AS batch FROM filed),
newest AS (SELECT batch, max(max(date_trunc('millisecond', recv_ts))) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS seen
           FROM taken GROUP BY batch)
SELECT count(*) AS input_rows, count(*) FILTER (late) AS late_rows
FROM (SELECT coalesce(time_bucket(INTERVAL 1 HOUR, recv_ts) + INTERVAL 1 HOUR <= seen - INTERVAL 1 HOUR, false) AS late
      FROM taken JOIN newest USING (batch))""",
)
def i5_stream_late(spark, sf_dir):
    messages = _live_messages(spark, _event_files(spark, sf_dir, _LATE_FILES, _LATE_GROUP))
    build = lambda ends: streams.stream_rates(streams.with_end(messages, ends, "recv_ts"), "1 hour", delay="1 hour")
    landed, progress = _ended(spark, "late", build)
    return streams.late_rows(spark, progress, landed).select("input_rows", "late_rows")


@plan(
    "i6_bounded_run",
    f"""WITH {MESSAGES_SQL} SELECT stream_id, arrival_seq, pulse_id, header_hash FROM messages ORDER BY arrival_seq LIMIT 500""",
)
def i6_bounded_run(spark, sf_dir):
    """Stopped after 200 messages and started again: in the end the first 500 are there."""
    live = _live_messages(spark, _event_files(spark, sf_dir, group=1)).select("stream_id", "arrival_seq", "pulse_id", "header_hash")
    path = scratch_dir(spark, "bounded")
    for n in (200, 500):
        assert streams.run_available(live, f"{path}/out", f"{path}/checkpoint", timeout_s=3600, n=n)
    return streams.bounded_rows(spark, f"{path}/out", 500)


@plan(
    "i7_stream_archive",
    f"""WITH {SAMPLES_SQL}
SELECT channel, pulse_id, value AS data, user_id AS "timestamp", arrival_seq AS timestamp_offset, stream_id, arrival_seq
FROM samples""",
)
def i7_stream_archive(spark, sf_dir):
    live = _live_samples(spark, _event_files(spark, sf_dir)).select(
        "stream_id", "channel", "pulse_id", "value", F.col("user_id").alias("ts_sec"),
        F.col("arrival_seq").alias("ts_ns"), "arrival_seq",
    )
    path = scratch_dir(spark, "live")
    query = streams.stream_archive(live, f"{path}/out", f"{path}/checkpoint", available_now=True)
    query.awaitTermination()
    return read_channels(spark, f"{path}/out")


@plan(
    "i7_stream_compact",
    f"WITH {MESSAGES_SQL} SELECT pulse_id, k, value FROM messages",
)
def i7_stream_compact(spark, sf_dir):
    live = _live_messages(spark, _event_files(spark, sf_dir))
    path = scratch_dir(spark, "live")
    query = streams.stream_archive(live, f"{path}/out", f"{path}/checkpoint", layout="compact", available_now=True)
    query.awaitTermination()
    return spark.read.parquet(f"{path}/out")


@plan(
    "i7_stream_versions",
    f"""WITH {SAMPLES_SQL},
versions AS (SELECT stream_id, arrival_seq, pulse_id, channel, value, {VERSION_SQL} AS version FROM samples)
SELECT stream_id, arrival_seq, pulse_id,
       {VERSION_CELLS}
FROM versions GROUP BY stream_id, arrival_seq, pulse_id""",
)
def i7_stream_versions(spark, sf_dir):
    """Channels change their definitions on two days while the stream runs; it is stopped and started again in between."""
    source = scratch_dir(spark, "events")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = scratch_dir(spark, "versions")
    for until in (6, 15, 24, 99):
        day = F.dayofmonth("ts")
        events.where((day >= {6: 0, 15: 6, 24: 15, 99: 24}[until]) & (day < until)).coalesce(1).write.mode("append").parquet(source)
        live = typed_samples(_live_samples(spark, source))
        versions.stream_versioned(live, path, f"{path}/checkpoint", available_now=True).awaitTermination()
    return versions.read_versions(spark, path)
