"""The operators on live streams, with Structured Streaming."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsekit.operators.continuity import classify
from pulsekit.operators.joins import lookup_join
from pulsekit.operators.scan import OrderedScan
from pulsekit.operators.select import ChannelRule, channel_rules, decimate, filter_messages, take_messages
from pulsekit.sources.archive import channel_rows, compact_columns
from pulsekit.sources.files import folders, remove
from pulsekit.sources.frames import decode_frames


def stream_samples(
    frames: DataFrame,
    specs: Iterable[str | dict | ChannelRule] | None = None,
    predicate: Column | Callable[[pd.DataFrame], pd.Series] | None = None,
) -> DataFrame:
    """Decode, choose and thin out channels, filter. No state; a batch of frames works the same way."""
    rules = None if specs is None else channel_rules(specs)
    samples = decode_frames(frames, None if rules is None else [r.name for r in rules])
    if rules is not None:
        samples = decimate(samples, rules)
    return samples if predicate is None else filter_messages(samples, predicate)


def stream_rates(messages: DataFrame, window: str = "1 second", slide: str | None = None, delay: str = "10 seconds") -> DataFrame:
    """I4: message and byte rate per stream and time window; windows close `delay` after their end.

    `recv_ts` must be a TIMESTAMP. Counting combines before the shuffle, so one busy stream is no burden. Windows still
    open when a bounded run ends come out with its closing event, see :func:`with_end`.
    """
    timed = _observed(messages.withWatermark("recv_ts", delay), "recv_ts")
    counted = timed.groupBy(F.window("recv_ts", window, slide), "stream_id").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("n_bytes").cast("bigint").alias("n_bytes")
    )
    seconds = F.timestamp_diff("MICROSECOND", F.col("window.start"), F.col("window.end")) / 1e6
    return counted.select(
        "stream_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "messages",
        "n_bytes",
        (F.col("messages") / seconds).alias("message_rate"),
        (F.col("n_bytes") / seconds * 8 / (1024 * 1024)).alias("receive_mbps"),
    )


# ---- the end of a bounded run ----

# The time of the event that ends a run, near the last one that nanoseconds can tell. No window that holds it ever closes, so
# the event itself never comes out.
END = "2262-01-01 00:00:00"
_INPUT = "pulsekit_input"


def _end():
    return F.lit(END).cast("timestamp")


def _observed(timed: DataFrame, event_time: str) -> DataFrame:
    """Count what goes into a stateful operator, before the watermark drops any of it; closing events do not count."""
    return timed.observe(_INPUT, F.count_if(F.col(event_time) < _end()).alias("rows"))


def with_end(stream: DataFrame, ends: str, event_time: str = "event_time", **values) -> DataFrame:
    """A stream together with the events that end it, which :func:`end_stream` puts into the folder `ends`.

    A watermark only moves when newer data comes, so the last windows of a stream that stops would stay in the state for
    good. The closing event is newer than anything and closes them. It is united with the stream before the watermark is
    taken, carries NULLs, and must pass the filters in front of the watermark: give it `values` for that, as
    ``channel="a"`` for an alignment of channel a.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], "at timestamp").write.mode("ignore").parquet(ends)
    types = dict(stream.dtypes)
    closing = spark.readStream.schema("at timestamp").parquet(ends).select(
        F.col("at").cast(types[event_time]).alias(event_time), *[F.lit(v).cast(types[c]).alias(c) for c, v in values.items()]
    )
    return stream.unionByName(closing, allowMissingColumns=True)


def end_stream(spark: SparkSession, ends: str) -> None:
    """Write the closing event, once. What comes behind it is late."""
    if spark.read.schema("at timestamp").parquet(ends).isEmpty():
        spark.range(1).select(_end().alias("at")).write.mode("append").parquet(ends)


def run_to_end(
    df: DataFrame, path: str, checkpoint: str, ends: str, timeout_s: float | None = None, progress: str | None = None
) -> bool:
    """Land all that is there in Parquet and then what the state still held: the stream ends itself.

    `df` is an operator over a stream from :func:`with_end` with the same `ends`. The run first takes all input, then the
    closing event, which moves the watermark past everything. False if the timeout ended it before; a later run goes on.
    """
    if not run_available(df, path, checkpoint, timeout_s, progress=progress):
        return False
    end_stream(df.sparkSession, ends)
    return run_available(df, path, checkpoint, timeout_s, progress=progress)


# ---- continuity ----


def _start(df: DataFrame, checkpoint: str, available_now: bool, interval: str | None):
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def stream_continuity(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    rows_path: str | None = None,
    available_now: bool = False,
    interval: str | None = None,
    scan: OrderedScan = OrderedScan(),
) -> StreamingQuery:
    """Running continuity totals per stream.

    Each micro-batch runs the bucketed batch scan, so a busy stream is spread over the cluster, and starts
    from the totals and highest pulse the batch before left in `path` (one row per stream). Totals are
    filed by batch number and written anew when a batch is repeated, so every message counts once.
    Nothing is dropped: a pulse that comes late counts as reverted. The source must deliver a stream's
    rows in order from batch to batch. With `rows_path` the classified messages are kept, too.
    """

    def step(batch: DataFrame, number: int) -> None:
        # The stream's own session resolves the batch; it has to write the state, too.
        session = batch.sparkSession
        keys = list(scan.by)
        # asked for twice, by the summary and by the rows: kept for the length of the batch
        slim = batch.select(*keys, scan.order, "pulse_id").persist()
        marked = scan.prefix_max(slim, "pulse_id", "_local")
        if number > 0:
            before = session.read.parquet(f"{path}/batch={number - 1}")
            given = before.select(*keys, F.col("hwm").alias("_carry"))
            marked = lookup_join(marked, given, keys)
            marked = marked.withColumn("hwm", F.greatest("_carry", "_local")).drop("_carry", "_local")
        else:
            before = None
            marked = marked.withColumnRenamed("_local", "hwm")
        classified = classify(marked)
        if rows_path is not None:
            classified.write.mode("overwrite").parquet(f"{rows_path}/batch={number}")
            classified = session.read.parquet(f"{rows_path}/batch={number}")
        counts = ["messages", "missed", "duplicated", "reverted"]
        new = classified.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("messages"),
            *[F.sum(c).alias(c) for c in counts[1:]],
            F.max("pulse_id").alias("hwm"),
        )
        if before is not None:
            new = before.unionByName(new)
        totals = new.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts], F.max("hwm").alias("hwm"))
        totals.write.mode("overwrite").parquet(f"{path}/batch={number}")
        slim.unpersist()
        # this batch may be repeated and then needs the totals before it; those before these are done with
        remove(session, f"{path}/batch={number - 2}")

    return _start(messages, checkpoint, available_now, interval).foreachBatch(step).start()


def continuity_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest totals :func:`stream_continuity` left in a folder: at most two are there, only the newest is read."""
    newest = max(int(name.partition("=")[2]) for name in folders(spark, path) if name.startswith("batch="))
    return spark.read.parquet(f"{path}/batch={newest}")


# ---- alignment ----


def stream_align(
    samples: DataFrame, channels: Sequence[str], tolerance: str, event_time: str = "event_time", counted: str | None = None
) -> DataFrame:
    """One row per pulse, sent once no more of its samples are awaited.

    The samples of a pulse form a session that ends `tolerance` after the last of them; when the watermark
    passes that, the pulse goes out with NULL for channels that did not come. All in the JVM, with values
    of any type, and combined before the shuffle. :func:`stream_align_complete` sends full pulses at once.
    A pulse whose samples come further apart than `tolerance` goes out in parts: choose it wide enough. Pulses still open
    when a bounded run ends come out with its closing event, see :func:`with_end`. `counted` names a column for the number
    of samples that went into a row, which :func:`late_rows` needs.
    """
    timed = samples.withWatermark(event_time, tolerance)
    wanted = _observed(timed.where(F.col("channel").isin(list(channels))), event_time)
    cells = []
    for name in channels:
        mine = F.col("channel") == name
        cells.append(F.max_by(F.when(mine, F.col("value")), F.when(mine, F.col("arrival_seq"))).alias(name))
    if counted is not None:
        cells.append(F.count(F.lit(1)).alias(counted))
    return (
        wanted.groupBy("pulse_id", F.session_window(event_time, tolerance).alias("_span"))
        .agg(*cells)
        .drop("_span")
    )


# Neighbouring pulses that share a state, about, and the groups a stretch of pulses is dealt to.
_TOGETHER, _LANES = 128, 64


def stream_align_complete(
    samples: DataFrame, channels: Sequence[str], tolerance: str, event_time: str = "event_time"
) -> DataFrame:
    """One row per pulse, sent as soon as all channels are there, at the latest `tolerance` after its first sample.

    A pulse is kept until the watermark passes it, so that it does not open again once it is finished. To call Python once
    for many pulses, a stretch of them is dealt to groups by hash, and a group holds its pulses in one state: as many
    groups work on the newest pulses at a time, and a state never holds more than its stretch.
    Values travel through the state as JSON and come out with the type of the `value` column.
    """
    names = list(channels)
    value_type = samples.schema["value"].dataType.simpleString()
    wait_ms = _milliseconds(samples.sparkSession, tolerance)
    end_ms = samples.sparkSession.range(1).select(F.unix_millis(_end())).first()[0]
    slim = (
        samples.where(F.col("channel").isin(names))
        .withWatermark(event_time, tolerance)
        .select(
            F.expr(f"pulse_id div {_TOGETHER * _LANES}L").alias("_stretch"),
            F.when(F.col("pulse_id").isNotNull(), F.pmod(F.xxhash64("pulse_id"), F.lit(_LANES))).alias("_lane"),
            "pulse_id",
            "channel",
            "arrival_seq",
            F.to_json(F.struct(F.col("value").alias("v"))).alias("v"),
            F.unix_millis(event_time).alias("at_ms"),
            event_time,
        )
    )

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # per pulse: its first time, the time it is kept until, whether it was sent, the newest sample of each channel
        held = {p: pulse for p, *pulse in json.loads(state.get[0])} if state.exists else {}
        now, touched, out = state.getCurrentWatermarkMs(), set(), []
        for rows in () if state.hasTimedOut else frames:
            pulses = [None] * len(rows) if pd.isna(key[0]) else rows["pulse_id"].tolist()  # NULL is a group of its own
            columns = (rows[c].tolist() for c in ("channel", "arrival_seq", "v", "at_ms"))
            for p, channel, seq, value, at in zip(pulses, *columns):
                if at >= end_ms:  # the closing event of the run is no sample
                    continue
                touched.add(p)
                pulse = held.setdefault(p, [int(at), 0, False, {}])
                pulse[0] = min(pulse[0], int(at))
                known = pulse[3].get(channel)
                if known is None or known[0] < seq:
                    pulse[3][channel] = (int(seq), value)
        for p in touched:
            pulse = held[p]
            pulse[1] = max(pulse[0] + wait_ms, now + 1)
            if not pulse[2] and len(pulse[3]) == len(names):
                out.append((p, _cells(pulse[3], names)))
                pulse[2] = True
            if pulse[2]:
                pulse[3] = {}
        for p in [p for p, pulse in held.items() if pulse[1] < now and p not in touched]:
            _, _, sent, seen = held.pop(p)
            if not sent:
                out.append((p, _cells(seen, names)))
        if held:
            state.update((json.dumps([(p, *pulse) for p, pulse in held.items()]),))
            state.setTimeoutTimestamp(max(min(pulse[1] for pulse in held.values()), now))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["pulse_id", "cells"])

    rows = slim.groupBy("_stretch", "_lane").applyInPandasWithState(
        step, "pulse_id bigint, cells array<string>", "held string", "append", GroupStateTimeout.EventTimeTimeout
    )
    typed = lambda i: F.from_json(F.get("cells", F.lit(i)), f"v {value_type}")["v"]
    return rows.select("pulse_id", *[typed(i).alias(name) for i, name in enumerate(names)])


def _cells(seen: dict, names: list[str]) -> list[str | None]:
    return [seen[n][1] if n in seen else None for n in names]


def _milliseconds(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {interval}"))).first()[0]


def _newest_per_pulse(stream: DataFrame, tolerance: str, event_time: str, suffix: str) -> DataFrame:
    """The last arrival of each pulse, its columns renamed, once no more arrivals of it are awaited."""
    order = "arrival_seq" if "arrival_seq" in stream.columns else event_time
    timed = stream.withWatermark(event_time, tolerance)
    # the row's own time becomes a plain column: the event time of the result is the end of the span
    plain = {event_time: F.col(event_time) + F.expr("INTERVAL 0 SECONDS")}
    row = F.struct(*[plain.get(c, F.col(f"`{c}`")).alias(f"{c}{suffix}") for c in stream.columns if c != "pulse_id"])
    spans = timed.groupBy(F.col("pulse_id").alias(f"pulse_id{suffix}"), F.session_window(event_time, tolerance).alias("_span"))
    newest = spans.agg(F.max_by(row, F.col(order)).alias("_row"))
    return newest.select(f"pulse_id{suffix}", "_row.*", F.window_time("_span").alias(f"_at{suffix}"))


def stream_merge(a: DataFrame, b: DataFrame, tolerance: str, event_time: str = "event_time", suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """I3 for two streams: one row per pulse, the other stream's columns NULL where it has none near in time.

    Each side first shrinks to the last arrival of a pulse (by `arrival_seq` where there is one), whose arrivals lie at most
    `tolerance` apart. A full outer stream-stream join then matches pulses whose last arrivals lie at most `tolerance` apart
    and waits that long for the other side: both states are bounded by that time, and repeats cannot multiply.
    """
    left, right = (_newest_per_pulse(s, tolerance, event_time, suffix) for s, suffix in zip((a, b), suffixes))
    pa, pb = (f"pulse_id{s}" for s in suffixes)
    ta, tb = (F.col(f"_at{s}") for s in suffixes)
    near = (tb >= ta - F.expr(f"INTERVAL {tolerance}")) & (tb <= ta + F.expr(f"INTERVAL {tolerance}"))
    joined = left.join(right, (F.col(pa) == F.col(pb)) & near, "full_outer")
    return joined.withColumn("pulse_id", F.coalesce(pa, pb)).drop(pa, pb, *[f"_at{s}" for s in suffixes])


# ---- sinks ----


def stream_archive(
    data: DataFrame,
    path: str,
    checkpoint: str,
    layout: str = "channels",
    available_now: bool = False,
    interval: str | None = None,
    rows_per_file: int = 1_000_000,
) -> StreamingQuery:
    """Archive a live stream: samples per channel, or wide rows as a compact archive.

    The file sink commits each batch once. Samples of a channel are brought together by blocks of
    arrivals first, which keeps files few and lets a large channel use several tasks. Columns whose definition changes
    have `versions.stream_versioned`.
    """
    if layout == "channels":
        block = F.expr(f"arrival_seq div {rows_per_file}L")
        rows = channel_rows(data).repartition(F.col("channel"), block)
        return _start(rows, checkpoint, available_now, interval).partitionBy("channel").format("parquet").start(path)
    if layout == "compact":
        rows = data.select(*[F.col(f"`{c}`") for c in compact_columns(data)])
        return _start(rows, checkpoint, available_now, interval).format("parquet").start(path)
    raise ValueError(f"unknown layout {layout!r}, known are channels and compact")


def run_available(
    df: DataFrame,
    path: str,
    checkpoint: str,
    timeout_s: float | None = None,
    n: int | None = None,
    accepted: Column | None = None,
    progress: str | None = None,
) -> bool:
    """Land everything that is there now in Parquet, or as much as the timeout and `n` ask for.

    True when all was landed, or `n` rows; otherwise a later run with the same checkpoint goes on from there. With `n`, rows
    land for which `accepted` is true (all, if not given), until there are n. Whole batches land, so that a later run loses
    nothing: the first n of them are :func:`bounded_rows`. How many each batch landed is filed beside the checkpoint under
    the batch's number, so the count goes on over restarts, and a repeated batch counts once. `progress` is a folder in
    which the progress of every batch is filed, see :func:`late_rows`.
    """
    spark = df.sparkSession
    counts = f"{checkpoint}/landed"
    if n is not None and _landed(spark, counts) >= n:
        return True
    full = [False]

    def land(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = batch if accepted is None else batch.where(accepted)
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        landed = session.read.schema(rows.schema).parquet(f"{path}/batch={number}").agg(F.count("*").alias("n"))
        landed.write.mode("overwrite").parquet(f"{counts}/batch={number}")
        full[0] = _landed(session, counts) >= n

    writer = _start(df, checkpoint, True, None)
    query = (writer.format("parquet").start(path) if n is None else writer.foreachBatch(land).start())
    until = None if timeout_s is None else time.monotonic() + timeout_s
    filed: set[int] = set()
    while True:
        step = 1.0 if n is None and progress is None else 0.2
        done = query.awaitTermination(step if until is None else max(0.01, min(step, until - time.monotonic())))
        if progress is not None:
            _file_progress(spark, query, progress, filed)
        if done:
            return True
        if full[0] or until is not None and time.monotonic() >= until:
            query.stop()
            if progress is not None:
                _file_progress(spark, query, progress, filed)
            return full[0]


def _landed(spark: SparkSession, counts: str) -> int:
    """Rows landed by all batches so far."""
    try:
        known = spark.read.schema("n bigint").parquet(counts)
    except AnalysisException:  # the first batch of the first run
        return 0
    return known.agg(F.sum("n")).first()[0] or 0


def bounded_rows(spark: SparkSession, path: str, n: int, order: str = "arrival_seq") -> DataFrame:
    """Exactly the first n rows, by `order`, that runs with `n` have landed in `path`."""
    return take_messages(spark.read.parquet(path).drop("batch"), n, order, checked=False)


_PROGRESS = "batch bigint, run string, rows bigint, dropped bigint, watermark string"


def _file_progress(spark: SparkSession, query: StreamingQuery, path: str, filed: set[int]) -> None:
    """File what a run's batches report: Spark itself forgets all but the last hundred."""
    rows = []
    for p in query.recentProgress:
        if p.batchId in filed or not p.durationMs.get("addBatch"):
            continue
        seen = p.observedMetrics.get(_INPUT)
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        rows.append((p.batchId, str(p.runId), seen["rows"] if seen else 0, dropped, p.eventTime.get("watermark")))
        filed.add(p.batchId)
    if rows:
        spark.createDataFrame(rows, _PROGRESS).coalesce(1).write.mode("append").parquet(path)


def late_rows(spark: SparkSession, progress: str, landed: DataFrame, counted: str = "messages") -> DataFrame:
    """One row (batches, input_rows, kept_rows, late_rows) about a run that has ended: what went into its stateful
    operator, how much of it is in the rows that came out, and the rest, which came too late and was dropped.

    `progress` is the folder the run filed its batches in, over any number of batches and restarts; `landed` are its
    rows, with a column `counted` that says how many input rows each is made of. Exact once :func:`run_to_end` has emptied
    the state; before that, rows still open look late. Spark's own count of dropped rows is no input count: it is taken
    after rows have been combined before the shuffle. A repeated batch counts once. An error if a batch was not filed.
    """
    filed = spark.read.schema(_PROGRESS).parquet(progress).groupBy("batch").agg(F.max_by("rows", "run").alias("rows"))
    lost = F.raise_error(F.lit("the progress of some batches was not filed")).cast("bigint")
    told = filed.agg(F.count("*").alias("batches"), F.max("batch").alias("last"), F.sum("rows").alias("rows"))
    told = told.select("batches", F.when(F.col("batches") <= F.col("last"), lost).otherwise(F.col("rows")).alias("input_rows"))
    kept = landed.agg(F.sum(counted).cast("bigint").alias("kept_rows"))
    both = told.unionByName(kept, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("batches", "input_rows", "kept_rows")]
    return both.agg(*sums).withColumn("late_rows", F.col("input_rows") - F.col("kept_rows"))
