"""Streams over several micro-batches give what the batch operators give on the whole."""

import random
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from pulsekit.operators.continuity import classify_pulses, continuity_stats
from pulsekit.operators.scan import OrderedScan
from pulsekit.operators.select import decimate
from pulsekit.sources import frames as fr
from pulsekit.sources.archive import read_channels
from pulsekit.streaming import streams, versions

START = datetime(2024, 1, 1)


def feed(df, path, chunks, key="arrival_seq"):
    """Write a table as files that the stream source takes in this order."""
    bounds = df.agg(F.min(key), F.max(key) + 1).first()
    width = (bounds[1] - bounds[0] + chunks - 1) // chunks
    for i in range(chunks):
        lo = bounds[0] + i * width
        df.where((F.col(key) >= lo) & (F.col(key) < lo + width)).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.05)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


@pytest.fixture(scope="module")
def messages(spark):
    rng, data, pulse = random.Random(4), [], {s: 0 for s in "aab"}
    for seq in range(300):
        s = rng.choice("aab")
        pulse[s] = max(0, pulse[s] + rng.choice([-2, 0, 1, 1, 1, 4]))
        data.append((s, seq, pulse[s], START + timedelta(milliseconds=70 * seq + rng.randrange(60)), rng.randrange(100)))
    return spark.createDataFrame(data, "stream_id string, arrival_seq bigint, pulse_id bigint, recv_ts timestamp, n_bytes bigint").cache()


def test_continuity(spark, messages, tmp_path):
    feed(messages, tmp_path / "in", 5)
    source = stream(spark, tmp_path / "in", messages.schema)
    where = {k: str(tmp_path / k) for k in ("totals", "check", "rows")}
    run = lambda: streams.stream_continuity(
        source, where["totals"], where["check"], where["rows"], available_now=True, scan=OrderedScan(bucket_rows=16)
    ).awaitTermination()
    run()
    columns = ["stream_id", "messages", "missed", "duplicated", "reverted"]
    assert rows(streams.continuity_totals(spark, where["totals"]), *columns) == rows(continuity_stats(messages), *columns)
    kept = spark.read.parquet(where["rows"])
    assert kept.select("batch").distinct().count() == 5
    assert rows(kept, "stream_id", "arrival_seq", "kind", "hwm") == rows(classify_pulses(messages), "stream_id", "arrival_seq", "kind", "hwm")
    # More data under the same checkpoint goes on from the totals so far.
    more = spark.createDataFrame([("a", 1000, 10**6, START, 1), ("new", 1001, 5, START, 1), ("new", 1002, 7, START, 1)], messages.schema)
    feed(more, tmp_path / "in", 1)
    run()
    assert rows(streams.continuity_totals(spark, where["totals"]), *columns) == rows(continuity_stats(messages.unionByName(more)), *columns)


def test_samples(spark, tmp_path):
    wide = spark.range(60).selectExpr("'s' AS stream_id", "id AS arrival_seq", "id AS pulse_id", "1L AS global_sec", "2L AS global_ns", "id * 2 AS a", "id / 4D AS b", "'t' AS c")
    frames = fr.encode_frames(wide)
    feed(frames, tmp_path / "in", 3)
    specs = ["a", {"name": "b", "modulo": 5}]
    live = streams.stream_samples(fr.read_frames(spark, str(tmp_path / "in"), streaming=True, maxFilesPerTrigger="1"), specs, F.col("ts_sec") == 1)
    assert streams.run_available(live, str(tmp_path / "out"), str(tmp_path / "check"))
    columns = ["arrival_seq", "channel", "value.i", "value.f", "status"]
    assert rows(spark.read.parquet(str(tmp_path / "out")), *columns) == rows(decimate(fr.decode_frames(frames), specs), *columns)
    assert rows(streams.stream_samples(frames, specs), *columns) == rows(decimate(fr.decode_frames(frames), specs), *columns)


def test_rates(spark, messages, tmp_path):
    feed(messages, tmp_path / "in", 4)
    source = stream(spark, tmp_path / "in", messages.schema)
    live = streams.stream_rates(source, "2 seconds", delay="1 second")
    streams.run_available(live, str(tmp_path / "out"), str(tmp_path / "check"), timeout_s=120)
    got = spark.read.parquet(str(tmp_path / "out"))
    newest = messages.agg(F.max("recv_ts")).first()[0]
    whole = messages.groupBy("stream_id", F.window("recv_ts", "2 seconds").alias("w")).agg(F.count("*").alias("n"), F.sum("n_bytes").alias("b"))
    closed = whole.where(F.col("w.end") <= F.lit(newest - timedelta(seconds=1)))
    expected = rows(closed, "stream_id", "w.start", "n", "b", F.col("n") / 2)
    assert rows(got, "stream_id", "window_start", "messages", "n_bytes", "message_rate") == expected and len(expected) > 10


def pulses(spark):
    rng, data, seq = random.Random(9), [], 0
    for pulse in range(60):
        at = START + timedelta(seconds=pulse)
        for channel in rng.sample("pqr", rng.choice([2, 3, 3])):
            for _ in range(rng.choice([1, 1, 2])):
                data.append((pulse, seq, channel, rng.random(), at + timedelta(milliseconds=rng.randrange(400))))
                seq += 1
    # Much later data moves the watermark past everything above.
    data += [(10_000, seq + i, c, 0.5, START + timedelta(hours=1)) for i, c in enumerate("pqr")]
    return spark.createDataFrame(data, "pulse_id bigint, arrival_seq bigint, channel string, value double, event_time timestamp")


@pytest.mark.parametrize("kind", ["stream_align", "stream_align_complete"])
def test_alignment(spark, tmp_path, kind):
    samples = pulses(spark).cache()
    feed(samples, tmp_path / "in", 4)
    live = getattr(streams, kind)(stream(spark, tmp_path / "in", samples.schema), list("pqr"), "2 seconds")
    streams.run_available(live, str(tmp_path / "out"), str(tmp_path / "check"))
    got = spark.read.parquet(str(tmp_path / "out")).where("pulse_id < 10000")
    assert got.count() == got.select("pulse_id").distinct().count() == 60
    assert dict(got.dtypes)["p"] == "double"
    present = samples.where("pulse_id < 10000").groupBy("pulse_id").pivot("channel", list("pqr")).agg(F.collect_set("value"))
    for r in present.join(got, "pulse_id").select(*[F.struct(present[c].alias("all"), got[c].alias("one")).alias(c) for c in "pqr"]).collect():
        for cell in r:
            assert cell["one"] in cell["all"] if cell["all"] else cell["one"] is None
    if kind == "stream_align":
        from pulsekit.operators.align import align_pulses

        assert rows(got, "pulse_id", "p", "q", "r") == rows(align_pulses(samples.where("pulse_id < 10000"), list("pqr")), "pulse_id", "p", "q", "r")


def test_merge_of_two_streams(spark, tmp_path):
    def side(ids, v):
        data = [(i, float(v), START + timedelta(seconds=i), i) for i in ids]
        # every third pulse came before with another value, every fourth comes again with a later one
        data += [(i, -1.0, START + timedelta(seconds=i), i - 1000) for i in ids if i % 3 == 0]
        data += [(i, v + 0.5, START + timedelta(seconds=i, milliseconds=500), i + 1000) for i in ids if i % 4 == 0]
        return spark.createDataFrame(data, "pulse_id bigint, value double, event_time timestamp, arrival_seq bigint")

    a, b = side(range(0, 30), 1), side(range(20, 40), 2)
    feed(a, tmp_path / "a", 3, "pulse_id")
    feed(b, tmp_path / "b", 2, "pulse_id")
    ends = str(tmp_path / "ends")
    sides = [streams.with_end(stream(spark, tmp_path / name, a.schema), ends) for name in "ab"]
    live = streams.stream_merge(*sides, "50 seconds")
    assert streams.run_to_end(live, str(tmp_path / "out"), str(tmp_path / "check"), ends)
    got = rows(spark.read.parquet(str(tmp_path / "out")), "pulse_id", "value_a", "value_b")
    value = lambda i, v: v + 0.5 if i % 4 == 0 else float(v)
    expected = [(i, value(i, 1) if i < 30 else None, value(i, 2) if i >= 20 else None) for i in range(40)]
    assert got == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def late_brute(batches, delay, window, rested=()):
    """Rows that lie in windows closed by the watermark of the batch before: that of the newest row two batches ago, less the
    delay, or one batch ago where the stream `rested` before a batch and ran one without data."""
    epoch, newest, late, per_window = datetime(1970, 1, 1), [], 0, {}
    for k, batch in enumerate(batches):
        mark = max(newest[: k if k in rested else max(0, k - 1)], default=None)
        for at in batch:
            end = epoch + ((at - epoch) // window + 1) * window
            if mark is not None and end <= mark.replace(microsecond=mark.microsecond // 1000 * 1000) - delay:
                late += 1
            else:
                per_window[end] = per_window.get(end, 0) + 1
        newest.append(max(batch))
    return late, per_window


@pytest.fixture
def one_partition(spark):
    """Many small batches: one state store each is enough."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_late_rows_over_many_batches(spark, tmp_path, one_partition):
    """More batches than Spark remembers, and a run that is stopped half way and goes on."""
    rng, n = random.Random(5), 104
    batches = [[START + timedelta(seconds=10 * k + rng.randrange(-60, 10), microseconds=rng.randrange(10**6)) for _ in range(4)] for k in range(n)]
    schema = "stream_id string, recv_ts timestamp, n_bytes bigint"

    def more(some):
        (tmp_path / "in").mkdir(exist_ok=True)
        for batch in some:
            file = pa.table({"stream_id": ["a"] * len(batch), "recv_ts": pa.array(batch, pa.timestamp("us", "UTC")), "n_bytes": [1] * len(batch)})
            pq.write_table(file, tmp_path / "in" / f"{batches.index(batch):03}.parquet")
            time.sleep(0.005)

    more(batches[:60])
    ends, place = str(tmp_path / "ends"), [str(tmp_path / k) for k in ("out", "check")]
    live = streams.stream_rates(streams.with_end(stream(spark, tmp_path / "in", schema), ends, "recv_ts"), "5 seconds", delay="20 seconds")
    assert streams.run_available(live, *place, progress=str(tmp_path / "progress"))
    more(batches[60:])
    assert streams.run_to_end(live, *place, ends, progress=str(tmp_path / "progress"))
    landed = spark.read.parquet(place[0])
    told = streams.late_rows(spark, str(tmp_path / "progress"), landed).first()
    late, per_window = late_brute(batches, timedelta(seconds=20), timedelta(seconds=5), rested=(60,))
    assert told.batches > 100 and told.input_rows == 4 * n and told.input_rows == told.kept_rows + told.late_rows
    assert told.late_rows == late > 40
    assert landed.agg(F.sum("messages")).first()[0] == told.kept_rows
    # nothing landed, nothing made up
    none = streams.late_rows(spark, str(tmp_path / "progress"), landed.where("false")).first()
    assert none.kept_rows == 0 and none.late_rows == 4 * n


def test_a_stream_ends_itself(spark, messages, tmp_path):
    """Files out of order, one batch each: all windows land, those of the end, too; without the closing event they do not."""
    for k in (1, 0, 3, 2):
        messages.where(F.expr("arrival_seq div 75") == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    ends, source = str(tmp_path / "ends"), stream(spark, tmp_path / "in", messages.schema)
    live = streams.stream_rates(streams.with_end(source, ends, "recv_ts"), "2 seconds", delay="12 seconds")
    place = [str(tmp_path / k) for k in ("out", "check")]
    whole = rows(messages.groupBy("stream_id", F.window("recv_ts", "2 seconds").alias("w")).agg(F.count("*").alias("n")), "stream_id", "w.start", "n")
    assert streams.run_available(live, *place)
    assert 0 < spark.read.parquet(place[0]).count() < len(whole)
    for _ in range(2):  # once it has ended, another run changes nothing
        assert streams.run_to_end(live, *place, ends)
        assert rows(spark.read.parquet(place[0]), "stream_id", "window_start", "messages") == whole


@pytest.mark.parametrize("kind", ["stream_align", "stream_align_complete"])
def test_alignment_to_the_end(spark, tmp_path, kind, one_partition):
    samples = pulses(spark).where("pulse_id < 10000").cache()
    feed(samples, tmp_path / "in", 4)
    for channels in (list("pqr"), ["p"]):
        ends = str(tmp_path / f"ends{len(channels)}")
        source = streams.with_end(stream(spark, tmp_path / "in", samples.schema), ends, channel="p")
        out = str(tmp_path / f"out{len(channels)}")
        live = getattr(streams, kind)(source, channels, "20 seconds")
        assert streams.run_to_end(live, out, str(tmp_path / f"check{len(channels)}"), ends)
        got = spark.read.parquet(out)
        from pulsekit.operators.align import align_pulses

        want = align_pulses(samples, channels)
        if kind == "stream_align":
            assert rows(got, "pulse_id", *channels) == rows(want, "pulse_id", *channels)
        else:
            assert rows(got, "pulse_id") == rows(want, "pulse_id")


def test_complete_alignment_holds_many_pulses_in_one_state(spark, tmp_path):
    sent = spark.range(6000).select((F.col("id") * 7 % 6000).alias("arrival_seq"))
    pulse, at = F.expr("arrival_seq div 3L"), F.lit(START) + F.expr("make_dt_interval(0, 0, 0, arrival_seq / 300)")
    sent = sent.withColumn("pulse_id", F.when(pulse != 77, pulse)).withColumn("event_time", at)
    sent = sent.withColumn("channel", F.substring(F.lit("pqr"), (F.col("arrival_seq") % 3 + 1).cast("int"), F.lit(1)))
    sent = sent.withColumn("value", F.col("arrival_seq") * 0.5).where("pulse_id IS NULL OR pulse_id % 5 > 0 OR channel < 'r'").cache()
    feed(sent, tmp_path / "in", 3)
    ends, out, check = (str(tmp_path / k) for k in ("ends", "out", "check"))
    source = streams.with_end(stream(spark, tmp_path / "in", sent.schema), ends, channel="p")
    live = streams.stream_align_complete(source, list("pqr"), "1 hour")
    query = live.writeStream.trigger(availableNow=True).option("checkpointLocation", check).format("parquet").start(out)
    query.awaitTermination()
    assert 0 < query.lastProgress.stateOperators[0].numRowsTotal < 200  # of 2,000 pulses
    got = spark.read.parquet(out)
    assert got.count() == 1600 and got.where("p IS NULL OR q IS NULL OR r IS NULL").isEmpty()  # full ones do not wait
    assert streams.run_to_end(live, out, check, ends)
    cell = lambda c: F.max(F.when(F.col("channel") == c, F.col("value"))).alias(c)
    assert rows(spark.read.parquet(out), "pulse_id", *"pqr") == rows(sent.groupBy("pulse_id").agg(*map(cell, "pqr")))


def test_bounded_run_over_restarts(spark, messages, tmp_path):
    feed(messages, tmp_path / "in", 6)
    source = stream(spark, tmp_path / "in", messages.schema)
    place = [str(tmp_path / k) for k in ("out", "check")]
    good = F.col("n_bytes") % 2 == 0
    run = lambda n, timeout_s=None: streams.run_available(source, *place, timeout_s, n, good)
    assert not run(10, timeout_s=0.0) or spark.read.parquet(place[0]).count() >= 10
    for n in (30, 30, 90):
        assert run(n)
        landed = spark.read.parquet(place[0]).count()
        assert n <= landed < n + 50
        want = [r.arrival_seq for r in messages.where(good).orderBy("arrival_seq").limit(n).collect()]
        assert sorted(r.arrival_seq for r in streams.bounded_rows(spark, place[0], n).collect()) == want
    assert run(10_000) and spark.read.parquet(place[0]).count() == messages.where(good).count()


def test_archive(spark, tmp_path):
    samples = pulses(spark).withColumn("ts_sec", F.col("arrival_seq")).withColumn("ts_ns", F.lit(1).cast("bigint"))
    feed(samples, tmp_path / "in", 3)
    source = stream(spark, tmp_path / "in", samples.schema)
    streams.stream_archive(source, str(tmp_path / "out"), str(tmp_path / "check"), available_now=True).awaitTermination()
    got = read_channels(spark, str(tmp_path / "out"), ["p", "q"])
    assert rows(got, "channel", "pulse_id", "data", "timestamp") == rows(samples.where("channel in ('p', 'q')"), "channel", "pulse_id", "value", "ts_sec")
    with pytest.raises(ValueError):
        streams.stream_archive(source, "x", "y", layout="other")


def typed(data):
    """(seq, channel, type, value) as samples with a struct of values."""
    return [(("s" if c != "other" else "t"), c, seq, seq * 10, kind, [1], (v if kind == "int64" else None, v / 2 if kind == "float64" else None)) for seq, c, kind, v in data]


def test_versions_of_a_live_archive(spark, tmp_path):
    """Late and replaced columns over several batches and a restart, and a batch that is repeated."""
    schema = "stream_id string, channel string, arrival_seq bigint, pulse_id bigint, type string, shape array<int>, value struct<i: bigint, f: double>"
    batches = [
        [(0, "a", "int64", 1), (0, "b", "int64", 2), (1, "a", "int64", 3)],
        [(2, "a", "float64", 4), (2, "late", "int64", 5), (3, "a", "float64", 6), (4, "a", "int64", 7), (4, "other", "int64", 8)],
        [(5, "b", "int64", 9), (6, "a", "int64", 10), (7, "b", "float64", 11), (7, "a", "float64", 12)],
    ]
    path = str(tmp_path / "out")
    for batch in batches:
        spark.createDataFrame(typed(batch), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        live = stream(spark, tmp_path / "in", schema)
        versions.stream_versioned(live, path, str(tmp_path / "check"), available_now=True).awaitTermination()
    ledger = rows(versions.column_versions(spark, path), "channel", "version", "type", "first")
    assert ledger == sorted(
        [("a", 0, "int64", 0), ("a", 1, "float64", 2), ("a", 2, "int64", 4), ("a", 3, "float64", 7), ("b", 0, "int64", 0), ("b", 1, "float64", 7), ("late", 0, "int64", 2), ("other", 0, "int64", 4)],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    whole = versions.read_versions(spark, path)
    assert whole.columns == ["stream_id", "arrival_seq", "pulse_id", "a(1)", "a(2)", "a(3)", "a", "b(1)", "b", "late", "other"]
    types = dict(whole.dtypes)
    assert (types["a(1)"], types["a(2)"], types["a"], types["b"]) == ("bigint", "double", "double", "double")
    want = {}
    where = {"a": lambda seq: "a(1)" if seq < 2 else "a(2)" if seq < 4 else "a(3)" if seq < 7 else "a", "b": lambda seq: "b(1)" if seq < 7 else "b"}
    for seq, c, kind, v in [r for b in batches for r in b]:
        key = ("t" if c == "other" else "s", seq)
        want.setdefault(key, {})[where.get(c, lambda _: c)(seq)] = v if kind == "int64" else v / 2
    got = {(r.stream_id, r.arrival_seq): {k: v for k, v in r.asDict().items() if v is not None and k not in ("stream_id", "arrival_seq", "pulse_id")} for r in whole.collect()}
    assert got == want
    # the archive of the batch operator has the same columns
    from pulsekit.sources.archive import replacements, versioned_columns

    one = spark.createDataFrame(typed([r for b in batches for r in b if r[1] != "other"]), schema)
    plain = versioned_columns(one.withColumn("value", F.coalesce(F.col("value.i").cast("double"), F.col("value.f"))), replaced=replacements(one))
    assert set(plain.columns) == set(whole.columns) - {"other"}


def test_too_many_versions(spark, tmp_path):
    schema = "stream_id string, channel string, arrival_seq bigint, pulse_id bigint, type string, shape array<int>, value struct<i: bigint, f: double>"
    flips = typed([(i, "a", ["int64", "float64"][i % 2], i) for i in range(5)])
    spark.createDataFrame(flips, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    live = stream(spark, tmp_path / "in", schema)
    with pytest.raises(Exception, match="replaced more than 3 times"):
        versions.stream_versioned(live, str(tmp_path / "out"), str(tmp_path / "check"), available_now=True, max_versions=3).awaitTermination()
