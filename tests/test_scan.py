"""Bucketed scans give what a plain loop over each stream gives, whatever the bucket size."""

import random
from collections import defaultdict

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from pulsekit.operators.catalog import completeness
from pulsekit.operators.continuity import classify_pulses, continuity_stats, gap_report, idle_gaps
from pulsekit.operators.epochs import format_changes, schema_epochs, tail_rows, trailing
from pulsekit.operators.rates import rates
from pulsekit.operators.scan import OrderedScan, depth_borders
from pulsekit.operators.select import every_nth, take_messages
from pulsekit.sources.frames import assign_pulse_ids

BUCKETS = [3, 16, 1_000_000]


def random_messages(seed, n=240):
    """(stream_id, arrival_seq, pulse_id, header_hash, explicit, micros): gaps in the order, one busy stream."""
    rng = random.Random(seed)
    out, pulse = [], defaultdict(int)
    seq = 0
    for _ in range(n):
        seq += rng.choice([1, 1, 1, 2, 40])
        stream = rng.choice("aaaabc")
        pulse[stream] += rng.choice([-3, 0, 1, 1, 1, 2, 5])
        pulse[stream] = max(pulse[stream], 0)
        explicit = rng.randrange(1000) if rng.random() < 0.1 else None
        out.append((stream, seq, pulse[stream], rng.choice(["x", "x", "x", "y"]), explicit, seq * 1000 + rng.randrange(900)))
    return out


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    raw = random_messages(request.param)
    schema = "stream_id string, arrival_seq bigint, pulse_id bigint, header_hash string, explicit bigint, us bigint"
    df = spark.createDataFrame(raw, schema).withColumn("recv_ts", F.timestamp_micros("us")).withColumn("n_bytes", F.col("us") % 97)
    streams = defaultdict(list)
    for r in raw:
        streams[r[0]].append(r)
    return df.repartition(5).cache(), streams


@pytest.mark.parametrize("bucket", BUCKETS)
def test_classification(data, bucket):
    df, streams = data
    scan = OrderedScan(bucket_rows=bucket)
    expected, totals = [], []
    for stream, messages in streams.items():
        high, missed, twice, back = 0, 0, 0, 0
        for _, seq, p, *_ in messages:
            if not high:
                high, outcome = p, (0, 0, 0)
            elif p > high:
                outcome = (p - high - 1, 0, 0)
                high = p
            else:
                outcome = (0, int(p == high), int(p < high))
            expected.append((stream, seq, *outcome))
            missed, twice, back = missed + outcome[0], twice + outcome[1], back + outcome[2]
        totals.append((stream, len(messages), missed, twice, back))
    got = rows(classify_pulses(df, scan), "stream_id", "arrival_seq", "missed", "duplicated", "reverted")
    assert got == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(continuity_stats(df, scan)) == sorted(totals, key=lambda r: str(r[0]))
    report = gap_report(df, scan)
    ids = gap_report(df, scan, ids=True)
    assert report.agg(F.sum("n_missing")).first()[0] == ids.count() == sum(t[2] for t in totals)
    assert ids.where("missing_id < expected OR missing_id >= received").count() == 0


@pytest.mark.parametrize("bucket", BUCKETS)
def test_index_and_running_sums(data, bucket):
    df, streams = data
    scan = OrderedScan(bucket_rows=bucket)
    expected = []
    for stream, messages in streams.items():
        total = 0
        for i, r in enumerate(messages):
            total += r[5] % 97
            expected.append((stream, r[1], i, total))
    got = {tuple(r) for r in scan.index(df, "idx", {"total": "n_bytes"}).select("stream_id", "arrival_seq", "idx", "total").collect()}
    assert got == set(expected)
    assert {r[1] for r in rows(every_nth(df, 4, scan), "stream_id", "arrival_seq")} == {e[1] for e in expected if e[2] % 4 == 0}
    assert every_nth(df, 0, scan).count() == 0


@pytest.mark.parametrize("bucket", BUCKETS)
def test_epochs(data, bucket):
    df, streams = data
    scan = OrderedScan(bucket_rows=bucket)
    epochs, tails = set(), set()
    for stream, messages in streams.items():
        epoch, before, tail = 0, None, []
        for r in messages:
            changed = r[3] != before
            if changed:
                tail = []
            epoch, before = epoch + changed, r[3]
            tail = (tail + [(stream, r[1])])[-5:]
            epochs.add((stream, r[1], changed, epoch))
        tails |= set(tail)
    columns = ["stream_id", "arrival_seq", "format_changed", "epoch"]
    assert {tuple(r) for r in schema_epochs(df, scan).select(*columns).collect()} == epochs
    assert {tuple(r) for r in format_changes(df, scan).select(*columns[:3]).collect()} == {e[:3] for e in epochs}
    assert {tuple(r) for r in tail_rows(df, 5, scan).select(*columns[:2]).collect()} == tails


def test_messages_without_channels_do_not_change_the_format(spark):
    df = spark.createDataFrame(
        [("s", 0, "x", 2), ("s", 1, "y", 0), ("s", 2, "y", 2), ("s", 3, "z", 1)],
        "stream_id string, arrival_seq bigint, header_hash string, n_channels int",
    )
    for bucket in BUCKETS:
        got = rows(schema_epochs(df, OrderedScan(bucket_rows=bucket)), "arrival_seq", "format_changed", "epoch")
        assert got == [(0, True, 1), (1, False, 1), (2, False, 1), (3, True, 2)]


@pytest.mark.parametrize("bucket", BUCKETS)
@pytest.mark.parametrize("n", [1, 10])
def test_trailing(data, bucket, n):
    df, streams = data
    expected = set()
    for stream, messages in streams.items():
        values = [r[4] for r in messages]
        for i, r in enumerate(messages):
            expected.add((stream, r[1], tuple(values[max(0, i - n + 1) : i + 1])))
    got = trailing(df, "explicit", n, OrderedScan(bucket_rows=bucket))
    assert {(r.stream_id, r.arrival_seq, tuple(r.trail)) for r in got.collect()} == expected


@pytest.mark.parametrize("bucket", BUCKETS)
def test_pulse_numbering(data, bucket):
    df, streams = data
    expected = set()
    for stream, messages in streams.items():
        current = 7
        for r in messages:
            current = r[4] if r[4] is not None else current
            expected.add((stream, r[1], current))
            current += 1
    got = assign_pulse_ids(df, 7, "explicit", OrderedScan(bucket_rows=bucket))
    assert {tuple(r) for r in got.select("stream_id", "arrival_seq", "pulse_id").collect()} == expected


@pytest.mark.parametrize("bucket", BUCKETS)
def test_idle_gaps_and_rates(data, bucket):
    df, streams = data
    scan = OrderedScan(bucket_rows=bucket)
    gaps, shown = set(), {}
    for stream, messages in streams.items():
        for a, b in zip(messages, messages[1:]):
            if b[5] - a[5] > 20_000:
                gaps.add((stream, b[1], b[5] - a[5]))
        total, totals = 0, []
        for r in messages:
            total += r[5] % 97
            totals.append(total)
        for i in range(0, len(messages), 10):
            rate = None if i == 0 else (10 / ((messages[i][5] - messages[i - 10][5]) / 1e6), totals[i] - totals[i - 10])
            shown[(stream, messages[i][1])] = rate
    assert {tuple(r) for r in idle_gaps(df, 20, scan).select("stream_id", "arrival_seq", "idle_us").collect()} == gaps
    assert idle_gaps(df, -1, scan).count() == 0
    got = rates(df, 10, scan).collect()
    assert {(r.stream_id, r.arrival_seq) for r in got} == set(shown)
    for r in got:
        expected = shown[(r.stream_id, r.arrival_seq)]
        assert (r.message_rate is None) == (expected is None)
        if expected:
            assert r.message_rate == pytest.approx(expected[0])
            assert r.receive_mbps == pytest.approx(expected[0] / 10 * expected[1] * 8 / 1024 / 1024)


@pytest.mark.parametrize("bucket", BUCKETS)
def test_completeness(spark, bucket):
    rng = random.Random(5)
    samples, expected = [], set()
    for stream in "abcd":
        chance = {"a": 0.6, "b": 0.4, "c": 0.2, "d": 0.0}[stream]
        latest, done = {}, None
        for i, seq in enumerate(range(rng.randrange(5), 200, 3)):
            for ordinal, channel in enumerate(["p", "q", "r", "other", "p"]):
                value = rng.random() if rng.random() < chance else None
                samples.append((stream, seq, ordinal, channel, value, seq * 1000))
                latest[channel] = value
            if done is None and all(latest[c] is not None for c in "pqr"):
                first = min(s[5] for s in samples if s[0] == stream)
                done = (stream, seq, i + 1, seq * 1000 - first)
        expected.add(done or (stream, None, None, None))
    df = spark.createDataFrame(samples, "stream_id string, arrival_seq bigint, ordinal int, channel string, value double, us bigint")
    df = df.withColumn("recv_ts", F.timestamp_micros("us"))
    got = completeness(df, ["p", "q", "r"], scan=OrderedScan(bucket_rows=bucket))
    assert {tuple(r) for r in got.collect()} == expected


@pytest.mark.parametrize("bucket", [1, 7, 10**6])
def test_take_across_buckets_and_streams(data, bucket):
    df, streams = data
    everything = sorted(r[1] for messages in streams.values() for r in messages)
    for n in (10, 100, 10**6):
        assert sorted(r[0] for r in rows(take_messages(df, n, bucket_rows=bucket), "arrival_seq")) == everything[:n]
    assert take_messages(df, 0).count() == take_messages(df, None).count() == len(everything)


@pytest.mark.parametrize("bucket", [1, 2, 3, 100])
def test_nulls_do_not_depend_on_the_bucket(spark, bucket):
    scan = OrderedScan(bucket_rows=bucket)
    data = [("s", i, h, t, p) for i, (h, t, p) in enumerate(zip("AAA.A", (1000, 2000, 3000, None, 6600), (1, 2, None, 3, 9)))]
    df = spark.createDataFrame([(s, i, None if h == "." else h, t, p) for s, i, h, t, p in data], "stream_id string, arrival_seq bigint, header_hash string, s bigint, pulse_id bigint")
    df = df.withColumn("recv_ts", F.timestamp_seconds("s"))
    assert [r.format_changed for r in format_changes(df, scan).orderBy("arrival_seq").collect()] == [True, False, False, True, True]
    assert [r.epoch for r in schema_epochs(df, scan).orderBy("arrival_seq").collect()] == [1, 1, 1, 2, 3]
    assert [r.idle_us for r in idle_gaps(df, 1_500_000, scan).collect()] == []
    kinds = classify_pulses(df, scan).orderBy("arrival_seq").collect()
    assert [(r.kind, r.missed) for r in kinds] == [("first", 0), ("ok", 0), ("no_pulse", 0), ("ok", 0), ("missed", 5)]


def test_sparse_order_values_and_long_gaps(spark):
    df = spark.createDataFrame([("s", i * 10**9, p) for i, p in enumerate((1, 10**18, 10**18 + 3))], "stream_id string, arrival_seq bigint, pulse_id bigint")
    assert [tuple(r) for r in continuity_stats(df).collect()] == [("s", 3, 10**18 - 2 + 2, 0, 0)]
    assert gap_report(df).count() == 2
    assert gap_report(df.where("arrival_seq > 0"), ids=True).select("missing_id").orderBy("missing_id").collect() == [(10**18 + 1,), (10**18 + 2,)]


def test_last_rows_in_one_pass(data):
    df, streams = data
    for n in (1, 3, 2000):
        got = OrderedScan(bucket_rows=5).last(df, n, "_rank")
        want = sorted(seq for messages in streams.values() for seq in sorted(r[1] for r in messages)[-n:])
        assert sorted(r[0] for r in rows(got, "arrival_seq")) == want


def test_take_messages_with_a_map_column(spark):
    df = spark.createDataFrame([(i // 2, {"k": i}) for i in range(10)], "arrival_seq long, m map<string,int>")
    assert take_messages(df, 5).count() == 5


SPARSE = [0, 1, 2, 10**9, 10**9 + 1] + [5 * 10**17 + 10**9 * i for i in range(300)] + [2**62] * 3


@pytest.mark.parametrize("rows_per_bucket", [1, 7, 50, 10**6])
def test_borders_are_of_equal_depth(spark, rows_per_bucket):
    df = spark.createDataFrame([(v,) for v in SPARSE] + [(None,)], "at long")
    borders = depth_borders(df, ["at"], rows_per_bucket, quantiles=8)[0]
    got = df.select("at", borders.bucket(F.col("at")).alias("b")).orderBy("at").collect()
    assert got[0].b is None
    known = [r.b for r in got[1:]]
    assert known == sorted(known)
    for r in got[1:]:
        assert (r.at == got[1].at) or r.b is not None
    if rows_per_bucket == 50:
        depth = defaultdict(int)
        for b in known:
            depth[b] += 1
        assert max(depth.values()) <= 80 and len(depth) >= 5
    out = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "at long").select(borders.bucket(F.col("at")).alias("b"))
    low, high, _ = (r.b for r in out.collect())
    assert low <= min(known) and high >= max(known)
    none = depth_borders(df.where("false"), ["at"])[0]
    assert df.where("at = 1").select(none.bucket(F.col("at"))).first()[0] == 0


def test_sparse_order_values(spark):
    """Receive times in nanoseconds as the order: buckets hold many rows each, and scans give what they gave."""
    raw = [(s, 10**18 + 10**9 * i + (s == "b"), (i * 7) % 50) for i in range(200) for s in "ab"]
    df = spark.createDataFrame(raw, "stream_id string, arrival_seq long, pulse_id long")
    scan = OrderedScan(bucket_rows=20).fitted(df)
    assert 10 <= scan.bucketed(df).select("_bucket").distinct().count() <= 80
    assert OrderedScan(bucket_rows=20).bucketed(df).select("_bucket").distinct().count() == 200
    whole = OrderedScan(bucket_rows=10**18)
    for run in (lambda s: continuity_stats(df, s), lambda s: every_nth(df, 3, s)):
        assert rows(run(scan), *run(scan).columns) == rows(run(whole), *run(scan).columns)
    want = sorted(r[1] for r in raw)[:33]
    assert sorted(r[1] for r in rows(take_messages(df, 33, borders=scan.borders))) == want


@pytest.mark.parametrize("n", [1, 2, 40, 250])
def test_trailing_far_back(spark, n):
    """Sparse and full buckets, windows that span none, some or very many of them."""
    rng = random.Random(n)
    seqs = sorted(rng.sample(range(10**6), 60)) + list(range(10**6, 10**6 + 150))
    raw = [(rng.choice("aab"), seq, seq * 3 % 101) for seq in seqs]
    df = spark.createDataFrame(raw, "stream_id string, arrival_seq long, v long")
    want = {}
    for stream in "ab":
        values = [(seq, v) for s, seq, v in raw if s == stream]
        want |= {seq: [v for _, v in values[max(0, i + 1 - n) : i + 1]] for i, (seq, _) in enumerate(values)}
    for bucket in (10, 5000):
        got = trailing(df, "v", n, OrderedScan(bucket_rows=bucket))
        assert {r.arrival_seq: r.trail for r in got.collect()} == want


def test_halo_of_a_hundred_thousand_rows(spark):
    """Copies are made for the buckets that are reached: n of each bucket, not n of each of n buckets."""
    df = spark.range(0, 400_000, 1, 8).selectExpr("'s' AS stream_id", "id AS arrival_seq", "id AS v")
    rows_ = OrderedScan(bucket_rows=50_000).with_halo(df, ["v"], 100_000)
    found = {r["_bucket"]: (r.n, r.low) for r in rows_.where("_halo").groupBy("_bucket").agg(F.count("*").alias("n"), F.min("v").alias("low")).collect()}
    assert found == {b: (min(2, b) * 50_000, max(0, b - 2) * 50_000) for b in range(1, 8)}


def test_epochs_scan_and_shuffle_the_messages_once(spark, tmp_path):
    spark.range(200).selectExpr("'s' AS stream_id", "id AS arrival_seq", "CAST(id div 30 AS STRING) AS header_hash", "id AS more").write.parquet(str(tmp_path / "m"))
    df = schema_epochs(spark.read.parquet(str(tmp_path / "m")), OrderedScan(bucket_rows=25))
    assert {r.epoch for r in df.collect()} == set(range(1, 8))
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 1
    assert plan.count("Exchange hashpartitioning(stream_id") - plan.count("ReusedExchange") <= 2


def test_a_null_stream_is_a_stream(spark):
    df = spark.createDataFrame([(None, i, i) for i in range(20)], "stream_id string, arrival_seq long, pulse_id long")
    got = sorted((r.arrival_seq, r.idx) for r in every_nth(df, 1, OrderedScan(bucket_rows=3)).collect())
    assert got == [(i, i) for i in range(20)]
