"""Selection, alignment, catalogue, retention and archives on small fixtures."""

import math
import random
from datetime import datetime, timedelta

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from pulsekit.functions import names, timestamps
from pulsekit.operators import align, catalog, joins, rates, retention, select
from pulsekit.sources import archive


# ---- selection ----


def test_first_match(spark):
    df = spark.createDataFrame([(1, 12.0, 0), (2, 4.0, 1), (3, 10.0, 2), (4, 9.5, 3), (5, None, 4)], "one int, two double, arrival_seq bigint")
    assert rows(select.first_match(df, F.col("two") <= 4), "one") == [(2,)]
    assert rows(select.first_match(df, lambda r: r["two"] <= 4), "one") == [(2,)]
    assert rows(select.filter_messages(df, F.col("two") > 0), "one") == rows(select.filter_messages(df, lambda r: r["two"] > 0), "one") == [(1,), (2,), (3,), (4,)]
    assert select.first_match(df, F.col("two") > 99).count() == 0


def test_rules_are_checked_up_front():
    assert select.channel_rules(["a", {"name": "b", "modulo": "10", "offset": 1.0, "extra": 5}]) == [
        select.ChannelRule("a"), select.ChannelRule("b", 10, 1),
    ]
    for bad in ({"name": "a", "modulo": "x"}, {"name": "a", "modulo": 2.5}, {"name": "a", "modulo": 0}, {"name": "a", "offset": None}):
        with pytest.raises(ValueError):
            select.channel_rules([bad])


def test_decimation(spark):
    df = spark.createDataFrame([(p, c) for p in range(40) for c in "abc"], "pulse_id bigint, channel string")
    specs = ["a", {"name": "b", "modulo": 10}, {"name": "b", "modulo": 10, "offset": 13}, {"name": "b", "modulo": 20}]
    got = rows(select.decimate(df, specs))
    assert got == sorted([(p, "a") for p in range(40)] + [(p, "b") for p in range(40) if p % 10 in (0, 3)], key=lambda r: tuple((False, str(v)) for v in r))
    table = spark.createDataFrame([("a", None, None), ("b", 10, None), ("b", 10, 13), ("b", 20, 0)], "channel string, modulo int, offset int")
    assert rows(select.decimate(df, table)) == got
    wide = df.groupBy("pulse_id").pivot("channel", ["a", "b", "c"]).agg(F.max("pulse_id"))
    sparse = select.decimate(wide, specs[1:])
    assert sparse.columns == ["pulse_id", "b"] and rows(sparse) == [(p, p) for p in sorted((0, 3, 10, 13, 20, 23, 30, 33), key=str)]


def test_projection_keeps_message_order(spark):
    wide = spark.createDataFrame([(1, 2, 3, 4)], "pulse_id bigint, c int, b int, a int")
    assert select.select_channels(wide, ["a", "c"]).columns == ["pulse_id", "c", "a"]
    assert select.select_channels(wide, None).columns == wide.columns
    long = spark.createDataFrame([("a",), ("b",), ("b",)], "channel string")
    assert select.select_channels(long, spark.createDataFrame([("b",), ("b",)], "channel string")).count() == 2


def test_rendering(spark):
    wide = spark.createDataFrame([(5, 1, 2, "x", None, [1, 2], 7)], "pulse_id bigint, global_sec bigint, global_ns bigint, a string, b int, c array<int>, global_timestamp int")
    shown = select.render_rows(wide)
    assert shown.columns == ["pulse_id", "global_timestamp", "global_timestamp_offset", "a", "b", "c"]
    assert tuple(shown.first()) == ("5", "7", "2", "x", "None", "[1,2]")
    assert select.render_rows(wide, ["b"]).columns == ["pulse_id", "global_timestamp", "global_timestamp_offset", "b"]


# ---- alignment ----


def test_alignment_takes_the_last_arrival_and_the_earliest_time(spark):
    df = spark.createDataFrame(
        [(1, 0, "a", 1.0, 10, 999999999), (1, 5, "a", 2.0, 11, 0), (1, 3, "b", None, 10, 5), (2, 6, "c", 1.0, 12, 0), (1, 4, "b", 4.0, 9, 7), (1, 9, "b", None, 20, 0)],
        "pulse_id bigint, arrival_seq bigint, channel string, value double, ts_sec bigint, ts_ns bigint",
    )
    assert rows(align.align_pulses(df, ["b", "a"])) == [(1, 9, 7, None, 2.0)]
    assert rows(align.align_pulses(df, ["a", "c"]).select("pulse_id", "a", "c")) == [(1, 2.0, None), (2, None, 1.0)]


def test_merge_is_one_row_per_pulse(spark):
    schema = "pulse_id bigint, arrival_seq bigint, v int"
    a = spark.createDataFrame([(0, i, i) for i in range(50)] + [(1, 60, 1), (None, 70, 7)], schema)
    b = spark.createDataFrame([(0, i, -i) for i in range(50)] + [(2, 60, 2)], schema)
    assert rows(align.merge_streams(a, b), "pulse_id", "v_a", "v_b") == [(0, 49, -49), (1, 1, None), (2, None, 2), (None, 7, None)]
    assert align.merge_streams(a, b, "inner").count() == 1 and align.merge_streams(a, b, "left").count() == 3
    with pytest.raises(ValueError):
        align.merge_streams(a, b, "cross")


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_lookup_join_either_way(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    big = spark.range(500).withColumn("key", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7))
    small = spark.createDataFrame([(0, "zero"), (1, "one"), (1, "uno"), (9, "none")], "key bigint, name string")
    expected = rows(big.join(small, "key", "left"))
    got = rows(joins.lookup_join(big, small, ["key"]))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == expected


def test_duplicate_channels(spark):
    df = spark.createDataFrame([("s", 1, "a", 0, 1.0), ("s", 1, "a", 2, None), ("s", 1, "b", 1, 3.0)], "stream_id string, arrival_seq bigint, channel string, ordinal int, value double")
    assert rows(align.collapse_duplicates(df), "channel", "ordinal", "value") == [("a", 2, None), ("b", 1, 3.0)]


def test_streams_with_different_columns_unite(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "x int, z int")
    assert rows(align.union_streams(a, b)) == [(1, 2, None), (3, None, 4)]


# ---- catalogue ----


def test_pattern_anchoring(spark):
    df = spark.createDataFrame([(n,) for n in ("xxa", "bxx", "xxb", "c")], "name string")
    assert rows(catalog.available_channels(df, "a|b")) == [("bxx",), ("xxa",)]
    assert catalog.available_channels(df).count() == 4


def test_catalogue_from_listing_and_status(spark):
    listing = spark.sql(
        "SELECT 'x' AS backend, array(named_struct('name', 'a', 'type', 'int32', 'modulo', 1), named_struct('name', 'b', 'type', NULL, 'modulo', 2)) AS channels "
        "UNION ALL SELECT 'y', array(named_struct('name', 'a', 'type', 'int32', 'modulo', 5))"
    )
    flat = catalog.flatten_catalog(listing)
    assert rows(catalog.channel_names(flat)) == [("a",), ("a",), ("b",)]
    now = datetime(2024, 1, 2)
    state = spark.createDataFrame([("a", True, False, True, now - timedelta(hours=1)), ("b", True, True, True, None)], "channel string, configured boolean, connected boolean, recording boolean, last_event timestamp")
    status = catalog.channel_status(["b", "a", "zz", "a"], state, now).collect()
    assert [r.channel for r in status] == ["a", "b", "zz"]
    assert [r.time_since for r in status] == [timedelta(hours=1), None, None]
    assert [r.connected for r in catalog.channel_status("a", state, now).collect()] == [False]
    checked = catalog.verify_channels(["a", {"name": "b", "modulo": 3, "offset": 1}, "zz"], flat, state)
    assert rows(checked) == [("a", True, False, 1, 1, 1, 0), ("b", True, True, 3, 2, 6, 1), ("zz", False, False, 1, None, 1, 0)]
    kept = catalog.verify_channels([{"name": "b", "modulo": 3}], flat, state, verify=False)
    assert kept.first().effective_modulo == 3
    with pytest.raises(ValueError):
        catalog.verify_channels(["a"], flat, state, "other")


def test_least_common_multiple(spark):
    df = spark.range(3600).selectExpr("id div 60 + 1 AS a", "id % 60 + 1 AS b")
    assert all(r.m == math.lcm(r.a, r.b) for r in df.select("a", "b", catalog.lcm(F.col("a"), F.col("b")).alias("m")).collect())


def test_missing_and_distinct(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("a", None)], "channel string, value double")
    assert rows(catalog.missing_channels(["a", "b", "c"], df)) == [("b",), ("c",)]
    assert catalog.distinct_channels(["b", "a", "b"]) == ["a", "b"] and catalog.distinct_channels("ab") == ["ab"]
    assert [r[0] for r in catalog.distinct_channels(df).collect()] == ["a", "b"]


def test_latency_of_single_message_runs(spark):
    df = spark.createDataFrame([(1, 0, 10.0), (1, 1, 2.0), (1, 2, 4.0), (2, 5, 20.0)], "run_id int, arrival_seq bigint, latency double")
    assert tuple(rates.latency_summary(df).first()) == (2, 15.0, 3.0, 1 / 3)


# ---- names and times ----


def test_qualified_names(spark):
    assert names.default_backend("http://h:1/main") == names.default_backend(" http://h:1/main/ ") == "main"
    df = spark.createDataFrame([("one",), ("other/two",), ("x/y/z",)], "n string")
    backend, channel = names.split_channel(F.col("n"), "main")
    assert rows(df.select(backend, channel)) == [("main", "one"), ("other", "two"), ("x", "y")]


def test_time_pairs(spark):
    df = spark.createDataFrame([(-1, 5), (1700000000, 123456789)], "s bigint, n bigint")
    joined = df.withColumn("t", timestamps.join_ts(F.col("s"), F.col("n")))
    sec, ns = timestamps.split_ts(F.col("t"))
    assert rows(joined.select(sec, ns)) == [(-1, 0), (1700000000, 123456000)]
    sec, ns = timestamps.split_seconds(F.lit(12.25))
    assert rows(spark.range(1).select(sec, ns)) == [(12, 250000000)]


# ---- retention ----


def test_rules_are_validated():
    day = timedelta(days=1)
    assert retention.ttl_rule(3, ["a", "x/b", "x/b/c"], 1, 5, day, "main") == [
        (3, "main", "a", 1, 5, None, None, 86400), (3, "x", "b", 1, 5, None, None, 86400), (3, "x", "b", 1, 5, None, None, 86400),
    ]
    at = datetime(2024, 1, 1)
    assert retention.ttl_rule(0, ["a"], at, at, timedelta(seconds=1.9), "m")[0][3:] == (None, None, at, at, 1)
    for start, end, ttl in ((1, at, day), (1.5, 2, day), (1, 2, 5)):
        with pytest.raises(ValueError):
            retention.ttl_rule(0, ["a"], start, end, ttl, "m")


def test_retention_against_brute_force(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    samples = [("s", i, 0, rng.choice("xy"), rng.choice("aaab"), rng.randrange(3000), start + timedelta(seconds=rng.randrange(10**6))) for i in range(600)]
    updates = []
    for _ in range(60):
        names_ = rng.sample(["a", "x/a", "y/b", "y/a"], 2)
        ttl = timedelta(seconds=rng.randrange(1000))
        if rng.random() < 0.5:
            lo = rng.randrange(3000)
            updates.append((names_, lo, lo + rng.choice([0, 1, 7, 300, 5000]), ttl))
        else:
            lo = start + timedelta(seconds=rng.randrange(10**6))
            updates.append((names_, lo, lo + timedelta(seconds=rng.choice([0, 100, 50_000])), ttl))
    rules = retention.retention_rules(spark, updates, "x")
    df = spark.createDataFrame(samples, "stream_id string, arrival_seq bigint, ordinal int, backend string, channel string, pulse_id bigint, ts timestamp_ntz")
    expected = {}
    for _, seq, _, backend, channel, pulse, ts in samples:
        expected[seq] = 77
        for names_, lo, hi, ttl in updates:
            named = any((n if "/" in n else f"x/{n}") == f"{backend}/{channel}" for n in names_)
            if named and lo <= (pulse if isinstance(lo, int) else ts) <= hi:
                expected[seq] = int(ttl.total_seconds())
    got = retention.apply_retention(df, rules, 77)
    assert {r.arrival_seq: r.ttl_s for r in got.collect()} == expected
    assert got.where("expires_at <> ts + make_dt_interval(0, 0, 0, ttl_s)").count() == 0
    now = start + timedelta(seconds=500_000)
    kept = retention.purge_expired(df, rules, F.lit(now).cast("timestamp_ntz"), 77)
    assert {r.arrival_seq for r in kept.collect()} == {s[1] for s in samples if s[6] + timedelta(seconds=expected[s[1]]) > now}


@pytest.mark.parametrize("block_rows", [1, 9])
def test_retention_over_many_blocks(spark, block_rows):
    """Segments that start blocks before a sample, gaps, a busy channel, samples far outside, both kinds of rules."""
    rng = random.Random(block_rows)
    start = datetime(2024, 1, 1)
    raw = [(i, "x", rng.choice("aab"), lo, lo + rng.choice([0, 40, 900]), None, None, i) for i, lo in enumerate(rng.randrange(2000) for _ in range(25))]
    at = lambda s: start + timedelta(seconds=s)
    raw += [(100 + i, "x", "a", None, None, at(lo), at(lo + rng.choice([0, 500])), 100 + i) for i, lo in enumerate(rng.randrange(5000) for _ in range(15))]
    rules = spark.createDataFrame(raw, retention.RULES_SCHEMA)
    samples = [("x", rng.choice("aaab"), rng.choice([rng.randrange(2500), 10**15, None]), at(rng.randrange(6000))) for _ in range(400)]
    df = spark.createDataFrame(samples, "backend string, channel string, pulse_id bigint, ts timestamp_ntz")

    def ttl(channel, pulse, ts):
        mine = [r for r in raw if r[2] == channel and (r[3] is None or pulse is not None and r[3] <= pulse <= r[4]) and (r[5] is None or r[5] <= ts <= r[6])]
        return max(mine)[7] if mine else None

    got = retention.apply_retention(df, rules, block_rows=block_rows)
    want = sorted((str(p), str(t), str(ttl(c, p, t))) for _, c, p, t in samples)
    assert sorted((str(r.pulse_id), str(r.ts), str(r.ttl_s)) for r in got.collect()) == want


def test_retention_shuffles_samples_once_a_kind(spark):
    df = spark.range(100).selectExpr("'x' AS backend", "'a' AS channel", "id AS pulse_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id AS payload")
    day = timedelta(days=1)
    rules = retention.retention_rules(spark, [(["a"], 0, 9, day), (["a"], 5, 2**40, day), (["a"], datetime(2024, 1, 1), datetime(2024, 2, 1), day)], "x")
    plan = retention.apply_retention(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_retention_with_nulls_repeats_and_ties(spark):
    rules = spark.createDataFrame(
        [(1, "x", "a", 0, 9, None, None, 5), (1, "x", "a", 5, 9, None, None, 50), (3, "x", "a", 7, 7, None, None, 1), (9, "x", None, 0, 9, None, None, 99)],
        retention.RULES_SCHEMA,
    )
    data = [(None, "x", "a", p) for p in (0, 5, 5, 7, 10)] + [("s", "x", None, 5), ("s", None, "a", 5), ("s", "x", "a", None)]
    df = spark.createDataFrame(data, "stream_id string, backend string, channel string, pulse_id bigint").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    got = rows(retention.apply_retention(df, rules), "pulse_id", "channel", "backend", "ttl_s")
    # of rules with one number the longer ttl counts
    expected = [(0, "a", "x", 5), (5, "a", "x", 50), (5, "a", "x", 50), (7, "a", "x", 1), (10, "a", "x", None), (5, None, "x", None), (5, "a", None, None), (None, "a", "x", None)]
    assert sorted(got, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_retention_of_crowded_ranges(spark, seed):
    rng = random.Random(seed)
    spread = [40, 10**6, 2**62][seed]
    raw = [(i, lo, min(lo + rng.choice([0, 3, spread // 5]), 2**63 - 1)) for i in range(150) for lo in [rng.randrange(-spread, spread)]]
    rules = spark.createDataFrame([(i, "x", "a", lo, hi, None, None, i) for i, lo, hi in raw], retention.RULES_SCHEMA)
    at = sorted({p + d for _, lo, hi in raw for p in (lo, hi) for d in (-1, 0, 1) if -(2**63) <= p + d < 2**63})
    df = spark.createDataFrame([("x", "a", p) for p in at], "backend string, channel string, pulse_id bigint").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    got = {r.pulse_id: r.ttl_s for r in retention.apply_retention(df, rules).collect()}
    assert got == {p: max((i for i, lo, hi in raw if lo <= p <= hi), default=None) for p in at}


def test_retention_without_rules_keeps_for_good(spark):
    df = spark.createDataFrame([("s", 1, 0, "x", "a", 1, 5, 0)], "stream_id string, arrival_seq bigint, ordinal int, backend string, channel string, pulse_id bigint, ts_sec bigint, ts_ns bigint")
    none = spark.createDataFrame([], retention.RULES_SCHEMA)
    assert rows(retention.purge_expired(df, none, datetime(2030, 1, 1)), "ttl_s", "expires_at") == [(None, None)]


# ---- archives ----


def test_per_channel_and_compact_archives(spark, tmp_path):
    data = [("s", seq, seq, c, float(seq), 1, 2) for seq in range(5) for c in ("a:b", "c")]
    df = spark.createDataFrame(data, "stream_id string, arrival_seq bigint, pulse_id bigint, channel string, value double, ts_sec bigint, ts_ns bigint")
    archive.write_channels(df, str(tmp_path / "long"))
    back = archive.read_channels(spark, str(tmp_path / "long"), ["a:b"])
    assert set(back.columns) == {"channel", "data", "timestamp", "timestamp_offset", "pulse_id", "stream_id", "arrival_seq"}
    assert sorted(r.data for r in back.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert "PartitionFilters: [isnotnull(channel" in back._jdf.queryExecution().toString()
    archive.write_compact(align.align_pulses(df, ["a:b", "c"], ("stream_id", "pulse_id")), str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    assert wide.columns == ["pulse_id", "a:b", "c"] and wide.count() == 5


def test_purge_of_an_archive(spark, tmp_path):
    data = [("s", i, i, c, float(i), 1000 + i, 0) for i in range(20) for c in "ab"] + [("s", 99, 99, "a", None, None, None)]
    df = spark.createDataFrame(data, "stream_id string, arrival_seq bigint, pulse_id bigint, channel string, value double, ts_sec bigint, ts_ns bigint")
    archive.write_channels(df, str(tmp_path / "old"))
    rules = retention.retention_rules(spark, [(["a"], 0, 9, timedelta(seconds=5)), (["a", "x/b"], 5, 6, timedelta(days=9))], "main")
    archive.purge_channels(spark, str(tmp_path / "old"), str(tmp_path / "new"), rules, datetime(1970, 1, 1, 0, 16, 58), "main", 10)
    kept = archive.read_channels(spark, str(tmp_path / "new"))
    assert set(kept.columns) == set(archive.read_channels(spark, str(tmp_path / "old")).columns)
    # It is second 1018; a pulse i dates from second 1000 + i.
    expected = {("a", 99)} | {("a", i) for i in range(20) if i in (5, 6) or (i > 9)} | {("b", i) for i in range(20) if i > 8}
    assert {(r.channel, r.pulse_id) for r in kept.collect()} == expected


def stamps(path):
    """Each folder of an archive with the newest file in it."""
    return {d.name: max(f.stat().st_mtime_ns for f in d.iterdir()) for d in path.iterdir() if d.name.startswith("channel=")}


def test_purge_in_place_rewrites_what_it_must(spark, tmp_path):
    channels = ["a", "b:1", "c", "gone", None]
    data = [(i, c, float(i), 1000 + i, 0) for i in range(20) for c in channels] + [(99, "a", None, None, None)]
    df = spark.createDataFrame(data, "pulse_id bigint, channel string, value double, ts_sec bigint, ts_ns bigint")
    path = tmp_path / "archive"
    archive.write_channels(df, str(path))
    before = stamps(path)
    assert len(before) == 5
    rules = retention.retention_rules(spark, [(["a", "b:1"], 0, 9, timedelta(seconds=5)), (["gone"], 0, 99, timedelta(0))], "main")
    now = datetime(1970, 1, 1, 0, 16, 58)  # second 1018; a pulse i dates from second 1000 + i
    changed = archive.purge_archive(spark, str(path), rules, now, "main")
    assert sorted(changed) == ["a", "b:1", "gone"]
    after = stamps(path)
    assert {n for n in before if after.get(n) != before[n]} == {"channel=a", "channel=b%3A1", "channel=gone"}
    want = {(c, i) for c in channels for i in range(20) if c in ("c", None) or (c in ("a", "b:1") and i > 9) or (c == "gone" and i > 18)} | {("a", 99)}
    assert {(r.channel, r.pulse_id) for r in archive.read_channels(spark, str(path)).collect()} == want
    # nothing more to do
    assert archive.purge_archive(spark, str(path), rules, now, "main") == [] and stamps(path) == after
    # all of a channel expires, and those without a name by default
    later = datetime(1970, 1, 1, 1)
    assert sorted(archive.purge_archive(spark, str(path), rules, later, "main", 60), key=str) == sorted(["a", "b:1", "c", "gone", None], key=str)
    assert {(r.channel, r.pulse_id) for r in archive.read_channels(spark, str(path)).collect()} == {("a", 99)}


@pytest.mark.parametrize("broken", ["write", "swap"])
def test_an_interrupted_purge_is_completed(spark, tmp_path, monkeypatch, broken):
    data = [(i, c, float(i), 1000 + i, 0) for i in range(20) for c in "abc"]
    df = spark.createDataFrame(data, "pulse_id bigint, channel string, value double, ts_sec bigint, ts_ns bigint")
    path = str(tmp_path / "archive")
    archive.write_channels(df, path)
    none = spark.createDataFrame([], retention.RULES_SCHEMA)
    now = datetime(1970, 1, 1, 0, 16, 58)

    def fail(*args):
        if broken == "write" or args[1].endswith("channel=b"):
            raise OSError("lost")
        return rename(*args)

    rename, finish = archive.rename, archive.finish_purge
    with monkeypatch.context() as patch:
        if broken == "swap":
            patch.setattr(archive, "rename", fail)
        else:
            patch.setattr(archive, "_write_by_channel", fail)
        with pytest.raises(OSError):
            archive.purge_archive(spark, path, none, now, "main", 10)
    if broken == "write":
        assert archive.read_channels(spark, path).count() == 60
    finish(spark, path)
    kept = archive.read_channels(spark, path)
    want = {(c, i) for c in "abc" for i in range(20) if broken == "write" or i > 8}
    assert {(r.channel, r.pulse_id) for r in kept.collect()} == want
    archive.purge_archive(spark, path, none, now, "main", 10)
    assert {r.pulse_id for r in archive.read_channels(spark, path).collect()} == set(range(9, 20))


def versioned(spark, replaced_at):
    df = spark.range(100).selectExpr("'s' AS stream_id", "id AS arrival_seq", "'name' AS channel", "id AS value")
    replaced = spark.createDataFrame([("name", at) for at in replaced_at], "channel string, arrival_seq bigint")
    wide = archive.versioned_columns(df, replaced=replaced).orderBy("arrival_seq")
    return wide.columns[2:], [tuple(r)[2:] for r in wide.collect()]


def test_replaced_column(spark):
    columns, got = versioned(spark, [50])
    assert columns == ["name", "name(1)"]
    assert got == [(None, i) if i < 50 else (i, None) for i in range(100)]


def test_column_replaced_three_times(spark):
    columns, got = versioned(spark, [50, 50, 50])
    assert columns == ["name", "name(1)", "name(2)", "name(3)"]
    assert got == [(None, i, None, None) if i < 50 else (i, None, None, None) for i in range(100)]


def test_column_replaced_too_often(spark):
    assert versioned(spark, [1] * 99)[0][0] == "name"
    with pytest.raises(Exception, match="replaced more than 99 times"):
        versioned(spark, [1] * 100)


def test_versions_follow_definition_changes(spark):
    types = ["int32"] * 10 + ["float64"] * 10 + ["int32"] * 10
    value = "named_struct('i', CAST(id AS BIGINT), 'u', CAST(NULL AS DECIMAL(20,0)), 'f', CAST(id AS DOUBLE), 'ai', CAST(NULL AS ARRAY<BIGINT>))"
    df = spark.range(30).selectExpr("'s' AS stream_id", "id AS arrival_seq", "'v' AS channel", f"{value} AS value", "CASE WHEN id div 10 = 1 THEN 'float64' ELSE 'int32' END AS type", "array(1) AS shape")
    wide = archive.versioned_columns(df)
    assert dict(wide.dtypes)["v"] == dict(wide.dtypes)["v(1)"] == "int" and dict(wide.dtypes)["v(2)"] == "double"
    got = wide.orderBy("arrival_seq").select("v(1)", "v(2)", "v").collect()
    for i, r in enumerate(got):
        expected = [None, None, None]
        expected[i // 10] = i
        assert list(r) == expected and types[i]


def test_late_column(spark):
    early, late = spark.range(50).selectExpr("id", "id AS a"), spark.range(50, 100).selectExpr("id", "id AS a", "id AS b")
    assert archive.align_schema([early, late]).where("b IS NULL").count() == 50
    filled = archive.align_schema([early, late], fill_null=0).orderBy("id").collect()
    assert [r.b for r in filled] == [0] * 50 + list(range(50, 100))


def test_retention_rules_of_one_channel_over_many_tasks(spark, monkeypatch):
    from pulsekit.operators import scan

    monkeypatch.setattr(scan, "TASK_ROWS", 100)
    rng, rules = random.Random(3), []
    for seq in range(600):  # nested, equal, open and overlapping ranges, nearly all of one channel
        lo = rng.choice([0, 0, 7, rng.randrange(3000)])
        rules.append((seq // 2, "b", rng.choice("ccccd"), lo, rng.choice([lo + 5, 2999, lo + rng.randrange(3000)]), None, None, rng.randrange(9)))
    frame = spark.createDataFrame(rules, retention.RULES_SCHEMA)
    samples = spark.range(-5, 3500).select(
        F.lit("b").alias("backend"), F.element_at(F.array(*map(F.lit, "cde")), (F.pmod("id", F.lit(3)) + 1).cast("int")).alias("channel"),
        F.col("id").alias("pulse_id"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
    )
    got = {r.pulse_id: r.ttl_s for r in retention.apply_retention(samples, frame, block_rows=40).select("pulse_id", "ttl_s").collect()}
    assert len(got) == 3505
    for pulse, ttl in got.items():
        covering = [(r[0], r[7]) for r in rules if r[2] == "cde"[pulse % 3] and r[3] <= pulse <= r[4]] if pulse >= 0 else []
        assert ttl == (max(covering)[1] if covering else None)
    # bounds are ranked by bucket, and the tasks that bring blocks together grow with the rules
    bounds = retention._bounds(retention._ranges(frame), 40)
    tasks = bounds.groupBy("channel", F.spark_partition_id().alias("task")).count().where("channel = 'c'").count()
    assert tasks > 4
    assert [r.rank for r in bounds.where("channel = 'c'").orderBy("at").collect()] == list(range(bounds.where("channel = 'c'").count()))
