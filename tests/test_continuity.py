from tests.conftest import rows

from pulsekit.operators.continuity import continuity_stats, gap_report

SCHEMA = "stream_id string, arrival_seq bigint, pulse_id bigint"


def totals(spark, *streams):
    data = [(name, i, p) for name, pulses in streams for i, p in enumerate(pulses)]
    return rows(continuity_stats(spark.createDataFrame(data, SCHEMA)), "stream_id", "missed", "duplicated", "reverted")


def test_growing_prefixes(spark):
    pulses = [0, 1, 3, 6, 6, 5]
    expected = [(0, 0, 0), (0, 0, 0), (1, 0, 0), (3, 0, 0), (3, 1, 0), (3, 1, 1)]
    streams = [(f"s{n}", pulses[: n + 1]) for n in range(len(pulses))]
    assert totals(spark, *streams) == [(f"s{n}", *e) for n, e in enumerate(expected)]


def test_zero_counts_as_no_pulse_yet(spark):
    assert totals(spark, ("s", [0, 5])) == [("s", 0, 0, 0)]


def test_reverts_keep_the_highest_pulse(spark):
    assert totals(spark, ("s", [10, 8, 9, 11])) == [("s", 0, 0, 2)]


def test_streams_are_independent(spark):
    assert totals(spark, ("a", [1, 2, 3]), ("b", [100, 102])) == [("a", 0, 0, 0), ("b", 1, 0, 0)]


def test_ids_of_a_long_gap(spark):
    df = spark.createDataFrame([("s", 0, 1), ("s", 1, 250_002)], SCHEMA)
    ids = gap_report(df, ids=True)
    assert (ids.count(), ids.agg({"missing_id": "min"}).first()[0], ids.agg({"missing_id": "max"}).first()[0]) == (250_000, 2, 250_001)
    assert ids.select("missing_id").distinct().count() == 250_000
