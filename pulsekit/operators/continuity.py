"""Continuity of pulse ids: what was missed, sent twice or came back in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.operators.scan import OrderedScan

# Missing ids are listed in runs of runs, so that no array grows with the size of a gap.
_RUNS = (10**15, 10**10, 10**5, 1)


def classify(messages: DataFrame) -> DataFrame:
    """Compare each pulse with `hwm`, the highest pulse before it, and name and count the outcome.

    A stream without a previous pulse, or whose highest pulse is still 0, counts nothing. A message without a pulse id is
    of kind "no_pulse" and counts nothing either.
    """
    p, hwm = F.col("pulse_id"), F.col("hwm")
    counting = hwm.isNotNull() & (hwm != 0)
    count = lambda condition, n: F.when(counting & condition, n).otherwise(F.lit(0)).cast("bigint")
    return (
        messages.withColumn(
            "kind",
            F.when(p.isNull(), "no_pulse")
            .when(~counting, "first")
            .when(p == hwm + 1, "ok")
            .when(p == hwm, "duplicated")
            .when(p > hwm, "missed")
            .otherwise("reverted"),
        )
        .withColumn("missed", count(p > hwm + 1, p - hwm - 1))
        .withColumn("duplicated", count(p == hwm, F.lit(1)))
        .withColumn("reverted", count(p < hwm, F.lit(1)))
    )


def classify_pulses(messages: DataFrame, scan: OrderedScan = OrderedScan()) -> DataFrame:
    """Each message with `hwm`, `kind` and its `missed`, `duplicated`, `reverted` counts."""
    return classify(scan.prefix_max(messages, "pulse_id", "hwm"))


def continuity_stats(messages: DataFrame, scan: OrderedScan = OrderedScan()) -> DataFrame:
    """Totals of missed, duplicated and reverted pulses per stream."""
    needed = messages.select(*scan.by, scan.order, "pulse_id")
    return (
        classify_pulses(needed, scan)
        .groupBy(*scan.by)
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum("missed").alias("missed"),
            F.sum("duplicated").alias("duplicated"),
            F.sum("reverted").alias("reverted"),
        )
    )


def gap_report(messages: DataFrame, scan: OrderedScan = OrderedScan(), ids: bool = False) -> DataFrame:
    """One row per gap (`expected`, `received`, `n_missing`), or one row per missing id."""
    needed = messages.select(*scan.by, scan.order, "pulse_id")
    gaps = (
        classify_pulses(needed, scan)
        .where("missed > 0")
        .select(
            *scan.by,
            scan.order,
            (F.col("hwm") + 1).alias("expected"),
            F.col("pulse_id").alias("received"),
            F.col("missed").alias("n_missing"),
        )
    )
    if not ids:
        return gaps
    last = F.col("received") - 1
    ids_, whole = gaps.withColumn("missing_id", F.col("expected")), None
    for step in _RUNS:
        end = last if whole is None else F.col("missing_id") + F.least(F.lit(whole - 1), last - F.col("missing_id"))
        ids_ = ids_.withColumn("missing_id", F.explode(F.sequence("missing_id", end, F.lit(step).cast("bigint"))))
        whole = step
    return ids_


def idle_gaps(messages: DataFrame, timeout_ms: int, scan: OrderedScan = OrderedScan()) -> DataFrame:
    """Messages that came more than `timeout_ms` after the one before; -1 never times out."""
    rows = scan.lag(messages.select(*scan.by, scan.order, "recv_ts"), ["recv_ts"], "previous_ts")
    idle = F.timestamp_diff("MICROSECOND", F.col("previous_ts"), F.col("recv_ts"))
    rows = rows.withColumn("idle_us", idle).where(F.col("idle_us") > F.lit(timeout_ms).cast("bigint") * 1000)
    return rows.where(F.lit(timeout_ms >= 0))
