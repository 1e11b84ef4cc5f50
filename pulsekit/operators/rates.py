"""Message and data volume, rates and latencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.operators.scan import OrderedScan

_MIB = 1024 * 1024


def volume(messages: DataFrame, by: tuple[str, ...] = ("stream_id",)) -> DataFrame:
    """Messages and bytes received, and the bytes in units of 1024 x 1024."""
    return (
        messages.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("messages"), F.sum("n_bytes").cast("bigint").alias("n_bytes"))
        .withColumn("mb", F.col("n_bytes") / _MIB)
    )


def mbps(bytes_per_second: Column) -> Column:
    return bytes_per_second * 8 / _MIB


def rates(messages: DataFrame, n: int = 100, scan: OrderedScan = OrderedScan()) -> DataFrame:
    """D3: at every n-th message, the message and data rate since the one before; first is NULL.

    The n-th messages know their own number, so each meets its predecessor by (stream, number), which
    spreads evenly however long the stream is.
    """
    if n < 1:
        raise ValueError("rates need n >= 1")
    needed = messages.select(*scan.by, scan.order, "recv_ts", "n_bytes")
    sampled = scan.index(needed, "idx", {"total_bytes": "n_bytes"}).where(F.col("idx") % n == 0)
    step = (F.col("idx") / F.lit(n)).cast("bigint")
    # Each sample goes out twice: as itself, and as "previous" of the next one.
    roles = F.explode(
        F.array(
            F.struct(step.alias("step"), F.lit(True).alias("own")),
            F.struct((step + 1).alias("step"), F.lit(False).alias("own")),
        )
    )
    both = sampled.withColumn("_role", roles)
    own = F.col("_role.own")
    pick = lambda c, mine: F.max(F.when(own == F.lit(mine), F.col(c)))
    paired = both.groupBy(*scan.by, F.col("_role.step").alias("_step")).agg(
        *[pick(c, True).alias(c) for c in (scan.order, "idx", "recv_ts", "total_bytes")],
        *[pick(c, False).alias(f"_prev_{c}") for c in ("idx", "recv_ts", "total_bytes")],
    )
    seconds = F.timestamp_diff("MICROSECOND", F.col("_prev_recv_ts"), F.col("recv_ts")) / 1e6
    seconds = F.when(seconds > 0, seconds)
    return (
        paired.where(F.col("idx").isNotNull())
        .withColumn("message_rate", (F.col("idx") - F.col("_prev_idx")) / seconds)
        .withColumn("receive_mbps", mbps((F.col("total_bytes") - F.col("_prev_total_bytes")) / seconds))
        .select(*scan.by, scan.order, "idx", "recv_ts", "total_bytes", "message_rate", "receive_mbps")
    )


def latency_per_run(receipts: DataFrame, run: str = "run_id", order: str = "arrival_seq", latency: str = "latency") -> DataFrame:
    """Per run: latency of its first message, number and mean latency of the others."""
    per_run = receipts.groupBy(run).agg(
        F.min_by(latency, order).alias("first_latency"),
        F.sum(latency).alias("_total"),
        (F.count(F.lit(1)) - 1).alias("n_later"),
    )
    later = F.when(F.col("n_later") > 0, (F.col("_total") - F.col("first_latency")) / F.col("n_later"))
    return per_run.withColumn("later_latency", later).drop("_total")


def latency_summary(receipts: DataFrame, run: str = "run_id", order: str = "arrival_seq", latency: str = "latency") -> DataFrame:
    """Mean first-message latency, mean over runs of the mean later latency, and its frequency."""
    return (
        latency_per_run(receipts, run, order, latency)
        .agg(
            F.count(F.lit(1)).alias("n_runs"),
            F.avg("first_latency").alias("first_latency"),
            F.avg("later_latency").alias("later_latency"),
        )
        .withColumn("later_frequency", F.when(F.col("later_latency") != 0, 1 / F.col("later_latency")))
    )
