"""Schema epochs: stretches of messages under one data header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.operators.scan import OrderedScan


def _changed(df: DataFrame, previous: str) -> Column:
    differs = ~F.col(previous).eqNullSafe(F.col("header_hash"))
    if "n_channels" in df.columns:
        differs = differs & (F.col("n_channels") > 0)
    return differs


def format_changes(messages: DataFrame, scan: OrderedScan = OrderedScan()) -> DataFrame:
    """Each message with `format_changed`: its header differs from the one before and has channels."""
    rows = scan.lag(messages, ["header_hash"], "_previous_hash")
    return rows.withColumn("format_changed", _changed(rows, "_previous_hash")).drop("_previous_hash")


def schema_epochs(messages: DataFrame, scan: OrderedScan = OrderedScan()) -> DataFrame:
    """Each message with `format_changed` and `epoch`, which counts the changes so far.

    One scan and one shuffle of the messages: a bucket's own changes are counted inside it, and whether its first message
    differs from the message before it is settled on the summary.
    """
    local = scan.local()
    rows = (
        scan.gathered(messages)
        .withColumn("_previous_hash", F.lag("header_hash").over(local))
        .withColumn("_first", F.row_number().over(local) == 1)
    )
    inner = ~F.col("_first") & _changed(rows, "_previous_hash")
    rows = rows.withColumn("_inner", inner.cast("int")).drop("_previous_hash")

    with_channels = F.lit(True) if "n_channels" not in messages.columns else F.col("n_channels") > 0
    per_bucket = rows.groupBy(*scan.keys).agg(
        F.sum("_inner").alias("_changes"),
        F.max(F.when(F.col("_first"), F.col("header_hash"))).alias("_first_hash"),
        F.max(F.when(F.col("_first"), with_channels)).alias("_first_counts"),
        scan.last_row(messages)["header_hash"].alias("_last_hash"),
    )
    border = F.lag("_last_hash").over(scan.across())
    at_border = F.col("_first_counts") & ~border.eqNullSafe(F.col("_first_hash"))
    per_bucket = per_bucket.withColumn("_at_border", at_border.cast("int"))
    until_here = scan.across().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.coalesce(F.sum("_changes").over(scan.across_before()), F.lit(0)) + F.sum("_at_border").over(until_here)
    given = per_bucket.select(*scan.keys, "_at_border", base.alias("_base"))

    running = F.sum("_inner").over(scan.local_until())
    changed = F.when(F.col("_first"), F.col("_at_border") == 1).otherwise(F.col("_inner") == 1)
    return (
        scan.attached(rows, given)
        .withColumn("epoch", (F.col("_base") + running).cast("bigint"))
        .withColumn("format_changed", changed)
        .drop("_first", "_inner", "_at_border", "_base", scan.bucket)
    )


def tail_rows(df: DataFrame, n: int, scan: OrderedScan = OrderedScan()) -> DataFrame:
    """The last n messages of each stream that belong to its current schema.

    The current schema is the end of the stream, so its last n messages are the stream's last n, cut at
    the newest format change among them. One message more tells whether the first of them is a change.
    """
    in_order = Window.partitionBy(*scan.by).orderBy(scan.order)
    stream = Window.partitionBy(*scan.by)
    rows = scan.last(df, n + 1, "_rank").withColumn("_previous_hash", F.lag("header_hash").over(in_order))
    change = F.when(_changed(rows, "_previous_hash") & (F.col("_rank") <= n), F.col(scan.order))
    rows = rows.withColumn("_since", F.max(change).over(stream))
    current = (F.col("_rank") <= n) & (F.col(scan.order) >= F.coalesce("_since", F.col(scan.order)))
    return rows.where(current).drop("_rank", "_since", "_previous_hash")


def trailing(df: DataFrame, column: str, n: int = 10, scan: OrderedScan = OrderedScan(), out: str = "trail") -> DataFrame:
    """E5: the last n values of a column up to each message, oldest first; NULLs keep their place."""
    rows = scan.with_halo(df, [column], n - 1) if n > 1 else scan.bucketed(df).withColumn("_halo", F.lit(False))
    frame = scan.local().rowsBetween(-(n - 1), 0)
    held = F.collect_list(F.struct(F.col(column).alias("v"))).over(frame)
    return (
        rows.withColumn(out, F.transform(held, lambda r: r["v"]))
        .where(~F.col("_halo"))
        .drop("_halo", scan.bucket)
    )
