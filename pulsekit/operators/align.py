"""Putting channels and streams together by pulse."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.types import ChannelDef, typed_value
from pulsekit.operators.joins import lookup_join

_NS = 1_000_000_000


def _slot(samples: DataFrame, channel: ChannelDef, value: Column) -> Column:
    """The value of one channel: the right slot of a value struct, or the plain value."""
    if isinstance(samples.schema["value"].dataType, T.StructType) and "ai" in samples.schema["value"].dataType.names:
        return typed_value(value, channel.type, channel.shape)
    return value


def align_pulses(
    samples: DataFrame,
    channels: Iterable[ChannelDef | dict | str],
    by: tuple[str, ...] = ("pulse_id",),
) -> DataFrame:
    """One row per pulse with a column per channel, NULL where the channel had nothing.

    A channel that came twice for a pulse counts with its last arrival. Samples shrink to one cell per pulse and channel,
    which combines before the shuffle, and the cells of a pulse to one map, so the work grows with the samples and the
    cells of the result, not with samples times channels. With `ts_sec`/`ts_ns` present the row also gets the
    earliest of its samples' times.
    """
    defs = [ChannelDef.of(c) for c in channels]
    wanted = samples.where(F.col("channel").isin([d.name for d in defs]))
    timed = {"ts_sec", "ts_ns"} <= set(samples.columns)
    times = [F.min(F.col("ts_sec") * _NS + F.col("ts_ns")).alias("_time")] if timed else []
    cells = wanted.groupBy(*by, "channel").agg(F.max_by("value", "arrival_seq").alias("_value"), *times)
    times = [F.min("_time").alias("_time")] if timed else []
    held = cells.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("channel", "_value"))).alias("_cells"), *times)
    values = [_slot(samples, d, F.element_at("_cells", F.lit(d.name))).alias(d.name) for d in defs]
    wide = held.select(*by, *(["_time"] if timed else []), *values)
    if times:
        ns = F.pmod(F.col("_time"), F.lit(_NS).cast("bigint"))
        wide = wide.select(
            *by,
            F.expr(f"(_time - pmod(_time, {_NS}L)) div {_NS}L").alias("global_sec"),
            ns.alias("global_ns"),
            *[F.col(f"`{d.name}`") for d in defs],
        )
    return wide


def one_per_pulse(df: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """The last arrival of each pulse; messages without a pulse id count as one pulse, NULL."""
    rest = [c for c in df.columns if c != "pulse_id"]
    newest = [F.max_by(F.col(f"`{c}`"), F.col(order)).alias(c) for c in rest]
    return df.groupBy("pulse_id").agg(*newest)


def merge_streams(
    a: DataFrame, b: DataFrame, how: str = "outer", suffixes: tuple[str, str] = ("_a", "_b")
) -> DataFrame:
    """Two separately received streams side by side, one row per pulse.

    Each side is reduced to the last arrival per pulse first, which bounds the result at one row per pulse. A NULL
    pulse is a pulse like any other, here as in `align_pulses`.
    """
    if how not in ("inner", "left", "outer", "full"):
        raise ValueError(f"how must be inner, left or outer, not {how!r}")
    sides = []
    for df, other, suffix in ((a, b, suffixes[0]), (b, a, suffixes[1])):
        renamed = {c: f"{c}{suffix}" for c in df.columns if c != "pulse_id" and c in other.columns}
        sides.append(one_per_pulse(df).withColumnsRenamed(renamed))
    right = sides[1].withColumnRenamed("pulse_id", "_pulse")
    joined = sides[0].join(right, F.col("pulse_id").eqNullSafe(F.col("_pulse")), how)
    return joined.withColumn("pulse_id", F.coalesce("pulse_id", "_pulse")).drop("_pulse")


def with_channel_defs(samples: DataFrame, defs: DataFrame) -> DataFrame:
    """Each sample with the definition its header gives for its position."""
    new = [c for c in defs.columns if c not in samples.columns or c in ("header_hash", "ordinal")]
    return lookup_join(samples, defs.select(*new), ["header_hash", "ordinal"])


def collapse_duplicates(samples: DataFrame) -> DataFrame:
    """A channel listed twice in one message counts with its last place in the header."""
    keys = [c for c in ("stream_id", "arrival_seq", "channel") if c in samples.columns]
    rest = F.struct(*[c for c in samples.columns if c not in keys])
    last = samples.groupBy(*keys).agg(F.max_by(rest, F.col("ordinal")).alias("_row"))
    return last.select(*keys, "_row.*").select(*samples.columns)


def union_streams(*frames: DataFrame) -> DataFrame:
    """G1: several origins as one table; `stream_id` keeps them apart."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
