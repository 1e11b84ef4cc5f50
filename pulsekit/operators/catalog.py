"""The channel catalogue: what exists, what is connected, what has data."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions.names import name_matches
from pulsekit.functions.timestamps import time_since
from pulsekit.operators.scan import OrderedScan
from pulsekit.operators.select import ChannelRule, channel_rules

# Euclid's algorithm needs fewer steps than this for any pair of 64-bit numbers.
_GCD_STEPS = 92

DETAILS = ("name", "type", "shape", "modulo", "offset", "source")


def available_channels(catalog: DataFrame, pattern: str = ".*", metadata: bool = False) -> DataFrame:
    """Catalogue entries whose name contains the pattern: names only, or with their details."""
    found = catalog.where(name_matches(F.col("name"), pattern))
    return found.select(*DETAILS) if metadata else found.select("name")


def channel_names(catalog: DataFrame) -> DataFrame:
    """The names alone."""
    return catalog.select("name")


def flatten_catalog(listing: DataFrame) -> DataFrame:
    """One row per channel from one row per backend; nothing is merged."""
    return listing.select("backend", F.explode("channels").alias("_channel")).select("backend", "_channel.*")


def distinct_channels(channels: DataFrame | str | Iterable[str]) -> DataFrame | list[str]:
    """Sorted distinct names of a table, or of a list; a bare string is one name."""
    if isinstance(channels, DataFrame):
        return channels.select("channel").distinct().orderBy("channel")
    return sorted({channels} if isinstance(channels, str) else set(channels))


def _as_table(spark: SparkSession, channels: DataFrame | str | Iterable[str]) -> DataFrame:
    if isinstance(channels, DataFrame):
        return channels.select("channel").distinct()
    return spark.createDataFrame([(c,) for c in distinct_channels(channels)], "channel string")


def channel_status(
    requested: DataFrame | str | Iterable[str], state: DataFrame, now: Column | datetime | None = None
) -> DataFrame:
    """C4: state, last event and age of each requested channel, by name; unknown ones have NULLs."""
    if now is None:
        now = F.current_timestamp()
    elif not isinstance(now, Column):
        now = F.lit(now)
    wanted = _as_table(state.sparkSession, requested)
    return (
        wanted.join(state.select("channel", "configured", "connected", "recording", "last_event"), "channel", "left")
        .withColumn("time_since", time_since(F.col("last_event"), now))
        .orderBy("channel")
    )


def missing_channels(expected: DataFrame | Iterable[str], samples: DataFrame) -> DataFrame:
    """Expected channels none of whose samples has a value."""
    seen = samples.where(F.col("value").isNotNull()).select("channel").distinct()
    return _as_table(samples.sparkSession, expected).join(seen, "channel", "left_anti")


def gcd(a: Column, b: Column) -> Column:
    pair = F.struct(a.cast("bigint").alias("x"), b.cast("bigint").alias("y"))

    def step(p: Column, _: Column) -> Column:
        rest = F.when(p["y"] == 0, F.lit(0)).otherwise(p["x"] % F.nullif(p["y"], F.lit(0).cast("bigint")))
        return F.when(p["y"] == 0, p).otherwise(F.struct(p["y"].alias("x"), rest.cast("bigint").alias("y")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_GCD_STEPS)), pair, step, lambda p: p["x"])


def lcm(a: Column, b: Column) -> Column:
    """Least common multiple of two positive whole numbers."""
    return F.call_function("div", a, gcd(a, b)) * b


def verify_channels(
    requested: DataFrame | Iterable[str | dict | ChannelRule],
    catalog: DataFrame,
    state: DataFrame,
    resolution: str = "adjust-individual",
    verify: bool = True,
) -> DataFrame:
    """Is each requested channel there and connected, and at which rate would it come?

    `adjust-individual` moves a requested modulo to the nearest rate the source can give (the least
    common multiple); `keep-as-is`, which `verify=False` implies, leaves it. A channel that several
    sources offer is judged by its fastest one.
    """
    if resolution not in ("adjust-individual", "keep-as-is"):
        raise ValueError(f"unknown resolution {resolution!r}")
    if not verify:
        resolution = "keep-as-is"
    if not isinstance(requested, DataFrame):
        rows = [(r.name, r.modulo, r.offset) for r in channel_rules(requested)]
        requested = catalog.sparkSession.createDataFrame(rows, "channel string, modulo bigint, offset bigint")
    wanted = requested.select(
        "channel",
        F.coalesce(F.col("modulo").cast("bigint"), F.lit(1).cast("bigint")).alias("requested_modulo"),
        F.coalesce(F.col("offset").cast("bigint"), F.lit(0).cast("bigint")).alias("offset"),
    )
    offered = catalog.groupBy(F.col("name").alias("channel")).agg(
        F.min(F.coalesce(F.col("modulo").cast("bigint"), F.lit(1).cast("bigint"))).alias("source_modulo")
    )
    live = state.groupBy("channel").agg(F.max("connected").alias("_connected"))
    joined = wanted.join(offered, "channel", "left").join(live, "channel", "left")
    effective = F.col("requested_modulo")
    if resolution == "adjust-individual":
        # the steps of the division run once per pair of rates, not once per row
        rates = ["requested_modulo", "source_modulo"]
        pairs = joined.where("source_modulo IS NOT NULL").select(*rates).distinct()
        pairs = pairs.withColumn("_lcm", lcm(F.col("requested_modulo"), F.col("source_modulo")))
        joined = joined.join(pairs, rates, "left")
        effective = F.coalesce("_lcm", effective)
    return joined.select(
        "channel",
        F.col("source_modulo").isNotNull().alias("available"),
        F.coalesce("_connected", F.lit(False)).alias("connected"),
        "requested_modulo",
        "source_modulo",
        effective.alias("effective_modulo"),
        "offset",
    )


def latest(samples: DataFrame, by: tuple[str, ...] = ("channel",), columns: Iterable[str] = ("value",)) -> DataFrame:
    """The newest sample of each channel; a channel has one sample per arrival (see collapse_duplicates)."""
    newest = [F.max_by(c, F.col("arrival_seq")).alias(c) for c in columns if c != "arrival_seq"]
    return samples.groupBy(*by).agg(F.max("arrival_seq").alias("arrival_seq"), *newest)


def derive_catalog(samples: DataFrame, defs: DataFrame) -> DataFrame:
    """The catalogue as the data shows it: each definition in use, with its pulses and sample count.

    Samples are reduced to one row per header position before they meet the definitions.
    """
    used = samples.groupBy("header_hash", "ordinal").agg(
        F.min("pulse_id").alias("_first"), F.max("pulse_id").alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    details = [c for c in ("type", "shape", "encoding", "compression", "modulo", "offset", "source", "backend") if c in defs.columns]
    return (
        used.join(defs.select("header_hash", "ordinal", "channel", *details), ["header_hash", "ordinal"])
        .groupBy("channel", *details)
        .agg(
            F.min("_first").alias("first_pulse"),
            F.max("_last").alias("last_pulse"),
            F.sum("_n").alias("n_samples"),
        )
    )


def completeness(
    samples: DataFrame,
    expected: str | Iterable[str],
    messages: DataFrame | None = None,
    scan: OrderedScan = OrderedScan(),
) -> DataFrame:
    """Per stream, the first message after which every expected channel's latest value is not NULL.

    Gives its `complete_seq`, the number of `messages` up to it and the microseconds since the first
    message; NULLs when that never happens. Only the moments where a channel gains or loses its value
    count, which on a healthy stream is a handful of rows.
    """
    names = distinct_channels(expected)
    stream = list(scan.by)
    mine = samples.where(F.col("channel").isin(names))
    has = F.col("value").isNotNull()
    if "ordinal" in samples.columns:
        # A channel listed twice in one message counts with its last place.
        held = mine.groupBy(*stream, scan.order, "channel").agg(F.max_by(has, F.col("ordinal")).alias("has"))
    else:
        held = mine.select(*stream, scan.order, "channel", has.alias("has"))
    per_channel = OrderedScan((*stream, "channel"), scan.order, scan.bucket_rows)
    moves = per_channel.lag(held, ["has"], "had").select(
        *stream, scan.order, (F.col("has").cast("int") - F.coalesce(F.col("had").cast("int"), F.lit(0))).alias("move")
    )
    steps = moves.where("move <> 0").groupBy(*stream, scan.order).agg(F.sum("move").alias("move"))
    done = (
        scan.index(steps, "_step", {"_held": "move"})
        .where(F.col("_held") == len(names))
        .groupBy(*stream)
        .agg(F.min(scan.order).alias(scan.order))
    )

    # messages up to the complete one: counted where they are, distinct before the shuffle, none sorted
    source = samples if messages is None else messages
    marked = source.join(done.withColumnRenamed(scan.order, "_done"), stream, "left")
    at = F.col(scan.order)
    return marked.groupBy(*stream).agg(
        F.max("_done").alias("complete_seq"),
        F.nullif(F.count_distinct(F.when(at <= F.col("_done"), at)), F.lit(0)).alias("messages"),
        F.timestamp_diff(
            "MICROSECOND", F.min_by("recv_ts", scan.order), F.min(F.when(at == F.col("_done"), F.col("recv_ts")))
        ).alias("elapsed_us"),
    )
