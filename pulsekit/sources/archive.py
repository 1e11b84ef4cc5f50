"""Archives in Parquet: a wide one, one directory per channel, and columns that keep their old versions."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.timestamps import join_ts
from pulsekit.functions.types import typed_value
from pulsekit.operators.joins import lookup_join
from pulsekit.operators.retention import apply_retention, purge_expired
from pulsekit.operators.scan import OrderedScan
from pulsekit.operators.select import META_COLUMNS
from pulsekit.sources.files import exists, folders, remove, rename
from pulsekit.sources.scratch import scratch_dir

# A column may be replaced this often.
MAX_VERSIONS = 99


def compact_columns(wide: DataFrame) -> list[str]:
    return ["pulse_id", *[c for c in wide.columns if c not in META_COLUMNS]]


def write_compact(wide: DataFrame, path: str, mode: str = "error", ordered: bool = True) -> None:
    """A4: pulse id and one column per channel.

    Files hold consecutive pulses, so their statistics let a pulse range skip the others; arrival order
    is part of the range, which lets a pulse id that very many rows share span several files.
    """
    keys = [c for c in ("pulse_id", "stream_id", "arrival_seq") if c in wide.columns]
    if ordered:
        wide = wide.repartitionByRange(*keys).sortWithinPartitions(*keys)
    wide.select(*[F.col(f"`{c}`") for c in compact_columns(wide)]).write.mode(mode).parquet(path)


def channel_rows(samples: DataFrame) -> DataFrame:
    """Samples under the names the per-channel archive uses."""
    order = [c for c in ("stream_id", "arrival_seq") if c in samples.columns]
    return samples.select(
        "channel",
        "pulse_id",
        F.col("value").alias("data"),
        F.col("ts_sec").alias("timestamp"),
        F.col("ts_ns").alias("timestamp_offset"),
        *order,
    )


def write_channels(samples: DataFrame, path: str, mode: str = "error") -> None:
    """A5: a directory per channel with data, timestamp, timestamp_offset and pulse_id.

    Rows are rebalanced by channel before the write: few files for small channels, and several tasks for
    one that holds much of the data.
    """
    _write_by_channel(channel_rows(samples), path, mode)


def _write_by_channel(rows: DataFrame, path: str, mode: str) -> None:
    rows = rows.hint("rebalance", "channel").sortWithinPartitions("channel", "pulse_id")
    rows.write.mode(mode).partitionBy("channel").parquet(path)


def read_channels(spark: SparkSession, path: str, channels: Iterable[str] | None = None) -> DataFrame:
    """Read a per-channel archive; only the directories of the named channels are opened."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return rows if channels is None else rows.where(F.col("channel").isin(sorted(channels)))


def purge_channels(
    spark: SparkSession,
    path: str,
    out: str,
    rules: DataFrame,
    now: datetime,
    backend: str,
    default_ttl_s: int | None = None,
    mode: str = "error",
) -> None:
    """C6 on a per-channel archive: write what is still to be kept to a new place.

    The old archive stays as it is until the new one is complete, whatever happens on the way. Rows without a
    timestamp have no age and are kept.
    """
    stored = read_channels(spark, path)
    dated = stored.withColumn("backend", F.lit(backend)).withColumn("ts", join_ts(F.col("timestamp"), F.col("timestamp_offset")))
    kept = purge_expired(dated, rules, now, default_ttl_s)
    _write_by_channel(kept.select(*stored.columns), out, mode)


# Where a purge prepares what it changes; readers pass over names that begin like this.
_PURGE = "_purge"
_NO_CHANNEL = "__HIVE_DEFAULT_PARTITION__"


def purge_archive(
    spark: SparkSession, path: str, rules: DataFrame, now: datetime, backend: str, default_ttl_s: int | None = None
) -> list[str | None]:
    """C6 on a per-channel archive, in its place: only channels that hold something expired are written anew.

    Which these are is asked of pulses and times alone, without a look at the data. What stays of them is written aside;
    when that is complete it is listed, and channel after channel is swapped. A purge that is interrupted before the listing
    has changed nothing, one interrupted later is completed by :func:`finish_purge`, which the next purge calls first. Rows
    without a timestamp have no age and are kept. Returns the channels written anew; another writer must not be at work.
    """
    finish_purge(spark, path)
    stored = read_channels(spark, path)
    backends = {"backend": F.lit(backend), "ts": join_ts(F.col("timestamp"), F.col("timestamp_offset"))}
    dated = apply_retention(stored.select("channel", "pulse_id", "timestamp", "timestamp_offset").withColumns(backends), rules, default_ttl_s)
    gone = F.count_if(F.col("expires_at") <= F.lit(now))
    bounds = dated.groupBy("channel").agg(gone.alias("gone"), (F.count("*") - gone).alias("left")).where("gone > 0")
    affected = bounds.collect()  # a row per folder of the archive at most
    if not affected:
        return []
    names = [r["channel"] for r in affected]
    mine = F.col("channel").isin([n for n in names if n is not None])
    rows = stored.where(mine | F.col("channel").isNull() if None in names else mine)
    work = f"{path}/{_PURGE}/{uuid.uuid4().hex}"
    kept = purge_expired(rows.withColumns(backends), rules, now, default_ttl_s)
    _write_by_channel(kept.select(*stored.columns), f"{work}/kept", "error")
    # the listing makes the purge final
    spark.createDataFrame([(r["channel"], r["left"]) for r in affected], "channel string, left bigint").coalesce(1).write.parquet(f"{work}/affected")
    finish_purge(spark, path)
    return names


def finish_purge(spark: SparkSession, path: str) -> None:
    """Complete a purge that was interrupted: swap in what it had listed, drop what it had not come to list."""
    for work in folders(spark, f"{path}/{_PURGE}"):
        work = f"{path}/{_PURGE}/{work}"
        if exists(spark, f"{work}/affected/_SUCCESS"):
            live = {None if n == f"channel={_NO_CHANNEL}" else unquote(n.partition("=")[2]): n for n in folders(spark, path)}
            ready = {None if n == f"channel={_NO_CHANNEL}" else unquote(n.partition("=")[2]): n for n in folders(spark, f"{work}/kept")}
            for r in spark.read.parquet(f"{work}/affected").collect():
                channel = r["channel"]
                # a channel with rows left that is not ready any more has been swapped before
                if channel in live and (channel in ready or not r["left"]):
                    remove(spark, f"{path}/{live[channel]}")
                if channel in ready:
                    rename(spark, f"{work}/kept/{ready[channel]}", f"{path}/{ready[channel]}")
        remove(spark, work)


def align_schema(frames: Sequence[DataFrame], fill_null: int | float | None = None) -> DataFrame:
    """One table from parts that learned of their columns at different times.

    Rows from before a column came up have NULL there; `fill_null=0` gives the view with zeros.
    """
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return whole if fill_null is None else whole.na.fill(fill_null)


# ---- columns with versions ----


def replacements(samples: DataFrame, spec: Sequence[str] = ("type", "shape"), scan: OrderedScan = OrderedScan()) -> DataFrame:
    """Where a channel's definition changes: one row (stream, channel, arrival_seq) per change."""
    per_channel = OrderedScan((*scan.by, "channel"), scan.order, scan.bucket_rows)
    now = F.struct(*spec)
    slim = samples.select(*scan.by, scan.order, "channel", now.alias("_spec"))
    rows = per_channel.lag(slim, ["_spec"], "_before")
    changed = F.col("_before").isNotNull() & ~F.col("_before").eqNullSafe(F.col("_spec"))
    return rows.where(changed).select(*scan.by, "channel", scan.order)


def with_versions(
    samples: DataFrame,
    replaced: DataFrame,
    by: Sequence[str] = ("stream_id",),
    order: str = "arrival_seq",
    max_versions: int = MAX_VERSIONS,
) -> DataFrame:
    """Samples with `column`: name(1), name(2), ... for the versions replaced later, the name for the latest.

    The changes of a channel travel to its samples as one sorted array; more than `max_versions` are an error.
    """
    keys = [c for c in (*by, "channel") if c in replaced.columns]
    too_many = F.concat(F.lit("column "), F.col("channel"), F.lit(f" replaced more than {max_versions} times"))
    # counted before anything is collected
    counted = replaced.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.where(F.when(F.col("_n") > max_versions, F.raise_error(too_many).cast("boolean")).otherwise(F.lit(True)))
    changes = replaced.join(counted.select(*keys), keys, "left_semi")
    changes = changes.groupBy(*keys).agg(F.sort_array(F.collect_list(order)).alias("_changes"))
    rows = lookup_join(samples, changes, keys)
    so_far = F.size(F.filter("_changes", lambda at: at <= F.col(order)))
    total = F.size("_changes")
    latest = F.col("_changes").isNull() | (so_far == total)
    old_name = F.concat("channel", F.lit("("), (so_far + 1).cast("string"), F.lit(")"))
    return rows.withColumn("column", F.when(latest, F.col("channel")).otherwise(old_name)).drop("_changes")


def versioned_columns(
    samples: DataFrame,
    spec: Sequence[str] = ("type", "shape"),
    replaced: DataFrame | None = None,
    scan: OrderedScan = OrderedScan(),
    max_versions: int = MAX_VERSIONS,
) -> DataFrame:
    """One row per message, a column per version of each channel.

    Rows outside a version's life are NULL in its column. Which columns there are is looked up first: their names, types
    and shapes, which the schema of the result needs. A version whose rows differ in type or shape is an error, no value
    is dropped for it. `replaced` (channel, arrival_seq, for all
    streams or with their keys) says where columns are replaced, if not where `spec` changes.
    """
    if replaced is None:
        replaced = replacements(samples, spec, scan)
    # A handful of rows behind a scan of everything, asked for three times below: written once.
    path = scratch_dir(samples.sparkSession, "replaced")
    replaced.write.parquet(path)
    replaced = samples.sparkSession.read.schema(replaced.schema).parquet(path)
    rows = with_versions(samples, replaced, scan.by, scan.order, max_versions)
    is_struct = isinstance(samples.schema["value"].dataType, T.StructType)
    known = [c for c in ("type", "shape") if c in samples.columns]
    keys = [c for c in (*scan.by, "channel") if c in replaced.columns]
    per_stream = replaced.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    changes = per_stream.groupBy("channel").agg(F.max("n").alias("n"))
    counted = changes.collect()
    for r in counted:
        if r["n"] > max_versions:
            raise ValueError(f"column {r['channel']} replaced more than {max_versions} times")
    listed: dict[tuple[str, str], dict] = {}
    for r in rows.select("channel", "column", *known).distinct().collect():
        if is_struct and (r["channel"], r["column"]) in listed:
            raise ValueError(f"column {r['column']} has rows of several types or shapes; replace it where they change")
        listed[r["channel"], r["column"]] = r.asDict()
    for r in counted:
        # A version that was replaced before it got any row still has its (empty) column.
        for v in range(1, r["n"] + 1):
            listed.setdefault((r["channel"], f"{r['channel']}({v})"), {})

    cells = []
    for (channel, column), entry in sorted(listed.items()):
        mine = F.col("column") == column
        value = typed_value(F.col("value"), entry.get("type"), entry.get("shape")) if is_struct else F.col("value")
        rank = F.col("ordinal") if "ordinal" in samples.columns else F.lit(0)
        cells.append(F.max_by(F.when(mine, value), F.when(mine, rank)).alias(column))
    keys = [*scan.by, scan.order] + (["pulse_id"] if "pulse_id" in samples.columns else [])
    return rows.groupBy(*keys).agg(*cells)


def write_versioned(samples: DataFrame, path: str, mode: str = "error", **options) -> None:
    """Write :func:`versioned_columns`, rows in arrival order."""
    wide = versioned_columns(samples, **options)
    keys = [c for c in ("stream_id", "arrival_seq") if c in wide.columns]
    wide.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).parquet(path)
