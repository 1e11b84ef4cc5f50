"""Choosing channels, pulses and messages."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions.identity import hashable
from pulsekit.operators.scan import BUCKET_ROWS, Borders, OrderedScan

# Columns of wide rows that are not channels.
META_COLUMNS = (
    "stream_id",
    "arrival_seq",
    "recv_ts",
    "pulse_id",
    "header_hash",
    "global_sec",
    "global_ns",
    "n_bytes",
    "n_channels",
    "status",
)


@dataclass(frozen=True)
class ChannelRule:
    """Take a channel at the pulses where (pulse_id - offset) is a multiple of modulo."""

    name: str
    modulo: int = 1
    offset: int = 0


def channel_rules(specs: Iterable[str | dict | ChannelRule]) -> list[ChannelRule]:
    """Rules from names and {name, modulo, offset} dicts; other keys are ignored, bad numbers are errors."""
    rules = []
    for spec in specs:
        if isinstance(spec, ChannelRule):
            rules.append(spec)
        elif isinstance(spec, str):
            rules.append(ChannelRule(spec))
        else:
            rules.append(
                ChannelRule(
                    spec["name"],
                    _whole(spec.get("modulo", 1), "modulo", spec["name"]),
                    _whole(spec.get("offset", 0), "offset", spec["name"]),
                )
            )
    for rule in rules:
        if rule.modulo < 1:
            raise ValueError(f"modulo of {rule.name!r} must be at least 1, not {rule.modulo}")
    return rules


def _whole(number: int | float | str, what: str, name: str) -> int:
    try:
        value = float(number)
    except (TypeError, ValueError):
        raise ValueError(f"{what} of {name!r} is not a number: {number!r}") from None
    if value != int(value):
        raise ValueError(f"{what} of {name!r} is not whole: {number!r}")
    return int(value)


def is_long(df: DataFrame) -> bool:
    return "channel" in df.columns


def select_channels(df: DataFrame, specs: Iterable[str | dict] | DataFrame | None) -> DataFrame:
    """B1/B2: keep the named channels; None keeps all.

    Long data keeps their rows, wide data their columns, in message order whatever the order of the
    request. A DataFrame with a `channel` column works for sets too large to write down.
    """
    if specs is None:
        return df
    if isinstance(specs, DataFrame):
        return df.join(specs.select("channel"), "channel", "left_semi")
    names = {rule.name for rule in channel_rules(specs)}
    if is_long(df):
        return df.where(F.col("channel").isin(sorted(names)))
    return df.select(*[f"`{c}`" for c in df.columns if c in META_COLUMNS or c in names])


def decimate(df: DataFrame, rules: Iterable[str | dict | ChannelRule] | DataFrame) -> DataFrame:
    """Keep a channel only at the pulses one of its rules asks for; other channels go.

    Long data loses the rows between, wide data gets NULL there and keeps rows where any channel is due.
    Rules in a DataFrame (channel, modulo, offset) are applied to long data by a semi join.
    """
    if isinstance(rules, DataFrame):
        r = rules.select(
            F.col("channel").alias("_channel"),
            F.coalesce(F.col("modulo").cast("bigint"), F.lit(1)).alias("_modulo"),
            F.coalesce(F.col("offset").cast("bigint"), F.lit(0)).alias("_offset"),
        )
        due = F.pmod(F.col("pulse_id") - F.col("_offset"), F.col("_modulo")) == 0
        return df.join(r, (F.col("channel") == F.col("_channel")) & due, "left_semi")

    names_at = defaultdict(set)
    for rule in channel_rules(rules):
        names_at[(rule.modulo, rule.offset % rule.modulo)].add(rule.name)
    due_at = {key: F.pmod(F.col("pulse_id") - key[1], F.lit(key[0]).cast("bigint")) == 0 for key in names_at}
    if is_long(df):
        wanted = F.lit(False)
        for key, names in names_at.items():
            named = F.col("channel").isin(sorted(names))
            wanted = wanted | (named if key[0] == 1 else named & due_at[key])
        return df.where(wanted)

    columns, any_due = [], F.lit(False)
    for c in df.columns:
        keys = [key for key, names in names_at.items() if c in names]
        if keys:
            due = F.lit(False)
            for key in keys:
                due = due | due_at[key]
            any_due = any_due | due
            columns.append(F.when(due, F.col(f"`{c}`")).alias(c))
        elif c in META_COLUMNS:
            columns.append(F.col(c))
    return df.where(any_due).select(*columns)


def filter_messages(df: DataFrame, predicate: Column | Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Keep the rows the predicate is true for; NULL counts as false.

    Give a Column where possible: it stays in the JVM and is pushed into the scan. A Python callable gets
    batches of rows as a pandas frame and returns booleans.
    """
    if isinstance(predicate, Column):
        return df.where(predicate)

    @F.pandas_udf("boolean")
    def keep(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(predicate(rows)).astype("boolean")

    return df.where(keep(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def first_match(
    df: DataFrame,
    predicate: Column | Callable[[pd.DataFrame], pd.Series],
    per_stream: bool = False,
    order: str = "arrival_seq",
) -> DataFrame:
    """The first row in arrival order the predicate is true for, overall or per stream."""
    matches = filter_messages(df, predicate)
    if not per_stream:
        return matches.orderBy(order).limit(1)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return matches.groupBy("stream_id").agg(F.min_by(row, F.col(order)).alias("_row")).select("_row.*")


def valid_messages(messages: DataFrame) -> DataFrame:
    """Messages that can be used: a good header, some channels and a header hash."""
    if "status" in messages.columns:
        messages = messages.where("status = 'ok'")
    return messages.where("header_hash <> ''")


def every_nth(df: DataFrame, n: int, scan: OrderedScan = OrderedScan()) -> DataFrame:
    """Rows 0, n, 2n, ... of each stream, with their index `idx`; n = 0 keeps none."""
    if n == 0:
        return df.withColumn("idx", F.lit(None).cast("bigint")).where(F.lit(False))
    return scan.index(df, "idx").where(F.col("idx") % n == 0)


def envelope(messages: DataFrame) -> DataFrame:
    """Pulse id and global timestamp of each message."""
    return messages.select(
        "pulse_id",
        F.col("global_sec").alias("global_timestamp"),
        F.col("global_ns").alias("global_timestamp_offset"),
    )


def render_rows(wide: DataFrame, channels: Sequence[str] | None = None) -> DataFrame:
    """Every cell as text, message columns first; NULL reads "None", arrays are JSON.

    A channel named like one of the message columns takes that column's place.
    """
    meta = {"pulse_id": "pulse_id", "global_timestamp": "global_sec", "global_timestamp_offset": "global_ns"}
    types = dict(wide.dtypes)

    def text(source: str) -> Column:
        cell = F.col(f"`{source}`")
        as_text = F.to_json(cell) if types[source].startswith("array") else cell.cast("string")
        return F.coalesce(as_text, F.lit("None"))

    cells = {out: text(source) for out, source in meta.items() if source in types}
    for c in wide.columns:
        if c not in META_COLUMNS and (channels is None or c in channels):
            cells[c] = text(c)
    return wide.select(*[cell.alias(name) for name, cell in cells.items()])


def in_order(df: DataFrame) -> DataFrame:
    """arrival order within each stream, header order within each message."""
    keys = [c for c in ("stream_id", "arrival_seq", "ordinal") if c in df.columns]
    return df.orderBy(*keys)


def take_messages(
    df: DataFrame,
    n: int | None,
    order: str = "arrival_seq",
    bucket_rows: int = BUCKET_ROWS,
    checked: bool = True,
    borders: Borders | None = None,
) -> DataFrame:
    """the first n usable messages in arrival order; 0 or None takes all.

    Ties in `order`, as between streams, go by stream_id and then by a hash of the row. Counts per bucket of arrivals say
    which buckets are needed, for any n; only these are sorted, each by itself, and no task gathers n rows. With `checked`
    off, all rows are usable, not only valid messages. Sparse order values need `borders`, see `OrderedScan.fitted`.
    """
    usable = valid_messages(df) if checked and "header_hash" in df.columns else df
    if not n:
        return usable
    bucket = OrderedScan((), order, bucket_rows, borders=borders).bucket_of()
    rows = usable.withColumn("_bucket", bucket)
    before = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    needed = counts.select("_bucket", F.coalesce(before, F.lit(0)).alias("_before")).where(F.col("_before") < n)
    ties = [c for c in ("stream_id",) if c in df.columns] + [F.xxhash64(*hashable(df))]
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(order, *ties))
    rows = rows.join(needed, "_bucket").withColumn("_place", F.col("_before") + place)
    return rows.where(F.col("_place") <= n).select(*df.columns)
