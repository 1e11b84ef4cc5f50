"""Retention: time-to-live rules over pulse or time ranges."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsekit.functions.timestamps import epoch_micros, join_ts
from pulsekit.operators.scan import BUCKET_ROWS, Borders, OrderedScan, dealt, depth_borders
from pulsekit.sources.scratch import scratch_dir

RULES_SCHEMA = (
    "rule_seq bigint, backend string, channel string, start_pulse bigint, end_pulse bigint, "
    "start_ts timestamp_ntz, end_ts timestamp_ntz, ttl_s bigint"
)


def ttl_rule(
    rule_seq: int, channels: Iterable[str], start: int | datetime, end: int | datetime, ttl: timedelta, backend: str
) -> list[tuple]:
    """Rule rows of one update; `channels` may be "backend/name", others belong to `backend`."""
    if not isinstance(ttl, timedelta):
        raise ValueError("ttl must be a timedelta")
    kinds = {type(start), type(end)}
    if kinds == {int}:
        bounds = (start, end, None, None)
    elif all(issubclass(kind, datetime) for kind in kinds):
        bounds = (None, None, start, end)
    else:
        raise ValueError("start and end must both be pulse ids or both be datetimes")
    seconds = int(ttl.total_seconds())
    rows = []
    for name in channels:
        owner, slash, rest = name.partition("/")
        target = (owner, rest.split("/")[0]) if slash else (backend, name)
        rows.append((rule_seq, *target, *bounds, seconds))
    return rows


def retention_rules(spark: SparkSession, updates: Sequence[tuple], backend: str) -> DataFrame:
    """A rules table from (channels, start, end, ttl) updates in the order they were made."""
    rows = [row for i, update in enumerate(updates) for row in ttl_rule(i, *update, backend)]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def _micros(ts: Column) -> Column:
    return epoch_micros(ts.cast("timestamp_ntz"), ntz=True)


_KEYS = ["axis", "backend", "channel"]


def _levels(ranks: Column) -> Column:
    """The levels, from 0, at which blocks of four to the power of the level fit into that many ranks, and one more."""
    return F.sequence(F.lit(0), F.floor(F.log2(ranks.cast("double")) / 2).cast("int") + 1)


def _ranges(rules: DataFrame) -> DataFrame:
    """Rules as whole-number ranges [lo, end) on the pulse axis ("p") or the time axis ("t", microseconds)."""
    entries = F.array(
        F.struct(F.lit("p").alias("axis"), F.col("start_pulse").alias("lo"), F.col("end_pulse").alias("hi")),
        F.struct(F.lit("t").alias("axis"), _micros(F.col("start_ts")).alias("lo"), _micros(F.col("end_ts")).alias("hi")),
    )
    ranges = rules.select("rule_seq", "backend", "channel", "ttl_s", F.explode(entries).alias("_entry"))
    end = F.least(F.col("_entry.hi"), F.lit(2**63 - 2)) + 1
    return ranges.select("rule_seq", "backend", "channel", "ttl_s", "_entry.axis", "_entry.lo", end.alias("end")).where("lo < end")


def _kept(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`df` filed once, and its number of rows."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    return df, df.count()


def _bounds(ranges: DataFrame, bucket_rows: int) -> DataFrame:
    """The distinct bounds `at` of each axis, backend and channel, with their rank and the `next` one.

    They are ranked by buckets, each with what comes before it: a channel may have most of the rules.
    """
    bounds = ranges.select(*_KEYS, F.explode(F.array("lo", "end")).alias("at"))
    borders = depth_borders(bounds, ["at"], bucket_rows)[0]
    scan = OrderedScan(tuple(_KEYS), "at", borders=borders)
    bounds = dealt(scan.bucketed(bounds), borders.rows, *scan.keys).distinct()
    given = bounds.groupBy(*scan.keys).agg(F.count(F.lit(1)).alias("_n"), F.min("at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(scan.across_before()), F.lit(0).cast("bigint"))
    given = given.select(*scan.keys, before.alias("_before"), F.lead("_first").over(scan.across()).alias("_follow"))
    bounds = bounds.join(given, scan.keys)
    rank = F.col("_before") + F.row_number().over(scan.local()) - 1
    after = F.coalesce(F.lead("at").over(scan.local()), "_follow")
    return bounds.select(*_KEYS, "at", rank.alias("rank"), after.alias("next"))


def _segments(rules: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Disjoint ranges [lo, hi] per axis, backend and channel, each with the newest rule that covers it.

    The bounds of a channel's rules are ranked. A rule is cut into the few aligned blocks of ranks that make it up, of each
    block only its newest rule is kept, and the stretch between two bounds takes the newest rule of the blocks around it.
    Only rules are shuffled here, over as many tasks as they need; of rules with the same number the longer ttl counts.
    """
    # of rules for the same range only the newest can win, and NULL names meet no sample
    named = _ranges(rules).where("backend IS NOT NULL AND channel IS NOT NULL")
    ranges = named.groupBy(*_KEYS, "lo", "end").agg(F.max(F.struct("rule_seq", "ttl_s")).alias("rule"))
    ranges, _ = _kept(ranges, "ranges")
    # read three times below: for both ends of the rules and for the stretches between bounds
    bounds, n = _kept(_bounds(ranges, bucket_rows), "bounds")
    rank = lambda bound: bounds.select(*_KEYS, F.col("at").alias(bound), F.col("rank").alias(f"_{bound}"))
    at = lambda df, bound: dealt(df, n, *_KEYS, bound)
    ranked = at(at(ranges, "lo").join(at(rank("lo"), "lo"), [*_KEYS, "lo"]), "end").join(at(rank("end"), "end"), [*_KEYS, "end"])
    ranked, n_ranked = _kept(ranked.select(*_KEYS, "rule", "_lo", "_end"), "ranked")
    span = F.max(F.col("_end") - F.col("_lo"))
    widest = ranked.groupBy(*_KEYS).agg(span.alias("widest"))
    up = lambda c, level: F.expr(f"-(-{c} >> (2 * ({level})))")  # noqa: E731  rounded up
    down = lambda c, level: F.expr(f"{c} >> (2 * ({level}))")
    # a rule makes some blocks a level, a stretch has a row a level; rules near each other share blocks and meet beforehand
    levels = widest.agg(F.max(F.size(_levels(F.col("widest"))))).first()[0] or 1
    near, block, stretch = ["_near_lo", "_near_end"], ["level", "block"], [*_KEYS, "at", "next"]
    cut = ranked.withColumns({"_near_lo": F.expr("_lo >> 12"), "_near_end": F.expr("_end >> 12")})
    cut = dealt(cut, 4 * levels * n_ranked, *_KEYS, *near)
    cut = cut.select(*_KEYS, *near, "rule", "_lo", "_end", F.explode(_levels(F.col("_end") - F.col("_lo"))).alias("level"))
    cut = cut.withColumn("a", up("_lo", "level")).withColumn("b", down("_end", "level")).where("a < b")
    cut = cut.withColumn("pa", up("_lo", "level + 1") * 4).withColumn("pb", down("_end", "level + 1") * 4)
    # what the next level covers is left to it
    whole = F.sequence(F.col("a"), F.col("b") - 1)
    outside = F.filter(
        F.concat(
            F.sequence(F.col("a"), F.least(F.col("a") + 3, F.col("b") - 1)), F.sequence(F.greatest(F.col("b") - 4, F.col("a")), F.col("b") - 1)
        ),
        lambda n: (n < F.col("pa")) | (n >= F.col("pb")),
    )
    blocks = F.array_distinct(F.when(F.col("pa") < F.col("pb"), outside).otherwise(whole))
    newest = F.max("rule").alias("rule")
    nodes = cut.withColumn("block", F.explode(blocks)).groupBy(*_KEYS, *near, *block).agg(newest)
    nodes = dealt(nodes.drop(*near), levels * n, *_KEYS, *block).groupBy(*_KEYS, *block).agg(newest)
    # no block of a level is wider than the widest rule
    stretches = bounds.where("next IS NOT NULL").join(widest, _KEYS)
    stretches = stretches.select(*stretch, "rank", F.explode(_levels(F.col("widest"))).alias("level"))
    stretches = dealt(stretches.withColumn("block", F.expr("rank >> (2 * level)")).drop("rank"), levels * n, *_KEYS, *block)
    found = dealt(stretches.join(nodes, [*_KEYS, *block]).select(*stretch, "rule"), levels * n, *stretch).groupBy(*stretch).agg(newest)
    return found.select(*_KEYS, F.col("at").alias("lo"), (F.col("next") - 1).alias("hi"), "rule.rule_seq", "rule.ttl_s")


def _as_of(rows: DataFrame, segments: DataFrame, at: str, borders: Borders, out: str, size: int) -> DataFrame:
    """`rows` with `out`, the segment of their backend and channel whose range holds their value of `at`, or NULL.

    Segments are disjoint, so that is the last one that starts at or before the value, if it ends at or behind it. Values
    are cut into blocks of equal depth, and a segment is filed under every block it reaches into: a block then knows all it
    needs, a busy channel is spread over its blocks, and the rows are shuffled once, by (backend, channel, block). `size` is
    the number of rows and segments, which the number of tasks grows with.
    """
    spread = -1 - F.pmod(F.xxhash64("pulse_id", "ts"), F.lit(4096))  # what has no place needs no company
    rows = rows.withColumn("_block", F.coalesce(borders.bucket(F.col(at)), spread)).withColumn("_at", F.col(at))
    rows = rows.withColumn("_sample", F.lit(True))
    blocks = F.sequence(borders.bucket(F.col("lo")), borders.bucket(F.col("hi")))
    filed = segments.select(
        "backend", "channel", F.explode(blocks).alias("_block"), F.col("lo").alias("_at"), F.lit(False).alias("_sample"),
        F.struct("hi", "rule_seq", "ttl_s").alias("_segment"),
    ).where("backend IS NOT NULL AND channel IS NOT NULL")
    both = dealt(rows.unionByName(filed, allowMissingColumns=True), size, "backend", "channel", "_block")
    order = Window.partitionBy("backend", "channel", "_block").orderBy("_at", "_sample")
    last = F.last("_segment", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = both.withColumn("_segment", last).where("_sample")
    held = F.when(F.col("_at") <= F.col("_segment.hi"), F.struct("_segment.rule_seq", "_segment.ttl_s"))
    return both.withColumn(out, held).drop("_block", "_at", "_sample", "_segment")


def apply_retention(
    samples: DataFrame, rules: DataFrame, default_ttl_s: int | None = None, block_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Each sample with the ttl of the latest rule that covers it, and `expires_at`.

    Bounds are inclusive. Samples need `backend`, `channel`, `pulse_id` and `ts` (or the second/nanosecond pair); a NULL in
    one of the first three meets no rule. Rules become disjoint segments first, of pulses and of times; for each kind there
    is, samples meet them in one as-of pass of one shuffle. Samples are neither multiplied nor joined back, so they need no key.
    """
    if "ts" not in samples.columns:
        samples = samples.withColumn("ts", join_ts(F.col("ts_sec"), F.col("ts_ns")))
    # only rules were shuffled up to here; both passes read them
    found, _ = _kept(_segments(rules, block_rows), "segments")
    axes = {r["axis"]: r["count"] for r in found.groupBy("axis").count().collect()}
    rows = samples.withColumn("_p", F.col("pulse_id").cast("bigint")).withColumn("_t", _micros(F.col("ts")))
    wanted = [f"_{axis}" for axis in sorted(axes)]
    winners = []
    for at, borders in zip(wanted, depth_borders(rows, wanted, block_rows) if wanted else []):
        mine = found.where(F.col("axis") == at[1:]).drop("axis")
        rows = _as_of(rows, mine, at, borders, f"_held{at}", borders.rows + axes[at[1:]])
        winners.append(F.col(f"_held{at}"))
    best = F.greatest(*winners) if len(winners) > 1 else winners[0] if winners else F.lit(None).cast("struct<rule_seq: bigint, ttl_s: bigint>")
    ttl = F.coalesce(best["ttl_s"], F.lit(default_ttl_s).cast("bigint"))
    kept = [F.col(f"`{c}`") for c in samples.columns]
    return rows.select(*kept, ttl.alias("ttl_s")).withColumn(
        "expires_at", F.col("ts") + F.make_dt_interval(secs=F.col("ttl_s").cast("decimal(18,6)"))
    )


def purge_expired(
    samples: DataFrame, rules: DataFrame, now: Column | datetime, default_ttl_s: int | None = None
) -> DataFrame:
    """The samples that are still to be kept; without any ttl a sample is kept for good."""
    now = now if isinstance(now, Column) else F.lit(now)
    dated = apply_retention(samples, rules, default_ttl_s)
    return dated.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))
