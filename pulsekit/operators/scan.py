"""Ordered scans along a stream, spread over the cluster.

Nearly every question about a pulse stream depends on what came before: the highest pulse so far, the
row index, the previous header. A window over `stream_id` alone would put a whole stream on one task, and
one stream can hold a third of all data. An :class:`OrderedScan` cuts each stream into buckets of
`bucket_rows` consecutive order values instead:

1. a summary per (stream, bucket), by map-side combining aggregation,
2. a window over that summary only, giving each bucket what came before it,
3. a window inside (stream, bucket), combined with what the bucket was given.

The rows are shuffled once, by (stream, bucket). The summary is smaller than the data by a factor of
about `bucket_rows`; whether it is broadcast into the join is left to Spark, which knows its size.
Order values need not be dense: empty buckets do not exist and are skipped. Where they are sparse, as receive times in
nanoseconds, blocks of equal width would hold a row each: :meth:`OrderedScan.fitted` cuts at quantiles instead, so that
buckets hold about `bucket_rows` rows wherever the values lie.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BUCKET_ROWS = 1_000_000
# Quantiles that are asked for; between two of them buckets are of equal width.
QUANTILES = 64
# Rows a task should sort, where the number of tasks has to grow with the rows.
TASK_ROWS = 500_000


@dataclass(frozen=True)
class Borders:
    """Buckets of about equal depth for whole numbers: between neighbouring `cuts` lie `parts` buckets of equal width.
    `rows` is how many values they were made for."""

    cuts: tuple[int, ...]
    parts: int = 1
    rows: int = 0

    def bucket(self, at: Column) -> Column:
        """The bucket of a value, as BIGINT that never falls as the value grows; NULL for NULL."""
        if not self.cuts:
            return F.when(at.isNotNull(), F.lit(0).cast("bigint"))

        def below(low: int, high: int) -> Column:
            """How many cuts are not above the value, if these are `low` to `high`: a tree of comparisons."""
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(at < F.lit(self.cuts[middle]), below(low, middle)).otherwise(below(middle + 1, high))

        last = len(self.cuts)
        base = [0.0, *map(float, self.cuts)]
        scale = [0.0, *[self.parts / max(1.0, float(b) - float(a)) for a, b in zip(self.cuts, self.cuts[1:])], 0.0]
        place = F.when(at.isNotNull(), below(0, last))
        pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), place)
        inside = F.floor((at.cast("double") - pick(base)) * pick(scale))
        return place.cast("bigint") * self.parts + F.least(inside, F.lit(self.parts - 1)).cast("bigint")


def depth_borders(df: DataFrame, columns: Sequence[str], bucket_rows: int = BUCKET_ROWS, quantiles: int = QUANTILES) -> list[Borders]:
    """Borders for BIGINT columns from sketches of their quantiles: one aggregation that combines before its shuffle."""
    shares = F.array(*[F.lit(i / quantiles) for i in range(quantiles + 1)])
    found = df.agg(
        *[F.percentile_approx(F.col(c), shares, F.lit(100 * quantiles)).alias(f"q{i}") for i, c in enumerate(columns)],
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns)],
    ).first()
    made = []
    for i in range(len(columns)):
        cuts = tuple(sorted(set(found[f"q{i}"] or ())))
        n = found[f"n{i}"]
        made.append(Borders(cuts, max(1, -(-n // (max(1, len(cuts) - 1) * bucket_rows))), n))
    return made


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df` by keys over enough tasks to give each about `TASK_ROWS` of its rows; few rows are left to Spark."""
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


@dataclass(frozen=True)
class OrderedScan:
    """`by` names the stream, `order` a BIGINT column that is unique within it."""

    by: tuple[str, ...] = ("stream_id",)
    order: str = "arrival_seq"
    bucket_rows: int = BUCKET_ROWS
    bucket: str = "_bucket"
    borders: Borders | None = None

    def fitted(self, df: DataFrame) -> OrderedScan:
        """The same scan with buckets of about equal depth for the order values of `df`, which are looked at for it."""
        return replace(self, borders=depth_borders(df, [self.order], self.bucket_rows)[0])

    def bucket_of(self) -> Column:
        if self.borders is not None:
            return self.borders.bucket(F.col(f"`{self.order}`"))
        return F.expr(f"`{self.order}` div {self.bucket_rows}L")

    @property
    def keys(self) -> list[str]:
        return [*self.by, self.bucket]

    def bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.bucket, self.bucket_of())

    def gathered(self, df: DataFrame) -> DataFrame:
        """Bucketed rows, brought together by stream and bucket once: what is asked of them bucket by bucket needs no other
        shuffle. Two branches share that one, and the scan below it, if both keep all columns: see :meth:`last_row`."""
        return self.bucketed(df).repartition(*self.keys)

    def last_row(self, df: DataFrame) -> Column:
        """The last row of a bucket as an aggregate: a struct of all columns, so that a summary prunes none of them."""
        return F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.col(self.order))

    def attached(self, rows: DataFrame, given: DataFrame) -> DataFrame:
        """`rows` with what `given` says of their bucket; a NULL stream is a stream like any other."""
        theirs = {k: f"_of_{k}" for k in self.keys}
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(other)) for k, other in theirs.items()])
        return rows.join(given.withColumnsRenamed(theirs), same, "left").drop(*theirs.values())

    def local(self) -> WindowSpec:
        """All rows of a bucket in order."""
        return Window.partitionBy(*self.keys).orderBy(self.order)

    def local_before(self) -> WindowSpec:
        return self.local().rowsBetween(Window.unboundedPreceding, -1)

    def local_until(self) -> WindowSpec:
        return self.local().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def across(self) -> WindowSpec:
        """The buckets of a stream in order; only ever applied to a summary."""
        return Window.partitionBy(*self.by).orderBy(self.bucket)

    def across_before(self) -> WindowSpec:
        return self.across().rowsBetween(Window.unboundedPreceding, -1)

    def with_carry(
        self,
        bucketed: DataFrame,
        summary: dict[str, Column],
        carry: Callable[[DataFrame], dict[str, Column]],
    ) -> DataFrame:
        """Attach to each row what the earlier buckets of its stream amount to.

        `summary` are aggregates per bucket; `carry` turns the summary into window expressions over
        :meth:`across` or :meth:`across_before`.
        """
        per_bucket = bucketed.groupBy(*self.keys).agg(*[c.alias(n) for n, c in summary.items()])
        given = per_bucket.select(*self.keys, *[c.alias(n) for n, c in carry(per_bucket).items()])
        return self.attached(bucketed, given)

    # ---- the scans the operators are made of ----

    def prefix_max(self, df: DataFrame, value: str, out: str) -> DataFrame:
        """Maximum over all earlier rows of the stream, NULL on its first row."""
        rows = self.with_carry(
            self.bucketed(df),
            {"_max": F.max(value)},
            lambda s: {"_carry": F.max("_max").over(self.across_before())},
        )
        local = F.max(value).over(self.local_before())
        return rows.withColumn(out, F.greatest("_carry", local)).drop("_carry", self.bucket)

    def index(self, df: DataFrame, out: str, running: dict[str, str] | None = None) -> DataFrame:
        """Row index from 0 within the stream, and running sums (current row included).

        `running` maps a new column to the BIGINT column it sums.
        """
        running = running or {}
        summary = {"_n": F.count(F.lit(1))}
        summary |= {f"_s_{name}": F.coalesce(F.sum(col), F.lit(0).cast("bigint")) for name, col in running.items()}
        before = self.across_before()
        rows = self.with_carry(
            self.bucketed(df),
            summary,
            lambda s: {f"_c{name}": F.sum(name).over(before) for name in summary},
        )
        zero = F.lit(0).cast("bigint")
        rows = rows.withColumn(
            out, F.coalesce("_c_n", zero) + F.row_number().over(self.local()).cast("bigint") - 1
        )
        for name, col in running.items():
            local = F.coalesce(F.sum(col).over(self.local_until()), zero)
            rows = rows.withColumn(name, F.coalesce(F.col(f"_c_s_{name}"), zero) + local)
        return rows.drop(self.bucket, *[f"_c{name}" for name in summary])

    def lag(self, df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
        """The previous row of the stream: NULL on its first row.

        One column gives its plain previous value, several give a struct. A previous value may be NULL itself.
        """
        value = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
        rows = self.with_carry(
            self.bucketed(df),
            {"_last": F.max_by(F.struct(value.alias("v")), F.col(self.order))},
            lambda s: {"_carry": F.lag("_last").over(self.across())},
        )
        first = F.row_number().over(self.local()) == 1
        before = F.when(first, F.col("_carry.v")).otherwise(F.lag(value).over(self.local()))
        return rows.withColumn(out, before).drop("_carry", self.bucket)

    def last(self, df: DataFrame, n: int, rank: str) -> DataFrame:
        """The last n rows of each stream, ranked from 1 for the newest.

        First the last n of each bucket, then of each stream: both are group limits, which Spark applies before it
        shuffles, so one pass over the rows is enough and no task gathers a stream.
        """
        by_bucket = Window.partitionBy(*self.keys).orderBy(F.desc(self.order))
        by_stream = Window.partitionBy(*self.by).orderBy(F.desc(self.order))
        rows = self.bucketed(df).withColumn(rank, F.row_number().over(by_bucket)).where(F.col(rank) <= n)
        rows = rows.drop(self.bucket).withColumn(rank, F.row_number().over(by_stream))
        return rows.where(F.col(rank) <= n)

    def with_halo(self, df: DataFrame, columns: Sequence[str], n: int, flag: str = "_halo") -> DataFrame:
        """Bucketed rows plus, in each bucket, copies of the `n` rows before it, flagged as halo.

        The copies carry `columns` and the keys only, everything else is NULL. They come from as many
        earlier buckets as it takes. Counts per bucket say which later buckets the end of a bucket reaches, so a
        copy is made for these alone: at most `n` a bucket, whatever `n` is. Drop the flagged rows after use.
        """
        bucketed = self.bucketed(df)
        kept = list(dict.fromkeys([*self.keys, self.order, *columns]))
        upto = F.sum("_n").over(self.across().rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counts = bucketed.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n"))
        counts = counts.select(*self.keys, upto.alias("_end"), F.lead(self.bucket).over(self.across()).alias("_next"))
        # the buckets behind this one and behind those that end within n rows of it, with the rows in between
        near = Window.partitionBy(*self.by).orderBy("_end").rangeBetween(0, max(0, n - 1))
        follow = F.collect_list(F.struct("_next", "_end")).over(near)
        reach = counts.select(*self.keys, F.col("_end").alias("_mine"), follow.alias("_follow"))
        newest_first = Window.partitionBy(*self.keys).orderBy(F.desc(self.order))
        ends = bucketed.select(*kept).withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= n)
        halo = ends.join(reach, self.keys).select(*kept, "_rank", "_mine", F.explode("_follow").alias("_to"))
        halo = halo.where((F.col("_to._end") - F.col("_mine") + F.col("_rank") <= n) & F.col("_to._next").isNotNull())
        halo = halo.withColumn(self.bucket, F.col("_to._next")).select(*kept, F.lit(True).alias(flag))
        return bucketed.withColumn(flag, F.lit(False)).unionByName(halo, allowMissingColumns=True)
