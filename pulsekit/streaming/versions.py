"""A live archive whose columns may come late and change their definition while the stream runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsekit.functions.types import typed_value
from pulsekit.operators.joins import lookup_join
from pulsekit.operators.scan import OrderedScan
from pulsekit.sources.archive import MAX_VERSIONS
from pulsekit.sources.files import folders, remove

_KEYS = ["stream_id", "channel"]


def _column(channel: str, version: int) -> str:
    return f"{channel}@{version}"


def _ledger(spark: SparkSession, path: str, number: int, schema: T.StructType) -> DataFrame:
    """What the batches up to `number` know: a row per stream, channel and version, with its definition and first row."""
    if number < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/ledger/batch={number}")


def stream_versioned(
    samples: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    max_versions: int = MAX_VERSIONS,
    scan: OrderedScan = OrderedScan(tuple(_KEYS)),
) -> StreamingQuery:
    """Archive live samples, a column for each version of a channel.

    Samples are `stream_id, channel, arrival_seq, pulse_id, type, shape, value` (a value struct or a plain value), in order
    from batch to batch. A channel's version goes up by one where its type or shape differs from the sample before. A ledger
    of versions, with the definition and first row of each, is written with every batch and read by the next, so versions go
    on over restarts, and a repeated batch finds what its first try found. A batch is written with the columns it has;
    late and replaced columns are a matter of schema for the reader, :func:`read_versions`.

    A channel and version that two streams define differently is an error, as is one replaced more than `max_versions` times.
    """
    spec = T.StructType([samples.schema["type"], samples.schema["shape"]])
    by_stream = [samples.schema[c] for c in _KEYS]
    ledger_schema = T.StructType([*by_stream, T.StructField("version", T.IntegerType()), *spec, T.StructField("first", T.LongType())])

    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = _ledger(session, path, number - 1, ledger_schema)
        batch = batch.persist()  # read for its versions and for its rows
        newest = before.groupBy(*_KEYS).agg(F.max("version").alias("_base"), F.max_by(F.struct(*spec.names), "version").alias("_known"))
        slim = batch.select(*_KEYS, scan.order, F.struct(*spec.names).alias("_spec"))
        rows = lookup_join(scan.lag(slim, ["_spec"], "_before"), newest, _KEYS)
        rows = rows.withColumn("_before", F.coalesce("_before", "_known"))
        # a channel listed twice in a message is one row of it
        starts = rows.where(~F.col("_before").eqNullSafe(F.col("_spec"))).dropDuplicates([*_KEYS, scan.order])
        place = F.row_number().over(Window.partitionBy(*_KEYS).orderBy(scan.order))
        starts = starts.select(*_KEYS, (F.coalesce("_base", F.lit(-1)) + place).cast("int").alias("version"), "_spec.*", F.col(scan.order).alias("first"))
        too_many = F.raise_error(F.concat(F.lit("column "), "channel", F.lit(f" replaced more than {max_versions} times"))).cast("int")
        starts = starts.withColumn("version", F.when(F.col("version") > max_versions, too_many).otherwise(F.col("version")))
        here = f"{path}/ledger/batch={number}"
        before.unionByName(starts).coalesce(1).write.mode("overwrite").parquet(here)
        ledger = _ledger(session, path, number, ledger_schema)

        # the versions a batch can hold: those it starts, and the newest of before
        live = ledger.join(newest.select(*_KEYS, "_base"), _KEYS, "left").where("version >= coalesce(_base, 0)")
        listed = live.select("channel", "version", *spec.names).distinct().collect()
        names = [_column(r["channel"], r["version"]) for r in listed]
        for name in names:
            if names.count(name) > 1:
                raise ValueError(f"column {name} has several types or shapes; archive its streams apart")
        changes = live.groupBy(*_KEYS).agg(
            F.min("version").alias("_least"), F.sort_array(F.collect_list("first")).alias("_firsts")
        )
        marked = lookup_join(batch, changes, _KEYS)
        at = F.size(F.filter("_firsts", lambda first: first <= F.col(scan.order))) - 1
        marked = marked.withColumn("_version", F.col("_least") + F.greatest(at, F.lit(0)))
        message = ["stream_id", scan.order, "pulse_id"]
        rank = F.col("ordinal") if "ordinal" in batch.columns else F.lit(0)
        # brought together once: both aggregations below find the rows of a message in one place
        cells = marked.repartition(*message).groupBy(*message, "channel", "_version").agg(F.max_by("value", rank).alias("_value"))
        key = F.concat("channel", F.lit("@"), F.col("_version").cast("string"))
        held = cells.groupBy(*message).agg(F.map_from_entries(F.collect_list(F.struct(key.alias("k"), "_value"))).alias("_cells"))
        is_struct = isinstance(samples.schema["value"].dataType, T.StructType)
        value = lambda r: F.element_at("_cells", F.lit(_column(r["channel"], r["version"])))
        typed = [(typed_value(value(r), r["type"], r["shape"]) if is_struct else value(r)).alias(_column(r["channel"], r["version"])) for r in listed]
        held.select(*message, *typed).write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        batch.unpersist()
        remove(session, f"{path}/ledger/batch={number - 2}")  # a repeated batch needs the ledger before it, nothing older

    writer = samples.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval) if interval else writer
    return writer.foreachBatch(step).start()


def column_versions(spark: SparkSession, path: str) -> DataFrame:
    """The newest ledger of a live archive: stream_id, channel, version, type, shape, first."""
    newest = max(int(name.partition("=")[2]) for name in folders(spark, f"{path}/ledger"))
    return spark.read.parquet(f"{path}/ledger/batch={newest}")


def read_versions(spark: SparkSession, path: str, streams: Sequence[str] | None = None) -> DataFrame:
    """One row per message: `name` for the newest version of a channel, `name(1)`, `name(2)`, ... for those it replaced.

    Rows outside a version's life have NULL in its column. Which version is the newest differs from stream to stream, so
    the streams (all, if not given) are read one by one and put together by column name.
    """
    ledger = column_versions(spark, path)
    listed = ledger.groupBy("stream_id", "channel").agg(F.max("version").alias("last")).collect()
    rows = spark.read.option("mergeSchema", "true").parquet(f"{path}/rows").drop("batch")
    whole = None
    for stream in sorted({r["stream_id"] for r in listed}, key=str) if streams is None else streams:
        mine = [F.col(c) for c in rows.columns[:3]]
        for r in sorted((r for r in listed if r["stream_id"] == stream), key=lambda r: r["channel"]):
            for v in range(r["last"] + 1):
                shown = r["channel"] if v == r["last"] else f"{r['channel']}({v + 1})"
                mine.append(F.col(f"`{_column(r['channel'], v)}`").alias(shown))
        part = rows.where(F.col("stream_id").eqNullSafe(F.lit(stream))).select(*mine)
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole
