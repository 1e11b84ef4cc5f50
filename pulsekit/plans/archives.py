"""Plans that write an archive into the shared scratch folder and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.operators.align import align_pulses
from pulsekit.plans.registry import plan
from pulsekit.sources.scratch import scratch_dir
from pulsekit.plans.views import CHANNELS, SAMPLES_SQL, samples
from pulsekit.sources import archive

_CELLS = ",\n       ".join(f"arg_max(value, arrival_seq) FILTER (channel = '{c}') AS {c}" for c in CHANNELS)


@plan("a4_compact", f"WITH {SAMPLES_SQL} SELECT pulse_id,\n       {_CELLS}\nFROM samples GROUP BY pulse_id")
def a4_compact(spark, sf_dir):
    path = scratch_dir(spark, "compact")
    archive.write_compact(align_pulses(samples(spark, sf_dir), CHANNELS), path, mode="overwrite")
    return spark.read.parquet(path)


_STORED_SQL = f"""{SAMPLES_SQL},
stored AS (SELECT channel, pulse_id, value AS data, user_id AS "timestamp", arrival_seq * 10 AS timestamp_offset, arrival_seq
           FROM samples)"""


def _stored(spark, sf_dir):
    return samples(spark, sf_dir).select(
        "channel",
        "pulse_id",
        "value",
        F.col("user_id").alias("ts_sec"),
        (F.col("arrival_seq") * 10).alias("ts_ns"),
        "arrival_seq",
    )


@plan("a5_channels", f"WITH {_STORED_SQL} SELECT * FROM stored")
def a5_channels(spark, sf_dir):
    path = scratch_dir(spark, "channels")
    archive.write_channels(_stored(spark, sf_dir), path, mode="overwrite")
    return archive.read_channels(spark, path)


@plan("a5_read_one_channel", f"WITH {_STORED_SQL} SELECT * FROM stored WHERE channel = 'click'")
def a5_read_one_channel(spark, sf_dir):
    path = scratch_dir(spark, "channels")
    archive.write_channels(_stored(spark, sf_dir), path, mode="overwrite")
    return archive.read_channels(spark, path, ["click"])


# Each channel changes its definition twice: on 11 and 21 January.
VERSION_SQL = "CASE WHEN recv_ts < TIMESTAMP '2024-01-11' THEN 1 WHEN recv_ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END"
VERSION_CELLS = ",\n       ".join(
    f"max(CASE WHEN channel = '{c}' AND version = {v} THEN value END) AS \"{c}{'' if v == 3 else f'({v})'}\""
    for c in CHANNELS
    for v in (1, 2, 3)
)


def typed_samples(rows):
    """Samples whose channels have one type until 10 January, another until 20 January and a third from then on."""
    at = F.col("recv_ts")
    epoch = F.when(at < F.lit("2024-01-11").cast("timestamp_ntz"), "int64").when(
        at < F.lit("2024-01-21").cast("timestamp_ntz"), "float32"
    )
    return rows.select(
        "stream_id", "arrival_seq", "pulse_id", "channel", "value",
        epoch.otherwise("float64").alias("type"), F.array(F.lit(1)).alias("shape"),
    )


@plan(
    "a6_versioned",
    f"""WITH {SAMPLES_SQL},
versions AS (SELECT stream_id, arrival_seq, pulse_id, channel, value, {VERSION_SQL} AS version FROM samples)
SELECT stream_id, arrival_seq, pulse_id,
       {VERSION_CELLS}
FROM versions GROUP BY stream_id, arrival_seq, pulse_id""",
)
def a6_versioned(spark, sf_dir):
    path = scratch_dir(spark, "versioned")
    archive.write_versioned(typed_samples(samples(spark, sf_dir)), path, mode="overwrite")
    return spark.read.parquet(path)


@plan(
    "a7_align_schema",
    f"""WITH {SAMPLES_SQL}
SELECT arrival_seq, value, CASE WHEN k < 50 THEN 0 ELSE user_id END AS user_id FROM samples""",
)
def a7_align_schema(spark, sf_dir):
    rows = samples(spark, sf_dir)
    path = scratch_dir(spark, "late")
    rows.where("k < 50").select("arrival_seq", "value").write.mode("overwrite").parquet(f"{path}/early")
    rows.where("k >= 50").select("arrival_seq", "value", "user_id").write.mode("overwrite").parquet(f"{path}/late")
    return archive.align_schema([spark.read.parquet(f"{path}/early"), spark.read.parquet(f"{path}/late")], fill_null=0)
