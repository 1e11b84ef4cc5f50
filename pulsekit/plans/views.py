"""The driver tables seen as pulse-synchronous data, in Spark and as the same SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def as_messages(events: DataFrame) -> DataFrame:
    """Events as the envelope of messages; the jitter k % 11 makes real gaps, repeats and reverts."""
    return events.select(
        F.col("event_type").alias("stream_id"),
        F.col("event_id").alias("arrival_seq"),
        F.col("ts").alias("recv_ts"),
        _k().alias("k"),
        (F.col("event_id") + _k() % 11).alias("pulse_id"),
        F.md5(F.floor(_k() / 50).cast("int").cast("string").cast("binary")).alias("header_hash"),
        F.length("props").cast("bigint").alias("n_bytes"),
        F.col("value").alias("value"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(table(spark, sf_dir, "events"))


MESSAGES_SQL = """
messages AS (
  SELECT event_type AS stream_id, event_id AS arrival_seq, ts AS recv_ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_id + CAST(json_extract_string(props, '$.k') AS INTEGER) % 11 AS pulse_id,
         md5(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) // 50 AS VARCHAR)) AS header_hash,
         CAST(length(props) AS BIGINT) AS n_bytes, value
  FROM events)
"""


def as_samples(events: DataFrame) -> DataFrame:
    """Events as samples: five channels, five arrivals per pulse, so pulses miss and repeat channels."""
    return events.select(
        F.lit("s").alias("stream_id"),
        F.col("event_id").alias("arrival_seq"),
        F.expr("event_id div 5L").alias("pulse_id"),
        F.col("event_type").alias("channel"),
        F.col("value").alias("value"),
        F.col("ts").alias("recv_ts"),
        _k().alias("k"),
        F.col("user_id").alias("user_id"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_samples(table(spark, sf_dir, "events"))


SAMPLES_SQL = """
samples AS (
  SELECT 's' AS stream_id, event_id AS arrival_seq, event_id // 5 AS pulse_id, event_type AS channel,
         value, ts AS recv_ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id
  FROM events)
"""

# The five event types of the tables, in alphabetical order; the fixed channel set of wide plans.
CHANNELS = ["click", "error", "purchase", "signup", "view"]
