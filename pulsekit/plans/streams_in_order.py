"""Plans over the message view: continuity, epochs, rates, filters and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.operators import continuity, epochs, rates, select
from pulsekit.operators.scan import OrderedScan
from pulsekit.plans.registry import plan
from pulsekit.plans.views import MESSAGES_SQL, messages

_BEFORE = "OVER (PARTITION BY stream_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

CLASSIFIED_SQL = f"""
{MESSAGES_SQL},
marked AS (SELECT *, max(pulse_id) {_BEFORE} AS hwm FROM messages),
classified AS (
  SELECT stream_id, arrival_seq, pulse_id, hwm,
         CASE WHEN hwm IS NULL OR hwm = 0 THEN 'first' WHEN pulse_id = hwm + 1 THEN 'ok'
              WHEN pulse_id = hwm THEN 'duplicated' WHEN pulse_id > hwm THEN 'missed' ELSE 'reverted' END AS kind,
         CASE WHEN hwm <> 0 AND pulse_id > hwm + 1 THEN pulse_id - hwm - 1 ELSE 0 END AS missed,
         CAST(CASE WHEN hwm <> 0 AND pulse_id = hwm THEN 1 ELSE 0 END AS BIGINT) AS duplicated,
         CAST(CASE WHEN hwm <> 0 AND pulse_id < hwm THEN 1 ELSE 0 END AS BIGINT) AS reverted
  FROM marked)
"""

STATS_SQL = f"""WITH {CLASSIFIED_SQL}
SELECT stream_id, count(*) AS messages, CAST(sum(missed) AS BIGINT) AS missed,
       CAST(sum(duplicated) AS BIGINT) AS duplicated, CAST(sum(reverted) AS BIGINT) AS reverted
FROM classified GROUP BY stream_id"""


@plan("d1_continuity_stats", STATS_SQL)
def d1_continuity_stats(spark, sf_dir, scan=OrderedScan()):
    return continuity.continuity_stats(messages(spark, sf_dir), scan)


@plan("e1_classify_pulses", f"WITH {CLASSIFIED_SQL} SELECT * FROM classified")
def e1_classify_pulses(spark, sf_dir, scan=OrderedScan()):
    slim = messages(spark, sf_dir).select("stream_id", "arrival_seq", "pulse_id")
    return continuity.classify_pulses(slim, scan)


@plan(
    "e3_gap_report",
    f"""WITH {CLASSIFIED_SQL}
SELECT stream_id, arrival_seq, hwm + 1 AS expected, pulse_id AS received, missed AS n_missing
FROM classified WHERE missed > 0""",
)
def e3_gap_report(spark, sf_dir, scan=OrderedScan()):
    return continuity.gap_report(messages(spark, sf_dir), scan)


@plan(
    "e3_gap_ids",
    f"""WITH {CLASSIFIED_SQL}
SELECT stream_id, arrival_seq, hwm + 1 AS expected, pulse_id AS received, missed AS n_missing,
       unnest(range(hwm + 1, pulse_id)) AS missing_id
FROM classified WHERE missed > 0""",
)
def e3_gap_ids(spark, sf_dir):
    return continuity.gap_report(messages(spark, sf_dir), ids=True)


@plan(
    "e7_idle_gaps",
    f"""WITH {MESSAGES_SQL},
lagged AS (SELECT stream_id, arrival_seq, recv_ts,
                  lag(recv_ts) OVER (PARTITION BY stream_id ORDER BY arrival_seq) AS previous_ts FROM messages)
SELECT stream_id, arrival_seq, recv_ts, previous_ts, date_diff('microsecond', previous_ts, recv_ts) AS idle_us
FROM lagged WHERE date_diff('microsecond', previous_ts, recv_ts) > 60000000""",
)
def e7_idle_gaps(spark, sf_dir, scan=OrderedScan()):
    return continuity.idle_gaps(messages(spark, sf_dir), timeout_ms=60_000, scan=scan)


EPOCHS_SQL = f"""
{MESSAGES_SQL},
lagged AS (SELECT *, lag(header_hash) OVER (PARTITION BY stream_id ORDER BY arrival_seq) AS previous FROM messages),
flagged AS (SELECT *, header_hash IS DISTINCT FROM previous AS format_changed FROM lagged)
"""


@plan(
    "e2_schema_epochs",
    f"""WITH {EPOCHS_SQL}
SELECT stream_id, arrival_seq, header_hash, format_changed,
       CAST(sum(CAST(format_changed AS INTEGER)) OVER (PARTITION BY stream_id ORDER BY arrival_seq) AS BIGINT) AS epoch
FROM flagged""",
)
def e2_schema_epochs(spark, sf_dir, scan=OrderedScan()):
    slim = messages(spark, sf_dir).select("stream_id", "arrival_seq", "header_hash")
    return epochs.schema_epochs(slim, scan)


@plan(
    "e4_tail_rows",
    f"""WITH {EPOCHS_SQL},
newest AS (SELECT stream_id, max(arrival_seq) AS since FROM flagged WHERE format_changed GROUP BY stream_id),
ranked AS (SELECT stream_id, arrival_seq, header_hash, pulse_id,
                  row_number() OVER (PARTITION BY stream_id ORDER BY arrival_seq DESC) AS rn FROM messages)
SELECT r.stream_id, r.arrival_seq, r.header_hash, r.pulse_id
FROM ranked r JOIN newest n ON r.stream_id = n.stream_id WHERE rn <= 20 AND arrival_seq >= since""",
)
def e4_tail_rows(spark, sf_dir, scan=OrderedScan()):
    slim = messages(spark, sf_dir).select("stream_id", "arrival_seq", "header_hash", "pulse_id")
    return epochs.tail_rows(slim, 20, scan)


@plan(
    "e5_trailing",
    f"""WITH {MESSAGES_SQL}
SELECT stream_id, arrival_seq, value,
       list(value) OVER (PARTITION BY stream_id ORDER BY arrival_seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS trail
FROM messages""",
)
def e5_trailing(spark, sf_dir, scan=OrderedScan()):
    slim = messages(spark, sf_dir).select("stream_id", "arrival_seq", "value")
    return epochs.trailing(slim, "value", 10, scan)


@plan(
    "d2_volume",
    f"""WITH {MESSAGES_SQL}
SELECT stream_id, count(*) AS messages, CAST(sum(n_bytes) AS BIGINT) AS n_bytes,
       round(sum(n_bytes) / 1048576.0, 6) AS mb
FROM messages GROUP BY stream_id""",
)
def d2_volume(spark, sf_dir):
    return rates.volume(messages(spark, sf_dir)).withColumn("mb", F.round("mb", 6))


@plan(
    "d3_rates",
    f"""WITH {MESSAGES_SQL},
numbered AS (
  SELECT stream_id, arrival_seq, recv_ts,
         row_number() OVER w - 1 AS idx, CAST(sum(n_bytes) OVER w AS BIGINT) AS total_bytes
  FROM messages WINDOW w AS (PARTITION BY stream_id ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING)),
shown AS (
  SELECT *, lag(idx) OVER w AS p_idx, lag(total_bytes) OVER w AS p_bytes,
         date_diff('microsecond', lag(recv_ts) OVER w, recv_ts) / 1e6 AS dt
  FROM numbered WHERE idx % 100 = 0 WINDOW w AS (PARTITION BY stream_id ORDER BY arrival_seq))
SELECT stream_id, arrival_seq, idx, recv_ts, total_bytes,
       round((idx - p_idx) / dt, 6) AS message_rate,
       round((total_bytes - p_bytes) / dt * 8 / 1048576, 6) AS receive_mbps
FROM shown""",
)
def d3_rates(spark, sf_dir):
    shown = rates.rates(messages(spark, sf_dir), n=100)
    return shown.withColumn("message_rate", F.round("message_rate", 6)).withColumn(
        "receive_mbps", F.round("receive_mbps", 6)
    )


@plan(
    "d7_latency_summary",
    """WITH receipts AS (
  SELECT user_id AS run_id, event_id AS arrival_seq, CAST(round(value * 100) AS BIGINT) AS latency FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY arrival_seq) AS rn FROM receipts),
runs AS (
  SELECT run_id, max(CASE WHEN rn = 1 THEN latency END) AS first_latency,
         avg(CASE WHEN rn > 1 THEN latency END) AS later_latency
  FROM ranked GROUP BY run_id)
SELECT count(*) AS n_runs, round(avg(first_latency), 6) AS first_latency,
       round(avg(later_latency), 6) AS later_latency, round(1 / avg(later_latency), 6) AS later_frequency
FROM runs""",
)
def d7_latency_summary(spark, sf_dir):
    receipts = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("arrival_seq"),
        F.round(F.col("value") * 100).cast("bigint").alias("latency"),
    )
    summary = rates.latency_summary(receipts)
    return summary.select(
        "n_runs", *[F.round(c, 6).alias(c) for c in ("first_latency", "later_latency", "later_frequency")]
    )


# ---- filters and projections ----


@plan(
    "b4_filter",
    f"WITH {MESSAGES_SQL} SELECT stream_id, arrival_seq, pulse_id, value FROM messages WHERE value <= 4 AND k >= 50",
)
def b4_filter(spark, sf_dir):
    found = select.filter_messages(messages(spark, sf_dir), (F.col("value") <= 4) & (F.col("k") >= 50))
    return found.select("stream_id", "arrival_seq", "pulse_id", "value")


@plan(
    "b5_first_match",
    f"""WITH {MESSAGES_SQL}
SELECT stream_id, arrival_seq, pulse_id, value FROM messages WHERE value > 50 ORDER BY arrival_seq LIMIT 1""",
)
def b5_first_match(spark, sf_dir):
    return select.first_match(messages(spark, sf_dir), F.col("value") > 50).select(
        "stream_id", "arrival_seq", "pulse_id", "value"
    )


@plan(
    "b5_first_match_per_stream",
    f"""WITH {MESSAGES_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY arrival_seq) AS rn
           FROM messages WHERE value > 50)
SELECT stream_id, arrival_seq, pulse_id, value FROM ranked WHERE rn = 1""",
)
def b5_first_match_per_stream(spark, sf_dir):
    slim = messages(spark, sf_dir).select("stream_id", "arrival_seq", "pulse_id", "value")
    return select.first_match(slim, F.col("value") > 50, per_stream=True)


_STATUS_SQL = f"""{MESSAGES_SQL},
received AS (
  SELECT stream_id, arrival_seq, pulse_id, CASE WHEN k % 10 = 0 THEN '' ELSE header_hash END AS header_hash,
         CASE WHEN k % 7 = 0 THEN 'no_channels' WHEN k % 7 = 1 THEN 'empty_header' ELSE 'ok' END AS status
  FROM messages)"""


def _received(spark, sf_dir):
    k = F.col("k")
    return messages(spark, sf_dir).select(
        "stream_id",
        "arrival_seq",
        "pulse_id",
        F.when(k % 10 == 0, "").otherwise(F.col("header_hash")).alias("header_hash"),
        F.when(k % 7 == 0, "no_channels").when(k % 7 == 1, "empty_header").otherwise("ok").alias("status"),
    )


@plan("b9_valid", f"WITH {_STATUS_SQL} SELECT * FROM received WHERE status = 'ok' AND header_hash <> ''")
def b9_valid(spark, sf_dir):
    return select.valid_messages(_received(spark, sf_dir))


@plan(
    "f2_take",
    f"""WITH {_STATUS_SQL}
SELECT * FROM received WHERE status = 'ok' AND header_hash <> '' ORDER BY arrival_seq LIMIT 100""",
)
def f2_take(spark, sf_dir):
    return select.take_messages(_received(spark, sf_dir), 100)


@plan(
    "b10_every_nth",
    f"""WITH {MESSAGES_SQL},
numbered AS (SELECT stream_id, arrival_seq, pulse_id,
                    row_number() OVER (PARTITION BY stream_id ORDER BY arrival_seq) - 1 AS idx FROM messages)
SELECT * FROM numbered WHERE idx % 7 = 0""",
)
def b10_every_nth(spark, sf_dir, scan=OrderedScan()):
    return select.every_nth(messages(spark, sf_dir).select("stream_id", "arrival_seq", "pulse_id"), 7, scan)


_ENVELOPE_SQL = f"""{MESSAGES_SQL},
stamped AS (SELECT *, epoch_us(recv_ts) // 1000000 AS global_sec, epoch_us(recv_ts) % 1000000 * 1000 AS global_ns
            FROM messages)"""


def _stamped(spark, sf_dir):
    from pulsekit.functions.timestamps import split_ts

    sec, ns = split_ts(F.col("recv_ts"), ntz=True)
    return messages(spark, sf_dir).withColumn("global_sec", sec).withColumn("global_ns", ns)


@plan(
    "b11_envelope",
    f"""WITH {_ENVELOPE_SQL}
SELECT pulse_id, global_sec AS global_timestamp, global_ns AS global_timestamp_offset FROM stamped""",
)
def b11_envelope(spark, sf_dir):
    return select.envelope(_stamped(spark, sf_dir))


@plan(
    "b12_render",
    f"""WITH {_ENVELOPE_SQL}
SELECT CAST(pulse_id AS VARCHAR) AS pulse_id, CAST(global_sec AS VARCHAR) AS global_timestamp,
       CAST(global_ns AS VARCHAR) AS global_timestamp_offset,
       coalesce(CASE WHEN k >= 30 THEN CAST(k AS VARCHAR) END, 'None') AS k, stream_id AS origin
FROM stamped""",
)
def b12_render(spark, sf_dir):
    wide = _stamped(spark, sf_dir).select(
        "pulse_id",
        "global_sec",
        "global_ns",
        F.when(F.col("k") >= 30, F.col("k")).alias("k"),
        F.col("stream_id").alias("origin"),
        "value",
    )
    return select.render_rows(wide, ["k", "origin"])


@plan(
    "f1_in_order",
    f"WITH {MESSAGES_SQL} SELECT stream_id, arrival_seq, pulse_id FROM messages ORDER BY stream_id, arrival_seq",
)
def f1_in_order(spark, sf_dir):
    return select.in_order(messages(spark, sf_dir).select("stream_id", "arrival_seq", "pulse_id"))


@plan(
    "i5_late_rows",
    f"""WITH {CLASSIFIED_SQL}
SELECT stream_id, kind, count(*) AS n FROM classified GROUP BY stream_id, kind""",
)
def i5_late_rows(spark, sf_dir):
    slim = messages(spark, sf_dir).select("stream_id", "arrival_seq", "pulse_id")
    return continuity.classify_pulses(slim).groupBy("stream_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "j1_udf_filter",
    f"WITH {MESSAGES_SQL} SELECT stream_id, arrival_seq, k, value FROM messages WHERE value * 2 > k",
)
def j1_udf_filter(spark, sf_dir):
    slim = messages(spark, sf_dir).select("stream_id", "arrival_seq", "k", "value")
    return select.filter_messages(slim, lambda rows: rows["value"] * 2 > rows["k"])
