"""The ordered plans again with buckets of 512 arrivals, so that streams of the small tables span many buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.operators import continuity, epochs
from pulsekit.operators.scan import OrderedScan
from pulsekit.plans import channels, codec, streams_in_order
from pulsekit.plans.registry import SQL, plan
from pulsekit.plans.views import MESSAGES_SQL, messages

SMALL = OrderedScan(bucket_rows=512)

for _place, _names in (
    (streams_in_order, "d1_continuity_stats e1_classify_pulses e2_schema_epochs e3_gap_report e4_tail_rows e5_trailing e7_idle_gaps b10_every_nth"),
    (channels, "e6_completeness"),
    (codec, "a9_pulse_ids"),
):
    for _name in _names.split():
        _function = getattr(_place, _name)
        plan(f"{_name}_buckets", SQL[_name])(lambda spark, sf_dir, function=_function: function(spark, sf_dir, SMALL))


_GAPPY_SQL = f"""{MESSAGES_SQL},
gappy AS (SELECT stream_id, arrival_seq, CASE WHEN k % 7 <> 0 THEN pulse_id END AS pulse_id,
                 CASE WHEN k % 10 <> 0 THEN header_hash END AS header_hash FROM messages),
lagged AS (SELECT *, lag(header_hash) OVER w AS previous,
                  max(pulse_id) OVER (PARTITION BY stream_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hwm
           FROM gappy WINDOW w AS (PARTITION BY stream_id ORDER BY arrival_seq))"""


@plan(
    "e2_null_headers",
    f"""WITH {_GAPPY_SQL},
flagged AS (SELECT *, header_hash IS DISTINCT FROM previous AS format_changed FROM lagged)
SELECT stream_id, arrival_seq, header_hash, format_changed,
       CAST(sum(CAST(format_changed AS INTEGER)) OVER (PARTITION BY stream_id ORDER BY arrival_seq) AS BIGINT) AS epoch,
       CASE WHEN pulse_id IS NULL THEN 'no_pulse' WHEN hwm IS NULL OR hwm = 0 THEN 'first' WHEN pulse_id = hwm + 1 THEN 'ok'
            WHEN pulse_id = hwm THEN 'duplicated' WHEN pulse_id > hwm THEN 'missed' ELSE 'reverted' END AS kind
FROM flagged""",
)
def e2_null_headers(spark, sf_dir):
    """Epochs and continuity of messages some of which lack their header hash or their pulse id."""
    k = F.col("k")
    gappy = messages(spark, sf_dir).select(
        "stream_id", "arrival_seq", F.when(k % 7 != 0, F.col("pulse_id")).alias("pulse_id"), F.when(k % 10 != 0, F.col("header_hash")).alias("header_hash")
    )
    marked = continuity.classify_pulses(epochs.schema_epochs(gappy, SMALL), SMALL)
    return marked.select("stream_id", "arrival_seq", "header_hash", "format_changed", "epoch", "kind")
