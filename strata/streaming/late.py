"""Late-arrival report (batch): how far behind the newest event seen so far
each event arrives, per user, in arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.windows import prefix


def late_event_report(events: DataFrame, key: str, ts: str, arrival: str, delay_seconds: int,
                      bucket_width: int | None = None, bucket_rows: int = 10_000) -> DataFrame:
    """Events that arrive after a newer event of the same key:
    (key, arrival, ts, newest_before, lateness_seconds, behind_watermark).

    ``newest_before`` is the maximum event time over strictly earlier
    arrivals of the key, computed as a bucketed prefix maximum over the
    numeric ``arrival`` order (a hot key is spread over arrival buckets;
    unless given, their width is taken from the range and number of arrivals,
    about ``bucket_rows`` of all rows each).
    ``behind_watermark``: lateness exceeds ``delay_seconds``, i.e. a stream
    with that watermark delay would drop the event.
    """
    t_us: Column = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = events.withColumn("_t_us", t_us)
    if bucket_width is None:
        b = events.agg(F.min(arrival).alias("a"), F.max(arrival).alias("z"), F.count(arrival).alias("n")).first()
        bucket_width = max(1, int((b["z"] - b["a"] + 1) * bucket_rows / b["n"])) if b["n"] else 1
    out = prefix(rows, key, F.col(arrival), arrival, {"_max_before": ("max", F.col("_t_us"))},
                 bucket_width, include_current=False)
    late_us = F.col("_max_before") - F.col("_t_us")
    return (out.filter(late_us > 0)
            .select(key, arrival, ts,
                    F.timestamp_micros("_max_before").cast(events.schema[ts].dataType).alias("newest_before"),
                    (late_us / 1_000_000.0).alias("lateness_seconds"),
                    (late_us > F.lit(delay_seconds * 1_000_000)).alias("behind_watermark")))
