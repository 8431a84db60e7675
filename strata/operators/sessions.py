"""Per-session aggregation of cleaned events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.ordered import first_by_time, last_by_time, ordered_path
from strata.functions.scalar import seconds_between

SESSION_KEYS = ["session_id", "user_id"]


def session_aggregate(events: DataFrame, keys=SESSION_KEYS, ts: str = "event_timestamp",
                      event_id: str = "event_id", event_type: str = "event_type",
                      with_path: bool = True) -> DataFrame:
    """One row per session: start, end, event count, ordered path,
    first/last event type, duration and session date.

    Every aggregate is partial (combined on the map side before the shuffle
    on the session key), so a session holding a large share of the rows is
    reduced on each map task first. The path is the only output whose size
    grows with the session; ``with_path=False`` leaves it out.
    """
    aggs = [
        F.min(ts).alias("session_start_time"),
        F.max(ts).alias("session_end_time"),
        F.count(event_id).alias("total_events"),
        first_by_time(event_type, ts, event_id).alias("first_event_type"),
        last_by_time(event_type, ts, event_id).alias("last_event_type"),
    ]
    if with_path:
        aggs.insert(3, ordered_path(event_type, ts, event_id).alias("event_types"))
    return (events.groupBy(*keys).agg(*aggs)
            .withColumn("session_duration_seconds",
                        seconds_between("session_end_time", "session_start_time"))
            .withColumn("session_date", F.to_date("session_start_time")))


def session_min_max_count(events: DataFrame, keys=SESSION_KEYS, ts: str = "event_timestamp",
                          event_id: str = "event_id") -> DataFrame:
    return events.groupBy(*keys).agg(
        F.min(ts).alias("session_start_time"),
        F.max(ts).alias("session_end_time"),
        F.count(event_id).alias("total_events"))
