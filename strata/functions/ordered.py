"""Order-deterministic per-group expressions.

``first``/``last``/``collect_list`` without an order depend on shuffle
arrival order. These helpers order by (ts, tiebreak) explicitly; rows with a
NULL timestamp are left out of the path and out of first/last (they are
still counted by the caller).

All three are partial aggregates (map-side combine), so a hot group is
reduced on every map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key(ts: str, tiebreak: str) -> Column:
    return F.when(F.col(ts).isNotNull(), F.struct(F.col(ts).alias("t"), F.col(tiebreak).alias("k")))


def ordered_path(value: str, ts: str, tiebreak: str) -> Column:
    """array<value> ordered by (ts, tiebreak)."""
    item = F.when(F.col(ts).isNotNull(),
                  F.struct(F.col(ts).alias("t"), F.col(tiebreak).alias("k"), F.col(value).alias("v")))
    return F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"])


def first_by_time(value: str, ts: str, tiebreak: str) -> Column:
    return F.min_by(F.col(value), _key(ts, tiebreak))


def last_by_time(value: str, ts: str, tiebreak: str) -> Column:
    return F.max_by(F.col(value), _key(ts, tiebreak))
