"""Scalar column expressions used by the cleaning and gold layers.

Spark 4 runs in ANSI mode: a bad timestamp string or a decimal overflow
raises instead of returning NULL. Data-dependent conversions therefore use
the ``try_*`` forms so one bad row cannot fail a 100 TB job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decision bands of the fraud score (score > 0.8 blocks,
# 0.5 to 0.8 inclusive goes to manual review, below 0.5 is approved).
BLOCK_ABOVE = 0.8
REVIEW_FROM = 0.5
BAND_BLOCK, BAND_REVIEW, BAND_APPROVE = "BLOCK", "REVIEW", "APPROVE"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """String (or timestamp) to timestamp; unparseable values become NULL."""
    c = _c(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def parse_date(c) -> Column:
    """Timestamp or timestamp string to date (time of day dropped)."""
    return F.to_date(parse_timestamp(_c(c).cast("string")))


def trim_columns(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def to_money(c, precision: int = 10, scale: int = 2) -> Column:
    """Double to DECIMAL(p,s), HALF_UP; values that do not fit become NULL."""
    return F.try_cast(_c(c), f"decimal({precision},{scale})") if hasattr(F, "try_cast") \
        else _c(c).try_cast(f"decimal({precision},{scale})")


def cents(c) -> Column:
    """Money as an exact integer number of cents (sums stay exact), rounded
    once, as ``to_money`` rounds it."""
    return (to_money(c, 18, 2) * 100).cast("bigint")


def to_int(c) -> Column:
    return _c(c).cast("int")


def seconds_between(end, start) -> Column:
    """Whole seconds end - start, each side floored to the second first."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))).cast("int")


def seconds_after_or_null(ts, start) -> Column:
    """Seconds from ``start`` to ``ts``; NULL when ``ts`` is NULL, may be negative."""
    return F.when(_c(ts).isNotNull(), seconds_between(ts, start))


def is_present(c) -> Column:
    return _c(c).isNotNull()


def score_band(score) -> Column:
    s = _c(score)
    return (F.when(s > BLOCK_ABOVE, F.lit(BAND_BLOCK))
            .when(s >= REVIEW_FROM, F.lit(BAND_REVIEW))
            .when(s.isNotNull(), F.lit(BAND_APPROVE)))


def session_key(user, ts) -> Column:
    """Session id for sources that carry none: user and calendar day (UTC)."""
    return F.concat(_c(user).cast("string"), F.lit("_"), F.to_date(_c(ts)).cast("string"))


def to_ntz(c) -> Column:
    return _c(c).cast("timestamp_ntz")
