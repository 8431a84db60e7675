"""Column expressions (all JVM-side built-ins, no UDFs)."""

from strata.functions.scalar import (  # noqa: F401
    parse_timestamp, parse_date, trim_columns, to_money, to_int, seconds_between,
    seconds_after_or_null, is_present, score_band, session_key, to_ntz, cents,
)
from strata.functions.ordered import (  # noqa: F401
    ordered_path, first_by_time, last_by_time,
)
