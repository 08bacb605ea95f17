"""Zone-independent time from epoch milliseconds, and its calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
# whole milliseconds in the microseconds that 63 bits can count
_MOST_MS = ((1 << 63) - 1) // 1000

# The calendar parts in stored order. ``week`` is the ISO-8601
# week, ``weekday`` runs from 1 for Sunday to 7 for Saturday.
CALENDAR = {
    "hour": F.hour,
    "day": F.dayofmonth,
    "week": F.weekofyear,
    "month": F.month,
    "year": F.year,
    "weekday": F.dayofweek,
}


def epoch_ms_to_timestamp(ms: str | Column) -> Column:
    """UTC wall-clock time of an epoch-millisecond count.

    Integer arithmetic on a zone-less timestamp: exact, and the same on every cluster
    whatever its session time zone. A count beyond what a timestamp can hold, some
    292,000 years either way, gives null, so that one bad line can't end a job.
    """
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.when(ms.between(-_MOST_MS, _MOST_MS), F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH)))


def add_calendar(df: DataFrame, ts_col: str = "start_time") -> DataFrame:
    """Append the six calendar parts of ``ts_col`` in one projection."""
    return df.withColumns({name: part(ts_col) for name, part in CALENDAR.items()})
