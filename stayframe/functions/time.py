"""Zone-free time arithmetic on TIMESTAMP_NTZ columns.

Windows are anchored on each entity's own start time, so ``F.window`` (anchored
on the epoch) does not apply.  Differences are taken in microseconds so a
reading exactly on a boundary belongs to the next window and sub-second parts
are never truncated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def elapsed_micros(start, end) -> Column:
    """``end - start`` in microseconds (long), zone-free for NTZ inputs."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def window_index(start, ts, window_seconds: int) -> Column:
    """0-based tumbling-window index of ``ts`` counted from ``start``."""
    w = F.lit(int(window_seconds) * 1_000_000)
    return F.floor(elapsed_micros(start, ts) / w).cast("int")


def add_seconds(ts, seconds) -> Column:
    """``ts + seconds`` keeping the NTZ type; ``seconds`` may be a column."""
    q = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_add("SECOND", q.cast("long"), _c(ts))


def iso_string(ts) -> Column:
    """ISO-8601 text as Python's ``isoformat`` writes it: the fraction only
    when non-zero, then always six digits."""
    t = _c(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.date_format(t, "SSSSSS") == F.lit("000000"), whole).otherwise(frac)


def parse_ntz(text) -> Column:
    """ISO (``T`` separator) or ``YYYY-MM-DD HH:MM:SS[.ffffff]`` text to
    TIMESTAMP_NTZ; unparseable text gives NULL instead of failing the job."""
    return _c(text).try_cast("timestamp_ntz")


def truncate_hour(ts) -> Column:
    """Hour floor of an NTZ timestamp without passing through a time zone."""
    t = _c(ts)
    return F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0)
    )
