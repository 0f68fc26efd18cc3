"""Date and time helpers.

Event time in the logs is epoch milliseconds.  Every helper takes the time
zone as an argument and works on ``TIMESTAMP_NTZ`` wall clocks, so results do
not depend on ``spark.sql.session.timeZone``.

Fixed values that must match the source system:
* string formats ``yyyy-MM-dd`` and ``yyyy-MM-dd HH:mm:ss``
* the zone of :func:`to_ts` is ``GMT+8``
* one day is 86 400 000 ms
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE_FMT = "yyyy-MM-dd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
PARSE_ZONE = "GMT+8"
DAY_MS = 86_400_000



def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def millis_to_utc_wallclock(ms) -> Column:
    """Epoch ms -> UTC wall clock as TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", _c(ms), _epoch())


def ntz_to_millis(ts) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) -> epoch ms (floor)."""
    return F.timestamp_diff("MILLISECOND", _epoch(), _c(ts))


def wallclock(ms, tz: str = "UTC") -> Column:
    w = millis_to_utc_wallclock(ms)
    if tz.upper() in ("UTC", "GMT", "Z"):
        return w
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), w)


def to_date_str(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` in zone ``tz``."""
    return F.date_format(wallclock(ms, tz), DATE_FMT)


def to_datetime_str(ms, tz: str = "UTC") -> Column:
    """D3: epoch ms -> ``yyyy-MM-dd HH:mm:ss`` in zone ``tz``."""
    return F.date_format(wallclock(ms, tz), DATETIME_FMT)


def previous_day_str(ms, tz: str = "UTC") -> Column:
    """Date of ``ms - 1 day``."""
    return to_date_str(_c(ms) - F.lit(DAY_MS), tz)


def to_ts(s, is_full: bool = True, tz: str = PARSE_ZONE) -> Column:
    """``yyyy-MM-dd[ HH:mm:ss]`` read in ``tz`` -> epoch ms."""
    fmt = DATETIME_FMT if is_full else DATE_FMT
    local = F.to_timestamp_ntz(_c(s), F.lit(fmt))
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    return ntz_to_millis(utc)


def split_list(s, sep: str = ",") -> Column:
    """Comma list -> array; no trimming, as the config rows are read."""
    return F.split(_c(s), sep if sep != "|" else r"\|")


def join_list(arr, sep: str = ",") -> Column:
    """Array -> comma list."""
    return F.array_join(_c(arr), sep)
