"""Epoch milliseconds, event time and calendar columns.

All of these follow the session time zone; :func:`tickloom.session.pin_utc` sets it to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seconds of 0001-01-01 and 9999-12-31T23:59:59, the span a TIMESTAMP can print.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def event_time(epoch_ms: Column, precision: str = "second") -> Column:
    """Turn epoch milliseconds into a TIMESTAMP.

    ``second`` drops the millisecond part, ``millisecond`` keeps it. A value outside the
    years 1 to 9999 gives NULL: under ANSI mode the conversion would otherwise raise an
    overflow, and one bad message would stop a stream for good.
    """
    seconds = F.call_function("div", epoch_ms, F.lit(1000))
    if precision == "second":
        moment = F.timestamp_seconds(seconds)
    elif precision == "millisecond":
        moment = F.timestamp_millis(epoch_ms)
    else:
        raise ValueError(f"precision must be 'second' or 'millisecond', not {precision!r}")
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), moment)


def calendar_parts(moment: Column) -> dict[str, Column]:
    """Calendar columns of a TIMESTAMP; ``weekday`` counts from 1 = Sunday."""
    return {
        "year": F.year(moment),
        "month": F.month(moment),
        "day": F.dayofmonth(moment),
        "hour": F.hour(moment),
        "minute": F.minute(moment),
        "weekday": F.dayofweek(moment),
    }


def whole_seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in whole seconds, each side cut to the second first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def instant(now: str | None) -> Column:
    """Processing time, or a fixed instant so that a result can be repeated."""
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
