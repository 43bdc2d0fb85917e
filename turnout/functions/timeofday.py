"""Time-of-day arithmetic on epoch milliseconds.

Everything is integer arithmetic on the epoch, so results do not depend on the
session time zone (the engine's convention is UTC).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def idiv(a: Column, b: int) -> Column:
    """Floor division of a non-negative long by a constant."""
    return F.floor(a / F.lit(b)).cast("long")


def second_of_day(ms: Column) -> Column:
    return F.pmod(idiv(ms, 1000), F.lit(DAY_SECONDS))


def hour_of(ms: Column) -> Column:
    return idiv(second_of_day(ms), 3600)


def time_of_day(ms: Column) -> Column:
    """``HH:mm:ss``, fraction of a second cut."""
    s = second_of_day(ms)
    return F.format_string("%02d:%02d:%02d", idiv(s, 3600), F.pmod(idiv(s, 60), F.lit(60)), F.pmod(s, F.lit(60)))


def rounded_minute_of_day(ms: Column) -> Column:
    """Minute of day, seconds >= 30 round up, carried into the hour and kept inside the day."""
    s = second_of_day(ms)
    m = idiv(s, 60) + F.when(F.pmod(s, F.lit(60)) >= 30, 1).otherwise(0)
    return F.least(m, F.lit(DAY_SECONDS // 60 - 1))


def minute_key(ms: Column, carry: bool = True) -> Column:
    """``HH:mm`` rounded to the nearest minute.

    ``carry=False`` reproduces the published behaviour where minute 59 rounded up
    prints as ``HH:60``.
    """
    if carry:
        m = rounded_minute_of_day(ms)
        return F.format_string("%02d:%02d", idiv(m, 60), F.pmod(m, F.lit(60)))
    s = second_of_day(ms)
    minute = F.pmod(idiv(s, 60), F.lit(60)) + F.when(F.pmod(s, F.lit(60)) >= 30, 1).otherwise(0)
    return F.format_string("%02d:%02d", idiv(s, 3600), minute)


def truncated_minute_key(ms: Column) -> Column:
    """history times are cut to the minute."""
    s = second_of_day(ms)
    return F.format_string("%02d:%02d", idiv(s, 3600), F.pmod(idiv(s, 60), F.lit(60)))


def hour_12h(hour: str) -> Column:
    """24-hour int column -> ``hh AM``/``hh PM`` (0 -> 12 AM, 12 -> 12 PM)."""
    h = f"pmod({hour}, 12)"
    return F.expr(f"format_string('%02d %s', CASE WHEN {h} = 0 THEN 12 ELSE {h} END, "
                  f"CASE WHEN {hour} < 12 THEN 'AM' ELSE 'PM' END)")


def ampm_hour(label: str, legacy: bool = False) -> Column:
    """``h AM/PM`` column -> sort key.

    ``legacy=True`` reproduces the published ordering, which adds 12 to every PM
    hour and none to AM, so 12 PM sorts as 24 and 12 AM as 12.
    """
    n = f"try_cast(substring_index({label}, ' ', 1) AS BIGINT)"
    am, pm = (n, f"{n} + 12") if legacy else (f"pmod({n}, 12)", f"pmod({n}, 12) + 12")
    return F.expr(f"CASE WHEN locate(' AM', {label}) > 0 THEN {am} WHEN locate(' PM', {label}) > 0 THEN {pm} "
                  f"ELSE 0 END")


def next_hour_slot(ts: Column) -> Column:
    """F16: the next full hour after ``ts`` (argument, not the wall clock)."""
    return F.date_trunc("hour", ts + F.expr("INTERVAL 1 HOUR"))
