"""Time expressions that do not depend on the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English month names as logs print them.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

DAY_MS = 86_400_000


def ntz_ms(ts: Column) -> Column:
    """Milliseconds from 1970 to a wall clock value, truncated, as if the clock ran on UTC."""
    ts = ts.cast("timestamp_ntz")
    day = F.unix_date(ts.cast("date")).cast("long") * DAY_MS
    whole = F.hour(ts).cast("long") * 3_600_000 + F.minute(ts).cast("long") * 60_000
    return day + whole + F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("long")


def ntz_of_ms(ms: Column) -> Column:
    """The wall clock value of :func:`ntz_ms`."""
    seconds = (F.pmod(ms, F.lit(DAY_MS)) / 1000).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.floor(ms / DAY_MS).cast("int"), F.lit(0), F.lit(0), seconds)


def month_number(name: Column) -> Column:
    """1 to 12 for an English month name of three letters, else null."""
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
    return F.when(at > 0, at.cast("int"))


def wall_clock(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    """A TIMESTAMP_NTZ to the second, null where the calendar or the clock has no such value.

    The fields (digits as text, or integers) are read once each, so the expression stays small.
    """
    text = lambda c: c.cast("string")
    return F.concat(text(y), F.lit("-"), text(mo), F.lit("-"), text(d), F.lit(" "), text(h), F.lit(":"), text(mi), F.lit(":"), text(s)).try_cast("timestamp_ntz")


def zoned_ms(local: Column, zone: Column) -> Column:
    """UTC milliseconds of a wall clock value (to the second) in an IANA zone.

    A reading that occurs twice means the earlier instant. One that does not occur takes the
    offset that the zone has at the same value read as UTC.
    """
    utc = F.convert_timezone(zone, F.lit("UTC"), local)
    back = F.convert_timezone(F.lit("UTC"), zone, utc)
    shift = ntz_ms(F.convert_timezone(F.lit("UTC"), zone, local)) - ntz_ms(local)
    return F.when(back == local, ntz_ms(utc)).otherwise(ntz_ms(local) - shift)


def offset_minutes(text: Column) -> Column:
    """Minutes of ``+hh:mm`` or ``+hhmm``; null for other texts and for 24 hours or more."""
    sign = F.when(text.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(F.substring(text, 2, 5), ":", "")
    h, m = F.substring(digits, 1, 2).try_cast("int"), F.substring(digits, 3, 2).try_cast("int")
    return F.when(text.rlike(r"^[+-][0-9]{2}:?[0-9]{2}\z") & (h < 24) & (m < 60), sign * (h * 60 + m))
