"""Events as JSON rows and as text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlog.functions.timefmt import ntz_ms, zoned_ms
from tarnlog.schema import CORE


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``, truncated."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def timestamp_with_offset(ts: Column, zone: str) -> Column:
    """The wall clock text with the zone's offset after it; the clock itself stays as it is."""
    whole = F.date_trunc("second", ts)
    minutes = ((ntz_ms(whole) - zoned_ms(whole.cast("timestamp_ntz"), F.lit(zone))) / 60_000).cast("int")
    size = F.abs(minutes)
    return F.concat(timestamp_text(ts), F.when(minutes < 0, "-").otherwise("+"), F.lpad(F.floor(size / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((size % 60).cast("string"), 2, "0"))


def json_rows(events: DataFrame, zone: str | None = None) -> DataFrame:
    """``value``: a JSON object per event: the core columns in order, then the others by name.

    Null values are left out, so they take the default of the table they are loaded into.
    """
    ts = timestamp_with_offset(F.col("timestamp"), zone) if zone else timestamp_text(F.col("timestamp"))
    rest = sorted(c for c in events.columns if c not in CORE)
    columns = [ts.alias("timestamp"), *[F.col(c) for c in CORE[1:]], *[F.col(c) for c in rest]]
    return events.select(F.to_json(F.struct(*columns)).alias("value"))


def text_rows(events: DataFrame) -> DataFrame:
    """``value``: a readable line per event."""
    line = F.format_string(
        "%s [TID:%s] [SpanID:%s] [%s] %-5s %s -%s", timestamp_text(F.col("timestamp")), *[F.col(c) for c in ("trace_id", "span_id", "thread", "level", "logger", "message")]
    )
    return events.select(line.alias("value"))
