"""Query shapes over the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def between(events: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of a time window, both ends included; the day partition is filtered too where the table has one."""
    ts = F.col("timestamp")
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    keep = ts.between(lo, hi)
    if "event_date" in events.columns:
        keep = keep & F.col("event_date").between(F.lit(start[:10]).cast("date"), F.lit(end[:10]).cast("date"))
    return events.where(keep)


def errors_by_service(events: DataFrame) -> DataFrame:
    return events.where("level = 'ERROR'").groupBy("service_name").agg(F.count(F.lit(1)).alias("n_errors"))


def by_trace(events: DataFrame, trace_id: str) -> DataFrame:
    return events.where(F.col("trace_id") == trace_id).orderBy("timestamp")


def around_trace(events: DataFrame, trace_id: str, at: str, minutes: int = 2) -> DataFrame:
    """Rows of a trace within some minutes of a time."""
    mid = F.lit(at).cast("timestamp_ntz")
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return events.where((F.col("trace_id") == trace_id) & F.col("timestamp").between(mid - gap, mid + gap))


def failed_requests(events: DataFrame, logger: str = "gin") -> DataFrame:
    return events.where((F.col("logger") == logger) & (F.col("level") == "ERROR"))


def tokens(message: Column) -> Column:
    """Lower-case words; every ASCII character but letters and digits separates."""
    return F.split(F.lower(message), r"[\x00-\x7F&&[^a-z0-9]]+")


def has_token(message: Column, token: str) -> Column:
    return F.array_contains(tokens(message), token.lower())


def has_text(message: Column, text: str) -> Column:
    return F.contains(F.lower(message), F.lit(text.lower()))


def token_index(events: DataFrame, id_col: str) -> DataFrame:
    """``token, id``: an inverted index for repeated searches."""
    found = events.select(F.explode(F.array_distinct(tokens(F.col("message")))).alias("token"), F.col(id_col).alias("id"))
    return found.where("token <> ''")
