"""Trace and span ids in one spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarnlog.functions.text import strip


def normalise_span_id(c: Column) -> Column:
    """Trimmed; absent marks become empty, hexadecimal ids lower case, other ids stay."""
    t = strip(F.coalesce(c, F.lit("")))
    return F.when((t == "") | (F.lower(t) == "n/a"), "").when(t.rlike(r"^[0-9A-Fa-f]+\z"), F.lower(t)).otherwise(t)


def normalise_trace_id(c: Column) -> Column:
    """As span ids; ids of exactly 16 hexadecimal digits are padded to 32."""
    t = normalise_span_id(c)
    return F.when(t.rlike(r"^[0-9a-f]{16}\z"), F.lpad(t, 32, "0")).otherwise(t)
