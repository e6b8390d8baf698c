"""The fixed record, and the raw line that it is parsed from."""

from __future__ import annotations

from pyspark.sql import types as T

#: Names and order of the record's columns.
CORE = ["timestamp", "level", "trace_id", "span_id", "thread", "logger", "message", "file", "host"]
SHARED = ["stream", "namespace", "pod", "container", "service_name"]
#: Order of the columns of a table; static fields stand before ``file``.
TABLE_ORDER = ["timestamp", "service_name", "level", "logger", "thread", "trace_id", "span_id", "namespace", "pod", "container", "stream", "host", "file", "message"]

RAW_LINE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("generation", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("line", T.StringType()),
        T.StructField("discard_bytes", T.LongType()),
        # what names the file after a rename; null where only its path is known
        T.StructField("identity", T.StringType()),
    ]
)


def ordered(columns: list[str]) -> list[str]:
    """Columns in table order; names that are not known come before ``file``, by name."""
    known = [c for c in TABLE_ORDER if c in columns]
    extra = sorted(c for c in columns if c not in TABLE_ORDER)
    at = next((i for i, c in enumerate(known) if c in ("file", "message")), len(known))
    return known[:at] + extra + known[at:]


def check_fields(fields: dict) -> None:
    """Static fields must not bear the name of a core column: it would be written twice."""
    clash = sorted(set(fields) & set(CORE))
    if clash:
        raise ValueError(f"fields: {', '.join(clash)} are columns of the record")
