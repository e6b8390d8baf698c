"""Put lines together to events: a head opens an event, other lines continue it.

A continuation is kept while the event has fewer than ``max_lines`` lines and its message stays
under ``max_bytes``; the first that does not fit seals the event, and all later ones are dropped
and counted. A sealed event that lost something ends with a marker line. The head itself is never
limited. Lines before the first head are events of their own. A row with ``discard_bytes``
stands for an over-long line that the source dropped: it seals, and counts as one line; with
nothing open, lines are dropped up to the next head, without a trace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlog.operators.parsers import Parser
from tarnlog.operators.sequence import carry_last

MAX_LINES, MAX_BYTES = 500, 256 * 1024


def marker(tag: str, lines: Column, size: Column) -> Column:
    """The line that tells what was dropped."""
    return F.format_string(f"... [{tag} 截断：省略 %d 行 / %d 字节]", lines, size)


def assemble(
    lines: DataFrame,
    parser: Parser,
    ingest_time: Column,
    max_lines: int = MAX_LINES,
    max_bytes: int = MAX_BYTES,
    tag: str = "tarnlog",
    keys: tuple[str, ...] = ("file", "generation"),
) -> DataFrame:
    """Events of ``lines(*keys, offset, content, stream, shell_time[, discard_bytes])``.

    Returns ``*keys, offset``, the record's fields, ``stream`` and ``n_lines``.
    """
    if "discard_bytes" not in lines.columns:
        lines = lines.withColumn("discard_bytes", F.lit(None).cast("long"))
    head = F.when(F.col("discard_bytes").isNull(), parser(F.col("content")))
    parsed = lines.withColumn("rec", head)
    placed = carry_last(parsed, list(keys), "offset", F.when(F.col("rec").isNotNull(), F.col("offset")), "event")
    # an orphan is its own event; discards before a head belong to none, and what follows them up
    # to the next head is the rest of a lost line
    lost = lines.where("discard_bytes is not null").groupBy(*keys).agg(F.min("offset").alias("__lost"))
    here = [F.col(f"p.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    placed = placed.alias("p").join(lost.alias("d"), here, "left").select("p.*", "d.__lost")
    placed = placed.where("event is not null or (discard_bytes is null and (__lost is null or offset < __lost))").drop("__lost").withColumn("orphan", F.col("event").isNull())
    placed = placed.withColumn("event", F.coalesce("event", "offset"))
    size = F.octet_length("content").cast("long")
    by_event = Window.partitionBy(*keys, "orphan", "event").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    first = F.coalesce(F.octet_length("rec.message"), F.lit(0)).cast("long")
    more = F.when(F.col("rec").isNull() & F.col("discard_bytes").isNull(), size)
    grown = placed.select(
        "*",
        F.sum(F.when(F.col("rec").isNotNull(), first).otherwise(F.coalesce(more, F.lit(0)) + 1)).over(by_event).alias("run_bytes"),
        (F.count(F.lit(1)).over(by_event) - 1).alias("k"),
    )
    # message before this line + its bytes, the line break not counted, must stay under the limit
    fits = F.col("rec").isNotNull() | F.col("orphan") | (F.col("discard_bytes").isNull() & (F.col("k") < max_lines) & (F.col("run_bytes") - 1 < max_bytes))
    kept = grown.withColumn("fits", fits.cast("int")).withColumn("keep", F.min("fits").over(by_event) == 1)
    text = F.when(F.col("rec").isNotNull(), F.col("rec.message")).otherwise(F.col("content"))
    lost = ~F.col("keep")
    events = kept.groupBy(*keys, "orphan", "event").agg(
        F.max_by("rec", F.col("rec").isNotNull()).alias("rec"),
        F.min_by("stream", "offset").alias("stream"),
        F.min_by("shell_time", "offset").alias("shell_time"),
        F.count(F.when(F.col("keep"), 1)).alias("n_lines"),
        F.count(F.when(lost, 1)).alias("lost_lines"),
        F.coalesce(F.sum(F.when(lost, F.coalesce(F.col("discard_bytes"), size + 1))), F.lit(0)).alias("lost_bytes"),
        F.collect_list(F.when(F.col("keep"), F.struct("offset", text.alias("text")))).alias("texts"),
    )
    body = F.array_join(F.transform(F.array_sort("texts"), lambda x: x["text"]), "\n")
    body = F.when(F.col("lost_lines") > 0, F.concat_ws("\n", body, marker(tag, F.col("lost_lines"), F.col("lost_bytes")))).otherwise(body)
    none = F.lit("")
    field = lambda name: F.coalesce(F.col(f"rec.{name}"), none)
    return events.select(
        *keys,
        F.col("event").alias("offset"),
        F.coalesce("rec.timestamp", "shell_time", ingest_time.cast("timestamp_ntz")).alias("timestamp"),
        *[field(n).alias(n) for n in ("level", "trace_id", "span_id", "thread", "logger")],
        body.alias("message"),
        "stream",
        "n_lines",
    )
