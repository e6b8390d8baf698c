"""Strip what a container runtime puts around each line, and join lines that it split.

``time stream tag content``: tag P marks a part, F the end of a line. Parts add up, per file and
over streams, until the next F; the joined line stands where the F stood, with its stream and
time. Lines without the shell are content as they are and leave open parts alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlog.operators.sequence import carry_last

CRI_HEAD = r"^[^ ]* (?:stdout|stderr) [PF](?::[^ ]*)?(?: |\z)"
_RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?(?:Z|[+-][0-9]{2}:[0-9]{2})\z"


def runtime_time(text: Column) -> Column:
    """The wall clock value, in the session's zone, of the time that a runtime prints; null for other texts."""
    return F.when(text.rlike(_RFC3339), text.try_cast("timestamp").cast("timestamp_ntz"))


def decode(lines: DataFrame, shell: str = "cri") -> DataFrame:
    """Add ``content, stream, shell_time, tag``; ``shell`` is ``raw`` or ``cri``.

    ``shell_time`` is in the session's zone; ``tag`` is null for lines without a shell.
    """
    if shell == "raw":
        null = F.lit(None).cast("string")
        return lines.select("*", F.col("line").alias("content"), null.alias("stream"), F.lit(None).cast("timestamp_ntz").alias("shell_time"), null.alias("tag"))
    if shell != "cri":
        raise ValueError("container_format: raw or cri")
    line = F.col("line")
    # cut at the first three spaces: the content is what stands behind them, and is never matched
    parts = F.split(line, " ", 4)
    cut = lines.select("*", F.when(line.rlike(CRI_HEAD), parts).alias("__shell"))
    time = runtime_time(F.col("__shell")[0])
    is_shell = F.col("__shell").isNotNull()
    return cut.select(
        *lines.columns,
        F.when(is_shell, F.coalesce(F.try_element_at("__shell", F.lit(4)), F.lit(""))).otherwise(line).alias("content"),
        F.col("__shell")[1].alias("stream"),
        time.alias("shell_time"),
        F.substring(F.col("__shell")[2], 1, 1).alias("tag"),
    )


def join_parts(decoded: DataFrame, keys: tuple[str, ...] = ("file", "generation")) -> DataFrame:
    """One row per line: parts joined to the F that ends them.

    Parts without an F become one line at the offset of their last part, with ``tag`` P.
    """
    parts = decoded.where("tag is not null")
    grouped = carry_last(parts, list(keys), "offset", F.when(F.col("tag") == "F", F.col("offset")), "group", inclusive=False)
    joined = grouped.groupBy(*keys, F.coalesce("group", F.lit(-1)).alias("group")).agg(
        F.max("offset").alias("offset"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "content"))), lambda x: x["content"]), "").alias("content"),
        F.max_by("stream", "offset").alias("stream"),
        F.max_by("shell_time", "offset").alias("shell_time"),
        F.max_by("tag", "offset").alias("tag"),
    )
    columns = [*keys, "offset", "content", "stream", "shell_time", "tag"]
    return joined.select(*columns).unionByName(decoded.where("tag is null").select(*columns))
