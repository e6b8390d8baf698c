"""Batch reading of log files into raw lines, and the rules of discovery."""

from __future__ import annotations

import glob
import os
import sys
import threading
import time
from collections.abc import Iterable
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlog.operators.enrich import SKIPPED_EXTENSIONS, glob_regex, readable

POD_LOGS = "/var/log/pods"


def discover(includes: Iterable[str], excludes: Iterable[str] = ()) -> list[str]:
    """Regular files of the include globs: none excluded or skipped, oldest change first.

    Hidden files count. An invalid exclude glob is an error.
    """
    import re

    bars = [re.compile(glob_regex(g).replace(r"\z", r"\Z")) for g in excludes]
    found = {}
    for pattern in includes:
        for path in glob.glob(pattern, recursive=True, include_hidden=True):
            if path.rsplit(".", 1)[-1] in SKIPPED_EXTENSIONS or any(b.match(path) for b in bars) or not os.path.isfile(path):
                continue
            found[path] = os.stat(path).st_mtime_ns
    return sorted(found, key=lambda p: (found[p], p))


def _path(uri: Column) -> Column:
    """The plain path of a local file; other addresses stay as they are."""
    return F.when(uri.startswith("file:/"), F.url_decode(F.replace(F.regexp_replace(uri, "^file:/+", "/"), F.lit("+"), F.lit("%2B")))).otherwise(uri)


def read_lines(spark: SparkSession, paths: str | list[str], host: str | None = None, excludes: Iterable[str] = ()) -> DataFrame:
    """``file, generation, offset, line, discard_bytes[, host]`` of whole files.

    Lines end at ``\\n`` only; one ``\\r`` before it is dropped; bytes that are no UTF-8 become
    U+FFFD. ``offset`` orders the lines of a file: the reader yields them in file order inside
    partitions that it numbers in file order too.
    """
    text = spark.read.option("lineSep", "\n").text(paths).select("value", _path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("start"))
    text = readable(text, excludes)
    lines = text.select(
        "file",
        F.lit(0).alias("generation"),
        # partitions are cut in file order, so (block start, running id) grows along a file
        (F.col("start") + F.monotonically_increasing_id() % (1 << 33)).alias("offset"),
        F.regexp_replace(F.decode(F.encode("value", "UTF-8"), "UTF-8"), "\r\\z", "").alias("line"),
        F.lit(None).cast("long").alias("discard_bytes"),
    )
    return lines.withColumn("host", F.lit(host)) if host is not None else lines


def lines_of(spark: SparkSession, lines: Iterable[str], file: str = "stdin") -> DataFrame:
    """Raw lines of a Python iterable, as a pipe would give them; for streams, see :func:`spool`."""
    rows = [(file, 0, i, x, None) for i, x in enumerate(lines)]
    return spark.createDataFrame(rows, "file string, generation int, offset long, line string, discard_bytes long")


def spool(path: str, stream: BinaryIO | None = None, every: float = 0.5) -> threading.Thread:
    """Copy a pipe, standard input by default, to a file that the tailing source follows.

    What has arrived becomes visible at least every ``every`` seconds; the thread ends with the pipe.
    """
    source = stream or sys.stdin.buffer

    def copy() -> None:
        with open(path, "ab") as f:
            shown = time.monotonic()
            for line in source:
                f.write(line if line.endswith(b"\n") else line + b"\n")
                if time.monotonic() - shown >= every or not getattr(source, "peek", lambda n: b"")(1):
                    f.flush()
                    shown = time.monotonic()

    thread = threading.Thread(target=copy, daemon=True)
    thread.start()
    return thread
