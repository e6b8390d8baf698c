"""From raw lines to enriched events, in batch; the builder of the whole path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlog.operators import assemble as asm
from tarnlog.operators import enrich, parsers, shell

Step = Callable[[DataFrame], DataFrame]


class Pipeline:
    """``Pipeline().parser(["logback"]).container("cri").labels(df).build(lines)``."""

    def __init__(self, ingest_time: Column | None = None):
        self._time = ingest_time if ingest_time is not None else F.current_timestamp().cast("timestamp_ntz")
        self._formats, self._pattern, self._shell = ["logback"], None, "raw"
        self._limits = (asm.MAX_LINES, asm.MAX_BYTES)
        self._labels: tuple[DataFrame, str | None] | None = None
        self._selector: dict | None = None
        self._host: str | None = None
        self._fields: dict = {}
        self._steps: list[Step] = []

    def parser(self, formats: list[str], pattern: str | None = None) -> Pipeline:
        self._formats, self._pattern = formats, pattern
        return self

    def container(self, shell_format: str) -> Pipeline:
        self._shell = shell_format
        return self

    def limits(self, max_lines: int, max_bytes: int) -> Pipeline:
        self._limits = (max_lines, max_bytes)
        return self

    def select(self, **selector) -> Pipeline:
        self._selector = selector
        return self

    def labels(self, labels: DataFrame, default: str | None = None) -> Pipeline:
        self._labels = (labels, default)
        return self

    def host(self, name: str) -> Pipeline:
        self._host = name
        return self

    def fields(self, **fields) -> Pipeline:
        self._fields = fields
        return self

    def transform(self, step: Step) -> Pipeline:
        self._steps.append(step)
        return self

    def build(self, lines: DataFrame) -> DataFrame:
        """Events of raw lines (``file, generation, offset, line[, discard_bytes]``)."""
        if self._selector is not None:
            # by path, before any line is looked at
            picked = enrich.select_pods(enrich.with_pod(lines), **self._selector)
            lines = picked.select(*lines.columns)
        discards = lines.where("discard_bytes is not null") if "discard_bytes" in lines.columns else None
        whole = lines.where("discard_bytes is null") if discards is not None else lines
        joined = shell.join_parts(shell.decode(whole, self._shell))
        if discards is not None:
            joined = joined.unionByName(discards.select("file", "generation", "offset", "discard_bytes"), allowMissingColumns=True)
        parser = parsers.factory(self._formats, self._time, self._pattern)
        events = asm.assemble(joined, parser, self._time, *self._limits)
        events = enrich.with_pod(events)
        if self._labels:
            events = enrich.with_service(events, *self._labels)
        if self._host is not None:
            events = events.withColumn("host", F.lit(self._host))
        return enrich.transform(enrich.with_fields(events, self._fields), *self._steps)
