"""Multi-line assembly of a stream, file by file, with an idle flush.

Lines may stand in a container runtime's shell; parts of a split line are kept in the state until
their end arrives, and join the event as one line.

The open event of a file is kept in the state store; it is emitted when the next head arrives,
or when the file has been quiet for ``idle_ms``, with the part of a split line that waits. A file
is known by its identity, so an event goes on after a rename. State and source offsets are committed together,
so an event that was open at a failure is still open after it. The rules are those of
:mod:`tarnlog.operators.assemble`, and the head of an event is handed on as it was read: the one
parser of batch and stream takes its fields out of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tarnlog.operators.parsers import head_message
from tarnlog.operators.shell import CRI_HEAD

_OPEN = [
    T.StructField("file", T.StringType()),
    T.StructField("generation", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("n_lines", T.IntegerType()),
    T.StructField("head", T.StringType()),
    T.StructField("tail", T.StringType()),
    T.StructField("stream", T.StringType()),
]
#: ``head`` is the line that opened the event, null for a line without one; ``tail`` what follows.
EVENT = T.StructType([*_OPEN, T.StructField("shell_time", T.StringType())])


class Assembler(StatefulProcessor):
    def __init__(self, formats: list[str], pattern: str | None = None, idle_ms: int = 2000, max_lines: int = 500, max_bytes: int = 262_144, tag: str = "tarnlog", shell: str = "raw"):
        self.formats, self.pattern, self.idle_ms, self.max_lines, self.max_bytes, self.tag, self.shell = formats, pattern, idle_ms, max_lines, max_bytes, tag, shell

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.message_of = head_message(self.formats, self.pattern)
        self.cri = re.compile(CRI_HEAD.replace("\\z", "\\Z"))
        # size: bytes of the message so far; an event without a head only holds what was dropped
        more = [T.StructField(c, T.LongType()) for c in ("size", "lost_lines", "lost_bytes")]
        self.state = handle.getValueState("open", T.StructType([*_OPEN, *more]))
        self.part = handle.getValueState("part", T.StructType([T.StructField("text", T.StringType())]))

    def _event(self, s: list) -> Iterator[Row]:
        file, generation, offset, n, head, tail, stream, _, lost, size = s
        if head is not None:
            if lost:
                tail = (tail or "") + f"\n... [{self.tag} 截断：省略 {lost} 行 / {size} 字节]"
            yield Row(file=file, generation=generation, offset=offset, n_lines=n, head=head, tail=tail, stream=stream, shell_time=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s = list(self.state.get()) if self.state.exists() else None
        part = self.part.get()[0] if self.part.exists() else None
        for r in sorted(rows, key=lambda r: (r["generation"], r["offset"])):
            file, generation, offset = r["file"], r["generation"], r["offset"]
            if s and s[1] != generation:
                yield from self._event(s)
                s = None
            if r["discard_bytes"] is not None:
                # with nothing open, what follows is the rest of a line that is lost
                s = s or [file, generation, offset, 0, None, None, None, 0, 0, 0]
                s[8], s[9] = s[8] + 1, s[9] + r["discard_bytes"]
                continue
            line, stream, time = r["line"], None, None
            if self.shell == "cri" and self.cri.match(line):
                time, stream, tag, *content = line.split(" ", 3)
                part = (part or "") + (content[0] if content else "")
                if tag[0] == "P":
                    continue
                line, part = part, None
            message = self.message_of(line)
            size = len(line.encode())
            if message is not None:
                if s:
                    yield from self._event(s)
                s = [file, generation, offset, 1, line, None, stream, len(message.encode()), 0, 0]
            elif s is None:
                yield Row(file=file, generation=generation, offset=offset, n_lines=1, head=None, tail=line, stream=stream, shell_time=time)
            elif s[8] or s[3] >= self.max_lines or s[7] + size >= self.max_bytes:
                s[8], s[9] = s[8] + 1, s[9] + size + 1
            else:
                s[3], s[5], s[7] = s[3] + 1, (s[5] or "") + "\n" + line, s[7] + 1 + size
        if part is None:
            self.part.clear()
        else:
            self.part.update((part,))
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        if s:
            self.state.update(tuple(s))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        else:
            self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            s = list(self.state.get())
            if s[4] is not None:
                if self.part.exists():
                    rest = self.part.get()[0]
                    self.part.clear()
                    if s[8]:
                        s[8], s[9] = s[8] + 1, s[9] + len(rest.encode()) + 1
                    else:
                        s[3], s[5] = s[3] + 1, (s[5] or "") + "\n" + rest
                self.state.clear()
                yield from self._event(s)

    def close(self) -> None:
        pass


def assemble_stream(
    lines: DataFrame, formats: list[str], pattern: str | None = None, idle_ms: int = 2000, max_lines: int = 500, max_bytes: int = 262_144, shell: str = "raw", tag: str = "tarnlog"
) -> DataFrame:
    """Events of a stream of raw lines. Needs the RocksDB state store."""
    identity = F.coalesce("identity", "file") if "identity" in lines.columns else F.col("file")
    return lines.withColumn("__key", identity).groupBy("__key").transformWithState(
        statefulProcessor=Assembler(formats, pattern, idle_ms, max_lines, max_bytes, tag, shell), outputStructType=EVENT, outputMode="Append", timeMode="ProcessingTime"
    )
