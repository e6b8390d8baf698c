"""Line parsers: a column of text becomes a struct of fields, or null where no record starts.

A parser is a function ``Column -> Column`` of type ``struct<timestamp, level, trace_id,
span_id, thread, logger, message>``. Everything is built from native expressions, and a chain
tries its parsers lazily, in order. A line is matched once: the match rewrites its head to fields
with a separator between them, and the text behind the head is never part of a group.

:func:`head_message` is the same test for the stream's state, which holds lines one by one; it is
made from the same patterns.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarnlog.functions.ids import normalise_span_id, normalise_trace_id
from tarnlog.functions.text import WHITE, strip
from tarnlog.functions.timefmt import MONTHS, month_number, offset_minutes, wall_clock

Parser = Callable[[Column], Column]

#: White space as the default layout separates its fields: Unicode White_Space, spelled out.
SPACE = "[" + "".join(f"\\u{ord(c):04x}" for c in WHITE) + "]"
NOT_SPACE = SPACE.replace("[", "[^", 1)
#: Stands between the fields of a rewritten head; it is no character of any text.
MARK = "\uffff"

#: Fixed value: the head of an application line, up to its message. Groups: time, trace, span,
#: thread, level, logger.
LOGBACK = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]{1,9})?)"
    rf"{SPACE}+(?:\[TID:([^\]]*)\]{SPACE}*)?(?:\[SpanID:([^\]]*)\]{SPACE}*)?(?:\[([^\]]*)\]{SPACE}*)?"
    rf"\[?([A-Z]+)\]?{SPACE}+({NOT_SPACE}+){SPACE}*-?{SPACE}?"
)
#: Access lines. Groups: year, month, day, clock; status. For nginx day, month, year,
#: clock, offset; status, of the text behind the first `` [``.
GIN = rf"(?s)^\[GIN\]{SPACE}*([0-9]{{4}})/([0-9]{{2}})/([0-9]{{2}}) - ([0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}){SPACE}*\|{SPACE}*(\+?[0-9]{{1,9}}){SPACE}*(?:\|.*)?\z"
NGINX = r"(?s)^([0-9]{2})/([A-Z][a-z]{2})/([0-9]{4}):([0-9]{2}:[0-9]{2}:[0-9]{2})(?: ([+-][0-9]{4}))?\] \"[^\"]*\" (\+?[0-9]{1,9})(?: .*)?\z"


def record(timestamp: Column, level: Column, trace_id: Column, span_id: Column, thread: Column, logger: Column, message: Column) -> Column:
    named = {"timestamp": timestamp, "level": level, "trace_id": trace_id, "span_id": span_id, "thread": thread, "logger": logger, "message": message}
    return F.struct(*[v.alias(k) for k, v in named.items()])


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _rewritten(line: Column, pattern: str, groups: int) -> Column:
    """``["", group 1, ..., rest]`` of a line that the pattern matches from its start, else one element.

    A mark in the line itself becomes U+FFFD, as other bytes that are no text.
    """
    to = MARK + "".join(f"${i}{MARK}" for i in range(1, groups + 1))
    return F.split(F.regexp_replace(F.replace(line, F.lit(MARK), F.lit("\ufffd")), pattern, to), MARK, groups + 2)


def logback_time(text: Column) -> Column:
    """The wall clock value of ``YYYY-MM-DD[ T]HH:MM:SS[.,]f{1,9}``; null if the calendar lacks it."""
    shape = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]{1,9})?\z"
    return F.when(text.rlike(shape), F.translate(text, ",", ".").try_cast("timestamp_ntz"))


def logback(ingest_time: Column) -> Parser:
    """Application lines. A time of the right shape that the calendar lacks becomes ``ingest_time``."""
    now = ingest_time.cast("timestamp_ntz")

    def fields(f: Column) -> Column:
        ts = F.coalesce(F.translate(f[1], ",", ".").try_cast("timestamp_ntz"), now)
        return F.when(F.size(f) == 8, record(ts, f[5], normalise_trace_id(f[2]), normalise_span_id(f[3]), strip(f[4]), f[6], f[7]))

    # the first characters tell most other lines, before any pattern
    return lambda line: F.when(F.substring(line, 5, 1) == "-", _once(_rewritten(line, LOGBACK, 6), fields))


def custom(pattern: str, ingest_time: Column) -> Parser:
    """Lines of a pattern with named groups, all optional, searched anywhere in the line.

    Java allows no ``_`` in group names, so names are resolved here and replaced by numbers.
    Without a ``message`` group the message is the text after the match.
    """
    index = re.compile(pattern).groupindex
    known = {"timestamp", "level", "trace_id", "span_id", "thread", "logger", "message"}
    if unknown := set(index) - known:
        raise ValueError(f"pattern: unknown groups {', '.join(sorted(unknown))}")
    numbered = "(?d)" + re.sub(r"\(\?P<[^>]+>", "(", pattern)

    def parse(line: Column) -> Column:
        def g(name: str) -> Column:
            return strip(F.regexp_extract(line, numbered, index[name])) if name in index else F.lit("")

        if "message" in index:
            message = F.regexp_extract(line, numbered, index["message"])
        else:
            start = F.regexp_instr(line, F.lit(numbered))
            message = F.substring(line, start + F.length(F.regexp_substr(line, F.lit(numbered))), F.length(line))
        ts = F.coalesce(logback_time(g("timestamp")), ingest_time.cast("timestamp_ntz"))
        return F.when(line.rlike(numbered), record(ts, g("level"), normalise_trace_id(g("trace_id")), normalise_span_id(g("span_id")), g("thread"), g("logger"), message))

    return parse


def _python(pattern: str) -> re.Pattern:
    return re.compile(pattern.replace("\\z", "\\Z"))


def _exists(y: str, mo: str, d: str, clock: str) -> bool:
    try:
        datetime.fromisoformat(f"{y}-{mo}-{d} {clock}")
    except ValueError:
        return False
    return True


def head_message(formats: list[str], pattern: str | None = None) -> Callable[[str], str | None]:
    """A function of a line: its message if it opens a record in one of the formats, else None."""
    layout, gin_line, nginx_line = _python(LOGBACK), _python(GIN), _python(NGINX)
    own = re.compile(pattern.replace("\\z", "\\Z")) if pattern else None
    status = lambda x: int(x) <= 65535

    def by_logback(line: str) -> str | None:
        if own is not None:
            m = own.search(line)
            return None if m is None else (m["message"] or "") if "message" in own.groupindex else line[m.end() :]
        m = layout.match(line)
        return None if m is None else line[m.end() :]

    def by_gin(line: str) -> str | None:
        m = gin_line.match(line)
        return line if m and _exists(*m.group(1, 2, 3, 4)) and status(m[5]) else None

    def by_nginx(line: str) -> str | None:
        at = line.find(" [")
        m = nginx_line.match(line[at + 2 :]) if at >= 0 else None
        if not m or m[2] not in MONTHS or not status(m[6]) or not _exists(m[3], f"{MONTHS.index(m[2]) + 1:02d}", m[1], m[4]):
            return None
        return line if not m[5] or (int(m[5][1:3]) < 24 and int(m[5][3:]) < 60) else None

    tests = [{"logback": by_logback, "gin": by_gin, "nginx": by_nginx}[f] for f in formats]
    return lambda line: next((m for t in tests if (m := t(line)) is not None), None)


def status_level(status: Column) -> Column:
    return F.when(status >= 500, "ERROR").when(status >= 400, "WARN").otherwise("INFO")


def _access(line: Column, clock: Column, status: Column, logger: str) -> Column:
    none = F.lit("")
    number = F.regexp_replace(status, r"^\+", "").try_cast("int")
    return _once(F.struct(clock.alias("at"), number.alias("status")), lambda x: F.when(x["at"].isNotNull() & (x["status"] <= 65535), record(x["at"], status_level(x["status"]), none, none, none, F.lit(logger), line)))


def _clock(y: Column, mo: Column, d: Column, time: Column) -> Column:
    return F.concat_ws("-", y, mo, F.concat(d, F.lit(" "), time)).try_cast("timestamp_ntz")


def gin(line: Column) -> Column:
    """``[GIN] date - time | status | ...``; the message is the whole line."""
    return F.when(line.startswith("[GIN]"), _once(_rewritten(line, GIN, 5), lambda f: F.when(F.size(f) == 7, _access(line, _clock(f[1], f[2], f[3], f[4]), f[5], "gin"))))


def _local(clock: Column, offset: Column) -> Column:
    """A clock reading in the session's zone; without an offset, as printed; null for one that is none."""
    utc = clock - F.make_dt_interval(F.lit(0), F.lit(0), offset_minutes(offset))
    return F.when(offset == "", clock).otherwise(F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc))


def nginx(line: Column) -> Column:
    """Combined access lines; only the first `` [`` may open the time."""
    at = F.locate(" [", line)
    rest = F.substring(line, at + 2, F.length(line))
    fields = lambda f: F.when(F.size(f) == 8, _access(line, _local(_clock(f[3], F.lpad(month_number(f[2]).cast("string"), 2, "0"), f[1], f[4]), f[5]), f[6], "nginx"))
    return F.when((at > 0) & F.substring(line, at + 4, 1).eqNullSafe("/"), _once(_rewritten(rest, NGINX, 6), fields))


def chain(*parsers: Parser) -> Parser:
    """The first parser that matches wins."""
    if not parsers:
        raise ValueError("formats: at least one is needed")
    return lambda line: F.coalesce(*[p(line) for p in parsers])


def factory(formats: list[str], ingest_time: Column, pattern: str | None = None) -> Parser:
    """Parsers by name, in order; ``pattern`` replaces the layout of ``logback``."""
    made = {"logback": custom(pattern, ingest_time) if pattern else logback(ingest_time), "gin": gin, "nginx": nginx}
    if unknown := [f for f in formats if f not in made]:
        raise ValueError(f"formats: unknown {', '.join(unknown)}; known are {', '.join(made)}")
    if pattern and "logback" not in formats:
        raise ValueError("pattern: it has no effect unless logback is among the formats")
    return chain(*[made[f] for f in formats])
