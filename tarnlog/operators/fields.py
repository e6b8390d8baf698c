"""Parse lines of mixed layouts, some over several lines, into entries with fields.

Method. A line is cut into tokens, each with the separator behind it, and every token is typed by
its form (time, level, name, number, address, bracket, quote, word). Token bigrams and trigrams are
counted over the corpus. They are the dictionary that tells layout from text: after two tokens of
a head, one type (or one word) nearly always follows, after the last of them anything does. What
a line shows of its layout this way is its template, and its tokens receive roles by type:

* time: the first token of a time type; only typed or constant tokens may stand before it,
* level: a level word among the typed tokens around the time, a priority or letter code before it,
  or a status number, if the counts say that three digits stand in that place,
* then fields go on as long as the counts hold one type for their place, or a word that a
  separator always closes, up to a name; the first place that is open to anything begins the message,
* component: the name between time and level or behind them, else the last bracket behind them.

Lines of pairs (JSON objects and ``key=value``) have keys as their constant tokens. Bigrams (key,
type of value) and (time key, key) give the roles there: the time key, the level key, the key of
names and the key of free text that the lines with that time key nearly always have. There is no
list of layouts or of key names; a template without a time, a level and a message is no head.

The dictionary holds types and separators, so its size does not grow with the data: it is what is
broadcast. Only words that fill nearly a whole place, and keys that most lines of a time key
have, are held by name. An exact check follows: a time that the calendar lacks makes no head.

Tokens are read by one pattern with a branch for each type, in Arrow batches: built-in expressions
would have to match each token again for each type, which took five times the CPU. One pass counts
and one cuts the fields out; both run on the scan, and only their narrow results are shuffled.

Entries. A head and the lines after it in the same file and generation, up to the next head, are
one entry. A file may hold a third of all lines, so it is worked on in blocks of its offsets; the
last head of each block is handed on to the next ones by a window over blocks.

Defined results: repeated rows count once; lines before the first head and rows with
``discard_bytes`` belong to no entry; null lines are left out; blank lines belong to the entry
before them. Times without an offset are the clock time printed, others and counts since 1970
are UTC; without a year, the year of ``read_at`` (no entry where that is null). An entry without
a component has an empty one.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlog.functions.text import rstrip
from tarnlog.functions.timefmt import MONTHS, ntz_of_ms
from tarnlog.runtime import cut, stored

#: Bytes of a file that form a block.
BLOCK_BYTES = 4 << 20
#: Tokens of a line in which its head must end.
HEAD_TOKENS = 14
#: A place belongs to the layout where typed tokens fill this share of it ...
FIELD_SHARE = 0.9
#: ... where types rarer than this do not count ...
RARE_SHARE = 0.05
#: ... counted behind two tokens at this place of the line, or anywhere, or behind one token, whichever was seen so often first.
FEW = 20
#: Share of the lines with a time key that must have another key for it to get a role.
KEY_SHARE = 0.5
#: Time keys rarer than this among the lines of pairs get no role; it bounds the dictionary of keys.
KEY_LEAST = 1e-4
#: Distinct heads, and bytes of key sets, that a task counts before it hands them on.
COUNTED_HEADS, COUNTED_BYTES = 50_000, 16 << 20

#: Names and codes of levels, and the nearest of the six.
LEVELS = {
    "TRACE": "TRACE", "FINEST": "TRACE", "VERBOSE": "TRACE", "DEBUG": "DEBUG", "FINE": "DEBUG", "DBG": "DEBUG", "D": "DEBUG",
    "INFO": "INFO", "INFORMATION": "INFO", "NOTICE": "INFO", "I": "INFO", "WARN": "WARN", "WARNING": "WARN", "W": "WARN",
    "ERROR": "ERROR", "ERR": "ERROR", "SEVERE": "ERROR", "E": "ERROR", "FATAL": "FATAL", "CRITICAL": "FATAL", "CRIT": "FATAL",
    "ALERT": "FATAL", "EMERG": "FATAL", "EMERGENCY": "FATAL", "PANIC": "FATAL", "F": "FATAL",
}
_LEVEL_WORDS = "|".join(w for w in LEVELS if len(w) > 1)
#: Levels of the severities 0 to 7.
SEVERITIES = ["FATAL", "FATAL", "FATAL", "ERROR", "WARN", "INFO", "INFO", "DEBUG"]
#: Name of access lines that print none.
COMBINED = "nginx"

_CLOCK = r"[0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]+)?"
_ISO = rf"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ]{_CLOCK}(?:Z|[+-][0-9]{{2}}:?[0-9]{{2}})?"
_SLASHED = rf"[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}} (?:- )?{_CLOCK}"
_CLF = rf"[0-9]{{2}}/[A-Z][a-z]{{2}}/[0-9]{{4}}:{_CLOCK}(?: [+-][0-9]{{4}})?"
_NAMED = rf"[A-Z][a-z]{{2}} [ 0-9][0-9] {_CLOCK}"
_TIME = rf"(?:{_ISO}|{_SLASHED}|{_CLF}|{_NAMED})"

#: Forms of tokens in the order in which they are tried: (type, pattern).
_FORMS = [
    ("TB", rf"\[{_TIME}\]"),
    ("T", rf"{_TIME}(?!\w)"),
    ("TL", rf"[A-Z][0-9]{{4}} {_CLOCK}(?!\w)"),
    ("LB", rf"\[(?i:{_LEVEL_WORDS})\]"),
    ("LV", rf"(?:{_LEVEL_WORDS})(?![\w-])"),
    ("PRI", r"<[0-9]{1,3}>[0-9]?"),
    ("BR", r"\[[^\]]*\]"),
    ("Q", r"\"[^\"]*\""),
    ("IP", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![\w.])"),
    ("N3", r"[0-9]{3}(?![\w.:])"),
    ("N", r"[0-9]+(?![\w.:])"),
    ("SRC", r"[A-Za-z_][\w./-]*\.[a-z]{1,5}:[0-9]+\]?"),
    ("NM", r"[A-Za-z_](?=\w*(?:[.$/-]|::)\w|\w*_\w)[\w.:$/-]*\w"),
    ("X", r"(?=[A-Za-z]*[0-9])[0-9A-Za-z][\w.:]*"),
    ("DASH", r"-+(?=[ \t])"),
    ("W", r"[A-Za-z_\x80-\U0010ffff]+"),
    ("P", r"."),
]
_SEPARATOR = r"(?:[ \t]+[-|:][ \t]?|\||:[ \t]|[ \t]+)?"
_TOKEN = re.compile("(?:" + "|".join(f"(?P<{k}>{p})" for k, p in _FORMS) + ")" + _SEPARATOR, re.A | re.S)
_HAS_CLOCK = re.compile(r"[0-9]:[0-9]{2}:[0-9]{2}")
#: Stand between keys and types in a set; a key that has one gets no role.
_MARKS = re.compile("[\x02\x03]")
_SPACES = re.compile(r"[ \t]+")
_PAIRS = re.compile(r"[A-Za-z_@][\w.@-]*=", re.A)
#: Escapes are hidden before, so quoted texts of any length need no repeated group.
_PAIR = re.compile(r"(?<![^ ])([A-Za-z_@][\w.@-]*)=(\"[^\"]*\"|[^ ]*)", re.A)

#: Types of the values of pairs; S is free text.
_VALUES = re.compile(rf"(?P<T>{_TIME}\Z|(?:[0-9]{{9,10}}|[0-9]{{12,13}})\Z)|(?P<LV>(?i:{_LEVEL_WORDS})\Z)|(?P<NUM>-?[0-9]+(?:\.[0-9]+)?\Z)|(?P<W>[^\s]*\Z)|(?P<S>.)", re.A | re.S)
KINDS = ["T", "LV", "NUM", "O", "W", "S"]

Token = tuple[str, str, str]
_KIND = re.compile(r"[A-Z0-9^]+")
#: (tokens of the head, time, level, component, kind of level, whether the last separator is layout)
Roles = tuple[int, int, int, int, str, bool]


def tokens_of(line: str) -> tuple[list[Token], list[int]]:
    """(type, separator, word) of the first tokens of a line, and where each token and its separator end.

    Only words keep their own text. Two words in a row are text, which no head goes beyond.
    """
    out, ends = [], []
    before = ""
    for m in _TOKEN.finditer(line):
        kind = m.lastgroup
        end, after = m.end(kind), m.end()
        sep = line[end:after]
        if len(sep) > 1:
            sep = _SPACES.sub(" ", sep)
        out.append((kind, sep, line[m.start() : end] if kind == "W" and end - m.start() <= 20 else ""))
        ends.append(after)
        if len(out) == HEAD_TOKENS or kind == before == "W":
            break
        before = kind
    return out, ends


def pairs_of(line: str) -> tuple[str, dict[str, object]] | None:
    """(style, values by key) of a JSON object or a line of ``key=value``; None for other lines."""
    if line.startswith("{"):
        try:
            found = json.loads(line)
        except (ValueError, RecursionError):  # nested beyond all bounds
            return None
        return ("json", found) if isinstance(found, dict) and found else None
    if not _PAIRS.match(line):
        return None
    plain = line.replace("\\\\", "\x01").replace('\\"', "\x02") if "\\" in line else line
    out: dict[str, object] = {}
    for k, v in _PAIR.findall(plain):
        if v.startswith('"'):
            v = v[1:-1].replace("\x02", '\\"').replace("\x01", "\\\\")
            if "\\" in v:
                try:
                    v = json.loads(f'"{v}"')
                except ValueError:
                    pass
        out.setdefault(k, v)
    return "pairs", out


def value_kind(value: object) -> str:
    if isinstance(value, bool) or value is None or isinstance(value, dict | list):
        return "O"
    m = _VALUES.match(str(value))
    return m.lastgroup if m else "W"


def _context(kind: str, sep: str) -> str:
    return ("N" if kind == "N3" else kind) + sep


@dataclass
class Dictionary:
    """N-gram counts of tokens, and the roles that they give to the tokens of a head."""

    #: (place, two tokens before | two tokens before | one token before) -> type -> count; words that a separator closes are C.
    places: dict[tuple, dict[str, int]] = field(default_factory=dict)
    #: words that fill nearly the whole of a place
    constants: set[tuple[str, str, str]] = field(default_factory=set)
    #: (token before, type) -> separator -> count
    ends: dict[tuple[str, str], dict[str, int]] = field(default_factory=dict)
    #: level, component and message key by (style, time key)
    keys: dict[tuple[str, str], tuple[str, str, str]] = field(default_factory=dict)

    def add(self, i: int, a: str, b: str, c: str, n: int) -> None:
        for context in ((i, a, b), (a, b), (b,)):
            seen = self.places.setdefault(context, {})
            seen[c] = seen.get(c, 0) + n
        kind = _KIND.match(b)[0]
        after = self.ends.setdefault((a, kind), {})
        after[b[len(kind) :]] = after.get(b[len(kind) :], 0) + n

    def is_layout(self, a: str, kind: str, sep: str) -> bool:
        """Whether a separator is common enough to be one, and not the beginning of a text."""
        seen = self.ends.get((a, kind), {})
        return not sep.strip() or seen.get(sep, 0) >= RARE_SHARE * sum(seen.values())

    def place(self, i: int, a: str, b: str) -> list[str]:
        """The types behind ``a, b``, commonest first, if the place belongs to the layout, else none.

        It does where typed tokens, none of them rare there, fill it; a dash is a value left out.
        """
        for context in ((i, a, b), (a, b), (b,)):
            seen = self.places.get(context, {})
            total = sum(seen.values())
            if total >= FEW:
                break
        common: dict[str, int] = defaultdict(int)
        for kind, n in seen.items():
            if n >= RARE_SHARE * total and kind not in ("W", "P"):
                common["N" if kind == "N3" else kind] += n
        if not total or sum(common.values()) + (seen.get("DASH", 0) if "DASH" not in common else 0) < FIELD_SHARE * total:
            return []
        return sorted(common, key=lambda k: (k == "DASH", -common[k], k))

    def share(self, a: str, b: str, kind: str) -> float:
        seen = self.places.get((a, b), {})
        return seen.get(kind, 0) / max(sum(seen.values()), 1)

    def roles(self, tokens: list[Token]) -> Roles | None:
        """Places of the fields, counted from 1; None for a line that is no head."""
        names: list[int] = []
        time = level = end = 0
        how = ""
        a, b = "^", "^"
        for i, (kind, sep, word) in enumerate(tokens, 1):
            if kind in ("T", "TB", "TL") and not time:
                time, names = i, []
                if kind == "TL":
                    level, how = i, "letter"
            elif kind in ("LV", "LB") and not level:
                level, how = i, "word"
            elif kind == "PRI" and i == 1:
                level, how = i, "priority"
            elif kind == "N3" and time and not level and self.share(a, b, "N3") >= FIELD_SHARE:
                level, how = i, "status"
            elif kind in ("NM", "SRC"):
                names.append(i)
            elif kind == "W":
                if self.place(i, a, b)[:1] == ["C"] and sep.strip():
                    names.append(i)
                elif (a, b, word) not in self.constants and (time or a != "^" or not b.startswith("IP")):
                    return None
            elif kind == "P":
                return None
            a, b = b, _context(kind, sep)
            if time and level:
                end = i
                break
        if not end:
            return None
        if how == "status":
            return end, time, level, 0, how, True
        # a name between time and level, or the first one behind them, closes the head; behind a
        # priority the fields have a fixed order, and the last name is meant
        brackets: list[int] = []
        while end < len(tokens) and not (names and how != "priority"):
            kind, sep, _ = tokens[end]
            kinds = self.place(end + 1, a, b)
            if not kinds:
                break
            end += 1
            shown = "N" if kind == "N3" else kind
            if kind in ("NM", "SRC") or (shown not in kinds and kinds[0] in ("NM", "SRC", "C")):
                names.append(end)
            elif kind == "BR":
                brackets.append(end)
            a, b = b, _context(kind, sep)
        last, sep, _ = tokens[end - 1]
        before = _context(*tokens[end - 2][:2]) if end > 1 else "^"
        return end, time, level, (names[-1:] or brackets[-1:] or [0])[0], how, self.is_layout(before, _context(last, ""), sep)


_COUNTS = "style string, i int, a string, b string, c string, w string, n long"


def counts(lines: DataFrame) -> DataFrame:
    """N-grams of the heads of all lines, and the sets of (key, type) of lines of pairs, counted.

    For heads, ``style`` is empty and ``a, b, c, w`` are two tokens, the type behind them and its
    word; for pairs, ``w`` holds the set. Counted in each task before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: Counter = Counter()
        sets: Counter = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            grams: Counter = Counter()
            for head, n in heads.items():
                a, b = "^", "^"
                for i, (kind, sep, word) in enumerate(head, 1):
                    grams["", i, a, b, "C" if kind == "W" and sep.strip() else kind, word] += n
                    a, b = b, _context(kind, sep)
            for (style, listed), n in sets.items():
                grams[style, 0, "", "", "", listed] += n
            heads.clear()
            sets.clear()
            cols = list(zip(*((*k, n) for k, n in grams.items()))) or [()] * 7
            kinds = [pa.string(), pa.int32(), *[pa.string()] * 4, pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["style", "i", "a", "b", "c", "w", "n"])

        for batch in batches:
            for line in batch.column(0).to_pylist():
                if (found := pairs_of(line)) is not None:
                    listed = "\x03".join(sorted(f"{k}\x02{value_kind(v)}" for k, v in found[1].items() if not _MARKS.search(k)))
                    sets[found[0], _clean(listed)] += 1
                    size += len(listed)
                elif _HAS_CLOCK.search(line):
                    heads[tuple(tokens_of(line)[0])] += 1
                if len(heads) > COUNTED_HEADS or size > COUNTED_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    counted = lines.select("line").mapInArrow(run, _COUNTS)
    return counted.groupBy("style", "i", "a", "b", "c", "w").agg(F.sum("n").alias("n"))


def learn(lines: DataFrame) -> Dictionary:
    """The dictionary of a corpus of lines."""
    counted = cut(counts(lines))
    grams = counted.where("style = ''")
    full = grams.withColumn("all", F.sum("n").over(Window.partitionBy("i", "a", "b")))
    # a word is shown by name only where it fills its place: at most one of each context
    named = F.when((F.col("w") != "") & (F.col("n") >= FIELD_SHARE * F.col("all")), F.col("w")).otherwise("")
    made = Dictionary()
    for r in full.groupBy("i", "a", "b", "c", named.alias("w")).agg(F.sum("n").alias("n")).toLocalIterator():  # types and separators: a bounded number of rows
        made.add(r["i"], r["a"], r["b"], r["c"], r["n"])
        if r["w"]:
            made.constants.add((r["a"], r["b"], r["w"]))
    made.keys = key_roles(counted.where("style <> ''").select("style", F.col("w").alias("set"), "n"))
    return made


def key_roles(sets: DataFrame) -> dict[tuple[str, str], tuple[str, str, str]]:
    """Level, component and message key by (style, time key), from bigrams: (key, type) and (time key, key)."""
    # an object without keys that count is an empty text
    sets = sets.where("set <> ''")
    each = sets.select("style", "set", "n", F.explode(F.split("set", "\x03")).alias("p")).select("style", "set", "n", F.split("p", "\x02")[0].alias("key"), F.split("p", "\x02")[1].alias("kind"))
    kinds = each.groupBy("style", "key").pivot("kind", KINDS).agg(F.sum("n")).fillna(0).withColumn("total", F.expr(" + ".join(KINDS)))
    lines = sets.groupBy("style").agg(F.sum("n").alias("lines"))
    times = kinds.join(lines, "style").where((F.col("T") >= FIELD_SHARE * F.col("total")) & (F.col("total") >= KEY_LEAST * F.col("lines"))).select("style", F.col("key").alias("time_key"), F.col("total").alias("of"))
    timed = each.select("style", "set", F.col("key").alias("time_key")).join(times, ["style", "time_key"])
    both = each.join(timed, ["style", "set"]).groupBy("style", "time_key", "of", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= KEY_SHARE * F.col("of"))
    by: dict[tuple[str, str], list] = defaultdict(list)
    for r in both.join(kinds, ["style", "key"]).toLocalIterator():  # at most 1 / KEY_LEAST time keys and the keys that most of their lines have
        by[r["style"], r["time_key"]].append(r)
    out = {}
    for at, rows in by.items():
        rows = [r for r in rows if r["key"] != at[1]]
        best = lambda kind: max(((r[kind] / r["total"], r["n"], r["key"]) for r in rows), default=(0, 0, ""))  # noqa: B023, E731
        level, message = best("LV"), best("S")
        names = [(r["n"], r["W"] / r["total"], r["key"]) for r in rows if r["key"] not in (level[2], message[2]) and r["W"] >= FIELD_SHARE * r["total"]]
        if level[0] >= FIELD_SHARE and message[0] > 0:
            out[at] = (level[2], max(names)[2] if names else "", message[2])
    return out


_PARTS = [
    re.compile(r"(?P<y>\d{4})-(?P<mo>\d\d)-(?P<d>\d\d)[T ](?P<h>\d\d):(?P<mi>\d\d):(?P<s>\d\d)(?:[.,](?P<fr>\d+))?(?P<z>Z|[+-]\d\d:?\d\d)?\Z", re.A),
    re.compile(r"(?P<y>\d{4})/(?P<mo>\d\d)/(?P<d>\d\d) (?:- )?(?P<h>\d\d):(?P<mi>\d\d):(?P<s>\d\d)(?:[.,](?P<fr>\d+))?(?P<z>)\Z", re.A),
    re.compile(r"(?P<d>\d\d)/(?P<mo>[A-Z][a-z]{2})/(?P<y>\d{4}):(?P<h>\d\d):(?P<mi>\d\d):(?P<s>\d\d)(?:[.,](?P<fr>\d+))?(?: (?P<z>[+-]\d{4}))?\Z", re.A),
    re.compile(r"[A-Z](?P<y>)(?P<mo>\d\d)(?P<d>\d\d) (?P<h>\d\d):(?P<mi>\d\d):(?P<s>\d\d)(?:[.,](?P<fr>\d+))?(?P<z>)\Z", re.A),
    re.compile(r"(?P<y>)(?P<mo>[A-Z][a-z]{2}) (?P<d>[ \d]\d) (?P<h>\d\d):(?P<mi>\d\d):(?P<s>\d\d)(?:[.,](?P<fr>\d+))?(?P<z>)\Z", re.A),
]
_COUNT = re.compile(r"(?:[0-9]{9,10}|[0-9]{12,13})\Z")
_EPOCH_DAY = date(1970, 1, 1).toordinal()


def time_ms(text: str, year: int | None) -> int | None:
    """Milliseconds from 1970 of a printed time; None where the calendar or the clock lacks it."""
    if _COUNT.match(text):
        return int(text) * (1 if len(text) > 10 else 1000)
    for pattern in _PARTS:
        if m := pattern.match(text):
            y, mo, d, h, mi, s, fr, z = m.group("y", "mo", "d", "h", "mi", "s", "fr", "z")
            if mo.isalpha():
                mo = MONTHS.index(mo) + 1 if mo in MONTHS else 0
            y = int(y) if y else year
            if y is None or int(h) > 23 or int(mi) > 59 or int(s) > 59:
                return None
            try:
                day = date(y, int(mo), int(d)).toordinal() - _EPOCH_DAY
            except ValueError:
                return None
            shift = 0
            if z and z != "Z":
                hours, minutes = int(z[1:3]), int(z[-2:])
                if hours > 23 or minutes > 59:
                    return None
                shift = (hours * 60 + minutes) * (-1 if z[0] == "-" else 1)
            return ((day * 24 + int(h)) * 60 + int(mi) - shift) * 60_000 + int(s) * 1000 + int((fr or "").ljust(3, "0")[:3] or 0)
    return None


_INSIDE = re.compile(_SEPARATOR + r"\Z", re.A)
_LINE_NUMBER = re.compile(r"(\.[a-z]{1,5}):[0-9]+\Z", re.A)
_OPENING = re.compile(r"\[([A-Za-z]+)\]")

Entry = tuple[int, str, str, str]


def reader(known: Dictionary) -> Callable[[str, int | None], Entry | None]:
    """A function that reads (ms, level, component, message) from a head, and None from any other line."""
    memo: dict[tuple, tuple | None] = {}

    def read(line: str, year: int | None) -> Entry | None:
        if (found := pairs_of(line)) is not None:
            style, values = found
            for k in values:
                roles = known.keys.get((style, k))
                if roles and roles[0] in values and roles[2] in values:
                    ms = time_ms(str(values[k]), year)
                    level = LEVELS.get(str(values[roles[0]]).upper())
                    if ms is None or level is None:
                        return None
                    name = values.get(roles[1])
                    return ms, level, "" if name is None else str(name), str(values[roles[2]])
            return None
        if not _HAS_CLOCK.search(line):
            return None
        tokens, ends = tokens_of(line)
        at = tuple(tokens)
        if at in memo:
            roles = memo[at]
        else:
            if len(memo) > COUNTED_HEADS:
                memo.clear()
            roles = memo[at] = known.roles(tokens)
        if roles is None:
            return None

        def text(i: int) -> str:
            piece = _INSIDE.sub("", line[ends[i - 2] if i > 1 else 0 : ends[i - 1]], 1)
            return piece[piece.startswith("[") : len(piece) - piece.endswith("]")]

        end, time, code, component, how, is_layout = roles
        ms = time_ms(text(time), year)
        if ms is None:
            return None
        if how == "status":
            number = int(text(code))
            opening = _OPENING.match(line)
            return ms, "ERROR" if number >= 500 else "WARN" if number >= 400 else "INFO", opening[1].lower() if opening else COMBINED, line
        if how == "priority":
            level = SEVERITIES[int(text(code)[1:].split(">")[0]) % 8]
        else:
            level = LEVELS.get(text(code)[0] if how == "letter" else text(code).upper())
        if level is None:
            return None
        name = _LINE_NUMBER.sub(r"\1", text(component)) if component else ""
        text_at = ends[end - 1]
        if not is_layout:
            text_at -= len(_INSIDE.search(line, ends[end - 2] if end > 1 else 0, text_at)[0].lstrip())
        return ms, level, name, line[text_at:]

    return read


def parsed(lines: DataFrame, known: Dictionary) -> DataFrame:
    """``file, generation, line_offset, ms, level, component, piece``; ``ms`` is null where no head is.

    ``piece`` is the message of a head, and any other line as it is.
    """
    shared = lines.sparkSession.sparkContext.broadcast(known)
    source = lines.select("file", "generation", "line_offset", "line", F.year("read_at").alias("year"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader(shared.value)
        for batch in batches:
            given = batch.column("line").to_pylist()
            found = [read(line, year) for line, year in zip(given, batch.column("year").to_pylist())]
            none = (None, None, None)
            cols = zip(*[(f[0], f[1], _clean(f[2]), _clean(f[3])) if f else (*none, line) for f, line in zip(found, given)]) if found else [()] * 4
            made = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)] + made, ["file", "generation", "line_offset", "ms", "level", "component", "piece"])

    kinds = ", ".join(f"{c} {lines.schema[c].dataType.simpleString()}" for c in ("file", "generation", "line_offset"))
    return source.mapInArrow(run, f"{kinds}, ms long, level string, component string, piece string")


def _clean(text: str) -> str:
    """Escaped halves of a character pair are no text."""
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def entries(raw: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file, generation, line_offset, n_lines, event_ts, level, component, message`` per entry."""
    lines = raw.where("discard_bytes is null and line is not null")
    block = F.floor(F.coalesce("line_offset", F.lit(0)) / block_bytes)
    rows = parsed(lines, learn(lines)).withColumn("block", block).repartition("file", "generation", "block").dropDuplicates(["file", "generation", "block", "line_offset"])
    here = Window.partitionBy("file", "generation", "block").orderBy("line_offset")
    opened = F.last(F.when(F.col("ms").isNotNull(), F.col("line_offset")), ignorenulls=True).over(here)
    # stored, as what follows reads it twice
    own = stored(rows.withColumn("opened", opened))
    # the last head of each block, handed on to the blocks after it
    last = own.groupBy("file", "generation", "block").agg(F.max("opened").alias("last_head"))
    before = Window.partitionBy("file", "generation").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.withColumn("carried", F.last("last_head", ignorenulls=True).over(before)).select("file", "generation", "block", "carried")
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in ("file", "generation", "block")]
    joined = own.alias("o").join(carry.alias("c"), same, "left").select("o.*", "c.carried")
    whole = joined.withColumn("entry", F.coalesce("opened", "carried")).where("entry is not null")
    grouped = whole.groupBy("file", "generation", F.col("entry").alias("line_offset")).agg(
        F.count(F.lit(1)).cast("int").alias("n_lines"),
        # one line of an entry has these
        *[F.max(c).alias(c) for c in ("ms", "level", "component")],
        F.collect_list(F.struct("line_offset", "piece")).alias("pieces"),
    )
    text = rstrip(F.array_join(F.transform(F.array_sort("pieces"), lambda p: p["piece"]), "\n"))
    return grouped.select(
        "file", "generation", "line_offset", "n_lines",
        F.date_format(ntz_of_ms(F.col("ms")), "yyyy-MM-dd HH:mm:ss.SSS").alias("event_ts"),
        "level", "component", text.alias("message"),
    )
