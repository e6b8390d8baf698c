"""Turn time texts of many notations into the one instant that is meant.

Every value gets all its valid interpretations as an array of (notation, instant). Values with
one instant are settled. The others are chosen by Viterbi over the record order of their source:
an interpretation costs by how far its instant lies outside the time in which it can have been
received, a change of notation and a step back in time cost extra. Settled values are single
states, so a chain falls apart at them, and only the stretches between two settled values are
solved. No task holds a long source: it is worked on in blocks of its offsets. A first pass finds,
for each block, the least cost from every reading of its first value to every reading of its last;
over these few numbers Viterbi chooses the readings at the borders, and a second pass solves each
block between them. The result is that of one chain over the source, whatever the blocks.

Rules. Text without a zone is the clock of its host; a reading that occurs twice means the
earlier instant, one that does not occur takes the offset of the same value read as UTC. Without
a year, the year that brings the instant nearest to the receipt. Abbreviations are read as in the
host's zone, then by a list of common ones. Seconds from 1970 may be in s, ms, us or ns.

Defined results: null, empty and unreadable values give no row; so do dates that the calendar
lacks, and host-local values whose host has no zone. Without a receipt time, values without a
year give no row. White space around a value and one pair of brackets are noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlog.functions.text import strip
from tarnlog.functions.timefmt import DAY_MS, month_number, ntz_ms, offset_minutes, zoned_ms
from tarnlog.operators.delivery import HOSTS_BROADCAST_ROWS, machine_names
from tarnlog.runtime import apart, broadcast_if_small, stored

#: Costs of the Viterbi steps.
SWITCH_COST, BACK_COST, LATE_COST = 1.0, 2.0, 4.0
#: An instant may lie this long before its receipt, and this little after it, without cost.
LATE_MS, EARLY_MS = 7 * DAY_MS, 5_000
#: Values of a source that a block holds on average; sources with fewer are one block.
BLOCK_ROWS = 20_000
#: Long sources that are broadcast at most; beyond it Spark chooses the join.
SOURCES_BROADCAST = 100_000

#: Minutes of abbreviations that the host's own zone does not use.
COMMON_ZONES = {
    "UTC": 0, "GMT": 0, "UT": 0, "Z": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MET": 60, "MEST": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "SGT": 480, "HKT": 480, "JST": 540, "KST": 540, "AWST": 480,
    "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780, "BRT": -180, "ART": -180, "AST": -240, "ADT": -180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}

_ISO = r"^([0-9]{4})-([0-9]{2})-([0-9]{2})[T ]([0-9]{2}):([0-9]{2}):([0-9]{2})(?:[.,]([0-9]{1,9}))? ?(Z|[+-][0-9]{2}:?[0-9]{2}|[A-Z]{2,5}|\[[A-Za-z0-9_+-]+(?:/[A-Za-z0-9_+-]+)*\])?\z"
_CLF = r"^([0-9]{2})/([A-Z][a-z]{2})/([0-9]{4}):([0-9]{2}):([0-9]{2}):([0-9]{2})(?: ([+-][0-9]{4}))?\z"
_DOT = r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4}) ([0-9]{2}):([0-9]{2}):([0-9]{2})(?:[.,]([0-9]{1,9}))?\z"
_SLASH = r"^([0-9]{4})/([0-9]{2})/([0-9]{2}) (?:- )?([0-9]{2}):([0-9]{2}):([0-9]{2})(?:[.,]([0-9]{1,9}))?\z"
_COMPACT = r"^([0-9]{4})([0-9]{2})([0-9]{2})T?([0-9]{2})([0-9]{2})([0-9]{2})(Z?)\z"
_SHORT = r"^([0-9]{2})([0-9]{2}) ([0-9]{2}):([0-9]{2}):([0-9]{2})(?:[.,]([0-9]{1,9}))?\z"
_SYSLOG = r"^([A-Z][a-z]{2}) {1,2}([0-9]{1,2}) ([0-9]{2}):([0-9]{2}):([0-9]{2})(?:[.,]([0-9]{1,9}))?\z"
_MAIL = r"^(?:[A-Z][a-z]{2}, )?([0-9]{1,2}) ([A-Z][a-z]{2}) ([0-9]{4}) ([0-9]{2}):([0-9]{2}):([0-9]{2}) ([+-][0-9]{4}|[A-Z]{2,5})\z"
_SPOKEN = r"^([A-Z][a-z]{2}) ([0-9]{1,2}), ([0-9]{4}),? ([0-9]{1,2}):([0-9]{2}):([0-9]{2}) ([AP]M)\z"


def zone_abbreviations(spark: SparkSession) -> DataFrame:
    """``tz, abbr, minutes`` of every zone of the time zone database, over the last decades.

    A zone and its abbreviations are a fixed, short list (a few thousand rows).
    """
    from zoneinfo import ZoneInfo, available_timezones

    found = {}
    for name in sorted(available_timezones()):
        zone = ZoneInfo(name)
        for year in range(1995, 2036, 5):
            for month in (1, 7):
                at = datetime(year, month, 1, tzinfo=zone)
                if (abbr := at.tzname()) and abbr.isalpha():
                    found[name, abbr] = int(at.utcoffset() / timedelta(minutes=1))
    return spark.createDataFrame([(a, b, m) for (a, b), m in found.items()], "tz string, abbr string, minutes int")


def _frac_ms(digits: Column) -> Column:
    return F.rpad(F.coalesce(digits, F.lit("")), 3, "0").cast("long")


#: Notations in the order of their codes: pattern, and which group holds each field.
_FIELDS = ("y", "mo", "d", "h", "mi", "s", "fr", "z", "half")
_NOTATIONS = {
    "iso": (_ISO, {"y": 1, "mo": 2, "d": 3, "h": 4, "mi": 5, "s": 6, "fr": 7, "z": 8}),
    "clf": (_CLF, {"d": 1, "mo": 2, "y": 3, "h": 4, "mi": 5, "s": 6, "z": 7}),
    "dmy": (_DOT, {"d": 1, "mo": 2, "y": 3, "h": 4, "mi": 5, "s": 6, "fr": 7}),
    "slash": (_SLASH, {"y": 1, "mo": 2, "d": 3, "h": 4, "mi": 5, "s": 6, "fr": 7}),
    "compact": (_COMPACT, {"y": 1, "mo": 2, "d": 3, "h": 4, "mi": 5, "s": 6, "z": 7}),
    "short": (_SHORT, {"mo": 1, "d": 2, "h": 3, "mi": 4, "s": 5, "fr": 6}),
    "syslog": (_SYSLOG, {"mo": 1, "d": 2, "h": 3, "mi": 4, "s": 5, "fr": 6}),
    "mail": (_MAIL, {"d": 1, "mo": 2, "y": 3, "h": 4, "mi": 5, "s": 6, "z": 7}),
    "spoken": (_SPOKEN, {"mo": 1, "d": 2, "y": 3, "h": 4, "mi": 5, "s": 6, "half": 7}),
}
#: Stands between fields; no notation has it.
_MARK = "\uffff"
_CODE = {k: i for i, k in enumerate(_NOTATIONS)}
#: Codes of the two readings that are no notation of their own.
_MDY, _EPOCH = len(_NOTATIONS), len(_NOTATIONS) + 1


def interpretations(rows: DataFrame) -> DataFrame:
    """Add ``cands``, an array of (fmt, ms): every valid reading of ``text``.

    Needs ``text``, ``tz`` (zone of the host), ``minutes`` (offset of the text's abbreviation) and
    ``received_at``. Each step is a projection of its own, so nothing is worked out twice.
    """
    text = F.col("text")
    fmt = F.lit(None).cast("int")
    for name, (pattern, _) in reversed(_NOTATIONS.items()):
        fmt = F.when(text.rlike(pattern), _CODE[name]).otherwise(fmt)
    got = None
    for name, (pattern, at) in _NOTATIONS.items():
        # one match writes all fields in their order, with a mark between them
        parts = F.split(F.regexp_replace(text, pattern, _MARK.join(f"${at[f]}" if f in at else "" for f in _FIELDS)), _MARK)
        got = F.when(F.col("fmt") == _CODE[name], parts) if got is None else got.when(F.col("fmt") == _CODE[name], parts)
    rows = apart(rows.withColumn("fmt", fmt).withColumn("f", got))
    f = {k: F.col("f")[i] for i, k in enumerate(_FIELDS)}
    hour = f["h"].try_cast("int")
    hour = F.when(f["half"] == "", hour).when(hour.between(1, 12), hour % 12 + F.when(f["half"] == "PM", 12).otherwise(0))
    rows = rows.select(
        "*",
        f["y"].try_cast("int").alias("y"),
        F.coalesce(f["mo"].try_cast("int"), month_number(f["mo"])).alias("mo"),
        f["d"].try_cast("int").alias("d"),
        hour.alias("h"),
        _frac_ms(f["fr"]).alias("frac"),
        f["z"].alias("z"),
    )
    rows = apart(rows)
    yearless = F.col("fmt").isin(_CODE["short"], _CODE["syslog"])
    y, mo, d = F.col("y"), F.col("mo"), F.col("d")
    ry = F.year("received_at")
    # days that can be meant, as text: the one printed, and for some notations others
    day = lambda y, mo, d: F.concat_ws("-", y, mo, d)
    days = (
        F.when(yearless, F.array(day(ry, mo, d), day(ry - 1, mo, d), day(ry + 1, mo, d)))
        .when(F.col("fmt") == _CODE["dmy"], F.array(day(y, mo, d), day(y, d, mo)))
        .when(F.col("fmt").isNotNull(), F.array(day(y, mo, d)))
    )
    rows = apart(rows.select("*", days.alias("days"), F.concat_ws(":", F.col("h").cast("string"), f["mi"], f["s"]).alias("clock")))
    # the zone that rules the reading: the text's own, else the host's; offsets need none
    z = F.col("z")
    region = F.regexp_replace(z, r"[\[\]]", "")
    rows = rows.withColumn("zone", F.when(z == "", F.col("tz")).when(z.startswith("[") & region.rlike("/|^UTC$|^GMT$"), region))
    rows = rows.withColumn("shift", F.when(z == "Z", F.lit(0)).when(z.rlike(r"^[+-]"), offset_minutes(z)).when((z != "") & ~z.startswith("["), F.col("minutes")).cast("long"))
    # one lambda for all of them: written out, the code would be too large to be compiled

    def ms(day: Column) -> Column:
        at = F.concat(day, F.lit(" "), F.col("clock")).try_cast("timestamp_ntz")
        return F.when(F.col("zone").isNotNull(), zoned_ms(at, F.col("zone"))).otherwise(ntz_ms(at) - F.col("shift") * 60_000) + F.col("frac")

    rows = rows.withColumn("m", F.transform("days", ms))
    number, size = text.rlike(r"^[0-9]+\z"), F.length(text)
    whole = F.when(number & (size <= 18), text.try_cast("long"))
    epoch = (
        F.when(number & size.between(9, 10), whole * 1000)
        .when(number & size.between(12, 13), whole)
        .when(number & size.between(15, 16), F.expr("try_cast(text as long) div 1000"))
        .when(number & size.between(18, 19), F.substring(text, F.lit(1), size - 6).try_cast("long"))
        .when(text.rlike(r"^[0-9]{9,10}\.[0-9]{1,9}\z"), F.substring_index(text, ".", 1).try_cast("long") * 1000 + _frac_ms(F.substring_index(text, ".", -1)))
    )
    at = ntz_ms(F.col("received_at"))
    # the year nearest to the receipt; the earlier one of two
    nearest = F.array_min(F.transform(F.filter("m", lambda m: m.isNotNull()), lambda m: F.struct(F.abs(m - at).alias("gap"), m.alias("m"))))["m"]
    one = F.when(yearless, nearest).otherwise(F.try_element_at("m", F.lit(1)))
    made = F.array(
        F.struct(F.col("fmt").alias("fmt"), one.cast("long").alias("ms")),
        F.struct(F.lit(_MDY).alias("fmt"), F.when(~yearless, F.try_element_at("m", F.lit(2))).cast("long").alias("ms")),
        F.struct(F.lit(_EPOCH).alias("fmt"), epoch.cast("long").alias("ms")),
    )
    return rows.withColumn("cands", F.filter(made, lambda x: x["ms"].isNotNull()))


def candidates(stamps: DataFrame, hosts: DataFrame) -> DataFrame:
    """``stamp_id, source, line_offset, received_ms, cands``; unreadable values have no candidates.

    They are dropped in :func:`choose`.
    """
    spark = stamps.sparkSession
    zones = machine_names(hosts).join(hosts.select(F.lower("host").alias("machine"), "tz").groupBy("machine").agg(F.min("tz").alias("tz")), "machine")
    zones = broadcast_if_small(zones, "name", HOSTS_BROADCAST_ROWS).select(F.col("name").alias("__name"), "machine", "tz")
    text = strip(F.col("timestamp"))
    text = F.when(text.rlike(r"^\[(?:[^\[\]]|\[[^\[\]]*\])*\]\z"), strip(F.regexp_replace(text, r"^\[|\]\z", ""))).otherwise(text)
    base = stamps.select("stamp_id", "host", "file", "line_offset", "received_at", text.alias("text")).where("text <> ''")
    base = base.withColumn("abbr", F.regexp_extract("text", r" ?\b([A-Z]{2,5})\z", 1))
    own = F.broadcast(zone_abbreviations(spark)).select(F.col("tz").alias("__tz"), F.col("abbr").alias("__abbr"), "minutes")
    common = F.create_map(*[F.lit(v) for kv in COMMON_ZONES.items() for v in kv])
    joined = base.join(zones, F.lower("host") == F.col("__name"), "left")
    joined = joined.join(own, (F.col("tz") == F.col("__tz")) & (F.col("abbr") == F.col("__abbr")), "left")
    minutes = F.coalesce("minutes", F.try_element_at(common, F.col("abbr")))
    read = interpretations(joined.select("stamp_id", "machine", "host", "file", "line_offset", "received_at", "text", "tz", minutes.alias("minutes")))
    return read.select(
        "stamp_id",
        F.concat_ws("\x01", F.coalesce("machine", F.lower("host")), "file").alias("source"),
        "line_offset",
        ntz_ms(F.col("received_at")).alias("received_ms"),
        "cands",
    )


def emission(ms: int, received: int | None) -> float:
    """Cost of an instant by its distance from where a received value can lie, in days."""
    if received is None:
        return 0.0
    out = max(0, ms - received - EARLY_MS, received - LATE_MS - ms)
    return 0.0 if out == 0 else LATE_COST + out / DAY_MS


def step(a: tuple[int, int], b: tuple[int, int]) -> float:
    """Cost of one reading (notation, instant) behind another."""
    return SWITCH_COST * (a[0] != b[0]) + BACK_COST * (b[1] < a[1])


def preference(rank: int, ident: int) -> float:
    """What decides between equal costs: the readings listed first, the same ones in blocks of any size."""
    return rank * (1.0 + (ident * 2654435761 % 1000003) / 1000003) * 1e-7


Row = tuple[int | None, list[tuple[int, int]], int]


def viterbi(before: tuple[int, int] | None, rows: list[Row], after: tuple[int, int] | None) -> list[int]:
    """The instants of consecutive values; ``before`` and ``after``: (notation, instant) of settled ones.

    A row is (received, readings, a number that tells it from others).
    """
    costs: list[float] = [0.0] if before else []
    back: list[list[int]] = []
    prev: list[tuple[int, int]] = [before] if before else []
    for received, cands, ident in rows:
        now, links = [], []
        for rank, c in enumerate(cands):
            e = emission(c[1], received) + preference(rank, ident)
            if prev:
                k = min(range(len(prev)), key=lambda i: costs[i] + step(prev[i], c))
                now.append(costs[k] + step(prev[k], c) + e)
                links.append(k)
            else:
                now.append(e)
                links.append(-1)
        prev, costs = cands, now
        back.append(links)
    if after:
        costs = [x + step(p, after) for x, p in zip(costs, prev)]
    k = min(range(len(costs)), key=costs.__getitem__)
    out = []
    for (_, cands, _), links in zip(reversed(rows), reversed(back)):
        out.append(cands[k][1])
        k = links[k]
    return out[::-1]


class Border:
    """Least costs through a block: from each reading of its first value to each of its last."""

    def __init__(self, row: Row):
        self.first = row
        received, cands, ident = row
        inside = [emission(c[1], received) + preference(k, ident) for k, c in enumerate(cands)]
        self.costs = [[inside[i] if i == j else np.inf for j in range(len(cands))] for i in range(len(cands))]
        self.last = row

    def add(self, row: Row) -> None:
        received, cands, ident = row
        prev = self.last[1]
        steps = [[step(p, c) + emission(c[1], received) + preference(k, ident) for k, c in enumerate(cands)] for p in prev]
        self.costs = [[min(x + steps[j][k] for j, x in enumerate(line)) for k in range(len(cands))] for line in self.costs]
        self.last = row


def borders(blocks: list[tuple[list[tuple[int, int]], list[tuple[int, int]], list[list[float]]]]) -> list[tuple[int, int]]:
    """(place of the first value's reading, of the last one's) of each block of a source, in order."""
    total: list[float] = []
    back: list[list[tuple[int, int]]] = []
    prev: list[tuple[int, int]] = []
    for first, last, costs in blocks:
        enter = [min(((t + step(p, c), j) for j, (t, p) in enumerate(zip(total, prev))), default=(0.0, -1)) for c in first]
        best = [min((enter[i][0] + costs[i][k], i) for i in range(len(first))) for k in range(len(last))]
        back.append([(i, enter[i][1]) for _, i in best])
        total, prev = [x for x, _ in best], last
    k = min(range(len(total)), key=total.__getitem__)
    out = []
    for links in reversed(back):
        i, before = links[k]
        out.append((i, k))
        k = before
    return out[::-1]


def _readings(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, notations, instants) of the lists of a batch."""
    fmt, ms = batch.column("fmt"), batch.column("ms")
    if isinstance(batch, pa.Table):
        fmt, ms = fmt.combine_chunks(), ms.combine_chunks()
    offs = ms.offsets.to_numpy()
    return offs - offs[0], fmt.flatten().to_numpy(), ms.flatten().to_numpy()


_BORDERS = "source string, block long, chain long, first_fmt array<int>, first_ms array<long>, last_fmt array<int>, last_ms array<long>, costs array<double>"


def block_borders(ordered: DataFrame) -> DataFrame:
    """A row for each block of ``ordered``: readings of its first and last value, and the costs between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, border, name = None, None, None

        def done() -> pa.RecordBatch:
            (_, first, _), (_, last, _) = border.first, border.last
            cols = [[name[0]], [name[1]], [at], [[c[0] for c in first]], [[c[1] for c in first]], [[c[0] for c in last]], [[c[1] for c in last]], [[x for line in border.costs for x in line]]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["source", "block", "chain", "first_fmt", "first_ms", "last_fmt", "last_ms", "costs"])

        for batch in batches:
            if not batch.num_rows:
                continue
            offs, fv, mv = _readings(batch)
            chain = batch.column("chain").to_numpy()
            received, ids = batch.column("received_ms"), batch.column("ident").to_numpy()
            several = np.diff(offs) > 1
            starts = np.concatenate([[True], chain[1:] != chain[:-1]])
            ends = np.concatenate([starts[1:], [True]])
            # between two settled values nothing depends on a border: only values beside unsettled ones, and the ends of blocks, are looked at
            beside = several | np.concatenate([several[1:], [False]]) | np.concatenate([[False], several[:-1]])
            for i in np.flatnonzero(beside | starts | ends).tolist():
                row = (received[i].as_py(), list(zip(fv[offs[i] : offs[i + 1]].tolist(), mv[offs[i] : offs[i + 1]].tolist())), int(ids[i]))
                if chain[i] != at:
                    if border is not None:
                        yield done()
                    at, border, name = int(chain[i]), Border(row), (batch.column("source")[i].as_py(), batch.column("block")[i].as_py())
                else:
                    border.add(row)
        if border is not None:
            yield done()

    return ordered.mapInArrow(run, _BORDERS)


def solve_borders(found: DataFrame) -> DataFrame:
    """``chain, first, last``: the instants chosen for the first and the last value of each block."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        blocks = []
        for r in pdf.itertuples():
            n = len(r.last_ms)
            blocks.append((list(zip(r.first_fmt, r.first_ms)), list(zip(r.last_fmt, r.last_ms)), [list(r.costs[i * n : (i + 1) * n]) for i in range(len(r.first_ms))]))
        chosen = borders(blocks)
        return pd.DataFrame({"chain": pdf["chain"], "first": [b[0][i][1] for b, (i, _) in zip(blocks, chosen)], "last": [b[1][k][1] for b, (_, k) in zip(blocks, chosen)]})

    # sources whose borders are all settled need no choice
    open_border = F.max(((F.size("first_ms") > 1) | (F.size("last_ms") > 1)).cast("int")).over(Window.partitionBy("source"))
    return found.withColumn("open", open_border).where("open = 1").drop("open").groupBy("source").applyInPandas(one, "chain long, first long, last long")


def choose(cands: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``stamp_id, utc_ms``: one instant per value."""
    # readings of one instant are one reading; stored, as they are needed twice, and because a filter
    # on them would otherwise be pushed through every projection before
    one = F.array_min("cands.ms") == F.array_max("cands.ms")
    readings = stored(cands.select("stamp_id", "source", "line_offset", "received_ms", F.when(one, F.slice("cands", 1, 1)).otherwise(F.col("cands")).alias("cands"))).where("size(cands) > 0")
    at = F.coalesce("line_offset", F.lit(0))
    long = readings.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi")).where(F.col("n") > block_rows)
    width = F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) * block_rows / F.col("n")))
    long = broadcast_if_small(long.select(F.col("source").alias("source0"), "lo", width.alias("width")), "source0", SOURCES_BROADCAST)
    readings = readings.join(long, F.col("source") == F.col("source0"), "left").withColumn("block", F.coalesce(F.floor((at - F.col("lo")) / F.col("width")), F.lit(0)))
    readings = readings.withColumn("chain", F.xxhash64("source", "block")).withColumn("ident", F.pmod(F.xxhash64("stamp_id", "line_offset"), F.lit(1 << 31)))
    sort = ["chain", "line_offset", "stamp_id"]
    lists = lambda df: df.withColumn("fmt", F.col("cands.fmt")).withColumn("ms", F.col("cands.ms")).drop("cands")
    # a source of one block has no border inside
    chosen = solve_borders(block_borders(lists(readings.where("source0 is not null").repartition("chain").sortWithinPartitions(*sort))))
    chosen = chosen.select(F.col("chain").alias("chain0"), "first", "last")
    joined = readings.join(chosen, F.col("chain") == F.col("chain0"), "left").repartition("chain")
    here = Window.partitionBy("chain").orderBy("line_offset", "stamp_id")
    at_border = F.when(F.lag("chain").over(here).isNull(), F.col("first")).when(F.lead("chain").over(here).isNull(), F.col("last"))
    placed = joined.withColumn("wanted", at_border)
    fixed = F.when(F.col("wanted").isNotNull(), F.filter("cands", lambda x: x["ms"] == F.col("wanted"))).otherwise(F.col("cands"))
    ordered = lists(placed.select("stamp_id", "chain", "line_offset", "ident", "received_ms", fixed.alias("cands")).sortWithinPartitions(*sort)).drop("line_offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the open stretch at the end of the last batch, with the settled row before it

        def solve(t: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table | None]:
            offs, fv, mv = _readings(t)
            chain = t.column("chain").to_numpy()
            fresh = t.column("fresh").to_numpy(zero_copy_only=False)
            lo = np.minimum.reduceat(mv, offs[:-1]) if len(mv) else mv
            hi = np.maximum.reduceat(mv, offs[:-1]) if len(mv) else mv
            loose = lo != hi
            chosen = mv[offs[:-1]].copy()
            n, keep_from = len(chain), None
            received = t.column("received_ms").to_pylist() if loose.any() else []
            ids = t.column("ident").to_numpy()
            cand = lambda i: list(zip(fv[offs[i] : offs[i + 1]].tolist(), mv[offs[i] : offs[i + 1]].tolist()))
            at = np.flatnonzero(loose)
            i = 0
            while i < len(at):
                a = b = int(at[i])
                while i + 1 < len(at) and at[i + 1] == b + 1 and chain[b + 1] == chain[a]:
                    i, b = i + 1, b + 1
                i += 1
                if b == n - 1 and not last:
                    keep_from = a - 1 if a and chain[a - 1] == chain[a] else a
                    break
                before = cand(a - 1)[0] if a and chain[a - 1] == chain[a] else None
                after = cand(b + 1)[0] if b + 1 < n and chain[b + 1] == chain[a] else None
                chosen[a : b + 1] = viterbi(before, [(received[k], cand(k), int(ids[k])) for k in range(a, b + 1)], after)
            if keep_from is None and not last and n:
                keep_from = n - 1  # it may be the settled row before a stretch
                rest = t.slice(keep_from).set_column(t.column_names.index("fresh"), "fresh", pa.array([False]))
                show = fresh
            elif keep_from is not None:
                rest = t.slice(keep_from)
                if not loose[keep_from]:
                    flags = rest.column("fresh").to_pylist()
                    flags[0] = False
                    rest = rest.set_column(t.column_names.index("fresh"), "fresh", pa.array(flags))
                show = fresh & (np.arange(n) < keep_from + (0 if loose[keep_from] else 1))
            else:
                rest, show = None, fresh
            shown = t.column("stamp_id").combine_chunks().filter(pa.array(show))
            return pa.RecordBatch.from_arrays([shown, pa.array(chosen[show], pa.int64())], ["stamp_id", "utc_ms"]), rest

        for batch in batches:
            t = pa.Table.from_batches([batch]).append_column("fresh", pa.array(np.ones(batch.num_rows, dtype=bool)))
            if held is not None:
                t = pa.concat_tables([held, t]).combine_chunks()
            if t.num_rows:
                out, held = solve(t, False)
                if out.num_rows:
                    yield out
        if held is not None and held.num_rows:
            out, _ = solve(held, True)
            if out.num_rows:
                yield out

    return ordered.mapInArrow(run, f"stamp_id {cands.schema['stamp_id'].dataType.simpleString()}, utc_ms long")


def normalise(stamps: DataFrame, hosts: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``stamp_id, utc_ms`` of every value that means an instant."""
    return choose(candidates(stamps, hosts), block_rows)
