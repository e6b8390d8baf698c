"""Find messages that were cut before their end, and how often each source cuts.

Storage limits. The length of each text is recomputed as a store may have measured it:
characters, UTF-8 bytes, UTF-16 units, after JSON escaping, entity escaping or newline
conversion. A hidden limit shows as a spike of one length under one of these encodings, in a
service or file or in all of its kind. A spike of whole texts has endings that are known to stand
at the end of texts, a limit cuts anywhere: spikes with mostly other endings are limits, any number
of them in a source and of any length. Rows on a limit are cut unless their own ending is a known
one; an ending seen too rarely to tell clears none.

Endings. Texts are split into tokens, values are masked by form, and the corpus is counted once:
how often each (two tokens before, token) ends a text and how often it goes on; which longer
tokens begin with it in the same place (neighbours in the order of a place's tokens, so their sum is
a difference of running sums); which id form rules a place. A text is cut if its last
token nearly always goes on, if it is the beginning of a token that is commoner there, or a
part of the id that belongs there. A marker of the collector, or a broken character at the end,
is a cut by itself. Endings that the program writes itself (dots, a count of further frames, no
full stop) are common endings in these counts, so they are no case.

All counts are over all rows; only aggregates over distinct token triples are joined back, by
128 bits of their hash. Defined results: null, empty and blank messages are no case; white space at the end
is ignored; every row counts, repeated or not; ids may be null or repeated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlog.functions.text import rstrip
from tarnlog.runtime import apart, broadcast_if_small, cut, stored

#: An ending is a cut if fewer than this share of its occurrences end a text ...
END_SHARE = 0.05
#: ... counted over this many occurrences; rarer triples are judged by the pair of tokens,
#: and where that is as rare, a row at a limit by the token alone.
FEW = 12
#: A beginning of a commoner token is a cut where those are this many times commoner; a token seen
#: FEW times or more by itself is likelier one of its own, and must be rarer still.
TIMES_COMMONER, TIMES_IF_MANY = 2.0, 15.0
#: Share of a place that an id form must have to rule it, and that another form must stay under.
RULES, STRAY = 0.3, 0.05
#: Rows on one length, and their ratio to the mean of the lengths around, that make a spike ...
LIMIT_ROWS, LIMIT_RATIO = 8, 8.0
#: ... and share of its rows without a known ending that makes it a limit.
LIMIT_OPEN = 0.5
#: Most sources whose spikes are broadcast; beyond it Spark chooses the join.
LIMITS_BROADCAST_ROWS = 100_000
#: Share of ends from which a triple is an ending of its own.
SURE_END = 0.5
#: Share of an ending seen too rarely to tell: no cut by itself, and not sure enough to clear a row at a limit.
UNKNOWN_END = 0.25

#: The collector's last line on a text that it cut itself.
MARKER = r"\n\.\.\. \[[^\]\n]* 截断：省略 [0-9]+ 行 / [0-9]+ 字节\]\z"

_IDS = [
    (r"\n", " ⏎ "),
    (r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "U"),
    (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "A"),
    (r"\b0x[0-9a-f]+", "X"),
    (r"\b(?=[a-f]*[0-9])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9a-f]{16}|[0-9a-f]{12}|[0-9a-f]{8})\b", "H"),
    (r"(?<![A-Za-z])[0-9]+", "0"),
]
_NAMES = [
    (r"\b[a-z]+(?:[-_][a-z]+)+\b", "w-w"),
    (r"\b[a-z]+(?:\.[A-Za-z]+)+", "j.j"),
    (r"\([A-Z][A-Za-z]*\.j", "(J.j"),
    # a frame that stops in its file's name begins the whole ones
    (r"j\.j\([A-Z][A-Za-z]*(\.?)\z", "j.j(J$1"),
    (r"/(?:[a-z0-9]+/)?w-w", "/p"),
]


def _replaced(c: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, p[0], p[1]), rules, c)


def encodings(text: Column) -> dict[str, Column]:
    """Lengths of a text as stores measure it."""
    n, lines = F.length(text), F.length(text) - F.length(F.replace(text, F.lit("\n")))
    count = lambda ch: F.length(text) - F.length(F.replace(text, F.lit(ch)))
    wide = F.length(F.regexp_replace(text, "[^\U00010000-\U0010ffff]", ""))
    return {
        "chars": n,
        "utf8": F.octet_length(text),
        "utf16": n + wide,
        "json": n + count('"') + count("\\") + count("\n") + count("\t") + count("\r"),
        "json_utf8": F.octet_length(text) + count('"') + count("\\") + count("\n") + count("\t") + count("\r"),
        "entities": n + 4 * count("&") + 3 * count("<") + 3 * count(">") + 5 * count('"') + 4 * count("'"),
        "crlf": n + lines,
        "crlf_utf8": F.octet_length(text) + lines,
    }


def source_of() -> Column:
    """Service where there is one, else the file without numbers and hashes; inside and outside pods are different stores."""
    plain = F.regexp_replace(F.coalesce("file", F.lit("")), r"(?<![A-Za-z0-9])[0-9a-f]*[0-9][0-9a-f]*(?![A-Za-z0-9])", "0")
    return F.concat_ws("|", kind_of(), F.coalesce(F.col("service_name"), plain))


def kind_of() -> Column:
    return F.when(F.col("pod").isNotNull(), "pod").otherwise("file")


KINDS = ["chars", "utf8", "utf16", "json", "json_utf8", "entities", "crlf", "crlf_utf8"]


def spikes(texts: DataFrame) -> DataFrame:
    """``source, encoding, len, rows`` of lengths that stand out, of ``texts(source, lens)``.

    ``lens`` holds the lengths in the order of ``KINDS``. Sources are counted by themselves and, as
    ``pod`` or ``file``, together. Of several encodings on one length, the one with most rows is
    kept, of those the plainest.
    """
    each = texts.select("source", F.posexplode("lens").alias("encoding", "len"))
    fine = each.groupBy("source", "encoding", "len").agg(F.count(F.lit(1)).alias("n"))
    hist = fine.unionByName(fine.withColumn("source", F.substring_index("source", "|", 1)).groupBy("source", "encoding", "len").agg(F.sum("n").alias("n")))
    near = F.expr("sum(n) over (partition by source, encoding order by len range between 8 preceding and 8 following)")
    found = hist.where("len > 0").withColumn("near", near).where((F.col("n") >= LIMIT_ROWS) & (F.col("n") > LIMIT_RATIO * (F.col("near") - F.col("n")) / 16))
    best = found.groupBy("source", "len").agg(F.max(F.struct("n", (-F.col("encoding")).alias("plain"))).alias("b"))
    return best.select("source", F.element_at(F.array(*[F.lit(k) for k in KINDS]), (1 - F.col("b.plain")).cast("int")).alias("encoding"), "len", F.col("b.n").alias("rows"))


def _tokens(logs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per text: its tokens with ids masked (x) and with names masked too (m), and what the verdict needs."""
    body = rstrip(F.col(text_col))
    base = logs.select(F.col(id_col).alias("id"), body.alias("text"), source_of().alias("source")).where("text <> ''")
    masked = base.withColumn("x", _replaced(F.col("text"), _IDS))
    masked = apart(masked.withColumn("m", _replaced(F.col("x"), _NAMES)))
    sizes = encodings(F.col("text"))
    return masked.select(
        "id",
        "source",
        F.array(*[sizes[k].cast("int") for k in KINDS]).alias("lens"),
        F.regexp_replace(F.substring_index(F.substring_index("text", "\n", -1), " ", -1), r"^['\"(\[]+", "").alias("tail"),
        F.when(F.col("text").rlike(MARKER), "marker").when(F.col("text").endswith("\ufffd"), "character").alias("plain"),
        F.split("x", " ").alias("x"),
        F.split("m", " ").alias("m"),
    )


def _last(c: str, k: int) -> Column:
    """The k-th token from the end, empty before the start."""
    return F.when(F.size(c) >= k, F.element_at(c, -k)).otherwise("")


def token_counts(tokens: DataFrame) -> DataFrame:
    """``l2, l1, m, x, total, ends``: the corpus counted by place."""
    none = F.array(F.lit(""))
    n = F.size("m")
    zipped = F.arrays_zip(F.slice(F.concat(none, none, "m"), F.lit(1), n).alias("l2"), F.slice(F.concat(none, "m"), F.lit(1), n).alias("l1"), F.col("m"), F.col("x"))
    spots = tokens.select(n.alias("n"), F.posexplode(zipped).alias("i", "s")).select("n", "i", F.col("s.l2").alias("l2"), F.col("s.l1").alias("l1"), F.col("s.m").alias("m"), F.col("s.x").alias("x"))
    return spots.groupBy("l2", "l1", "m", "x").agg(F.count(F.lit(1)).alias("total"), F.sum((F.col("i") == F.col("n") - 1).cast("long")).alias("ends"))


def _longer(words: DataFrame, col: str, total: str) -> DataFrame:
    """``l2, l1, <col>, longer_<col>``: total of the longer tokens that begin with each token that ends a text.

    ``words`` is ``l2, l1, <col>, <total>, ends``. In the order of a place's tokens, those that begin
    with one follow it up to its own copy with the last character behind it.
    """
    own = words.select("l2", "l1", F.col(col).alias("__e"), F.col(col).alias("__at"), F.col(total).alias("__n"), F.lit(0).alias("__end"))
    ends = words.where("ends > 0").select("l2", "l1", F.col(col).alias("__e"), F.concat(col, F.lit("\U0010ffff")).alias("__at"), F.lit(0).cast("long").alias("__n"), F.lit(1).alias("__end"))
    upto = F.sum("__n").over(Window.partitionBy("l2", "l1").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0))
    placed = own.unionByName(ends).withColumn("__upto", upto)
    at = lambda k: F.max(F.when(F.col("__end") == k, F.col("__upto")))
    return placed.groupBy("l2", "l1", F.col("__e").alias(col)).agg((at(1) - at(0)).alias(f"longer_{col}")).where(F.col(f"longer_{col}") > 0)


def endings(counts: DataFrame) -> DataFrame:
    """``l2, l1, m, x, share, commoner, ruler``: what speaks against each ending that occurs."""
    triple = counts.groupBy("l2", "l1", "m").agg(F.sum("total").alias("t3"), F.sum("ends").alias("e3"))
    pair = counts.groupBy("l1", "m").agg(F.sum("total").alias("t2"), F.sum("ends").alias("e2"))
    single = counts.groupBy("m").agg(F.sum("total").alias("t1"), F.sum("ends").alias("e1"))
    # how often longer tokens begin with a token, in the same place; once as written, once masked
    word = counts.groupBy("l2", "l1", "x").agg(F.sum("total").alias("tx"), F.sum("ends").alias("ends"))
    longer_x = _longer(word, "x", "tx")
    longer_m = _longer(triple.withColumnRenamed("e3", "ends"), "m", "t3")
    # the same by the token before alone, for places that are rare
    any_word = counts.groupBy("l1", "x").agg(F.sum("total").alias("ty"), F.sum("ends").alias("ends"))
    longer_y = _longer(any_word.withColumn("l2", F.lit("")), "x", "ty").select("l1", "x", F.col("longer_x").alias("longer_y"))
    form = F.regexp_extract("m", r"^['\"(\[]*(U|A|H|X)\b", 1)
    place = counts.groupBy("l2", "l1").agg(F.sum("total").alias("tp"))
    rulers = (
        counts.withColumn("form", form).where("form <> ''").groupBy("l2", "l1", "form").agg(F.sum("total").alias("tf")).groupBy("l2", "l1").agg(F.max(F.struct("tf", "form")).alias("f"))
    )
    ruled = rulers.join(place, ["l2", "l1"]).where(F.col("f.tf") >= RULES * F.col("tp")).select("l2", "l1", "tp", F.col("f.form").alias("ruler"))
    at_end = counts.where("ends > 0")
    joined = (
        at_end.join(triple, ["l2", "l1", "m"])
        .join(pair, ["l1", "m"])
        .join(single, "m")
        .join(word.drop("ends"), ["l2", "l1", "x"])
        .join(longer_x, ["l2", "l1", "x"], "left")
        .join(longer_m, ["l2", "l1", "m"], "left")
        .join(any_word.drop("ends"), ["l1", "x"])
        .join(longer_y, ["l1", "x"], "left")
        .join(ruled, ["l2", "l1"], "left")
    )

    def times(longer: str, total: str) -> Column:
        """How many times commoner the longer tokens are, on the scale of TIMES_COMMONER."""
        return F.coalesce(longer, F.lit(0)) / F.col(total) * F.when(F.col(total) >= FEW, TIMES_COMMONER / TIMES_IF_MANY).otherwise(1.0)

    own = F.coalesce(F.regexp_extract("m", r"^['\"(\[]*(U|A|H|X)\b", 1), F.lit(""))
    return joined.select(
        "l2",
        "l1",
        "m",
        "x",
        # rare by the pair too: the token alone may clear a row at a limit, but is no evidence of a cut
        F.when(F.col("t3") >= FEW, F.col("e3") / F.col("t3"))
        .when(F.col("t2") >= FEW, F.col("e2") / F.col("t2"))
        .when(F.col("t1") >= FEW, F.greatest(F.col("e1") / F.col("t1"), F.lit(END_SHARE)))
        .otherwise(UNKNOWN_END)
        .alias("share"),
        F.greatest(
            times("longer_x", "tx"),
            times("longer_m", "t3"),
            F.when(F.col("t3") < FEW, times("longer_y", "ty")).otherwise(0.0),
        ).alias("commoner"),
        F.when((own != F.col("ruler")) & (F.col("t3") < STRAY * F.col("tp")), F.col("ruler")).otherwise("").alias("ruler"),
    )


def _part_of_ruler() -> Column:
    """The last token of the text is a part of the id form that rules its place."""
    size = F.length("tail")
    part = (
        F.when(F.col("ruler") == "H", F.col("tail").rlike(r"^[0-9a-f]*\z"))
        .when(F.col("ruler") == "U", F.col("tail").rlike(r"^[0-9a-f-]*\z") & (size < 36))
        .when(F.col("ruler") == "A", F.col("tail").rlike(r"^[0-9.]*\z"))
        .when(F.col("ruler") == "X", F.col("tail").rlike(r"^0?x?\z"))
    )
    return F.coalesce(part, F.lit(False))


def _keys(l2: Column, l1: Column, m: Column, x: Column) -> list[Column]:
    """128 bits that name a place and its token."""
    return [F.xxhash64(l2, l1, m, x).alias("key"), F.xxhash64(F.lit("second"), x, m, l1, l2).alias("key2")]


def verdicts(logs: DataFrame, id_col: str = "row_id", text_col: str = "message") -> DataFrame:
    """``id, source, evidence`` of each cut text: marker, character, limit, part or ending."""
    # the text is masked once; what follows reads tokens and lengths
    tokens = stored(_tokens(logs, id_col, text_col))
    marks = endings(cut(token_counts(tokens.where("plain is null or plain <> 'marker'"))))
    suspects = marks.where((F.col("share") < SURE_END) | (F.col("commoner") > TIMES_COMMONER) | (F.coalesce("ruler", F.lit("")) != ""))
    suspects = suspects.select(*_keys(*[F.col(c) for c in ("l2", "l1", "m", "x")]), "share", "commoner", "ruler")
    found = cut(spikes(tokens))
    slack = F.when(F.col("encoding").isin("utf8", "json_utf8", "crlf_utf8"), 3).otherwise(0)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("encoding")).cast("int")
    # one row a source, with its spikes; a source has few, as each takes LIMIT_ROWS rows on a length of its own
    listed = found.groupBy("source").agg(F.collect_list(F.struct(place.alias("k"), "len", slack.alias("slack"))).alias("spikes"))
    own = broadcast_if_small(listed, "source", LIMITS_BROADCAST_ROWS)
    kinds = F.broadcast(listed.where("source in ('pod', 'file')").withColumnRenamed("source", "kind").withColumnRenamed("spikes", "of_kind"))
    within = lambda s: (F.element_at("lens", s["k"]) <= s["len"]) & (F.element_at("lens", s["k"]) >= s["len"] - s["slack"])
    hits = lambda c, name: F.transform(F.filter(F.coalesce(F.col(c), F.array().cast(listed.schema["spikes"].dataType)), within), lambda s: F.concat_ws("|", name, s["len"].cast("string"), s["k"].cast("string")))
    rows = (
        tokens.withColumn("kind", F.substring_index("source", "|", 1))
        .join(own, "source", "left")
        .join(kinds, "kind", "left")
        .select("id", "source", *_keys(_last("m", 3), _last("m", 2), _last("m", 1), _last("x", 1)), "tail", "plain", F.concat(hits("spikes", F.col("source")), hits("of_kind", F.col("kind"))).alias("hits"))
    )
    joined = rows.join(suspects, ["key", "key2"], "left")
    told = F.when((F.col("share") < END_SHARE) | (F.col("commoner") > TIMES_COMMONER), "ending").when(_part_of_ruler(), "part")
    open_end = F.coalesce(F.col("share") < SURE_END, F.lit(False)) | told.isNotNull()
    judged = stored(joined.where("plain is not null or key is not null").select("id", "source", "plain", "hits", told.alias("told"), open_end.alias("open")).where("plain is not null or told is not null or size(hits) > 0"))
    limits = judged.select(F.explode("hits").alias("hit"), "open").groupBy("hit").agg(F.avg(F.col("open").cast("int")).alias("share")).where(F.col("share") >= LIMIT_OPEN).select("hit")
    limited = judged.where("open").select("id", F.explode("hits").alias("hit")).join(limits, "hit").select("id").distinct().withColumn("at_limit", F.lit(True))
    evidence = F.coalesce("plain", F.when(F.col("at_limit"), "limit"), "told")
    return judged.join(limited, "id", "left").select("id", "source", evidence.alias("evidence")).where("evidence is not null")


def report(logs: DataFrame, found: DataFrame, id_col: str = "row_id") -> DataFrame:
    """``service_name, file, n_rows, n_cut, share`` per service and file, and how many rows each evidence told."""
    cut_ids = found.select(F.col("id").alias(id_col), F.col("evidence").alias("__cut"))
    joined = logs.select(id_col, "service_name", "file").join(cut_ids, id_col, "left")
    by = [F.count(F.when(F.col("__cut") == k, 1)).alias(f"n_{k}") for k in ("limit", "marker", "character", "part", "ending")]
    return joined.groupBy("service_name", "file").agg(F.count(F.lit(1)).alias("n_rows"), F.count("__cut").alias("n_cut"), (F.count("__cut") / F.count(F.lit(1))).alias("share"), *by)
