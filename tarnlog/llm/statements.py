"""Tell the fixed words of a log statement from the values that a program inserts.

Values are recognised by their form (numbers, ids, addresses, paths, sizes, durations, names
joined by hyphens, dots or underscores), and by their place: a plain word is a value where the
corpus shows values of other forms, or many different words, between the same neighbours. All
lines of a message count: a differing fixed word below its first line is another statement too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlog.functions.text import rstrip
from tarnlog.llm.truncation import MARKER
from tarnlog.runtime import cut, stored

#: (pattern, replacement), applied in order to the lines of a message; none goes beyond a line.
_VALUES = [
    (r"\{\".*", "#"),  # a JSON body, to its end or to where the text stops
    # paths; names; tokens with a digit, dots inside included; columns
    (r"/[^ \n,;:'\"()]*|\b[A-Za-z0-9]+(?:[-_][A-Za-z0-9]*)+|\b(?=[0-9a-zA-Z.]*[0-9])[0-9a-zA-Z]+(?:[.:][0-9a-zA-Z]+)*|\b[a-z]\.[a-z]+\b", "#"),
    (r"# ?(?:[KMGT]i?B?|bytes|ms|s|us|ns|µs|毫秒)(?![\p{L}])", "#"),
    (r"#(?:,? (?:-> )?#)+", "#"),
]

#: The token that stands for a line end.
LINE_END = "⏎"
#: A word is a value where values of other forms fill this share of the same place ...
SLOT_SHARE = 0.3
#: ... or where at least this many different words do.
SLOT_WORDS = 8
#: A word counts as one of them if it fills this share of the place; cut-off words are rarer.
WORD_SHARE = 0.01


def masked(message: Column) -> Column:
    """The text with values replaced by ``#`` and each line end by a token of its own.

    The collector's marker on a text that it cut is no part of the text.
    """
    text = rstrip(F.regexp_replace(rstrip(message), MARKER, ""))
    values = reduce(lambda c, p: F.regexp_replace(c, p[0], p[1]), _VALUES, text)
    return F.regexp_replace(values, r"[ \t\r]*\n", f" {LINE_END} ")


def _places(tokens: Column) -> Column:
    """An array of (left two tokens, word, right token) over the plain words of a text; line ends close a line."""
    none = F.array(F.lit(""))
    t = F.coalesce(tokens, none)
    n = F.size(t)
    # shifted copies: a look-up inside a lambda would split the text again for each word
    return F.arrays_zip(
        F.slice(F.concat(none, none, t), F.lit(1), n).alias("l2"),
        F.slice(F.concat(none, t), F.lit(1), n).alias("l1"),
        t.alias("word"),
        F.slice(F.concat(F.transform(t, lambda x: F.when(x != LINE_END, x).otherwise("")), none), F.lit(2), n).alias("r1"),
    )


def bare(token: Column) -> Column:
    """A token without the marks around it."""
    return F.regexp_replace(token, r"^['\"(\[]+|['\")\],:;.]+$", "")


def value_words(words: DataFrame) -> DataFrame:
    """``l2, l1, r1, kind`` of the plain words that stand where values stand.

    ``words`` is ``l2, l1, r1, kind, n``: how often each bare word stands in each place.
    """
    place = Window.partitionBy("l2", "l1", "r1")
    slots = (
        words.withColumn("all", F.sum("n").over(place))
        .groupBy("l2", "l1", "r1")
        .agg(
            F.sum(F.when(F.col("kind") == "#", F.col("n")).otherwise(0)).alias("values"),
            F.first("all").alias("all"),
            F.count(F.when(F.col("kind").rlike(r"^\p{Ll}+$") & (F.col("n") >= WORD_SHARE * F.col("all")), 1)).alias("words"),
        )
    )
    open_slots = slots.where((F.col("values") >= SLOT_SHARE * F.col("all")) | (F.col("words") >= SLOT_WORDS))
    return words.where(F.col("kind").rlike(r"^\p{Ll}+$")).join(open_slots, ["l2", "l1", "r1"]).select("l2", "l1", "r1", "kind")


def statements(lines: DataFrame, col: str = "template") -> DataFrame:
    """``template, statement`` of each distinct masked text of ``lines``.

    The lines shrink to distinct masked texts by a partial aggregate first; all learning runs on
    those. Words in value places become ``#``, so lines that differ there share a statement.
    """
    spark = lines.sparkSession
    counted = lines.where(F.col(col).isNotNull()).select(F.col(col).alias("template")).groupBy("template").agg(F.count(F.lit(1)).alias("n"))
    templates = cut(counted).withColumn("tid", F.monotonically_increasing_id())
    # few rows become many: spread them over all tasks first
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = templates.repartition(tasks, "tid").select("tid", "n", F.posexplode(_places(F.split("template", " "))).alias("i", "p"))
    placed = stored(placed.select("tid", "n", "i", "p.*").withColumn("kind", bare(F.col("word"))))
    values = value_words(placed.groupBy("l2", "l1", "r1", "kind").agg(F.sum("n").alias("n"))).withColumn("hit", F.lit(True))
    looked = placed.join(values, ["l2", "l1", "r1", "kind"], "left")
    word = F.when(F.col("hit"), F.expr("replace(word, kind, '#')")).otherwise(F.col("word"))
    made = looked.select("tid", "i", word.alias("w")).groupBy("tid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]), " ").alias("statement"))
    return templates.join(made, "tid").select("template", "statement")
