"""Collapse runs of consecutive events that one statement wrote.

Each event is compared with its predecessor by a lag window, changes are flagged, their running
sum names the run, and runs are aggregated. A sequence may hold a third of all rows, so this
happens in two levels: first inside (sequence, time bucket), then only for the first and last
run of each bucket, which are the only ones that can go on across a border. Buckets are as wide as
``BUCKET_ROWS`` events of their sequence take on average, so no task ever sees a whole sequence,
however dense it is.

Two events are of one statement if their masked texts, all lines of them, are equal. A text that
was cut lacks fixed words of its statement, so it is equal to texts cut alike only, and ends a run
of whole ones. Defined results: rows with a null sequence are left out; null timestamps sort first
and give a null duration; null messages equal each other; runs shorter than ``least`` are not
returned; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlog.functions.timefmt import ntz_ms
from tarnlog.llm.statements import masked, statements
from tarnlog.operators import delivery
from tarnlog.runtime import broadcast_if_small, cut, stored

#: Events of a sequence that a time bucket holds on average.
BUCKET_ROWS = 20_000
#: Sequences, and distinct masked texts (24 bytes each), that are broadcast at most.
SEQUENCES_BROADCAST, TEMPLATES_BROADCAST = 100_000, 200_000


def collapse(events: DataFrame, least: int = 2, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``seq, first_id, last_id, n_events, duration_ms`` of ``events(seq, ts, id, stmt)``.

    ``events`` is read twice, so hand over a table.
    """
    rows = events.where("seq is not null").withColumn("ms", ntz_ms(F.col("ts")))
    spans = rows.groupBy("seq").agg(F.min("ms").alias("lo"), F.greatest(F.lit(1), F.ceil((F.max("ms") - F.min("ms") + 1) * bucket_rows / F.count(F.lit(1)))).alias("width"))
    spans = broadcast_if_small(spans, "seq", SEQUENCES_BROADCAST).withColumnRenamed("seq", "seq0")
    rows = rows.join(spans, F.col("seq") == F.col("seq0")).withColumn("bucket", F.floor((F.col("ms") - F.col("lo")) / F.col("width"))).drop("seq0", "lo", "width")
    inside = Window.partitionBy("seq", "bucket").orderBy(F.col("ts").asc_nulls_first(), "id")
    start = F.when(F.row_number().over(inside) == 1, 1).when(F.col("stmt").eqNullSafe(F.lag("stmt").over(inside)), 0).otherwise(1)
    flagged = rows.withColumn("start", start).withColumn("run", F.sum("start").over(inside))
    last_run = F.max("run").over(Window.partitionBy("seq", "bucket"))
    parts = (
        flagged.groupBy("seq", "bucket", "run")
        .agg(
            F.min(F.struct("ts", "id")).alias("lo"),
            F.max(F.struct("ts", "id")).alias("hi"),
            F.first("stmt").alias("stmt"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("edge", (F.col("run") == 1) | (F.col("run") == last_run))
    )
    finish = lambda df: df.select(
        "seq",
        F.col("lo.id").alias("first_id"),
        F.col("hi.id").alias("last_id"),
        F.col("n").alias("n_events"),
        (ntz_ms(F.col("hi.ts")) - ntz_ms(F.col("lo.ts"))).alias("duration_ms"),
    )
    across = Window.partitionBy("seq").orderBy(F.col("bucket").asc_nulls_first(), "run")
    joins = (F.lag("bucket").over(across).eqNullSafe(F.col("bucket")) == F.lit(False)) & F.col("stmt").eqNullSafe(F.lag("stmt").over(across))
    # the first and the last run of a bucket with more than two runs are not neighbours, and never join
    begin = F.when(F.row_number().over(across) == 1, 1).when(joins, 0).otherwise(1)
    edges = parts.where("edge").withColumn("begin", begin).withColumn("g", F.sum("begin").over(across))
    merged = edges.groupBy("seq", "g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
    return finish(parts.where("not edge")).unionByName(finish(merged)).where(F.col("n_events") >= least)


def statement_runs(lines: DataFrame, least: int = 2) -> DataFrame:
    """Runs of ``lines(seq, ts, id, template)``, rows with masked texts.

    ``lines`` is read twice: once to learn the statements, once to order the events.
    """
    keys = lambda c: [F.xxhash64(c).alias("k1"), F.xxhash64(F.lit("second"), c).alias("k2")]
    # texts stay behind: a text is joined by 128 bits of its hash, a statement is compared by 64
    known = cut(statements(lines).select(*keys("template"), F.xxhash64("statement").alias("stmt")))
    narrow = lines.select("seq", "ts", "id", F.col("template").isNull().alias("none"), *keys("template"))
    events = narrow.join(broadcast_if_small(known, "k1", TEMPLATES_BROADCAST), ["k1", "k2"], "left").select("seq", "ts", "id", F.when(~F.col("none"), F.col("stmt")).alias("stmt"))
    return collapse(events, least)


def pod_runs(scan: DataFrame, hosts: DataFrame, least: int = 2) -> DataFrame:
    """Runs of the rows of each pod of a Parquet scan of log events, repeated deliveries aside."""
    folder = delivery.write_vectors(delivery.surplus(scan, hosts), len(scan.inputFiles()))
    masks = scan.where("pod is not null").withColumn("template", masked(F.col("message")))
    lines = delivery.apply_vectors(masks, folder, ["pod", "timestamp", "row_id", "template"])
    return statement_runs(stored(lines.toDF("seq", "ts", "id", "template")), least)
