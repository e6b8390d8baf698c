"""Keep exactly one copy of messages that were delivered at least once.

Identity. Rows are copies if machine, log file, instant (truncated to ms) and text (white space
at its end aside) are the same. A machine goes by any name that ``hosts`` lists, in any case. A
row with a pod has the one log of its container (namespace, pod, container), whichever path it
was read by; any other file keeps its identity when rotation adds ``.yyyymmdd-hhmmss``.

Plan. Only a 128-bit key, the delivery order and the row's place in its file are shuffled. The
first copy per key is found by a partial aggregate (hot keys shrink before the shuffle); keys
with one copy end there. Surplus rows come from joining the narrow rows with the remaining keys
under a salt, so that a key with a third of all rows spreads over many tasks; the number of salts
follows the copies of the commonest key. The wide payload is never shuffled: surplus places become
one deletion vector per file, and each task that reads a part of a file drops those positions.

Defined results: null is a value of its own in every part of the key; order is ``row_id``, and of
rows with the same order one is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlog.functions.text import rstrip
from tarnlog.functions.timefmt import ntz_ms
from tarnlog.runtime import broadcast_if_small, shared_path, stored

#: Copies of one key that one task handles; keys with more are spread over several.
SALT_ROWS = 200_000
#: Most rows of the table of machine names that are broadcast; beyond it Spark chooses the join.
HOSTS_BROADCAST_ROWS = 100_000
#: Most folders of deletion vectors; up to that, each file of the table has one of its own.
VECTOR_PARTS = 4096


def machine_names(hosts: DataFrame) -> DataFrame:
    """``name, machine``: every listed name in lower case and the machine it means."""
    pair = hosts.select(F.lower("host").alias("machine"), F.explode(F.array(F.lower("host"), F.lower("fqdn"))).alias("name"))
    return pair.where("name is not null").groupBy("name").agg(F.min("machine").alias("machine"))


def with_machine(df: DataFrame, hosts: DataFrame, host_col: str = "host", to: str = "machine") -> DataFrame:
    """Add the canonical machine; a name that is not listed stands for itself, in lower case."""
    names = broadcast_if_small(machine_names(hosts), "name", HOSTS_BROADCAST_ROWS).select(F.col("name").alias("__name"), F.col("machine").alias("__machine"))
    return df.join(names, F.lower(df[host_col]) == F.col("__name"), "left").withColumn(to, F.coalesce("__machine", F.lower(df[host_col]))).drop("__name", "__machine")


def log_file_key() -> Column:
    """One text per log file."""
    null = F.lit("\x00")
    inside = F.concat_ws("\x01", F.lit("pod"), F.coalesce("namespace", null), F.col("pod"), F.coalesce("container", null))
    outside = F.concat_ws("\x01", F.lit("file"), F.coalesce(F.regexp_replace("file", r"\.[0-9]{8}-[0-9]{6}\z", ""), null))
    return F.when(F.col("pod").isNotNull(), inside).otherwise(outside)


def narrow(scan: DataFrame, hosts: DataFrame) -> DataFrame:
    """``k1, k2, ord, path, pos`` of each row of a Parquet scan of log events."""
    base = scan.select(
        "host",
        log_file_key().alias("log_file"),
        ntz_ms(F.col("timestamp")).alias("ms"),
        rstrip(F.col("message")).alias("body"),
        F.col("row_id").alias("ord"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("pos"),
    )
    null = F.lit("\x00")
    parts = [F.coalesce(F.col("machine"), null), F.col("log_file"), F.coalesce(F.col("ms"), F.lit(-1 << 62)), F.coalesce(F.col("body"), null)]
    keyed = with_machine(base, hosts)
    return keyed.select(F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("k2"), "ord", "path", "pos")


def surplus(scan: DataFrame, hosts: DataFrame) -> DataFrame:
    """``ord, path, pos`` of every row that is not the first copy of its message."""
    rows = narrow(scan, hosts).withColumn("place", F.xxhash64("path", "pos"))
    first = rows.groupBy("k1", "k2").agg(F.min("ord").alias("first_ord"), F.min_by("place", "ord").alias("first_place"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = stored(first)
    salts = int((first.agg(F.max("n")).first()[0] or 1) // SALT_ROWS) + 1
    first = first.select("k1", "k2", "first_ord", "first_place", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod("place", F.lit(salts)).cast("int"))
    joined = salted.join(first, ["k1", "k2", "salt"])
    return joined.where("not (ord <=> first_ord and place = first_place)").select("ord", "path", "pos")


def write_vectors(lost: DataFrame, files: int = 64) -> str:
    """Write one sorted list of positions per file of a table with so many files; returns their folder."""
    spark = lost.sparkSession
    parts = max(1, min(files, VECTOR_PARTS))
    folder = shared_path(spark, f"vectors-{parts}")
    (
        lost.select("path", "pos", F.pmod(F.xxhash64("path"), F.lit(parts)).cast("int").alias("part"))
        .repartition("part", "path")
        .sortWithinPartitions("part", "path", "pos")
        .write.partitionBy("part")
        .parquet(folder)
    )
    return folder


def apply_vectors(scan: DataFrame, folder: str, columns: list[str] | None = None) -> DataFrame:
    """The scan without the positions listed in ``folder``; rows are not shuffled."""
    columns = columns or scan.columns
    schema = scan.select(*columns).schema
    parts = int(folder.rsplit("/", 1)[1].split("-")[1])
    tagged = scan.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)],
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.row_index").alias("__pos"),
        F.pmod(F.xxhash64(F.col("_metadata.file_path")), F.lit(parts)).cast("int").alias("__part"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
        known: dict[str, np.ndarray] = {}

        def vector(path: str, part: int) -> np.ndarray:
            if path not in known:
                known.clear()
                at = f"{base}/part={part}"
                if filesystem.get_file_info(at).type == fs.FileType.NotFound:
                    known[path] = np.zeros(0, dtype=np.int64)
                else:
                    found = ds.dataset(at, filesystem=filesystem, format="parquet").to_table(columns=["pos"], filter=pc.field("path") == path)
                    known[path] = np.sort(found.column("pos").to_numpy())
            return known[path]

        for batch in batches:
            paths = batch.column("__path").dictionary_encode()
            codes, pos, parts = paths.indices.to_numpy(), batch.column("__pos").to_numpy(), batch.column("__part").to_numpy()
            keep = np.ones(batch.num_rows, dtype=bool)
            for k, path in enumerate(paths.dictionary.to_pylist()):
                here = np.flatnonzero(codes == k)
                gone = vector(path, int(parts[here[0]]))
                if len(gone):
                    at = np.searchsorted(gone, pos[here])
                    at[at == len(gone)] = len(gone) - 1
                    keep[here] = gone[at] != pos[here]
            yield batch.select(range(len(columns))).filter(pa.array(keep)).rename_columns([f"c{i}" for i in range(len(columns))])

    from pyspark.sql.types import StructField, StructType

    inner = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema.fields)])
    out = tagged.mapInArrow(run, inner)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def without_repeats(scan: DataFrame, hosts: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One copy of each message, with its whole payload (or ``columns`` of it)."""
    return apply_vectors(scan, write_vectors(surplus(scan, hosts), len(scan.inputFiles())), columns)
