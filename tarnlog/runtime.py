"""Session-level helpers shared by every operator."""

from __future__ import annotations

import atexit
import logging
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text in a table that is broadcast, at most.
BROADCAST_BYTES = 32 << 20
CHECKPOINT_CONF = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table (a file or a directory of parts) of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names; a private one only where none is named.

    A machine-local folder would lose data with its machine, so it is chosen only in local
    mode; elsewhere a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tarnlog-checkpoint-"))
    else:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so a lost executor costs a re-read only."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, key: str, most: int, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when ``df`` has at most ``most`` rows and ``most_bytes`` of text.

    Both are checked with one limited aggregate; ``key`` is any column. Beyond, Spark chooses.
    """
    texts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("long") for f in df.schema.fields if f.dataType.simpleString() == "string"]
    n, size = df.limit(most + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(reduce(lambda a, b: a + b, texts, F.lit(0).cast("long"))), F.lit(0))).first()
    return F.broadcast(df) if n <= most and size <= most_bytes else df


def apart(df: DataFrame) -> DataFrame:
    """End a stage of generated code here, without moving any row.

    A long chain of projections otherwise becomes one method too large for the JVM to compile, which
    then runs interpreted. Asking for at most more partitions than there are changes none.
    """
    return df.coalesce(1 << 20)


#: Folders that this process wrote below the shared folder.
_WRITTEN: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; :func:`release` removes what was written there."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """As :func:`cut`, but as a compressed table in the shared folder, for data as large as the input."""
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> int:
    """Remove the stored tables and vectors of this process, once their results are written; returns how many.

    Results that are not yet computed lose their source. The end of the process does the same.
    """
    n = 0
    while _WRITTEN:
        at = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))
    return n


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _WRITTEN:
        try:
            release(spark)
        except Exception as e:  # the session may be gone
            logging.getLogger(__name__).debug("stored tables are left: %s", e)
