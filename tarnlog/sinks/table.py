"""The event table: DDL, checks, day partitions in query order, and retention."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlog.schema import CORE, ordered

RETENTION_DAYS = 30
SORT_KEY = ["service_name", "timestamp", "level", "trace_id"]
#: Names of the table properties that hold the retention in days and the order of rows.
RETENTION, SORTED_BY = "tarnlog.retention_days", "tarnlog.sorted_by"
_TYPES = {"timestamp": "TIMESTAMP_NTZ"}


def field_type(value: object) -> str:
    """Column type of a static field."""
    return "BOOLEAN" if isinstance(value, bool) else "BIGINT" if isinstance(value, int) else "DOUBLE" if isinstance(value, float) else "STRING"


def ddl(name: str, extra: dict[str, str] | None = None, days: int = RETENTION_DAYS) -> list[str]:
    """Statements that make the table, and that bring an older one's properties up to date. Safe to repeat.

    ``upgrade`` also adds the columns that an older table lacks.
    """
    types = {**dict.fromkeys(CORE, "STRING"), **(extra or {}), **_TYPES}
    body = ",\n".join(f"  `{c}` {types[c]}" for c in ordered(list(types)))
    create = f"CREATE TABLE IF NOT EXISTS {name} (\n{body},\n  `event_date` DATE\n)\nUSING parquet\nPARTITIONED BY (event_date)"
    keys = [c for c in SORT_KEY if c in types]
    return [create, f"ALTER TABLE {name} SET TBLPROPERTIES ('{RETENTION}' = '{days}', '{SORTED_BY}' = '{','.join(keys)}')"]


def missing_columns(spark: SparkSession, name: str, expected: Iterable[str]) -> list[str]:
    """Columns that the table lacks, by name."""
    return sorted(set(expected) - set(spark.table(name).columns))


def upgrade(spark: SparkSession, name: str, extra: dict[str, str] | None = None) -> None:
    """Create the table, or add the columns that it lacks."""
    for statement in ddl(name, extra):
        spark.sql(statement)
    types = {**dict.fromkeys(CORE, "STRING"), **(extra or {}), **_TYPES}
    if lacking := missing_columns(spark, name, types):
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {types[c]}' for c in lacking)})")


def healthcheck(spark: SparkSession, name: str, expected: Iterable[str]) -> None:
    """Fail with the reason if the table cannot take events."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist; run the DDL first")
    if lacking := missing_columns(spark, name, expected):
        raise ValueError(f"table {name} lacks columns: {', '.join(lacking)}")


def laid_out(events: DataFrame, salt: int = 8) -> DataFrame:
    """Events in the layout of the table: a day's rows together, sorted by what queries filter on.

    A day is spread over ``salt`` files, so a hot day is no single task; min/max statistics of
    row groups then skip by service and time.
    """
    dated = events.withColumn("event_date", F.to_date("timestamp"))
    keys = [c for c in SORT_KEY if c in events.columns]
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in keys if c not in ("timestamp", "level")]), F.lit(salt))
    return dated.withColumn("__s", spread).repartition("event_date", "__s").drop("__s").sortWithinPartitions("event_date", *keys)


def write(events: DataFrame, path: str, mode: str = "append") -> None:
    """Write Parquet by day, with a bloom filter for trace lookups."""
    out = laid_out(events).write.mode(mode).partitionBy("event_date")
    out.option("parquet.bloom.filter.enabled#trace_id", "true").option("compression", "zstd").parquet(path)


def expired(partitions: Iterable[str], today: str, days: int = RETENTION_DAYS) -> list[str]:
    """Partitions ``event_date=...`` that are older than the retention."""
    from datetime import date, timedelta

    limit = date.fromisoformat(today) - timedelta(days=days)
    return [p for p in partitions if date.fromisoformat(p.split("=", 1)[1]) < limit]


def drop_expired(spark: SparkSession, name: str, today: str, days: int | None = None) -> list[str]:
    """Drop whole day partitions past the retention, by default the one of the table's properties."""
    if days is None:
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        days = int(found.get(RETENTION, RETENTION_DAYS))
    old = expired([r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()], today, days)
    for p in old:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (event_date='{p.split('=', 1)[1]}')")
    return old
