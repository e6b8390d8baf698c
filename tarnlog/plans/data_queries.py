"""Registered queries of the general data problems (p4, p5, p6), and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlog.operators import delivery, fields, stamps
from tarnlog.runtime import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = delivery.surplus(table(spark, sf_dir, "log_events"), table(spark, sf_dir, "hosts"))
    return lost.select(F.col("ord").alias("row_id"))


def p4_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.without_repeats(table(spark, sf_dir, "log_events"), table(spark, sf_dir, "hosts"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fields.entries(table(spark, sf_dir, "raw_lines"))
    return found.withColumn("message_md5", F.md5(F.col("message").cast("binary"))).drop("message")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamps.normalise(table(spark, sf_dir, "raw_stamps"), table(spark, sf_dir, "hosts"))


_P4_KEY = r"""
with names as (
  select lower(host) as name, lower(host) as machine from hosts
  union
  select lower(fqdn), lower(host) from hosts
), keyed as (
  select l.*, row_number() over (
    partition by coalesce(n.machine, lower(l.host)),
      case when pod is not null then concat('pod|', coalesce(namespace, '?'), '|', pod, '|', coalesce(container, '?'))
           else concat('file|', coalesce(regexp_replace(file, '\.[0-9]{8}-[0-9]{6}$', ''), '?')) end,
      date_trunc('millisecond', "timestamp"),
      regexp_replace(message, '\s+$', '')
    order by row_id) as copy
  from log_events l left join names n on lower(l.host) = n.name
)
"""

QUERIES = {"p4_found": p4_found, "p4_kept": p4_kept, "p5_found": p5_found, "p6_found": p6_found}

ORACLE = {
    "p4_found": _P4_KEY + "select row_id from keyed where copy > 1",
    "p4_kept": _P4_KEY + "select * exclude (copy) from keyed where copy = 1",
}
