"""Registered queries of the problems tagged llm, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlog.llm import bpe, distinct, langid, packing, runs, truncation
from tarnlog.runtime import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.distinct_traces(table(spark, sf_dir, "log_events"), table(spark, sf_dir, "hosts"))


def p1_registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.trace_registers(table(spark, sf_dir, "log_events"), table(spark, sf_dir, "hosts"))


def p1_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates against exact counts, per level: groups, ids, and whether 99 % of the groups are within bounds."""
    keys = ["day", "service_name", "host"]
    events = distinct.trace_events(table(spark, sf_dir, "log_events"), table(spark, sf_dir, "hosts")).where("trace_id is not null")
    exact = events.cube(*keys).agg(F.grouping_id().cast("int").alias("level"), F.count_distinct("trace_id").alias("exact"))
    found = distinct.estimates(distinct.combinations(distinct.registers(events, keys, "trace_id"), keys), [*keys, "level"])
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "level"]]
    both = exact.alias("a").join(found.alias("b"), same).select("a.level", "exact", (~F.col("exact").between(F.col("low"), F.col("high"))).cast("int").alias("outside"))
    n = F.count(F.lit(1))
    return both.groupBy("level").agg(n.alias("groups"), F.sum("exact").alias("ids"), (F.sum("outside") <= F.ceil(n * 0.01)).alias("holds"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.verdicts(table(spark, sf_dir, "log_events")).select(F.col("id").alias("row_id"))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = table(spark, sf_dir, "log_events")
    return truncation.report(logs, truncation.verdicts(logs))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.pod_runs(table(spark, sf_dir, "log_events"), table(spark, sf_dir, "hosts"))
    return found.select(F.col("seq").alias("pod"), F.col("first_id").alias("first_row_id"), F.col("last_id").alias("last_row_id"), "n_events", "duration_ms")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "context_sizes"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, sf_dir))


def p8_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = cut(bpe.token_counts(table(spark, sf_dir, "documents")))
    return packing.violations(packing.pack(sizes, table(spark, sf_dir, "context_sizes")), sizes)


def p9_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.mislabelled(p9_segments(spark, sf_dir)).select("doc_id", "seg_start", "lang")


def queries() -> dict[str, Query]:
    return {
        "p1_distinct": p1_distinct,
        "p1_registers": p1_registers,
        "p1_bounds": p1_bounds,
        "p2_found": p2_found,
        "p2_report": p2_report,
        "p3_found": p3_found,
        "p7_ids": p7_ids,
        "p8_containers": p8_containers,
        "p8_fill": p8_fill,
        "p8_holds": p8_holds,
        "p9_found": p9_found,
        "p9_segments": p9_segments,
    }


#: The registers of day, service and host, built without Spark.
_P1 = r"""
with names as (
  select lower(host) as name, lower(host) as machine from hosts union select lower(fqdn), lower(host) from hosts
), ids as (
  select strftime("timestamp", '%Y-%m-%d') as day, service_name, coalesce(n.machine, lower(l.host)) as host, trim(coalesce(trace_id, '')) as t
  from log_events l left join names n on lower(l.host) = n.name
), one as (
  select day, service_name, host,
    case when regexp_full_match(t, '[0-9A-Fa-f]{16}') then lpad(lower(t), 32, '0')
         when regexp_full_match(t, '[0-9A-Fa-f]+') then lower(t) else t end as trace_id
  from ids where t <> '' and lower(t) <> 'n/a'
), hashed as (
  select *, cast(concat('0x', substr(md5(trace_id), 1, 15)) as bigint) as h from one
), registers as (
  select day, service_name, host, cast(h & 16383 as integer) as register,
    max(cast(47 - case when (h >> 14) = 0 then 0 else length(ltrim(bin(h >> 14), '0')) end as integer)) as rank
  from hashed group by all
)
"""

_P1_DISTINCT = (
    _P1
    + r"""
, sets as (
  select day, service_name, host, cast(grouping(day, service_name, host) as integer) as level, register, max(rank) as rank
  from registers group by grouping sets
    ((day, service_name, host, register), (day, service_name, register), (day, host, register), (service_name, host, register),
     (day, register), (service_name, register), (host, register), (register))
), sums as (
  select day, service_name, host, level, 16384 - count(*) as empty, sum(pow(2.0, -rank)) as s from sets group by all
), est as (
  select day, service_name, host, level, 16384.0 * 16384.0 / (2 * ln(2.0)) / (16384.0 * (e +
    list_sum(list_transform(range(1, 21), lambda k: pow(e, pow(2.0, k)) * pow(2.0, k - 1)))) + s) as value
  from (select *, empty / 16384.0 as e from sums)
)
select day, service_name, host, level, cast(round(value) as bigint) as n_distinct, 0.008125 as standard_error,
  cast(floor(value * (1 - 3 * 0.008125)) as bigint) as low, cast(ceil(value * (1 + 3 * 0.008125)) as bigint) as high from est
"""
)

#: Containers cannot be said in SQL; what must hold for any packing can.
ORACLE = {
    "p8_holds": "select size_name, cast(capacity_tokens as bigint) as capacity, (select count(*) from documents) as docs, true as fits, true as whole from context_sizes",
    "p1_registers": _P1 + "select * from registers",
    "p1_distinct": _P1_DISTINCT,
    "p1_bounds": _P1
    + """, exact as (select cast(grouping(day, service_name, host) as integer) as level, count(distinct trace_id) as exact from one group by cube (day, service_name, host))
    select level, count(*) as groups, cast(sum(exact) as bigint) as ids, true as holds from exact group by level""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
