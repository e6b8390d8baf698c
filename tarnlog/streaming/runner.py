"""Run a configuration as a stream: tail, assemble, parse, enrich, write; stop on a signal."""

from __future__ import annotations

import logging
import signal
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarnlog import config as cfg
from tarnlog.operators import enrich, parsers, shell
from tarnlog.operators.batching import RetryPolicy
from tarnlog.schema import CORE, SHARED
from tarnlog.sinks import stream as sinks
from tarnlog.sinks import table
from tarnlog.sources.files import POD_LOGS
from tarnlog.sources.labels import Labels, api_of_environment, fetch_label
from tarnlog.sources.tail import TailDataSource
from tarnlog.streaming.assembler import assemble_stream

log = logging.getLogger(__name__)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def parsed(events: DataFrame, formats: list[str], pattern: str | None = None) -> DataFrame:
    """Records of assembled events: the head line is parsed, the other lines follow its message.

    A text without a head is a message with the runtime's time, else the time of its arrival.
    """
    now = F.current_timestamp().cast("timestamp_ntz")
    rec = events.withColumn("r", parsers.factory(formats, now, pattern)(F.col("head")))
    strings = [F.coalesce(F.col(f"r.{c}"), F.lit("")).alias(c) for c in ("level", "trace_id", "span_id", "thread", "logger")]
    message = F.concat(F.coalesce("r.message", F.lit("")), F.coalesce("tail", F.lit("")))
    return rec.select(F.coalesce("r.timestamp", shell.runtime_time(F.col("shell_time")), now).alias("timestamp"), *strings, message.alias("message"), "file", "stream")


def source_of(spark: SparkSession, c: dict, checkpoint: str) -> tuple[DataFrame, str]:
    """(raw lines, shell) of the configured source."""
    spark.dataSource.register(TailDataSource)
    src = c["source"]
    kube = src["type"] == "kubernetes"
    include = [f"{src.get('log_dir') or POD_LOGS}/*/*/*.log*"] if kube else src["include"]
    reader = spark.readStream.format("tail_lines").option("include", ";".join(include)).option("exclude", ";".join(src.get("exclude", [])))
    reader = reader.option("read_from_beginning", str(src["read_from_beginning"]).lower()).option("max_batch_bytes", batch_bytes(c)).option("glob_interval_secs", src["glob_interval_secs"])
    reader = reader.option("positions", f"{(src['data_dir'] or checkpoint).removeprefix('file:')}/positions.json")
    return reader.load(), "cri" if kube else src["container_format"]


def batch_bytes(c: dict) -> int:
    """Bytes read for one micro-batch: what may wait for the sink, in batches that it takes."""
    return min(c["pipeline"]["max_inflight_bytes"], c["pipeline"]["buffer"] * c["batch"]["max_bytes"])


def events_of(lines: DataFrame, shell: str, c: dict, labels: DataFrame | None = None) -> DataFrame:
    src, p = c["source"], c["parser"]
    if src["type"] == "kubernetes":
        include = {"namespace": src["namespaces"], "pod": src["pods"], "container": src["containers"]}
        exclude = {"namespace": src["exclude_namespaces"], "pod": src["exclude_pods"], "container": src["exclude_containers"]}
        import os
        import socket

        own = (os.environ.get("POD_NAME") or socket.gethostname()) if src["exclude_self"] else None
        lines = enrich.select_pods(enrich.with_pod(lines), include, exclude, own).select(*lines.columns)
    events = parsed(assemble_stream(lines, p["formats"], p["pattern"], 2000, p["max_message_lines"], p["max_message_bytes"], shell), p["formats"], p["pattern"])
    if shell == "raw":
        events = events.drop("stream")
    events = events.withColumn("host", F.lit(src.get("host") or ""))
    if src["type"] == "kubernetes" or shell == "cri":
        events = enrich.with_pod(events)
        if labels is not None:
            events = enrich.with_service(events, labels, c["fields"].get("service_name"))
    return enrich.with_fields(events, {k: v for k, v in c["fields"].items() if k not in events.columns})


def sink_of(c: dict) -> sinks.Sink:
    s, b = c["sink"], c["batch"]
    if s["type"] == "console":
        return sinks.console_sink(s["encoding"], s["stderr"])
    if s["type"] == "parquet":
        return sinks.parquet_sink(s["path"])
    return sinks.http_sink(
        s["endpoint"], s["database"], s["table"], s["user"], s["password"], s["async_insert"], s["timezone"], s["timeout_secs"], s["compress"], b["max_events"], b["max_bytes"]
    )


def columns_of(c: dict) -> dict[str, str]:
    """Columns beside the record's own, and their types."""
    extra = {}
    if c["source"]["type"] == "kubernetes" or c["source"].get("container_format") == "cri":
        extra = dict.fromkeys(SHARED, "STRING")
    return extra | {k: table.field_type(v) for k, v in c["fields"].items() if k not in extra}


def health_of(c: dict) -> Callable[[], None] | None:
    """The check of the configured sink, if it has one."""
    s = c["sink"]
    if s["type"] != "clickhouse":
        return None
    return lambda: sinks.http_health(s["endpoint"], s["database"], s["table"], [*CORE, *columns_of(c)], s["user"], s["password"], s["timeout_secs"])


def labelled(sink: sinks.Sink, c: dict) -> sinks.Sink:
    """A sink whose batches get service names from the cluster's API, where one is known."""
    src = c["source"]
    api = src.get("api") or api_of_environment()
    if src["type"] != "kubernetes" or not api:
        return sink
    known = Labels(lambda namespace, pod: fetch_label(api, namespace, pod, src["service_name_label"]))
    return lambda df, batch: sink(enrich.with_service(df, known.table(df), c["fields"].get("service_name")), batch)


def start(spark: SparkSession, config: dict, checkpoint: str, labels: DataFrame | None = None, sink: sinks.Sink | None = None, health: Callable[[], None] | None = None) -> StreamingQuery:
    """Start the stream. The sink's health is tried first; its failure stops only with ``require_healthy``."""
    c = cfg.parse(config)
    health = health or (health_of(c) if sink is None else None)
    if health is not None:
        try:
            health()
        except Exception as e:
            if c["pipeline"]["require_healthy"]:
                raise
            log.warning("sink is not healthy: %s", e)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    lines, shell_format = source_of(spark, c, checkpoint)
    r = c["retry"]
    policy = RetryPolicy(r["max_attempts"], r["initial_backoff_ms"], int(r["max_backoff_secs"] * 1000))
    to = sink or sink_of(c)
    write = sinks.retried(to if labels is not None else labelled(to, c), policy, c["pipeline"]["on_error"], f"{checkpoint}/dead_letters")
    events = events_of(lines, shell_format, c, labels)
    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=f"{c['batch']['timeout_secs']} seconds").start()


def run_until_signal(query: StreamingQuery) -> None:
    """Wait for the end of the query; SIGINT and SIGTERM stop it after the batch in progress.

    Open events stay in the state store and go on after a restart.
    """
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: query.stop())
    query.awaitTermination()


def ddl_of(config: dict) -> list[str]:
    """Statements for the table that the configuration fills."""
    c = cfg.parse(config)
    return table.ddl(c["sink"].get("table") or "events", columns_of(c))
