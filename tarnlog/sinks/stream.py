"""Writers of micro-batches: retried, at least once, idempotent by batch."""

from __future__ import annotations

import gzip
import sys
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlog.operators.batching import BatchPolicy, RetryPolicy
from tarnlog.sinks import table
from tarnlog.sinks.encode import json_rows, text_rows

Sink = Callable[[DataFrame, int], None]


def parquet_sink(path: str) -> Sink:
    """One folder per batch id, overwritten when the batch is repeated."""

    def write(df: DataFrame, batch: int) -> None:
        table.write(df, f"{path}/batch={batch}", mode="overwrite")

    return write


def console_sink(encoding: str = "json", stderr: bool = False) -> Sink:
    def write(df: DataFrame, batch: int) -> None:
        rows = json_rows(df) if encoding == "json" else text_rows(df)
        for row in rows.toLocalIterator():
            print(row["value"], file=sys.stderr if stderr else sys.stdout)

    return write


def memory_sink(into: list) -> Sink:
    """For tests."""
    return lambda df, batch: into.extend(df.collect())


def _request(endpoint: str, query: dict[str, str], user: str, password: str, body: bytes | None = None, headers: dict[str, str] | None = None, timeout: float = 30.0) -> str:
    headers = dict(headers or {})
    if user:
        headers |= {"X-ClickHouse-User": user, "X-ClickHouse-Key": password}
    request = urllib.request.Request(f"{endpoint.rstrip('/')}/?{urllib.parse.urlencode(query)}", body, headers, method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return answer.read().decode("utf-8", "replace")


def bodies(rows: Iterable[str], max_events: int, max_bytes: int) -> Iterator[bytes]:
    """Rows joined to bodies that close at the first of two limits."""
    policy = BatchPolicy(max_events, max_bytes)
    held: list[bytes] = []
    size = 0
    for row in rows:
        held.append(row.encode())
        size += len(held[-1]) + 1
        if policy.full(len(held), size, 0.0):
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def http_sink(
    endpoint: str,
    database: str,
    name: str,
    user: str = "",
    password: str = "",
    async_insert: bool = False,
    zone: str | None = None,
    timeout: float = 30.0,
    compress: bool = True,
    max_events: int = 10_000,
    max_bytes: int = 8 << 20,
) -> Sink:
    """POST the rows of each partition as JSON, one object a line, in bounded bodies."""
    query = {"query": f"INSERT INTO `{database}`.`{name}` FORMAT JSONEachRow", "date_time_input_format": "best_effort", "input_format_skip_unknown_fields": "1"}
    if async_insert:
        query |= {"async_insert": "1", "wait_for_async_insert": "1"}
    headers = {"Content-Type": "application/json"} | ({"Content-Encoding": "gzip"} if compress else {})

    def send(rows: Iterator) -> None:
        for body in bodies((r["value"] for r in rows), max_events, max_bytes):
            _request(endpoint, query, user, password, gzip.compress(body, 1) if compress else body, headers, timeout)

    return lambda df, batch: json_rows(df, zone).foreachPartition(send)


def http_health(endpoint: str, database: str, name: str, expected: Iterable[str], user: str = "", password: str = "", timeout: float = 30.0) -> None:
    """Fail with the reason if the server does not answer, or its table cannot take the columns."""
    ask = lambda sql: _request(endpoint, {"query": sql}, user, password, b"", timeout=timeout)
    text = lambda x: x.replace("\\", "\\\\").replace("'", "\\'")
    ask("SELECT 1")
    if ask(f"EXISTS TABLE `{database}`.`{name}`").strip() != "1":
        raise ValueError(f"table {database}.{name} does not exist; run the DDL first")
    present = {x.strip() for x in ask(f"SELECT name FROM system.columns WHERE database = '{text(database)}' AND table = '{text(name)}' FORMAT TSV").splitlines()}
    if lacking := sorted(set(expected) - present):
        raise ValueError(f"table {database}.{name} lacks columns: {', '.join(lacking)}")


def retried(sink: Sink, policy: RetryPolicy = RetryPolicy(), on_error: str = "stop", dead_letters: str | None = None) -> Sink:
    """Retry a sink; a batch that is given up goes to ``dead_letters``, if named."""

    def write(df: DataFrame, batch: int) -> None:
        if not policy.run(lambda: sink(df, batch), on_error) and dead_letters:
            df.withColumn("batch", F.lit(batch)).write.mode("append").parquet(dead_letters)

    return write
