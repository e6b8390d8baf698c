"""Rules of delivery as pure functions: when a batch closes, how retries wait, what is prunable."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class BatchPolicy:
    max_events: int = 10_000
    max_bytes: int = 8 << 20
    timeout_secs: float = 1.0

    def full(self, events: int, size: int, age_secs: float) -> bool:
        """A batch closes at the first of its limits; an empty one never does."""
        return events > 0 and (events >= self.max_events or size >= self.max_bytes or age_secs >= self.timeout_secs)


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = 5
    initial_backoff_ms: int = 500
    max_backoff_ms: int = 30_000

    def wait_ms(self, attempt: int) -> int:
        """Wait after the given failed attempt, counted from 1."""
        return min(self.max_backoff_ms, self.initial_backoff_ms << min(max(attempt, 1) - 1, 40))

    def run(self, write: Callable[[], None], on_error: str = "stop", sleep: Callable[[float], None] = time.sleep) -> bool:
        """Try until it works; at the end raise (``stop``) or give up (``drop``, returns False)."""
        for attempt in range(1, max(self.max_attempts, 1) + 1):
            try:
                write()
                return True
            except Exception:
                if attempt >= max(self.max_attempts, 1):
                    if on_error == "drop":
                        return False
                    raise
                sleep(self.wait_ms(attempt) / 1000)
        return False


def backoff_column(attempt: Column, policy: RetryPolicy = RetryPolicy()) -> Column:
    """:meth:`RetryPolicy.wait_ms` as an expression."""
    grown = F.lit(policy.initial_backoff_ms) * F.pow(F.lit(2.0), F.greatest(attempt, F.lit(1)) - 1)
    return F.least(F.lit(float(policy.max_backoff_ms)), grown).cast("long")


def number_batches(events: DataFrame, order: list[str], size: Column, policy: BatchPolicy, keys: list[str]) -> DataFrame:
    """Add ``batch``: events of a key, in order, cut where a batch reaches its number of events or bytes.

    A batch closes at the first of the limits and the next starts anew, so a number depends on all
    events before: the rows of a key are passed through one task, in Arrow batches, and only the
    open batch's two sums are kept.
    """
    ordered = events.withColumn("__size", F.coalesce(size, F.lit(0)).cast("long")).withColumn("__key", F.xxhash64(*[F.col(k) for k in keys])).repartition("__key").sortWithinPartitions("__key", *order)
    most_events, most_bytes = policy.max_events, policy.max_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number, n, total = None, 0, 0, 0
        for batch in batches:
            out = []
            for key, more in zip(batch.column("__key").to_pylist(), batch.column("__size").to_pylist()):
                if key != last:
                    last, number, n, total = key, 0, 0, 0
                elif n >= most_events or total >= most_bytes:
                    number, n, total = number + 1, 0, 0
                n, total = n + 1, total + more
                out.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, pa.int64())], schema=pa.schema([*list(batch.schema)[:-2], pa.field("batch", pa.int64())]))

    made = T.StructType([*events.schema.fields, T.StructField("batch", T.LongType())])
    return ordered.mapInArrow(run, made)


def advance(saved: int, acked: int) -> int:
    """A position only grows."""
    return max(saved, acked)


def prune(positions: dict[str, dict], watched: set[str], exists: Callable[[str], bool]) -> dict[str, dict]:
    """Positions without those of files that are neither watched nor there."""
    return {k: v for k, v in positions.items() if k in watched or exists(v["path"])}
