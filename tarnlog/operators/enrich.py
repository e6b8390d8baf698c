"""Container identity from paths, selection by it, service names, fields and size estimates."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlog.runtime import broadcast_if_small
from tarnlog.schema import check_fields

#: Fixed forms of log paths: ``<ns>_<pod>_<uid>/<container>/x``, the first and the last ``_`` divide.
_PODS = r"(?:^|/)([^/_]+)_([^/]+)_([^/_]*)/([^/]+)/[^/]+\z"
#: ``<pod>_<ns>_<container>-<id>.log``, the first two ``_`` and the last ``-`` divide.
_CONTAINERS = r"(?:^|/)([^/_]+)_([^/_]+)_([^/]+)-([^/-]+)\.log\z"
#: Most rows of a label table that are broadcast; beyond it Spark chooses the join.
LABELS_BROADCAST_ROWS = 200_000

#: Files that are never read.
SKIPPED_EXTENSIONS = ("gz", "zst", "xz", "bz2", "zip", "tmp")


def pod_of(path: Column) -> Column:
    """struct(namespace, pod, container) of a log path, null if it names none."""

    def meta(pattern: str, ns: int, pod: int, container: int) -> Column:
        g = lambda i: F.regexp_extract(path, pattern, i)
        return F.when(path.rlike(pattern), F.struct(g(ns).alias("namespace"), g(pod).alias("pod"), g(container).alias("container")))

    return F.coalesce(meta(_PODS, 1, 2, 4), meta(_CONTAINERS, 2, 1, 3))


def with_pod(df: DataFrame, path_col: str = "file") -> DataFrame:
    """Add ``namespace, pod, container``."""
    tagged = df.withColumn("__pod", pod_of(F.col(path_col)))
    return tagged.select("*", "__pod.namespace", "__pod.pod", "__pod.container").drop("__pod")


def glob_regex(pattern: str) -> str:
    """A glob as an anchored Java regular expression; ``*`` and ``?`` also match ``/``."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        end = pattern.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif end > 0:
            body = pattern[i + 1 : end].replace("\\", "\\\\")
            out += "[" + ("^" + body[1:] if body[0] == "!" else body) + "]"
            i = end
        elif c == "[":
            raise ValueError(f"glob: {pattern!r} has an open bracket")
        else:
            out += re.escape(c)
        i += 1
    return rf"(?s)^{out}\z"


def matches_any(c: Column, globs: Iterable[str]) -> Column:
    found = F.lit(False)
    for g in globs:
        found = found | c.rlike(glob_regex(g))
    return found


def select_pods(df: DataFrame, include: dict[str, list[str]] | None = None, exclude: dict[str, list[str]] | None = None, self_pod: str | None = None) -> DataFrame:
    """Rows of the wanted containers; globs by ``namespace``, ``pod`` and ``container``.

    Any exclusion drops; an empty inclusion keeps all. With any selector, rows without a
    container identity are dropped; without one they stay. ``self_pod`` is excluded too.
    """
    include, exclude = include or {}, {k: list(v) for k, v in (exclude or {}).items()}
    if self_pod:
        exclude.setdefault("pod", []).append(self_pod)
    if not any(include.values()) and not any(exclude.values()):
        return df
    keep = F.col("pod").isNotNull()
    for dim in ("namespace", "pod", "container"):
        if exclude.get(dim):
            keep = keep & ~matches_any(F.col(dim), exclude[dim])
        if include.get(dim):
            keep = keep & matches_any(F.col(dim), include[dim])
    return df.where(keep)


def readable(df: DataFrame, exclude: Iterable[str] = (), path_col: str = "file") -> DataFrame:
    """Rows of files that are read at all: none of the skipped extensions, no excluded path."""
    path = F.col(path_col)
    return df.where(~path.rlike(rf"\.({'|'.join(SKIPPED_EXTENSIONS)})\z") & ~matches_any(path, exclude))


def with_service(df: DataFrame, labels: DataFrame, default: str | None = None) -> DataFrame:
    """Set ``service_name`` from ``labels(namespace, pod, service_name)``.

    Repeated label rows count once (the least label wins); pods without a label take the static
    default; rows are never multiplied.
    """
    one = labels.where("service_name is not null").groupBy("namespace", "pod").agg(F.min("service_name").alias("__label"))
    one = broadcast_if_small(one, "pod", LABELS_BROADCAST_ROWS)
    joined = df.drop("service_name").join(one, ["namespace", "pod"], "left")
    return joined.withColumn("service_name", F.coalesce("__label", F.lit(default).cast("string"))).drop("__label")


def with_fields(df: DataFrame, fields: dict) -> DataFrame:
    """Add static fields as typed literals; columns that are already there win."""
    check_fields(fields)
    for name, value in fields.items():
        typed = F.lit(value) if isinstance(value, bool | int | float) else F.lit(str(value))
        df = df.withColumn(name, F.coalesce(F.col(name), typed.cast(df.schema[name].dataType)) if name in df.columns else typed)
    return df


def get_field(fields: Column, shared: Column, key: str) -> Column:
    """A value by key: of the event's own fields, else of the shared ones."""
    return F.coalesce(F.try_element_at(fields, F.lit(key)), F.try_element_at(shared, F.lit(key)))


def transform(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply steps in order; a step drops rows by a filter."""
    for step in steps:
        df = step(df)
    return df


def value_size(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value of an extra entry, roughly; a number takes 8, a list or an object the sum of its parts."""
    if isinstance(kind, T.BooleanType):
        size = F.lit(5)
    elif isinstance(kind, T.NumericType):
        size = F.lit(8)
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(F.transform(value, lambda x: value_size(x, kind.elementType)), F.lit(0).cast("long"), lambda a, x: a + x + 1) + 2
    elif isinstance(kind, T.MapType):
        entry = lambda e: F.octet_length(e["key"].cast("string")) + value_size(e["value"], kind.valueType) + 4
        size = F.aggregate(F.transform(F.map_entries(value), entry), F.lit(0).cast("long"), lambda a, x: a + x) + 2
    elif isinstance(kind, T.StructType):
        size = sum((value_size(value[f.name], f.dataType) + len(f.name.encode()) + 4 for f in kind.fields), F.lit(2))
    else:
        size = F.octet_length(value.cast("string")) + 2
    return F.when(value.isNull(), 4).otherwise(size).cast("long")


def estimated_size(df: DataFrame, strings: Iterable[str], extra: Iterable[str] = ()) -> Column:
    """Bytes of the record as JSON, roughly: its strings, its extra entries with their keys, and 160."""
    total = F.lit(160).cast("long")
    for c in strings:
        total = total + F.coalesce(F.octet_length(F.col(c)), F.lit(0))
    for key in extra:
        total = total + value_size(F.col(key), df.schema[key].dataType) + len(key.encode()) + 4
    return total
