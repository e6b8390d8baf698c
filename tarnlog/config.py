"""Configuration as a plain dict, seven sections, every unknown name refused."""

from __future__ import annotations

from typing import Any

#: Names of sections and keys.
_SECTIONS: dict[str, dict[str, Any]] = {
    "source": {},
    "parser": {"formats": ["logback"], "pattern": None, "max_message_lines": 500, "max_message_bytes": 262_144},
    "sink": {},
    "batch": {"max_events": 10_000, "max_bytes": 8 << 20, "timeout_secs": 1},
    "retry": {"max_attempts": 5, "initial_backoff_ms": 500, "max_backoff_secs": 30},
    "pipeline": {"buffer": 8, "max_inflight_bytes": 32 << 20, "require_healthy": False, "on_error": "stop"},
    "fields": {},
}
_SOURCES: dict[str, dict[str, Any]] = {
    "file": {"include": None, "exclude": [], "data_dir": None, "read_from_beginning": True, "glob_interval_secs": 10, "host": None, "container_format": "raw"},
    "kubernetes": {
        "namespaces": [], "pods": [], "containers": [], "exclude_namespaces": [], "exclude_pods": [], "exclude_containers": [],
        "exclude_self": True, "service_name_label": "app", "api": None, "log_dir": "/var/log/pods", "data_dir": None,
        "read_from_beginning": False, "glob_interval_secs": 10, "host": None,
    },
}
_SINKS: dict[str, dict[str, Any]] = {
    "clickhouse": {
        "endpoint": None, "database": None, "table": None, "cluster": None, "timezone": None, "user": "", "password": "",
        "async_insert": False, "compress": True, "timeout_secs": 30,
    },
    "console": {"encoding": "json", "stderr": False},
    "parquet": {"path": None},
}


class ConfigError(ValueError):
    pass


def _merged(name: str, given: dict, known: dict) -> dict:
    if unknown := sorted(set(given) - set(known)):
        raise ConfigError(f"{name}: unknown keys {', '.join(unknown)}; known are {', '.join(sorted(known))}")
    return {**known, **given}


def parse(config: dict) -> dict:
    """Checked configuration with all defaults filled in."""
    if unknown := sorted(set(config) - set(_SECTIONS)):
        raise ConfigError(f"unknown sections {', '.join(unknown)}; known are {', '.join(_SECTIONS)}")
    out = {}
    for name, kinds in (("source", _SOURCES), ("sink", _SINKS)):
        if name not in config:
            raise ConfigError(f"{name}: section is missing")
        given = dict(config[name])
        kind = given.pop("type", None)
        if kind not in kinds:
            raise ConfigError(f"{name}: type must be one of {', '.join(kinds)}, not {kind!r}")
        out[name] = {"type": kind, **_merged(name, given, kinds[kind])}
    for name in ("parser", "batch", "retry", "pipeline"):
        out[name] = _merged(name, dict(config.get(name) or {}), _SECTIONS[name])
    out["fields"] = dict(config.get("fields") or {})
    if out["source"]["type"] == "file" and not out["source"]["include"]:
        raise ConfigError("source: include must name at least one pattern")
    if out["sink"]["type"] == "clickhouse" and not all(out["sink"][k] for k in ("endpoint", "database", "table")):
        raise ConfigError("sink: endpoint, database and table are needed")
    if out["sink"].get("cluster"):
        raise ConfigError("sink: cluster has no counterpart; the table is spread by Spark")
    if out["parser"]["max_message_lines"] < 1 or out["parser"]["max_message_bytes"] < 1:
        raise ConfigError("parser: limits must be above 0")
    if out["pipeline"]["on_error"] not in ("stop", "drop"):
        raise ConfigError("pipeline: on_error must be stop or drop")
    out["retry"]["max_attempts"] = max(1, out["retry"]["max_attempts"])
    out["pipeline"]["max_inflight_bytes"] = max(out["pipeline"]["max_inflight_bytes"], 4 * out["batch"]["max_bytes"])
    return out
