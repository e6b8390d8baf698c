"""Labels of pods from a cluster's API, one request for each pod that was not seen before."""

from __future__ import annotations

import json
import logging
import os
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)
#: Fixed value: where a cluster puts the token of a pod's account.
TOKEN_FILE = "/var/run/secrets/kubernetes.io/serviceaccount/token"
#: Pods whose labels are looked up at once; a batch that holds more is an error of the selection.
MOST_PODS = 100_000


def api_of_environment() -> str | None:
    """Address of the API as the cluster tells its pods; None outside a cluster."""
    host, port = os.environ.get("KUBERNETES_SERVICE_HOST"), os.environ.get("KUBERNETES_SERVICE_PORT", "443")
    return f"https://{host}:{port}" if host else None


def fetch_label(api: str, namespace: str, pod: str, label: str, token_file: str = TOKEN_FILE, timeout: float = 10.0) -> str | None:
    """A pod's label; None if the pod or the label is not there. Other failures raise."""
    url = f"{api.rstrip('/')}/api/v1/namespaces/{urllib.parse.quote(namespace, safe='')}/pods/{urllib.parse.quote(pod, safe='')}"
    headers = {"Accept": "application/json"}
    if Path(token_file).exists():
        headers["Authorization"] = f"Bearer {Path(token_file).read_text(encoding='utf-8').strip()}"
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as answer:
            value = (json.load(answer).get("metadata", {}).get("labels") or {}).get(label)
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return None
        raise
    return value if isinstance(value, str) else None


class Labels:
    """Service names by pod; what was found, or found to be missing, is not asked for again."""

    def __init__(self, fetch: Callable[[str, str], str | None]):
        self.fetch, self.known = fetch, {}

    def table(self, events: DataFrame) -> DataFrame:
        """``namespace, pod, service_name`` of the pods in ``events``. A failed request is tried in the next batch."""
        pods = events.where("pod is not null").select("namespace", "pod").distinct().limit(MOST_PODS + 1).collect()
        if len(pods) > MOST_PODS:
            raise ValueError(f"more than {MOST_PODS} pods in one batch; select fewer")
        for at in {(r["namespace"], r["pod"]) for r in pods} - set(self.known):
            try:
                self.known[at] = self.fetch(*at)
            except (OSError, ValueError) as e:
                log.warning("labels of %s/%s: %s", *at, e)
        rows = [(ns, pod, name) for (ns, pod), name in self.known.items()]
        return events.sparkSession.createDataFrame(rows, "namespace string, pod string, service_name string")
