"""A streaming source that tails growing files.

Files are known by device and inode, so a renamed file goes on where it was. A file that shrank
starts anew under the next generation. Complete lines only are read; an unterminated rest longer
than ``max_line_bytes`` is reported as a row with ``discard_bytes`` and skipped.

Offsets live in the stream's checkpoint: a batch is read again until it is committed. Spark asks
for the newest offset without telling the last one, so the end of every planned batch is also
written to the file that ``positions`` names; a restarted query goes on from there. A file that is
missing from a few listings keeps its place. The driver reads no text: it looks for the last line
break of a range from the range's end.

    spark.dataSource.register(TailDataSource)
    spark.readStream.format("tail_lines").option("include", "/var/log/*.log").option("positions", "/data/positions.json").load()
"""

from __future__ import annotations

import json
import logging
import os
import time
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tarnlog.operators.batching import prune
from tarnlog.schema import RAW_LINE
from tarnlog.sources.files import discover

log = logging.getLogger(__name__)
MAX_LINE_BYTES = 1 << 20
MAX_BATCH_BYTES = 32 << 20
#: Bytes of one file in a batch, so that a busy file leaves room for others.
MAX_FILE_BYTES = 8 << 20
#: Listings that a file may be missing from before its place is forgotten.
MISSING = 3
_STEP = 1 << 16


def start_position(saved: int | None, size: int, from_beginning: bool, first_scan: bool, sibling_saved: bool) -> int:
    """Where a file is read from: its saved place if that still exists, else its start or end."""
    if saved is not None:
        return saved if saved <= size else 0
    return 0 if from_beginning or not first_scan or sibling_saved else size


class TailPartition(InputPartition):
    def __init__(self, key: str, path: str, generation: int, start: int, end: int):
        super().__init__(key)
        self.key, self.path, self.generation, self.start, self.end = key, path, generation, start, end


def split_lines(data: bytes, start: int) -> Iterator[tuple[int, str]]:
    """(offset, text) of the complete lines in ``data``, which begins at ``start``."""
    at = 0
    while (nl := data.find(b"\n", at)) >= 0:
        raw = data[at:nl]
        yield start + at, (raw[:-1] if raw.endswith(b"\r") else raw).decode("utf-8", "replace")
        at = nl + 1


def last_break(f: BinaryIO, begin: int, end: int) -> int:
    """The place behind the last line break of a range, or its begin; reads backwards, the needed bytes only."""
    at = end
    while at > begin:
        start = max(begin, at - _STEP)
        f.seek(start)
        if (nl := f.read(at - start).rfind(b"\n")) >= 0:
            return start + nl + 1
        at = start
    return begin


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.includes = [p for p in options.get("include", "").split(";") if p]
        if not self.includes:
            raise ValueError("include: at least one pattern is needed")
        self.excludes = [p for p in options.get("exclude", "").split(";") if p]
        self.from_beginning = options.get("read_from_beginning", "true") == "true"
        self.max_line = int(options.get("max_line_bytes", MAX_LINE_BYTES))
        # a line that is not too long must fit
        self.max_batch = max(int(options.get("max_batch_bytes", MAX_BATCH_BYTES)), self.max_line + 2)
        self.max_file = max(int(options.get("max_file_bytes", MAX_FILE_BYTES)), self.max_line + 2)
        self.interval = float(options.get("glob_interval_secs", 0))
        self.positions = options.get("positions")
        self.last: dict | None = None
        self.listed: list[str] = []
        self.next_listing = 0.0
        self.first_scan = True

    def _saved(self) -> dict | None:
        if not self.positions or not os.path.exists(self.positions):
            return None
        with open(self.positions, encoding="utf-8") as f:
            return json.load(f)

    def _save(self, end: dict) -> None:
        if self.positions:
            os.makedirs(os.path.dirname(self.positions) or ".", exist_ok=True)
            with open(f"{self.positions}.tmp", "w", encoding="utf-8") as f:
                json.dump(end, f)
            os.replace(f"{self.positions}.tmp", self.positions)

    def initialOffset(self) -> dict:
        state = {}
        if not self.from_beginning:
            for path in discover(self.includes, self.excludes):
                st = os.stat(path)
                state[f"{st.st_dev}-{st.st_ino}"] = {"path": path, "offset": start_position(None, st.st_size, False, True, False), "generation": 0}
        return {"files": json.dumps(state, sort_keys=True)}

    def _paths(self, state: dict) -> list[str]:
        """The listing; renewed after its interval, or as soon as a known file is not where it was."""

        def moved(key: str, path: str) -> bool:
            try:
                st = os.stat(path)
            except OSError:
                return True
            return f"{st.st_dev}-{st.st_ino}" != key

        if time.monotonic() >= self.next_listing or any(moved(k, v["path"]) for k, v in state.items()):
            self.listed = discover(self.includes, self.excludes)
            self.next_listing = time.monotonic() + self.interval
        return self.listed

    def latestOffset(self) -> dict:
        if self.last is None:
            self.last = self._saved() or self.initialOffset()
        state = json.loads(self.last["files"])
        folders = {os.path.dirname(v["path"]) for v in state.values()}
        out, left = {}, self.max_batch
        for path in self._paths(state):
            try:
                with open(path, "rb") as f:
                    st = os.fstat(f.fileno())
                    key = f"{st.st_dev}-{st.st_ino}"
                    if key in out:
                        continue
                    seen = state.get(key)
                    begin = start_position(seen and seen["offset"], st.st_size, self.from_beginning, self.first_scan, os.path.dirname(path) in folders)
                    generation = 0 if seen is None else seen["generation"] + (st.st_size < seen["offset"])
                    upper = min(st.st_size, begin + min(left, self.max_file))
                    end = last_break(f, begin, upper)
                    if end == begin and upper - begin > self.max_line:
                        end = upper
            except FileNotFoundError:
                continue
            except OSError as e:
                log.error("%s cannot be read: %s", path, e)
                continue
            left -= end - begin
            out[key] = {"path": path, "offset": end, "generation": generation}
        gone = {k: {**v, "missing": v.get("missing", 0) + 1} for k, v in state.items() if k not in out}
        out |= prune(gone, {k for k, v in gone.items() if v["missing"] <= MISSING}, lambda path: False)
        self.first_scan = False
        self.last = {"files": json.dumps(out, sort_keys=True)}
        return self.last

    def partitions(self, start: dict, end: dict) -> list[TailPartition]:
        a, b = json.loads(start["files"]), json.loads(end["files"])
        out = []
        for key, v in b.items():
            u = a.get(key)
            begin = u["offset"] if u and u["generation"] == v["generation"] else 0
            if v["offset"] > begin and not v.get("missing"):
                out.append(TailPartition(key, v["path"], v["generation"], begin, v["offset"]))
        self._save(end)
        self.last = self.last or end
        return out

    def read(self, part: TailPartition) -> Iterator[tuple]:
        with open(part.path, "rb") as f:
            f.seek(part.start)
            data = f.read(part.end - part.start)
        for offset, text in split_lines(data, part.start):
            if len(text.encode("utf-8", "replace")) > self.max_line:
                yield part.path, part.generation, offset, None, len(text.encode("utf-8", "replace")), part.key
            else:
                yield part.path, part.generation, offset, text, None, part.key
        if not data.endswith(b"\n"):
            yield part.path, part.generation, part.start, None, len(data), part.key

    def commit(self, end: dict) -> None:
        pass


class TailDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail_lines"

    def schema(self):
        return RAW_LINE

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))
