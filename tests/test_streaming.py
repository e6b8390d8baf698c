import os
import random
import time

import pytest
from pyspark.sql import functions as F
from tarnlog.operators import parsers
from tarnlog.pipeline import Pipeline
from tarnlog.sources.tail import TailDataSource, TailReader
from tarnlog.streaming import runner
from tarnlog.streaming.assembler import Assembler, assemble_stream

HEAD = "2024-05-01 10:00:00.000 [main] INFO  a.B -"


def test_reader_follows_rename_truncation_and_long_lines(tmp_path):
    p = tmp_path / "a.log"
    p.write_text("one\ntw")
    r = TailReader({"include": f"{tmp_path}/*", "max_line_bytes": "100"})

    def batch(start, end):
        return [row for part in r.partitions(start, end) for row in r.read(part)]

    o0 = r.initialOffset()
    o1 = r.latestOffset()
    assert [x[3] for x in batch(o0, o1)] == ["one"]
    with p.open("a") as f:
        f.write("o\n")
    os.rename(p, tmp_path / "a.log.20240101-000000")
    o2 = r.latestOffset()
    got = batch(o1, o2)
    assert [(x[0].rsplit("/", 1)[1], x[3]) for x in got] == [("a.log.20240101-000000", "two")]
    (tmp_path / "a.log.20240101-000000").write_text("n\n")
    o3 = r.latestOffset()
    assert [(x[1], x[3]) for x in batch(o2, o3)] == [(1, "n")]
    with (tmp_path / "a.log.20240101-000000").open("a") as f:
        f.write("z" * 200)
    o4 = r.latestOffset()
    assert [(x[3], x[4]) for x in batch(o3, o4)] == [(None, 200)]
    assert batch(o4, r.latestOffset()) == []


def test_tail_and_idle_flush(spark, tmp_path):
    spark.dataSource.register(TailDataSource)
    log = tmp_path / "logs"
    log.mkdir()
    (log / "a.log").write_text(f"stray\n{HEAD}one\n\tat x\n")
    lines = spark.readStream.format("tail_lines").option("include", f"{log}/*").load()
    q = assemble_stream(lines, ["logback"], idle_ms=500).writeStream.format("memory").queryName("tail_events").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="1 second").start()
    try:
        deadline = time.time() + 90
        with (log / "a.log").open("a") as f:
            f.write(f"\tat y\n{HEAD}two\n")
        while time.time() < deadline and spark.table("tail_events").count() < 3:
            time.sleep(1)
        got = sorted((r["head"] or "") + (r["tail"] or "") for r in spark.table("tail_events").collect())
    finally:
        q.stop()
    assert got == sorted(["stray", f"{HEAD}one\n\tat x\n\tat y", f"{HEAD}two"])


def test_configured_stream(spark, tmp_path):
    pod = tmp_path / "pods" / "ns_web-1_u1" / "app"
    pod.mkdir(parents=True)
    t = "2026-03-05T01:02:03.5Z"
    (pod / "0.log").write_text(f"{t} stdout P {HEAD}on\n{t} stdout F e\n{t} stderr F \tat x\n{t} stdout F {HEAD}two\n")
    config = {
        "source": {"type": "kubernetes", "log_dir": f"{tmp_path}/pods", "read_from_beginning": True, "host": "h1", "namespaces": ["n*"]},
        "sink": {"type": "console"},
        "fields": {"shard": 3},
    }
    labels = spark.createDataFrame([("ns", "web-1", "web")], "namespace string, pod string, service_name string")
    rows: list = []
    from tarnlog.sinks.stream import memory_sink

    def unhealthy():
        raise ValueError("no table")

    q = runner.start(spark, config, str(tmp_path / "ck"), labels, memory_sink(rows), unhealthy)
    try:
        deadline = time.time() + 90
        while time.time() < deadline and len(rows) < 2:
            time.sleep(1)
    finally:
        q.stop()
    got = sorted((r["message"], r["level"], r["pod"], r["service_name"], r["host"], r["shard"]) for r in rows)
    assert got == [("one\n\tat x", "INFO", "web-1", "web", "h1", 3), ("two", "INFO", "web-1", "web", "h1", 3)]


def test_command_line(tmp_path, capsys):
    import json

    from tarnlog.__main__ import main

    p = tmp_path / "c.json"
    p.write_text(json.dumps({"source": {"type": "file", "include": ["*"]}, "sink": {"type": "console"}, "fields": {"n": 1}}))
    assert main([str(p), "--check"]) == 0 and main([str(p), "--ddl"]) == 0
    assert "`n` BIGINT" in capsys.readouterr().out
    p.write_text("{}")
    assert main([str(p), "--check"]) == 1


def test_restart_goes_on_where_it_was(spark, tmp_path):
    """Files larger than a batch, a stop in between: each line comes once."""
    logs = tmp_path / "logs"
    logs.mkdir()
    rnd = random.Random(2)
    want = []
    for name in "abc":
        lines = [f"{name}{i} {'x' * rnd.randrange(200)}" for i in range(400)]
        (logs / f"{name}.log").write_text("\n".join(lines) + "\n")
        want += lines
    spark.dataSource.register(TailDataSource)
    # a batch that was not committed at the stop comes again under its number
    batches: dict = {}
    seen = lambda: [x for rows in list(batches.values()) for x in rows]

    def run(until):
        reader = spark.readStream.format("tail_lines").option("include", f"{logs}/*").option("max_batch_bytes", 3000).option("max_line_bytes", 1000).option("positions", str(tmp_path / "ck/positions.json"))
        q = reader.load().writeStream.foreachBatch(lambda df, i: batches.update({i: [r["line"] for r in df.collect()]})).option("checkpointLocation", str(tmp_path / "ck")).start()
        deadline = time.time() + 90
        while len(seen()) < until and time.time() < deadline:
            time.sleep(0.1)
        q.stop()

    run(60)
    assert 60 <= len(seen()) < len(want)
    with (logs / "a.log").open("a") as f:
        f.write("late\n")
    run(len(want) + 1)
    assert sorted(seen()) == sorted([*want, "late"])


def test_a_file_missing_from_a_listing_keeps_its_place(tmp_path):
    p, away = tmp_path / "a.log", tmp_path / "elsewhere"
    p.write_text("one\n")
    r = TailReader({"include": f"{tmp_path}/*.log"})
    o = [r.initialOffset(), r.latestOffset()]
    os.rename(p, away)
    o.append(r.latestOffset())
    os.rename(away, p)
    with p.open("a") as f:
        f.write("two\n")
    o.append(r.latestOffset())
    got = [row[3] for a, b in zip(o, o[1:]) for part in r.partitions(a, b) for row in r.read(part)]
    assert got == ["one", "two"]
    os.remove(p)
    for _ in range(5):
        last = r.latestOffset()
    assert last["files"] == "{}"


def test_new_files_of_a_watched_folder_are_read_whole(tmp_path):
    (tmp_path / "a.log").write_text("old\n")
    r = TailReader({"include": f"{tmp_path}/*.log", "read_from_beginning": "false", "positions": str(tmp_path / "p/positions.json")})
    a = r.initialOffset()
    b = r.latestOffset()
    assert r.partitions(a, b) == []
    (tmp_path / "b.log").write_text("new\n")
    again = TailReader({"include": f"{tmp_path}/*.log", "read_from_beginning": "false", "positions": str(tmp_path / "p/positions.json")})
    assert [row[3] for part in again.partitions(b, again.latestOffset()) for row in again.read(part)] == ["new"]


class Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    def clear(self):
        self.v = None


class Handle:
    def getValueState(self, *_):
        return Value()

    def listTimers(self):
        return []

    def registerTimer(self, *_):
        pass


class Clock:
    def getCurrentProcessingTimeInMs(self):
        return 0


@pytest.mark.parametrize("shell", ["raw", "cri"])
def test_stream_and_batch_agree(spark, shell):
    """The same random lines through both paths give the same rows."""
    rnd = random.Random(3)
    now = F.expr("timestamp_ntz'2000-01-01 00:00:00'")
    texts = [
        f"{HEAD}short", f"{HEAD}{'m' * 50}", "2024-02-30 10:00:00 INFO a.B -no such day", "[GIN] 2024/05/01 - 10:00:00 | 503 | x", "[GIN] 2024/13/01 - 10:00:00 | 503 | x",
        'h - - [01/May/2024:10:00:00] "q" 404 1', 'h - - [31/Feb/2024:10:00:00] "q" 404 1', "\tat a.B", "", "caused " + "by " * 20, "# own WARN tail", "é" * 20,
    ]
    for pattern in (None, r"own (?P<level>[A-Z]+) (?P<message>.*)$"):
        formats = ["gin", "nginx", "logback"]
        rows = []
        for i in range(600):
            text = rnd.choice(texts)
            if shell == "cri" and rnd.random() < 0.9:
                text = f"2024-05-01T10:00:{i % 60:02d}.5Z {rnd.choice(['stdout', 'stderr'])} {rnd.choice('PFFF')} {text}"
            discard = rnd.random() < 0.04
            rows.append((f"f{i % 7}", 0, i, None if discard else text, 1000 + i if discard else None))
        # a file ends with a head, so nothing is left in a state
        end = f"2024-05-01T10:00:00Z stdout F {HEAD}end" if shell == "cri" else f"{HEAD}end"
        rows += [(f"f{k}", 0, 1000 + k, end, None) for k in range(7)]
        raw = spark.createDataFrame(rows, "file string, generation int, offset long, line string, discard_bytes long")
        batch = Pipeline(now).parser(formats, pattern).container(shell).limits(4, 64).build(raw)
        events = []
        for k in range(7):
            a = Assembler(formats, pattern, max_lines=4, max_bytes=64, shell=shell)
            a.init(Handle())
            mine = [r for r in raw.where(f"file = 'f{k}'").orderBy("offset").collect()]
            for at in range(0, len(mine), 9):
                events += list(a.handleInputRows((f"f{k}",), iter(mine[at : at + 9]), Clock()))
            events += list(a.handleExpiredTimer((f"f{k}",), Clock(), None))
        from tarnlog.streaming.assembler import EVENT

        order = [f.name for f in EVENT]
        made = runner.parsed(spark.createDataFrame([tuple(e[c] for c in order) for e in events], EVENT), formats, pattern)
        names = ["file", "level", "logger", "thread", "message", "stream"]
        show = lambda df: sorted(str(tuple(r)) for r in df.select(*names, F.when(F.year("timestamp") == 2024, F.col("timestamp"))).collect())
        assert show(made) == show(batch)


def test_rename_and_waiting_part(spark):
    rows = [("a.log", 0, 0, f"2024-05-01T10:00:00Z stdout F {HEAD}x", None), ("a.log.1", 0, 90, "2024-05-01T10:00:00Z stdout F more", None), ("a.log.1", 0, 120, "2024-05-01T10:00:00Z stdout P open", None)]
    made = spark.createDataFrame(rows, "file string, generation int, offset long, line string, discard_bytes long").orderBy("offset").collect()
    a = Assembler(["logback"], shell="cri")
    a.init(Handle())
    assert list(a.handleInputRows(("k",), iter(made), Clock())) == []
    (event,) = a.handleExpiredTimer(("k",), Clock(), None)
    assert (event["file"], event["n_lines"], event["tail"]) == ("a.log", 3, "\nmore\nopen")
    assert list(a.handleExpiredTimer(("k",), Clock(), None)) == []


def test_labels_are_asked_for_once(spark):
    from tarnlog.sources.labels import Labels

    asked = []

    def fetch(namespace, pod):
        asked.append(pod)
        if pod == "p-3" and asked.count("p-3") == 1:
            raise OSError("no answer")
        return {"p-1": "s1", "p-3": "s3"}.get(pod)

    df = spark.createDataFrame([("n", "p-1"), ("n", "p-1"), ("n", "p-2"), ("n", "p-3"), (None, None)], "namespace string, pod string")
    known = Labels(fetch)
    known.table(df)
    assert sorted(map(tuple, known.table(df).collect())) == [("n", "p-1", "s1"), ("n", "p-2", None), ("n", "p-3", "s3")]
    assert sorted(asked) == ["p-1", "p-2", "p-3", "p-3"]


def test_http_sink(spark):
    import gzip
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from tarnlog.sinks import stream

    seen = []

    class Server(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"] or 0))
            seen.append((self.headers["Content-Encoding"], gzip.decompress(body) if self.headers["Content-Encoding"] else body))
            out = b"1" if "EXISTS" in self.path else b"timestamp\nlevel\n" if "system.columns" in self.path else b""
            self.send_response(200)
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    rows = spark.range(5).selectExpr("timestamp_ntz'2024-01-01 00:00:00' timestamp", *[f"'{c}' {c}" for c in ("level", "trace_id", "span_id", "thread", "logger", "message", "file", "host")]).coalesce(1)
    for compress in (True, False):
        stream.http_sink(url, "d", "t", compress=compress, max_events=2)(rows, 0)
    assert [e for e, _ in seen] == ["gzip"] * 3 + [None] * 3 and [b.count(b"\n") for _, b in seen] == [1, 1, 0] * 2
    stream.http_health(url, "d", "t", ["level"])
    with pytest.raises(ValueError, match="lacks columns: zone"):
        stream.http_health(url, "d", "t", ["level", "zone"])
    server.shutdown()
