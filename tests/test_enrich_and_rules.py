import pytest
from pyspark.sql import functions as F
from tarnlog import config, schema
from tarnlog.operators import batching, enrich
from tarnlog.sinks import encode, stream, table
from tarnlog.sources.files import discover, lines_of, read_lines, spool
from tarnlog.sources.tail import start_position


def test_pod_paths(spark):
    paths = ["/var/log/pods/ns_pod-1_u-1/app/0.log", "/var/log/containers/pod-1_ns_app-x-0a.log", "/var/log/pods/_p_u/app/0.log", "/srv/x.log", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, file string")
    rows = enrich.with_pod(df).orderBy("i").collect()
    assert [(r["namespace"], r["pod"], r["container"]) for r in rows] == [("ns", "pod-1", "app"), ("ns", "pod-1", "app-x"), *[(None, None, None)] * 3]


def test_selector(spark):
    df = spark.createDataFrame([("a", "p1", "c"), ("a", "p2", "c"), ("b", "p1", "c"), (None, None, None)], "namespace string, pod string, container string")
    assert enrich.select_pods(df).count() == 4
    assert enrich.select_pods(df, {"namespace": ["a"]}, {"pod": ["*2"]}).count() == 1
    assert enrich.select_pods(df, self_pod="p1").count() == 1
    with pytest.raises(ValueError):
        enrich.glob_regex("a[")


def test_labels_never_multiply(spark):
    logs = spark.createDataFrame([("n", "p", None), ("n", "q", "old"), (None, None, None)], "namespace string, pod string, service_name string")
    labels = spark.createDataFrame([("n", "p", "b"), ("n", "p", "a"), ("n", "q", None)], "namespace string, pod string, service_name string")
    got = sorted(r["service_name"] for r in enrich.with_service(logs, labels, "d").collect())
    assert got == ["a", "d", "d"]


def test_fields_and_size(spark):
    df = spark.range(1).select(F.lit("é").alias("message"))
    assert enrich.with_fields(df, {"n": 1, "b": True, "s": [1]}).dtypes[1:] == [("n", "int"), ("b", "boolean"), ("s", "string")]
    with pytest.raises(ValueError):
        enrich.with_fields(df, {"level": "x"})
    rich = df.selectExpr("message", "1 n", "true b", "cast(null as string) z", "'ab' s", "array(1, 2) a", "map('k', 'v') m", "named_struct('x', 1.5, 'y', array('q')) st")
    size = lambda *c: rich.select(enrich.estimated_size(rich, ["message"], c)).first()[0] - 162
    assert size() == 0 and size("n") == 8 + 5 and size("b") == 5 + 5 and size("z") == 4 + 5 and size("s") == 4 + 5
    assert size("a") == 2 + 16 + 2 + 5 and size("m") == 2 + 1 + 3 + 4 + 5 and size("st") == 2 + (1 + 8 + 4) + (1 + (2 + 3 + 1) + 4) + 6
    shared = F.create_map(F.lit("a"), F.lit("x"))
    own = F.create_map(F.lit("b"), F.lit("y"))
    assert df.select(enrich.get_field(own, shared, "a"), enrich.get_field(own, shared, "b")).first()[:] == ("x", "y")


def test_policies():
    p = batching.BatchPolicy(10, 100, 1)
    assert not p.full(0, 0, 9) and p.full(10, 0, 0) and p.full(1, 100, 0) and p.full(1, 0, 1)
    r = batching.RetryPolicy()
    assert [r.wait_ms(k) for k in (1, 2, 7, 99)] == [500, 1000, 30_000, 30_000]
    calls = []

    def fail():
        calls.append(1)
        raise OSError

    assert r.run(fail, "drop", lambda s: None) is False and len(calls) == 5
    with pytest.raises(OSError):
        r.run(fail, "stop", lambda s: None)
    assert batching.advance(5, 3) == 5
    assert list(stream.bodies(["aa", "b", "c" * 9, "d"], 2, 8)) == [b"aa\nb", b"c" * 9, b"d"]
    assert batching.prune({"a": {"path": "x"}, "b": {"path": "y"}}, {"a"}, lambda p: False) == {"a": {"path": "x"}}


def test_batches_start_anew(spark):
    df = spark.createDataFrame([("k", i, "x" * 60, 1) for i in range(6)] + [("j", 0, None, 2)], "key string, i int, message string, batch_no int")
    policy = batching.BatchPolicy(max_events=2, max_bytes=100)
    got = batching.number_batches(df, ["i"], F.octet_length("message"), policy, ["key"])
    assert [r["batch"] for r in got.where("key = 'k'").orderBy("i").collect()] == [0, 0, 1, 1, 2, 2] and got.where("key = 'j'").first()["batch"] == 0
    few = batching.number_batches(df, ["i"], F.octet_length("message"), batching.BatchPolicy(100, 150), ["key"])
    assert [r["batch"] for r in few.where("key = 'k'").orderBy("i").collect()] == [0, 0, 0, 1, 1, 1]
    assert batching.number_batches(df.where("false"), ["i"], F.lit(1), policy, ["key"]).count() == 0


@pytest.mark.parametrize(
    "saved,size,begin,first,sibling,want",
    [(5, 9, False, True, False, 5), (9, 5, True, True, False, 0), (None, 7, True, True, False, 0), (None, 7, False, False, False, 0), (None, 7, False, True, True, 0), (None, 7, False, True, False, 7)],
)
def test_start_position(saved, size, begin, first, sibling, want):
    assert start_position(saved, size, begin, first, sibling) == want


def test_encoding_keeps_the_clock_in_a_gap(spark):
    df = spark.sql("select timestamp_ntz'1991-04-14 02:30:00.9999' t union all select timestamp_ntz'2024-07-01 00:00:00'")
    got = [r[0] for r in df.select(encode.timestamp_with_offset(F.col("t"), "Asia/Shanghai")).collect()]
    assert got[0].startswith("1991-04-14 02:30:00.999+0") and got[1] == "2024-07-01 00:00:00.000+08:00"


def test_table(spark, tmp_path):
    cols = schema.ordered([*schema.CORE, "service_name", "zone"])
    assert cols[:2] == ["timestamp", "service_name"] and cols[-3:] == ["zone", "file", "message"]
    spark.sql("drop table if exists t_events")
    table.upgrade(spark, "t_events")
    table.healthcheck(spark, "t_events", schema.CORE)
    with pytest.raises(ValueError, match="lacks columns: pod"):
        table.healthcheck(spark, "t_events", [*schema.CORE, "pod"])
    table.upgrade(spark, "t_events", {"pod": "STRING"})
    assert table.missing_columns(spark, "t_events", ["pod"]) == []
    spark.sql("alter table t_events add partition (event_date='2020-01-01')")
    assert table.drop_expired(spark, "t_events", "2020-01-20") == [] and table.drop_expired(spark, "t_events", "2020-03-01") == ["event_date=2020-01-01"]
    spark.sql("drop table t_events")
    with pytest.raises(ValueError, match="does not exist"):
        table.healthcheck(spark, "t_events", [])
    assert table.expired(["event_date=2024-01-01", "event_date=2024-02-20"], "2024-03-01") == ["event_date=2024-01-01"]
    events = spark.sql("select timestamp_ntz'2024-01-01 10:00:00' timestamp, 's' service_name, 'INFO' level, 'x' trace_id, 'm' message")
    stream.parquet_sink(str(tmp_path))(events, 1)
    stream.parquet_sink(str(tmp_path))(events, 1)
    assert spark.read.parquet(str(tmp_path)).count() == 1


def test_sources(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"x\r\ny\x85z\n\xff\n")
    (tmp_path / "b.log.gz").write_bytes(b"")
    (tmp_path / ".c.log").write_text("q\n")
    assert [p.rsplit("/", 1)[1] for p in discover([f"{tmp_path}/*"], ["*c.log"])] == ["a.log"]
    rows = read_lines(spark, f"{tmp_path}/a.log", host="h").orderBy("offset").collect()
    assert len(rows) == 3 and rows[0]["line"] == "x" and rows[0]["host"] == "h" and rows[0]["file"] == f"{tmp_path}/a.log"
    (tmp_path / "d e+f%.log").write_text("z\n")
    assert [r["file"] for r in read_lines(spark, f"{tmp_path}/*.log", excludes=[f"{tmp_path}/a*"]).where("line <> 'q'").collect()] == [f"{tmp_path}/d e+f%.log"]
    import io

    spool(str(tmp_path / "stdin"), io.BytesIO(b"a\nb")).join()
    assert (tmp_path / "stdin").read_bytes() == b"a\nb\n"
    assert lines_of(spark, ["a", "b"]).count() == 2


def test_config():
    ok = config.parse({"source": {"type": "file", "include": ["*"]}, "sink": {"type": "console"}, "batch": {"max_bytes": 1 << 25}})
    assert ok["retry"]["max_attempts"] == 5 and ok["pipeline"]["max_inflight_bytes"] == 1 << 27
    for bad in ({}, {"source": {"type": "file", "include": ["*"]}, "sink": {"type": "clickhouse", "endpoint": "e", "database": "d", "table": "t", "cluster": "c"}}, {"source": {"type": "file", "include": ["*"]}, "sink": {"type": "x"}}, {"what": {}}, {"source": {"type": "file", "include": ["*"], "zzz": 1}, "sink": {"type": "console"}}):
        with pytest.raises(config.ConfigError):
            config.parse(bad)
