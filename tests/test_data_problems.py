import hashlib
from datetime import datetime

from pyspark.sql import functions as F
from tarnlog import runtime
from tarnlog.operators import delivery, fields, stamps

HOSTS = [("n1", "n1.x.example", "Europe/Berlin"), ("n2", "n2.x.example", "America/New_York")]


def hosts(spark):
    return spark.createDataFrame([(h, f, "s", z) for h, f, z in HOSTS], "host string, fqdn string, site string, tz string")


LOG = "row_id long, timestamp timestamp_ntz, host string, file string, namespace string, pod string, container string, message string, machine string"


def logs(spark, tmp_path, rows):
    path = str(tmp_path / "logs.parquet")
    spark.createDataFrame(rows, LOG).repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def test_delivery(spark, tmp_path, monkeypatch):
    t, u = datetime(2024, 1, 1, 0, 0, 0, 1200), datetime(2024, 1, 1, 0, 0, 0, 1999)
    pods = "/var/log/pods/a_p_u/c/0.log"
    rows = [
        (1, t, "n1", pods, "a", "p", "c", "m", "x"),
        (2, u, "N1.X.example", "/var/log/containers/p_a_c-1.log", "a", "p", "c", "m \n\t", "y"),
        (3, t, "n2", pods, "a", "p", "c", "m", "x"),
        (4, t, "n1", "/s/app.log", None, None, None, "m", "x"),
        (5, t, "n1", "/s/app.log.20240101-000000", None, None, None, "m", "x"),
        (6, None, None, None, None, None, None, None, None),
        (7, None, None, None, None, None, None, None, None),
        (7, None, None, None, None, None, None, None, None),
        (8, t, "n1", "/s/app.log", None, None, None, " m", "x"),
    ]
    df = logs(spark, tmp_path, rows)
    lost = sorted(r["ord"] for r in delivery.surplus(df, hosts(spark)).collect())
    assert lost == [2, 5, 7, 7]
    kept = delivery.without_repeats(df, hosts(spark))
    assert kept.columns == df.columns and sorted(r["row_id"] for r in kept.collect()) == [1, 3, 4, 6, 8]
    assert delivery.surplus(df.where("row_id < 0"), hosts(spark)).count() == 0
    # a key with more copies than a task should have, and what is left behind
    monkeypatch.setattr(delivery, "SALT_ROWS", 1)
    assert sorted(r["ord"] for r in delivery.surplus(df, hosts(spark)).collect()) == lost
    assert runtime.release(spark) >= 3 and runtime.release(spark) == 0


def read_stamps(spark, rows):
    df = spark.createDataFrame([(i, h, "f", i * 10, t, datetime.fromisoformat(r)) for i, (t, h, r) in enumerate(rows)], "stamp_id long, host string, file string, line_offset long, timestamp string, received_at timestamp_ntz")
    df = df.withColumn("tz", F.lit("x")).withColumn("machine", F.lit(1)).withColumn("cands", F.lit(1)).withColumn("text", F.lit("2024"))  # clashing names
    return {r["stamp_id"]: r["utc_ms"] for r in stamps.normalise(df, hosts(spark)).collect()}


def test_stamps(spark):
    utc = lambda *a: int((datetime(*a) - datetime(1970, 1, 1)).total_seconds() * 1000)
    cases = [
        ("2024-10-27 02:30:00", "N1", "2024-10-27T02:00:00", utc(2024, 10, 27, 0, 30)),  # occurs twice: the earlier
        ("2024-03-31 02:30:00", "n1", "2024-03-31T02:00:00", utc(2024, 3, 31, 0, 30)),  # does not occur
        ("[03/Apr/2025:10:11:12 -0400]", "n2", "2025-04-03T14:12:00", utc(2025, 4, 3, 14, 11, 12)),
        ("\t03.04.2025 10:11:12", "n1", "2025-04-03T08:12:00", utc(2025, 4, 3, 8, 11, 12)),
        ("Dec 31 23:59:59", "n1.x.example", "2025-01-01T00:00:00", utc(2024, 12, 31, 22, 59, 59)),
        ("0101 00:00:01.5", "n1", "2024-12-31T23:00:05", utc(2024, 12, 31, 23, 0, 1) + 500),
        ("2025-01-02 03:04:05.999999 EST", "n2", "2025-01-03T00:00:00", utc(2025, 1, 2, 8, 4, 5) + 999),
        ("2025-01-02T03:04:05[Asia/Kolkata]", "n2", "2025-01-02T00:00:00", utc(2025, 1, 1, 21, 34, 5)),
        ("1719454130235479988", "n1", "2024-06-27T03:00:00", 1719454130235),
        ("1742011651.268", "n1", "2025-03-15T05:00:00", 1742011651268),
        ("Jun 11, 2026 12:08:58 AM", "n1", "2026-06-11T00:00:00", utc(2026, 6, 10, 22, 8, 58)),
        ("2026-04-31T05:59:15Z", "n1", "2026-05-01T00:00:00", None),
        ("2026-04-30 24:00:00", "n1", "2026-05-01T00:00:00", None),
        ("NaN", "n1", "2026-05-01T00:00:00", None),
        ("", "n1", "2026-05-01T00:00:00", None),
        (None, "n1", "2026-05-01T00:00:00", None),
        ("2026-04-30 10:00:00", "nobody", "2026-05-01T00:00:00", None),
        ("2026-04-30 10:00:00Z", "nobody", "2026-05-01T00:00:00", utc(2026, 4, 30, 10)),
    ]
    got = read_stamps(spark, [c[:3] for c in cases])
    assert [got.get(i) for i in range(len(cases))] == [c[3] for c in cases]
    assert read_stamps(spark, []) == {}


def test_viterbi_against_all_paths():
    import itertools
    import random

    rnd = random.Random(1)
    day = stamps.DAY_MS
    for _ in range(60):
        rows = [(rnd.randrange(0, 90) * day, [(f, rnd.randrange(0, 90) * day) for f in range(rnd.randrange(1, 4))]) for _ in range(rnd.randrange(1, 5))]
        before = (rnd.randrange(3), rnd.randrange(90) * day) if rnd.random() < 0.5 else None
        after = (rnd.randrange(3), rnd.randrange(90) * day) if rnd.random() < 0.5 else None

        def cost(path):
            full = ([before] if before else []) + list(path) + ([after] if after else [])
            steps = sum(stamps.SWITCH_COST * (a[0] != b[0]) + stamps.BACK_COST * (b[1] < a[1]) for a, b in zip(full, full[1:]))
            return steps + sum(stamps.emission(c[1], r[0]) for c, r in zip(path, rows))

        best = min(cost(p) for p in itertools.product(*[r[1] for r in rows]))
        got = stamps.viterbi(before, [(*r, i) for i, r in enumerate(rows)], after)
        assert any(abs(cost(p) - best) < 1e-4 for p in itertools.product(*[r[1] for r in rows]) if [c[1] for c in p] == got)


STAMPS = "stamp_id long, host string, file string, line_offset long, timestamp string, received_at timestamp_ntz"


def test_order_alone_decides(spark):
    """One value that is two days; only what stands around it tells which. No receipt, so no distance counts."""
    around = {
        "f": ["2025-04-30 10:00:00", "05.06.2025 11:00:00", "2025-05-13 10:00:00"],
        "g": ["2025-06-02 10:00:00", "05.06.2025 11:00:00", "2025-06-13 10:00:00"],
        "h": ["13.05.2025 10:00:00", "05.06.2025 11:00:00", "05.07.2025 11:00:00"],
    }
    rows = [(10 * k + i, "n1", f, i * 100, x, None) for k, (f, xs) in enumerate(around.items()) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, STAMPS)
    utc = lambda *a: int((datetime(*a) - datetime(1970, 1, 1)).total_seconds() * 1000)
    for size in (1, 2, 1 << 20):
        got = {r["stamp_id"]: r["utc_ms"] for r in stamps.normalise(df, hosts(spark), size).collect()}
        assert (got[1], got[11], got[21], got[22]) == (utc(2025, 5, 6, 9), utc(2025, 6, 5, 9), utc(2025, 6, 5, 9), utc(2025, 7, 5, 9)), size


def test_blocks_change_nothing(spark):
    import random

    rnd = random.Random(4)
    rows = []
    for k in range(6):
        for i in range(80):
            day = rnd.choice(["2025-{:02d}-{:02d} 10:00:00", "{1:02d}.{0:02d}.2025 10:00:00"][:: rnd.choice([1, -1])] + ["{1:02d}.{0:02d}.2025 10:00:00"] * (4 + k)).format(rnd.randrange(1, 13), rnd.randrange(1, 13))
            rows.append((1000 * k + i, "n1", f"f{k}", i * 10, day, datetime(2025, rnd.randrange(1, 13), 28) if rnd.random() < 0.3 else None))
    df = spark.createDataFrame(rows, STAMPS)
    results = [sorted(map(tuple, stamps.normalise(df, hosts(spark), size).collect())) for size in (1 << 20, 20, 3, 1)]
    assert len(results[0]) == len(rows) and all(r == results[0] for r in results)
    first = lambda x: datetime.strptime(x, "%d.%m.%Y %H:%M:%S") if "." in x else datetime.fromisoformat(x)
    plain = {r[0]: int((first(r[4]) - datetime(1970, 1, 1)).total_seconds() // 86400) for r in rows}
    assert sum(plain[i] != (ms + 7_200_000) // 86_400_000 for i, ms in results[0]) > 20  # order and receipt decide often here


LINES = "file string, generation int, line_offset long, line string, discard_bytes long, read_at timestamp_ntz"
AT = datetime(2024, 1, 8)
TEXTS = ["Lease on x-{i} released", "{i} shards left", "10.1.2.{i} refused", "订单 {i} 已入队", "io.x.Lock: held {i}", "'a' took {i} ms", "[x{i}] body", "Poll idle", "(see {i}) | odd"]


def corpus(layouts, n=60):
    """(line, level, component, message) of each layout, n times, with texts that begin with anything."""
    out = []
    for k, (form, level, name, escape) in enumerate(layouts):
        for i in range(n):
            text = "-5 degrees" if i == 7 else TEXTS[(i + k) % len(TEXTS)].format(i=i % 90)
            line = form.replace("%m", escape(text)).replace("%i", f"{i % 60:02d}").replace("%c", name)
            out.append((line, level, name, line if escape is None else text))
    return out


def same(x):
    return x


def quoted(x):
    return x.replace('"', '\\"')


LAYOUTS = [
    ("2024-01-06 02:27:%i,152 - %c - DEBUG - %m", "DEBUG", "a.router", same),
    ('{"ts": 1704308334042, "pid": 1%i, "severity": "NOTICE", "logger": "%c", "message": "%m", "ctx": {"level": 1}}', "INFO", "k", quoted),
    ('time=2024-01-06T03:36:%i.112Z msg="%m" peer=17 level=err component=%c', "ERROR", "w", quoted),
    ("<131>1 2024-01-05T10:22:%i.001Z h-1 %c 17 ID%i - %m", "ERROR", "x-store", same),
    ("F0106 11:25:%i.651626   89829 %c:7%i] %m", "FATAL", "r_store.go", same),
    ("2024-01-06T10:27:%i.460147+08:00|CRITICAL|%c|%m", "FATAL", "j-r", same),
    ("2024-01-06T03:36:%i.553687Z  WARN %c: %m", "WARN", "b::kettle", same),
    ("2024-01-06 06:05:%i.765 [TID:AA] [w-1] INFO  %c -%m", "INFO", "c.d.E", same),
    ("2024-01-06 06:05:%i,765 [ERROR] %c %m", "ERROR", "c.d.F", same),
]
#: Layouts that no rule names: level first, bracketed time, a word as component, dashes and brackets, a tabbed one.
NEW = [
    ("ERROR 2024-01-06 06:05:%i %c: %m", "ERROR", "cache", same),
    ("[2024-01-06 06:05:%i.1] [warn] %c | %m", "WARN", "scheduler", same),
    ("2024-01-06 06:05:%i.123  INFO 4711 --- [main] %c  : %m", "INFO", "o.s.Boot", same),
    ("2024/01/06 06:05:%i\tFATAL\t%c\t%m", "FATAL", "io.y.Zed", same),
]


def placed(spark, lines, step=100):
    return spark.createDataFrame([("f", 0, i * step, x, None, AT) for i, x in enumerate(lines)], LINES)


def check(spark, made):
    got = {r["line_offset"] // 100: (r["level"], r["component"], r["message"]) for r in fields.entries(placed(spark, [m[0] for m in made])).collect()}
    wrong = {made[i][0]: got.get(i) for i in range(len(made)) if got.get(i) != (*made[i][1:3], made[i][3].rstrip())}
    return wrong, got


def test_fields(spark):
    # a dash behind a name is layout, so no text begins with one there
    made = [m for m in corpus(LAYOUTS) if not (m[3].startswith("-") and m[2] == "c.d.F")]
    assert check(spark, made)[0] == {}


def test_layouts_that_no_list_holds(spark, monkeypatch):
    made = [m for m in corpus(NEW + LAYOUTS) if not (m[3].startswith("-") and m[2] == "c.d.F")]
    assert check(spark, made)[0] == {}
    # the counts decide: without them the fields end elsewhere
    learn = fields.learn
    monkeypatch.setattr(fields, "learn", lambda lines: fields.Dictionary(keys=learn(lines).keys))
    assert len(check(spark, made)[0]) > 100


def test_entries(spark):
    lines = [m[0] for m in corpus(LAYOUTS)]
    n = len(lines)
    lines += [
        "2024-01-06 02:27:39,152 - a.router - DEBUG - hello",
        "2024-01-06 is not a booking day",
        "",
        "2024-01-08 12:34:03 last seen on shard 24",
        "INFO blocks follow for x",
        "E0106: rule set is empty",
        '{"ts": 1704308334042, "severity": "NOTICE", "logger": "k", "message": "a\\nb \\u00fc \\ud800"}',
        "{",
        '{"\\u0002\\u0003": 1, "ts": 1704308334042, "severity": "NOTICE", "logger": "k\\udfff", "message": "odd keys"}',
        '{"a":' * 5000,
        'time=2024-01-06T03:36:39.112Z msg="say \\"x\\" level=debug" level=err component=w',
        "[GIN] 2024/01/05 - 22:37:36 | 404 |   76.089ms |   10.1.1.1 | GET",
        '10.8.1.2 - bob [07/Jan/2024:00:51:31 +0100] "DELETE /x HTTP/1.1" 204 8 "-" "t"',
        "2024-01-06 06:05:40.765 [TID:AA] [w-1] INFO  c.d.E -body",
        "2024-02-30 06:05:40.765 [w-1] INFO  c.d.E - no such day",
        "F0106 11:25:07.651626   89829 r_store.go:799] end  ",
    ]
    rows = [("g", 0, 0, "orphan", None, AT)] + [("f", 0, i * (3 << 20), x, None, AT) for i, x in enumerate(lines)]
    rows += [rows[1], ("f", 0, 9999 << 20, "lost", 5, AT), ("f", 0, 9998 << 20, None, None, AT), ("g", 0, 1, "x", None, None), ("g", None, 2, lines[n], None, None), (None, 0, 2, lines[-1], None, None), ("g", 7, 5, "x" * 300_000, None, AT)]
    df = spark.createDataFrame(rows, LINES)
    for c in ("block", "style", "n", "ms", "year", "a", "opened"):
        df = df.withColumn(c, F.lit("clash"))
    got = [r for r in fields.entries(df).orderBy("line_offset").collect() if r["line_offset"] >= n * (3 << 20)]
    assert [tuple(r)[3:7] + (r["message"],) for r in got] == [
        (6, "2024-01-06 02:27:39.152", "DEBUG", "a.router", "hello\n" + "\n".join(lines[n + 1 : n + 6])),
        (2, "2024-01-03 18:58:54.042", "INFO", "k", "a\nb ü \ufffd\n{"),
        (2, "2024-01-03 18:58:54.042", "INFO", "k\ufffd", "odd keys\n" + lines[n + 9]),
        (1, "2024-01-06 03:36:39.112", "ERROR", "w", 'say "x" level=debug'),
        (1, "2024-01-05 22:37:36.000", "WARN", "gin", lines[n + 11]),
        (1, "2024-01-06 23:51:31.000", "INFO", "nginx", lines[n + 12]),
        (2, "2024-01-06 06:05:40.765", "INFO", "c.d.E", "body\n" + lines[n + 14]),
        (1, "2024-01-06 11:25:07.651", "FATAL", "r_store.go", "end"),
    ]
    # without a generation, and without a receipt for a time that has no year
    assert [r["level"] for r in fields.entries(df).where("generation is null").collect()] == ["DEBUG"] and fields.entries(df).where("file is null").count() == 0
    assert fields.entries(df.where("false")).count() == 0


def test_rare_methods_are_heads(spark):
    methods = ["GET"] * 2500 + ["POST"] * 500 + ["OPTIONS", "PATCH", "HEAD"]
    lines = [f'10.8.1.2 - - [07/Jan/2024:00:51:31 +0000] "{m} /x HTTP/1.1" 200 8 "-" "t"' for m in methods]
    lines += ['10.8.1.2 - - [07/Jan/2024:00:51:31 +0000] "quit" 400 8 "-" "-"', '10.8.1.2 - - [07/Jan/2024:00:51:31 +0000] unquoted 400 8']
    got = {r["line_offset"] // 100: (r["n_lines"], r["component"]) for r in fields.entries(placed(spark, lines)).collect()}
    assert got == {i: (1 + (i == len(lines) - 2), "nginx") for i in range(len(lines) - 1)}
