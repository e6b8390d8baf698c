from pyspark.sql import functions as F
from tarnlog.operators import assemble, parsers, shell
from tarnlog.pipeline import Pipeline

NOW = F.expr("timestamp_ntz'2000-01-01 00:00:00'")
HEAD = "2026-03-05 01:02:03 INFO a.B -"


def lines_of(spark, lines, block=1):
    rows = [("f", 0, i * block, None if isinstance(x, int) else x, x if isinstance(x, int) else None) for i, x in enumerate(lines)]
    return spark.createDataFrame(rows, "file string, generation int, offset long, line string, discard_bytes long")


def events(spark, lines, shell_format="raw", **limits):
    p = Pipeline(NOW).container(shell_format)
    if limits:
        p = p.limits(limits.get("max_lines", 500), limits.get("max_bytes", 262_144))
    return [(r["offset"], r["message"]) for r in p.build(lines_of(spark, lines, 3 << 20)).orderBy("offset").collect()]


def test_continuations_orphans_and_blocks(spark):
    got = events(spark, ["lost", HEAD + "one", "\tat x", "", HEAD + "two"])
    assert [m for _, m in got] == ["lost", "one\n\tat x\n", "two"]


def test_byte_limit(spark):
    got = events(spark, [HEAD + "x", "a" * 200, "b" * 32], max_bytes=64)
    assert got[0][1] == "x\n... [tarnlog 截断：省略 2 行 / 234 字节]"


def test_line_limit(spark):
    got = events(spark, [HEAD + "x", "a", "b", HEAD + "y"], max_lines=2)
    assert [m for _, m in got] == ["x\na\n... [tarnlog 截断：省略 1 行 / 2 字节]", "y"]


def test_discard_seals(spark):
    got = events(spark, [5, HEAD + "x", 1 << 20, "tail", HEAD + "y"])
    assert [m for _, m in got] == [f"x\n... [tarnlog 截断：省略 2 行 / {(1 << 20) + 5} 字节]", "y"]
    # with nothing open, the rest of the lost line goes up to the next head
    assert [m for _, m in events(spark, ["lost", 7, "tail", "more", HEAD + "y", "z"])] == ["lost", "y\nz"]


def test_shell_parts(spark):
    t = "2026-03-05T01:02:03.123456789Z"
    got = events(spark, [f"{t} stdout P {HEAD}par", "no shell", f"{t} stderr F t", f"{t} stdout F more", f"{t} stdout F"], "cri")
    assert [m for _, m in got] == ["no shell", "part\nmore\n"]
    df = shell.decode(lines_of(spark, [f"{t} stdout F:x a", f"{t} other F a"]), "cri").orderBy("offset").collect()
    assert (df[0]["content"], df[0]["stream"], df[0]["tag"]) == ("a", "stdout", "F") and df[1]["tag"] is None and df[1]["content"].endswith("a")


def test_open_part_is_kept(spark):
    t = "2026-03-05T01:02:03Z"
    assert [m for _, m in events(spark, [f"{t} stdout F {HEAD}x", f"{t} stdout P open"], "cri")] == ["x\nopen"]


def test_empty(spark):
    assert events(spark, []) == []


def test_order_of_parser_does_not_matter_for_orphans(spark):
    df = assemble.assemble(shell.join_parts(shell.decode(lines_of(spark, ["x", "y"]), "raw")), parsers.gin, NOW)
    assert sorted(r["message"] for r in df.collect()) == ["x", "y"]
