import itertools
import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F
from tarnlog.llm import distinct, runs, statements, truncation


def test_registers_merge_and_bound(spark):
    rows = [(d, s, f"id{i}") for d in (1, 2) for s in ("a", None) for i in range(d * 1000, d * 1000 + 3000)] + [(1, "a", None)]
    df = spark.createDataFrame(rows, "day int, service_name string, trace_id string")
    part = distinct.registers(df, ["day", "service_name"], "trace_id", 10)
    halves = distinct.registers(df.where("day = 1"), ["day", "service_name"], "trace_id", 10).unionByName(distinct.registers(df.where("day = 2"), ["day", "service_name"], "trace_id", 10))
    merged = distinct.merge(halves, ["day", "service_name"])
    assert sorted(map(str, merged.collect())) == sorted(map(str, part.collect()))
    est = {(r["day"], r["service_name"], r["level"]): r for r in distinct.estimates(distinct.combinations(part, ["day", "service_name"]), ["day", "service_name", "level"], 10).collect()}
    assert len(est) == 9
    for key, exact in (((1, "a", 0), 3000), ((1, None, 1), 3000), ((None, None, 3), 4000), ((None, None, 2), 4000)):
        assert est[key]["low"] <= exact <= est[key]["high"]
        assert abs(est[key]["n_distinct"] - exact) < 0.12 * exact
    assert distinct.registers(df.where("false"), ["day"], "trace_id").count() == 0


def test_bounds_hold_at_every_size(spark):
    """Sets of 10 to a million ids; three standard errors hold nearly always, and there is no bias in between."""
    m, rows = 1 << distinct.PRECISION, []
    for seed in range(20):
        rnd = np.random.default_rng(seed)
        for n in (10, 300, 5000, 20_000, 28_000, 36_000, 42_000, 50_000, 80_000, 1_000_000):
            h = rnd.integers(0, 1 << distinct.HASH_BITS, n, dtype=np.int64)
            ranks = np.zeros(m, dtype=np.int64)
            width = distinct.HASH_BITS - distinct.PRECISION
            np.maximum.at(ranks, h & (m - 1), width - np.floor(np.log2(np.maximum(h >> distinct.PRECISION, 0.5))).astype(np.int64))
            rows.append((n, int((ranks > 0).sum()), float((2.0 ** -ranks[ranks > 0]).sum())))
    df = spark.createDataFrame(rows, "n long, filled long, powers double")
    got = df.select("n", distinct.estimate(F.col("filled"), F.col("powers")).alias("v")).collect()
    error = 1.04 / m**0.5
    assert sum(abs(r["v"] - r["n"]) > 3 * error * r["n"] for r in got) <= 2
    for n in {r["n"] for r in got}:
        assert abs(np.mean([r["v"] / n - 1 for r in got if r["n"] == n])) < error


def test_rank_of_edge_hashes(spark):
    df = spark.range(1, 2000).select(F.col("id").cast("string").alias("x"))
    reg, rank = distinct.register_of(F.col("x"), 4)
    got = df.select("x", reg.alias("g"), rank.alias("r")).collect()
    import hashlib

    for r in got:
        h = int(hashlib.md5(r["x"].encode()).hexdigest()[:15], 16)
        assert r["g"] == h & 15 and r["r"] == 56 + 1 - (h >> 4).bit_length()


def test_statements(spark):
    texts = [f"Cache hit for {x}" for x in ("a_b", "c_d", "book", "book")] * 5 + [f"Cache miss for {x}" for x in ("a_b", "c_d", "book")] * 5
    texts += [f"Poll took {x}" for x in ("1.5s", "2m3s", "17 ms", "88")] + ["Flag 'x-y' set to on", "Flag 'x-z' set to off", ""]
    df = spark.createDataFrame([(x,) for x in texts] + [(None,)], "message string")
    lines = df.select("message", statements.masked(F.col("message")).alias("template"))
    got = {r["message"]: r["statement"] for r in lines.join(statements.statements(lines), "template").collect()}
    assert len({got[x] for x in texts if "hit" in x}) == 1 and len({got[x] for x in texts if x.startswith("Cache")}) == 2
    assert len({got[x] for x in texts if x.startswith("Poll")}) == 1
    assert got["Flag 'x-y' set to on"] != got["Flag 'x-z' set to off"]


def plain_runs(rows):
    out = []
    for seq, group in itertools.groupby(sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or datetime.min, r[2])), key=lambda r: r[0]):
        for _, run in itertools.groupby(list(group), key=lambda r: r[3]):
            run = list(run)
            if len(run) > 1:
                ms = lambda t: int((t - datetime(1970, 1, 1)) / timedelta(milliseconds=1))
                out.append((seq, run[0][2], run[-1][2], len(run), None if run[0][1] is None else ms(run[-1][1]) - ms(run[0][1])))
    return sorted(out)


def test_runs_against_plain_loop(spark):
    rnd = random.Random(3)
    base = datetime(2024, 1, 1)
    rows = [(rnd.choice(["p", "q", None]), base + timedelta(microseconds=rnd.randrange(0, 60_000_000)), i, rnd.choice("ABC") * 8) for i in range(600)]
    rows += [("r", base, 10_000 + i, "S") for i in range(5)] + [("t", None, 20_000, "Z"), ("t", None, 20_001, "Z")]
    df = spark.createDataFrame(rows, "seq string, ts timestamp_ntz, id long, stmt string")
    for bucket in (3, 40, 20_000):
        assert sorted(map(tuple, runs.collapse(df, bucket_rows=bucket).collect())) == plain_runs(rows)
    assert runs.collapse(df.where("false")).count() == 0


def test_cut_texts_end_a_run(spark):
    """A cut text lacks fixed words, and is no bridge between two statements."""
    hit, miss, part = "Digest cache hit", "Digest cache miss", "Digest cac"
    for seq, want in (([hit, part, miss], []), ([hit, hit, part, hit, hit], [(0, 1), (3, 4)]), ([hit, "Digest cache hit for x"], []), ([part, part], [(0, 1)]), ([None, None, part], [(0, 1)])):
        df = spark.createDataFrame([("p", datetime(2024, 1, 1, 0, 0, i), i, t) for i, t in enumerate(seq)], "seq string, ts timestamp_ntz, id long, stmt string")
        for rows in (100, 2):
            assert sorted((r["first_id"], r["last_id"]) for r in runs.collapse(df, bucket_rows=rows).collect()) == want, (seq, rows)


def test_further_lines_make_a_statement(spark):
    crash = lambda i, error, line=88: f"Worker {i} crashed while handling task {i}\n{error}: slot {i} already taken\n\tat /a.b.C.d(C.java:{line})\n\t... {i} more"
    a, b = "java.lang.IllegalStateException", "java.io.IOException"
    texts = [crash(1, a), crash(2, a, 9), crash(3, b), crash(4, b), crash(5, a)[:60], crash(6, a)]
    texts += [crash(7, b)[:70] + "\n... [x 截断：省略 3 行 / 109 字节]", crash(8, b), "Worker 9 stopped", "Worker 10 stopped"]
    df = spark.createDataFrame([("p", datetime(2024, 1, 1, 0, 0, i), i, x) for i, x in enumerate(texts)], "seq string, ts timestamp_ntz, id long, message string")
    got = runs.statement_runs(df.withColumn("template", statements.masked(F.col("message"))).drop("message"))
    assert sorted((r["first_id"], r["last_id"]) for r in got.collect()) == [(0, 1), (2, 3), (8, 9)]


def test_truncation(spark):
    rnd = random.Random(5)
    names = [f"{a}-{b}" for a in ("amber", "brisk", "keen") for b in ("kettle", "dune", "willow")]
    texts = []
    for i in range(400):
        texts += [f"Lease on {rnd.choice(names)} released for {i} seconds", f"Job {rnd.choice(names)} started", f"Waiting for {rnd.choice(names)}...", f"Session {rnd.randrange(1 << 47, 1 << 48):012x} closed"]
        texts.append("Trace\n\tat a.b.C.d(E.java:1)\n\t... %d more" % i)
    # an ending of its own that also begins a commoner token
    texts += [f"Depth is {i} after {i}.5 s" for i in range(40)] + [f"Process {i} ready after {i}.5 s, profile x" for i in range(120)]
    whole = len(texts)
    cut = ["Lease on amber-kettle rel", "Job brisk-", "Job keen-dun", "Lease on keen-willow released for", "Session 12ab", "Trace\n\tat a.b.C.d(E.ja", "Trace\n... [x 截断：省略 3 行 / 109 字节]", "Lease on gr�"]
    rows = [(i, x, "p", "s", "f") for i, x in enumerate(texts + cut)] + [(9001, None, None, None, None), (9002, " \n", None, None, None)]
    df = spark.createDataFrame(rows, "row_id long, message string, pod string, service_name string, file string")
    found = truncation.verdicts(df)
    got = {r["id"]: r["evidence"] for r in found.collect()}
    assert set(got) == set(range(whole, whole + len(cut))), {(i, (texts + cut)[i]) for i in set(got) ^ set(range(whole, whole + len(cut)))}
    assert got[whole + 6] == "marker" and got[whole + 7] == "character"
    assert truncation.verdicts(df.where("false")).count() == 0
    report = truncation.report(df, found).where("service_name = 's'").first()
    assert report["n_cut"] == len(cut)


def test_rare_endings_of_cut_texts(spark):
    names = "Anchor Falcon Garnet Harbor Juniper Lantern Meadow Orchard Pebble Quarry".split()
    frame = lambda i: f"\n\tat a.b.{names[i % 10]}.c{'xyz'[i % 3]}({names[i % 10]}.java:{i})"
    whole = [f"Task {i} failed{frame(i)}{frame(i + 1)}" for i in range(60)]
    cut = ["Task 1 failed\n\tat a.b.Valley.q(Valley.", "Task 2 failed\n\tat a.b.Thicket.q(Thick"]
    # a limit of 80 characters: endings that occur once each
    word = lambda i: "".join(chr(97 + (i * k) % 26) for k in (3, 5, 7, 11))
    known = [f"Sum {word(i)}{word(i + 50)}".ljust(71, chr(97 + i % 26)) + " verified" for i in range(20)]
    limited = [f"Note {word(i)} {word(i + 100)} ".ljust(80, chr(97 + i % 26))[:80] for i in range(40)]
    short = [f"Note {word(i + 200)} {word(i + 300)} {word(i + 400)} {'t' * (i % 30)}" for i in range(40)]
    texts = whole + short + known + cut + limited
    df = spark.createDataFrame([(i, x, "p", "s" if "Task" in x else "t", "f") for i, x in enumerate(texts)], "row_id long, message string, pod string, service_name string, file string")
    got = {r["id"]: r["evidence"] for r in truncation.verdicts(df).collect()}
    first = len(whole + short + known)
    assert got == {first: "ending", first + 1: "ending"} | {i: "limit" for i in range(first + 2, len(texts))}


def test_spikes(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(600):
        text = "".join(rnd.choice('ab "é\n') for _ in range(rnd.randrange(20, 400)))
        b = text.encode()[:200]
        rows += [("pod|chars", text[:200]), ("pod|free", text), ("pod|bytes", b.decode("utf-8", "ignore")), ("pod|two", text[: (40, 160)[i % 2]])]
    df = spark.createDataFrame(rows, "source string, text string")
    sizes = truncation.encodings(F.col("text"))
    got = {}
    for r in truncation.spikes(df.select("source", F.array(*[sizes[k].cast("int") for k in truncation.KINDS]).alias("lens"))).collect():
        got.setdefault(r["source"], {})[r["len"]] = r["encoding"]
    assert got["pod|chars"][200] == "chars" and got["pod|bytes"][200] == "utf8" and "pod|free" not in got
    assert got["pod|two"][40] == got["pod|two"][160] == "chars" and {40, 160, 200} <= set(got["pod"])


def test_two_limits_of_one_service(spark):
    """Short and long limit of one source; whole texts of one length are no limit."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(3, 9)))
    whole = [f"Stage {word()} done after {rnd.randrange(10, 99)} ms" for _ in range(400)] + ["Readiness check passed"] * 50
    cut = []
    for limit in (41, 90):
        cut += [" ".join(word() for _ in range(40))[:limit].rstrip().ljust(limit, "q") for _ in range(30)]
    df = spark.createDataFrame([(i, x, "p", "s" if i % 2 else None, "f") for i, x in enumerate(whole + cut)], "row_id long, message string, pod string, service_name string, file string")
    got = {r["id"]: r["evidence"] for r in truncation.verdicts(df).collect()}
    assert got == {i: "limit" for i in range(len(whole), len(whole) + len(cut))}


def test_longer_tokens_by_running_sums(spark):
    rnd = random.Random(9)
    words = {("l", "m", "".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 6)))): (rnd.randrange(1, 9), rnd.randrange(2)) for _ in range(60)}
    words[("l", "m", "a" * 3000)] = (5, 1)
    df = spark.createDataFrame([(*k, *v) for k, v in words.items()], "l2 string, l1 string, x string, tx long, ends long")
    got = {r["x"]: r["longer_x"] for r in truncation._longer(df, "x", "tx").collect()}
    want = {k[2]: sum(n for j, (n, _) in words.items() if j[2].startswith(k[2]) and j != k) for k, (_, e) in words.items() if e}
    assert got == {k: v for k, v in want.items() if v}


def test_encodings(spark):
    import html
    import json

    for text in ('a"b\\c\n\td', "é<&>'", "🙂x", ""):
        cols = truncation.encodings(F.lit(text))
        got = spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first().asDict()
        js = json.dumps(text, ensure_ascii=False)[1:-1]
        assert got == {
            "chars": len(text), "utf8": len(text.encode()), "utf16": len(text.encode("utf-16-le")) // 2, "json": len(js), "json_utf8": len(js.encode()),
            "entities": len(html.escape(text).replace("&#x27;", "&#39;")), "crlf": len(text.replace("\n", "\r\n")), "crlf_utf8": len(text.replace("\n", "\r\n").encode()),
        }
