"""Registered queries of the log engine, and the SQL that checks them.

The tables hold few raw logs, so lines are rendered from known columns and parsed back; the SQL
computes the expected columns from the source and never parses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlog.operators import assemble, batching, enrich, parsers, shell
from tarnlog.pipeline import Pipeline
from tarnlog.plans import served
from tarnlog.runtime import table
from tarnlog.sinks import table as sink_table
from tarnlog.sinks.encode import json_rows, text_rows, timestamp_text, timestamp_with_offset
from tarnlog.schema import CORE

_NOW = "timestamp_ntz'2024-06-01 00:00:00'"

#: Expressions that both engines read.
LEVEL = "case event_type when 'error' then 'ERROR' when 'click' then 'WARN' when 'view' then 'INFO' when 'signup' then 'DEBUG' else 'FATAL' end"
LOGGER = "concat('shop.', event_type)"
THREAD = "concat('worker-', cast(user_id as string))"
TRACE = "md5(cast(event_id as string))"
SPAN = "substr(md5(cast(user_id as string)), 1, 16)"
MESSAGE = "concat(event_type, ' by ', cast(user_id as string), ' ', props)"
STATUS = "(case event_id % 4 when 0 then 200 when 1 then 302 when 2 then 404 else 503 end)"
ACCESS_LEVEL = "case event_id % 4 when 2 then 'WARN' when 3 then 'ERROR' else 'INFO' end"
TS_S = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
MS_D = "strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g')"
SEC_D = "strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.000')"

LOGBACK_LINE = f"format_string('%s [TID:%s] [SpanID:%s] [%s] %-5s %s -%s', {TS_S}, {TRACE}, {SPAN}, {THREAD}, {LEVEL}, {LOGGER}, {MESSAGE})"
BRACKET_LINE = f"format_string('%s [%s] %s %s', replace(date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS'), '.', ','), {LEVEL}, {LOGGER}, {MESSAGE})"
GIN_LINE = f"format_string('[GIN] %s | %d | 1.2ms | 10.0.0.1 | GET \"/p/%d\"', date_format(ts, 'yyyy/MM/dd - HH:mm:ss'), {STATUS}, event_id)"
GIN_D = f"concat('[GIN] ', strftime(ts, '%Y/%m/%d - %H:%M:%S'), ' | ', cast({STATUS} as string), ' | 1.2ms | 10.0.0.1 | GET \"/p/', cast(event_id as string), '\"')"
NGINX_LINE = f"format_string('10.0.0.1 - - [%s] \"GET /p/%d HTTP/1.1\" %d 12 \"-\" \"probe\"', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), event_id, {STATUS})"
NGINX_D = f"concat('10.0.0.1 - - [', strftime(ts, '%d/%b/%Y:%H:%M:%S'), '] \"GET /p/', cast(event_id as string), ' HTTP/1.1\" ', cast({STATUS} as string), ' 12 \"-\" \"probe\"')"


def _events(spark: SparkSession, d: str, line: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.expr(line).alias("line"))


def _fields(df: DataFrame, parser: parsers.Parser, *names: str) -> DataFrame:
    rec = df.select("event_id", parser(F.col("line")).alias("r"))
    return rec.select("event_id", timestamp_text(F.col("r.timestamp")).alias("timestamp"), *[F.col(f"r.{n}").alias(n) for n in names])


_ALL = ("level", "trace_id", "span_id", "thread", "logger", "message")


def _now():
    return F.expr(_NOW)


def logback_parse(s, d):
    return _fields(_events(s, d, LOGBACK_LINE), parsers.logback(_now()), *_ALL)


def bracketed_level(s, d):
    return _fields(_events(s, d, BRACKET_LINE), parsers.logback(_now()), *_ALL)


def trace_id_normalize(s, d):
    spelled = f"case event_id % 5 when 0 then upper({TRACE}) when 1 then substr({TRACE}, 1, 16) when 2 then 'N/A' when 3 then concat('1.', cast(event_id as string)) else concat(' ', {TRACE}, ' ') end"
    line = f"format_string('%s [TID:%s] %s %s -x', {TS_S}, {spelled}, {LEVEL}, {LOGGER})"
    return _fields(_events(s, d, line), parsers.logback(_now()), "trace_id")


def custom_regex_parse(s, d):
    line = f"format_string('%s|%s|%s|%s', {LEVEL}, {TS_S}, {LOGGER}, {MESSAGE})"
    pattern = r"^(?P<level>[A-Z]+)\|(?P<timestamp>[^|]*)\|(?P<logger>[^|]*)\|(?P<message>.*)$"
    return _fields(_events(s, d, line), parsers.custom(pattern, _now()), "level", "logger", "message")


def gin_parse(s, d):
    return _fields(_events(s, d, GIN_LINE), parsers.gin, "level", "logger", "message")


def nginx_parse(s, d):
    return _fields(_events(s, d, NGINX_LINE), parsers.nginx, "level", "logger", "message")


def format_chain(s, d):
    line = f"case event_id % 3 when 0 then {LOGBACK_LINE} when 1 then {GIN_LINE} else {NGINX_LINE} end"
    return _fields(_events(s, d, line), parsers.factory(["gin", "nginx", "logback"], _now()), "level", "logger", "message")


def _document_lines(s, d, head: bool = True) -> DataFrame:
    """Documents as files: a head line with the first line of the text, then its other lines."""
    parts = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    lines = table(s, d, "documents").select("doc_id", F.posexplode(parts).alias("offset", "part"))
    prefix = F.when(F.col("offset") == 0, F.lit("2024-05-01 10:00:00.123 [main] INFO  docs.Reader ->")).otherwise("") if head else F.lit("")
    return lines.select(
        F.col("doc_id").alias("file"),
        F.lit(0).alias("generation"),
        F.col("offset").cast("long").alias("offset"),
        F.concat(prefix, F.col("part")).alias("content"),
        F.lit(None).cast("string").alias("stream"),
        F.lit(None).cast("timestamp_ntz").alias("shell_time"),
    )


def _assembled(s, d, **limits) -> DataFrame:
    events = assemble.assemble(_document_lines(s, d), parsers.logback(_now()), _now(), **limits)
    return events.select(F.col("file").alias("doc_id"), timestamp_text(F.col("timestamp")).alias("timestamp"), "level", "logger", "message", F.col("n_lines").cast("long").alias("n_lines"))


def multiline_assemble(s, d):
    return _assembled(s, d, max_lines=1 << 30, max_bytes=1 << 30)


def multiline_truncate_lines(s, d):
    return _assembled(s, d, max_lines=3, max_bytes=1 << 30).select("doc_id", "message")


def multiline_truncate_bytes(s, d):
    return _assembled(s, d, max_lines=1 << 30, max_bytes=400).select("doc_id", "message")


def orphan_lines(s, d):
    events = assemble.assemble(_document_lines(s, d, head=False), parsers.logback(_now()), _now())
    return events.select(F.col("file").alias("doc_id"), "offset", "level", "message")


def cri_decode(s, d):
    line = f"format_string('%sZ %s %s %s', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), case when event_id % 2 = 0 then 'stdout' else 'stderr' end, case when event_id % 7 = 0 then 'P' else 'F' end, {MESSAGE})"
    mixed = f"case when event_id % 11 = 0 then concat('no shell ', props) else {line} end"
    out = shell.decode(_events(s, d, mixed), "cri")
    return out.select("event_id", "content", "stream", "tag")


CHUNK = 50


def cri_partial_join(s, d):
    chunks = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    docs = table(s, d, "documents").select("doc_id", F.when(F.size(chunks) > 0, chunks).otherwise(F.array(F.lit(""))).alias("c"))
    parts = docs.select("doc_id", F.size("c").alias("n"), F.posexplode("c").alias("i", "c"))
    tag = F.when(F.col("i") == F.col("n") - 1, "F").otherwise("P")
    lines = parts.select(F.col("doc_id").alias("file"), F.lit(0).alias("generation"), F.col("i").cast("long").alias("offset"), F.concat(F.lit("2024-05-01T10:00:00.000000000Z stdout "), tag, F.lit(" "), F.col("c")).alias("line"))
    return shell.join_parts(shell.decode(lines, "cri")).select(F.col("file").alias("doc_id"), F.col("content").alias("text"), "stream")


def _paths(s, d) -> DataFrame:
    pods = table(s, d, "supplier").join(F.broadcast(table(s, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    ns = F.lower(F.regexp_replace("n_name", "[^A-Za-z]", "-"))
    pod = F.concat(F.lit("pod-"), F.col("s_suppkey").cast("string"))
    pods_path = F.concat(F.lit("/var/log/pods/"), ns, F.lit("_"), pod, F.lit("_u-1/app/0.log"))
    link_path = F.concat(F.lit("/var/log/containers/"), pod, F.lit("_"), ns, F.lit("_app-0a1b.log"))
    path = F.when(F.col("s_suppkey") % 3 == 0, link_path).when(F.col("s_suppkey") % 3 == 1, pods_path).otherwise(F.lit("/var/log/other.log"))
    return pods.select("s_suppkey", path.alias("file"))


def pod_path_parse(s, d):
    return enrich.with_pod(_paths(s, d)).select("s_suppkey", "namespace", "pod", "container")


def pod_path_logs(s, d):
    return enrich.with_pod(table(s, d, "log_events").select("row_id", "file")).select("row_id", "namespace", "pod", "container")


def pod_selector(s, d):
    chosen = enrich.select_pods(enrich.with_pod(_paths(s, d)), include={"pod": ["pod-1*", "pod-?"]}, exclude={"pod": ["*5"]}, self_pod="pod-7")
    return chosen.select("s_suppkey", "pod")


def service_name_logs(s, d):
    logs = table(s, d, "log_events").select("row_id", "namespace", "pod", "service_name")
    return enrich.with_service(logs, table(s, d, "pod_labels"), default="unlabelled").select("row_id", "service_name")


def _records(s, d) -> DataFrame:
    """Records as the assembled table has them, made from the events table."""
    cols = {"timestamp": "ts", "level": LEVEL, "trace_id": TRACE, "span_id": SPAN, "thread": THREAD, "logger": LOGGER, "message": MESSAGE, "file": "'/srv/log/shop.log'", "host": "'h1'", "service_name": "concat('svc-', cast(user_id % 7 as string))"}
    return table(s, d, "events").select("event_id", *[F.expr(v).alias(k) for k, v in cols.items()])


def json_encode(s, d):
    return json_rows(_records(s, d).drop("event_id"))


def text_render(s, d):
    return text_rows(_records(s, d))


def timestamp_offset(s, d):
    return _records(s, d).select("event_id", timestamp_with_offset(F.col("timestamp"), "Asia/Shanghai").alias("stamped"))


def estimated_size(s, d):
    rows = _records(s, d).withColumn("shard", F.col("event_id") % 4).withColumn("canary", F.expr("event_id % 2 = 0"))
    rows = rows.withColumn("zone", F.expr("case when event_id % 3 = 0 then null else 'z12' end")).withColumn("tags", F.expr("array(level, logger)"))
    size = enrich.estimated_size(rows, [c for c in CORE if c != "timestamp"], ["service_name", "shard", "canary", "zone", "tags"])
    return rows.select("event_id", size.alias("size"))


def backoff_schedule(s, d):
    attempt = F.col("n_nationkey") + 1
    return table(s, d, "nation").select(attempt.cast("long").alias("attempt"), batching.backoff_column(attempt).alias("wait_ms"))


def batch_numbers(s, d):
    policy = batching.BatchPolicy(max_events=40, max_bytes=900)
    out = batching.number_batches(_records(s, d), ["timestamp", "event_id"], F.octet_length("message"), policy, ["service_name"])
    return out.groupBy("service_name", "batch").agg(F.count(F.lit(1)).alias("n"))


def errors_by_service(s, d):
    return served.errors_by_service(_records(s, d))


def errors_by_service_logs(s, d):
    window = served.between(table(s, d, "log_events"), "2024-01-02 00:00:00", "2024-01-05 00:00:00")
    return served.errors_by_service(window)


def trace_lookup(s, d):
    return served.by_trace(_records(s, d), "c4ca4238a0b923820dcc509a6f75849b").select("event_id", "trace_id", timestamp_text(F.col("timestamp")).alias("timestamp"))


def trace_window(s, d):
    return served.around_trace(table(s, d, "log_events"), "048892bae5668f36d5ef7582d6489852", "2024-01-01 00:09:00", 2).select("row_id", "trace_id")


def keyword_token(s, d):
    return table(s, d, "log_events").where(served.has_token(F.col("message"), "Lease")).select("row_id")


def keyword_substring(s, d):
    return table(s, d, "log_events").where(served.has_text(F.col("message"), "timed OUT")).select("row_id")


def keyword_cjk(s, d):
    return table(s, d, "log_events").where(served.has_text(F.col("message"), "未命中")).select("row_id")


def service_keyword(s, d):
    logs = table(s, d, "log_events").where("service_name = 'seat-map'")
    return logs.where(served.has_token(F.col("message"), "refused")).select("row_id", "service_name")


def failed_requests(s, d):
    line = _events(s, d, GIN_LINE)
    rec = line.select("event_id", parsers.gin(F.col("line")).alias("r")).select("event_id", "r.*")
    return served.failed_requests(rec).select("event_id", "message")


def token_index_top(s, d):
    index = served.token_index(table(s, d, "log_events"), "row_id")
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("n_rows")).where("token rlike '^[a-z]+$'")


def events_per_day(s, d):
    """Rows of each day partition, as the table is laid out."""
    logs = sink_table.laid_out(table(s, d, "log_events").select("timestamp", "level", "service_name", "trace_id"))
    return logs.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day"), "level").agg(F.count(F.lit(1)).alias("n"))


def schema_missing_columns(s, d):
    table(s, d, "log_events").createOrReplaceTempView("tarnlog_events")
    lacking = sink_table.missing_columns(s, "tarnlog_events", [*CORE, "stream", "namespace", "pod", "container", "service_name", "region_code"])
    return s.createDataFrame([(c,) for c in lacking], "column_name string")


def transform_filter(s, d):
    steps = [lambda df: df.where("level <> 'DEBUG'"), lambda df: df.withColumn("message", F.upper("message"))]
    return enrich.transform(_records(s, d), *steps).select("event_id", "level", "message")


def static_fields(s, d):
    return enrich.with_fields(_records(s, d), {"env": "prod", "shard": 3, "canary": False, "service_name": "late"}).select("event_id", "env", "shard", "canary", "service_name")


def pipeline_errors(s, d):
    """The whole path: lines with stack traces, in shells, assembled, enriched and counted."""
    ev = table(s, d, "events").select("event_id", F.expr(LOGBACK_LINE).alias("head"), F.expr("event_type = 'error'").alias("err"), "user_id")
    lines = F.when(F.col("err"), F.array("head", F.lit("java.lang.IllegalStateException: x"), F.lit("\tat a.B.c(B.java:1)"))).otherwise(F.array("head"))
    raw = ev.select("event_id", "user_id", F.posexplode(lines).alias("i", "text")).select(
        F.concat(F.lit("/var/log/pods/shop_web-"), (F.col("user_id") % 5).cast("string"), F.lit("_u1/app/0.log")).alias("file"),
        F.lit(0).alias("generation"),
        (F.col("event_id") * 10 + F.col("i")).cast("long").alias("offset"),
        F.concat(F.lit("2024-05-01T10:00:00.000Z stdout F "), F.col("text")).alias("line"),
    )
    labels = s.createDataFrame([("shop", f"web-{k}", f"web{k % 2}") for k in range(5)], "namespace string, pod string, service_name string")
    events = Pipeline(_now()).container("cri").labels(labels).host("h1").build(raw)
    multi = events.where("level = 'ERROR'").groupBy("service_name")
    return multi.agg(F.count(F.lit(1)).alias("n_errors"), F.sum("n_lines").alias("n_lines"))


QUERIES = {
    f.__name__: f
    for f in (
        logback_parse, bracketed_level, trace_id_normalize, custom_regex_parse, gin_parse, nginx_parse, format_chain, multiline_assemble,
        multiline_truncate_lines, multiline_truncate_bytes, orphan_lines, cri_decode, cri_partial_join, pod_path_parse, pod_path_logs, pod_selector,
        service_name_logs, json_encode, text_render, timestamp_offset, estimated_size, backoff_schedule, batch_numbers, errors_by_service,
        errors_by_service_logs, trace_lookup, trace_window, keyword_token, keyword_substring, keyword_cjk, service_keyword, failed_requests,
        token_index_top, events_per_day, schema_missing_columns, transform_filter, static_fields, pipeline_errors,
    )
}

_REC = f"select event_id, ts, {LEVEL} as level, {TRACE} as trace_id, {SPAN} as span_id, {THREAD} as thread, {LOGGER} as logger, {MESSAGE} as message, '/srv/log/shop.log' as file, 'h1' as host, concat('svc-', cast(user_id % 7 as string)) as service_name from events"
_LINES = "select doc_id, coalesce(string_split(coalesce(text, ''), chr(10)), ['']) as l from documents"
_NS = "lower(regexp_replace(n_name, '[^A-Za-z]', '-', 'g'))"
_PODS_D = f"""select s_suppkey, case when s_suppkey % 3 <> 2 then {_NS} end as namespace,
  case when s_suppkey % 3 <> 2 then concat('pod-', cast(s_suppkey as string)) end as pod,
  case when s_suppkey % 3 <> 2 then 'app' end as container
  from supplier join nation on s_nationkey = n_nationkey"""

ORACLE = {
    "logback_parse": f"select event_id, {MS_D} as timestamp, level, trace_id, span_id, thread, logger, message from ({_REC})",
    "bracketed_level": f"select event_id, {MS_D} as timestamp, level, '' as trace_id, '' as span_id, '' as thread, logger, message from ({_REC})",
    "trace_id_normalize": f"""select event_id, {MS_D} as timestamp, case event_id % 5 when 0 then {TRACE} when 1 then lpad(substr({TRACE}, 1, 16), 32, '0')
        when 2 then '' when 3 then concat('1.', cast(event_id as string)) else {TRACE} end as trace_id from events""",
    "custom_regex_parse": f"select event_id, {MS_D} as timestamp, level, logger, message from ({_REC})",
    "gin_parse": f"select event_id, {SEC_D} as timestamp, {ACCESS_LEVEL} as level, 'gin' as logger, {GIN_D} as message from events",
    "nginx_parse": f"select event_id, {SEC_D} as timestamp, {ACCESS_LEVEL} as level, 'nginx' as logger, {NGINX_D} as message from events",
    "format_chain": f"""select event_id, case event_id % 3 when 0 then {MS_D} else {SEC_D} end as timestamp,
        case event_id % 3 when 0 then {LEVEL} else {ACCESS_LEVEL} end as level,
        case event_id % 3 when 0 then {LOGGER} when 1 then 'gin' else 'nginx' end as logger,
        case event_id % 3 when 0 then {MESSAGE} when 1 then {GIN_D} else {NGINX_D} end as message from events""",
    "multiline_assemble": f"select doc_id, '2024-05-01 10:00:00.123' as timestamp, 'INFO' as level, 'docs.Reader' as logger, concat('>', array_to_string(l, chr(10))) as message, len(l) as n_lines from ({_LINES})",
    "multiline_truncate_lines": f"""select doc_id, case when len(l) <= 3 then concat('>', array_to_string(l, chr(10))) else concat('>', array_to_string(l[1:3], chr(10)), chr(10),
        '... [tarnlog 截断：省略 ', cast(len(l) - 3 as string), ' 行 / ', cast(list_sum(list_transform(l[4:], lambda x: strlen(x) + 1)) as string), ' 字节]') end as message from ({_LINES})""",
    "multiline_truncate_bytes": f"""with q as (select doc_id, unnest(l) as c, generate_subscripts(l, 1) as i from ({_LINES})),
        p as (select doc_id, case when i = 1 then concat('>', c) else c end as c, i from q),
        r as (select *, sum(strlen(c) + case when i = 1 then 0 else 1 end) over (partition by doc_id order by i) as upto from p),
        f as (select *, min(case when i = 1 or upto - 1 < 400 then 1 else 0 end) over (partition by doc_id order by i) as keep from r)
        select doc_id, concat(string_agg(case when keep = 1 then c end, chr(10) order by i), case when min(keep) = 0 then concat(chr(10),
        '... [tarnlog 截断：省略 ', cast(sum(1 - keep) as string), ' 行 / ', cast(sum(case when keep = 0 then strlen(c) + 1 else 0 end) as string), ' 字节]') else '' end) as message
        from f group by doc_id""",
    "orphan_lines": f"select doc_id, cast(generate_subscripts(l, 1) - 1 as bigint) as \"offset\", '' as level, unnest(l) as message from ({_LINES})",
    "cri_decode": f"""select event_id, case when event_id % 11 = 0 then concat('no shell ', props) else {MESSAGE} end as content,
        case when event_id % 11 = 0 then null when event_id % 2 = 0 then 'stdout' else 'stderr' end as stream,
        case when event_id % 11 = 0 then null when event_id % 7 = 0 then 'P' else 'F' end as tag from events""",
    "cri_partial_join": "select doc_id, coalesce(text, '') as text, 'stdout' as stream from documents",
    "pod_path_parse": _PODS_D,
    "pod_path_logs": "select row_id, namespace, pod, container from log_events",
    "pod_selector": f"select s_suppkey, pod from ({_PODS_D}) where (pod like 'pod-1%' or pod like 'pod-_') and pod not like '%5' and pod <> 'pod-7'",
    "service_name_logs": """select row_id, coalesce(p.service_name, 'unlabelled') as service_name from log_events l left join
        (select namespace, pod, min(service_name) as service_name from pod_labels where service_name is not null group by all) p on l.namespace = p.namespace and l.pod = p.pod""",
    "json_encode": f"""select concat('{{"timestamp":"', {MS_D}, '","level":"', level, '","trace_id":"', trace_id, '","span_id":"', span_id, '","thread":"', thread, '","logger":"', logger,
        '","message":', to_json(message), ',"file":"', file, '","host":"', host, '","service_name":"', service_name, '"}}') as value from ({_REC})""",
    "text_render": f"select concat({MS_D}, ' [TID:', trace_id, '] [SpanID:', span_id, '] [', thread, '] ', rpad(level, 5, ' '), ' ', logger, ' -', message) as value from ({_REC})",
    "timestamp_offset": f"select event_id, concat({MS_D}, '+08:00') as stamped from events",
    "estimated_size": f"""select event_id, cast(160 + strlen(level) + strlen(trace_id) + strlen(span_id) + strlen(thread) + strlen(logger) + strlen(message) + strlen(file) + strlen(host)
        + strlen(service_name) + 2 + 12 + 4 + 8 + 5 + 4 + 5 + 6 + 4 + case when event_id % 3 = 0 then 4 else 5 end + 4 + 4
        + 2 + strlen(level) + 2 + 1 + strlen(logger) + 2 + 1 + 4 + 4 as bigint) as size from ({_REC})""",
    "backoff_schedule": "select cast(n_nationkey + 1 as bigint) as attempt, cast(least(30000, 500 * pow(2, n_nationkey)) as bigint) as wait_ms from nation",
    "batch_numbers": f"""with recursive r as (select service_name, strlen(message) as size, row_number() over (partition by service_name order by ts, event_id) as k from ({_REC})),
        w as (select service_name, k, cast(0 as bigint) as batch, cast(1 as bigint) as n, cast(size as bigint) as total from r where k = 1
          union all select r.service_name, r.k, w.batch + case when w.n >= 40 or w.total >= 900 then 1 else 0 end,
            case when w.n >= 40 or w.total >= 900 then 1 else w.n + 1 end, case when w.n >= 40 or w.total >= 900 then r.size else w.total + r.size end
          from w join r on r.service_name = w.service_name and r.k = w.k + 1)
        select service_name, batch, count(*) as n from w group by all""",
    "errors_by_service": f"select service_name, count(*) as n_errors from ({_REC}) where level = 'ERROR' group by service_name",
    "errors_by_service_logs": "select service_name, count(*) as n_errors from log_events where level = 'ERROR' and timestamp >= timestamp '2024-01-02' and timestamp <= timestamp '2024-01-05' group by service_name",
    "trace_lookup": f"select event_id, trace_id, {MS_D} as timestamp from ({_REC}) where trace_id = 'c4ca4238a0b923820dcc509a6f75849b'",
    "trace_window": "select row_id, trace_id from log_events where trace_id = '048892bae5668f36d5ef7582d6489852' and timestamp between timestamp '2024-01-01 00:07:00' and timestamp '2024-01-01 00:11:00'",
    "keyword_token": r"select row_id from log_events where list_contains(regexp_split_to_array(lower(message), '[\x00-\x2f\x3a-\x60\x7b-\x7f]+'), 'lease')",
    "keyword_substring": "select row_id from log_events where contains(lower(message), 'timed out')",
    "keyword_cjk": "select row_id from log_events where contains(lower(message), '未命中')",
    "service_keyword": r"select row_id, service_name from log_events where service_name = 'seat-map' and list_contains(regexp_split_to_array(lower(message), '[\x00-\x2f\x3a-\x60\x7b-\x7f]+'), 'refused')",
    "failed_requests": f"select event_id, {GIN_D} as message from events where event_id % 4 = 3",
    "token_index_top": r"""select token, count(*) as n_rows from (select unnest(list_distinct(regexp_split_to_array(lower(message), '[\x00-\x2f\x3a-\x60\x7b-\x7f]+'))) as token from log_events)
        where regexp_full_match(token, '[a-z]+') group by token""",
    "events_per_day": "select strftime(timestamp, '%Y-%m-%d') as day, level, count(*) as n from log_events group by all",
    "schema_missing_columns": "select 'region_code' as column_name",
    "transform_filter": f"select event_id, level, upper(message) as message from ({_REC}) where level <> 'DEBUG'",
    "static_fields": f"select event_id, 'prod' as env, cast(3 as integer) as shard, false as canary, service_name from ({_REC})",
    "pipeline_errors": """select case (user_id % 5) % 2 when 0 then 'web0' else 'web1' end as service_name, count(*) as n_errors, cast(count(*) * 3 as bigint) as n_lines
        from events where event_type = 'error' group by all""",
}
