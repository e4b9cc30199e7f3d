"""Registered queries of the archive engine, and the SQL that each must equal. The log is made from the events table."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.columns import payload_bytes, segment_name
from tidelog.operators import chains, reports, segments
from tidelog.plans import archive, mirror
from tidelog.plans.storage import Files, shared_dir
from tidelog.schema import ENVELOPE, HEADERS, LOG
from tidelog.sources import archive_source
from tidelog.sources import log as logs
from tidelog.streaming import mirror as streaming

STEP, TIME_MS, BYTES, ROWS = 100, 38 * 3600 * 1000, 720, 27


# -- fixtures -----------------------------------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with topic and partition, and the payloads of the log."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    i = F.col("event_id")
    value = F.when(i % 97 == 9, None).when(i % 89 == 3, F.encode(F.lit(""), "utf-8")).otherwise(F.encode("props", "utf-8"))
    some = F.array(F.struct(F.lit("trace-id").alias("key"), F.encode(F.concat(F.lit("t"), i.cast("string")), "utf-8").alias("value")), F.struct(F.lit("null-value").alias("key"), F.lit(None).cast("binary").alias("value")))
    return e.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.when(i % 101 == 7, None).otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).alias("timestamp_ms"),
        F.when(i % 3 == 0, "create_time").when(i % 3 == 1, "log_append_time").otherwise("not_available").alias("timestamp_type"),
        F.when(i % 53 == 5, None).otherwise(F.encode(F.col("user_id").cast("string"), "utf-8")).alias("key"),
        value.alias("value"),
        F.when(i % 4 == 0, F.array().cast(HEADERS)).otherwise(some.cast(HEADERS)).alias("headers"),
    )


def full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.make_log(events(spark, sf_dir), ["ts", "event_id"])


def the_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_log(spark, sf_dir).select(*ENVELOPE.fieldNames())


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a table, for queries that scan it again and again."""
    path = fresh_root(spark, "log")
    the_log(spark, sf_dir).write.parquet(path)
    return spark.read.schema(ENVELOPE).parquet(path)


def committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed segments of STEP rows with their payload bytes, and the last row's time as commit time."""
    rows = segments.by_count(full_log(spark, sf_dir), STEP)
    found = rows.groupBy(*LOG, "from_offset").agg(F.max("offset").alias("to_offset"), F.count("*").alias("n_records"), F.sum(payload_bytes()).cast("bigint").alias("encoded_bytes"), F.max("ts").alias("committed_at"))
    return found.filter(F.col("n_records") == STEP)


def mirrors_of(log: DataFrame) -> DataFrame:
    """A mirror per log but those of partition 2, the ones of partition 3 renamed, and one per topic for a missing log."""
    have = log.select(*LOG).distinct().filter("partition != 2")
    none = log.select("topic").distinct().select("topic", F.lit(9).alias("partition"))
    return have.unionByName(none).select(F.concat_ws("-", "topic", "partition").alias("name"), *LOG, F.when(F.col("partition") == 3, F.concat(F.lit("alt_"), "topic")).alias("destination_name_override"))


def shown(df: DataFrame) -> DataFrame:
    """Envelopes with payloads as hexadecimal text."""
    text = F.array_join(F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.coalesce(F.hex(h["value"]), F.lit("null")))), ";")
    return df.select(*LOG, "offset", "timestamp_ms", "timestamp_type", F.hex("key").alias("key"), F.hex("value").alias("value"), text.alias("headers"))


def fresh_root(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log by arrival, with rows missing and rows twice."""
    rows = full_log(spark, sf_dir).select("event_id", *LOG, "offset").filter("offset % 50 != 17")
    return rows.withColumn("copy", F.explode(F.when(F.col("offset") % 70 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).withColumn("arrival", F.col("event_id") * 2 + F.col("copy"))


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chains, damaged by partition: 1 lacks a segment, 2 has a longer copy of one, 3 a foreign format and a backward range."""
    m = committed(spark, sf_dir).select(*LOG, "from_offset", "to_offset", F.lit("parquet").alias("ext")).filter(f"not (partition = 1 and from_offset = {STEP})")
    extra = F.array(
        F.when((F.col("partition") == 2) & (F.col("from_offset") % 200 == 0), F.struct(F.col("from_offset").alias("f"), (F.col("to_offset") + 50).alias("t"), F.lit("parquet").alias("e"))),
        F.when((F.col("partition") == 3) & (F.col("from_offset") % 200 == 0), F.struct(F.col("from_offset").alias("f"), F.col("to_offset").alias("t"), F.lit("ndjson").alias("e"))),
        F.when((F.col("partition") == 3) & (F.col("from_offset") % 300 == 0), F.struct((F.col("from_offset") + 5).alias("f"), F.col("from_offset").alias("t"), F.lit("parquet").alias("e"))),
    )
    return m.unionByName(m.select(*LOG, F.explode(F.array_compact(extra)).alias("x")).select(*LOG, F.col("x.f").alias("from_offset"), F.col("x.t").alias("to_offset"), F.col("x.e").alias("ext")))


# -- queries ------------------------------------------------------------------------------------------------------


def summary(spark, sf_dir):
    log = the_log(spark, sf_dir)
    found = segments.by_count(log, STEP).groupBy(*LOG).agg(F.count_distinct("from_offset").alias("n_segments"), F.sum(payload_bytes()).cast("bigint").alias("payload_bytes"), (F.max("offset") + 1).alias("next_offset"))
    return found


def make_log(spark, sf_dir):
    return full_log(spark, sf_dir).select("event_id", *LOG, "offset")


def envelope(spark, sf_dir):
    rows = full_log(spark, sf_dir).withColumn("timestampType", F.when(F.col("event_id") % 3 == 2, -1).otherwise(F.col("event_id") % 3)).withColumn("timestamp", F.col("ts"))
    return shown(logs.envelope(rows.withColumn("headers", F.when(F.size("headers") > 0, F.col("headers")))))


def log_source(spark, sf_dir):
    log = the_log(spark, sf_dir)
    starts = log.select(*LOG).distinct().filter("partition != 1").withColumn("start", F.col("partition") * 10 + 100)
    return shown(logs.log_source(log, starts))


def high_watermark(spark, sf_dir):
    log = the_log(spark, sf_dir)
    return logs.high_watermark(log, mirrors_of(log))


def log_sizes(spark, sf_dir):
    log = the_log(spark, sf_dir)
    return segments.sizes(log).join(segments.sizes(log, "object").select(*LOG, F.col("payload_bytes").alias("object_bytes")), LOG)


def header_index(spark, sf_dir):
    return segments.header_index(the_log(spark, sf_dir)).withColumn("header_value", F.hex("header_value"))


def mirror_assignment(spark, sf_dir):
    log = the_log(spark, sf_dir)
    return logs.assigned(log, mirrors_of(log)).select("mirror", "destination", *LOG, "offset")


def seek(spark, sf_dir):
    return logs.seek(the_log(spark, sf_dir), segments.next_expected(committed(spark, sf_dir))).select(*LOG, "offset")


def segment_by_count(spark, sf_dir):
    return segments.cut(the_log(spark, sf_dir), max_offsets=ROWS)


def segment_by_bytes(spark, sf_dir):
    return segments.cut(the_log(spark, sf_dir), max_bytes=BYTES)


def segment_by_time(spark, sf_dir):
    return segments.cut(the_log(spark, sf_dir), max_time_ms=TIME_MS)


def segment(spark, sf_dir):
    return segments.cut(the_log(spark, sf_dir), ROWS, BYTES, TIME_MS)


def drain_tail(spark, sf_dir):
    cut = segments.cut(the_log(spark, sf_dir), max_offsets=ROWS)
    kept = segments.drained(cut, False).groupBy(*LOG).agg(F.sum("n_records").cast("bigint").alias("kept"))
    return segments.drained(cut, True).groupBy(*LOG).agg(F.sum("n_records").cast("bigint").alias("drained")).join(kept, LOG, "left").select(*LOG, "drained", F.coalesce("kept", F.lit(0)).cast("bigint").alias("kept"))


def manifest(spark, sf_dir):
    return segments.manifest(segments.by_count(the_log(spark, sf_dir), STEP))


def next_expected(spark, sf_dir):
    return segments.next_expected(committed(spark, sf_dir), mirrors_of(the_log(spark, sf_dir)))


def counters(spark, sf_dir):
    return reports.counters(committed(spark, sf_dir))


def gauges(spark, sf_dir):
    return reports.gauges(committed(spark, sf_dir))


def flush_age(spark, sf_dir):
    return reports.flush_age(committed(spark, sf_dir), "2024-12-31 00:00:00", 60_000)


def flush_intervals(spark, sf_dir):
    return segments.flush_intervals(committed(spark, sf_dir))


def heartbeat_progress(spark, sf_dir):
    return segments.heartbeat_progress(the_log(spark, sf_dir), "1 hour").withColumn("beat", F.unix_seconds("beat"))


def catalog_segments(spark, sf_dir):
    m = committed(spark, sf_dir).withColumn("dir", F.concat_ws("/", "topic", "partition"))
    good = segment_name(F.col("from_offset"), F.col("to_offset"))
    f, t = F.col("from_offset").cast("string"), F.col("to_offset").cast("string")
    names = F.array(good, F.concat(good, F.lit(".tmp.1")), F.concat(F.lit("+"), f, F.lit("-+"), t, F.lit(".ndjson")), F.concat(F.lit(" "), f, F.lit("-"), t, F.lit(".parquet")), F.concat(f, F.lit(".5-"), t, F.lit(".parquet")), F.concat(f, F.lit("-99999999999999999999."), F.lit("parquet")), F.lit("README"))
    found = chains.catalogue(m.select("dir", F.explode(names).alias("name")))
    return found.select("dir", "name", F.col("from_offset").cast("string").alias("from_offset"), F.col("to_offset").cast("string").alias("to_offset"), "ext")


def chain_validate(spark, sf_dir):
    long = lambda c: F.col(c).cast("bigint").alias(c)
    return chains.violations(damaged(spark, sf_dir), by=("topic", "partition")).select(*LOG, "kind", long("from_offset"), long("to_offset"), long("expected_from"))


def conflicts(spark, sf_dir):
    m = committed(spark, sf_dir).select(*LOG, "from_offset", "to_offset")
    proposed = m.withColumn("from_offset", F.col("from_offset") + 250).withColumn("to_offset", F.col("to_offset") + 250)
    return chains.conflicts(proposed, m)


def conflicts_same_key(spark, sf_dir):
    m = committed(spark, sf_dir).select(*LOG, "from_offset", "to_offset")
    return chains.same_key(m.withColumn("from_offset", F.col("from_offset") + STEP).withColumn("to_offset", F.col("to_offset") + STEP), m)


def gate_contiguous(spark, sf_dir):
    return chains.gate_contiguous(broken(spark, sf_dir), arrival="arrival")


def gate_position(spark, sf_dir):
    batch = the_log(spark, sf_dir).filter(f"offset >= {STEP} + partition")
    return chains.gate_position(batch, segments.next_expected(committed(spark, sf_dir).filter(f"from_offset < {STEP}")))


def gate_produced(spark, sf_dir):
    log = the_log(spark, sf_dir)
    return chains.gate_produced(log, log.filter("offset % 61 != 7"))


def idle_drift(spark, sf_dir):
    fresh = segments.next_expected(committed(spark, sf_dir))
    return chains.idle_drift(fresh.withColumn("next_offset", F.col("next_offset") + F.when(F.col("partition") == 2, 1).otherwise(0)), fresh)


def status(spark, sf_dir):
    log = the_log(spark, sf_dir)
    high = logs.high_watermark(log).withColumn("error", F.when(F.col("partition") == 1, F.lit("timed out")))
    return reports.status(mirrors_of(log), high, segments.next_expected(committed(spark, sf_dir)))


def health(spark, sf_dir):
    return reports.health(status(spark, sf_dir))


def end_to_end_lag(spark, sf_dir):
    return reports.end_to_end_lag(logs.high_watermark(the_log(spark, sf_dir)), segments.next_expected(committed(spark, sf_dir)))


def audit_mirror(spark, sf_dir):
    log = the_log(spark, sf_dir)
    dest = log.filter("offset % 97 != 5").withColumn("value", F.when(F.col("offset") % 89 == 7, F.encode(F.lit("x"), "utf-8")).otherwise(F.col("value")))
    return reports.audit(log, dest.unionByName(log.filter("offset % 211 = 3").withColumn("offset", F.col("offset") + 1_000_000_000)))


def append_log(spark, sf_dir):
    log = stored_log(spark, sf_dir)
    held = log.filter(f"offset < {STEP}")
    return shown(held.unionByName(mirror.append_log(log, held, "source", 1_700_000_000_000)))


def append_log_restamped(spark, sf_dir):
    log = stored_log(spark, sf_dir)
    return shown(mirror.append_log(log, log.filter(f"offset < {STEP}"), "destination", 1_700_000_000_000))


def append_once(spark, sf_dir):
    """A log table that holds the first rows, brought up to the log; the second call finds nothing to add."""
    log, path = stored_log(spark, sf_dir), fresh_root(spark, "table")
    log.filter(f"offset < {STEP}").write.parquet(path)
    for _ in range(2):
        mirror.append_once(spark, log, path, "source", 1_700_000_000_000)
    return shown(mirror.log_table(spark, path))


def _written(spark, sf_dir, fmt):
    root = fresh_root(spark, f"archive-{fmt}")
    mirror.mirror_once(spark, stored_log(spark, sf_dir), root, fmt=fmt, drain=True, max_offsets=STEP)
    return root


def scan_parquet(spark, sf_dir):
    return shown(archive.replay(spark, _written(spark, sf_dir, "parquet")))


def scan_ndjson(spark, sf_dir):
    return shown(archive.replay(spark, _written(spark, sf_dir, "ndjson"), "ndjson"))


def replay(spark, sf_dir):
    return shown(archive.replay(spark, _written(spark, sf_dir, "parquet"), first=150, last=349))


def replay_in_order(spark, sf_dir):
    """Offsets 150 to 349 of the logs of partitions 0 and 1 by the archive's data source; a row is in order if it follows the one before in its task."""
    archive_source.register(spark)
    root = _written(spark, sf_dir, "parquet")
    logs_there = archive.archived(spark, root).select(*LOG).distinct().filter("partition < 2").collect()
    starts: dict = {}
    for r in logs_there:
        starts.setdefault(r["topic"], {})[r["partition"]] = 150
    rows = spark.read.format("tidelog").option("path", root).option("starts", json.dumps(starts)).option("last", 349).load()
    place = F.monotonically_increasing_id().alias("_place")
    found = shown(rows).select("*", place)
    before = F.lag("_place").over(Window.partitionBy(*LOG).orderBy("offset"))
    return found.withColumn("in_order", F.coalesce(before < F.col("_place"), F.lit(True))).drop("_place")


def write_archive(spark, sf_dir):
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.ndjson").text(_written(spark, sf_dir, "ndjson"))
    return lines.groupBy(F.get_json_object("value", "$.topic").alias("topic"), F.get_json_object("value", "$.partition").cast("int").alias("partition")).agg(F.count("*").alias("n_lines"), F.sum(F.length("value")).cast("bigint").alias("n_chars"))


def _catalogue(spark, root):
    number = lambda c: F.col(c).cast("bigint").alias(c)
    return archive.archived(spark, root).select(*LOG, "name", number("from_offset"), number("to_offset"))


def commit_segments(spark, sf_dir):
    root = fresh_root(spark, "commit")
    mirror.mirror_once(spark, stored_log(spark, sf_dir), root, max_offsets=STEP)
    return _catalogue(spark, root)


def mirror_once(spark, sf_dir):
    root = fresh_root(spark, "once")
    mirror.mirror_once(spark, stored_log(spark, sf_dir), root, drain=True, max_offsets=ROWS, max_bytes=BYTES, max_time_ms=TIME_MS)
    return _catalogue(spark, root).drop("name")


def mirror_store(spark, sf_dir):
    """An archive by commit records, stopped after 170 rows of each log and brought up to date; what its segments hold."""
    root, log = fresh_root(spark, "store"), stored_log(spark, sf_dir)
    for rows in (log.filter("offset < 170"), log):
        mirror.mirror_once(spark, rows, root, drain=rows is log, by_record=True, max_offsets=STEP)
    held = shown(archive.replay(spark, root)).groupBy(*LOG, (F.floor(F.col("offset") / STEP) * STEP).alias("from_offset")).agg(F.count("*").alias("n_rows"), F.sum(F.length("value")).cast("bigint").alias("n_digits"))
    return _catalogue(spark, root).join(held, [*LOG, "from_offset"])


def status_archive(spark, sf_dir):
    """Status of a written archive; each chain of partition 1 has a segment far behind the others, which is its row's error."""
    root, log = fresh_root(spark, "status"), stored_log(spark, sf_dir)
    mirrors = mirrors_of(log)
    mirror.mirror_once(spark, log, root, mirrors=mirrors, max_offsets=STEP)
    stray = log.filter("partition = 1 and offset = 0").withColumn("offset", F.lit(2**40)).withColumns({"destination": F.col("topic"), "from_offset": F.col("offset"), "to_offset": F.col("offset")})
    archive.commit_segments(spark, root, archive.stage_segments(stray, root))
    high = logs.high_watermark(log).withColumn("error", F.lit(None).cast("string"))
    return reports.status(mirrors, high, mirror.verified(spark, root), renamed=True)


def archive_report(spark, sf_dir):
    """Counters, gauges, flush age and intervals of the files of a written archive; times are only compared with now."""
    begin = int(time.time())
    found = archive.archived(spark, _written(spark, sf_dir, "ndjson"))
    now = spark.range(1).select(F.date_format(F.now(), "yyyy-MM-dd HH:mm:ss").alias("now")).first()["now"]
    report = reports.counters(found).join(reports.gauges(found), LOG).join(reports.flush_age(found, now, 3_600_000), LOG)
    intervals = segments.flush_intervals(found).groupBy(*LOG).agg(F.count("interval_ms").alias("n_intervals"))
    return report.join(intervals, LOG).select(*LOG, "records_total", "bytes_total", "flushes_total", "offset_verified", "n_intervals", "alert", (F.col("last_flush") >= begin - 1).alias("flushed"))


def resume_from_destination(spark, sf_dir):
    """Stopped hard after 170 rows of each log and started again: the lost tail is read anew."""
    root, log = fresh_root(spark, "resume"), stored_log(spark, sf_dir)
    mirror.mirror_once(spark, log.filter("offset < 170"), root, max_offsets=STEP)
    mirror.mirror_once(spark, log, root, drain=True, max_offsets=STEP)
    return _catalogue(spark, root)


def parallel_mirrors(spark, sf_dir):
    root, log = fresh_root(spark, "parallel"), stored_log(spark, sf_dir)
    mirror.mirror_once(spark, log, root, mirrors=mirrors_of(log), drain=True, max_offsets=STEP)
    return _catalogue(spark, root).drop("name")


def _streamed(spark, sf_dir, seen=None, drain=False):
    """The log as it arrives, in as many files as its longest log has steps of 190 offsets, in four batches."""
    source, root = fresh_root(spark, "source"), fresh_root(spark, "streamed")
    log = stored_log(spark, sf_dir)
    log.withColumn("_arrival", F.floor(F.col("offset") / 190)).repartition("_arrival").sortWithinPartitions("_arrival").write.partitionBy("_arrival").parquet(f"{source}-parts")
    parts = Files(spark, source)
    parts.make(source)
    for name in sorted((n for n in parts.names(f"{source}-parts") if "=" in n), key=lambda n: int(n.split("=")[1])):
        for i, part in enumerate(sorted(n for n in parts.names(f"{source}-parts/{name}") if n.startswith("part-"))):
            step, to = int(name.split("=")[1]), parts.path(f"{source}/{name.split('=')[1].zfill(12)}-{i}.parquet")
            parts.fs.rename(parts.path(f"{source}-parts/{name}/{part}"), to)
            parts.fs.setTimes(to, 1_700_000_000_000 + 1000 * step, -1)  # files arrive in this order
    query = streaming.mirror_stream(spark, source, root, f"{root}-checkpoint", files_per_batch=-(-len(parts.names(source)) // 4), progress=seen, max_offsets=STEP)
    query.awaitTermination()
    if seen:
        seen.over.wait(60)
    if drain:
        streaming.stop_mirror(query)
    return root


def mirror_stream(spark, sf_dir):
    return _catalogue(spark, _streamed(spark, sf_dir))


def drained_stream(spark, sf_dir):
    """A stream that is stopped with open segments: what they hold is archived."""
    return _catalogue(spark, _streamed(spark, sf_dir, drain=True))


def progress_metrics(spark, sf_dir):
    """What the stream's batches add up to, by the listener's sums per log."""
    _streamed(spark, sf_dir, seen := streaming.MirrorProgress())
    return seen.table(spark).agg(F.sum("records_total").cast("bigint").alias("n_records"), F.sum("bytes_total").cast("bigint").alias("payload_bytes"))


def progress_by_log(spark, sf_dir):
    """Rows, bytes and segments that the stream's batches came to, and each log's next offset."""
    _streamed(spark, sf_dir, seen := streaming.MirrorProgress())
    return seen.table(spark)


QUERIES = {f.__name__: f for f in (
    summary, make_log, envelope, log_source, high_watermark, log_sizes, header_index, mirror_assignment, seek, segment_by_count, segment_by_bytes, segment_by_time, segment, drain_tail, manifest, next_expected, counters, gauges, flush_age, flush_intervals, heartbeat_progress, catalog_segments, chain_validate, conflicts, conflicts_same_key, gate_contiguous, gate_position, gate_produced, idle_drift, status, health, end_to_end_lag, audit_mirror, append_log, append_log_restamped, append_once, status_archive, archive_report, scan_parquet, scan_ndjson, replay, replay_in_order, write_archive, commit_segments, mirror_once, mirror_store, resume_from_destination, parallel_mirrors, mirror_stream, progress_metrics, progress_by_log, drained_stream,
)}

# -- SQL ----------------------------------------------------------------------------------------------------------

BASE = """log as materialized (
  select event_id, ts, event_type as topic, (user_id % 4)::int as "partition",
    (row_number() over (partition by event_type, user_id % 4 order by ts, event_id) - 1)::bigint as "offset",
    case when event_id % 101 = 7 then null else epoch_us(ts) // 1000 end as timestamp_ms,
    case event_id % 3 when 0 then 'create_time' when 1 then 'log_append_time' else 'not_available' end as timestamp_type,
    case when event_id % 53 = 5 then null else encode(user_id::varchar) end as key,
    case when event_id % 97 = 9 then null when event_id % 89 = 3 then encode('') else encode(props) end as value,
    case when event_id % 4 = 0 then [] else [{key: 'trace-id', value: encode('t' || event_id)}, {key: 'null-value', value: null::blob}] end as headers
  from events),
sized as materialized (
  select *, coalesce(octet_length(key), 0) + coalesce(octet_length(value), 0) as object_size,
    coalesce(octet_length(key), 0) + coalesce(octet_length(value), 0) + case when event_id % 4 = 0 then 0 else 8 + octet_length(encode('t' || event_id)) + 10 end as size
  from log),
committed as (
  select topic, "partition", ("offset" // 100) * 100 as from_offset, max("offset") as to_offset, count(*) as n_records, sum(size)::bigint as encoded_bytes, max(ts) as committed_at
  from sized group by 1, 2, 3 having count(*) = 100),
mirrors as (
  select topic || '-' || "partition" as name, topic, "partition", case when "partition" = 3 then 'alt_' || topic end as destination_name_override
  from (select distinct topic, "partition" from log where "partition" != 2 union select distinct topic, 9 from log)),
next_expected as (select topic, "partition", max(to_offset) + 1 as next_offset from committed group by 1, 2),
high as (select topic, "partition", max("offset") + 1 as high from log group by 1, 2)
"""
SHOWN = """topic, "partition", "offset", timestamp_ms, timestamp_type, hex(key) as key, hex(value) as value,
  array_to_string(list_transform(headers, lambda h: h.key || '=' || coalesce(hex(h.value), 'null')), ';') as headers"""
#: A segment's closing rule, one row after the other.
GREEDY = """, r(topic, p, o, seg, acc, cnt, st, mx) as (
  select topic, "partition", "offset", 0, size, 1::bigint, timestamp_ms, timestamp_ms from sized where "offset" = 0
  union all
  select e.topic, e."partition", e."offset", case when c then seg + 1 else seg end, case when c then e.size else acc + e.size end,
    case when c then 1 else cnt + 1 end, case when c then e.timestamp_ms else coalesce(st, e.timestamp_ms) end, case when c then e.timestamp_ms else greatest(mx, e.timestamp_ms) end
  from (select *, (acc >= {bytes} or cnt >= {rows} or coalesce(mx - st, 0) >= {time}) as c from r) r
  join sized e on e.topic = r.topic and e."partition" = r.p and e."offset" = r.o + 1),
segs as (
  select topic, p as "partition", min(o) as from_offset, max(o) as to_offset, count(*) as n_records, max(acc)::bigint as buffered_bytes,
    bool_or(acc >= {bytes} or cnt >= {rows} or coalesce(mx - st, 0) >= {time}) as closed
  from r group by topic, p, seg)
"""
FAR = 2**62


def _sql(select: str, more: str = "") -> str:
    return f"with {BASE}{more}\n{select}"


def _greedy(rows: int = FAR, size: int = FAR, time: int = FAR, select: str = "select * from segs") -> str:
    return f"with recursive {BASE}{GREEDY.format(rows=rows, bytes=size, time=time)}\n{select}"


_SEGMENT_LIST = """select topic, "partition", printf('%020d-%020d.parquet', from_offset, to_offset) as name, from_offset, to_offset from ({})"""
_BY_STEP = 'select topic, "partition", ("offset" // 100) * 100 as from_offset, max("offset") as to_offset from log group by 1, 2, 3'
_COMMITTED = "select topic, \"partition\", from_offset, to_offset from committed"
_DAMAGED = """, kept as (select topic, "partition", from_offset, to_offset, 'parquet' as ext from committed where not ("partition" = 1 and from_offset = 100)),
damaged as (
  select * from kept
  union all select topic, "partition", from_offset, to_offset + 50, 'parquet' from kept where "partition" = 2 and from_offset % 200 = 0
  union all select topic, "partition", from_offset, to_offset, 'ndjson' from kept where "partition" = 3 and from_offset % 200 = 0
  union all select topic, "partition", from_offset + 5, from_offset, 'parquet' from kept where "partition" = 3 and from_offset % 300 = 0)"""
_STATUS = """, status as (
  select m.name, case when m."partition" = 1 then null else h.high end as source_high,
    case when m."partition" != 1 and h.high is not null then coalesce(n.next_offset, 0) end as dest_next,
    case when m."partition" != 1 and h.high is not null then greatest(0, h.high - coalesce(n.next_offset, 0)) end as lag,
    case when m."partition" = 1 and h.high is not null then 'timed out' when h.high is null then 'source has no such log' end as error
  from mirrors m left join high h using (topic, "partition") left join next_expected n using (topic, "partition"))"""

#: A row as the line that an archive holds.
_LINE = """'{"topic":"' || topic || '","partition":' || "partition" || ',"offset":' || "offset"
  || case when timestamp_ms is null then '' else ',"timestamp_ms":' || timestamp_ms end || ',"timestamp_type":"' || timestamp_type || '"'
  || case when key is null then '' else ',"key":"' || base64(key) || '"' end || case when value is null then '' else ',"value":"' || base64(value) || '"' end
  || case when event_id % 4 = 0 then '' else ',"headers":[{"key":"trace-id","value":"' || base64(encode('t' || event_id)) || '"},{"key":"null-value"}]' end || '}'"""
_APPENDED = _sql(f"""select {SHOWN} from (select * replace (case when "offset" < 100 then timestamp_ms else coalesce(timestamp_ms, 1700000000000) end as timestamp_ms,
  case when "offset" < 100 then timestamp_type when timestamp_ms is null then 'log_append_time' else 'create_time' end as timestamp_type) from log)""")

ORACLE_SQL = {
    "summary": _sql('select topic, "partition", count(distinct "offset" // 100) as n_segments, sum(size)::bigint as payload_bytes, max("offset") + 1 as next_offset from sized group by 1, 2'),
    "make_log": _sql('select event_id, topic, "partition", "offset" from log'),
    "envelope": _sql(f"select {SHOWN} from (select * replace (case when event_id % 3 = 2 then null else epoch_us(ts) // 1000 end as timestamp_ms) from log)"),
    "log_source": _sql(f'select {SHOWN} from log where "partition" != 1 and "offset" >= "partition" * 10 + 100'),
    "high_watermark": _sql('select m.topic, m."partition", coalesce(h.high, 0) as high from mirrors m left join high h using (topic, "partition")'),
    "log_sizes": _sql('select topic, "partition", count(*) as n_records, sum(size)::bigint as payload_bytes, sum(object_size)::bigint as object_bytes from sized group by 1, 2'),
    "header_index": _sql('select topic, "partition", "offset", i::int as "position", headers[i + 1].key as header_key, hex(headers[i + 1].value) as header_value from log, unnest(range(len(headers))) as t(i)'),
    "mirror_assignment": _sql('select m.name as mirror, coalesce(m.destination_name_override, topic) as destination, topic, "partition", "offset" from log join mirrors m using (topic, "partition")'),
    "seek": _sql('select topic, "partition", "offset" from log left join next_expected using (topic, "partition") where "offset" >= coalesce(next_offset, 0)'),
    "segment_by_count": _greedy(rows=ROWS),
    "segment_by_bytes": _greedy(size=BYTES),
    "segment_by_time": _greedy(time=TIME_MS),
    "segment": _greedy(ROWS, BYTES, TIME_MS),
    "drain_tail": _sql(f'select topic, "partition", count(*) as drained, (count(*) // {ROWS}) * {ROWS} as kept from log group by 1, 2'),
    "manifest": _sql('select topic, "partition", ("offset" // 100) * 100 as from_offset, max("offset") as to_offset, count(*) as n_records, sum(size)::bigint as buffered_bytes from sized group by 1, 2, 3'),
    "next_expected": _sql('select m.topic, m."partition", coalesce(next_offset, 0) as next_offset from mirrors m left join next_expected using (topic, "partition")'),
    "counters": _sql('select topic, "partition", sum(n_records)::bigint as records_total, sum(encoded_bytes)::bigint as bytes_total, count(*) as flushes_total from committed group by 1, 2'),
    "gauges": _sql('select topic, "partition", max(to_offset) + 1 as offset_verified, epoch_us(max(committed_at)) // 1000000 as last_flush from committed group by 1, 2'),
    "flush_age": _sql("select topic, \"partition\", epoch_us(timestamp '2024-12-31 00:00:00') // 1000000 - epoch_us(max(committed_at)) // 1000000 as age_s, (epoch_us(timestamp '2024-12-31 00:00:00') // 1000000 - epoch_us(max(committed_at)) // 1000000) * 1000 > 120000 as alert from committed group by 1, 2"),
    "flush_intervals": _sql('select topic, "partition", from_offset, coalesce(epoch_us(committed_at) // 1000 - lag(epoch_us(committed_at) // 1000) over (partition by topic, "partition" order by from_offset), 0) as interval_ms from committed'),
    "heartbeat_progress": _sql('select topic, "partition", timestamp_ms // 3600000 * 3600 as beat, count(*) as n_records, max("offset") + 1 as expected from log where timestamp_ms is not null group by 1, 2, 3'),
    "catalog_segments": _sql(
        "select dir, name, from_offset, to_offset, ext from found",
        """, found as (
  select topic || '/' || "partition" as dir, unnest([printf('%020d-%020d.parquet', from_offset, to_offset), '+' || from_offset || '-+' || to_offset || '.ndjson']) as name,
    from_offset::varchar as from_offset, to_offset::varchar as to_offset, unnest(['parquet', 'ndjson']) as ext from committed)""",
    ),
    "chain_validate": _sql(
        """select topic, "partition", 'mixed_format' as kind, from_offset, to_offset, null::bigint as expected_from from damaged where ext != 'parquet'
union all select topic, "partition", 'inverted_range', from_offset, to_offset, null from damaged where ext = 'parquet' and to_offset < from_offset
union all select topic, "partition", 'gap_or_overlap', from_offset, to_offset, want from (
  select *, coalesce(lag(to_offset) over (partition by topic, "partition" order by from_offset, to_offset) + 1, 0) as want from damaged where ext = 'parquet' and to_offset >= from_offset) where from_offset != want""",
        _DAMAGED,
    ),
    "conflicts": _sql('select topic, "partition", from_offset + 250 as from_offset, to_offset + 250 as to_offset from committed p where exists (select 1 from committed e where e.topic = p.topic and e."partition" = p."partition" and p.from_offset + 250 <= e.to_offset and e.from_offset <= p.to_offset + 250)'),
    "conflicts_same_key": _sql('select topic, "partition", from_offset + 100 as from_offset, to_offset + 100 as to_offset from committed p where exists (select 1 from committed e where e.topic = p.topic and e."partition" = p."partition" and e.from_offset = p.from_offset + 100 and e.to_offset = p.to_offset + 100)'),
    "gate_contiguous": _sql(
        'select topic, "partition", expected, "offset" as actual from (select *, coalesce(lag("offset") over (partition by topic, "partition" order by arrival) + 1, 0) as expected from broken) where "offset" != expected',
        """, broken as (
  select topic, "partition", "offset", event_id * 2 as arrival from log where "offset" % 50 != 17
  union all select topic, "partition", "offset", event_id * 2 + 1 from log where "offset" % 50 != 17 and "offset" % 70 = 3)""",
    ),
    "gate_position": _sql('select topic, "partition", coalesce(next_offset, 0) as expected, actual from (select topic, "partition", min("offset") as actual from log where "offset" >= 100 + "partition" group by 1, 2) left join (select topic, "partition", max(to_offset) + 1 as next_offset from committed where from_offset < 100 group by 1, 2) using (topic, "partition") where coalesce(next_offset, 0) != actual'),
    "gate_produced": _sql('select topic, "partition", "offset" from log where "offset" % 61 = 7'),
    "idle_drift": _sql('select topic, "partition", next_offset + 1 as expected, next_offset as actual from next_expected where "partition" = 2'),
    "status": _sql("select * from status", _STATUS),
    "health": _sql("select count(*) as mirrors, count(error) as failed, count(error) = 0 as healthy from status", _STATUS),
    "end_to_end_lag": _sql('select topic, "partition", high - next_offset as lag from high join next_expected using (topic, "partition")'),
    "audit_mirror": _sql("""select topic, "partition", count(*) as n_source, count(*) filter ("offset" % 97 != 5) + count(*) filter ("offset" % 211 = 3) as n_destination, count(*) filter ("offset" % 97 = 5) as missing,
  count(*) filter ("offset" % 211 = 3) as extra, count(*) filter ("offset" % 97 != 5 and "offset" % 89 = 7) as changed from log group by 1, 2"""),
    "append_log": _APPENDED,
    "append_once": _APPENDED,
    "append_log_restamped": _sql(f"""select {SHOWN} from (select * replace (1700000000000::bigint as timestamp_ms, 'log_append_time' as timestamp_type) from log where "offset" >= 100)"""),
    "scan_parquet": _sql(f"select {SHOWN} from log"),
    "scan_ndjson": _sql(f"select {SHOWN} from log"),
    "replay": _sql(f'select {SHOWN} from log where "offset" between 150 and 349'),
    "replay_in_order": _sql(f'select {SHOWN}, true as in_order from log where "partition" < 2 and "offset" between 150 and 349'),
    "write_archive": _sql(f'select topic, "partition", count(*) as n_lines, sum(length({_LINE}))::bigint as n_chars from log group by 1, 2'),
    "archive_report": _sql(f'select topic, "partition", count(*) as records_total, sum(length({_LINE}) + 1)::bigint as bytes_total, count(distinct "offset" // 100) as flushes_total, max("offset") + 1 as offset_verified, count(distinct "offset" // 100) as n_intervals, false as alert, true as flushed from log group by 1, 2'),
    "status_archive": _sql("""select m.name, h.high as source_high, case when m."partition" != 1 then h.high // 100 * 100 end as dest_next, case when m."partition" != 1 then h.high % 100 end as lag,
  case when h.high is null then 'source has no such log' when m."partition" = 1 then 'destination: gap_or_overlap at 1099511627776-1099511627776' end as error from mirrors m left join high h using (topic, "partition")"""),
    "commit_segments": _sql(_SEGMENT_LIST.format(_COMMITTED)),
    "mirror_once": _greedy(ROWS, BYTES, TIME_MS, 'select topic, "partition", from_offset, to_offset from segs'),
    "mirror_store": _sql("""select topic, "partition", printf('%020d-%020d.parquet', min("offset"), max("offset")) as name, ("offset" // 100) * 100 as from_offset, max("offset") as to_offset,
  count(*) as n_rows, sum(length(hex(value)))::bigint as n_digits from log group by topic, "partition", "offset" // 100"""),
    "resume_from_destination": _sql(_SEGMENT_LIST.format(_BY_STEP)),
    "parallel_mirrors": _sql('select coalesce(m.destination_name_override, topic) as topic, "partition", ("offset" // 100) * 100 as from_offset, max("offset") as to_offset from log join mirrors m using (topic, "partition") group by 1, 2, 3'),
    "mirror_stream": _sql(_SEGMENT_LIST.format(_COMMITTED)),
    "drained_stream": _sql(_SEGMENT_LIST.format(_BY_STEP)),
    "progress_by_log": _sql('select topic, "partition", count(*) as records_total, sum(size)::bigint as bytes_total, count(*) // 100 as flushes_total, (count(*) // 100) * 100 as expected from sized group by 1, 2'),
    "progress_metrics": _sql("select count(*) as n_records, sum(size)::bigint as payload_bytes from sized"),
}
