"""Cutting logs into segments, and what is known of segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.columns import payload_bytes
from tidelog.operators import jumps
from tidelog.schema import LOG

ENDLESS = jumps.ENDLESS


def sizes(log: DataFrame, mode: str = "directory") -> DataFrame:
    """topic, partition, rows and payload bytes of each log."""
    return log.groupBy(*LOG).agg(F.count("*").alias("n_records"), F.sum(payload_bytes(mode)).cast("bigint").alias("payload_bytes"))


def header_index(log: DataFrame) -> DataFrame:
    """A row per header: topic, partition, offset, position, header_key, header_value."""
    return log.select(*LOG, "offset", F.posexplode("headers").alias("position", "h")).select(*LOG, "offset", "position", F.col("h.key").alias("header_key"), F.col("h.value").alias("header_value"))


def by_count(log: DataFrame, max_offsets: int, positions: DataFrame | None = None) -> DataFrame:
    """log with from_offset, the first offset of its segment: every max_offsets rows from the log's position on (default 0)."""
    step = max(1, max_offsets)
    if positions is None:
        return log.withColumn("from_offset", F.floor(F.col("offset") / step) * step)
    start = F.coalesce("next_offset", F.lit(0))
    joined = log.join(positions.select(*LOG, "next_offset"), LOG, "left")
    return joined.withColumn("from_offset", start + F.floor((F.col("offset") - start) / step) * step).drop("next_offset")


def cut(log: DataFrame, max_offsets: int = ENDLESS, max_bytes: int = ENDLESS, max_time_ms: int = ENDLESS, mode: str = "directory", stretch: int = 1 << 17) -> DataFrame:
    """topic, partition, from_offset, to_offset, n_records, buffered_bytes, closed: the logs' segments.

    A segment closes with the row that brings it to max_offsets rows or max_bytes bytes, or whose time lies max_time_ms
    or more after its first; time is the running maximum of timestamp_ms, null times inherit it, and it starts at the
    segment's first time. closed is false for the open tail of a log. Offsets must be dense. With no limit but rows, the
    cut is arithmetic. Otherwise a log is cut in stretches of that many rows by jump tables (see jumps), each a task's
    work; only offset, size and time travel.
    """
    narrow = log.select(*LOG, "offset", payload_bytes(mode).alias("size"), "timestamp_ms")
    if max_bytes >= ENDLESS and max_time_ms >= ENDLESS:
        found = by_count(narrow, max_offsets).groupBy(*LOG, "from_offset")
        found = found.agg(F.max("offset").alias("to_offset"), F.count("*").alias("n_records"), F.sum("size").cast("bigint").alias("buffered_bytes"))
        return found.withColumn("closed", F.col("n_records") >= max(1, max_offsets))

    return jumps.cut(narrow, jumps.Limits(max_offsets, max_bytes, max_time_ms), stretch)


def drained(segments: DataFrame, drain: bool) -> DataFrame:
    """The segments that a stop leaves behind: with drain the open tails too."""
    return segments if drain else segments.filter("closed")


def with_segments(log: DataFrame, segments: DataFrame, block: int = 1024) -> DataFrame:
    """log's rows with from_offset and to_offset of their segment; rows of no segment are left out.

    Segments are listed under every block of offsets that they touch, so rows meet them by an equality join and only
    the few segments of their own block are compared.
    """
    at = segments.select(*LOG, "from_offset", "to_offset", F.explode(F.sequence(F.floor(F.col("from_offset") / block), F.floor(F.col("to_offset") / block))).alias("_block"))
    return log.withColumn("_block", F.floor(F.col("offset") / block)).join(at, [*LOG, "_block"]).filter("offset between from_offset and to_offset").drop("_block")


def manifest(log: DataFrame, mode: str = "directory") -> DataFrame:
    """Per segment of a log with from_offset: first and last offset, rows and payload bytes."""
    return log.groupBy(*LOG, "from_offset").agg(F.max("offset").alias("to_offset"), F.count("*").alias("n_records"), F.sum(payload_bytes(mode)).cast("bigint").alias("buffered_bytes"))


def next_expected(segments: DataFrame, logs: DataFrame | None = None) -> DataFrame:
    """topic, partition, next_offset: one past each log's last archived offset; 0 for logs without a segment."""
    found = segments.groupBy(*LOG).agg((F.max("to_offset") + 1).cast("bigint").alias("next_offset"))
    if logs is None:
        return found
    return logs.select(*LOG).distinct().join(found, LOG, "left").select(*LOG, F.coalesce("next_offset", F.lit(0)).cast("bigint").alias("next_offset"))


def flush_intervals(segments: DataFrame) -> DataFrame:
    """Milliseconds from the previous segment's commit of the same log, 0 for the first (committed_at)."""
    w = Window.partitionBy(*LOG).orderBy("from_offset")
    gap = F.unix_millis("committed_at") - F.unix_millis(F.lag("committed_at").over(w))
    return segments.select(*LOG, "from_offset", F.coalesce(gap, F.lit(0)).cast("bigint").alias("interval_ms"))


def heartbeat_progress(log: DataFrame, every: str = "30 seconds") -> DataFrame:
    """Per log and interval of timestamp_ms: rows seen and the offset expected next; rows without a time are left out."""
    timed = log.filter("timestamp_ms is not null").withColumn("at", F.timestamp_millis("timestamp_ms"))
    return timed.groupBy(*LOG, F.window("at", every).start.alias("beat")).agg(F.count("*").alias("n_records"), (F.max("offset") + 1).alias("expected"))
