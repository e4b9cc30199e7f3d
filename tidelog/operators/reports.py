"""Reports: status and lag of mirrors, counters, gauges, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.plans.storage import stored
from tidelog.schema import LOG


def status(mirrors: DataFrame, high: DataFrame, positions: DataFrame, renamed: bool = False) -> DataFrame:
    """name, source_high, dest_next, lag, error per mirror.

    high: topic, partition, high, error; a source with an error hides the destination. lag is never below 0, and null
    if either side is unknown; a destination without segments is at 0. Positions may have an error too, which is then
    the row's. renamed: positions go by the destinations' names (override, else topic), not by the sources'.
    """
    if renamed:
        mirrors = mirrors.withColumn("_dest", F.coalesce("destination_name_override", "topic"))
    else:
        mirrors = mirrors.withColumn("_dest", F.col("topic"))
    failed = F.col("error") if "error" in positions.columns else F.lit(None).cast("string")
    joined = mirrors.join(high.select(*LOG, "high", F.col("error").alias("source_error")), LOG, "left")
    joined = joined.join(positions.select(F.col("topic").alias("_dest"), "partition", "next_offset", failed.alias("_failed")), ["_dest", "partition"], "left")
    error = F.when(F.col("source_error").isNotNull(), F.col("source_error")).when(F.col("high").isNull(), F.lit("source has no such log")).when(F.col("_failed").isNotNull(), F.concat(F.lit("destination: "), "_failed"))
    dest = F.when(error.isNull(), F.coalesce("next_offset", F.lit(0))).cast("bigint")
    source = F.when(F.col("source_error").isNull(), F.col("high"))
    return joined.select("name", source.alias("source_high"), dest.alias("dest_next"), F.when(source.isNotNull() & dest.isNotNull(), F.greatest(F.lit(0), source - dest)).cast("bigint").alias("lag"), error.alias("error"))


def health(found: DataFrame) -> DataFrame:
    """One row: mirrors, failed, healthy."""
    return found.agg(F.count("*").alias("mirrors"), F.count("error").alias("failed"), (F.count("error") == 0).alias("healthy"))


def end_to_end_lag(high: DataFrame, positions: DataFrame) -> DataFrame:
    """topic, partition, lag: source head minus verified offset, for logs that have both."""
    return high.join(positions, LOG).select(*LOG, (F.col("high") - F.col("next_offset")).cast("bigint").alias("lag"))


def counters(segments: DataFrame) -> DataFrame:
    """records_total, bytes_total, flushes_total per log."""
    return segments.groupBy(*LOG).agg(F.sum("n_records").cast("bigint").alias("records_total"), F.sum("encoded_bytes").cast("bigint").alias("bytes_total"), F.count("*").alias("flushes_total"))


def gauges(segments: DataFrame) -> DataFrame:
    """offset_verified (next durable offset) and last_flush (seconds) per log."""
    return segments.groupBy(*LOG).agg((F.max("to_offset") + 1).cast("bigint").alias("offset_verified"), F.unix_seconds(F.max("committed_at")).alias("last_flush"))


def flush_age(segments: DataFrame, as_of: str, max_time_ms: int) -> DataFrame:
    """Seconds since the last flush at as_of, and whether that is over twice the flush time."""
    age = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds(F.max("committed_at"))
    return segments.groupBy(*LOG).agg(age.alias("age_s")).withColumn("alert", F.col("age_s") * 1000 > 2 * max_time_ms)


def audit(source: DataFrame, destination: DataFrame, timestamps: bool = True, bits: int = 16, most: int = 1_000_000) -> DataFrame:
    """Per log: rows on both sides, and how many are missing, extra or changed (key, value, headers, and the time if asked).

    Both sides are first compared by blocks of 2^bits offsets: rows, and 128 bits of row hashes that don't depend on
    order. Only digests are shuffled; rows are joined by offset in the blocks that differ, and nothing is where all are
    equal. Up to `most` differing blocks are sent to the scans, more are joined. A row that repeats counts as often.
    """
    columns = ["key", "value", "headers", *(["timestamp_ms"] if timestamps else [])]
    there = digests(source, columns, bits).select(*LOG, "_block", F.struct("n", "h1", "h2").alias("s"))
    here = digests(destination, columns, bits).select(*LOG, "_block", F.struct("n", "h1", "h2").alias("d"))
    blocks = stored(there.join(here, [*LOG, "_block"], "full"), "blocks")
    same = F.col("s").eqNullSafe(F.col("d"))
    counts = blocks.filter(same).groupBy(*LOG).agg(F.sum("s.n").alias("n_source"), F.sum("d.n").alias("n_destination"), *[F.lit(0).cast("bigint").alias(c) for c in ("missing", "extra", "changed")])
    differ = blocks.filter(~same).select(*LOG, "_block")
    if n := differ.count():
        counts = counts.unionByName(_audit_rows(*(_in_blocks(df, differ, bits, n <= most) for df in (source, destination)), columns))
    return counts.groupBy(*LOG).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_source", "n_destination", "missing", "extra", "changed")])


def digests(log: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """topic, partition, _block, n, h1, h2: per block of offsets its rows and two sums modulo 2 of 64-bit row hashes.

    Hashes skip nulls, so every value goes with a mark of whether it is one.
    """
    marked = lambda c: (c.isNull(), c)
    fields = []
    for c in columns:
        if c == "headers":
            fields += [F.coalesce(F.size(c), F.lit(-1)), F.transform(c, lambda h: F.struct(*[x.alias(f"c{i}") for i, x in enumerate((*marked(h["key"]), *marked(h["value"])))]))]
        else:
            fields += marked(F.col(c))
    rows = log.select(*LOG, F.shiftright("offset", bits).alias("_block"), F.xxhash64("offset", *fields).alias("h1"), F.xxhash64(F.lit("second"), *reversed(fields), "offset").alias("h2"))
    return rows.groupBy(*LOG, "_block").agg(F.count("*").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))


def _in_blocks(log: DataFrame, blocks: DataFrame, bits: int, few: bool) -> DataFrame:
    keyed = log.withColumn("_block", F.shiftright("offset", bits))
    return keyed.join(F.broadcast(blocks) if few else blocks, [*LOG, "_block"], "left_semi").drop("_block")


def _audit_rows(source: DataFrame, destination: DataFrame, columns: list[str]) -> DataFrame:
    side = lambda df, s: df.select(*LOG, "offset", F.struct(*columns).alias(s))
    both = side(source, "s").join(side(destination, "d"), [*LOG, "offset"], "full")
    changed = F.col("s").isNotNull() & F.col("d").isNotNull() & ~F.col("s").eqNullSafe(F.col("d"))
    return both.groupBy(*LOG).agg(F.count("s").alias("n_source"), F.count("d").alias("n_destination"), F.count(F.when(F.col("d").isNull(), 1)).alias("missing"), F.count(F.when(F.col("s").isNull(), 1)).alias("extra"), F.count(F.when(changed, 1)).alias("changed"))
