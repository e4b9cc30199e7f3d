"""Logs: dense offsets for any table, envelopes, reading from explicit offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.columns import known_type
from tidelog.schema import LOG, TIMESTAMP_TYPES


def make_log(df: DataFrame, order: list[str], stretches: int | None = None) -> DataFrame:
    """df (topic, partition, …) with offset: dense from 0 in each log by the order columns.

    The first order column is cut into stretches by its quantiles, so that a log that holds most rows is still numbered
    by many tasks: rows are counted per log and stretch, the counts become each stretch's first offset, and rows are
    numbered within their stretch. Nulls of the first order column come first.
    """
    n = stretches or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[order[0]].dataType.simpleString()
    by = F.col(order[0])
    if kind in ("timestamp", "timestamp_ntz"):
        by = F.unix_micros(by.cast("timestamp"))
    elif kind == "date":
        by = F.unix_date(by)
    elif kind == "string":
        by = F.conv(F.rpad(F.hex(F.substring(by.cast("binary"), 1, 6)), 12, "0"), 16, 10)  # six bytes: exact as a double
    df = df.withColumn("_by", by.cast("double"))
    cuts = sorted(set(df.approxQuantile("_by", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    df = df.withColumn("_stretch", _bucket(F.col("_by"), cuts)).drop("_by")
    counts = df.groupBy(*LOG, "_stretch").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*LOG).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*LOG, "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    nth = F.row_number().over(Window.partitionBy(*LOG, "_stretch").orderBy(*order))
    return df.withColumn("_nth", nth).join(first, [*LOG, "_stretch"]).withColumn("offset", (F.col("_first") + F.col("_nth") - 1).cast("bigint")).drop("_stretch", "_nth", "_first")


def _bucket(by: Column, cuts: list[float]) -> Column:
    """Number of cuts not above the value, by a binary search in an array of them; 0 for null."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    known = F.lit(cuts)
    further = lambda at, step: F.when((at + step <= len(cuts)) & (by >= F.get(known, at + step - 1)), at + step).otherwise(at)
    return F.aggregate(steps, F.lit(0), further)


def envelope(df: DataFrame) -> DataFrame:
    """A log source's rows (topic, partition, offset, timestamp, timestampType, key, value, headers) as envelopes.

    Without an available timestamp timestamp_ms is null; null headers become an empty list.
    """
    kind = F.lit(TIMESTAMP_TYPES[-1])
    for number in (0, 1):
        kind = F.when(F.col("timestampType") == number, F.lit(TIMESTAMP_TYPES[number])).otherwise(kind)
    empty = F.array().cast(df.schema["headers"].dataType)
    return df.select(
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.when(F.col("timestampType").isin(0, 1), F.unix_millis("timestamp")).alias("timestamp_ms"),
        kind.alias("timestamp_type"),
        "key",
        "value",
        F.coalesce("headers", empty).alias("headers"),
    )


def normalised(df: DataFrame) -> DataFrame:
    """Decoded envelopes: offsets as long (beyond its range an error), unknown timestamp types and null headers replaced."""
    return df.select("topic", "partition", F.col("offset").cast("bigint").alias("offset"), "timestamp_ms", known_type(F.col("timestamp_type")).alias("timestamp_type"), "key", "value", F.coalesce("headers", F.array().cast(df.schema["headers"].dataType)).alias("headers"))


def log_source(log: DataFrame, starts: DataFrame) -> DataFrame:
    """The rows of the logs named in starts (topic, partition, start) from that offset on."""
    return log.join(starts.select(*LOG, "start"), LOG).filter("offset >= start").drop("start")


def broker_options(starts: dict[str, dict[int, int]], servers: str) -> dict[str, str]:
    """Options of Spark's own broker reader for explicit offsets, where its connector is installed."""
    import json

    by_topic = {t: {str(p): o for p, o in sorted(ps.items())} for t, ps in sorted(starts.items())}
    return {"kafka.bootstrap.servers": servers, "assign": json.dumps({t: [int(p) for p in ps] for t, ps in by_topic.items()}), "startingOffsets": json.dumps(by_topic), "includeHeaders": "true", "failOnDataLoss": "true"}


def broker_log(spark: SparkSession, starts: dict[str, dict[int, int]], servers: str) -> DataFrame:
    return envelope(spark.read.format("kafka").options(**broker_options(starts, servers)).load())


def high_watermark(log: DataFrame, logs: DataFrame | None = None) -> DataFrame:
    """topic, partition, high: the offset a log would assign next; logs without rows have 0."""
    high = log.groupBy(*LOG).agg((F.max("offset") + 1).alias("high"))
    if logs is None:
        return high
    return logs.select(*LOG).distinct().join(high, LOG, "left").select(*LOG, F.coalesce("high", F.lit(0)).cast("bigint").alias("high"))


def seek(log: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows at or after each log's next expected offset (positions: topic, partition, next_offset); unknown logs from 0."""
    return log.join(positions.select(*LOG, "next_offset"), LOG, "left").filter(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).drop("next_offset")


def assigned(log: DataFrame, mirrors: DataFrame) -> DataFrame:
    """Rows of the mirrors' logs with destination: the override if there is one, else the topic.

    mirrors: name, topic, partition, destination_name_override. One log under two mirrors is an error.
    """
    twice = mirrors.groupBy(*LOG).count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"a log has more than one mirror: {twice.first().asDict()}")
    return log.join(mirrors.select(*LOG, F.col("name").alias("mirror"), "destination_name_override"), LOG).withColumn("destination", F.coalesce("destination_name_override", "topic")).drop("destination_name_override")
